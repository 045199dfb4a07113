"""Word shingles of whole batches of texts as 64-bit hashes, with array operations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from drayage.llm.common import worker_cache

BASE = 0x9E3779B97F4A7C15 | 1
#: A-Z to lower case, every other white space to a space.
FOLD = bytes((b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b) for b in range(256))
SEGMENT = 1 << 18


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@worker_cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (BASE, pow(BASE, -1, 2**64)):
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def _hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of folded text: a polynomial of its bytes, read off running sums."""
    b = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(b) + 2, np.int8)
    inside[1:-1] = b != 32
    edge = np.diff(inside)
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    size = 1 << max(18, (len(b)).bit_length())
    power, back = _powers(size)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power[: len(b)], out=sums[1:])
    return start, mixed((sums[stop] - sums[start]) * back[start] ^ (stop - start).astype(np.uint64) << np.uint64(56))


def _segments(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Stretches of about SEGMENT bytes that end between words, so one very long text needs no more memory than many short ones."""
    at = 0
    while at < len(data):
        end = len(data) if len(data) - at <= SEGMENT else data.rfind(b" ", at + 1, at + SEGMENT) + 1
        if end <= at:
            end = data.find(b" ", at + SEGMENT) + 1 or len(data)
        yield at, data[at:end]
        at = end


def word_hashes(texts: list[str], fold: bytes = FOLD) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words of all texts in order, number of words of each text); `fold` makes a space of what is no word."""
    raw = [t.encode("utf-8", "replace").translate(fold) for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    where, found = [], []
    for at, part in _segments(b" ".join(raw)):
        s, h = _hash_words(part)
        where.append(s + at)
        found.append(h)
    if not found:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    owner = np.searchsorted(ends, np.concatenate(where), side="right")
    return np.concatenate(found), np.bincount(owner, minlength=len(texts))


def shingle_sets(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle hash) of the distinct shingles, by text and hash; a text of fewer words has all of them as one."""
    words, n = word_hashes(texts)
    first = np.cumsum(n) - n
    owner = np.repeat(np.arange(len(texts)), n)
    full = np.maximum(n - width + 1, 0)
    h = np.zeros(max(0, len(words) - width + 1), np.uint64)
    for k in range(width):
        h = h * np.uint64(BASE) + words[k : k + len(h)]
    ok = np.arange(len(h)) - first[owner[: len(h)]] < full[owner[: len(h)]]
    doc, h = owner[: len(h)][ok], mixed(h[ok])
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        some = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            more = n[short] > k
            some[more] = some[more] * np.uint64(BASE) + words[first[short][more] + k]
        doc = np.concatenate([doc, short])
        h = np.concatenate([h, mixed(some + n[short].astype(np.uint64))])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[keep], h[keep]

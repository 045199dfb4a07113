"""Exact token counts of every prefix of a text under a byte-level BPE vocabulary, by dynamic programming over prefixes."""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drayage.llm import pieces
from drayage.llm.common import add_from_texts, worker_cache
from drayage.llm.last_tokens import LastTokens

#: A worker remembers between one and two times this many pieces, or this many characters of pieces, those met last; others
#: are worked out anew.
REMEMBERED, CHARACTERS = 350_000, 8_000_000
#: Pieces up to so many bytes are worked out together as rows of one array.
ROW_BYTES = 40


class Vocabulary:
    """Merges of a tokenizer file of the `tokenizers` library (kind BPE, byte-level, without normalizer).

    Counts come from the last token of each prefix: count(p) = count(p - its length) + 1.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or model.get("ignore_merges"):
            raise ValueError(f"{path} is not a plain byte-level BPE")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}
        raw = {s: bytes(byte_of[c] for c in s) for s in model["vocab"] if all(c in byte_of for c in s)}
        self.rank = {}
        for n, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.rank.setdefault((raw[a], raw[b]), n)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.program = LastTokens([t for t in raw.values() if len(t) == 1 or self.encode(t) == [t]], self.encode)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.size = 0

    def encode(self, data: bytes) -> list[bytes]:
        """Merge by rank, for short byte strings."""
        parts = [data[k : k + 1] for k in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.rank.get(p, 1 << 60), k) for k, p in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def learn(self, new: list[str]) -> None:
        """Work out the prefix counts of distinct pieces, kept as bytes of 32-bit numbers, one for each character."""
        raw = [p.encode("utf-8", "replace") for p in new]
        self.size += sum(map(len, new))
        by_size: dict[int, list[int]] = {}
        for k, b in enumerate(raw):
            by_size.setdefault(min(len(b), ROW_BYTES + 1), []).append(k)
        for n, ks in by_size.items():
            if n > ROW_BYTES:
                for k, (_, count) in zip(ks, self.program.strings([raw[k] for k in ks])):
                    ends = np.flatnonzero(np.append(np.frombuffer(raw[k], np.uint8)[1:], 0) & 0xC0 != 0x80)
                    self.known[new[k]] = count[1:][ends].tobytes()
                continue
            rows = np.frombuffer(b"".join([raw[k] for k in ks]), np.uint8).reshape(len(ks), n)
            counts = np.ascontiguousarray(self.program.together(rows)[1][1:].T)
            flat = counts.tobytes()
            for j, k in enumerate(ks):
                if len(new[k]) == n:
                    self.known[new[k]] = flat[4 * n * j : 4 * n * (j + 1)]
                else:
                    ends = np.flatnonzero(np.append(rows[j, 1:], 0) & 0xC0 != 0x80)
                    self.known[new[k]] = counts[j, ends].tobytes()

    def counts_of(self, found: list[str]) -> list[bytes]:
        """The prefix counts of each piece; those met lately are remembered, in two generations that bound number and size."""
        if len(self.known) > REMEMBERED or self.size > CHARACTERS:
            self.older, self.known, self.size = self.known, {}, 0
        new = set(found).difference(self.known)
        back = {p: self.older[p] for p in new if p in self.older}
        self.known.update(back)
        self.learn([p for p in new if p not in back])
        return list(map(self.known.__getitem__, found))


@worker_cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _plain(texts: list[str], voc: Vocabulary) -> list[np.ndarray]:
    """Counts at every prefix of each text; special strings count as ordinary text."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    whole = "".join(texts)
    begin = pieces.starts(whole, (ends - sizes)[sizes > 0])
    if not len(begin):
        return [np.zeros(0, np.int64) for _ in texts]
    stop = np.append(begin[1:], len(whole))
    found = list(map(whole.__getitem__, map(slice, begin.tolist(), stop.tolist())))
    inner = np.frombuffer(b"".join(voc.counts_of(found)), np.uint32)
    last = inner[stop - 1].astype(np.int64)
    before = np.cumsum(last) - last
    at = np.searchsorted(begin, ends - sizes)
    base = np.append(before, before[-1] + last[-1])[at]  # tokens of the texts before
    owner = np.searchsorted(ends, begin, side="right")
    out = inner + np.repeat(before - base[owner], stop - begin)
    kind = pieces.classes()[pieces.code_points(whole)]
    # a prefix that ends in white space holds the whole run as one match
    runs = np.flatnonzero((kind[begin[1:]] == pieces.SPACE) & (kind[begin[1:] - 1] == pieces.SPACE) & (owner[1:] == owner[:-1])) + 1
    for k in runs.tolist():
        run = whole[begin[k - 1] : begin[k] + 1]
        out[begin[k]] = before[k - 1] - base[owner[k]] + np.frombuffer(voc.counts_of([run])[0], np.uint32)[-1]
    # a contraction of three characters, cut after two, is an apostrophe and a letter
    short = np.flatnonzero(stop - begin == 3)
    for k in short[pieces.code_points(whole)[begin[short]] == 0x27].tolist():
        if whole[begin[k] + 1 : stop[k]] in pieces.THREE:
            out[begin[k] + 1] = before[k] - base[owner[k]] + 2
    return np.split(out, ends[:-1])


def prefix_counts(texts: list[str], voc: Vocabulary) -> list[np.ndarray]:
    """For each text, the number of tokens of text[:1], text[:2], ..., as the library counts them.

    A special string inside a text is one token of its own, as is the library's default.
    """
    out: list = [None] * len(texts)
    easy = [k for k, t in enumerate(texts) if not any(s in t for s in voc.special)]
    for k, counts in zip(easy, _plain([texts[k] for k in easy], voc)):
        out[k] = counts
    for k, text in enumerate(texts):
        if out[k] is None:
            out[k] = _with_special(text, voc)
    return out


def _with_special(text: str, voc: Vocabulary) -> np.ndarray:
    import regex

    found, begin, base = [], 0, 0
    for m in regex.finditer("|".join(map(regex.escape, sorted(voc.special, key=len, reverse=True))), text):
        # up to its last character the special string is text like any other
        counts = _plain([text[begin : m.end() - 1]], voc)[0] + base
        whole = _plain([text[begin : m.start()]], voc)[0]
        base += (int(whole[-1]) if len(whole) else 0) + 1
        found += [counts, np.array([base])]
        begin = m.end()
    return np.concatenate([*found, _plain([text[begin:]], voc)[0] + base])


def fit(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most `budget` tokens."""
    ok = np.flatnonzero(counts <= budget)
    return int(ok[-1]) + 1 if len(ok) else 0


def count_tokens(docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fit_chars): read off the prefix counts of every whole text.

    fit_chars is the length of the longest prefix of at most `limit` tokens. A null text counts as empty: 0 tokens. Ids may
    be null or repeat; extra columns are ignored; an empty table gives no rows.
    """

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))

    def run(texts: list[str]) -> list:
        n, cut = [], []
        for counts in prefix_counts(texts, vocabulary(path)):
            n.append(int(counts[-1]) if len(counts) else 0)
            cut.append(len(counts) if not n[-1] > limit and (not len(counts) or counts.max() <= limit) else fit(counts, limit))
        return [pa.array(n, pa.int64()), pa.array(cut, pa.int64())]

    out = add_from_texts(rows, "text", run, "n_tokens long, fit_chars long", ["doc_id", "n_bytes"])
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "fit_chars")


def prefix_token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, counts array<int>): element k is the number of tokens of the first k + 1 characters. Null text: an empty array."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(texts: list[str]) -> list:
        return [pa.array([c.astype("int32") for c in prefix_counts(texts, vocabulary(path))], pa.list_(pa.int32()))]

    return add_from_texts(rows, "text", run, "counts array<int>", ["doc_id"])

"""Split whole batches of texts into the matches of the byte-level pre-tokenizer pattern, with array operations.

The pattern's alternatives are: contractions ('s 't 're 've 'm 'll 'd), then letters, numbers or other characters with an
optional space before, then white space (its last character is left to what follows). A boundary depends on the classes of
neighbouring characters only, so one pass over the character classes of a batch finds all of them.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import regex

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
TWO, THREE = ("s", "t", "m", "d"), ("re", "ve", "ll")


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    out = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            a, b = ord(every[m.start()]), ord(every[m.end() - 1])
            out[a : b + 1] = kind
    out[0xD800:0xE000] = OTHER
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def starts(text: str, bounds: np.ndarray) -> np.ndarray:
    """Start positions of the pieces of `text`, the texts of a batch joined; bounds: where each non-empty text starts."""
    cps = code_points(text)
    n = len(cps)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes()[cps]
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    first[n] = True
    run = np.empty(n, bool)
    run[0] = True
    np.not_equal(kind[1:], kind[:-1], out=run[1:])
    run |= first[:n]
    space = kind == SPACE
    # the last white space before something else in the same text
    tail = np.zeros(n, bool)
    tail[:-1] = space[:-1] & ~space[1:] & ~first[1:n]
    after_blank = np.zeros(n, bool)
    after_blank[1:] = tail[:-1] & (cps[:-1] == 0x20)
    begin = (run & space) | tail | (run & ~space & ~after_blank)
    # a lone apostrophe that starts a piece and is followed by letters
    for p in np.flatnonzero((cps == 0x27) & begin & run):
        q = p + 1
        if q >= n or first[q] or kind[q] != LETTER:
            continue
        two = text[q : q + 2]
        if two[0] in TWO:
            size = 1
        elif two in THREE and not first[q + 1]:
            size = 2
        else:
            continue
        begin[q] = False
        if q + size < n and not first[q + size]:
            begin[q + size] = True
    return np.flatnonzero(begin)

"""Byte-level BPE encoding and decoding: ranked merges folded over the byte arrays of distinct pieces."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drayage.llm import pieces
from drayage.llm.common import add_from_texts, ship, slices, worker_cache
from drayage.llm.last_tokens import LastTokens
from drayage.llm.lookup import NONE, Lookup

#: Pieces up to so many bytes are folded together as rows of one array; longer ones are read off their last tokens.
ROW_BYTES = 48
#: A worker remembers between one and two times this many pieces, or this many characters of pieces.
REMEMBERED, CHARACTERS = 100_000, 2_000_000
#: Texts are split into pieces about so many characters at a time, of which only distinct pieces are kept.
SPLIT = 100_000


class Ranks:
    """A rank file of the `tiktoken` format: token bytes in base64 and rank, which is also the id."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, f))}
        self.token = {r: t for t, r in self.rank.items()}
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        # every way to split a token into two tokens: (left id, right id) -> merged id
        found = [(self.rank[t[:k]] << 32 | self.rank[t[k:]], r) for t, r in self.rank.items() for k in range(1, len(t)) if t[:k] in self.rank and t[k:] in self.rank]
        self.merges = Lookup(np.array([k for k, _ in found], np.int64), np.array([v for _, v in found], np.int32))
        self.known, self.older, self.size = {}, {}, 0
        self._program = None

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge, NONE where the bytes together are no token."""
        return self.merges(left.astype(np.int64) << 32 | right.astype(np.int64))

    def fold(self, data: np.ndarray) -> list[bytes]:
        """Encode rows of one length: each step merges every row's pair of least rank, the leftmost of equals."""
        m, n = data.shape
        ids = self.byte[data]
        ranks = np.full((m, n), NONE, np.int32)
        if n > 1:
            ranks[:, :-1] = self.pair(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(m, n - 1)
        size = np.full(m, n)
        column = np.arange(n)

        def step(active: np.ndarray, _: int) -> np.ndarray:
            if not len(active):
                return active
            at = ranks[active].argmin(axis=1)
            least = ranks[active, at]
            go = least != NONE
            active, at, least = active[go], at[go], least[go]
            if not len(active):
                return active
            shift = np.minimum(column + (column > at[:, None]), n - 1)
            ids[active] = np.take_along_axis(ids[active], shift, axis=1)
            ranks[active] = np.take_along_axis(ranks[active], shift, axis=1)
            ids[active, at] = least
            size[active] -= 1
            ranks[active, size[active] - 1] = NONE
            after = at + 1 < size[active]
            ranks[active[~after], at[~after]] = NONE
            ranks[active[after], at[after]] = self.pair(ids[active[after], at[after]], ids[active[after], at[after] + 1])
            before = at > 0
            ranks[active[before], at[before] - 1] = self.pair(ids[active[before], at[before] - 1], ids[active[before], at[before]])
            return active

        reduce(step, range(n - 1), np.arange(m))
        flat = ids.astype("<u4").tobytes()
        return [flat[4 * n * k : 4 * (n * k + s)] for k, s in enumerate(size.tolist())]

    def merge(self, data: bytes) -> list[bytes]:
        """The same merges for one short byte string."""
        parts = [data[k : k + 1] for k in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.rank.get(a + b, NONE), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == NONE:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    @property
    def program(self) -> LastTokens:
        """The last tokens of prefixes, made when the first long piece comes."""
        if self._program is None:
            by_size: dict[int, list[bytes]] = {}
            for t in self.rank:
                by_size.setdefault(len(t), []).append(t)
            own = []
            for n, tokens in by_size.items():
                ids = self.fold(np.frombuffer(b"".join(tokens), np.uint8).reshape(len(tokens), n))
                own += [t for t, x in zip(tokens, ids) if len(x) == 4]
            self._program = LastTokens(own, self.merge)
        return self._program

    def merge_long(self, data: list[bytes]) -> list[bytes]:
        """The ids of long pieces: the last token of the whole, then of what is before it, and so on."""
        program, out = self.program, []
        number = np.array([self.rank[t] for t in program.token], np.int64)
        size = np.array([len(t) for t in program.token], np.int64)
        for d, (last, _) in zip(data, program.strings(data)):
            p, found, at = len(d), [], last.tolist()
            while p:
                found.append(at[p])
                p -= int(size[at[p]])
            out.append(number[np.array(found[::-1], np.int64)].astype("<u4").tobytes())
        return out

    def learn(self, new: list[str]) -> None:
        """Encode distinct pieces that are not known yet."""
        raw = [p.encode("utf-8", "replace") for p in new]
        self.size += sum(map(len, new))
        by_size: dict[int, list[int]] = {}
        for k, b in enumerate(raw):
            by_size.setdefault(min(len(b), ROW_BYTES + 1), []).append(k)
        for n, ks in by_size.items():
            if n > ROW_BYTES:
                self.known.update(zip([new[k] for k in ks], self.merge_long([raw[k] for k in ks])))
            else:
                rows = np.frombuffer(b"".join([raw[k] for k in ks]), np.uint8).reshape(len(ks), n)
                self.known.update(zip([new[k] for k in ks], self.fold(rows)))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        once: dict[str, str] = {}
        parts = []
        for a, b in slices(map(len, texts), SPLIT, len(texts)):
            sizes = np.array([len(t) for t in texts[a:b]], np.int64)
            ends = np.cumsum(sizes)
            whole = "".join(texts[a:b])
            begin = pieces.starts(whole, (ends - sizes)[sizes > 0])
            stops = np.append(begin[1:], len(whole)) if len(begin) else begin
            found = list(map(whole.__getitem__, map(slice, begin.tolist(), stops.tolist())))
            parts.append((list(map(once.setdefault, found, found)), np.searchsorted(begin, np.append(0, ends)).tolist()))
        new = set(once).difference(self.known)
        back = {p: self.older[p] for p in new if p in self.older}
        if len(self.known) > REMEMBERED or self.size > CHARACTERS:
            self.older, self.known, self.size = self.known, {}, 0
            new = set(once)
            back = {p: self.older[p] for p in new if p in self.older}
        self.known.update(back)
        self.learn([p for p in new if p not in back])
        out = []
        for found, at in parts:
            ids = list(map(self.known.__getitem__, found))
            out += [b"".join(ids[a:b]) for a, b in zip(at, at[1:])]
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@worker_cache
def ranks(path: str) -> Ranks:
    return Ranks(path)


def _text_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every whole text; a null text has no ids."""

    def run(texts: list[str]) -> list:
        return [pa.array([np.frombuffer(b, "<i4") for b in ranks(path).encode(texts)], pa.list_(pa.int32()))]

    return add_from_texts(_text_rows(docs, id_col, text_col), "text", run, "ids array<int>", ["doc_id"])


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, bytes) from (doc_id, ids)."""
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [ranks(path).decode(np.array(x or [], "<u4").tobytes()) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {dict(encoded.dtypes)['doc_id']}, bytes binary")


def encode_and_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, encoded and decoded again in one pass.

    A null text counts as empty: no ids, the digests of no bytes. Ids may be null or repeat; extra columns are ignored; an
    empty table gives no rows.
    """

    def run(texts: list[str]) -> list:
        r = ranks(path)
        ids = r.encode(texts)
        digests = [[hashlib.sha256(x).hexdigest() for x in part] for part in (ids, map(r.decode, ids))]
        return [pa.array([len(b) // 4 for b in ids], pa.int64()), *(pa.array(d, pa.string()) for d in digests)]

    return add_from_texts(_text_rows(docs, id_col, text_col), "text", run, "n_tokens long, ids_sha256 string, decoded_sha256 string", ["doc_id"])

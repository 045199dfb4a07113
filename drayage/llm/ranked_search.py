"""Ranked lexical search over bit-sliced Bloom signatures.

Documents of about the same number of terms form blocks. A block's index is one bitmap of its documents for each bit position of
their Bloom signatures. A term that a document holds once, twice, three times, ... is in its signature under a key for each of
these levels, so the conjunction of a key's bitmaps has every document that reaches the level, and some that do not. With the
greatest number of occurrences that a level allows, weighted sums over the bitmaps are upper bounds of scores. The documents of
the greatest bounds are scored exactly from their texts, which gives each item a score to reach; then every document whose bound
reaches it, that is all that are not provably excluded, is scored exactly.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from drayage.llm.common import Scratch, claim, ship, text_slices
from drayage.llm.jaccard_join import sifted
from drayage.llm.shingles import mixed, word_hashes

#: What is no part of a term, as a pattern of code points; bytes from 128 up belong to terms.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Occurrences at which a level begins; the last has no end.
LEVELS = np.array([1, 2, 3, 4, 6, 8, 12, 16, 32, 64])
#: Bits of a signature for each of its keys (at least, and less than twice as many), positions of a key.
BITS, POSITIONS = 12, 4
#: Documents and bits of one block, documents that wait to be dealt to blocks, and terms of a batch of items, about.
DOCS, SIZE, WAIT, TERMS = 512, 1 << 22, 2048, 1 << 16
STEP = np.uint64(0x9E3779B97F4A7C15)


def distinct_terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, term hash, occurrences) of the distinct terms of each text, and the number of terms of each text."""
    h, n = word_hashes(texts, FOLD)
    ends = np.cumsum(n)
    for a, b in zip(ends - n, ends):
        h[a:b].sort()
    owner = np.repeat(np.arange(len(texts)), n)
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])]) if len(h) else np.zeros(0, np.int64)
    return owner[first], h[first], np.diff(np.r_[first, len(h)]), n


def positions(keys: np.ndarray, width: int) -> np.ndarray:
    """The bits of each key in signatures of `width` bits, a power of two."""
    a, b = keys & np.uint64(0xFFFFFFFF), (keys >> np.uint64(32)) | np.uint64(1)
    return ((a[:, None] + b[:, None] * np.arange(POSITIONS, dtype=np.uint64)) & np.uint64(width - 1)).astype(np.int64)


def level_keys(h: np.ndarray, level: np.ndarray | int) -> np.ndarray:
    return mixed(h + STEP * np.asarray(level, np.uint64))


def _signatures(h: np.ndarray, occurrences: np.ndarray) -> np.ndarray:
    """The keys of one document's terms: one for each level that a term reaches."""
    reached = np.searchsorted(LEVELS, occurrences, side="right")
    level = np.arange(reached.sum()) - np.repeat(np.cumsum(reached) - reached, reached)
    return level_keys(np.repeat(h, reached), level)


def _blocks(docs: list[tuple]) -> Iterator[tuple[int, list[tuple], bytes]]:
    """(width, documents, bitmaps) of documents (id, digest, n, keys), the longest apart from the shortest."""
    widths = [1 << max(6, (BITS * len(d[3]) - 1).bit_length()) for d in docs]
    for width in sorted(set(widths)):
        own = [d for d, w in zip(docs, widths) if w == width]
        most = max(8, min(DOCS, SIZE // width))
        for at in range(0, len(own), most):
            part = own[at : at + most]
            bitmaps = np.zeros((width, -(-len(part) // 8)), np.uint8)
            for k, d in enumerate(part):
                bitmaps[np.unique(positions(d[3], width)), k // 8] |= np.uint8(1 << k % 8)
            yield width, part, bitmaps.tobytes()


BLOCK = "width int, ids array<bigint>, digests array<bigint>, sizes array<bigint>, bitmaps binary, df array<bigint>"


def read_documents(docs: DataFrame, terms: np.ndarray, index: bool) -> DataFrame:
    """Blocks of the index (if asked for), and one row a task, of width 0, with the number of its documents that hold each of `terms`."""
    ship(docs.sparkSession)
    kinds = {"l": pa.list_(pa.int64())}

    def row(width, ids, digests, sizes, bitmaps, df) -> pa.RecordBatch:
        cells = [pa.array([width], pa.int32()), *(pa.array([x], kinds["l"]) for x in (ids, digests, sizes)), pa.array([bitmaps], pa.binary()), pa.array([df], kinds["l"])]
        return pa.RecordBatch.from_arrays(cells, names=["width", "ids", "digests", "sizes", "bitmaps", "df"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(__name__)
        df, waiting = np.zeros(len(terms), np.int64), []

        def dealt() -> Iterator[pa.RecordBatch]:
            for width, part, bitmaps in _blocks(waiting):
                yield row(width, [d[0] for d in part], [d[1] for d in part], [d[2] for d in part], bitmaps, None)
            waiting.clear()

        for part, texts in text_slices(batches, "text", 1_000_000, 100_000):
            owner, h, times, n = distinct_terms(texts)
            if len(terms):
                at = np.searchsorted(terms, h)
                df += np.bincount(at[(at < len(terms)) & (terms[np.minimum(at, len(terms) - 1)] == h)], minlength=len(terms))
            if index:
                begin = np.searchsorted(owner, np.arange(len(texts) + 1))
                for k, (i, digest) in enumerate(zip(part.column("id").to_pylist(), part.column("digest").to_pylist())):
                    if n[k]:
                        waiting.append((i, digest, int(n[k]), _signatures(h[begin[k] : begin[k + 1]], times[begin[k] : begin[k + 1]])))
                if len(waiting) >= WAIT:
                    yield from dealt()
        yield from dealt()
        yield row(0, [], [], [], b"", df.tolist())

    return docs.select("id", "digest", "text").mapInArrow(run, BLOCK)


class Batch:
    """A bounded number of items: their terms with weights, and which terms each has."""

    def __init__(self, items: list[tuple[int, list[str]]]):
        self.numbers = [number for number, _ in items]
        self.names = sorted({t for _, terms in items for t in terms})
        found = word_hashes(self.names, FOLD)[0] if self.names else np.zeros(0, np.uint64)
        order = np.argsort(found)
        self.terms, self.names = found[order], [self.names[k] for k in order]
        place = {t: k for k, t in enumerate(self.names)}
        self.has = [sorted(place[t] for t in terms) for _, terms in items]

    def weigh(self, df: dict[int, int], docs: int, total: int) -> None:
        self.docs, self.total = docs, total
        self.weights = np.array([math.floor(1000 * math.log((2 * docs + 2) / (2 * df.get(k, 0) + 1))) for k in range(len(self.terms))], np.int64)

    def measure(self, sizes: list[int]) -> np.ndarray:
        """What a document's length counts; no product leaves 64 bits."""
        return np.array([100 - 50 + 50 * n * self.docs // self.total for n in sizes], np.int64)

    def levels(self, bitmaps: np.ndarray, width: int, count: int) -> np.ndarray:
        """The level that each term may reach in each document, counted from 1; 0: the document does not hold it."""
        out = np.zeros((len(self.terms), count), np.int64)
        alive, hit = np.arange(len(self.terms)), None
        for level in range(len(LEVELS)):
            found = np.bitwise_and.reduce(bitmaps[positions(level_keys(self.terms[alive], level), width)], axis=1)
            hit = found if hit is None else found & hit
            some = hit.any(axis=1)
            alive, hit = alive[some], hit[some]
            if not len(alive):
                break
            out[alive] += np.unpackbits(hit, axis=1, count=count, bitorder="little")
        return out

    def bounds(self, width: int, sizes: list[int], bitmaps: bytes) -> np.ndarray:
        """The most that each document of a block can score for each item."""
        most = np.r_[LEVELS[1:] - 1, np.iinfo(np.int32).max][:, None]
        occurs = np.minimum(most, np.array(sizes)[None, :])
        value = np.zeros((len(LEVELS) + 1, len(sizes)), np.int64)
        value[1:] = 1_000_000_000 * occurs // (1000 * occurs + 20 * self.measure(sizes))
        level = self.levels(np.frombuffer(bitmaps, np.uint8).reshape(width, -1), width, len(sizes))
        weighted = value[level, np.arange(len(sizes))] * self.weights[:, None]
        return np.array([weighted[own].sum(axis=0) for own in self.has], np.int64).reshape(len(self.has), len(sizes))

    def scores(self, text: bytes, items: list[int]) -> list[int]:
        """The exact score of a text for some items (places in this batch)."""
        found = Counter(re.findall(rb"[^ ]+", text.translate(FOLD)))
        m, out = int(self.measure([found.total()])[0]) if found else 0, []
        for k in items:
            own = [(int(self.weights[t]), found.get(self.names[t].encode(), 0)) for t in self.has[k]]
            out.append(sum(w * (1_000_000_000 * tf // (1000 * tf + 20 * m)) for w, tf in own if tf))
        return out


CANDIDATE = "item int, id bigint, digest bigint, bound bigint"


def _bounded(index: DataFrame, batch: Batch, least: list[int] | None, most: int) -> DataFrame:
    """(item, id, digest, bound) of documents whose bound reaches `least` of the item; without it, the `most` greatest bounds of a task."""
    schema = pa.schema([("item", pa.int32()), ("id", pa.int64()), ("digest", pa.int64()), ("bound", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(__name__)
        reach = np.ones(len(batch.has), np.int64) if least is None else np.array(least)
        best: list[list[tuple]] = [[] for _ in batch.has]
        for part in batches:
            for block in part.to_pylist():
                bounds = batch.bounds(block["width"], block["sizes"], block["bitmaps"])
                item, at = np.nonzero(bounds >= np.maximum(reach, 1)[:, None])
                bound = bounds[item, at]
                if least is not None:
                    cells = [item.astype(np.int32), [block["ids"][k] for k in at], [block["digests"][k] for k in at], bound]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cells, schema)], schema=schema)
                    continue
                for k, a, x in zip(item.tolist(), at.tolist(), bound.tolist()):
                    best[k].append((x, block["ids"][a], block["digests"][a]))
                for k in set(item.tolist()):
                    if len(best[k]) > most:
                        best[k] = sorted(best[k], key=lambda c: -c[0])[:most]
                        reach[k] = best[k][-1][0]
        if least is None:
            rows = [{"item": k, "id": i, "digest": d, "bound": x} for k, own in enumerate(best) for x, i, d in own]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return index.select("width", "ids", "digests", "sizes", "bitmaps").mapInArrow(run, CANDIDATE)


def _rescored(docs: DataFrame, wanted: DataFrame, batch: Batch) -> DataFrame:
    """(item, id, score) of every row of the documents that is wanted(item, id, digest), from its whole text.

    Texts stay where they are but for those that a bit table of a fixed size lets through; these meet their items in a join.
    """
    each = wanted.groupBy(F.col("id").alias("__id"), F.col("digest").alias("__digest")).agg(F.collect_set("item").alias("items"))
    key = F.xxhash64(F.coalesce("id", F.lit(0)), "digest")
    some = sifted(docs, key, wanted.select(key.alias("key"))).where("__maybe")
    joined = some.join(each, F.col("id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest"))).select("id", "text", "items")
    schema = pa.schema([("item", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(__name__)
        for part in batches:
            rows = []
            for i, text, items in zip(*(part.column(c).to_pylist() for c in ("id", "text", "items"))):
                rows += [{"item": k, "id": i, "score": x} for k, x in zip(items, batch.scores((text or "").encode("utf-8", "replace"), items))]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return joined.mapInArrow(run, "item int, id bigint, score bigint").where("score > 0")


def _first(scored: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _batches(items: DataFrame, s: Scratch) -> tuple[DataFrame, int]:
    """(item_id, terms, bucket) of every item, written, and the number of batches, of about TERMS terms each."""
    terms = F.regexp_extract_all(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))
    each = items.select("item_id", terms.alias("t")).groupBy("item_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("t")))).alias("terms"))
    held = s.cut(each.withColumn("bucket", F.xxhash64("item_id")), "items")
    total = held.agg(F.sum(F.size("terms"))).first()[0] or 0
    return held, max(1, -(-total // TERMS))


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """The k best documents of every item: (item_id, rank, doc_id, score), scores above 0.

    Terms are the maximal runs of letters, digits and characters beyond ASCII, A-Z lower-cased. N documents hold a term, L is
    the number of all their terms, df of a term the number of documents that hold it, n a document's terms, tf occurrences. A
    term weighs w = floor(1000 ln((2 N + 2) / (2 df + 1))), m is 50 + (50 n N) div L, and a document scores the sum of
    w ((10^9 tf) div (1000 tf + 20 m)) over the item's distinct terms. Ties go to the smaller id.

    Null texts hold no terms; documents without an id rank behind all others of their score; repeated rows are documents of
    their own and take a rank each; rows of one item id are one item with the terms of all, a null item id among them; items
    without terms, and empty tables, give no rows; extra columns are ignored. Items come in batches of a bounded number of
    terms; the index is made once. df counts 64-bit hashes of terms; scores count the terms themselves.
    """
    spark = docs.sparkSession
    s = Scratch(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).withColumn("digest", F.xxhash64("text"))
    held, parts = _batches(items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")), s)
    index, every, out = None, [], None
    for part in range(parts):
        own = held.where(F.pmod("bucket", F.lit(parts)) == part).orderBy(F.asc_nulls_first("item_id")).collect()
        batch = Batch([(n, list(r["terms"])) for n, r in enumerate(own)])
        read = s.cut(read_documents(docs, batch.terms, index is None), "ranked-index")
        df = {r["pos"]: r["n"] for r in read.where("width = 0").select(F.posexplode("df").alias("pos", "x")).where("x > 0").groupBy("pos").agg(F.sum("x").alias("n")).collect()}
        if index is None:
            index = read.where("width > 0")
            sums = index.agg(F.sum(F.size("sizes")), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()
        batch.weigh(df, sums[0] or 0, sums[1] or 0)
        every.append(s.cut(_searched(docs, index, batch, k, s), "ranked"))
        names = spark.createDataFrame([(n, r["item_id"]) for n, r in enumerate(own)], f"item int, item_id {dict(held.dtypes)['item_id']}")
        found = every[-1].join(names, "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
        out = found if out is None else out.unionByName(found)
    s.keep_only(*every)
    return out


def _searched(docs: DataFrame, index: DataFrame, batch: Batch, k: int, s: Scratch) -> DataFrame:
    """(item, rank, id, score) of a batch."""
    best = _bounded(index, batch, None, 2 * k)
    w = Window.partitionBy("item").orderBy(F.desc("bound"), "id", "digest")
    best = s.cut(best.withColumn("n", F.row_number().over(w)).where(F.col("n") <= 2 * k).drop("n"), "ranked-best")
    reached = _first(_rescored(docs, best, batch), k).where(F.col("rank") == k).select("item", "score").collect()
    least = [1] * len(batch.has)
    for r in reached:
        least[r["item"]] = r["score"]
    wanted = s.cut(_bounded(index, batch, least, 0).distinct(), "ranked-candidates")
    s.drop(best)
    return _first(_rescored(docs, wanted, batch), k)

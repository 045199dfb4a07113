"""Near-duplicate embeddings by cross-polytope hashing after fast Hadamard rotations; buckets are worked through where they meet, and pairs verified there."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drayage.llm.common import Scratch, claim, components, ship, worker_cache

#: Rows that a bucket may have on average before another hash is joined to its name: comparing so many costs less than more tables.
FULL = 4096
#: Bytes of shuffled vectors that one pass may take whatever the table's size; beyond them a pass has one table.
PASS = 256_000_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row; the width is a power of two."""
    n, width = x.shape
    step = 1
    while step < width:
        y = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, width)
        step *= 2
    return x / np.sqrt(np.asarray(width, x.dtype))


def rotate(x: np.ndarray, seed: int) -> np.ndarray:
    """Three signed Hadamard rotations of every row."""
    signs = np.random.Generator(np.random.PCG64(seed)).integers(0, 2, (3, x.shape[1])) * 2 - 1
    for s in signs.astype(x.dtype):
        x = hadamard(x * s)
    return x


@worker_cache
def rotations(width: int, seeds: tuple[int, ...]) -> list[np.ndarray]:
    """The same rotations as matrices: for narrow vectors one product is faster than the transform's steps."""
    return [rotate(np.eye(width), seed).astype(np.float32) for seed in seeds]


def vertices(x: np.ndarray, seeds: tuple[int, ...]) -> Iterator[np.ndarray]:
    """For each seed the nearest vertex of the cross-polytope after that rotation: an axis, twice, plus one where the coordinate is negative."""
    narrow = rotations(x.shape[1], seeds) if x.shape[1] <= 256 else None
    for k, seed in enumerate(seeds):
        y = x @ narrow[k] if narrow else rotate(x, seed)
        axis = np.abs(y).argmax(axis=1)
        yield axis * 2 + (np.take_along_axis(y, axis[:, None], axis=1)[:, 0] < 0)


def buckets(x: np.ndarray, tables: int, hashed: int) -> np.ndarray:
    """A bucket number of each vector in every table, made of `hashed` joined hashes. Numbers beyond 32 bits wrap, which only joins buckets."""
    out = np.empty((len(x), tables), np.uint32)
    found = vertices(x, tuple(1000 * t + k for t in range(tables) for k in range(hashed)))
    for t in range(tables):
        code = np.zeros(len(x), np.uint64)
        for _ in range(hashed):
            code = code * np.uint64(2 * x.shape[1]) + next(found).astype(np.uint64)
        out[:, t] = code
    return out


def meeting(least: float, length: int, width: int) -> float:
    """The chance that two vectors at cosine `least` have one hash in common, from 32,000 drawn trials."""
    rng = np.random.Generator(np.random.PCG64(7))
    a, o = rng.normal(size=(2, 4000, length))
    a /= np.sqrt((a**2).sum(axis=1, keepdims=True))
    o -= (o * a).sum(axis=1, keepdims=True) * a
    o /= np.maximum(np.sqrt((o**2).sum(axis=1, keepdims=True)), 1e-300)
    b = least * a + math.sqrt(max(0.0, 1 - least * least)) * o
    pair = np.zeros((8000, width), np.float32)
    pair[:4000, :length], pair[4000:, :length] = a, b
    return float(np.mean([(v[:4000] == v[4000:]).mean() for v in vertices(pair, tuple(range(1_000_000, 1_000_008)))]))


def unit(v: np.ndarray) -> np.ndarray:
    """Rows in double precision, of length one."""
    out = v.astype(np.float64)
    out /= np.abs(out).max(axis=1, keepdims=True)
    return out / np.sqrt((out**2).sum(axis=1, keepdims=True))


def nearly_unit(v: np.ndarray) -> np.ndarray:
    """The same in single precision, in a tenth of the time: for what is looked at again near the bound."""
    out = (v / np.abs(v).max(axis=1, keepdims=True)).astype(np.float32)
    out /= np.sqrt(np.einsum("ij,ij->i", out, out))[:, None]
    return out


def wider(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def ragged(flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Stretches of `flat` as rows of one array; what is shorter ends in zeros."""
    if len(length) and (length == length[0]).all():
        if (begin == begin[0] + np.arange(len(begin)) * length[0]).all():
            return flat[begin[0] : begin[0] + length.sum()].reshape(len(begin), -1)
        return flat[begin[:, None] + np.arange(length[0])]
    out = np.zeros((len(length), max(length, default=0)), flat.dtype)
    for k, (b, n) in enumerate(zip(begin, length, strict=True)):
        out[k, :n] = flat[b : b + n]
    return out


def binary_rows(a: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A binary column without nulls as rows of bytes, and their lengths."""
    at = np.frombuffer(a.buffers()[1], np.int32)[a.offset : a.offset + len(a) + 1].astype(np.int64)
    return ragged(np.frombuffer(a.buffers()[2], np.uint8), at[:-1], np.diff(at)), np.diff(at)


def to_binary(rows: np.ndarray, length: np.ndarray) -> pa.Array:
    """The first `length` bytes of each row as a binary column."""
    if not (length == rows.shape[1]).all():
        return pa.array([r[:n].tobytes() for r, n in zip(rows, length, strict=True)], pa.binary())
    at = (np.arange(len(rows) + 1) * rows.shape[1]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(rows))])


class Layout:
    """An item: 8 bytes that stand for the label, the bucket number in each table, and the vector as it came."""

    def __init__(self, kind: str, width: int, tables: int, hashed: int):
        self.kind, self.width, self.tables, self.hashed = np.dtype(kind), width, tables, hashed
        self.code = np.dtype(np.uint16 if (2 * width) ** hashed <= 1 << 16 else np.uint32)
        self.head = 8 + tables * self.code.itemsize

    def pack(self, batch: pa.RecordBatch, items: bool) -> pa.RecordBatch:
        """(vec_id, v, lab) to (vec_id, node) and, if asked for, item. node: 128-bit digest of label and vector; both are null for rows that link with nothing."""
        ids, v, lab = batch.columns
        length = pc.fill_null(pc.list_value_length(v), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = pc.fill_null(v.flatten(), math.nan).to_numpy(zero_copy_only=False).astype(self.kind) + self.kind.type(0)  # no negative zero
        end = np.cumsum(length)
        count = lambda flags: (c := np.concatenate([[0], np.cumsum(flags)]))[end] - c[end - length]
        good = np.flatnonzero((count(~np.isfinite(flat)) == 0) & (count(flat != 0) > 0) & lab.is_valid().to_numpy(zero_copy_only=False))
        rows, length = ragged(flat, (end - length)[good], length[good]), length[good] * self.kind.itemsize
        names = [hashlib.blake2b(x.tobytes() + r[:n].tobytes(), digest_size=16).digest() for x, r, n in zip(pc.fill_null(lab, 0).to_numpy()[good], rows.view(np.uint8), length, strict=True)]
        place = np.full(len(ids), -1)
        place[good] = np.arange(len(good))
        place = pa.array(place, mask=place < 0)
        out = {"vec_id": ids, "node": pa.array(names, pa.binary()).take(place)}
        if items:
            codes = buckets(wider(unit(rows).astype(np.float32), self.width), self.tables, self.hashed).astype(self.code)
            whole = np.hstack([np.ascontiguousarray(x).view(np.uint8).reshape(len(rows), -1) for x in (pc.fill_null(lab, 0).to_numpy()[good], codes, rows)])
            out["item"] = to_binary(whole, self.head + length).take(place)
        return pa.RecordBatch.from_pydict(out)

    def lab(self) -> Column:
        return F.substring("item", 1, 8)

    def bucket(self, t: int) -> Column:
        """One long for label, table and bucket number."""
        n = self.code.itemsize
        return F.xxhash64(F.lit(t), self.lab(), F.substring("item", 9 + t * n, n))

    def unpack(self, items: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Label, bucket numbers (one row for each table) and vectors."""
        rows, _ = binary_rows(items)
        part = lambda a, b, kind: np.ascontiguousarray(rows[:, a:b]).view(kind)
        return part(0, 8, np.int64)[:, 0], np.ascontiguousarray(part(8, self.head, self.code).T), part(self.head, None, self.kind)

    def links(self, batch: pa.RecordBatch | pa.Table, least: float) -> pa.RecordBatch | None:
        """Of rows in order of `place`, buckets whole: (node, other, near) of the nodes with a link that no earlier table has.

        near counts the rows of such links; other is a node that these links reach, one for all that they connect.
        """
        place = batch.column("place").to_numpy()
        begin = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        size = np.diff(np.append(begin, len(place)))
        if (size < 2).all():
            return None
        together = np.repeat(size > 1, size)
        batch, size = batch.filter(pa.array(together)), size[size > 1]
        place, t, side, copies = (batch.column(c).to_numpy() for c in ("place", "t", "side", "size"))
        node, item = (pa.concat_arrays(batch.column(c).chunks) if isinstance(batch, pa.Table) else batch.column(c) for c in ("node", "item"))
        lab, codes, raw = self.unpack(item)
        end, own = np.repeat(np.cumsum(size), size), codes[t, np.arange(len(t))]
        # what of a bucket may differ though its 64-bit names agree, and cells of two parts
        mixed = (place[1:] == place[:-1]) & ((t[1:] != t[:-1]) | (lab[1:] != lab[:-1]) | (own[1:] != own[:-1]))
        exact = [x for x in (t, lab, own) if mixed.any()]
        x, slack = nearly_unit(raw), np.float32(1e-5 + 2e-7 * raw.shape[1])
        near, root, several = np.zeros(len(place), np.int64), np.arange(len(place)), copies.max() > 1
        done = 0
        while done < len(place):
            a, done = done, min(len(place), done + 256)
            done = min(done, a + max(16, 4_000_000 // (end[done - 1] - a)))
            cosine = x[a:done] @ x[a : end[done - 1]].T
            i, j = (k + a for k in np.divmod(np.flatnonzero(cosine >= least - slack), cosine.shape[1]))
            keep = (j > i) & (j < end[i])
            for y in exact:
                keep &= y[i] == y[j]
            if side.any():
                keep &= (side[i] == 0) | (side[i] != side[j])
            i, j = i[keep], j[keep]
            for u in range(t.max()):  # a pair counts in the first table where it meets
                keep = codes[u][i] != codes[u][j]
                if u >= t.min():
                    keep |= t[i] <= u
                i, j = i[keep], j[keep]
            far = np.flatnonzero(cosine[i - a, j - a] < least + slack)
            far = far[(unit(wider(raw[i[far]], self.width)) * unit(wider(raw[j[far]], self.width))).sum(axis=1) < least] if len(far) else far
            i, j = (np.delete(k, far) if len(far) else k for k in (i, j))
            for p, q in ((i, j), (j, i)):
                near += np.bincount(p, weights=copies[q] if several else None, minlength=len(near)).astype(np.int64)
            root = joined(root, i, j)
        some = np.flatnonzero(near)
        return pa.RecordBatch.from_arrays([node.take(pa.array(some)), node.take(pa.array(root[some])), pa.array(near[some])], names=["node", "other", "near"]) if len(some) else None


def joined(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The root of each row, its set's least row, once the sets of i and j are one."""
    while len(i):
        p, q = root[i], root[j]
        apart = p != q
        if not apart.any():
            break
        i, j, p, q = i[apart], j[apart], p[apart], q[apart]
        root[np.maximum(p, q)] = np.minimum(p, q)  # of several the last one; the others come again
        while (root != (further := root[root])).any():
            root = further
    return root


def whole_runs(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches in order of `place`, put together to about `rows` rows and cut where place changes."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        n += len(batch)
        if n >= rows:
            place = batch.column("place").to_numpy()
            other = np.flatnonzero(place != place[-1])
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut or len(held) > 1 and held[-2].column("place")[-1].as_py() != place[-1]:
                yield pa.Table.from_batches([*held[:-1], batch.slice(0, cut)])
                held, n = [batch.slice(cut)], len(batch) - cut
    if held:
        yield pa.Table.from_batches(held)


def link_embeddings(
    rows: DataFrame, least: float = 0.98, tables: int | None = None, hashed: int | None = None, miss: float = 1e-8, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept): links are pairs of one label whose cosine in double precision is `least` or more.

    Equal vectors of a label are one node, told apart by 128-bit digests. A node enters one bucket in each table, named by one hash or, for
    larger labels, up to three; there are as many tables as make the chance of missing a pair at exactly `least` smaller than `miss`. The
    tables are shuffled a few at a time, so disk is a multiple of the input and not of the tables. A task compares the vectors of a bucket
    and writes a row for each node with links: their count, each pair in the first table where it meets, and a node that they reach. So
    what is written grows with the vectors and not with the pairs of a dense group. A bucket that would fill a task is cut into cells.

    n_links counts other vectors linked directly, copies too; component_id is the smallest id that links reach, kept whether that is the
    row's own. Vectors that are null, zero, or hold a null or non-finite component, and rows without a label, link with nothing. A row
    without an id has a null component and is not kept; repeated rows link with one another; vectors of different lengths are compared as
    if the shorter ended in zeros; an empty table gives no rows; extra columns are ignored.
    """
    kind = "float" if dict(rows.select(F.col(vector_col).alias("v")).dtypes)["v"] == "array<float>" else "double"
    lab = F.when(F.col(label_col).isNotNull(), F.xxhash64(F.lit(5), F.col(label_col)))
    v = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(f"array<{kind}>").alias("v"), lab.alias("lab"))
    spark = rows.sparkSession
    ship(spark)
    s = Scratch(spark)
    each_label = v.where("lab IS NOT NULL AND v IS NOT NULL").groupBy("lab").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("longest"))
    most, longest = each_label.agg(F.coalesce(F.max("n"), F.lit(0)), F.greatest(F.max("longest"), F.lit(1))).first()
    width = 1 << max(1, (longest - 1).bit_length())
    hashed = hashed or next((k for k in (1, 2) if most <= FULL * (2 * width) ** k), 3)
    tables = tables or max(1, math.ceil(math.log(miss) / math.log(max(1e-12, 1 - meeting(least, longest, width) ** hashed))))
    of, owner = Layout("f4" if kind == "float" else "f8", width, tables, hashed), __name__

    def packs(items: bool):
        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            claim(owner)
            step = max(1, (1 << 21) // width)
            for batch in batches:
                for k in range(0, len(batch), step):
                    yield of.pack(batch.slice(k, step), items)

        return v.mapInArrow(pack, "vec_id long, node binary" + ", item binary" * items)

    nodes = packs(True).where("node IS NOT NULL").groupBy("node").agg(F.first("item").alias("item"), F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("id"))
    nodes = s.cut(nodes, "vector-nodes")

    n = nodes.count()
    at_once = min(tables, max(1, int(PASS // max(1, n * (80 + of.head + longest * of.kind.itemsize)))))
    wide = _wide(nodes, of, n, at_once, s)
    met = [s.cut(_links(nodes, of, range(t, min(tables, t + at_once)), wide, least), "vector-links") for t in range(0, tables, at_once)]
    links = reduce(DataFrame.union, met)
    degree = links.groupBy("node").agg(F.sum("near").alias("near"))
    labels = components(links.select(F.col("node").alias("a"), F.col("other").alias("b")), s)
    smallest = labels.join(nodes.select("node", "id"), "node").groupBy("component").agg(F.min("id").alias("smallest"))
    smallest = labels.join(s.cut(smallest, "component-ids"), "component").select("node", "smallest")
    info = nodes.select("node", "id", "size").join(degree, "node", "left").join(smallest, "node", "left")
    info = s.cut(info.select("node", (F.col("size") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"), F.coalesce("smallest", "id").alias("smallest")), "vector-info")
    s.keep_only(info)
    out = packs(False).join(info, "node", "left")
    own = F.when(F.col("vec_id").isNotNull(), F.coalesce("smallest", "vec_id"))
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"))
    out = s.cut(out, "vector-components")
    s.keep_only(out)
    return out


def _wide(nodes: DataFrame, of: Layout, n: int, at_once: int, s: Scratch) -> DataFrame | None:
    """(place, parts) of the buckets with more rows than two tasks have on average; half as many as a pass has tasks, at most.

    Of buckets of several hashes a sixteenth of the nodes is counted, by digest: it decides how rows are dealt, never a result.
    """
    share = 1 if of.hashed == 1 or n * of.tables < 5_000_000 else 16
    mean = n * at_once // int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = nodes if share == 1 else nodes.where(F.col("node") < F.lit(bytes([256 // share])))
    counted = counted.select(F.explode(F.array(*(of.bucket(t) for t in range(of.tables)))).alias("place")).groupBy("place").agg((F.count(F.lit(1)) * share).alias("n"))
    wide = s.cut(counted.where(F.col("n") > max(256, 2 * mean)).select("place", F.ceil(F.col("n") / max(128, mean)).cast("int").alias("parts")), "wide-buckets")
    return None if wide.isEmpty() else wide


def _links(nodes: DataFrame, of: Layout, tables: range, wide: DataFrame | None, least: float) -> DataFrame:
    """(node, other, near) of the links that `tables` add to those of earlier ones.

    The rows of a wide bucket have a part each and go to the cells of theirs and every part; a cell of two parts compares one with the other.
    """
    entries = F.array(*(F.struct(F.lit(t).alias("t"), of.bucket(t).alias("place")) for t in tables))
    met = nodes.select("node", "size", "item", F.explode(entries).alias("e")).select("node", "size", "item", "e.t", "e.place")
    # the first row of a set stands for it: in this order components() hooks nodes in its first round
    order = F.xxhash64(F.lit(0), "node")
    if wide is None:
        met = met.withColumn("side", F.lit(0))
    else:
        met = met.join(F.broadcast(wide), "place", "left").withColumn("part", F.expr("pmod(xxhash64(97, node), parts)"))
        one = F.expr("array(named_struct('cell', place, 'side', 0))")
        cells = F.expr("transform(sequence(0, parts - 1), p -> named_struct('cell', xxhash64(place, least(p, part), greatest(p, part)), 'side', if(p = part, 0, if(p > part, 1, 2))))")
        met = met.withColumn("c", F.explode(F.when(F.col("parts").isNull(), one).otherwise(cells))).select("node", "size", "item", "t", F.col("c.cell").alias("place"), F.col("c.side").alias("side"))
    held, owner = max(64, min(4096, (1 << 21) // of.width)), __name__

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(owner)
        for run in whole_runs(batches, held):
            if (found := of.links(run, least)) is not None:
                yield found

    return met.repartition("place").sortWithinPartitions("place", order).mapInArrow(compare, "node binary, other binary, near long")

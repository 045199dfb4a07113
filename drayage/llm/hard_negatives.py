"""Hard negatives by slot-decomposed selection. An anchor's positives set upper limits, which split scores into disjoint slots; the
best negatives of each slot are kept, within a task first and then over all, and descending suffix merges of the slots answer
the windows of all positives, which overlap.

Anchors and rows meet in cells: each side is cut into parts of a bounded number of rows by a hash of the id, and a cell is one
part of either. A cell fits a task, whatever the number of rows, labels or copies.
"""

from __future__ import annotations

from math import gcd

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from drayage.llm.common import Scratch, ship

#: Rows of one side of a cell, about, and anchors that are scored at once.
CELL, AT_ONCE = 16_384, 256
#: Components of floor(scale * x) stay below this, so that sums of products of 2 ** 13 components fit 64 bits.
LARGEST = 2.0**25


def usable_rows(rows: DataFrame, label: Column, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, label, q array<long>), each once: floor(scale * x) of each component. Rows with a null id, label or vector, or with a null
    or non-finite component, are left out; a finite component beyond LARGEST / scale raises, as its scores would not fit."""
    v = rows.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    v = v.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    v = v.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    too_large = F.raise_error(F.lit(f"a vector has a component beyond {LARGEST / scale}")).cast("long")
    whole = lambda x: F.when(F.abs(x * scale) < LARGEST, F.floor(x * scale)).otherwise(too_large)
    return v.select("vec_id", "label", F.transform("v", whole).alias("q")).distinct()


def _matrix(vectors: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; the shorter end in zeros."""
    held = vectors.combine_chunks()
    sizes, values = held.value_lengths().to_numpy(zero_copy_only=False), held.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = values
    return out


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of a with all of b; in floating point where that is exact."""
    if np.abs(a).max(initial=0) * float(np.abs(b).max(initial=0)) * a.shape[1] < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _first(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each group, by score from the greatest, then by id."""
    order = np.lexsort((ids, -score, group))
    g = group[order]
    begin = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    return order[np.arange(len(g)) - np.repeat(begin, np.diff(np.r_[begin, len(g)])) < k]


def _cells(anchors: DataFrame, rows: DataFrame, pick, made: str) -> DataFrame:
    """What `pick` makes of the anchors and rows of each cell: the inner products of AT_ONCE anchors with the rows at a time."""
    ship(rows.sparkSession)
    parts = [max(1, -(-side.count() // CELL)) for side in (anchors, rows)]
    part = lambda n, seed: F.pmod(F.xxhash64(F.lit(seed), "vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = anchors.withColumns({"a": part(parts[0], 1), "b": every(parts[1])})
    r = rows.withColumns({"b": part(parts[1], 2), "a": every(parts[0])})

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            width = max(pc.max(pc.list_value_length(t["q"])).as_py() for t in (left, right))
            x, y = _matrix(left["q"], width), _matrix(right["q"], width)
            for at in range(0, len(x), AT_ONCE):
                found.append(pick(left.slice(at, AT_ONCE), right, _products(x[at : at + AT_ONCE], y)))
        return pa.concat_tables(found).cast(target) if found else target.empty_table()

    target = pa.schema([(name, pa.int64() if kind == "long" else pa.int32()) for name, kind in (c.split() for c in made.split(", "))])
    return a.groupBy("a", "b").cogroup(r.groupBy("a", "b")).applyInArrow(run, made)


def _keep(df: DataFrame, group: list[str], k: int, out: str) -> DataFrame:
    """The first k of each group, numbered from 1; Spark keeps k a group in each task before the shuffle."""
    w = Window.partitionBy(*group).orderBy(F.desc("score"), "vec_id")
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= k)


def positives_of(anchors: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(anchor_id, vec_id, score): the first k other rows of each anchor's label."""

    def pick(left: pa.Table, right: pa.Table, scores: np.ndarray) -> pa.Table:
        mine, other = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
        ok = (left["label"].to_numpy()[:, None] == right["label"].to_numpy()) & (mine[:, None] != other)
        row, col = np.nonzero(ok)
        best = _first(row, scores[row, col], other[col], k)
        return pa.table({"anchor_id": mine[row[best]], "vec_id": other[col[best]], "score": scores[row[best], col[best]]})

    return _keep(_cells(anchors, rows, pick, "anchor_id long, vec_id long, score long"), ["anchor_id"], k, "place").drop("place")


def slot_candidates(anchors: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(anchor_id, slot, vec_id, score): the first k rows of other labels in each slot of each anchor.

    anchors have `limits`, upper limits from the greatest down, and `floor`, the least score of any window. Slot n holds the
    scores at or below limit n and above limit n + 1.
    """

    def pick(left: pa.Table, right: pa.Table, scores: np.ndarray) -> pa.Table:
        mine, other = left["vec_id"].to_numpy(), right["vec_id"].to_numpy()
        held = left["limits"].to_pylist()
        ok = (left["label"].to_numpy()[:, None] != right["label"].to_numpy()) & (mine[:, None] != other)
        ok &= (scores <= np.array([u[0] for u in held])[:, None]) & (scores >= left["floor"].to_numpy()[:, None])
        row, col = np.nonzero(ok)
        score, most = scores[row, col], max(map(len, held))
        slot = np.full(len(row), -1)
        for n in range(most):
            limit = np.array([u[n] if n < len(u) else np.iinfo(np.int64).min for u in held])
            slot += score <= limit[row]
        best = _first(row * most + slot, score, other[col], k)
        return pa.table({"anchor_id": mine[row[best]], "slot": slot[best], "vec_id": other[col[best]], "score": score[best]})

    return _keep(_cells(anchors, rows, pick, "anchor_id long, slot int, vec_id long, score long"), ["anchor_id", "slot"], k, "place").drop("place")


def least_score(limit: str, share: tuple[int, int]) -> Column:
    """The least whole score with share[0] * limit <= share[1] * score, for a limit from 0; no product outgrows 64 bits."""
    p, q = (x // gcd(*share) for x in share)
    return F.expr(f"{p} * ({limit} div {q}) + ({p} * ({limit} % {q}) + {q - 1}) div {q}")


def mine(
    rows: DataFrame, every: int = 100, positives: int = 5, k: int = 5, share: tuple[int, int] = (80, 100), label: Column | None = None, scale: int = 256,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Hard negatives of every anchor and positive: (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are rows whose id is divisible by `every`, their positives the first `positives` other rows of the same label, and
    a positive's negatives the first k rows of other labels whose score is at most the positive's and at least share[0] /
    share[1] of it; a positive of negative score has none. First is by inner product of floor(scale * x), then by smaller id.

    Rows with a null id, label or vector, or a null or non-finite component, take no part; rows that agree in id, label and
    vector count once; of an id with several labels or vectors the least is the anchor, and rows of the anchor's own id are
    neither positives nor negatives; vectors of different lengths end in zeros; an empty table, or an anchor without
    positives, gives no rows; extra columns are ignored. Labels are whole numbers.
    """
    s = Scratch(rows.sparkSession)
    v = s.cut(usable_rows(rows, F.col(label_col) if label is None else label, scale, id_col, vector_col), "negatives-rows")
    anchors = v.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("x")).select("vec_id", "x.*")
    anchors = s.cut(anchors, "negatives-anchors")
    found = s.cut(positives_of(anchors, v, positives), "negatives-positives")
    # a window reaches from the limit down to a share of it, so it is empty below zero
    limits = found.where("score >= 0").groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_set("score"), asc=False).alias("limits"))
    limits = limits.withColumn("floor", least_score("element_at(limits, -1)", share))
    kept = slot_candidates(anchors.join(limits, "vec_id"), v, k)
    entry = F.struct((-F.col("score")).alias("down"), "vec_id")
    lists = kept.groupBy("anchor_id").pivot("slot", list(range(positives))).agg(F.sort_array(F.collect_list(entry)))
    # from the last slot up: what a slot and all below it hold, the first k of it
    merged, none = {}, F.array().cast("array<struct<down:bigint,vec_id:bigint>>")
    for n in reversed(range(positives)):
        merged[n] = F.slice(F.concat(F.coalesce(F.col(f"`{n}`"), none), merged.get(n + 1, none)), 1, k)
    lists = lists.select("anchor_id", F.array(*[merged[n] for n in range(positives)]).alias("merged"))
    out = found.join(limits.select(F.col("vec_id").alias("anchor_id"), "limits"), "anchor_id").join(lists, "anchor_id").where("score >= 0")
    out = out.withColumn("least", least_score("score", share))
    answer = F.expr("filter(merged[array_position(limits, score) - 1], x -> -x.down >= least)")
    out = out.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.posexplode(answer).alias("rank", "x"))
    out = out.select("anchor_id", "positive_id", (F.col("rank") + 1).alias("rank"), F.col("x.vec_id").alias("negative_id"), "positive_score", (-F.col("x.down")).alias("negative_score"))
    out = s.cut(out, "negatives")
    s.keep_only(out)
    return out

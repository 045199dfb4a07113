"""Exact top-k by inner product over an M-tree: two levels of routing vectors, paged nodes, covering radii, stored distances.

The routing vectors are a bounded sample. Some of them are the upper level; the others are nodes, each with its distance to its
parent. A node's vectors lie in pages, in order of their distance to the node's routing vector, with that distance and their
norm stored. A vector x at distance d from p, seen from a query q, scores at most q.p + |q| d, and, as |q - x| is at least the
difference of their distances to p, at most (|q|^2 + |x|^2 - that^2) / 2. The lesser of the two bounds an upper node, a node, a
page or a vector. Each query first visits its best node, whose answers give the score to beat, then whatever still reaches it,
best pages first, and the score to beat rises as it goes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from drayage.llm.common import Scratch, ship

PAGE = 256
PACKET = 256
#: Components of floor(scale * x) must stay below this, so that inner products of up to 2 ** 13 components are exact.
LARGEST = 2.0**25


def whole_vectors(rows: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, q array<long>): floor(scale * x) of each component; vectors that are null or hold a null or non-finite one are left out.

    A finite component beyond LARGEST / scale raises: its scores would not fit.
    """
    v = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    too_large = F.raise_error(F.lit(f"a vector has a component beyond {LARGEST / scale}")).cast("long")
    whole = lambda x: F.when(F.abs(x * scale) < LARGEST, F.floor(x * scale)).otherwise(too_large)
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.where("v IS NOT NULL AND vec_id IS NOT NULL").where(~F.coalesce(bad, F.lit(True))).select("vec_id", F.transform("v", whole).alias("q"))


def _rows(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for k, v in enumerate(vectors):
        out[k, : min(len(v), width)] = v[:width]
    return out


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of a with all of b; in floating point where that is exact."""
    if np.abs(a).max(initial=0) * float(np.abs(b).max(initial=0)) * a.shape[1] < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _distance(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    a, b = x.astype(np.float64), p.astype(np.float64)
    square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def _above(bound: np.ndarray) -> np.ndarray:
    """A bound with room for rounding."""
    return bound + np.abs(bound) * 1e-9 + 1e-3


def _bound(center: np.ndarray, size: np.ndarray, reach: np.ndarray, near, far, norm) -> np.ndarray:
    """The most that vectors score whose distance to p is in near..far and whose squared norm is norm at most.

    center: q.p, size: |q|, reach: |q - p| of each query; the last three broadcast against them.
    """
    gap = np.maximum(np.maximum(reach - far, near - reach), 0)
    gap = np.maximum(gap * (1 - 1e-9) - 1e-6, 0)
    return _above(np.minimum(center + size * far, (size**2 + norm - gap**2) / 2))


class Routing:
    """The upper levels of the tree, on the driver and in every task: a bounded number of vectors."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.radius, self.norm = np.zeros(len(vectors)), np.zeros(len(vectors))
        self.top = np.arange(min(len(vectors), int(np.sqrt(len(vectors))) + 1))
        far = _distance(vectors, vectors[self.top]) if len(vectors) else np.zeros((0, 0))
        self.parent = far.argmin(axis=1) if len(vectors) else np.zeros(0, int)
        self.far = far[np.arange(len(vectors)), self.parent] if len(vectors) else np.zeros(0)

    def may_reach(self, q: np.ndarray, beat: np.ndarray) -> tuple[np.ndarray, int]:
        """(query x node: whether the node may hold a score of `beat` or more, inner products worked out)."""
        go = np.zeros((len(q), len(self.vectors)), bool)
        size, done = np.sqrt((q.astype(np.float64) ** 2).sum(1)), 0
        for t in range(len(self.top)):
            mine = np.flatnonzero(self.parent == t)
            p = self.vectors[self.top[t] : self.top[t] + 1]
            center, reach = _dot(q, p)[:, 0], _distance(q, p)[:, 0]
            done += len(q)
            # by the stored distance to the parent: no distance to the node is worked out where this rules it out
            lo, hi = np.maximum(self.far[mine] - self.radius[mine], 0), self.far[mine] + self.radius[mine]
            open_ = _bound(center[:, None], size[:, None], reach[:, None], lo[None, :], hi[None, :], self.norm[mine][None, :]) >= beat[:, None]
            for k, m in enumerate(mine.tolist()):
                some = np.flatnonzero(open_[:, k])
                if len(some):
                    v = self.vectors[m : m + 1]
                    c, r = _dot(q[some], v)[:, 0], _distance(q[some], v)[:, 0]
                    done += len(some)
                    go[some, m] = _bound(c, size[some], r, 0.0, self.radius[m], self.norm[m]) >= beat[some]
        return go, done


def build(vectors: DataFrame, keep: int, nodes: int = 256, scratch: Scratch | None = None) -> tuple[Routing, DataFrame]:
    """(routing levels, pages) of the tree over distinct vectors, each with its `keep` smallest distinct ids.

    Routing vectors are the `nodes` distinct vectors of least hash, a bounded sample that decides shape, never results.
    Pages hold PAGE vectors at most; they are cut from rows in range order of (node, distance), so a node with most vectors
    is many pages in many tasks.
    """
    s = scratch or Scratch(vectors.sparkSession)
    least = Window.partitionBy("q").orderBy("vec_id")
    distinct = vectors.distinct().withColumn("n", F.row_number().over(least)).where(F.col("n") <= keep).groupBy("q").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    distinct = s.cut(distinct, "tree-vectors")
    width = distinct.agg(F.max(F.size("q"))).first()[0] or 0
    picked = distinct.select("q", F.xxhash64("q").alias("h")).orderBy("h", "q").limit(nodes).collect()
    routing = Routing(_rows([r["q"] for r in picked], width))
    points = routing.vectors

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            x = _rows(f["q"], width)
            d = _distance(x, points)
            node = d.argmin(axis=1)
            yield f.assign(node=node, far=d[np.arange(len(f)), node], norm=(x.astype(np.float64) ** 2).sum(1))

    placed = s.cut(distinct.mapInPandas(place, "q array<long>, ids array<long>, node long, far double, norm double"), "tree-placed")
    s.drop(distinct)
    for r in placed.groupBy("node").agg(F.max("far").alias("r"), F.max("norm").alias("n")).collect():
        routing.radius[r["node"]], routing.norm[r["node"]] = r["r"], r["n"]

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def page(part: pd.DataFrame) -> dict:
            ids = np.full((len(part), keep), -1, np.int64)
            for k, x in enumerate(part["ids"]):
                ids[k, : len(x)] = x
            count = np.array([len(x) for x in part["ids"]], np.int64)
            shape = {"node": part["node"].iloc[0], "page_near": part["far"].min(), "page_far": part["far"].max(), "page_norm": part["norm"].max()}
            arrays = {"vectors": _rows(part["q"], width), "far": part["far"].to_numpy(np.float64), "norm": part["norm"].to_numpy(np.float64), "ids": ids, "count": count}
            return shape | {k: v.tobytes() for k, v in arrays.items()}

        rest = None
        for f in frames:
            f = f if rest is None else pd.concat([rest, f], ignore_index=True)
            groups = [g for _, g in f.groupby("node", sort=True)]
            out = []
            for g in groups[:-1]:
                out += [page(g.iloc[k : k + PAGE]) for k in range(0, len(g), PAGE)]
            last = groups[-1]
            whole = len(last) // PAGE * PAGE
            out += [page(last.iloc[k : k + PAGE]) for k in range(0, whole, PAGE)]
            rest = last.iloc[whole:] if whole < len(last) else None
            if out:
                yield pd.DataFrame(out)
        if rest is not None:
            yield pd.DataFrame([page(rest)])

    ordered = placed.repartitionByRange("node", "far").sortWithinPartitions("node", "far")
    pages = ordered.mapInPandas(pack, "node long, page_near double, page_far double, page_norm double, vectors binary, far binary, norm binary, ids binary, count binary")
    pages = s.cut(pages, "tree-pages")
    s.drop(placed)
    return routing, pages


def _visits(queries: DataFrame, routing: Routing, first: bool) -> DataFrame:
    """Packets of queries for the nodes they visit: the node of the nearest routing vector first, then all others that may reach `beat`."""
    width = routing.vectors.shape[1]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            q = _rows(f["q"], width)
            beat = f["beat"].to_numpy(np.float64)
            best = _distance(q, routing.vectors).argmin(axis=1)
            if first:
                go = np.zeros((len(q), len(routing.vectors)), bool)
                go[np.arange(len(f)), best] = True
            else:
                go, _ = routing.may_reach(q, beat)
                go[np.arange(len(f)), best] = False
            size = np.sqrt((q.astype(np.float64) ** 2).sum(1))
            for node in np.flatnonzero(go.any(axis=0)).tolist():
                p, ks = routing.vectors[node : node + 1], np.flatnonzero(go[:, node])
                center, reach = _dot(q[ks], p)[:, 0], _distance(q[ks], p)[:, 0]
                # queries at a similar distance travel together, so what holds for all of a packet is close to what holds for each
                order = np.argsort(reach, kind="stable")
                for a in range(0, len(ks), PACKET):
                    at = order[a : a + PACKET]
                    some = ks[at]
                    bytes_of = {"query_ids": f["vec_id"].to_numpy(np.int64)[some], "queries": q[some], "beat": beat[some]}
                    spans = {"center": center[at].max(), "size": size[some].max(), "reach_low": reach[at].min(), "reach_high": reach[at].max(), "beat_low": beat[some].min()}
                    yield pd.DataFrame({"node": [node]} | {k: [x.tobytes()] for k, x in bytes_of.items()} | {k: [float(x)] for k, x in spans.items()})

    return queries.mapInPandas(run, "node long, query_ids binary, queries binary, beat binary, center double, size double, reach_low double, reach_high double, beat_low double")


def _page_may_reach() -> F.Column:
    """Whether a page may hold a score that any query of a packet needs: _bound for the packet's spans, before either goes to Python."""
    gap = F.greatest(F.col("reach_low") - F.col("page_far"), F.col("page_near") - F.col("reach_high"), F.lit(0.0))
    gap = F.greatest(gap * (1 - 1e-9) - 1e-6, F.lit(0.0))
    most = F.least(F.col("center") + F.col("size") * F.col("page_far"), (F.col("size") * F.col("size") + F.col("page_norm") - gap * gap) / 2)
    return most + F.abs(most) * 1e-8 + 2e-3 >= F.col("beat_low")


def best_of_page(qid: np.ndarray, q: np.ndarray, beat: np.ndarray, p: np.ndarray, page, k: int, keep: int) -> tuple[dict[int, list[tuple[int, int]]], int]:
    """({query: what of a page may be among its k best, as (-score, id)}, inner products worked out with the page's vectors)."""
    size = np.sqrt((q.astype(np.float64) ** 2).sum(1))
    center, reach = _dot(q, p[None, :])[:, 0], _distance(q, p[None, :])[:, 0]
    may = _bound(center, size, reach, page.page_near, page.page_far, page.page_norm) >= beat
    if not may.any():
        return {}, 0
    qid, q, beat, size, center, reach = qid[may], q[may], beat[may], size[may], center[may], reach[may]
    far, norm, x = np.frombuffer(page.far, np.float64), np.frombuffer(page.norm, np.float64), np.frombuffer(page.vectors, np.int64).reshape(-1, len(p))
    ids, count = np.frombuffer(page.ids, np.int64).reshape(-1, keep), np.frombuffer(page.count, np.int64)
    # entries by stored distance: nothing below the least score that any of these queries still needs
    near = _bound(center[:, None], size[:, None], reach[:, None], far[None, :], far[None, :], norm[None, :]) >= beat[:, None]
    some = np.flatnonzero(near.any(axis=0))
    if not len(some):
        return {}, 0
    score, out = _dot(q, x[some]), {}
    for n in range(len(qid)):
        hit = np.flatnonzero(near[n, some] & (score[n] >= beat[n]))
        new, last = set(), None
        # best first, until k distinct answers are there and the score falls: an id may repeat among the vectors
        for h in hit[np.argsort(-score[n, hit], kind="stable")].tolist():
            s = -int(score[n, h])
            if len(new) >= k and s != last:
                break
            last = s
            new.update((s, int(v)) for v in ids[some[h], : count[some[h]]] if v != qid[n])
        if new:
            out[int(qid[n])] = sorted(new)
    return out, len(some) * len(q)


def _search(visits: DataFrame, pages: DataFrame, routing: Routing, k: int, keep: int) -> DataFrame:
    """(query_id, vec_id, score): of each task's pages and packets, whatever may be among the k best; the score to beat rises in it."""
    width = routing.vectors.shape[1]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out: dict[int, list[tuple[int, int]]] = {}
            reached: dict[int, float] = {}
            found, packets = [], []
            for r in f.itertuples(index=False):
                qid, q, beat = np.frombuffer(r.query_ids, np.int64), np.frombuffer(r.queries, np.int64).reshape(-1, width), np.frombuffer(r.beat, np.float64)
                p = routing.vectors[r.node]
                size = np.sqrt((q.astype(np.float64) ** 2).sum(1))
                top = _bound(_dot(q, p[None, :])[:, 0], size, _distance(q, p[None, :])[:, 0], r.page_near, r.page_far, r.page_norm)
                packets.append((-float(top.max()), len(packets), r, qid, q, beat, p))
            for _, _, r, qid, q, beat, p in sorted(packets, key=lambda x: x[:2]):
                beat = np.array([max(b, reached.get(i, -np.inf)) for i, b in zip(qid.tolist(), beat.tolist())])
                for i, new in best_of_page(qid, q, beat, p, r, k, keep)[0].items():
                    out[i] = sorted({*out.get(i, []), *new})[: 8 * k]
                    if len(out[i]) >= k:
                        reached[i] = float(-out[i][k - 1][0])
            found = [(i, v, -s) for i, top in out.items() for s, v in top[:k]]
            if found:
                yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    met = visits.withColumnRenamed("node", "visited").join(pages, (F.col("visited") == F.col("node")) & _page_may_reach())
    met = met.select("node", "query_ids", "queries", "beat", "page_near", "page_far", "page_norm", "vectors", "far", "norm", "ids", "count")
    return met.mapInPandas(run, "query_id long, vec_id long, score long")


def top_k(rows: DataFrame, k: int = 5, every: int = 50, scale: int = 256, nodes: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every row whose id is divisible by `every`.

    Components count as floor(scale * x); the score is the integer inner product, ties go to the smaller id, a row is not
    its own candidate. Vectors that are null or hold a null or non-finite component, and rows without an id, take no part.
    Equal vectors are one entry with its smallest distinct ids, so copies never crowd a page, and repeated rows are one
    candidate. An id with several vectors is a candidate with each of them, but once for each score, never one for its own
    id, and one query, with the smallest of its vectors. Vectors of different lengths are compared as if the shorter ended
    in zeros. Fewer than k candidates give fewer rows, none an empty result; extra columns are ignored.
    """
    ship(rows.sparkSession)
    s = Scratch(rows.sparkSession)
    vectors = s.cut(whole_vectors(rows, scale, id_col, vector_col), "tree-rows")
    routing, pages = build(vectors, k + 1, nodes, s)
    queries = vectors.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("q").alias("q"))
    queries = s.cut(queries.withColumn("beat", F.lit(float("-inf"))), "tree-queries")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(found: DataFrame) -> DataFrame:
        return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    first = s.cut(best(_search(_visits(queries, routing, True), pages, routing, k, k + 1)), "tree-first")
    reached = first.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("reached"))
    again = queries.join(reached, "vec_id", "left").select("vec_id", "q", F.coalesce("reached", "beat").alias("beat"))
    rest = _search(_visits(again, routing, False), pages, routing, k, k + 1)
    out = best(first.select("query_id", "vec_id", "score").unionByName(rest))
    out = s.cut(out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), "tree-answers")
    s.keep_only(out)
    return out

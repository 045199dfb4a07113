import math

import numpy as np

from drayage.llm import embedding_dedup, exact_topk, url_filter
from drayage.llm.common import components, table

SCHEMA = "vec_id long, embedding array<float>, label int, node string, bucket int"


def odd_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=8)
    rows = [(k, (base + rng.normal(size=8) * 0.02).tolist(), 1) for k in range(60)] + [(100 + k, base.tolist(), 1) for k in range(5)] + [(150, base.tolist(), 2)]
    rows += [(200, None, 1), (201, [0.0] * 8, 1), (202, [math.nan] * 8, 1), (203, [math.inf] + [0.0] * 7, 1), (204, base.tolist(), None), (None, base.tolist(), 1), (250, [None] + [1.0] * 7, 1)]
    rows += [(300 + k, rng.normal(size=8).tolist(), k % 3) for k in range(200)]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def brute_links(rows, least=0.98):
    good = [(k, r) for k, r in enumerate(rows) if r.embedding and r.label is not None and all(x is not None and math.isfinite(x) for x in r.embedding) and any(r.embedding)]
    unit = {k: np.array(r.embedding, float) / np.linalg.norm(np.array(r.embedding, float)) for k, r in good}
    near = {k: [j for j, s in good if j != k and s.label == r.label and unit[k] @ unit[j] >= least] for k, r in good}
    out = []
    for k, r in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for j in near.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j].vec_id for j in seen if rows[j].vec_id is not None]
        own = min(ids) if r.vec_id is not None else None
        out.append((str(r.vec_id), len(near.get(k, [])), own, r.vec_id is not None and own == r.vec_id))
    return sorted(out)


def test_links_equal_brute_force(spark):
    for d in (odd_vectors(spark), table(spark, "/root/testdata/sf0.001", "embeddings")):
        got = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in embedding_dedup.link_embeddings(d).collect())
        want = brute_links(d.collect())
        links, found = sum(w[1] for w in want), sum(g[1] for g in got)
        assert found <= links and found >= 0.99 * links
        if found == links:
            assert got == want
    assert embedding_dedup.link_embeddings(odd_vectors(spark).limit(0)).count() == 0


def test_top_k_equals_brute_force(spark):
    for d, every in ((odd_vectors(spark), 10), (table(spark, "/root/testdata/sf0.001", "embeddings"), 50)):
        rows = [(r.vec_id, np.floor(256 * np.array(r.embedding, float)).astype(np.int64)) for r in d.collect() if r.vec_id is not None and r.embedding and all(x is not None and math.isfinite(x) for x in r.embedding)]
        want = []
        for i, q in rows:
            if i % every == 0:
                best = sorted((-int(q @ x), j) for j, x in rows if j != i)[:5]
                want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
        for nodes in (16, 256):
            got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in exact_topk.top_k(d, 5, every, nodes=nodes).collect())
            assert got == sorted(want)
    assert exact_topk.top_k(odd_vectors(spark).limit(0)).count() == 0
    assert exact_topk.top_k(odd_vectors(spark).where("vec_id = 100")).count() == 0


def test_top_k_counts_repeated_rows_once(spark):
    rng = np.random.default_rng(4)
    base = [float(x) for x in rng.integers(1, 4, 8)]
    rows = [(k, base if k < 12 else [float(x) for x in rng.integers(-3, 4, 8)]) for k in range(80)]
    rows += [(7, base)] * 9 + [(21, [x + 1 for x in base])] + [(22, [base[1], base[0], *base[2:]])] * 2 + [(20, [x + 2.0 + d for d, x in enumerate(base)]) for _ in range(7)]
    rows += [(50, [x + 3.0, *base[1:]]) for x in range(9)] + [(51, np.roll(base, k).tolist()) for k in range(8)]
    schema = "vec_id long, embedding array<double>"
    for d in (spark.createDataFrame(rows, schema), spark.createDataFrame(rows + rows + rows, schema)):
        queries = {i: min(x for j, x in rows if j == i) for i in {j for j, _ in rows} if i % 10 == 0}
        want = []
        for i, q in queries.items():
            best = sorted({(-int(np.dot(256 * np.array(q), 256 * np.array(x))), j) for j, x in rows if j != i})[:5]
            want += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
        for nodes in (2, 16):
            got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in exact_topk.top_k(d, 5, 10, nodes=nodes).collect())
            assert got == sorted(want)


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 99), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {99: 99, 100: 99}


def test_components_of_long_chains_with_shuffled_ids(spark):
    rng = np.random.default_rng(5)
    ids = [int(x) for x in rng.integers(-(2**63), 2**63 - 1, 2600)]
    chain, ring, star = ids[:2000], ids[2000:2300], ids[2300:]
    edges = list(zip(chain, chain[1:])) + list(zip(ring, ring[1:] + ring[:1])) + [(max(star), x) for x in star]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: min(group) for group in (chain, ring, star) for x in group}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_urls(spark):
    urls = {
        1: ("https://WWW.Example.com/en/x?q#f", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
        2: ("http://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
        3: ("http://b.net/es/1", "b.net", "/es/1", "net/es/", "block"),
        4: ("http://b.com", "b.com", "", None, None),
        5: ("http://xexample.com/en/1", "xexample.com", "/en/1", "com/", "allow"),
        6: (None, "", "", None, None),
        7: ("no scheme", "", "", None, None),
        8: ("x://a.org?u=http://b.com/", "a.org", "", None, None),
        9: ("http://é漢😀.org/" + "a" * 3000, "é漢😀.org", "/" + "a" * 3000, None, None),
        10: ("", "", "", None, None),
    }
    rows = [(k, v[0], "h", "clash") for k, v in urls.items()] + [(None, "http://b.com/", "h", "clash")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in url_filter.judge_urls(d).collect()}
    for k, (_, host, path, rule, verdict) in urls.items():
        assert (got[k].host, got[k].path, got[k].rule) == (host, path, rule) and got[k].verdict in ((verdict,) if verdict else ("allow", "block")), k
    assert url_filter.judge_urls(d.limit(0)).count() == 0


def test_url_ratios_equal_brute_force(spark):
    from pyspark.sql import functions as F

    size, weight = url_filter.SIZE, 4.0
    data = [("http://a.com/x1", True), ("http://a.com/y2", True), ("http://spam.net/es/", False), ("http://bad.net/fr/9", False)]

    def grams(u):
        s = [url_filter.START] * 2 + [url_filter.SYMBOLS.find("0" if c.isdigit() else c) for c in u.lower()]
        return list(zip(s, s[1:], s[2:]))

    def p(side, a, b, c):
        g = [x for u, ok in data if ok == side for x in grams(u)]
        p0 = (sum(x[2] == c for x in g) + weight / size) / (len(g) + weight)
        p1 = (sum(x[1:] == (b, c) for x in g) + weight * p0) / (sum(x[1] == b for x in g) + weight)
        return (sum(x == (a, b, c) for x in g) + weight * p1) / (sum(x[:2] == (a, b) for x in g) + weight)

    d = spark.createDataFrame(data, "url string, accepted boolean")
    table_ = url_filter.table_of(url_filter.ratios(d))
    got = {r.url: r.s for r in d.select("url", url_filter.mean_ratio(F.col("url"), table_).alias("s")).collect()}
    for u, _ in data:
        want = sum(math.log(p(True, *g)) - math.log(p(False, *g)) for g in grams(u)) / len(u)
        assert abs(got[u] - want) < 1e-5


def test_the_tree_avoids_most_inner_products_where_vectors_cluster(spark):
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(40, 16)) * 4
    rows = [(k, (centers[k % 40] + rng.normal(size=16) * 0.05).tolist()) for k in range(4000)]
    d = exact_topk.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 256, "vec_id", "embedding")
    routing, pages = exact_topk.build(d, 6, 256)
    held = list(pages.toPandas().itertuples(index=False))
    q = np.array([r.q for r in d.orderBy("vec_id").collect()][:40])
    every = q @ np.array([r.q for r in d.collect()]).T
    beat = np.sort(every, axis=1)[:, -6].astype(float)  # the query itself and five more
    go, done = routing.may_reach(q, beat)
    assert done < 0.5 * len(q) * len(routing.vectors)  # the upper level rules out most nodes
    for page in held:
        some = np.flatnonzero(go[:, page.node])
        if len(some):
            found, n = exact_topk.best_of_page(some, q[some], beat[some], routing.vectors[page.node], page, 5, 6)
            done += n
            assert all(-s in every[i] for i, top in found.items() for s, _ in top)
    assert done < 0.1 * len(q) * len(rows)


def test_components_beyond_the_range_raise(spark):
    import pytest

    with pytest.raises(Exception, match="component beyond"):
        exact_topk.top_k(spark.createDataFrame([(0, [1e30])], "vec_id long, embedding array<double>")).collect()


def test_a_hub_of_many_links_counts_them_all(spark):
    """One vector near 300 others that are not near each other's far side, ids above 2^53, and copies of it."""
    rng = np.random.default_rng(9)
    hub = rng.normal(size=32)
    hub /= np.linalg.norm(hub)
    rows = [(2**53 + 1, hub.tolist(), 1)] * 3
    for k in range(300):
        off = rng.normal(size=32)
        off -= off @ hub * hub
        rows.append((2**53 + 3 + 2 * k, (0.985 * hub + math.sqrt(1 - 0.985**2) * off / np.linalg.norm(off)).tolist(), 1))
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = embedding_dedup.link_embeddings(d).collect()
    assert {r.component_id for r in got} == {2**53 + 1}
    assert [r.n_links for r in got if r.vec_id == 2**53 + 1] == [302] * 3 and all(r.n_links >= 3 for r in got)


def near_group(spark, n, size, parts=4):
    """n vectors of 64 floats in one label, the first `size` of them near copies of one another; cosines are on either side of 0.98."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(n, 64))
    x[:size] = rng.normal(size=64) + rng.normal(size=(size, 64)) * 0.13
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    ids = rng.permutation(n)
    d = spark.createDataFrame([(int(k), v.tolist(), 1) for k, v in zip(ids, x, strict=True)], "vec_id long, embedding array<float>, label int").repartition(parts)
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    return d, {int(k): int(c) for k, c in zip(ids, (u @ u.T >= 0.98).sum(axis=1) - 1, strict=True)}


def shuffled(spark):
    """Bytes that each stage of the session has shuffled, by stage id."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return {(x := stages.apply(k)).stageId(): x.shuffleWriteBytes() for k in range(stages.size())}


def test_what_links_shuffle_stays_below_a_multiple_of_the_input(spark, monkeypatch):
    """A dense group has a hundred thousand pairs; the rows on disk at once follow the vectors and neither the pairs nor the hash tables."""
    d, want = near_group(spark, 3000, 600)
    assert sum(want.values()) // 2 > 100_000
    monkeypatch.setattr(embedding_dedup, "PASS", 0, raising=False)  # one table a pass, as for a large input
    before = shuffled(spark)
    got = embedding_dedup.link_embeddings(d).collect()
    assert {r.vec_id: r.n_links for r in got} == want and len(got) == 3000
    assert max(n for k, n in shuffled(spark).items() if k not in before) < 2 * 3000 * 64 * 4


def test_links_of_a_bucket_in_cells(spark):
    """A bucket with more rows than two tasks have is cut into cells; its links are the same, and components too."""
    d, want = near_group(spark, 1200, 900)
    twice = d.union(d.where("vec_id < 100").selectExpr("vec_id + 5000 AS vec_id", "embedding", "label"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    plain = {r.vec_id: r for r in embedding_dedup.link_embeddings(twice).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert {r.vec_id: r for r in embedding_dedup.link_embeddings(twice).collect()} == plain
        assert {r.vec_id: r.n_links for r in embedding_dedup.link_embeddings(d).collect()} == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_links_between_lengths_in_different_batches(spark):
    rng = np.random.default_rng(12)
    short = [rng.normal(size=3).tolist() for _ in range(40)]
    d = spark.createDataFrame([(k, v, "a") for k, v in enumerate(short)], "vec_id long, embedding array<double>, label string").coalesce(1)
    d = d.union(spark.createDataFrame([(100 + k, [*(2 * x for x in v), *[0.0] * 6], "a") for k, v in enumerate(short)], d.schema).coalesce(1))
    got = {r.vec_id: r for r in embedding_dedup.link_embeddings(d, least=0.9999).collect()}
    assert all(got[100 + k].component_id == got[k].component_id <= k and got[k].n_links == got[100 + k].n_links > 0 for k in range(40))

import numpy as np
import pyarrow as pa

from drayage.llm import jaccard_join


def test_entries_with_a_possible_partner_stay(spark):
    """Against all pairs of each list, over lists that cross Arrow batches, repeat rows, are in parts, or are longer than LONG."""
    rng = np.random.default_rng(2)
    rows = []
    for token in range(300):
        size = int(rng.choice([1, 2, 3, 9, 40]))
        for k in range(size):
            n = int(rng.integers(1, 60))
            rows.append((token, 5 if token % 50 == 0 else -1, bytes([token % 256, token // 256, k] + [0] * 13), n, int(rng.integers(0, max(1, n // 6 + 1)))))
    rows += [(1000, -1, bytes([1, k % 256, k // 256] + [0] * 13), 10 + k, 0) for k in range(jaccard_join.LONG + 50)]
    rows += rows[:200]
    d = spark.createDataFrame(rows, "token long, part int, node binary, n int, pos int")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        for p, q in ((85, 100), (80, 100)):
            rows_of = jaccard_join._shared(d, (p, q)).collect()
            got, meets = {(r.token, bytes(r.node)) for r in rows_of if r.near}, {(r.token, bytes(r.node)) for r in rows_of if r.met}
            want, fits = set(), set()
            lists = {}
            for r in set(rows):
                lists.setdefault(r[0], []).append(r)
            for token, members in lists.items():
                for a in members:
                    reach = lambda x, y: (x[3] - x[4]) * (p + q) >= (x[3] + y[3]) * p
                    if a[1] >= 0 or len(members) > jaccard_join.LONG or any(a[2] != b[2] and min(a[3], b[3]) * q >= max(a[3], b[3]) * p and reach(a, b) and reach(b, a) for b in members):
                        want.add((token, a[2]))
                    if a[1] >= 0 or len(members) > jaccard_join.LONG or any(a[2] != b[2] and min(a[3], b[3]) * q >= max(a[3], b[3]) * p for b in members):
                        fits.add((token, a[2]))
            assert got == want and meets == fits
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_entries_name_sets_shortly_and_lists_in_full(spark):
    """What the largest shuffle carries, and what lies on disk beside it: no whole digest, no bitmaps twice."""
    words = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(words[: 60 - k % 4] + [f"v{k}y{j}" for j in range(k % 4)])) for k in range(12)]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "xxhash64(text) AS row", "text")
    none = np.zeros(0, np.uint64)
    entries = jaccard_join._prefixes(d, 5, (80, 100), none, none.view(np.int64)).collect()
    join = jaccard_join._Join(d, 5, (80, 100), jaccard_join.Scratch(spark))
    join.index()
    whole = {bytes(r.node): r.n for r in join.nodes.collect()}
    lists = join.lists.collect()
    assert len(whole) == 10 and lists and all(whole[bytes(r.node)] == r.n for r in lists)
    assert {(bytes(r.node), r.n) for r in entries} == {(x[:8], n) for x, n in whole.items()}
    assert {(r.token, r.part, bytes(r.node)[:8], r.n, r.pos) for r in lists} <= {(r.token, r.part, bytes(r.node), r.n, r.pos) for r in entries}
    assert not any("profiles" in path for _, path in join.s.held)


def test_sets_with_the_same_short_digest_and_other_sizes_stay_apart(spark):
    for long_list in (0, jaccard_join.LONG + 50):
        rows = [(7, -1, b"\1" * 8, 20, 0), (7, -1, b"\1" * 8, 21, 0), (7, -1, b"\1" * 8, 21, 0)] + [(7, -1, k.to_bytes(8, "little"), 22 + k, 0) for k in range(long_list)]
        d = spark.createDataFrame(rows, "token long, part int, node binary, n int, pos int")
        got = sorted((r.n, bytes(r.node)) for r in jaccard_join._shared(d, (80, 100)).collect())
        assert got == sorted({(r[3], r[2]) for r in rows})


def test_binary_round_trip():
    x = np.arange(10, dtype=np.uint64).reshape(5, 2)
    a = jaccard_join._binary(x)
    assert (jaccard_join._numbers(a) == x).all() and (jaccard_join._numbers(a.slice(2, 2)) == x[2:4]).all() and isinstance(a, pa.Array)


def test_needed_shingles_are_never_more_than_links_have():
    """Random linked sets: the shingles that both prefixes hold reach the bound of the bin of their sizes, both ways."""
    rng = np.random.default_rng(8)
    for p, q in ((85, 100), (80, 100)):
        for _ in range(3000):
            n, union = int(rng.integers(1, 300)), 0
            common = int(rng.integers(0, n + 1))
            m = common + int(rng.integers(0, n // 4 + 2))
            if not m or q * common < p * (n + m - common):
                continue
            union = n + m - common
            order = rng.permutation(union)  # shingles 0..common are shared, then a's, then b's
            a, b = sorted(order[: n]), sorted([*order[:common], *order[n:]])
            pre = lambda s: set(s[: len(s) - -(-len(s) * p // q) + 1])
            held = len(pre(a) & pre(b))
            for x, y in ((n, m), (m, n)):
                k = int(np.log2(jaccard_join._bins(np.array([y / x]), (p, q))[0]))
                lo, hi = ((q / p) ** (2 * z / jaccard_join.BINS - 1) for z in (k, k + 1))
                worst = min((p / (p + q)) * (1 + r) - (p / q) * max(1.0, r) for r in (lo, hi))
                assert held >= x * worst - 1e-6 * (x + 1)


def test_entries_of_long_lists_come_once(spark):
    """Equal sets that several tasks have entered, in a list longer than LONG and in one in parts, across Arrow batches."""
    lists = [(1, -1, bytes([k % 256, k // 256] + [0] * 14), 100 + k % 7, k % 5) for k in range(jaccard_join.LONG + 90)]
    lists += [(2, 3, bytes([9, k] + [0] * 14), 100, k % 5) for k in range(60)]
    d = spark.createDataFrame(lists * 5, "token long, part int, node binary, n int, pos int").repartition(7)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        got = [(r.token, r.part, bytes(r.node), r.n, r.pos) for r in jaccard_join._shared(d, (85, 100)).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted(got) == sorted(lists)


def test_a_group_of_near_copies_leaves_few_pairs_to_open(spark, monkeypatch):
    """Copies with edits in common link in many ways: leaders find most of them, and what they leave is no square of the group."""
    rng, rows = np.random.default_rng(5), []
    for doc in range(600):
        words = [f"w{k}" for k in range(150)]
        for at in rng.choice(14, int(rng.integers(2, 5)), replace=False):
            words[10 * at + 5] = f"e{at}x{rng.integers(2)}"
        rows.append((doc, " ".join(words)))
    opened, pairs = jaccard_join._Join.opened, []
    monkeypatch.setattr(jaccard_join._Join, "opened", lambda self, *a: (out := opened(self, *a), pairs.append(out.count()))[0])
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    sets = [{tuple(w[k : k + 4]) for k in range(147)} for w in (t.split() for _, t in rows)]
    least = list(range(600))
    links = [(a, b) for a in range(600) for b in range(a) if 100 * (i := len(sets[a] & sets[b])) >= 85 * (294 - i)]
    while any(least[a] != least[b] for a, b in links):
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    assert got == dict(enumerate(least)) and pairs[0] < 600

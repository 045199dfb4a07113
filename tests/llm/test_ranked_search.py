"""Ranked search against a plain version, at odd inputs and in several batches of items."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from drayage.llm import ranked_search
from drayage.llm.common import table

SF = "/root/testdata/sf0.001"


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain(docs, items, k):
    """[(item, rank, id, score)] of all items, and ids in order of their score; rows that tie and agree in id are alike."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, total = sum(bool(c) for _, c in held), sum(c.total() for _, c in held)
    df, wanted, out = Counter(t for _, c in held for t in c), {}, []
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    for item, own in wanted.items():
        scored = []
        for i, c in held:
            m = 50 + 50 * c.total() * n_docs // total if total else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in own if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out += [(item, n + 1, None if none else i, -s) for n, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=repr)


@pytest.mark.parametrize("k, batch", [(3, 1 << 16), (50, 6)])
def test_search_equals_brute_force(spark, docs, monkeypatch, k, batch):
    monkeypatch.setattr(ranked_search, "TERMS", batch)
    more = spark.createDataFrame([(100 + n, " ".join(f"w{j % (n + 2)}" for j in range(n * n + 1))) for n in range(40)], "doc_id long, text string")
    d = docs.unionByName(more, allowMissingColumns=True).withColumn("item_id", F.lit(1)).withColumn("bound", F.lit(2))
    items = [(1, "quick fox w3 w5, w3"), (2, "漢😀 Une autre zzz"), (3, None), (4, ""), (5, "!!"), (None, "dawn bridge"), (7, "MIT License"), (7, "license released"), (7, "license released"), (8, "W1 w2 w3 w4 w5 w6 x")]
    i = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, doc_id int")
    rows = [(r.doc_id, r.text) for r in d.collect()]
    assert got(ranked_search.search(d, i, k)) == plain(rows, items, k)
    assert ranked_search.search(d.limit(0), i, k).count() == 0 and ranked_search.search(d, i.limit(0), k).count() == 0


def test_search_of_real_documents_rescores_few(spark):
    d, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    want = plain([(r.doc_id, r.text) for r in d.collect()], [(r.item_id, r.text) for r in items.collect()], 10)
    assert got(ranked_search.search(d, items, 10)) == want


def test_bounds_are_never_below_scores_and_exclude_most(spark):
    rng = np.random.default_rng(2)
    texts = [" ".join(f"t{x}" for x in rng.zipf(1.3, 150) if x < 50_000) for _ in range(600)]
    batch = ranked_search.Batch([(n, sorted({f"t{x}" for x in rng.zipf(1.3, 25) if x < 50_000})) for n in range(20)])
    df = Counter(t for x in texts for t in set(x.split()))
    batch.weigh({k: df[t] for k, t in enumerate(batch.names)}, len(texts), sum(len(t.split()) for t in texts))
    owner, h, times, n = ranked_search.distinct_terms(texts)
    docs = [(k, k, int(n[k]), ranked_search._signatures(h[owner == k], times[owner == k])) for k in range(len(texts))]
    exact = np.array([batch.scores(t.encode(), list(range(20))) for t in texts])
    above, seen = 0, 0
    for width, part, bitmaps in ranked_search._blocks(docs):
        bounds = batch.bounds(width, [d[2] for d in part], bitmaps)
        own = exact[[d[0] for d in part]].T
        assert (bounds >= own).all()
        above, seen = above + (bounds > 1.2 * own + 1).sum(), seen + len(part)
    assert seen == len(texts) and above < 0.1 * exact.size

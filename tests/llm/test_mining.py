"""Hard negatives and fingerprints against plain versions, at odd inputs."""

import hashlib
import math
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from drayage.llm import fingerprints, hard_negatives
from drayage.llm.common import table

SF = "/root/testdata/sf0.001"


def vectors(spark):
    """Copies, ties, nulls in every column, several labels and vectors of one id, scores below zero, clashing names."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=6)
    rows = [(k, (base + rng.normal(size=6) * 0.3).tolist(), k % 3) for k in range(150)] + [(200 + k, base.tolist(), k % 2) for k in range(40)]
    rows += [(300 + k, (-base).tolist(), 7) for k in range(3)] + [(300, (base * 0.5).tolist(), 7), (40, base.tolist(), 9), (40, base.tolist(), 2), (41, base[:4].tolist(), 1)]
    rows += [(400, None, 1), (410, [math.nan] * 6, 1), (420, [1.0, None], 1), (430, [math.inf], 1), (440, base.tolist(), None), (None, base.tolist(), 1), (450, [], 1), (460, [0.0] * 6, 0)]
    return spark.createDataFrame([(*r, 1, 2) for r in rows * 2], "vec_id long, embedding array<double>, label int, score int, slot int")


def plain_negatives(rows, every, share, relabel=lambda i, x: x):
    good = {(r.vec_id, relabel(r.vec_id, r.label), tuple(math.floor(256 * x) for x in r.embedding)) for r in rows if r.vec_id is not None and r.label is not None and r.embedding is not None and all(x is not None and math.isfinite(x) for x in r.embedding)}
    out = []
    for i in {g[0] for g in good if g[0] % every == 0}:
        _, label, q = min(g for g in good if g[0] == i)
        scored = sorted((-sum(a * b for a, b in zip(q, x)), j, y) for j, y, x in good if j != i)
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            fits = [x for x in scored if x[2] != label and share[0] * -s <= share[1] * -x[0] <= share[1] * -s][:5]
            out += [(i, p, n + 1, j, -s, -x) for n, (x, j, _) in enumerate(fits)]
    return sorted(out)


def test_hard_negatives_equal_brute_force(spark, monkeypatch):
    d, real = vectors(spark), table(spark, SF, "embeddings")
    got = lambda df: sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect())
    for cell in (16_384, 60):
        monkeypatch.setattr(hard_negatives, "CELL", cell)
        assert got(hard_negatives.mine(d, every=20)) == plain_negatives(d.collect(), 20, (80, 100))
    assert got(hard_negatives.mine(d, every=10, share=(3, 10))) == plain_negatives(d.collect(), 10, (3, 10))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    want = plain_negatives(real.collect(), 25, (80, 100), lambda i, x: (x + 1) % 10 if i % 7 == 0 else x)
    assert got(hard_negatives.mine(real, every=25, label=label)) == want and want
    assert hard_negatives.mine(d.limit(0)).count() == 0 and hard_negatives.mine(d.where("label = 7"), every=1000).count() == 0
    with pytest.raises(Exception, match="beyond"):
        hard_negatives.mine(spark.createDataFrame([(0, [2.0**20], 1)], "vec_id long, embedding array<double>, label int")).collect()


def plain_words(text):
    alone = set(range(0x2E80, 0xA000)) | set(range(0xAC00, 0xD7B0))
    text = "".join(f" {c} " if ord(c) in alone else c for c in text.lower())
    return "".join(" " if c in " \t\n\v\f\r" else c for c in text).split(" ")


def hash_long(x, seed):
    signed = struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(x, seed)))[0]
    return signed


def plain_samples(text, samples):
    """The least value of each sample, from the formula."""
    out = []
    weights = Counter(w for w in plain_words(text) if w)
    for n in range(samples):
        values = []
        for w, s in weights.items():
            # Spark hashes several columns by making each hash the seed of the one before
            part = hash_long(struct.pack("<q", hash_long(w.encode(), 42)), 42)
            one, two = (xxhash.xxh64_intdigest(struct.pack("<i", k), part % 2**64) for k in (2 * n, 2 * n + 1))
            u = [((one & (2**21 - 1)) + 0.5) / 2**21, (((one >> 21) & (2**21 - 1)) + 0.5) / 2**21, ((one >> 42) + 0.5) / 2**22]
            c = -math.log(((two & (2**32 - 1)) + 0.5) / 2**32 * (((two >> 32) + 0.5) / 2**32))
            r = -math.log(u[0] * u[1])
            values.append(c * u[0] * u[1] * math.exp(r * (u[2] - math.floor(math.log(s) / r + u[2]))))
        out.append(min(values, default=None))
    return out


def similarity(a, b):
    x, y = (Counter(w for w in plain_words(t) if w) for t in (a, b))
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def plain_edits(rows):
    """(id, text, edited text, next text) in order."""
    key = lambda r: (r.doc_id is None, r.doc_id or 0, hash_long((r.text or "").encode(), 42))
    rows = sorted(rows, key=key)
    out = []
    for k, r in enumerate(rows):
        text, after = r.text or "", rows[(k + 1) % len(rows)].text or ""
        half = len(text) // 2
        out.append((r.doc_id, text, text[: len(text) - half] + after[:half], after))
    return out


@pytest.mark.parametrize("block", [4096, 3])
def test_fingerprints_equal_the_formula(spark, docs, block):
    odd = docs.select("doc_id", "text", "shard", F.lit("x").alias("block"), F.lit(1).alias("guest"), F.lit(1).alias("key"))
    want = plain_edits(odd.collect())
    got = sorted(fingerprints.fingerprint_edits(odd, samples=16, block=block).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    full = lambda i, n, sha: (i is None, i or 0, n, sha)
    assert sorted(full(r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(full(i, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in want)
    prints = {}
    for r in got:
        prints.setdefault((r.doc_id, r.edited_sha256), r)
    share = lambda a, b: sum(x == y for x, y in zip(plain_samples(a, 16), plain_samples(b, 16))) / 16
    for i, text, edited, after in want:
        r = prints[i, hashlib.sha256(edited.encode()).hexdigest()]
        assert (len(r.fingerprint), len(r.edited_fingerprint)) == (64, 64)
        assert abs(r.near_edited - share(text, edited)) < 1e-9 and abs(r.near_next - share(text, after)) < 1e-9, (i, text[:40])
    assert fingerprints.fingerprint_edits(odd.limit(0)).count() == 0
    one = fingerprints.fingerprint_edits(odd.where("doc_id = 1"), block=block).first()
    assert one.near_next == 1.0


def test_fingerprints_estimate_generalised_jaccard(spark):
    d = table(spark, SF, "documents")
    want = {(i, hashlib.sha256(e.encode()).hexdigest()): (similarity(t, e), similarity(t, n)) for i, t, e, n in plain_edits(d.collect())}
    rows = fingerprints.fingerprint_edits(d, samples=32).collect()
    assert len(rows) == d.count()
    off = np.array([(r.near_edited - want[r.doc_id, r.edited_sha256][0], r.near_next - want[r.doc_id, r.edited_sha256][1]) for r in rows])
    # unbiased, and no further off than 32 draws are
    assert np.abs(off.mean(axis=0)).max() < 0.02 and np.abs(off).max() < 0.45 and np.sqrt((off**2).mean(axis=0)).max() < 0.09

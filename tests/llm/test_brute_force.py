"""Operators against plain versions of their own, at odd inputs: large ids beside null ids, ties, repeated rows, empty tables."""

import base64
import hashlib
import math
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from drayage.llm import bpe, embedding_dedup, jaccard_join, language_id, license_scan, mixing, queries, sharding, token_counts, url_filter
from drayage.llm.common import table

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import corpus_pipeline  # noqa: E402
import oracle  # noqa: E402
from test_text_operators import brute_components  # noqa: E402

SF = "/root/testdata/sf0.001"
JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
BIG = 2**53


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert oracle.compare(spark, queries.queries()[name], queries.oracle_sql()[name], SF) > 0


def big_ids(spark):
    """Ids that no float holds, and null, in one partition."""
    a, b = " ".join(f"word{k}" for k in range(30)), " ".join(f"other{k}" for k in range(30))
    rows = [(BIG + 1, a, "en", "s", BIG + 5), (None, b, "de", None, None), (BIG + 3, a + " more", "en", "s", BIG + 7), (BIG + 5, None, None, "s", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, extra long").coalesce(1)


def test_ids_stay_exact_beside_a_null(spark):
    d, want = big_ids(spark), {BIG + 1, None, BIG + 3, BIG + 5}
    for out in (
        token_counts.count_tokens(d, JSON), token_counts.prefix_token_counts(d, JSON), language_id.identify_held_out(d), bpe.encode_and_decode(d, RANKS), bpe.encode_documents(d, RANKS),
        bpe.decode_documents(bpe.encode_documents(d, RANKS), RANKS), jaccard_join.jaccard_components(d), mixing.mix_documents(d), sharding.shard_rows(d),
    ):
        assert {r.doc_id for r in out.coalesce(1).collect()} == want
    assert {r.component_id for r in jaccard_join.jaccard_components(d).collect()} == {BIG + 1, None, BIG + 5}
    v = d.select(F.col("doc_id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"), F.lit(1).alias("label"))
    assert {(r.vec_id, r.component_id, r.n_links) for r in embedding_dedup.link_embeddings(v).collect()} == {(x, BIG + 1 if x else None, 3) for x in want}
    docs = d
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.dtypes == d.dtypes
    assert {(r.doc_id, r.extra) for r in docs.collect()} <= {(BIG + 1, BIG + 5), (None, None)}
    assert {r.doc_id for r in corpus_pipeline.encode(spark, docs, SF).collect()} <= {BIG + 1, None}


def test_shards_equal_plain_draws(spark, docs):
    def descend(key, layout):
        def pick(nodes):
            def draw(n):
                u = (int(hashlib.md5(f"{key}/{n[0]}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
                return -math.log(u) / n[2], n[1]

            return min(nodes, key=draw)[1]

        total = lambda x: x[1] if isinstance(x, tuple) else sum(map(total, x))
        r = pick([(f"r{n}", n, total(x)) for n, x in enumerate(layout)])
        k = pick([(f"r{r}k{m}", m, total(y)) for m, y in enumerate(layout[r])])
        return pick([(f"s{s}", s, w) for s, w in layout[r][k]])

    for d in (docs, table(spark, SF, "documents")):
        want = Counter()
        for r in d.collect():
            key, raw = "null" if r.doc_id is None else str(r.doc_id), (r.text or "").encode()
            want[r.doc_id, len(raw) + 16, zlib.crc32(raw), descend(key, sharding.tree(40)), descend(key, sharding.tree(41))] += 1
        assert Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.grown_shard) for r in sharding.shard_rows(d).collect()) == want


def plain_targets(sizes, cap=3.0):
    names = sorted((n for n in sizes if n is not None), key=lambda n: [ord(c) for c in n]) + [None] * (None in sizes)
    weight = {n: k % 3 + 1 for k, n in enumerate(names)}
    full, out = set(), {}
    while True:
        left = sum(sizes.values()) - sum(cap * sizes[n] for n in full)
        free = [n for n in names if n not in full]
        out = {n: cap * sizes[n] if n in full else left * weight[n] / sum(weight[m] for m in free) for n in names}
        over = {n for n in free if out[n] > cap * sizes[n]}
        if not over:
            return out
        full |= over


def test_targets_equal_repeated_sharing(spark):
    for sizes in ({"a": 5, "b": 1000, "é": 3, "Z": 70, None: 11}, {"x": 10}, {"a": 0, "b": 9, "c": 1}, {f"s{k}": (k * 7919) % 97 for k in range(40)}):
        rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(rows).collect()}
        want = plain_targets(sizes)
        assert got.keys() == want.keys() and all(math.isclose(got[n], want[n], rel_tol=1e-9, abs_tol=1e-9) for n in want)


def test_schedule_meets_quotas_and_is_even(spark):
    quotas = {0: 37, 1: 5, 2: 0, 3: 300, 4: 1}
    first, rows = 0, []
    for rank, n in quotas.items():
        rows.append((rank, first, n))
        first += n
    got = sorted((r.slot, r.rank, r.nth) for r in mixing.schedule(spark.createDataFrame(rows, "rank int, first long, slots long"), chunk=16).collect())
    assert Counter(r for _, r, _ in got) == {k: n for k, n in quotas.items() if n}
    seen = Counter()
    for t, (slot, rank, nth) in enumerate(got, 1):
        assert nth == seen[rank]  # numbered in slot order without a gap
        seen[rank] += 1
        for k, n in quotas.items():  # the discrepancy of the points, twice for the idle ones
            assert abs(seen[k] - t * n / first) <= 2 * math.log2(first) + 2
    assert mixing.schedule(spark.createDataFrame([], "rank int, first long, slots long")).count() == 0


def test_pieces_are_blocks_of_the_streams(spark, docs):
    for d, block in ((docs, 32), (table(spark, SF, "documents"), 256)):
        rows, pieces = mixing.mixed(d, block)
        info = {r.row: r for r in rows.collect()}
        by_slot = {}
        for p in pieces.collect():
            by_slot.setdefault(p.slot, []).append(p)
            assert 0 <= p.skip and p.skip + p.words <= info[p.row].size
        of = {s: {info[p.row].source for p in ps} for s, ps in by_slot.items()}
        assert all(len(x) == 1 for x in of.values()) and all(sum(p.words for p in ps) <= block for ps in by_slot.values())
        short = Counter(next(iter(of[s])) for s, ps in by_slot.items() if sum(p.words for p in ps) < block)
        assert all(n == 1 for n in short.values())  # only the last block of a source is short
        got = mixing.mix_documents(d, block).collect()
        firsts, taken = {}, Counter()
        for s, ps in by_slot.items():
            for p in ps:
                firsts[p.row] = min(s, firsts.get(p.row, s))
                taken[p.row] += p.words
        assert sorted((str(r.doc_id), r.size, r.taken, str(r.first_slot)) for r in got) == sorted((str(i.doc_id), i.size, taken[i.row], str(firsts.get(i.row))) for i in info.values())
        want = plain_targets({x: sum(i.size for i in info.values() if i.source == x) for x in {i.source for i in info.values()}})
        assert all(math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9) for r in got)


def test_mix_rows_are_taken_as_the_mix_begins_them(spark, docs):
    for d in (docs.where("doc_id != 12 AND doc_id IS NOT NULL"), table(spark, SF, "documents")):
        out = mixing.mix_rows(d)
        assert out.columns == d.columns
        want = {r.doc_id: -(-r.taken // r.size) for r in mixing.mix_documents(d).collect() if r.taken}
        assert Counter(r.doc_id for r in out.collect()) == want
    twice = docs.unionByName(docs)  # ties and repeated rows are taken alike
    times = Counter((r.doc_id, r.text) for r in mixing.mix_rows(twice).collect())
    assert all(n % 2 == 0 and n <= 6 * 2 for n in times.values())
    assert mixing.mix_rows(docs.limit(0)).count() == 0 and mixing.mix_rows(docs.where("text IS NULL")).count() == 0


def test_url_threshold_and_verdicts(spark):
    d = table(spark, SF, "pages").select("page_id", "url")
    rows = d.collect()
    got = {r.page_id: r for r in url_filter.judge_urls(d).collect()}
    judged = [(r.url, got[r.page_id].rule) for r in rows if got[r.page_id].rule]
    side = {u: rule in ("com/", "www.example.com/en/") for u, rule in judged}
    grams = lambda u: (lambda s: list(zip(s, s[1:], s[2:])))([url_filter.START] * 2 + [(lambda k: len(url_filter.SYMBOLS) if k < 0 else k)(url_filter.SYMBOLS.find("0" if c in "0123456789" else c.lower() if c.isascii() else c)) for c in u])
    counts = {}
    for u, rule in judged:
        if zlib.crc32(u.encode()) % 3 < 2:
            for g in grams(u):
                for key in ((side[u],), (side[u], "c", g[2]), (side[u], "b", g[1]), (side[u], "bc", g[1:]), (side[u], "ab", g[:2]), (side[u], g)):
                    counts[key] = counts.get(key, 0) + 1
    n = lambda *k: counts.get(k, 0)
    w, size = 4.0, url_filter.SIZE

    def p(s, g):
        p0 = (n(s, "c", g[2]) + w / size) / (n(s) + w)
        p1 = (n(s, "bc", g[1:]) + w * p0) / (n(s, "b", g[1]) + w)
        return (n(s, g) + w * p1) / (n(s, "ab", g[:2]) + w)

    score = lambda u: sum(math.log(p(True, g)) - math.log(p(False, g)) for g in grams(u)) / len(u) if u else 0.0
    held = [(side[u], score(u)) for u, _ in judged if zlib.crc32(u.encode()) % 3 == 2]
    up, down = ([s for k, s in held if k is x] for x in (True, False))
    threshold = (np.mean(up) * np.std(down) + np.mean(down) * np.std(up)) / (np.std(up) + np.std(down))
    undecided = [r for r in rows if not got[r.page_id].rule]
    assert undecided and judged
    for r in undecided:
        s = score(r.url or "")
        assert abs(s - got[r.page_id].score) < 1e-4
        if abs(s - threshold) > 1e-4:
            assert got[r.page_id].verdict == ("allow" if s >= threshold else "block")


def test_url_models_tell_held_out_urls_apart(spark):
    """On the third of the rule-decided URLs that trained nothing, the models agree with the rules."""
    d = table(spark, "/root/testdata/sf0.1", "pages").select("page_id", "url")
    host, path = url_filter.split_url(F.col("url"))
    ruled = d.withColumn("host", host).withColumn("path", path)
    ruled = ruled.withColumn("accepted", url_filter.rule_of(F.col("host"), F.col("path"))[1] == "allow").where("accepted IS NOT NULL")
    third = F.crc32(F.col("url").cast("binary")) % 3
    held = ruled.where(third == 2).select("page_id", "url", "accepted")
    model = url_filter.table_of(url_filter.ratios(ruled.where(third < 2).select("url", "accepted")))
    right = held.select((url_filter.mean_ratio(F.col("url"), model) >= 0) == F.col("accepted")).collect()
    assert sum(r[0] for r in right) / len(right) > 0.95


def test_language_id_equals_plain_cosines(spark):
    d = spark.createDataFrame([(k, t, g) for k, (t, g) in enumerate([("the cat sat on the mat", "en"), ("le chat est sur la table", "fr"), ("der hund und die katze", "de"), ("The dog ate", None), ("ce chien", None), ("und das Haus", "de"), ("été Étude", "fr"), ("12 !", "en"), ("", "en"), (None, "en")])], "doc_id long, text string, lang string")
    size = language_id.DIMENSIONS
    letter = {}

    def base(c):
        if c not in letter:
            letter[c] = language_id.letter_vectors(np.array([ord(c) if c else 0]))[0].astype(float)
        return letter[c]

    def bundle(text):
        out, words = np.zeros(size), "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        for w in words:
            s = ["", *w, ""]
            for a, b, c in zip(s, s[1:], s[2:]):
                out += np.roll(base(a), 2) * np.roll(base(b), 1) * base(c)
        return out

    rows, sums = d.collect(), {}
    for r in rows:
        v = bundle(r.text)
        if zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.lang and v.any():
            sums[r.lang] = sums.get(r.lang, 0) + v / np.linalg.norm(v)
    got = {r.doc_id: r for r in language_id.identify_held_out(d).collect()}
    for r in rows:
        v = bundle(r.text)
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        if not v.any():
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        cosine = {g: v @ s / np.linalg.norm(v) / np.linalg.norm(s) for g, s in sums.items()}
        best = max(sorted(cosine), key=cosine.get)
        assert got[r.doc_id].lang_pred == best and abs(got[r.doc_id].score - max(0, cosine[best])) < 1e-4


def plain_words(text):
    out, word = [], ""
    for c in (text or "").lower():
        if c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out + [word] * bool(word)


def test_license_scan_equals_plain_containment(spark, docs):
    """A template that a text holds word for word is found; what is found holds four fifths of the shingles of some template."""
    d = table(spark, "/root/testdata/sf0.01", "documents")
    sentences = {"MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.", "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0."}
    want = {(r.doc_id, n) for r in d.collect() for n, s in sentences.items() if f" {' '.join(plain_words(s))} " in f" {' '.join(plain_words(r.text))} "}
    got = license_scan.scan(d).collect()
    assert want and want <= {(r.doc_id, r.license) for r in got}
    text = {r.doc_id: plain_words(r.text) for r in d.collect()}
    every = [(n, plain_words(t)) for n, t in [*license_scan.TEMPLATES.items(), *license_scan.NOTICES, *[(n, t) for n, t, _, _ in license_scan.texts()]]]
    runs = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    for r in got:
        assert any(n == r.license and len(runs(w) & runs(text[r.doc_id])) >= 0.8 * len(runs(w)) for n, w in every)
    # the first of a template's shingles stands where it is said to
    for r in got:
        firsts = [min((k for k in range(len(text[r.doc_id]) - 4) if tuple(text[r.doc_id][k : k + 5]) in runs(w)), default=None) for n, w in every if n == r.license]
        assert r.first_word in firsts
    assert license_scan.scan(docs.limit(0)).count() == 0
    assert {r.doc_id for r in license_scan.scan(docs.unionByName(docs)).collect()} == {12}


def test_pipeline_stages_equal_plain_versions(spark, docs):
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}, special_tokens={})
    for d in (docs, table(spark, SF, "documents"), docs.limit(0), docs.where("text IS NULL"), docs.withColumn("source", F.lit(None).cast("string"))):
        rows = [r.asDict() for r in d.collect()]
        first = corpus_pipeline.identify_languages(spark, d, SF)
        kept = [r for r in rows if any(c.isalpha() for c in r["text"] or "")]
        assert Counter(map(str, (r.asDict() for r in first.collect()))) == Counter(map(str, kept))
        second = corpus_pipeline.drop_near_duplicates(spark, first, SF)
        # rows of the smallest id of a component stay, once; rows without an id stay
        best = {i: c for i, _, c in brute_components([(r["doc_id"], r["text"]) for r in kept], 5, 80, 100) if c is not None}
        left = [r.asDict() for r in second.collect()]
        assert Counter(r["doc_id"] for r in left if r["doc_id"] is not None) == Counter({c for i, c in best.items() if i == str(c)})
        assert sum(r["doc_id"] is None for r in left) == sum(r["doc_id"] is None for r in kept)
        third = corpus_pipeline.mix_sources(spark, second, SF)
        sizes = Counter()
        for r in left:
            sizes[r["source"]] += len((r["text"] or "").split())
        mixed, taken = [r.asDict() for r in third.collect()], Counter()
        for r in mixed:
            taken[r["source"]] += len(r["text"].split())
        longest = {x: max(len(r["text"].split()) for r in left if r["source"] == x) for x in sizes}
        for x, t in plain_targets(sizes).items() if sizes else ():
            assert t - 1 <= taken[x] < t + longest[x] + 1 or taken[x] == 3 * sizes[x]
        assert all(n <= 3 * m for n, m in ((n, Counter(r["doc_id"] for r in left)[i]) for i, n in Counter(r["doc_id"] for r in mixed).items()))
        last = corpus_pipeline.encode(spark, third, SF).collect()
        want = Counter()
        for r in mixed:
            ids = lib.encode_ordinary(r["text"])
            want[r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(r["text"].encode()).hexdigest()] += 1
        assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in last) == want


def test_long_pieces_equal_the_libraries():
    """Runs without a space, longer than a row and longer than a stretch, alone and many together."""
    rng = np.random.default_rng(3)
    cjk = lambda n: "".join(map(chr, rng.integers(0x4E00, 0x4E00 + 300, n)))
    letters = lambda n: "".join(map(chr, rng.integers(97, 103, n)))
    some = [cjk(900), letters(3000), "a" * 5000, "=" * 4100, " " * 2600 + "x", "ab" * 2000]
    lib = Tokenizer.from_file(JSON)
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}, special_tokens={})
    for texts in (some, some + [cjk(int(k)) for k in rng.integers(20, 700, 80)] + [letters(int(k)) for k in rng.integers(50, 2500, 60)]):
        voc, ranks = token_counts.Vocabulary(JSON), bpe.Ranks(RANKS)
        assert [int(c[-1]) for c in token_counts.prefix_counts(texts, voc)] == [len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(b, "<u4").tolist() for b in ranks.encode(texts)] == [own.encode_ordinary(t) for t in texts]
    text = some[0][:200]
    want = [len(e.ids) for e in lib.encode_batch([text[:k] for k in range(1, 201)], add_special_tokens=False)]
    assert token_counts.prefix_counts([text] + some, token_counts.Vocabulary(JSON))[0].tolist() == want

import base64
import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers as P
import tiktoken
from tokenizers import Tokenizer

from drayage.llm import bpe, jaccard_join, language_id, license_scan, mixing, queries, sharding, token_counts
from drayage.llm.common import table

SF = "/root/testdata/sf0.001"
JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")


def own_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(n=400):
    rnd = random.Random(3)
    alphabet = [*"ab  \n\t'srevltmdX9,.! 　é漢😀٣", "<|endoftext|>", "'re", "'ll", " 's", "<|end"]
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(n)] + ["", "a" * 3000, " " * 300 + "x", "'", "<|endoftext|>" * 3]


def test_prefix_counts_equal_the_library_at_every_prefix():
    voc, lib = token_counts.vocabulary(JSON), Tokenizer.from_file(JSON)
    texts = odd_texts()
    for text, counts in zip(texts, token_counts.prefix_counts(texts, voc)):
        cuts = range(1, len(text) + 1) if len(text) < 60 else [len(text)]
        want = [len(e.ids) for e in lib.encode_batch([text[:k] for k in cuts], add_special_tokens=False)]
        assert [int(counts[k - 1]) for k in cuts] == want, text


def test_count_tokens(spark, docs):
    lib = Tokenizer.from_file(JSON)
    for d in (docs, table(spark, SF, "documents")):
        got = token_counts.count_tokens(d, JSON, 1024).collect()
        texts = [r.text or "" for r in d.collect()]
        assert sorted(r.n_tokens for r in got) == sorted(len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False))
        assert all(r.over_limit == (r.n_tokens > 1024) for r in got) and sorted(r.n_bytes for r in got) == sorted(len(t.encode()) for t in texts)
    assert token_counts.count_tokens(docs.limit(0), JSON).count() == 0
    assert len(token_counts.prefix_token_counts(docs.where("doc_id = 3"), JSON).first()["counts"]) == len(docs.where("doc_id = 3").first()["text"])


def test_encoding_equals_the_library_and_decodes(spark, docs):
    lib = own_encoding()
    ranks = bpe.ranks(RANKS)
    for text, ids in zip(odd_texts(), ranks.encode(odd_texts())):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode_ordinary(text)
        assert ranks.decode(ids).decode() == text
    for d in (docs, table(spark, SF, "documents")):
        want = sorted((len(i := lib.encode_ordinary(r.text or "")), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in d.collect())
        got = sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_and_decode(d, RANKS).collect())
        assert got == want
    assert bpe.encode_and_decode(docs.limit(0), RANKS).count() == 0
    back = bpe.decode_documents(bpe.encode_documents(docs.where("doc_id = 11"), RANKS), RANKS).first()
    assert bytes(back["bytes"]).decode() == docs.where("doc_id = 11").first()["text"]


def shingle_set(text, width):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", w) if x]
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute_components(rows, width, p, q):
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    at = list(range(len(sets)))

    def find(k):
        while at[k] != k:
            k = at[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and q * len(x & y) >= p * len(x | y):
                at[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted((str(i), len(s), least.get(find(k)) if i is not None else None) for k, (i, s) in enumerate(sets))


def test_encoding_holds_distinct_pieces_once():
    ranks, texts = bpe.Ranks(RANKS), ["to be or not to be, that is 1 of 2 " * 300] * 100
    one = ranks.encode(texts[:1])
    tracemalloc.start()
    try:
        assert ranks.encode([*texts, ""]) == one * 100 + [b""]
        assert tracemalloc.get_traced_memory()[1] < 25e6
    finally:
        tracemalloc.stop()


def test_jaccard_components_equal_brute_force(spark, docs):
    for d, width, share in ((docs, 4, (85, 100)), (table(spark, SF, "documents"), 4, (85, 100)), (table(spark, SF, "documents"), 5, (80, 100))):
        got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(d, width, share).collect())
        assert got == brute_components([(r.doc_id, r.text) for r in d.collect()], width, *share)
    assert jaccard_join.jaccard_components(docs.limit(0)).count() == 0


def test_long_sets_near_the_threshold_link_as_brute_force_has_it(spark):
    rnd, rows = random.Random(5), []
    for group in range(6):
        words = [f"w{group}x{k}" for k in range(rnd.choice([480, 700, 1500, 4000]))]
        for share in (0, 0.02, 0.05, 0.09, 0.10, 0.105, 0.11, 0.115, 0.12, 0.15, 0.3):
            own = words[: len(words) - int(share * len(words))] + [f"v{len(rows)}y{k}" for k in range(int(share * len(words)))]
            rows.append((len(rows), " ".join(own)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    for width, share in ((4, (85, 100)), (5, (80, 100))):
        got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(d, width, share).collect())
        assert got == brute_components(rows, width, *share)


def test_wide_bitmaps_pass_every_link_and_few_others(spark):
    common = [f"w{k}" for k in range(3000)]
    rows = [(k, " ".join(common[: 3000 - e] + [f"v{k}y{j}" for j in range(e)])) for k, e in enumerate((0, 150, 250, 900, 1500))] + [(5, "five words are quite short"), (6, "five words are quite brief")]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "xxhash64(text) AS row", "text")
    join = jaccard_join._Join(d, 5, (80, 100), jaccard_join.Scratch(spark))
    join.index()
    ids = {bytes(r.node): r.id for r in join.nodes.collect()}
    assert len(ids) == 7
    pairs = spark.createDataFrame([(a, b) for a in ids for b in ids if ids[a] < ids[b]], "a binary, b binary")
    got = {(ids[bytes(r.a)], ids[bytes(r.b)]) for r in join.alike(pairs).collect()}
    sets = {i: shingle_set(t, 5) for i, t in rows}
    linked = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}
    short = {(a, b) for a in sets for b in (5, 6) if a < b}
    assert linked == {(0, 1), (0, 2), (1, 2)} and got == linked | short


def test_one_of_each_group_stays(spark, docs):
    kept = jaccard_join.keep_one_of_each(docs, width=5, share=(80, 100))
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 5, 6, 7, 8, 9, 10, 11, 12, None, None]))


def test_rows_of_one_id_are_judged_by_their_own_text(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(3, a), (5, a + " more"), (5, b), (7, c), (7, c + " more"), (7, c), (9, c)]
    got = sorted((r.doc_id, r.text) for r in jaccard_join.keep_one_of_each(spark.createDataFrame(rows, "doc_id long, text string"), width=5, share=(80, 100)).collect())
    assert got[:2] == [(3, a), (5, b)] and len(got) == 3 and got[2] in [(7, c), (7, c + " more")]


def test_language_id(spark, docs):
    d = table(spark, "/root/testdata/sf0.01", "documents")
    got = language_id.identify_held_out(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.98
    small = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify_held_out(docs).collect()}
    assert all(small[k] == ("und", 0.0) for k in (5, 6, 7, 9)) and small[1][0] in ("en", "fr", "de") and 0 <= small[1][1] <= 1
    assert language_id.identify_held_out(docs.limit(0)).count() == 0
    assert language_id.identify_held_out(docs.where("lang IS NULL")).where("lang_pred != 'und'").count() == 0
    assert language_id.keep_identified(docs).columns == docs.columns


def test_license_scan(spark, docs):
    d = table(spark, "/root/testdata/sf0.01", "documents")
    want = set()
    for r in d.collect():
        w = license_scan.words_of(r.text)
        for name, t in license_scan.TEMPLATES.items():
            n = len(license_scan.words_of(t))
            need = {tuple(license_scan.words_of(t)[k : k + 5]) for k in range(n - 4)}
            for at in range(0, max(1, len(w)), max(1, n // 4)):
                win = w[at : at + n + n // 2]
                if len(need & {tuple(win[k : k + 5]) for k in range(len(win) - 4)}) >= 0.8 * len(need):
                    want.add((r.doc_id, name))
    assert {(r.doc_id, r.license) for r in license_scan.scan(d).collect()} == want and want
    assert [(r.doc_id, r.license) for r in license_scan.scan(docs).collect()] == [(12, "MIT")]


def test_texts_with_letters_stay_where_no_language_was_learned(spark, docs):
    from pyspark.sql import functions as F

    want = sorted(str(r.doc_id) for r in docs.collect() if any(c.isalpha() for c in r.text or ""))
    for lang in (F.lit(None).cast("string"), F.when(language_id.held_out(), "en"), F.lit("und")):
        assert sorted(str(r.doc_id) for r in language_id.keep_identified(docs.withColumn("lang", lang)).collect()) == want


MIT_FILE = """Copyright 2019 A. Writer and others

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the
Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be
included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE."""
GPL_HEADER = """/* frob.c: frobs widgets.  Copyright (C) 2001 A. Writer
 * This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or (at your option) any later version.
 * This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details.
 * You should have received a copy of the GNU General Public License along with this program.  If not, see <https://www.gnu.org/licenses/>. */
int main(void) { return 0; }"""
LGPL_HEADER = GPL_HEADER.replace("GNU General", "GNU Lesser General").replace("program", "library").replace("version 3", "version 2.1")


def test_license_scan_finds_real_texts(spark):
    whole = {n: t for n, t, _, _ in license_scan.texts()}
    prose = "once there was a licensed ferry that crossed the river every day and " * 30
    cases = [(MIT_FILE, "MIT"), (GPL_HEADER, "GPL-3.0"), (GPL_HEADER.replace("version 3", "version 2"), "GPL-2.0"), (LGPL_HEADER, "LGPL-2.1")]
    cases += [(GPL_HEADER.replace("GNU General", "GNU Affero General"), "AGPL-3.0"), ("x = 1  # Licensed under the MIT License", "MIT"), (prose, None), (MIT_FILE[: len(MIT_FILE) // 2], None)]
    cases += [("Redistribution and use in source and binary forms, with or without modification, are permitted.", "BSD")]
    cases += [(prose + "\n" + "\n".join(" * " + line for line in whole[n].splitlines()) + "\n" + prose, n) for n in license_scan.TOLD]
    # two rows of one id with half a text each hold no text
    half = [(MIT_FILE[: len(MIT_FILE) // 2], 900), (MIT_FILE[len(MIT_FILE) // 2 :], 900)]
    d = spark.createDataFrame([(t, k) for k, (t, _) in enumerate(cases)] + half + [(None, 901)], "text string, doc_id long")
    got = {}
    for r in license_scan.scan(d).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    assert got == {k: {n} for k, (_, n) in enumerate(cases) if n}


def test_shards_are_gapless_and_grow_only_into_the_new_one(spark, docs):
    for d in (docs, table(spark, SF, "documents")):
        got = sharding.shard_rows(d).collect()
        assert len(got) == d.count() and all(r.grown_shard in (r.shard, 40) for r in got)
        slots = {}
        for r in got:
            slots.setdefault(r.shard, []).append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_rows(docs.limit(0)).count() == 0


def test_raised_weight_moves_rows_into_its_subtree_only(spark):
    from pyspark.sql import functions as F

    old = sharding.tree(8, base=8, regions=2, racks=2)
    new = [[[(s, 3.0 if s == 5 else w) for s, w in rack] for rack in region] for region in old]
    d = spark.range(3000).withColumn("k", F.col("id").cast("string"))
    moved = sharding.assign(sharding.assign(d, F.col("k"), old, "a"), F.col("k"), new, "b").where("a != b").collect()
    rack = next(r for region in old for r in region if any(s == 5 for s, _ in r))
    region = next(x for x in old if rack in x)
    inside = {s for r in region for s, _ in r}
    assert moved and all(m.b in inside for m in moved)
    assert all(m.b in {s for s, _ in rack} for m in moved if m.a in inside)


def test_mix_meets_targets(spark, docs):
    for d in (table(spark, "/root/testdata/sf0.01", "documents"), docs):
        got = mixing.mix_documents(d, block=32).collect()
        assert len(got) == d.count() and all(r.taken <= 3 * r.size for r in got)
        by = {}
        for r in got:
            by.setdefault(r.source, [r.target, 0, r.source_size])[1] += r.taken
        assert all(abs(t - n) <= 1 for t, n, _ in by.values()) and abs(sum(t for t, _, _ in by.values()) - sum(s for _, _, s in by.values())) < 1e-6
        assert all(t <= 3 * s + 1e-9 for t, _, s in by.values())
        assert sorted(map(str, got)) == sorted(map(str, mixing.mix_documents(d, block=32).collect()))
    assert mixing.mix_documents(docs.limit(0)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    d = table(spark, SF, "documents")
    kept = jaccard_join.keep_one_of_each(language_id.keep_identified(d), width=5, share=(80, 100))
    want = {i for i, _, c in brute_components([(r.doc_id, r.text) for r in d.collect()], 5, 80, 100) if i == str(c)}
    assert {str(r.doc_id) for r in kept.collect()} == {i for i in want if any(ch.isalpha() for ch in d.where(f"doc_id = {i}").first()["text"] or "")}
    out = corpus_pipeline.run(spark, SF)
    assert {str(r.doc_id) for r in out.collect()} <= want and out.count() > 0
    assert "pipeline" in __import__("__spark_entry__").queries() and len(queries.queries()) == 13

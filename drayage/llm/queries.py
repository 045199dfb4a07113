"""The registered queries of this package: each applies its operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drayage.llm import bpe, embedding_dedup, exact_topk, fingerprints, hard_negatives, jaccard_join, language_id, license_scan, mixing, ranked_search, sharding, token_counts, url_filter
from drayage.llm.common import table


def op1_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), shards=40)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op3_prefix_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"), block=256)


def op5_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256)


def op6_cross_polytope_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.link_embeddings(table(spark, sf_dir, "embeddings"), least=0.98)


def op7_url_likelihood_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op8_hyperdimensional_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_held_out(table(spark, sf_dir, "documents"))


def op9_byte_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op10_shingle_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), width=4, share=(85, 100))


def op11_signature_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op12_slot_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), every=100, positives=5, k=5, share=(80, 100), label=label)


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, sf_dir, "documents"), samples=32)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_hash_tree_shards,
        op2_license_scan,
        op3_prefix_token_counts,
        op4_source_mix,
        op5_mtree_top_k,
        op6_cross_polytope_dedup,
        op7_url_likelihood_filter,
        op8_hyperdimensional_language_id,
        op9_byte_bpe_round_trip,
        op10_shingle_jaccard_join,
        op11_signature_ranked_search,
        op12_slot_hard_negatives,
        op13_document_fingerprints,
    )
    return {f.__name__: f for f in every}


#: Exact search: integer inner products are exact in double precision here.
TOP_K = """with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) q from embeddings
    where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  pairs as (select a.vec_id query_id, b.vec_id, list_dot_product(a.q, b.q)::bigint score from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
  ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int rank from pairs)
  select query_id, rank, vec_id, score from ranked where rank <= 5"""
#: All documents that share a term with an item.
RANKED = r"""with d as (select row_number() over () r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') t from documents),
  f as (select r, t, count(*) tf from (select r, unnest(t) t from d) group by 1, 2),
  n as (select count(*) filter (where len(t) > 0) n_docs, sum(len(t))::bigint total from d),
  w as (select t, floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)))::bigint w from f, n group by t, n_docs),
  i as (select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) t from benchmark),
  s as (select item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(d.t) * n_docs) // total))))::bigint score
    from i join w using (t) join f using (t) join d using (r), n group by 1, 2, 3),
  k as (select *, row_number() over (partition by item_id order by score desc, doc_id nulls last)::int rank from s where score > 0)
  select item_id, rank, doc_id, score from k where rank <= 50"""
#: All pairs of an anchor.
NEGATIVES = """with v as (select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end label, list_transform(embedding, lambda x: floor(256 * x::double)) q
    from embeddings where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  s as (select a.vec_id a, b.vec_id b, a.label = b.label same, list_dot_product(a.q, b.q)::bigint score from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
  p as (select * from (select *, row_number() over (partition by a order by score desc, b) n from s where same) where n <= 5),
  c as (select p.a anchor_id, p.b positive_id, p.score positive_score, s.b negative_id, s.score negative_score,
    row_number() over (partition by p.a, p.b order by s.score desc, s.b)::int rank
    from p join s on s.a = p.a and not s.same and 80 * p.score <= 100 * s.score and s.score <= p.score)
  select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from c where rank <= 5"""
#: All pairs of a label, for vectors that the hashing finds all links of.
LINKS = """with recursive v as (select vec_id, label, embedding::double[] e from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
  l as (select a.vec_id a, b.vec_id b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.98),
  r as (select vec_id id, vec_id c from embeddings union select l.b, r.c from r join l on l.a = r.id),
  m as (select id, min(c) component_id from r group by 1), n as (select a, count(*) n from l group by 1)
  select vec_id, coalesce(n, 0) n_links, component_id, vec_id = component_id kept from embeddings join m on m.id = vec_id left join n on n.a = vec_id"""
#: All pairs that share a shingle.
JACCARD = r"""with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w from documents),
  s as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) s from w),
  n as (select doc_id, count(*) n from s group by 1),
  c as (select x.doc_id a, y.doc_id b, count(*) c from s x join s y on x.s = y.s and x.doc_id <> y.doc_id group by 1, 2),
  l as (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
  r as (select doc_id id, doc_id c from documents union select l.b, r.c from r join l on l.a = r.id)
  select id doc_id, coalesce(any_value(n), 0) n_shingles, min(c) component_id from r left join n on n.doc_id = id group by id"""


def oracle_sql() -> dict[str, str]:
    """DuckDB text for what SQL can express; tests/llm holds the others against brute force, libraries and held-out rows."""
    return {"op5_mtree_top_k": TOP_K, "op6_cross_polytope_dedup": LINKS, "op10_shingle_jaccard_join": JACCARD, "op11_signature_ranked_search": RANKED, "op12_slot_hard_negatives": NEGATIVES}

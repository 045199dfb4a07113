"""A training corpus from raw documents: identify languages, drop near duplicates, mix sources, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read as the next one's docs. All
but the last return the columns of documents, whatever columns there are. Every stage works on whole texts of any length, takes
null ids, sources and languages and repeated rows, and makes no rows of an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from drayage.llm import bpe, jaccard_join, language_id, mixing
from drayage.llm.common import Scratch, table


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language.

    Texts that are null, empty or without a letter go; all others stay, and rows that repeat stay as often as they come. The
    prototype of greatest cosine wins, ties by name, but which language it is rejects nothing. Without any label every text
    with a letter stays.
    """
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of Jaccard 0.8 over five-word shingles connect.

    The smallest id stays, of one id the smallest digest of the text, of rows that repeat both one. Null and wordless texts
    and rows without an id stay, as nothing tells which of them would be first.
    """
    return jaccard_join.keep_one_of_each(docs, width=5, share=(80, 100))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: never, once, or up to three times.

    Sources weigh 1, 2, 3 by name, null is a source and comes last; within a source a hash of id and text orders documents,
    and rows that tie in it are taken alike. Documents without words are in no mix.
    """
    return mixing.mix_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, digest of the token ids, and digest of what they decode to, of every row; a null text is empty."""
    return bpe.encode_and_decode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("identify_languages", identify_languages),
    ("drop_near_duplicates", drop_near_duplicates),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: SQL cannot express the stages; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; the rows of the last one. What a stage wrote goes when the next has read it."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES[:-1]:
        done, docs = docs, scratch.cut(stage(spark, docs, sf_dir), name)
        scratch.drop(done)
    return STAGES[-1][1](spark, docs, sf_dir)

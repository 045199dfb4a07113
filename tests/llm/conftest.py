import pytest
from pyspark.sql import functions as F

LONG = "word " * 3000 + "x" * 5000


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, and extra columns with clashing names."""
    words = "the quick brown fox jumps over the lazy dog while seven wizards brew strong potions near an old stone bridge at dawn".split()
    base = " ".join(words * 2)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, base + " again", "en", "b"), (4, base.upper(), "en", None), (5, None, "en", "b"), (6, "", None, "b"),
        (7, " \t\n ", "de", "c"), (8, LONG, "en", "c"), (9, "123 456 !!", "en", "c"), (10, "une autre phrase", "fr", "d"), (11, "don't we'll 'tis  <|endoftext|> é漢😀\n\n x", None, "d"),
        (12, "Released under the MIT License.", "en", "d"), (12, "Released under the MIT License.", "en", "d"), (None, base, "en", "a"), (None, None, None, None),
    ]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return d.select("*", F.lit(1).alias("shard"), F.lit(2).alias("size"), F.lit("x").alias("node"), F.lit(3).alias("score"), F.length("text").cast("long").alias("n_chars"))

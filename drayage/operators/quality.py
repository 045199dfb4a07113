"""Rule splits: every input row is either clean or has the label of the first rule it breaks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def first_broken(rules: list[tuple[str, Column]]) -> Column:
    """The label of the first rule whose condition is true; a null condition does not break a rule."""
    return F.coalesce(*[F.when(cond, F.lit(label)) for label, cond in rules], F.lit(None).cast("string"))


def label(df: DataFrame, rules: list[tuple[str, Column]], out: str = "error_reason") -> DataFrame:
    return df.withColumn(out, first_broken(rules))


def relabel(df: DataFrame, rule: str, cond: Column, out: str = "error_reason") -> DataFrame:
    """Label rows that are still clean and break one more rule."""
    return df.withColumn(out, F.coalesce(out, F.when(cond, F.lit(rule))))


def split(df: DataFrame, out: str = "error_reason") -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(out).isNull()).drop(out), df.where(F.col(out).isNotNull())


def counters(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row with the number of rows that meet each condition, in one pass."""
    return df.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(cond).alias(name) for name, cond in rules.items()])


def observed(df: DataFrame, name: str, rules: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """The same counters without a pass of their own: they are there when the next write of the returned frame has ended."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("total"), *[F.count_if(F.coalesce(cond, F.lit(False))).alias(n) for n, cond in rules.items()]), seen

"""Which row of a group stays. Orders must be total: append an id or a hash, else ties are not repeatable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def place(keys: list[str], order: list[Column]) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(*order))


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("__n", place(keys, order)).where("__n = 1").drop("__n")


def split_first(df: DataFrame, keys: list[str], order: list[Column]) -> tuple[DataFrame, DataFrame]:
    numbered = df.withColumn("__n", place(keys, order))
    return numbered.where("__n = 1").drop("__n"), numbered.where("__n > 1").drop("__n")


def group_size(keys: list[str], among: Column | None = None) -> Column:
    """Rows of the group (of those that meet `among`): one shuffle, where a count joined back would take three."""
    counted = F.lit(1) if among is None else F.when(among, 1)
    return F.count(counted).over(Window.partitionBy(*keys))


def conflicting(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys under which `value` has more than one distinct entry."""
    return df.groupBy(*keys).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi")).where("__lo != __hi").select(*keys)

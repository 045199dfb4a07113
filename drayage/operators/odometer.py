"""Odometer checks and distances per vehicle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def running_max(keys: list[str], order: list[str], value: str, among: Column | None = None) -> Column:
    """The greatest earlier value (of rows that meet `among`)."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.max(F.col(value) if among is None else F.when(among, F.col(value))).over(w)


def distances(df: DataFrame, keys: list[str], order: list[str], odometer: str, fuel: str) -> DataFrame:
    """prev_odo, distance and mileage since the previous reading; rows without a positive distance go."""
    prev = F.lag(odometer).over(Window.partitionBy(*keys).orderBy(*order))
    df = df.withColumn("prev_odo", prev).withColumn("distance", F.col(odometer) - F.col("prev_odo"))
    return df.where("distance > 0").withColumn("mileage", F.try_divide("distance", fuel))

"""Rolling medians over the days before a day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Bins of values of rolling_median_fanout(): a power of two.
BINS = 64


def rolling_median(df: DataFrame, keys: list[str], day: str, value: str, days: int = 30, out: str = "baseline") -> DataFrame:
    """The exact lower median of `value` over the `days` days before each row's day, within its keys.

    A key's rows of one day become one row with its values in order and the rows themselves. Days are cut into blocks of
    `days`; a day goes to its own block and, as history without its rows, to the next one, so the window runs within a block:
    parallel over keys and time. There the sorted arrays of the days before are put together, which a merging sort does run
    by run, and the middle is read off: once for a day, however many rows it has. Rows without a day have no baseline; null
    values count in none. What a task holds at once are the values of one key in `days` days.
    """
    rest = [c for c in df.columns if c not in (*keys, day)]
    daily = df.groupBy(*keys, day).agg(F.sort_array(F.collect_list(value)).alias("__values"), F.collect_list(F.struct(*rest)).alias("__rows"))
    number = F.unix_date(day)
    block = F.floor(number / days)
    own = lambda at, rows: F.struct(at.alias("block"), rows.alias("rows"))
    none = F.lit(None).cast(daily.schema["__rows"].dataType)
    blocks = F.when(block.isNull(), F.array(own(block, F.col("__rows")))).otherwise(F.array(own(block, F.col("__rows")), own(block + 1, none)))
    sent = daily.select(*keys, day, "__values", F.explode(blocks).alias("__x")).select(*keys, day, "__values", "__x.block", F.col("__x.rows").alias("__rows"))
    w = Window.partitionBy(*keys, "block").orderBy(number).rangeBetween(-days, -1)
    merged = F.sort_array(F.flatten(F.collect_list("__values").over(w)))
    sent = sent.withColumn("__before", merged).where("__rows IS NOT NULL")
    median = F.when(F.col(day).isNotNull(), F.expr("try_element_at(__before, nullif(cast((size(__before) + 1) div 2 as int), 0))"))
    return sent.select(*keys, day, median.alias(out), F.inline("__rows")).select(*df.columns, out)


def rolling_median_fanout(df: DataFrame, keys: list[str], day: str, value: str, days: int = 30, out: str = "baseline", accuracy: int = 10_000) -> DataFrame:
    """The same, and exact too, parallel over keys, days and values. For few or very uneven keys.

    Values are counted in bins, whose borders a sketch of each key and block of `days` days gives: `accuracy` is the sketch's, makes
    bins even, and never decides a result. The counts of the days before tell the bin that a day's median is in, and its place
    there. Only the values of that bin are sent to the day and put in order, equal ones of a day as one row.
    """
    block = F.floor(F.unix_date("__day") / days)
    daily = df.where(F.col(day).isNotNull() & F.col(value).isNotNull())
    daily = daily.groupBy(*keys, F.col(day).alias("__day"), F.col(value).alias("__value")).agg(F.count(F.lit(1)).alias("__n"))
    sent = daily.withColumn("__block", F.explode(F.array(block, block + 1)))  # a day counts for days of its own block and the next
    borders = F.percentile_approx("__value", F.array(*[F.lit(k / BINS) for k in range(1, BINS)]), F.lit(accuracy))
    borders = sent.groupBy(*keys, "__block").agg(F.sort_array(F.array_distinct(borders)).alias("__borders"))
    steps = F.array(*[F.lit(2**k) for k in reversed(range(BINS.bit_length() - 1))])
    # binary search: how many borders are below the value
    place = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get("__borders", at + step - 1) < F.col("__value"), at + step).otherwise(at))
    sent = _join(sent, borders, [*keys, "__block"]).withColumn("__bin", place).drop("__borders")

    asked = df.where(F.col(day).isNotNull()).select(*keys, F.col(day).alias("__asked")).distinct()
    counts = sent.groupBy(*keys, "__block", "__day", "__bin").agg(F.sum("__n").alias("__n"))
    counts = counts.withColumn("__asked", F.explode(F.sequence(F.date_add("__day", 1), F.date_add("__day", days))))
    counts = _join(counts.where(F.floor(F.unix_date("__asked") / days) == F.col("__block")), asked, [*keys, "__asked"], "left_semi")
    counts = counts.groupBy(*keys, "__asked", "__block", "__bin").agg(F.sum("__n").alias("__n"))
    w = Window.partitionBy(*keys, "__asked")
    upto = lambda by: F.sum("__n").over(w.orderBy(by).rowsBetween(Window.unboundedPreceding, 0))
    counts = counts.withColumn("__upto", upto("__bin")).withColumn("__middle", F.floor((F.sum("__n").over(w) + 1) / 2))
    middle = counts.where("__upto - __n < __middle AND __middle <= __upto")
    middle = middle.select(*keys, "__asked", "__block", "__bin", (F.col("__middle") - F.col("__upto") + F.col("__n")).alias("__place"))

    middle = middle.withColumn("__day", F.explode(F.sequence(F.date_sub("__asked", days), F.date_sub("__asked", 1))))
    near = _join(sent, middle, [*keys, "__block", "__day", "__bin"])
    near = near.groupBy(*keys, "__asked", "__value").agg(F.sum("__n").alias("__n"), F.first("__place").alias("__place")).withColumn("__upto", upto("__value"))
    medians = near.where("__upto - __n < __place AND __place <= __upto").select(*keys, F.col("__asked").alias(day), F.col("__value").alias(out))
    return _join(df, medians, [*keys, day], "left").select(*df.columns, out)


def _join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join by equal columns in which null keys meet too."""
    right = right.select(*[F.col(c).alias(f"__on_{k}") for k, c in enumerate(on)], *[c for c in right.columns if c not in on])
    same = [left[c].eqNullSafe(right[f"__on_{k}"]) for k, c in enumerate(on)]
    return left.join(right, same, how).drop(*[f"__on_{k}" for k in range(len(on))])

"""Slowly changing history and joins to the interval that holds a moment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def end_by_next(df: DataFrame, keys: list[str], start: str = "start_date", out: str = "end_date") -> DataFrame:
    """The next start of the same key ends a row; the newest stays open. Intervals are [start, end)."""
    return df.withColumn(out, F.lead(start).over(Window.partitionBy(*keys).orderBy(start)))


def status(end: str = "end_date") -> Column:
    return F.when(F.col(end).isNull(), "IN-TRANSIT").otherwise("ARCHIVED")


def interval_join(
    facts: DataFrame, history: DataFrame, on: dict[str, str], moment: str, start: str = "start_date", end: str = "end_date", how: str = "inner", bounded: bool = False
) -> DataFrame:
    """Join each fact to the history row of its keys (fact column -> history column) with start <= moment < end, or open.

    Equality on the keys makes this a hash or sort-merge join with the range as residual; whether the history is broadcast
    is left to its size. bounded: first cut history to the facts' span by one aggregated row.
    """
    if bounded:
        span = facts.agg(F.min(moment).alias("__lo"), F.max(moment).alias("__hi"))
        history = history.join(F.broadcast(span), (F.col(start) <= F.col("__hi")) & (F.col(end).isNull() | (F.col(end) > F.col("__lo")))).drop("__lo", "__hi")
    renamed = history.select(*[F.col(c).alias(f"__h_{c}") for c in history.columns])
    cond = (F.col(f"__h_{start}") <= F.col(moment)) & (F.col(f"__h_{end}").isNull() | (F.col(moment) < F.col(f"__h_{end}")))
    for mine, theirs in on.items():
        cond = cond & (F.col(mine) == F.col(f"__h_{theirs}"))
    joined = facts.join(renamed, cond, how)
    extra = [c for c in history.columns if c not in facts.columns]
    return joined.select(*facts.columns, *[F.col(f"__h_{c}").alias(c) for c in extra])


def disjoint(history: DataFrame, keys: list[str], start: str = "start_date", end: str = "end_date") -> bool:
    """Whether no two intervals of a key hold the same moment (and none begins twice)."""
    after = F.lead(start).over(Window.partitionBy(*keys).orderBy(start))
    return history.select(start, end, after.alias("__next")).where(F.col("__next").isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col("__next")) | (F.col(start) == F.col("__next")))).isEmpty()


def sweep_join(facts: DataFrame, history: DataFrame, on: dict[str, str], moment: str, start: str = "start_date", end: str = "end_date", how: str = "inner") -> DataFrame:
    """interval_join for disjoint intervals, as a sweep: facts and interval starts in one order, each fact takes the last start.

    One shuffle and one sort of both, no join: the cost does not grow with the versions of a key times its facts. A fact
    whose last interval has ended has none. For one key with a large share of all facts interval_join is better, whose skewed
    partitions are split.
    """
    extra = [c for c in history.columns if c not in facts.columns]
    kinds = dict(history.dtypes)
    row = F.struct(*[F.col(f"`{c}`") for c in dict.fromkeys([start, end, *extra])])
    begins = history.select(*[F.col(theirs).alias(f"__k{n}") for n, theirs in enumerate(on.values())], F.col(start).alias("__at"), row.alias("__h"), F.lit(None).cast(facts.schema).alias("__f"))
    own = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    seen = facts.select(*[F.col(mine).alias(f"__k{n}") for n, mine in enumerate(on)], F.col(moment).cast(kinds[start]).alias("__at"), F.lit(None).cast(begins.schema["__h"].dataType).alias("__h"), own.alias("__f"))
    keys = [f"__k{n}" for n in range(len(on))]
    # at one moment starts come first; null keys and moments match nothing and are spread
    keyless = F.col("__at").isNull()
    for k in keys:
        keyless = keyless | F.col(k).isNull()
    both = begins.where(~keyless).withColumn("__spread", F.lit(None).cast("long")).unionByName(seen.withColumn("__spread", F.when(keyless, F.monotonically_increasing_id() % 4096)))
    w = Window.partitionBy(*keys, "__spread").orderBy("__at", F.col("__f").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("__last", F.last("__h", ignorenulls=True).over(w)).where("__f IS NOT NULL")
    holds = F.col("__last").isNotNull() & ~keyless & (F.col(f"__last.{end}").isNull() | (F.col("__at") < F.col(f"__last.{end}")))
    if how == "inner":
        both = both.where(holds)
    return both.select("__f.*", *[F.when(holds, F.col(f"__last.{c}")).alias(c) for c in extra])


def end_open_rows(history: DataFrame, ended: DataFrame, keys: list[str], at: str = "suspended_date") -> DataFrame:
    """End rows of the given keys that are open or end later; ended(keys, at) counts with its earliest date a key."""
    first = ended.groupBy(*keys).agg(F.min(at).alias("__at"))
    late = F.col("__at").isNotNull() & (F.col("end_date").isNull() | (F.col("end_date") > F.col("__at")))
    return history.join(first, keys, "left").withColumn("end_date", F.when(late, F.col("__at")).otherwise(F.col("end_date"))).select(*history.columns)

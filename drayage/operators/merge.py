"""Keyed merges of two tables into a new snapshot, and the difference of two snapshots.

Source keys must be unique: deduplicate by a stated order first. Columns that only one side has are null on the other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    return source.unionByName(target.join(source, keys, "left_anti"), allowMissingColumns=True)


def insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    return target.unionByName(source.join(target, keys, "left_anti"), allowMissingColumns=True)


def merge_rows(target: DataFrame, source: DataFrame, keys: list[str], update: list[str] | None = None, when: Column | None = None) -> DataFrame:
    """Update the `update` columns (all by default) of matched rows where `when` holds, and insert the rest.

    In `when`, target columns are t.name and source columns s.name. One full outer join.
    """
    columns = [*target.columns, *(c for c in source.columns if c not in target.columns)]
    t = target.withColumn("__in_t", F.lit(True)).alias("t")
    s = source.withColumn("__in_s", F.lit(True)).alias("s")
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    both = t.join(s, cond, "full_outer")
    new = F.col("t.__in_t").isNull()
    changed = F.col("s.__in_s").isNotNull() if when is None else F.col("s.__in_s").isNotNull() & F.coalesce(when, F.lit(False))
    out = []
    for c in columns:
        old = F.col(f"t.{c}") if c in target.columns else F.lit(None)
        given = F.col(f"s.{c}") if c in source.columns else F.lit(None)
        takes = new if c in keys or (update is not None and c not in update) or c not in source.columns else new | changed
        out.append(F.when(takes, given).otherwise(old).alias(c))
    return both.select(*out)


def with_changes(
    target: DataFrame | None, source: DataFrame, keys: list[str], update: list[str] | None = None, when: Column | None = None, put: dict[str, Column] | None = None, whole: bool = False
) -> DataFrame:
    """The merged rows, with _change_type null, and what the merge changed, as rows of one frame: insert, delete, update_preimage
    and update_postimage. One full outer join gives both.

    Matched rows take the `update` columns (all by default) where `when` holds; put: columns that take an expression instead.
    In both, target columns are t.name and source columns s.name. whole: target rows without a match are deleted. Columns that
    only one side has are null on the other.
    """
    added = [] if target is None else [c for c in source.columns if c not in target.columns]
    columns = list(source.columns) if target is None else [*target.columns, *added]
    if target is None:
        row = F.struct(*[F.col(c) for c in columns])
        kinds = F.array(F.struct(F.lit(None).cast("string").alias("k"), row.alias("r")), F.struct(F.lit("insert").alias("k"), row.alias("r")))
        return source.select(F.explode(kinds).alias("x")).select("x.r.*", F.col("x.k").alias("_change_type"))
    kinds = dict(target.dtypes) | dict(source.dtypes)
    fill = lambda df: df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in columns], F.lit(True).alias("__in"))
    t, s = fill(target).alias("t"), fill(source).alias("s")
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    new, old = F.col("t.__in").isNull(), F.col("s.__in").isNull()
    changed = ~old & (F.lit(True) if when is None else F.coalesce(when, F.lit(False)))
    after = []
    for c in columns:
        mine, given = F.col(f"t.{c}"), F.col(f"s.{c}")
        takes = c not in keys and c in source.columns and (update is None or c in update)
        value = (put or {}).get(c, given) if takes or c in (put or {}) else mine
        after.append(F.when(new, given).when(changed, value).otherwise(mine).cast(kinds[c]).alias(c))
    before = F.when(~new, F.struct(*[F.col(f"t.{c}").alias(c) for c in columns]))
    both = t.join(s, cond, "full_outer").select(before.alias("b"), F.when(~old | ~F.lit(whole), F.struct(*after)).alias("a"))
    row = lambda kind, r: F.struct(F.lit(kind).cast("string").alias("k"), F.col(r).alias("r"))
    out = (
        F.when(F.col("b").isNull(), F.array(row(None, "a"), row("insert", "a")))
        .when(F.col("a").isNull(), F.array(row("delete", "b")))
        .when(F.col("b").eqNullSafe(F.col("a")), F.array(row(None, "a")))
        .otherwise(F.array(row(None, "a"), row("update_preimage", "b"), row("update_postimage", "a")))
    )
    return both.select(F.explode(out).alias("x")).select("x.r.*", F.col("x.k").alias("_change_type"))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str], version: int) -> DataFrame:
    """Rows that were inserted, deleted or changed (before and after), as a change feed would list them."""
    columns = new.columns
    kinds = dict(new.dtypes)
    o = old.select(*[(F.col(c) if c in old.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in columns]).withColumn("__row", F.struct(*columns)).alias("o")
    n = new.withColumn("__row", F.struct(*columns)).alias("n")
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"o.{k}") == F.col(f"n.{k}"))
    both = o.join(n, cond, "full_outer").select(F.col("o.__row").alias("before"), F.col("n.__row").alias("after")).where(~F.col("before").eqNullSafe(F.col("after")))
    change = lambda kind, row: F.struct(F.lit(kind).alias("_change_type"), row.alias("row"))
    kinds = (
        F.when(F.col("before").isNull(), F.array(change("insert", F.col("after"))))
        .when(F.col("after").isNull(), F.array(change("delete", F.col("before"))))
        .otherwise(F.array(change("update_preimage", F.col("before")), change("update_postimage", F.col("after"))))
    )
    out = both.select(F.explode(kinds).alias("c")).select("c.row.*", "c._change_type")
    return out.withColumn("_commit_version", F.lit(version).cast("long"))


def latest_changes(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Inserts and post-images, the newest version of each key."""
    from drayage.operators.dedup import keep_first

    kept = changes.where(F.col("_change_type").isin("insert", "update_postimage"))
    return keep_first(kept, keys, [F.desc("_commit_version")])

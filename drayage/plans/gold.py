"""The jobs that read and write gold tables: vehicle history and fleet snapshot, and their exports to a database."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drayage.operators import merge
from drayage.plans import jobs
from drayage.sources import jdbc
from drayage.sources.tables import load_position, merge_table, read_changes, read_table, require_nonempty, save_position, write_snapshot

#: Target tables of the exports, their keys, and the names under which their positions are kept.
ASSET_HISTORY = ("gold_asset_history_scd2", ["vin", "start_date"], "asset_version")
DRIVER_STANDING = ("gold_driver_standing", ["driver_id", "month_year"], "standing_version")
FUEL_AUDIT = ("gold_fuel_efficiency_audit", ["vin", "audit_date"], "fuel_version")


def vehicle_gold(spark: SparkSession, assignments: DataFrame, registry: DataFrame, gold: str, version: int) -> None:
    """Merge assignments into the asset history by vehicle and start, and write the fleet snapshot.

    Of two end dates the earlier stays, so a suspension outlasts the daily merge. Without active vehicles, or without a
    registry, the snapshot stays as it was.
    """
    history = jobs.asset_history(require_nonempty(assignments, "assignments"))
    earlier = {"end_date": F.least("t.end_date", "s.end_date")}
    merge_table(history, f"{gold}/asset_history", str(version), ["vin", "start_date"], start_month(), put=earlier)
    fleet = jobs.fleet_snapshot(history, registry)
    if not fleet.isEmpty():
        write_snapshot(fleet.orderBy(F.desc("no_of_active_vehicles"), "model").coalesce(1), f"{gold}/fleet_snapshot", version, keep=10)


def start_month() -> Column:
    """The part of the asset history that an assignment lies in."""
    return F.date_format("start_date", "yyyy-MM")


def end_suspended(spark: SparkSession, history: DataFrame, ended: DataFrame, path: str, run: str) -> int:
    """End the assignments of ended(driver_id, vin, suspended_date) in the asset history, with change rows; returns the version."""
    later = F.col("end_date").isNull() | (F.col("end_date") > F.col("__at"))
    first = ended.groupBy("driver_id", "vin").agg(F.min("suspended_date").alias("__at"))
    rows = history.join(first, ["driver_id", "vin"]).where(later).select("vin", "start_date", F.col("__at").alias("end_date"))
    return merge_table(rows, path, run, ["vin", "start_date"], start_month(), update=["end_date"])


def pending(changes: DataFrame, keys: list[str]) -> tuple[DataFrame, int | None]:
    """(what a database is to be told: inserts and post-images, the newest of each key; the newest version among all changes)."""
    return merge.latest_changes(changes, keys).drop("_change_type", "_commit_version"), changes.agg(F.max("_commit_version")).first()[0]


def export_changes(spark: SparkSession, path: str, target: tuple[str, list[str], str], positions: str, url: str, properties: dict[str, str]) -> int | None:
    """Upsert what a published table changed since the saved position, then advance it. Returns the newest version, if any.

    The position moves after the database has the rows, and an upsert may come twice: a run that fails in between is repeated.
    """
    name, keys, key = target
    changes = read_changes(spark, path, load_position(spark, positions, key))
    if changes is None:
        return None
    rows, newest = pending(changes, keys)
    if newest is None:
        return None
    if not rows.isEmpty():
        jdbc.staged_upsert(rows, url, name, keys, properties)
    save_position(spark, positions, {key: newest + 1})
    return newest


def export_snapshot(spark: SparkSession, path: str, table: str, url: str, properties: dict[str, str], keys: list[str] | None = None) -> bool:
    """Overwrite a database table by the newest snapshot; an empty or missing one leaves it alone."""
    df = read_table(spark, path)
    if df is None or df.isEmpty():
        return False
    jdbc.overwrite(df, url, table, properties, keys)
    return True

"""The batch jobs from bronze to silver: each reads a feed's bronze table, labels and archives, and publishes what is clean.

A job works its labels out once: it writes the labelled rows, with counters that come along with that write, and the archive and
the merges read them back. Every job returns its counters: rows in all, clean ones, and those of each label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drayage.functions.values import epoch_date, lenient_date, lenient_timestamp, number
from drayage.operators import quality
from drayage.plans import jobs
from drayage.sources.tables import archive, key_bucket, merge_table, read_table, require_nonempty


#: The labels of each feed's rules.
LABELS = {
    "registry": ["INVALID_REGISTRY_RECORD", "SAME_VIN_SAME_YEAR_DIFFERENT_MODEL"],
    "assignment": ["INVALID_ASSIGNMENT_RECORD", "UNKNOWN_VIN"],
    "fuel": ["Negative or zero fuel", "Null keys", "Duplicate txn+timestamp", "Old txn", "Future timestamp", "Odometer rollback", "Soft duplicate", "Null non-key"],
    "maintenance": ["Null or Invalid Key", "Duplicate Maintenance Record"],
}


def _written(labelled: DataFrame, archives: str, feed: str, version: int) -> tuple[DataFrame, dict[str, int]]:
    """The labelled rows, written once and read back, and the counters of that write."""
    spark, path = labelled.sparkSession, f"{archives}/_labelled/{feed}"
    rules = {"clean": F.col("error_reason").isNull()} | {x: F.col("error_reason") == x for x in LABELS[feed]}
    watched, counts = quality.observed(labelled, f"{feed}-{version}", rules)
    watched.write.mode("overwrite").parquet(path)
    rows = spark.read.schema(labelled.schema).parquet(path)
    archive(quality.split(rows)[1], f"{archives}/{feed}", str(version), "error_reason")
    return rows, dict(counts.get)


def registry(spark: SparkSession, bronze: str, silver: str, archives: str, version: int, as_of: str) -> dict[str, int]:
    """The newest day's rows by rules, conflicts archived, one row of each vin, merged by vin."""
    rows = jobs.latest_batch(spark.read.parquet(bronze)).select("vin", "model", "mfg_year", "fuel_type")
    labelled, counts = _written(jobs.registry_labelled(rows, as_of), archives, "registry", version)
    merge_table(jobs.registry_clean(labelled).select("vin", "model", "mfg_year", "fuel_type"), silver, str(version), ["vin"], key_bucket("vin"))
    return counts


def assignment(spark: SparkSession, bronze: str, registry_silver: str, silver: str, archives: str, version: int) -> dict[str, int]:
    """Epoch seconds to dates, rules, known vehicles, one assignment a vehicle and day, end dates and status, merged by vin and start."""
    known = require_nonempty(read_table(spark, registry_silver), "registry")
    raw = spark.read.parquet(bronze).select(
        "vin", "driver_id", epoch_date("start_timestamp").alias("start_date"), epoch_date("end_timestamp").alias("end_date"), number("daily_rate").alias("daily_rate"), "region",
        F.col("ingestion_time").alias("ingestion_seq"),
    )
    labelled, counts = _written(jobs.assignment_labelled(raw, known), archives, "assignment", version)
    history, twice = jobs.assignment_clean(labelled)
    archive(twice.select(*labelled.columns), f"{archives}/assignment_conflicts", str(version), "error_reason")
    merge_table(jobs.asset_history(history), silver, str(version), ["vin", "start_date"], F.date_format("start_date", "yyyy-MM"))
    return counts


def fuel(spark: SparkSession, bronze: str, silver: str, archives: str, version: int, as_of: str) -> dict[str, int]:
    """Typed rows through the cascade; clean rows and distances merged by transaction."""
    raw = spark.read.parquet(bronze).select(
        "transaction_id", "vin", number("fuel_liters").alias("fuel_liters"), number("odometer_reading").alias("odometer_reading"), lenient_timestamp("timestamp").alias("timestamp"), "_row_hash"
    )
    labelled, counts = _written(jobs.fuel_labelled(raw, as_of, ["_row_hash"]), archives, "fuel", version)
    clean = quality.split(labelled)[0].drop("_row_hash")
    for name, rows in (("clean", clean), ("distance", jobs.fuel_distance(clean))):
        merge_table(rows, f"{silver}/{name}", str(version), ["transaction_id"], key_bucket("transaction_id"), sort=["vin", "timestamp"])
    return counts


def maintenance(spark: SparkSession, bronze: str, silver: str, archives: str, version: int) -> dict[str, int]:
    """Text dates, rules, the newest of repeated services, merged by vehicle, day and service."""
    raw = spark.read.parquet(bronze).select("vin", lenient_date("service_date").alias("service_date"), "service_type", F.struct("ingestion_time", "_row_hash").alias("ingestion_seq"))
    labelled, counts = _written(jobs.maintenance_labelled(raw), archives, "maintenance", version)
    clean = quality.split(labelled)[0].drop("ingestion_seq").withColumn("service_year", F.year("service_date")).withColumn("service_month", F.month("service_date"))
    merge_table(clean, silver, str(version), ["vin", "service_date", "service_type"], F.date_format("service_date", "yyyy-MM"))
    return counts


def fuel_audit(spark: SparkSession, fuel_silver: str, registry_silver: str, history: str, maintenance_silver: str, gold: str, version: int) -> None:
    """The efficiency audit of all silver tables, published by vehicle and day."""
    read = lambda path, name: require_nonempty(read_table(spark, path), name)
    services = read_table(spark, maintenance_silver)
    distance = read(f"{fuel_silver}/distance", "fuel distances")
    if services is None:
        services = spark.createDataFrame([], "vin string, service_date date")
    audit = jobs.fuel_audit(distance, read(registry_silver, "registry"), read(history, "asset history"), services)
    merge_table(audit, gold, str(version), ["vin", "audit_date"], F.date_format("audit_date", "yyyy-MM"), whole=True)

"""The batch jobs as plans over DataFrames: feeds in, audited tables out. Nothing here reads or writes paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drayage.functions.values import blank, key
from drayage.operators import dedup, geo, history, odometer, quality, rolling, strikes


def latest_batch(df: DataFrame, batch: str = "ingestion_date") -> DataFrame:
    """Rows of the newest ingestion: a join with one aggregated row, without a round trip to the driver."""
    return df.join(F.broadcast(df.agg(F.max(batch).alias("__newest"))), F.col(batch) == F.col("__newest")).drop("__newest")


def registry_labelled(raw: DataFrame, as_of: str) -> DataFrame:
    """Rules, then conflicts: vins registered in one year under two models are all quarantined."""
    r = raw.withColumn("vin", key("vin")).withColumn("model", F.trim("model")).withColumn("fuel_type", key("fuel_type")).withColumn("mfg_year", F.col("mfg_year").try_cast("int"))
    bad = blank("vin") | blank("model") | blank("fuel_type") | (F.length("vin") != 8) | F.col("mfg_year").isNull() | (F.col("mfg_year") > F.year(F.lit(as_of).cast("date")))
    r = quality.label(r, [("INVALID_REGISTRY_RECORD", bad)])
    clash = dedup.conflicting(r.where("error_reason IS NULL"), ["vin", "mfg_year"], "model").withColumn("__clash", F.lit(True))
    r = r.join(clash, ["vin", "mfg_year"], "left")
    return quality.relabel(r, "SAME_VIN_SAME_YEAR_DIFFERENT_MODEL", F.col("__clash")).drop("__clash")


def registry_clean(labelled: DataFrame) -> DataFrame:
    clean, _ = quality.split(labelled)
    return dedup.keep_first(clean, ["vin"], [F.desc("mfg_year"), F.col("model"), F.col("fuel_type")])


def assignment_labelled(raw: DataFrame, registry: DataFrame) -> DataFrame:
    """Keys, region, a positive rate and dates in order, then the registry. A feed without end_date has open assignments."""
    a = raw.withColumn("vin", key("vin")).withColumn("driver_id", key("driver_id")).withColumn("region", F.trim("region"))
    ok = ~blank("vin") & ~blank("driver_id") & ~blank("region") & (F.col("daily_rate") > 0) & F.col("start_date").isNotNull()
    if "end_date" in raw.columns:
        ok = ok & (F.col("end_date").isNull() | (F.col("end_date") >= F.col("start_date")))
    a = quality.label(a, [("INVALID_ASSIGNMENT_RECORD", ~F.coalesce(ok, F.lit(False)))])
    known = registry.select("vin").distinct().withColumn("__known", F.lit(True))
    return quality.relabel(a.join(known, "vin", "left"), "UNKNOWN_VIN", F.col("__known").isNull()).drop("__known")


def assignment_clean(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(history rows with end dates and status, rows rejected because their driver had another vehicle that day)."""
    clean, _ = quality.split(labelled)
    best = dedup.keep_first(clean, ["vin", "start_date"], [F.desc("daily_rate"), F.desc("ingestion_seq")])
    kept, twice = dedup.split_first(best, ["driver_id", "start_date"], [F.desc("daily_rate"), F.desc("ingestion_seq")])
    hist = history.end_by_next(kept, ["vin"]).withColumn("status", history.status())
    return hist, twice.withColumn("error_reason", F.lit("DRIVER_MULTI_ASSIGNMENT_CONFLICT"))


def fuel_labelled(raw: DataFrame, as_of: str, ties: list[str]) -> DataFrame:
    """The cascade: each rule sees the rows that earlier rules left. Groups with repeated id and time, or with the same
    vehicle, time and litres, lose all members."""
    f = raw.withColumn("vin", key("vin"))
    f = quality.label(f, [
        ("Negative or zero fuel", F.col("fuel_liters") <= 0),
        ("Null keys", F.col("transaction_id").isNull() | F.col("vin").isNull() | F.col("timestamp").isNull()),
    ])
    keyless = F.col("transaction_id").isNull() | F.col("vin").isNull() | F.col("timestamp").isNull()
    # rows without keys have their label: whom they meet does not matter, so they are spread
    f = f.withColumn("__spread", F.when(keyless, F.monotonically_increasing_id() % 4096))
    clean = F.col("error_reason").isNull()
    # dealt by transaction once: the two rules on it need no other shuffle
    f = f.repartition("transaction_id", "__spread")
    f = quality.relabel(f, "Duplicate txn+timestamp", dedup.group_size(["transaction_id", "__spread", "timestamp"], clean) > 1)
    # newest first among those still clean; a labelled row sorts last
    order = [F.when(clean, 0).otherwise(1), F.desc("timestamp"), *[F.col(c) for c in ties]]
    f = quality.relabel(f, "Old txn", dedup.place(["transaction_id", "__spread"], order) > 1)
    f = quality.relabel(f, "Future timestamp", F.col("timestamp") > F.lit(as_of).cast("timestamp"))
    f = f.repartition("vin", "__spread")
    f = quality.relabel(f, "Odometer rollback", F.col("odometer_reading") < odometer.running_max(["vin", "__spread"], ["timestamp", "transaction_id"], "odometer_reading", clean))
    f = quality.relabel(f, "Soft duplicate", dedup.group_size(["vin", "__spread", "timestamp", "fuel_liters"], clean) > 1)
    return quality.relabel(f, "Null non-key", F.col("fuel_liters").isNull() | F.col("odometer_reading").isNull()).drop("__spread")


def fuel_distance(clean: DataFrame) -> DataFrame:
    return odometer.distances(clean, ["vin"], ["timestamp", "transaction_id"], "odometer_reading", "fuel_liters")


def maintenance_labelled(raw: DataFrame) -> DataFrame:
    m = raw.withColumn("vin", key("vin")).withColumn("service_type", key("service_type"))
    m = quality.label(m, [("Null or Invalid Key", F.col("vin").isNull() | F.col("service_date").isNull() | F.col("service_type").isNull())])
    place = dedup.place(["vin", "service_date", "service_type", F.col("error_reason").isNull()], [F.desc("ingestion_seq")])
    return quality.relabel(m, "Duplicate Maintenance Record", place > 1)


def asset_history(assignments: DataFrame) -> DataFrame:
    """The gold history: every assignment of a vehicle with its dates and status."""
    return assignments.select("vin", "driver_id", "start_date", "end_date", "daily_rate", "region", "status")


def fleet_snapshot(asset_history: DataFrame, registry: DataFrame) -> DataFrame:
    """Active vehicles of each model."""
    active = asset_history.where("status = 'IN-TRANSIT'").select("vin").join(registry.select("vin", "model"), "vin")
    return active.groupBy("model").agg(F.count(F.lit(1)).alias("no_of_active_vehicles"))


def fuel_audit(distance: DataFrame, registry: DataFrame, asset_history: DataFrame, maintenance: DataFrame, days: int = 30, factor: float = 0.88, weekend: tuple[int, ...] = (1, 7), fanout: bool = False) -> DataFrame:
    """Kilometres per litre of vehicle-days against the median of their model and fuel type over the days before."""
    d = distance.withColumn("txn_date", F.to_date("timestamp")).select("vin", "txn_date", "distance", "fuel_liters")
    d = d.where(~F.dayofweek("txn_date").isin(*weekend)).join(registry.select("vin", "model", "fuel_type"), "vin")
    d = history.interval_join(d, asset_history.select("vin", "start_date", "end_date"), {"vin": "vin"}, "txn_date").drop("start_date", "end_date")
    served = maintenance.select("vin", F.col("service_date").alias("txn_date")).distinct()
    d = d.join(served, ["vin", "txn_date"], "left_anti")
    daily = d.groupBy("vin", "model", "fuel_type", "txn_date").agg(F.sum("distance").alias("km"), F.sum("fuel_liters").alias("liters"))
    daily = daily.withColumn("km_per_liter", F.try_divide("km", "liters"))
    median = rolling.rolling_median_fanout if fanout else rolling.rolling_median
    daily = median(daily, ["model", "fuel_type"], "txn_date", "km_per_liter", days, "baseline_kmpl")
    verdict = F.when(F.col("km_per_liter").isNull() | F.col("baseline_kmpl").isNull(), "INSUFFICIENT_DATA")
    verdict = verdict.when(F.col("km_per_liter") < F.col("baseline_kmpl") * factor, "FLAGGED").otherwise("OK")
    return daily.select("vin", "model", F.col("txn_date").alias("audit_date"), "km_per_liter", "baseline_kmpl", verdict.alias("status"), "fuel_type")


def telemetry_labelled(raw: DataFrame) -> DataFrame:
    t = raw.withColumn("vin", key("vin")).withColumn("driver_id", key("driver_id"))
    missing = F.lit(False)
    for c in ("vin", "driver_id", "event_timestamp", "lat", "long", "speed"):
        missing = missing | F.col(c).isNull()
    return quality.label(t, [
        ("NULL_KEY", missing),
        ("GPS_ZERO_ERROR", (F.col("lat") == 0) & (F.col("long") == 0)),
        ("GPS_OUT_OF_RANGE", ~F.col("lat").between(-90, 90) | ~F.col("long").between(-180, 180)),
        ("NEGATIVE_SPEED_ERROR", F.col("speed") < 0),
    ])


def trips(clean: DataFrame, assignments: DataFrame, sweep: bool = False) -> DataFrame:
    """VALID, GHOST_TRIP (no assignment of the vehicle then) or SHADOW_ASSIGNMENT (another driver's).

    sweep: for assignments that do not overlap, without a join.
    """
    hist = assignments.select("vin", F.col("driver_id").alias("assigned_driver"), "start_date", "end_date")
    day = clean.withColumn("__day", F.to_date("event_timestamp"))
    join = history.sweep_join if sweep else history.interval_join
    j = join(day, hist, {"vin": "vin"}, "__day", how="left").drop("__day")
    kind = F.when(F.col("start_date").isNull(), "GHOST_TRIP").when(F.col("assigned_driver") != F.col("driver_id"), "SHADOW_ASSIGNMENT").otherwise("VALID")
    reason = F.when(F.col("trip_type") == "GHOST_TRIP", "No assignment found").when(F.col("trip_type") == "SHADOW_ASSIGNMENT", "Driver mismatch")
    return j.withColumn("trip_type", kind).withColumn("audit_reason", reason)


def violations(clean: DataFrame, zones: DataFrame, limit: int = 110) -> DataFrame:
    t = geo.point_in_zone(clean, zones, "event_id")
    t = t.withColumn("is_speeding", F.coalesce(F.col("speed") > limit, F.lit(False)))
    t = t.withColumn("is_violation", F.col("is_speeding") | F.col("is_zone_breach"))
    return t.withColumn("strike_type", strikes.strike_type())


def incidents(found: DataFrame, assignments: DataFrame, existing: DataFrame | None = None, standing: DataFrame | None = None) -> DataFrame:
    """Sessions as numbered, priced incidents; those already in `existing` and those after a suspension go."""
    new = strikes.incident_ids(found)
    if existing is not None:
        new = new.join(existing.select("strike_id"), "strike_id", "left_anti")
    if standing is not None:
        new = strikes.before_suspension(new, standing)
    hist = assignments.select("vin", "driver_id", "start_date", "end_date", F.col("daily_rate").alias("base_rate"))
    day = new.withColumn("__day", F.to_date("incident_ts"))
    # sessions without an assignment have no rate: unassigned() has them
    rated = history.interval_join(day, hist, {"vin": "vin", "driver_id": "driver_id"}, "__day").drop("__day", "start_date", "end_date")
    prior = None if existing is None else strikes.prior_counts(existing, rated)
    return strikes.penalties(strikes.number_strikes(rated, prior)).drop("start_ts", "end_ts")


def unassigned(found: DataFrame, assignments: DataFrame) -> DataFrame:
    """Sessions of a driver and vehicle that no assignment covers: they are numbered nowhere and go to an archive."""
    new = strikes.incident_ids(found).withColumn("__day", F.to_date("incident_ts"))
    hist = assignments.select("vin", "driver_id", "start_date", "end_date")
    return history.interval_join(new, hist, {"vin": "vin", "driver_id": "driver_id"}, "__day", how="left").where("start_date IS NULL").drop("__day", "start_date", "end_date")

"""Violation sessions, numbered strikes, penalties and monthly standings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from drayage.functions.values import surrogate_id


def strike_type(speeding: str = "is_speeding", breach: str = "is_zone_breach") -> Column:
    s, b = F.col(speeding), F.col(breach)
    return F.when(s & b, "ZONE_BREACH_OVERSPEEDING").when(b, "ZONE_BREACH").when(s, "OVERSPEEDING")


def sessions(violations: DataFrame, gap: str = "5 minutes", moment: str = "event_timestamp") -> DataFrame:
    """Violations of a driver and vehicle no more than `gap` apart are one incident.

    Greatest speed, the earliest named zone, and the greatest strike type by name. Works on streams (set a watermark) and
    on tables.
    """
    w = F.session_window(moment, gap)
    named = F.min(F.when(F.col("breached_zone_name").isNotNull(), F.struct(moment, "breached_zone_name")))["breached_zone_name"]
    out = violations.groupBy("driver_id", "vin", w.alias("session")).agg(
        F.max("speed").alias("max_speed"), named.alias("zone_name"), F.max("strike_type").alias("strike_type")
    )
    return out.select("driver_id", "vin", F.col("session.start").alias("start_ts"), F.col("session.end").alias("end_ts"), "max_speed", "zone_name", "strike_type")


def incident_ids(found: DataFrame) -> DataFrame:
    """strike_id, incident_ts and month_year of sessions: the same session always has the same id."""
    stamp = found.withColumn("__at", F.date_format("start_ts", "yyyy-MM-dd HH:mm:ss"))
    stamp = stamp.withColumn("strike_id", surrogate_id(["driver_id", "vin", "__at"])).drop("__at")
    return stamp.withColumn("incident_ts", F.col("start_ts")).withColumn("month_year", F.date_format("start_ts", "yyyy-MM"))


def before_suspension(incidents: DataFrame, standing: DataFrame) -> DataFrame:
    """Incidents of drivers not suspended, or before their earliest suspension."""
    first = standing.where("status = 'SUSPENDED'").groupBy("driver_id").agg(F.min("suspension_date").alias("__from"))
    return incidents.join(first, "driver_id", "left").where("__from IS NULL OR incident_ts < __from").drop("__from")


def prior_counts(history: DataFrame, months: DataFrame) -> DataFrame:
    """Highest strike number of each driver-month, reading only the months of the batch."""
    return history.join(months.select("month_year").distinct(), "month_year", "left_semi").groupBy("driver_id", "month_year").agg(F.max("strike_number").alias("prev_strikes"))


def number_strikes(incidents: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """strike_number: place within the driver's month by time (ties by id), after what the month had before."""
    seq = F.row_number().over(Window.partitionBy("driver_id", "month_year").orderBy("incident_ts", "strike_id"))
    out = incidents.withColumn("__seq", seq)
    if prior is None:
        return out.withColumnRenamed("__seq", "strike_number")
    out = out.join(prior, ["driver_id", "month_year"], "left").fillna({"prev_strikes": 0})
    return out.withColumn("strike_number", (F.col("prev_strikes") + F.col("__seq")).cast("int")).drop("prev_strikes", "__seq")


def penalties(strikes: DataFrame, limit: int = 10, step: float = 0.05) -> DataFrame:
    """Deduction of step x number of the base rate, all of it at the limit; strikes past the limit go."""
    rate, n = F.col("base_rate"), F.col("strike_number")
    out = strikes.where(n <= limit).withColumn("base_rate", F.round("base_rate", 2))
    out = out.withColumn("deduction_amount", F.round(F.when(n < limit, rate * n * step).otherwise(rate), 2))
    out = out.withColumn("adjusted_rate", F.round(F.when(n >= limit, 0.0).otherwise(rate - F.col("deduction_amount")), 2))
    return out.withColumn("status_after_strike", F.when(n >= limit, "SUSPENDED").otherwise("ACTIVE"))


def standings(incidents: DataFrame, limit: int = 10) -> DataFrame:
    """One row for each driver and month: strikes, deductions and payable rate over the days' last states."""
    daily = incidents.groupBy("driver_id", "month_year", F.to_date("incident_ts").alias("day")).agg(
        F.max("strike_number").alias("strikes"), F.max("deduction_amount").alias("deduction"), F.min("adjusted_rate").alias("rate"), F.max("incident_created_ts").alias("created")
    )
    monthly = daily.groupBy("driver_id", "month_year").agg(
        F.max("strikes").alias("current_strikes"),
        # money adds up in decimals, so the order of rows does not show
        F.sum(F.col("deduction").cast("decimal(18,2)")).cast("double").alias("total_deductions"),
        F.sum(F.col("rate").cast("decimal(18,2)")).cast("double").alias("final_payable_rate"),
        F.max("created").alias("created_ts"),
    )
    monthly = monthly.withColumn("status", F.when(F.col("current_strikes") >= limit, "SUSPENDED").otherwise("ACTIVE"))
    return monthly.withColumn("suspension_date", F.when(F.col("status") == "SUSPENDED", F.to_date("created_ts")))


#: The text of the report.
REPORT = """Monthly Driver rate deduction report:
Report Includes:
Driver ID: %s
Total strikes for the month: %s
Total rate deductions: %s
Final payable daily rate: %s
Suspension status: %s
Suspension date: %s
------------------------------------
"""


def report_lines(standing: DataFrame) -> DataFrame:
    """One text block for each driver."""
    names = ["driver_id", "current_strikes", "total_deductions", "final_payable_rate", "status"]
    values = [*(F.col(c).cast("string") for c in names), F.coalesce(F.col("suspension_date").cast("string"), F.lit("N/A"))]
    return standing.select("driver_id", F.format_string(REPORT, *values).alias("value"))

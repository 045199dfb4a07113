"""Registered fleet queries over the adapted tables, each with its DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drayage.functions.values import epoch_date, lenient_date, lenient_timestamp, row_hash, surrogate_id
from drayage.operators import dedup, history, merge, quality, rolling, strikes
from drayage.plans import jobs
from drayage.plans.adapters import AS_OF, DUCKDB, fleet
from drayage.sources.tables import z_code

FUEL_AS_OF = "1998-06-01"
TIES = ["seq", "seq2", "seq3", "seq4"]
GAP = "8 hours"


class Tables:
    """The fleet tables of one folder and the plans over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return fleet(self.spark, self.dir, name)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def registry(self) -> DataFrame:
        return jobs.registry_clean(jobs.registry_labelled(self.raw("registry"), AS_OF))

    def assignment(self) -> tuple[DataFrame, DataFrame]:
        return jobs.assignment_clean(jobs.assignment_labelled(self.raw("assignment"), self.registry()))

    def fuel(self) -> DataFrame:
        return jobs.fuel_labelled(self.raw("fuel"), FUEL_AS_OF, TIES)

    def distance(self) -> DataFrame:
        return jobs.fuel_distance(quality.split(self.fuel())[0])

    def maintenance(self) -> DataFrame:
        return quality.split(jobs.maintenance_labelled(self.raw("maintenance")))[0]

    def audit(self, fanout: bool = False) -> DataFrame:
        return jobs.fuel_audit(self.distance(), self.registry(), self.assignment()[0], self.maintenance(), fanout=fanout)

    def telemetry(self) -> DataFrame:
        return quality.split(jobs.telemetry_labelled(self.raw("telemetry")))[0]

    def violations(self) -> DataFrame:
        return jobs.violations(self.telemetry(), self.raw("zones"))

    def sessions(self) -> DataFrame:
        return strikes.sessions(self.violations().where("is_violation"), GAP)

    def incidents(self) -> DataFrame:
        out = jobs.incidents(self.sessions(), self.raw("telemetry_assignment"))
        return out.withColumn("incident_created_ts", F.col("incident_ts"))

    def daily_ratio(self) -> DataFrame:
        f = self.table("lineitem").groupBy("l_returnflag", F.to_date("l_shipdate").alias("day"), "l_suppkey").agg(F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("n"))
        return f.select("l_returnflag", "day", "l_suppkey", (F.col("q") / F.col("n")).alias("ratio"))


def _cte(*names: str) -> str:
    return "with " + ", ".join(f'{n}_raw as ({DUCKDB[n]})' for n in names)


REGISTRY = f"""registry_lab as (select *, (vin is null or trim(vin) = '' or trim(model) = '' or trim(fuel_type) = '' or length(trim(vin)) <> 8 or mfg_year > 2024) bad from registry_raw),
  clash as (select vin, mfg_year from registry_lab where not bad group by 1, 2 having count(distinct model) > 1),
  registry as (select vin, model, fuel_type, mfg_year from (select r.*, row_number() over (partition by vin order by mfg_year desc, model, fuel_type) n
    from registry_lab r where not bad and (vin, mfg_year) not in (select vin, mfg_year from clash)) where n = 1)"""
ASSIGN = """best as (select * from (select a.*, row_number() over (partition by vin, start_date order by daily_rate desc, ingestion_seq desc) n
    from assignment_raw a where daily_rate > 0 and trim(region) <> '' and (end_date is null or end_date >= start_date) and vin in (select vin from registry)) where n = 1),
  ranked as (select * exclude (n), row_number() over (partition by driver_id, start_date order by daily_rate desc, ingestion_seq desc) m from best),
  hist as (select vin, driver_id, start_date, lead(start_date) over (partition by vin order by start_date) end_date, daily_rate, region, ingestion_seq from ranked where m = 1)"""
FUEL = f"""f1 as (select *, case when fuel_liters <= 0 then 'Negative or zero fuel' end e from fuel_raw),
  f2 as (select * exclude (e), coalesce(e, case when count(case when e is null then 1 end) over (partition by transaction_id, "timestamp") > 1 then 'Duplicate txn+timestamp' end) e from f1),
  f3 as (select * exclude (e), coalesce(e, case when row_number() over (partition by transaction_id order by case when e is null then 0 else 1 end, "timestamp" desc, seq, seq2, seq3, seq4) > 1 then 'Old txn' end) e from f2),
  f4 as (select * exclude (e), coalesce(e, case when "timestamp" > timestamp '{FUEL_AS_OF}' then 'Future timestamp' end) e from f3),
  f5 as (select * exclude (e), coalesce(e, case when odometer_reading < max(case when e is null then odometer_reading end) over (partition by vin order by "timestamp", transaction_id rows between unbounded preceding and 1 preceding) then 'Odometer rollback' end) e from f4),
  f6 as (select * exclude (e), coalesce(e, case when count(case when e is null then 1 end) over (partition by vin, "timestamp", fuel_liters) > 1 then 'Soft duplicate' end) e from f5),
  dist as (select * from (select transaction_id, vin, "timestamp", fuel_liters, odometer_reading, lag(odometer_reading) over (partition by vin order by "timestamp", transaction_id) prev_odo from f6 where e is null)
    where odometer_reading - prev_odo > 0)"""
MAINT = """maint as (select distinct vin, service_date from maintenance_raw)"""
AUDIT = f"""days as (select d.vin, model, fuel_type, cast("timestamp" as date) audit_date, sum(odometer_reading - prev_odo) / sum(fuel_liters) km_per_liter
    from dist d join registry r on d.vin = r.vin join hist h on h.vin = d.vin and h.start_date <= cast("timestamp" as date) and (h.end_date is null or cast("timestamp" as date) < h.end_date)
    where dayofweek(cast("timestamp" as date)) not in (0, 6) and (d.vin, cast("timestamp" as date)) not in (select vin, service_date from maint) group by 1, 2, 3, 4),
  audit as (select *, case when km_per_liter is null or baseline_kmpl is null then 'INSUFFICIENT_DATA' when km_per_liter < baseline_kmpl * 0.88 then 'FLAGGED' else 'OK' end status
    from (select *, quantile_disc(km_per_liter, 0.5) over (partition by model, fuel_type order by audit_date range between interval 30 days preceding and interval 1 days preceding) baseline_kmpl from days))"""
TELE = """tele as (select *, case when lat = 0 and long = 0 then 'GPS_ZERO_ERROR' when not (lat between -90 and 90) or not (long between -180 and 180) then 'GPS_OUT_OF_RANGE'
    when speed < 0 then 'NEGATIVE_SPEED_ERROR' end e from telemetry_raw)"""
VIOL = """hits as (select event_id, min(zone_name) breached_zone_name from tele join zones_raw on lat between min_lat and max_lat and long between min_long and max_long where e is null group by 1),
  viol as (select t.*, breached_zone_name, breached_zone_name is not null is_zone_breach, speed > 110 is_speeding, speed > 110 or breached_zone_name is not null is_violation,
    case when speed > 110 and breached_zone_name is not null then 'ZONE_BREACH_OVERSPEEDING' when breached_zone_name is not null then 'ZONE_BREACH' when speed > 110 then 'OVERSPEEDING' end strike_type
    from tele t left join hits using (event_id) where e is null)"""
SESS = """steps as (select *, case when event_timestamp - lag(event_timestamp) over (partition by driver_id, vin order by event_timestamp) <= interval 8 hours then 0 else 1 end s from viol where is_violation),
  numbered as (select *, sum(s) over (partition by driver_id, vin order by event_timestamp rows unbounded preceding) g from steps),
  sess as (select driver_id, vin, min(event_timestamp) start_ts, max(event_timestamp) + interval 8 hours end_ts, max(speed) max_speed,
    arg_min(breached_zone_name, event_timestamp) filter (where breached_zone_name is not null) zone_name, max(strike_type) strike_type from numbered group by driver_id, vin, g)"""
INC = """rated as (select s.*, start_ts incident_ts, strftime(start_ts, '%Y-%m') month_year, sha256(driver_id || '|' || vin || '|' || strftime(start_ts, '%Y-%m-%d %H:%M:%S')) strike_id, daily_rate base_rate
    from sess s join telemetry_assignment_raw a using (driver_id, vin) where a.start_date <= cast(start_ts as date) and (a.end_date is null or cast(start_ts as date) < a.end_date)),
  seq as (select *, row_number() over (partition by driver_id, month_year order by incident_ts, strike_id) strike_number from rated),
  inc as (select *, round(case when strike_number < 10 then base_rate * strike_number * 0.05 else base_rate end, 2) deduction_amount from seq where strike_number <= 10),
  inc2 as (select *, round(case when strike_number >= 10 then 0 else base_rate - deduction_amount end, 2) adjusted_rate, case when strike_number >= 10 then 'SUSPENDED' else 'ACTIVE' end status_after_strike from inc)"""
STAND = """daily as (select driver_id, month_year, cast(incident_ts as date) d, max(strike_number) k, max(deduction_amount) a, min(adjusted_rate) r, max(incident_ts) c from inc2 group by 1, 2, 3),
  standing as (select driver_id, month_year, max(k) current_strikes, sum(a::decimal(18,2))::double total_deductions, sum(r::decimal(18,2))::double final_payable_rate, case when max(k) >= 10 then 'SUSPENDED' else 'ACTIVE' end status,
    case when max(k) >= 10 then cast(max(c) as date) end suspension_date from daily group by 1, 2)"""
ALL_BATCH = _cte("registry", "assignment", "fuel", "maintenance") + f", {REGISTRY}, {ASSIGN}, {FUEL}, {MAINT}, {AUDIT} "
ALL_TELE = _cte("telemetry", "telemetry_assignment", "zones") + f", {TELE}, {VIOL}, {SESS}, {INC}, {STAND} "
_RATIO = "select l_returnflag, cast(l_shipdate as date) as day, l_suppkey, sum(l_quantity) / count(*) ratio from lineitem group by 1, 2, 3"
_MEDIAN = f"select *, quantile_disc(ratio, 0.5) over (partition by l_returnflag order by day range between interval 30 days preceding and interval 1 days preceding) baseline from ({_RATIO})"
OLD, NEW = "o_orderkey % 5 <> 0", "o_orderkey % 3 = 0"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        _QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


@query(ALL_BATCH + "select vin, model, audit_date, km_per_liter, baseline_kmpl, status, fuel_type from audit")
def fuel_audit(t: Tables) -> DataFrame:
    return t.audit()


@query(ALL_BATCH + "select vin, model, audit_date, km_per_liter, baseline_kmpl, status, fuel_type from audit")
def fuel_audit_fanout(t: Tables) -> DataFrame:
    return t.audit(fanout=True)


@query(ALL_BATCH + "select status, count(*) n from audit group by 1")
def audit_tallies(t: Tables) -> DataFrame:
    return t.audit().groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(ALL_BATCH + "select vin, model, audit_date, km_per_liter from audit where status = 'FLAGGED' order by audit_date desc, vin, model limit 10")
def flagged_top10(t: Tables) -> DataFrame:
    return t.audit().where("status = 'FLAGGED'").select("vin", "model", "audit_date", "km_per_liter").orderBy(F.desc("audit_date"), "vin", "model").limit(10)


@query(_MEDIAN)
def rolling_median(t: Tables) -> DataFrame:
    return rolling.rolling_median(t.daily_ratio(), ["l_returnflag"], "day", "ratio")


@query(_MEDIAN)
def rolling_median_fanout(t: Tables) -> DataFrame:
    return rolling.rolling_median_fanout(t.daily_ratio(), ["l_returnflag"], "day", "ratio")


@query(ALL_BATCH + "select transaction_id, vin, fuel_liters, odometer_reading, \"timestamp\" from f6 where e is null")
def fuel_clean(t: Tables) -> DataFrame:
    return quality.split(t.fuel())[0].select("transaction_id", "vin", "fuel_liters", "odometer_reading", "timestamp")


@query(ALL_BATCH + "select transaction_id, vin, fuel_liters, odometer_reading, \"timestamp\", e error_reason from f6 where e is not null")
def fuel_errors(t: Tables) -> DataFrame:
    return quality.split(t.fuel())[1].select("transaction_id", "vin", "fuel_liters", "odometer_reading", "timestamp", "error_reason")


@query(ALL_BATCH + "select transaction_id, vin, prev_odo, odometer_reading - prev_odo distance, (odometer_reading - prev_odo) / fuel_liters mileage from dist")
def fuel_distance(t: Tables) -> DataFrame:
    return t.distance().select("transaction_id", "vin", "prev_odo", "distance", "mileage")


@query(ALL_BATCH + "select vin, count(*) rollbacks, max(odometer_reading) highest from f6 where e = 'Odometer rollback' group by 1")
def odometer_rollback(t: Tables) -> DataFrame:
    return t.fuel().where("error_reason = 'Odometer rollback'").groupBy("vin").agg(F.count(F.lit(1)).alias("rollbacks"), F.max("odometer_reading").alias("highest"))


@query(ALL_BATCH + "select vin, model, fuel_type, mfg_year from registry")
def registry_clean(t: Tables) -> DataFrame:
    return t.registry().select("vin", "model", "fuel_type", "mfg_year")


@query(ALL_BATCH + "select r.vin, r.mfg_year, model, 'SAME_VIN_SAME_YEAR_DIFFERENT_MODEL' error_reason from registry_lab r join clash c on r.vin = c.vin and r.mfg_year = c.mfg_year where not bad")
def registry_conflicts(t: Tables) -> DataFrame:
    lab = jobs.registry_labelled(t.raw("registry"), AS_OF)
    return lab.where("error_reason = 'SAME_VIN_SAME_YEAR_DIFFERENT_MODEL'").select("vin", "mfg_year", "model", "error_reason")


@query(ALL_BATCH + "select count(*) total, count(*) filter (where bad) invalid, count(*) filter (where length(vin) <> 8) wrong_length, count(*) filter (where mfg_year > 2024) future_year from registry_lab")
def quality_counts(t: Tables) -> DataFrame:
    lab = jobs.registry_labelled(t.raw("registry"), AS_OF)
    rules = {"invalid": F.col("error_reason") == "INVALID_REGISTRY_RECORD", "wrong_length": F.length("vin") != 8, "future_year": F.col("mfg_year") > 2024}
    return quality.counters(lab, rules)


@query(ALL_BATCH + "select vin, start_date, driver_id, daily_rate from best")
def assignment_highest_rate(t: Tables) -> DataFrame:
    clean, _ = quality.split(jobs.assignment_labelled(t.raw("assignment"), t.registry()))
    best = dedup.keep_first(clean, ["vin", "start_date"], [F.desc("daily_rate"), F.desc("ingestion_seq")])
    return best.select("vin", "start_date", "driver_id", "daily_rate")


@query(ALL_BATCH + "select vin, start_date, driver_id, daily_rate, 'DRIVER_MULTI_ASSIGNMENT_CONFLICT' error_reason from ranked where m > 1")
def driver_conflicts(t: Tables) -> DataFrame:
    return t.assignment()[1].select("vin", "start_date", "driver_id", "daily_rate", "error_reason")


@query(ALL_BATCH + "select vin, driver_id, start_date, end_date, daily_rate, region, case when end_date is null then 'IN-TRANSIT' else 'ARCHIVED' end status from hist")
def assignment_scd2(t: Tables) -> DataFrame:
    return t.assignment()[0].select("vin", "driver_id", "start_date", "end_date", "daily_rate", "region", "status")


@query(ALL_BATCH + "select vin, driver_id, start_date, 'UNKNOWN_VIN' error_reason from assignment_raw where daily_rate > 0 and trim(region) <> '' and (end_date is null or end_date >= start_date) and vin not in (select vin from registry)")
def assignment_unknown_vin(t: Tables) -> DataFrame:
    lab = jobs.assignment_labelled(t.raw("assignment"), t.registry())
    return lab.where("error_reason = 'UNKNOWN_VIN'").select("vin", "driver_id", "start_date", "error_reason")


@query(ALL_BATCH + "select vin, driver_id, start_date, end_date, trim(region) region from assignment_raw where not (daily_rate > 0 and trim(region) <> '' and (end_date is null or end_date >= start_date))")
def assignment_invalid(t: Tables) -> DataFrame:
    lab = jobs.assignment_labelled(t.raw("assignment"), t.registry())
    return lab.where("error_reason = 'INVALID_ASSIGNMENT_RECORD'").select("vin", "driver_id", "start_date", "end_date", "region")


@query(ALL_BATCH + "select vin, driver_id, start_date, end_date, daily_rate, region, case when end_date is null then 'IN-TRANSIT' else 'ARCHIVED' end status from hist")
def asset_history(t: Tables) -> DataFrame:
    """Gold history after two runs: the second merges all assignments over those that start before 1996."""
    full = jobs.asset_history(t.assignment()[0])
    return merge.upsert(full.where("start_date < '1996-01-01'"), full, ["vin", "start_date"])


@query("select vin, model, mfg_year from (select *, max(ingestion_date) over () newest from (select concat('V', p_partkey) vin, p_brand model, p_size mfg_year, date '2024-01-01' + cast(p_partkey % 5 as int) ingestion_date from part)) where ingestion_date = newest")
def registry_latest_batch(t: Tables) -> DataFrame:
    rows = t.table("part").selectExpr("concat('V', p_partkey) vin", "p_brand model", "p_size mfg_year", "date_add(date'2024-01-01', cast(p_partkey % 5 as int)) ingestion_date")
    return jobs.latest_batch(rows).select("vin", "model", "mfg_year")


@query(ALL_BATCH + "select vin, model, fuel_type, mfg_year from registry_lab except select vin, model, fuel_type, mfg_year from registry_lab where bad")
def registry_difference(t: Tables) -> DataFrame:
    """Rows that are in the table and not among the rejected ones, each once: the complement of the rule, deduplicated."""
    lab = jobs.registry_labelled(t.raw("registry"), AS_OF)
    kept = lab.where("error_reason IS NULL OR error_reason != 'INVALID_REGISTRY_RECORD'")
    return kept.select("vin", "model", "fuel_type", "mfg_year").dropDuplicates()


@query("select o_orderkey, try_cast(d as date) as \"day\", try_cast(x as timestamp) moment from (select o_orderkey, case when o_orderkey % 7 = 0 then 'n/a' when o_orderkey % 11 = 0 then '1996-02-31' else strftime(o_orderdate, '%Y-%m-%d') end d, case when o_orderkey % 13 = 0 then '' else strftime(o_orderdate, '%Y-%m-%d 07:30:00') end x from orders)")
def lenient_dates(t: Tables) -> DataFrame:
    """Dates and times that arrive as text, slashes among them; what is no date is null and stops nothing."""
    o = t.table("orders").selectExpr(
        "o_orderkey", "case when o_orderkey % 7 = 0 then 'n/a' when o_orderkey % 11 = 0 then '1996-02-31' when o_orderkey % 3 = 0 then date_format(o_orderdate, 'dd/MM/yyyy') else date_format(o_orderdate, 'yyyy-MM-dd') end d",
        "case when o_orderkey % 13 = 0 then '' else concat(date_format(o_orderdate, 'yyyy-MM-dd'), ' 07:30:00') end x",
    )
    return o.select("o_orderkey", lenient_date("d", ("dd/MM/yyyy",)).alias("day"), lenient_timestamp("x").alias("moment"))


@query("select event_id, cast(to_timestamp(epoch(ts)) at time zone 'UTC' as date) \"day\" from events")
def epoch_dates(t: Tables) -> DataFrame:
    return t.table("events").select("event_id", F.col("ts").cast("timestamp").cast("long").cast("string").alias("s")).select("event_id", epoch_date("s").alias("day"))


@query(ALL_BATCH + "select model, count(*) no_of_active_vehicles from hist join registry using (vin) where end_date is null group by 1 order by 2 desc, 1 limit 5")
def fleet_top5(t: Tables) -> DataFrame:
    return jobs.fleet_snapshot(t.assignment()[0], t.registry()).orderBy(F.desc("no_of_active_vehicles"), "model").limit(5)


@query(ALL_BATCH + "select vin, service_date, upper(trim(service_type)) service_type, year(service_date) service_year, month(service_date) service_month, max(ingestion_seq) ingestion_seq from maintenance_raw group by all")
def maintenance_clean(t: Tables) -> DataFrame:
    m = t.maintenance().withColumn("service_year", F.year("service_date").cast("long")).withColumn("service_month", F.month("service_date").cast("long"))
    return m.select("vin", "service_date", "service_type", "service_year", "service_month", "ingestion_seq")


@query(ALL_BATCH + "select model, count(*) no_of_active_vehicles from hist join registry using (vin) where end_date is null group by 1")
def fleet_snapshot(t: Tables) -> DataFrame:
    return jobs.fleet_snapshot(t.assignment()[0], t.registry())


@query(ALL_TELE + "select event_id, e error_reason from tele where e is not null")
def telemetry_errors(t: Tables) -> DataFrame:
    return quality.split(jobs.telemetry_labelled(t.raw("telemetry")))[1].select("event_id", "error_reason")


@query(ALL_TELE + """select event_id, case when a.vin is null then 'GHOST_TRIP' when a.driver_id <> t.driver_id then 'SHADOW_ASSIGNMENT' else 'VALID' end trip_type
  from tele t left join telemetry_assignment_raw a on a.vin = t.vin and a.start_date <= cast(event_timestamp as date) and (a.end_date is null or cast(event_timestamp as date) < a.end_date) where e is null""")
def trip_classification(t: Tables) -> DataFrame:
    return jobs.trips(t.telemetry(), t.raw("telemetry_assignment")).select("event_id", "trip_type")


@query(ALL_TELE + """select event_id, case when a.vin is null then 'GHOST_TRIP' when a.driver_id <> t.driver_id then 'SHADOW_ASSIGNMENT' else 'VALID' end trip_type
  from tele t left join telemetry_assignment_raw a on a.vin = t.vin and a.start_date <= cast(event_timestamp as date) and (a.end_date is null or cast(event_timestamp as date) < a.end_date) where e is null""")
def trip_sweep(t: Tables) -> DataFrame:
    """The same by a sweep over events and starts in one order, without a join."""
    return jobs.trips(t.telemetry(), t.raw("telemetry_assignment"), sweep=True).select("event_id", "trip_type")


@query(ALL_TELE + """select event_id, case when a.vin is null then 'No assignment found' else 'Driver mismatch' end audit_reason
  from tele t left join telemetry_assignment_raw a on a.vin = t.vin and a.start_date <= cast(event_timestamp as date) and (a.end_date is null or cast(event_timestamp as date) < a.end_date)
  where e is null and (a.vin is null or a.driver_id <> t.driver_id)""")
def trip_audit(t: Tables) -> DataFrame:
    return jobs.trips(t.telemetry(), t.raw("telemetry_assignment")).where("trip_type != 'VALID'").select("event_id", "audit_reason")


@query("""select case when vin is null or driver_id is null then 'NULL_KEY' else 'OTHER' end kind, count(*) n from (
  select case when event_id % 50 <> 7 then user_id end vin, case when event_id % 70 <> 9 then user_id end driver_id from events) group by 1""")
def telemetry_null_keys(t: Tables) -> DataFrame:
    raw = t.raw("telemetry").withColumn("vin", F.when(F.col("event_id") % 50 != 7, F.col("vin"))).withColumn("driver_id", F.when(F.col("event_id") % 70 != 9, F.col("driver_id")))
    kind = F.when(F.col("error_reason") == "NULL_KEY", "NULL_KEY").otherwise("OTHER")
    return jobs.telemetry_labelled(raw).groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


_KEYLESS = """with f as (select l_orderkey, l_linenumber, case when l_linenumber % 3 <> 0 then l_orderkey || '-' || l_linenumber end transaction_id, case when l_orderkey % 4 <> 0 then 'V' || l_suppkey end vin, l_quantity from lineitem)
  select l_orderkey, l_linenumber from f where transaction_id is null or vin is null"""


@query(_KEYLESS)
def fuel_null_keys(t: Tables) -> DataFrame:
    """Fuel rows without a key: labelled without meeting in a window."""
    raw = t.table("lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "case when l_linenumber % 3 <> 0 then concat(l_orderkey, '-', l_linenumber) end transaction_id", "case when l_orderkey % 4 <> 0 then concat('V', l_suppkey) end vin",
        "l_quantity as fuel_liters", "cast(l_shipdate as timestamp) as timestamp", "l_extendedprice as odometer_reading",
    )
    return jobs.fuel_labelled(raw, FUEL_AS_OF, ["vin"]).where("error_reason = 'Null keys'").select("l_orderkey", "l_linenumber")


@query(ALL_TELE + """, susp as (select driver_id, min(start_date + 4) since from telemetry_assignment_raw where cast(substr(driver_id, 2) as int) % 5 = 0 group by 1)
  select sess.driver_id, sess.vin, start_ts from sess left join susp using (driver_id) where since is null or start_ts < since""")
def before_suspension(t: Tables) -> DataFrame:
    """Sessions of drivers who are not suspended, or before they were; every fifth driver is, twice."""
    a = t.raw("telemetry_assignment").where("cast(substr(driver_id, 2) as int) % 5 = 0").withColumn("status", F.lit("SUSPENDED"))
    standing = a.select("driver_id", "status", F.date_add("start_date", 4).alias("suspension_date")).unionByName(a.select("driver_id", "status", F.date_add("start_date", 9).alias("suspension_date")))
    return strikes.before_suspension(strikes.incident_ids(t.sessions()), standing).select("driver_id", "vin", "start_ts")


@query(ALL_TELE + """select s.driver_id, s.vin, start_ts from sess s left join telemetry_assignment_raw a
  on a.driver_id = s.driver_id and a.vin = s.vin and a.start_date <= cast(start_ts as date) and (a.end_date is null or cast(start_ts as date) < a.end_date) where a.vin is null""")
def unassigned_sessions(t: Tables) -> DataFrame:
    return jobs.unassigned(t.sessions(), t.raw("telemetry_assignment")).select("driver_id", "vin", "start_ts")


@query(ALL_TELE + "select event_id, breached_zone_name from viol where is_zone_breach")
def zone_breach(t: Tables) -> DataFrame:
    return t.violations().where("is_zone_breach").select("event_id", "breached_zone_name")


@query(ALL_TELE + "select event_id, is_speeding, is_zone_breach, is_violation, strike_type from viol")
def violations(t: Tables) -> DataFrame:
    return t.violations().select("event_id", "is_speeding", "is_zone_breach", "is_violation", "strike_type")


@query(ALL_TELE + "select * from sess")
def violation_sessions(t: Tables) -> DataFrame:
    return t.sessions()


@query(ALL_TELE + "select strike_id, driver_id, vin, incident_ts, base_rate from rated")
def incident_rates(t: Tables) -> DataFrame:
    new = strikes.incident_ids(t.sessions()).withColumn("day", F.to_date("incident_ts"))
    hist = t.raw("telemetry_assignment").withColumnRenamed("daily_rate", "base_rate")
    return history.interval_join(new, hist, {"vin": "vin", "driver_id": "driver_id"}, "day", bounded=True).select("strike_id", "driver_id", "vin", "incident_ts", "base_rate")


@query(ALL_TELE + "select strike_id, driver_id, month_year, strike_number from inc2")
def strike_sequence(t: Tables) -> DataFrame:
    """The month's second half as a second batch: numbers go on from what the first left in the table."""
    late = F.dayofmonth("start_ts") > 15
    assigned = t.raw("telemetry_assignment")
    first = jobs.incidents(t.sessions().where(~late), assigned)
    second = jobs.incidents(t.sessions(), assigned, existing=first)
    return first.unionByName(second).select("strike_id", "driver_id", "month_year", F.col("strike_number").cast("long"))


@query(ALL_TELE + "select strike_id, strike_number, base_rate, deduction_amount, adjusted_rate, status_after_strike from inc2")
def strike_penalty(t: Tables) -> DataFrame:
    return t.incidents().select("strike_id", F.col("strike_number").cast("long"), "base_rate", "deduction_amount", "adjusted_rate", "status_after_strike")


@query(ALL_TELE + "select driver_id, month_year, current_strikes, total_deductions, final_payable_rate, status, suspension_date from standing")
def driver_standing(t: Tables) -> DataFrame:
    s = strikes.standings(t.incidents())
    return s.select("driver_id", "month_year", F.col("current_strikes").cast("long"), "total_deductions", "final_payable_rate", "status", "suspension_date")


@query(ALL_TELE + "select driver_id, status like 'S%' suspended, current_strikes from standing")
def standing_report(t: Tables) -> DataFrame:
    lines = strikes.report_lines(strikes.standings(t.incidents()))
    strikes_of = F.regexp_extract("value", r"Total strikes for the month: (\d+)", 1).cast("long")
    return lines.select("driver_id", F.col("value").contains("Suspension status: SUSPENDED").alias("suspended"), strikes_of.alias("current_strikes"))


def _sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    o = t.table("orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return o.where(OLD), o.where(NEW).withColumn("o_totalprice", F.col("o_totalprice") + 1).withColumn("o_orderstatus", F.lit("N"))


_SIDES = f"""with old as (select o_orderkey, o_custkey, o_totalprice, o_orderstatus from orders where {OLD}),
  new as (select o_orderkey, o_custkey, o_totalprice + 1 o_totalprice, 'N' o_orderstatus from orders where {NEW}) """


@query(_SIDES + "select * from new union all select * from old where o_orderkey not in (select o_orderkey from new)")
def merge_upsert(t: Tables) -> DataFrame:
    return merge.upsert(*_sides(t), ["o_orderkey"])


@query(_SIDES + "select * from old union all select * from new where o_orderkey not in (select o_orderkey from old)")
def merge_insert_only(t: Tables) -> DataFrame:
    return merge.insert_only(*_sides(t), ["o_orderkey"])


_MERGED = """select coalesce(o.o_orderkey, n.o_orderkey) o_orderkey, coalesce(o.o_custkey, n.o_custkey) o_custkey,
  case when {cond} then n.o_totalprice else o.o_totalprice end o_totalprice, {status} o_orderstatus from old o full join new n on o.o_orderkey = n.o_orderkey"""


@query(_SIDES + _MERGED.format(cond="n.o_orderkey is not null", status="coalesce(o.o_orderstatus, n.o_orderstatus)"))
def merge_columns(t: Tables) -> DataFrame:
    return merge.merge_rows(*_sides(t), ["o_orderkey"], update=["o_totalprice"])


@query(_SIDES + _MERGED.format(cond="o.o_orderkey is null or (n.o_orderkey is not null and n.o_totalprice > 100000)", status="case when o.o_orderkey is null or (n.o_orderkey is not null and n.o_totalprice > 100000) then n.o_orderstatus else o.o_orderstatus end"))
def merge_conditional(t: Tables) -> DataFrame:
    return merge.merge_rows(*_sides(t), ["o_orderkey"], when=F.col("s.o_totalprice") > 100000)


@query(ALL_BATCH + """, ended as (select driver_id, vin, min(start_date) + 20 suspended_date from hist group by 1, 2)
  select h.vin, h.driver_id, start_date, case when end_date is null or end_date > suspended_date then suspended_date else end_date end end_date from hist h join ended e on h.vin = e.vin and h.driver_id = e.driver_id""")
def merge_end_date(t: Tables) -> DataFrame:
    hist = t.assignment()[0].select("vin", "driver_id", "start_date", "end_date")
    ended = hist.groupBy("driver_id", "vin").agg(F.date_add(F.min("start_date"), 20).alias("suspended_date"))
    return history.end_open_rows(hist, ended, ["driver_id", "vin"])


_DIFF = _SIDES + """, d as (select o.o_orderkey ok, n.o_orderkey nk, o.o_totalprice op, n.o_totalprice np from old o full join new n on o.o_orderkey = n.o_orderkey),
  c as (select nk o_orderkey, np o_totalprice, 'insert' _change_type from d where ok is null union all select ok, op, 'delete' from d where nk is null
    union all select ok, op, 'update_preimage' from d where ok = nk and op <> np union all select nk, np, 'update_postimage' from d where ok = nk and op <> np) """


@query(_DIFF + "select o_orderkey, o_totalprice, _change_type, 7::bigint _commit_version from c")
def snapshot_diff(t: Tables) -> DataFrame:
    old, new = _sides(t)
    return merge.snapshot_diff(old.select("o_orderkey", "o_totalprice"), new.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 7)


@query(_SIDES + """, d as (select o.o_orderkey ok, n.o_orderkey nk, o.o_totalprice op, n.o_totalprice np, (o.o_orderkey is null or n.o_totalprice > 100000) takes from old o full join new n on o.o_orderkey = n.o_orderkey)
  select coalesce(ok, nk) o_orderkey, case when nk is not null and takes then np else op end o_totalprice, null::varchar _change_type from d
  union all select nk, np, 'insert' from d where ok is null
  union all select ok, op, 'update_preimage' from d where ok = nk and takes and op <> np union all select nk, np, 'update_postimage' from d where ok = nk and takes and op <> np""")
def merge_with_changes(t: Tables) -> DataFrame:
    """A conditional merge: the new state (without _change_type) and what it changed, from one join."""
    old, new = _sides(t)
    columns = ["o_orderkey", "o_totalprice"]
    return merge.with_changes(old.select(*columns), new.select(*columns), ["o_orderkey"], when=F.col("s.o_totalprice") > 100000)


@query("select l_orderkey, l_linenumber, (select sum((((p >> b) & 1) << (3 * b + 2)) | (((s >> b) & 1) << (3 * b + 1)) | (((d >> b) & 1) << (3 * b))) from range(8) r(b))::bigint z from (select l_orderkey, l_linenumber, l_partkey % 256 p, l_suppkey % 256 s, dayofyear(l_shipdate) % 256 d from lineitem)")
def z_order_codes(t: Tables) -> DataFrame:
    """Part, supplier and day interleaved bit by bit: the number that Z-ordered files are cut by."""
    ranks = t.table("lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 256).alias("p"), (F.col("l_suppkey") % 256).alias("s"), (F.dayofyear("l_shipdate") % 256).alias("d"))
    return ranks.select("l_orderkey", "l_linenumber", z_code(["p", "s", "d"], 8).alias("z"))


@query(_DIFF + "select o_orderkey, o_totalprice from c where _change_type in ('insert', 'update_postimage')")
def latest_change(t: Tables) -> DataFrame:
    old, new = _sides(t)
    columns = ["o_orderkey", "o_totalprice"]
    once = merge.snapshot_diff(old.select(*columns), new.select("o_orderkey", (F.col("o_totalprice") - 5).alias("o_totalprice")), ["o_orderkey"], 1)
    twice = merge.snapshot_diff(old.select(*columns), new.select(*columns), ["o_orderkey"], 2)
    return merge.latest_changes(once.unionByName(twice), ["o_orderkey"]).select(*columns)


@query(_DIFF + "select o_orderkey, o_totalprice from c where _change_type in ('insert', 'update_postimage')")
def export_delta(t: Tables) -> DataFrame:
    """What a database is told after version 1: of the changes of version 2, the newest of each key."""
    old, new = _sides(t)
    columns = ["o_orderkey", "o_totalprice"]
    feed = merge.snapshot_diff(old.select(*columns).limit(0), old.select(*columns), ["o_orderkey"], 1).unionByName(merge.snapshot_diff(old.select(*columns), new.select(*columns), ["o_orderkey"], 2))
    return merge.latest_changes(feed.where("_commit_version >= 2"), ["o_orderkey"]).select(*columns)


@query(_DIFF + "select max(v) newest, count(*) filter (where v = 9) waiting from (select case when o_orderkey % 2 = 0 then 9 else 7 end v from c)")
def feed_position(t: Tables) -> DataFrame:
    """The newest version of a change feed, where the next export begins after, and how many rows it has."""
    old, new = _sides(t)
    feed = merge.snapshot_diff(old.select("o_orderkey", "o_totalprice"), new.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 7)
    feed = feed.withColumn("_commit_version", F.when(F.col("o_orderkey") % 2 == 0, 9).otherwise(F.col("_commit_version")))
    return feed.agg(F.max("_commit_version").alias("newest"), F.count_if(F.col("_commit_version") == 9).alias("waiting"))


@query("select c_custkey, md5(c_name || '||' || c_nationkey || '||' || c_mktsegment) _row_hash from customer where c_custkey % 4 <> 0")
def row_hash_append(t: Tables) -> DataFrame:
    """Rows of the feed (each sent twice) whose fingerprint the table does not have yet."""
    hashed = t.table("customer").withColumn("_row_hash", row_hash(["c_name", "c_nationkey", "c_mktsegment"])).select("c_custkey", "_row_hash")
    held = hashed.where("c_custkey % 4 = 0")
    return hashed.unionByName(hashed).dropDuplicates(["_row_hash"]).join(held, "_row_hash", "left_anti").select("c_custkey", "_row_hash")


@query("select event_id, sha256(event_id || '|' || user_id || '|' || event_type) id from events")
def surrogate_ids(t: Tables) -> DataFrame:
    return t.table("events").select("event_id", surrogate_id(["event_id", "user_id", "event_type"]).alias("id"))


@query("select event_id, cast(json_extract(props, '$.k') as bigint) k from events")
def json_flatten(t: Tables) -> DataFrame:
    return t.table("events").select("event_id", F.from_json("props", "k bigint").alias("p")).select("event_id", "p.k")


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)

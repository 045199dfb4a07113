"""Fleet tables projected from the star-schema tables, in Spark and as DuckDB text for the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2024-12-31"


def _vin(number: str) -> str:
    return f"concat('V', lpad(cast({number} as string), 7, '0'))"


def _driver(number: str) -> str:
    return f"concat('D', lpad(cast({number} as string), 5, '0'))"


#: name -> (source table, Spark projection, condition)
SPARK = {
    "registry": ("part", [
        f"case when p_partkey % 97 = 96 then concat('X', p_partkey) else {_vin('cast(floor(p_partkey * 0.75D) as bigint)')} end as vin",
        "p_brand as model", "upper(p_type) as fuel_type", "1990 + p_size as mfg_year"], None),
    "assignment": ("orders", [
        f"{_vin('o_custkey % 120')} as vin", f"{_driver('o_orderkey % 300')} as driver_id", "cast(o_orderdate as date) as start_date",
        "case when o_orderkey % 11 <> 0 then date_add(cast(o_orderdate as date), cast(o_orderkey % 45 - 2 as int)) end as end_date",
        "o_totalprice / 1000 as daily_rate", "case when o_orderkey % 53 = 0 then ' ' else o_orderpriority end as region", "o_orderkey as ingestion_seq"], None),
    "fuel": ("lineitem", [
        "concat(l_orderkey, '-', l_linenumber) as transaction_id", f"{_vin('l_suppkey')} as vin",
        "case when l_linenumber = 7 and l_quantity < 3 then 0.0D else l_quantity end as fuel_liters",
        "cast(datediff(cast(l_shipdate as date), date'1995-01-01') * 100 + floor(l_extendedprice / 1000) as double) as odometer_reading",
        "cast(l_shipdate as timestamp) as timestamp", "l_partkey as seq", "l_extendedprice as seq2", "l_discount as seq3", "l_tax as seq4"], None),
    "maintenance": ("orders", [
        f"{_vin('o_custkey % 120')} as vin", "cast(o_orderdate as date) as service_date", "o_orderpriority as service_type",
        "o_orderkey as ingestion_seq"], "o_orderstatus = 'F'"),
    "telemetry": ("events", [
        "event_id", f"{_vin('user_id')} as vin", f"{_driver('case when event_id % 10 = 0 then user_id + 1 else user_id end')} as driver_id",
        "cast(ts as timestamp) as event_timestamp", "cast(floor(value) as bigint) - case when event_id % 500 = 1 then 400 else 0 end as speed",
        "case when event_id % 400 = 3 then 0.0D else cast(event_id * 7919 % 18000 as double) / 100 - 90 end as lat",
        "case when event_id % 400 = 3 then 0.0D else cast(event_id * 104729 % 36000 as double) / 100 - 180 end as long", "props"], None),
    "telemetry_assignment": ("customer", [
        f"{_vin('c_custkey')} as vin", f"{_driver('c_custkey')} as driver_id", "date_add(date'2024-01-01', cast(c_custkey % 20 as int)) as start_date",
        "case when c_custkey % 3 = 0 then date_add(date'2024-01-11', cast(c_custkey % 20 as int)) end as end_date",
        "cast(100 + c_custkey % 50 as double) as daily_rate"], None),
    "zones": ("nation", [
        "n_name as zone_name", "n_nationkey * 6.0D - 80 as min_lat", "n_nationkey * 6.0D - 72 as max_lat",
        "n_nationkey * 13.0D - 170 as min_long", "n_nationkey * 13.0D - 155 as max_long"], None),
}


def fleet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns, cond = SPARK[name]
    df = spark.read.parquet(f"{sf_dir}/{source}.parquet")
    return (df.where(cond) if cond else df).selectExpr(*columns)


#: The same for DuckDB, as common table expressions.
DUCKDB = {
    "registry": """select case when p_partkey % 97 = 96 then 'X' || p_partkey
          else 'V' || lpad(cast(cast(floor(p_partkey * 0.75) as bigint) as varchar), 7, '0') end vin,
          p_brand model, upper(p_type) fuel_type, 1990 + p_size mfg_year from part""",
    "assignment": """select 'V' || lpad(cast(o_custkey % 120 as varchar), 7, '0') vin, 'D' || lpad(cast(o_orderkey % 300 as varchar), 5, '0') driver_id,
          cast(o_orderdate as date) start_date, case when o_orderkey % 11 <> 0 then cast(o_orderdate as date) + cast(o_orderkey % 45 - 2 as int) end end_date,
          o_totalprice / 1000 daily_rate, case when o_orderkey % 53 = 0 then ' ' else o_orderpriority end region, o_orderkey ingestion_seq from orders""",
    "fuel": """select l_orderkey || '-' || l_linenumber transaction_id, 'V' || lpad(cast(l_suppkey as varchar), 7, '0') vin,
          case when l_linenumber = 7 and l_quantity < 3 then 0.0::double else l_quantity end fuel_liters,
          ((cast(l_shipdate as date) - date '1995-01-01') * 100 + floor(l_extendedprice / 1000))::double odometer_reading,
          l_shipdate "timestamp", l_partkey seq, l_extendedprice seq2, l_discount seq3, l_tax seq4 from lineitem""",
    "maintenance": """select 'V' || lpad(cast(o_custkey % 120 as varchar), 7, '0') vin, cast(o_orderdate as date) service_date,
          o_orderpriority service_type, o_orderkey ingestion_seq from orders where o_orderstatus = 'F'""",
    "telemetry": """select event_id, 'V' || lpad(cast(user_id as varchar), 7, '0') vin,
          'D' || lpad(cast(case when event_id % 10 = 0 then user_id + 1 else user_id end as varchar), 5, '0') driver_id, ts event_timestamp,
          cast(floor(value) as bigint) - case when event_id % 500 = 1 then 400 else 0 end speed,
          case when event_id % 400 = 3 then 0.0::double else cast(event_id * 7919 % 18000 as double) / 100 - 90 end lat,
          case when event_id % 400 = 3 then 0.0::double else cast(event_id * 104729 % 36000 as double) / 100 - 180 end long, props from events""",
    "telemetry_assignment": """select 'V' || lpad(cast(c_custkey as varchar), 7, '0') vin, 'D' || lpad(cast(c_custkey as varchar), 5, '0') driver_id,
          date '2024-01-01' + cast(c_custkey % 20 as int) start_date,
          case when c_custkey % 3 = 0 then date '2024-01-11' + cast(c_custkey % 20 as int) end end_date,
          cast(100 + c_custkey % 50 as double) daily_rate from customer""",
    "zones": """select n_name zone_name, n_nationkey * 6.0::double - 80 min_lat, n_nationkey * 6.0::double - 72 max_lat,
          n_nationkey * 13.0::double - 170 min_long, n_nationkey * 13.0::double - 155 max_long from nation""",
}

import datetime as dt
import json
import tempfile

import pytest
from pyspark.sql import functions as F

from drayage.operators import geo, history, merge, quality
from drayage.sources import jdbc, landing, tables
from drayage.streaming import telemetry


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="spark-")


def put(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_landing_files_manifest_and_idempotence(spark, folder):
    import os

    os.makedirs(f"{folder}/in")
    put(f"{folder}/in/a.csv", "VIN , Model,mfg_year,fuel_type\nV0000001,M,2020,Diesel\nV0000001,M,2020,Diesel\n")
    put(f"{folder}/in/b.csv", "vin,model\nV0000002,M\n")
    put(f"{folder}/in/c.csv", "")
    put(f"{folder}/in/d.csv", "VIN , Model,mfg_year,fuel_type\nV0000001,M,2020,Diesel\nV0000001,M,2020,Diesel\n")
    put(f"{folder}/in/e.csv", "model,vin,fuel_type,mfg_year,extra\nN,V0000003,Petrol,2021,x\n")
    where = (f"{folder}/in", f"{folder}/bronze", f"{folder}/manifest")
    found = {r.file_name: r.file_status for r in landing.ingest(spark, "registry", *where, "2024-05-01").collect()}
    assert found == {
        "a.csv": "PROCESSED",
        "b.csv": "REJECTED:MISSING_REQUIRED_COLUMNS:mfg_year,fuel_type",
        "c.csv": "REJECTED:EMPTY_FILE",
        "e.csv": "PROCESSED",
    }
    rows = spark.read.parquet(f"{folder}/bronze")
    assert sorted((r.vin, r.model, r.source_file) for r in rows.collect()) == [("V0000001", "M", "a.csv"), ("V0000003", "N", "e.csv")]
    assert landing.ingest(spark, "registry", *where, "2024-05-01").count() == 0
    assert spark.read.parquet(f"{folder}/bronze").count() == 2


def test_snapshots_and_positions(spark, folder):
    path = f"{folder}/t"
    assert tables.read_table(spark, path) is None
    tables.write_snapshot(spark.range(3), path, 1)
    tables.write_snapshot(spark.range(5), path, 2)
    assert tables.read_table(spark, path).count() == 5 and tables.read_table(spark, path, below=2).count() == 3
    tables.save_position(spark, f"{folder}/p", {"a": 3})
    tables.save_position(spark, f"{folder}/p", {"b": 4, "a": 7})
    assert [tables.load_position(spark, f"{folder}/p", n) for n in "abc"] == [7, 4, 0]
    with pytest.raises(RuntimeError):
        tables.require_nonempty(None, "x")


def test_jdbc_upsert(spark, folder):
    url = f"jdbc:derby:{folder}/db;create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    jdbc.overwrite(first, url, "t", props)
    jdbc.staged_upsert(spark.createDataFrame([(2, "c"), (3, "d")], "id int, v string"), url, "t", ["id"], props)
    assert sorted(map(tuple, spark.read.jdbc(url, "t", properties=props).collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert "ON CONFLICT" in jdbc.upsert_statement("postgresql", "t", "s", ["id", "v"], ["id"])


def test_interval_ends_are_half_open(spark):
    h = spark.createDataFrame([("V", dt.date(2024, 1, 1), dt.date(2024, 1, 5)), ("V", dt.date(2024, 1, 5), None)], "vin string, start_date date, end_date date")
    f = spark.createDataFrame([("V", dt.date(2023, 12, 31)), ("V", dt.date(2024, 1, 1)), ("V", dt.date(2024, 1, 5))], "vin string, day date")
    got = {(r.day.isoformat(), r.start_date.isoformat() if r.start_date else None) for r in history.interval_join(f, h, {"vin": "vin"}, "day", how="left").collect()}
    assert got == {("2023-12-31", None), ("2024-01-01", "2024-01-01"), ("2024-01-05", "2024-01-05")}


def test_a_sweep_equals_the_interval_join(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    h = [("A", day(0), day(5), "x"), ("A", day(5), day(6), "y"), ("A", day(9), None, "z"), ("B", day(3), day(4), None), (None, day(0), None, "n"), ("C", None, None, "s")]
    h = spark.createDataFrame(h, "vin string, start_date date, end_date date, note string")
    f = [(v, day(n), n) for v in ("A", "B", "C", "D", None) for n in range(-2, 12)] + [("A", None, 99), ("A", day(5), 5)]
    f = spark.createDataFrame(f, "vin string, day date, note2 int")
    for how in ("inner", "left"):
        both = [sorted(map(tuple, join(f, h, {"vin": "vin"}, "day", how=how).select("vin", "day", "note2", "start_date", "end_date", "note").collect()), key=str) for join in (history.interval_join, history.sweep_join)]
        assert both[0] == both[1] and both[0]
    plan = history.sweep_join(f, h, {"vin": "vin"}, "day")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert history.disjoint(h, ["vin"])
    assert not history.disjoint(h.unionByName(spark.createDataFrame([("A", day(2), day(3), "w")], h.schema)), ["vin"])


def test_zones_of_all_sizes_in_one_table(spark):
    zones = [(f"S{n}", 10 + n * 0.001, 10.0005 + n * 0.001, 20.0, 20.0004) for n in range(200)] + [("CONTINENT", -60.0, 70.0, -120.0, 100.0), ("WORLD", -90.0, 90.0, -180.0, 180.0), ("HALF", 0.0, 90.0, 0.0, 180.0)]
    z = spark.createDataFrame(zones, telemetry.ZONES)
    per_zone = geo.cover(geo.sane_zones(z)).groupBy("zone_name").count().agg(F.max("count")).first()[0]
    assert per_zone <= 9
    pts = [(n, 10 + n * 0.0002, 20.0 + (n % 7) * 0.0001) for n in range(1100)] + [(2000 + n, -90.0 + n * 4.5, -180.0 + n * 9.0) for n in range(41)] + [(3000, None, 1.0), (3001, 91.0, 0.0)]
    p = spark.createDataFrame(pts, "event_id int, lat double, long double")
    got = {r.event_id: r.breached_zone_name for r in geo.point_in_zone(p, z, "event_id").collect()}
    want = {i: min((n for n, a, b, c, d in zones if la is not None and a <= la <= b and c <= lo <= d), default=None) for i, la, lo in pts}
    assert got == want
    assert geo.point_in_zone(p, z.limit(0), "event_id").where("is_zone_breach").count() == 0


def test_zone_edges_overlap_and_names(spark):
    z = spark.createDataFrame([("B", 0.0, 10.0, 0.0, 10.0), ("A", 5.0, 20.0, 5.0, 20.0), (None, -3.0, -1.0, -3.0, -1.0), ("X", 9.0, 1.0, 0.0, 1.0)], telemetry.ZONES)
    p = spark.createDataFrame([(1, 10.0, 10.0), (2, 0.0, 0.0), (3, -1.0, -3.0), (4, 30.0, 30.0)], "event_id int, lat double, long double")
    got = {r.event_id: r.breached_zone_name for r in geo.point_in_zone(p, z, "event_id").collect()}
    assert got == {1: "A", 2: "B", 3: "UNKNOWN_ZONE", 4: None}


def test_first_rule_wins_and_null_breaks_nothing(spark):
    d = spark.createDataFrame([(1, -1), (2, None), (3, 5)], "id int, v int")
    got = {r.id: r.error_reason for r in quality.label(d, [("NEG", F.col("v") < 0), ("ODD", F.col("v") % 2 != 0)]).collect()}
    assert got == {1: "NEG", 2: None, 3: "ODD"}


def test_merge_is_a_fixed_point_and_adds_columns(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(2, "c", 9), (3, "d", 8)], "k int, v string, w int")
    once = merge.merge_rows(t, s, ["k"])
    assert sorted(map(tuple, once.collect())) == [(1, "a", None), (2, "c", 9), (3, "d", 8)]
    assert sorted(map(tuple, merge.merge_rows(once, s, ["k"]).collect())) == sorted(map(tuple, once.collect()))
    assert merge.snapshot_diff(once, once, ["k"], 1).count() == 0


def test_telemetry_stream_end_to_end(spark, folder):
    start = 1_714_521_600
    def message(k, at, vin, speed, lat=1.0):
        return json.dumps({"driver_id": "D1" if vin == "V1" else "D9", "lat": lat, "long": 2.0, "speed": speed, "vin": vin}), "t", 0, k, dt.datetime.fromtimestamp(start + at, dt.timezone.utc)
    rows = [message(0, 0, "V1", 120), message(1, 240, "V1", 130), message(2, 3000, "V1", 140), message(3, 90000, "V1", 50), message(4, 10, "V2", 150), message(5, 20, "V1", -4), ("not json", "t", 0, 6, dt.datetime.fromtimestamp(start, dt.timezone.utc))]
    raw = spark.createDataFrame(rows, "value string, topic string, partition int, offset long, timestamp timestamp")
    raw.coalesce(1).write.parquet(f"{folder}/raw")
    tables.write_snapshot(spark.createDataFrame([("V1", "D1", dt.date(2024, 1, 1), None, 100.0)], "vin string, driver_id string, start_date date, end_date date, daily_rate double"), f"{folder}/assets", 1)
    put(f"{folder}/zones.json", json.dumps([{"zone_name": "Z", "min_lat": 50.0, "max_lat": 51.0, "min_long": 1.0, "max_long": 3.0}]))
    stream = telemetry.file_source(spark, f"{folder}/raw", raw.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "))
    bronze = telemetry.append_stream(telemetry.flatten(stream, F.lit("2024-05-02 00:00:00").cast("timestamp")), f"{folder}/bronze", f"{folder}/c1")
    bronze.awaitTermination(120)
    b = spark.read.parquet(f"{folder}/bronze")
    assert b.count() == 7 and b.where("driver_id IS NULL").count() == 1
    for _ in range(2):  # a replayed epoch changes nothing
        telemetry.silver_batch(b, 1, f"{folder}/silver", f"{folder}/arch", f"{folder}/zones.json", f"{folder}/assets")
    silver = tables.read_epochs(spark, f"{folder}/silver", "event_date")
    assert silver.count() == 4 and silver.where("is_violation").count() == 3
    assert {r.error_reason: r["count"] for r in spark.read.parquet(f"{folder}/arch/errors").groupBy("error_reason").count().collect()} == {"NULL_KEY": 1, "NEGATIVE_SPEED_ERROR": 1}
    assert spark.read.parquet(f"{folder}/arch/invalid").select("trip_type").first()[0] == "GHOST_TRIP"
    live = telemetry.silver_stream(spark, f"{folder}/silver", ", ".join(f"{c} {k}" for c, k in silver.dtypes))
    telemetry.each_batch(telemetry.session_stream(live), lambda d, e: telemetry.incident_batch(d, e + 1, f"{folder}/gold", f"{folder}/assets"), f"{folder}/c2").awaitTermination(180)
    incidents = tables.read_epochs(spark, f"{folder}/gold/incidents", "month_year")
    found = incidents.orderBy("incident_ts").collect()
    assert [(r.strike_number, r.max_speed, r.deduction_amount, r.adjusted_rate) for r in found][:1] == [(1, 130, 5.0, 95.0)]
    telemetry.write_standing(spark, f"{folder}/gold", "2024-05", 1, f"{folder}/report")
    assert "Driver ID: D1" in "\n".join(r.value for r in spark.read.text(f"{folder}/report").collect())
    url, props = f"jdbc:derby:{folder}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    jdbc.overwrite(spark.createDataFrame([("D0", "V0", 1.0, 1, "x", 1.0, "ACTIVE", dt.date(2024, 1, 1), "2024-01")], "driver_id string, vin string, base_rate double, strike_count int, current_strike_type string, current_adjusted_rate double, status string, incident_day date, month string"), url, "s", props, ["driver_id", "vin", "month"])
    changes = spark.read.parquet(f"{folder}/gold/changes").drop("epoch")
    feed = telemetry.incident_changes(spark, f"{folder}/gold", ", ".join(f"{c} {k}" for c, k in changes.dtypes))
    telemetry.safety_status_stream(feed, url, "s", props, f"{folder}/c3").awaitTermination(180)
    assert spark.read.jdbc(url, "s", properties=props).count() == 2


def minute(spark, rows):
    """A bronze batch of (epoch second, vin, speed)."""
    cols = "driver_id string, lat double, long double, speed bigint, vin string, kafka_timestamp bigint, value_str string, topic string, partition int, offset long, ingestion_timestamp bigint, ingestion_date date"
    return spark.createDataFrame([("D1", 1.0, 2.0, speed, vin, at, "x", "t", 0, 0, at, dt.date(2024, 5, 1)) for at, vin, speed in rows], cols)


@pytest.fixture
def fleet_folder(spark, folder):
    tables.write_snapshot(spark.createDataFrame([("V1", "D1", dt.date(2024, 1, 1), None, 100.0)], "vin string, driver_id string, start_date date, end_date date, daily_rate double"), f"{folder}/assets", 1)
    put(f"{folder}/zones.json", json.dumps([{"zone_name": "Z", "min_lat": 50.0, "max_lat": 51.0, "min_long": 1.0, "max_long": 3.0}]))
    return folder


def test_silver_keeps_every_epoch_and_replays(spark, fleet_folder):
    at, day = 1_714_521_600, 86_400
    batches = [[(at, "V1", 120), (at + 5, "V1", 10)], [(at + 5, "V1", 10), (at + 60, "V1", 130)], [(at + day, "V1", 20), (at, "V1", 120)]]
    run = lambda k: telemetry.silver_batch(minute(spark, batches[k]), k + 1, f"{fleet_folder}/silver", f"{fleet_folder}/arch", f"{fleet_folder}/zones.json", f"{fleet_folder}/assets")
    rows = lambda: sorted((r.event_date, r.speed, r.epoch) for r in tables.read_epochs(spark, f"{fleet_folder}/silver", "event_date").collect())
    for k in range(3):
        run(k)
    want = [("2024-05-01", 10, 1), ("2024-05-01", 120, 1), ("2024-05-01", 130, 2), ("2024-05-02", 20, 3)]
    assert rows() == want
    run(1)
    assert rows() == want
    # only the folders of the asked day are read, and the plan does not know of epochs
    one = tables.read_epochs(spark, f"{fleet_folder}/silver", "event_date", ["2024-05-02"], below=9)
    assert [r.speed for r in one.collect()] == [20]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and plan.count("Scan parquet") == 1
    tables.compact(spark, f"{fleet_folder}/silver", "event_date", "2024-05-01", ["vin", "event_timestamp"])
    assert [(d, s) for d, s, _ in rows()] == [(d, s) for d, s, _ in want]
    tables.compact(spark, f"{fleet_folder}/silver", "event_date", "2024-05-01", ["vin", "event_timestamp"])
    run(1)
    assert [(d, s) for d, s, _ in rows()] == [(d, s) for d, s, _ in want]


def test_incidents_go_on_by_month_and_end_assignments_once(spark, fleet_folder):
    def sessions(k, n):
        rows = [("D1", "V1", dt.datetime(2024, 5, 1 + k, h), dt.datetime(2024, 5, 1 + k, h, 5), 120, None, "OVERSPEEDING") for h in range(n)] + [("D7", "V7", dt.datetime(2024, 5, 1 + k), dt.datetime(2024, 5, 1 + k, 0, 5), 120, None, "OVERSPEEDING")]
        return spark.createDataFrame(rows, "driver_id string, vin string, start_ts timestamp, end_ts timestamp, max_speed long, zone_name string, strike_type string")

    gold, assets = f"{fleet_folder}/gold", f"{fleet_folder}/assets"
    rows = lambda: sorted((r.strike_number, r.incident_ts.day, r.epoch) for r in tables.read_epochs(spark, f"{gold}/incidents", "month_year").collect())
    telemetry.incident_batch(sessions(0, 6), 1, gold, assets)
    telemetry.incident_batch(sessions(1, 6), 2, gold, assets)
    want = [(k, 1, 1) for k in range(1, 7)] + [(k, 2, 2) for k in range(7, 11)]
    assert rows() == want and tables.versions(spark, assets) == [1, 2]
    telemetry.incident_batch(sessions(0, 6), 1, gold, assets)
    assert rows() == want and tables.versions(spark, assets) == [1, 2]
    assert tables.read_table(spark, assets).first().end_date == dt.date(2024, 5, 2)
    assert {r.driver_id for r in spark.read.parquet(f"{gold}/unassigned").collect()} == {"D7"}


def test_a_late_row_is_dropped_after_the_watermark(spark, folder):
    schema = "driver_id string, vin string, event_timestamp timestamp, is_violation boolean, speed long, breached_zone_name string, strike_type string"
    at = dt.datetime(2024, 5, 1)
    for k, minutes in enumerate(([0, 2], [60], [90], [1], [150])):  # the fourth file comes late; the watermark of the batch before counts
        rows = [("D1", "V1", at + dt.timedelta(minutes=m), True, 120 + k, None, "OVERSPEEDING") for m in minutes]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    got = []
    stream = telemetry.session_stream(telemetry.file_source(spark, f"{folder}/in", schema, files=1))
    telemetry.each_batch(stream, lambda d, e: got.extend(d.collect()), f"{folder}/c").awaitTermination(180)
    assert [(r.start_ts, r.max_speed) for r in sorted(got, key=lambda r: r.start_ts)] == [(at, 120), (at + dt.timedelta(hours=1), 121), (at + dt.timedelta(minutes=90), 122)]


def test_gold_and_exports(spark, folder):
    from drayage.plans import gold

    cols = "vin string, driver_id string, start_date date, end_date date, daily_rate double, region string, status string"
    first = spark.createDataFrame([("V1", "D1", dt.date(2024, 1, 1), None, 9.0, "N", "IN-TRANSIT"), ("V2", "D2", dt.date(2024, 1, 1), None, 9.0, "N", "IN-TRANSIT")], cols)
    second = spark.createDataFrame([("V1", "D1", dt.date(2024, 1, 1), dt.date(2024, 2, 1), 9.0, "N", "ARCHIVED"), ("V1", "D3", dt.date(2024, 2, 1), None, 8.0, "N", "IN-TRANSIT")], cols)
    registry = spark.createDataFrame([("V1", "M"), ("V2", "M")], "vin string, model string")
    url, props = f"jdbc:derby:{folder}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    export = lambda: gold.export_changes(spark, f"{folder}/asset_history", gold.ASSET_HISTORY, f"{folder}/positions", url, props)
    assert export() is None
    gold.vehicle_gold(spark, first, registry, folder, 1)
    jdbc.overwrite(first.limit(0), url, gold.ASSET_HISTORY[0], props, ["vin"])
    assert export() == 1 and export() is None
    gold.vehicle_gold(spark, second, registry, folder, 2)
    assert {r.vin: r._change_type for r in tables.read_changes(spark, f"{folder}/asset_history", 2).where("end_date IS NULL AND start_date = '2024-02-01'").collect()} == {"V1": "insert"}
    assert export() == 2 and tables.load_position(spark, f"{folder}/positions", "asset_version") == 3
    held = spark.read.jdbc(url, gold.ASSET_HISTORY[0], properties=props)
    assert sorted(map(tuple, held.collect()), key=str) == sorted(map(tuple, tables.read_table(spark, f"{folder}/asset_history").collect()), key=str) and held.count() == 3
    assert gold.export_snapshot(spark, f"{folder}/fleet_snapshot", "fleet", url, props) and not gold.export_snapshot(spark, f"{folder}/none", "fleet", url, props)
    assert [tuple(r) for r in spark.read.jdbc(url, "fleet", properties=props).collect()] == [("M", 1)]
    for v in range(3, 15):
        tables.write_snapshot(first, f"{folder}/kept", v, hashed=["vin"], keep=3)
    assert tables.versions(spark, f"{folder}/kept") == [12, 13, 14]
    assert tables.empty(spark, "a string, b int").dtypes == [("a", "string"), ("b", "int")]


@pytest.mark.parametrize("feed", sorted(landing.REQUIRED))
def test_every_feed_lands(spark, folder, feed):
    import os

    os.makedirs(f"{folder}/in")
    columns = landing.REQUIRED[feed]
    put(f"{folder}/in/good.csv", ",".join(columns).upper() + "\n" + ",".join(f'"{c}, 1"' for c in columns) + "\n")
    put(f"{folder}/in/bad.csv", ",".join(columns[:-2]) + "\n1,2\n")
    found = {r.file_name: r.file_status for r in landing.ingest(spark, feed, f"{folder}/in", f"{folder}/bronze", f"{folder}/manifest", "2024-05-01").collect()}
    assert found == {"good.csv": "PROCESSED", "bad.csv": "REJECTED:MISSING_REQUIRED_COLUMNS:" + ",".join(columns[-2:])}
    assert [r[columns[0]] for r in spark.read.parquet(f"{folder}/bronze").collect()] == [f"{columns[0]}, 1"]


def test_rolling_median_blocks(spark):
    from drayage.operators import rolling

    d = spark.range(400).selectExpr("id % 3 as k", "date_add(date'2023-11-20', cast(id * 7 % 131 as int)) as day", "cast(id * 37 % 101 as double) as v").unionByName(spark.createDataFrame([(1, None, 5.0)], "k long, day date, v double"))
    rows = d.collect()
    for r in rolling.rolling_median(d, ["k"], "day", "v", 30, "m").collect():
        before = sorted(x.v for x in rows if r.day and x.day and x.k == r.k and 1 <= (r.day - x.day).days <= 30)
        assert r.m == (before[(len(before) - 1) // 2] if before else None)
    assert rolling.rolling_median(d, ["k"], "day", "v").count() == len(rows)


@pytest.mark.parametrize("rows", [3_000, 60_000])
def test_fanned_out_medians_are_exact(spark, rows):
    """As many values as make a sketch inexact; equal ones, a drift over the days, null keys, days and values among them."""
    from drayage.operators import rolling

    key, value = "case when id % 11 = 0 then null when id % 7 = 0 then 'b' else 'a' end", "case when id % 13 = 0 then null when id % 5 = 0 then 3.5 else hash(id) % 100003 / 7 + id end"
    d = spark.range(rows).selectExpr(f"{key} as k", f"case when id % 101 <> 0 then date_add(date'2023-11-20', cast(id * 90 div {rows} as int)) end as day", f"cast({value} as double) as v", "id")
    values = {}
    for r in d.collect():
        if r.day and r.v is not None:
            values.setdefault((r.k, r.day), []).append(r.v)
    want = {}
    for k, day in {(r.k, r.day) for r in d.select("k", "day").distinct().collect()}:
        before = sorted(v for (k2, x), some in values.items() if day and k2 == k and 1 <= (day - x).days <= 30 for v in some)
        want[k, day] = before[(len(before) - 1) // 2] if before else None
    got = rolling.rolling_median_fanout(d, ["k"], "day", "v", 30, "m")
    assert got.columns == ["k", "day", "v", "id", "m"]
    got = got.collect()
    assert len(got) == rows and not [r for r in got if r.m != want[r.k, r.day]][:3]


def test_feeds_go_from_landing_to_gold_and_a_second_day_merges(spark, folder):
    import os

    from drayage.plans import gold, silver

    at = lambda day: int(dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc).timestamp())

    def land(feed, day, text):
        os.makedirs(f"{folder}/in/{feed}", exist_ok=True)
        put(f"{folder}/in/{feed}/{day}.csv", text)
        landing.ingest(spark, feed, f"{folder}/in/{feed}", f"{folder}/bronze/{feed}", f"{folder}/manifest/{feed}", f"2024-06-{day:02d}")

    counts = {}

    def run(v):
        b, s, a = f"{folder}/bronze", f"{folder}/silver", f"{folder}/archive"
        counts["registry"] = silver.registry(spark, f"{b}/registry", f"{s}/registry", a, v, "2024-12-31")
        counts["assignment"] = silver.assignment(spark, f"{b}/assignment", f"{s}/registry", f"{s}/assignment", a, v)
        counts["fuel"] = silver.fuel(spark, f"{b}/fuel", f"{s}/fuel", a, v, "2024-12-31")
        silver.maintenance(spark, f"{b}/maintenance", f"{s}/maintenance", a, v)
        gold.vehicle_gold(spark, tables.read_table(spark, f"{s}/assignment"), tables.read_table(spark, f"{s}/registry"), f"{folder}/gold", v)
        silver.fuel_audit(spark, f"{s}/fuel", f"{s}/registry", f"{folder}/gold/asset_history", f"{s}/maintenance", f"{folder}/gold/audit", v)

    land("registry", 1, "vin,model,mfg_year,fuel_type\nv0000001,M,2020,diesel\nV0000002,M,2030,diesel\nV0000003,N,2021,petrol\n")
    land("assignment", 1, f"vin,driver_id,start_timestamp,end_timestamp,daily_rate,region\nV0000001,d1,{at(1)},,100,N\nV0000003,D3,{at(1)},{at(1) - 90000},100,N\nV0000009,D9,{at(1)},,100,N\nV0000001,D2,{at(9)},,x,N\n")
    land("fuel", 1, "transaction_id,vin,fuel_liters,odometer_reading,timestamp\nt1,V0000001,10,100,2024-01-02 08:00:00\nt2,V0000001,10,200,2024-01-03 08:00:00\nt3,V0000001,-1,300,2024-01-04 08:00:00\nt4,V0000001,5,400,soon\nt5,V0000001,10,320,2024-01-04 08:00:00\n")
    land("maintenance", 1, "vin,service_date,service_type\nV0000001,2024-01-04,oil\nV0000001,2024-01-04,oil \nV0000001,never,oil\n")
    run(1)
    # counters come with the write of the labelled rows
    assert (counts["registry"]["total"], counts["registry"]["clean"], counts["registry"]["INVALID_REGISTRY_RECORD"]) == (3, 2, 1)
    assert {k: n for k, n in counts["fuel"].items() if n} == {"total": 5, "clean": 3, "Negative or zero fuel": 1, "Null keys": 1}
    assert counts["assignment"]["UNKNOWN_VIN"] == 1
    held = lambda name: sorted(map(tuple, tables.read_table(spark, f"{folder}/silver/{name}").collect()), key=str)
    assert held("registry") == [("V0000001", "M", 2020, "DIESEL"), ("V0000003", "N", 2021, "PETROL")]
    assert [(r[0], r[1], r[6]) for r in held("assignment")] == [("V0000001", "D1", "IN-TRANSIT")]
    assert {r.error_reason for r in spark.read.parquet(f"{folder}/archive/assignment").collect()} == {"INVALID_ASSIGNMENT_RECORD", "UNKNOWN_VIN"}
    assert {r.error_reason for r in spark.read.parquet(f"{folder}/archive/fuel").collect()} == {"Negative or zero fuel", "Null keys"}
    assert [r.distance for r in tables.read_table(spark, f"{folder}/silver/fuel/distance").orderBy("timestamp").collect()] == [100.0, 120.0]
    assert len(held("maintenance")) == 1
    audit = tables.read_table(spark, f"{folder}/gold/audit").collect()
    assert [(r.audit_date.isoformat(), r.km_per_liter, r.status) for r in audit] == [("2024-01-03", 10.0, "INSUFFICIENT_DATA")]
    land("registry", 2, "vin,model,mfg_year,fuel_type\nV0000001,M2,2022,diesel\n")
    land("assignment", 2, f"vin,driver_id,start_timestamp,end_timestamp,daily_rate,region\nV0000001,D5,{at(20)},,90,S\n")
    run(2)
    assert held("registry") == [("V0000001", "M2", 2022, "DIESEL"), ("V0000003", "N", 2021, "PETROL")]
    assert [(r[1], str(r[3]), r[6]) for r in held("assignment")] == [("D1", "2024-01-20", "ARCHIVED"), ("D5", "None", "IN-TRANSIT")]
    changed = tables.read_changes(spark, f"{folder}/silver/registry", 2).collect()
    assert sorted((r.vin, r._change_type) for r in changed) == [("V0000001", "update_postimage"), ("V0000001", "update_preimage")]
    assert [tuple(r) for r in tables.read_table(spark, f"{folder}/gold/fleet_snapshot").collect()] == [("M2", 1)]

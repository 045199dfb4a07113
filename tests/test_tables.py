"""What tables must not lose: rows of epochs that land during a rewrite, suspensions, change rows of any run, files of untouched parts."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from drayage.operators import merge
from drayage.plans import gold
from drayage.sources import jdbc, tables
from drayage.streaming import telemetry

HISTORY = "vin string, driver_id string, start_date date, end_date date, daily_rate double, region string, status string"


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="spark-")


def files(folder):
    return {os.path.join(d, n) for d, _, names in os.walk(folder) for n in names if n.endswith(".parquet")}


def orders(spark, rows):
    return spark.createDataFrame(rows, "k int, day date, v string")


def merged(spark, path, rows, run, **more):
    return tables.merge_table(orders(spark, rows), path, run, ["k", "day"], F.date_format("day", "yyyy-MM"), **more)


def held(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_a_merge_touches_its_months_only_and_has_its_changes(spark, folder):
    jan, feb, mar = dt.date(2024, 1, 5), dt.date(2024, 2, 5), dt.date(2024, 3, 5)
    assert merged(spark, folder, [(1, jan, "a"), (2, feb, "b")], "first") == 1
    before = files(folder)
    assert merged(spark, folder, [(2, feb, "c"), (3, mar, "d")], "second") == 2
    assert before <= files(folder)
    new = {f for f in files(folder) - before if "rows=table" in f}
    assert {f.split("part=")[1][:7] for f in new} == {"2024-02", "2024-03"}
    assert held(tables.read_table(spark, folder), "k", "v") == [(1, "a"), (2, "c"), (3, "d")]
    assert held(tables.read_table(spark, folder, below=2), "k", "v") == [(1, "a"), (2, "b")]
    assert held(tables.read_table(spark, folder, parts=["2024-01"]), "k", "v") == [(1, "a")]
    changes = held(tables.read_changes(spark, folder, 2), "k", "v", "_change_type", "_commit_version")
    assert changes == [(2, "b", "update_preimage", 2), (2, "c", "update_postimage", 2), (3, "d", "insert", 2)]
    # the newest run again replaces itself; an older one, on which another was built, changes nothing
    assert merged(spark, folder, [(2, feb, "c"), (3, mar, "e")], "second") == 2
    assert merged(spark, folder, [(1, jan, "z")], "first") == 1
    assert held(tables.read_table(spark, folder), "k", "v") == [(1, "a"), (2, "c"), (3, "e")]
    assert held(tables.read_changes(spark, folder, 0), "k", "_commit_version", "_change_type")[:2] == [(1, 1, "insert"), (2, 1, "insert")]
    # many versions later the oldest part is still there, and superseded ones are gone
    for n in range(6):
        merged(spark, folder, [(2, feb, f"n{n}")], f"more-{n}", keep=2)
    assert held(tables.read_table(spark, folder), "k", "v") == [(1, "a"), (2, "n5"), (3, "e")]
    assert len([f for f in files(folder) if "rows=table/part=2024-02" in f or "rows=whole/part=2024-02" in f]) == 2
    assert merged(spark, folder, [], "nothing") == 8


def test_added_columns_reach_table_and_feed(spark, folder):
    jan, feb = dt.date(2024, 1, 5), dt.date(2024, 2, 5)
    merged(spark, folder, [(1, jan, "a"), (2, feb, "b")], "1")
    wide = orders(spark, [(2, feb, "c")]).withColumn("w", F.lit(7))
    assert tables.merge_table(wide, folder, "2", ["k", "day"], F.date_format("day", "yyyy-MM")) == 2
    assert held(tables.read_table(spark, folder), "k", "v", "w") == [(1, "a", None), (2, "c", 7)]
    assert held(tables.read_changes(spark, folder, 2), "v", "w", "_change_type") == [("b", None, "update_preimage"), ("c", 7, "update_postimage")]
    # a table that is replaced as a whole tells of rows that went
    tables.merge_table(orders(spark, [(1, jan, "x")]), folder, "3", ["k", "day"], F.date_format("day", "yyyy-MM"), whole=True)
    assert held(tables.read_table(spark, folder), "k", "v") == [(1, "x")]
    assert held(tables.read_changes(spark, folder, 3), "k", "_change_type") == [(1, "update_postimage"), (1, "update_preimage"), (2, "delete")]
    with pytest.raises(ValueError):
        tables.merge_table(orders(spark, []), folder, "4", ["k", "day"], whole=True)


def test_conditions_columns_and_expressions_of_a_merge(spark):
    t = spark.createDataFrame([(1, 5, "a"), (2, 5, "b"), (3, None, "c")], "k int, n int, v string")
    s = spark.createDataFrame([(1, 9, "x"), (2, 1, "y"), (3, 4, None), (4, 4, "w")], "k int, n int, v string")
    out = lambda **m: held(merge.with_changes(t, s, ["k"], **m).where("_change_type IS NULL"), "k", "n", "v")
    assert out() == [(1, 9, "x"), (2, 1, "y"), (3, 4, None), (4, 4, "w")]
    assert out(update=["n"]) == [(1, 9, "a"), (2, 1, "b"), (3, 4, "c"), (4, 4, "w")]
    assert out(when=F.col("s.n") > F.col("t.n")) == [(1, 9, "x"), (2, 5, "b"), (3, None, "c"), (4, 4, "w")]
    assert out(put={"n": F.least("t.n", "s.n")}) == [(1, 5, "x"), (2, 1, "y"), (3, 4, None), (4, 4, "w")]
    same = merge.with_changes(t, t, ["k"])
    assert same.where("_change_type IS NOT NULL").count() == 0 and same.count() == 3


def test_suspensions_outlast_gold_runs_and_reach_the_database(spark, folder):
    assignments = spark.createDataFrame([("V1", "D1", dt.date(2024, 4, 1), None, 9.0, "N", "IN-TRANSIT"), ("V2", "D2", dt.date(2024, 3, 1), None, 9.0, "N", "IN-TRANSIT")], HISTORY)
    registry = spark.createDataFrame([("V1", "M"), ("V2", "M")], "vin string, model string")
    path, url, props = f"{folder}/asset_history", f"jdbc:derby:{folder}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    jdbc.overwrite(assignments.limit(0), url, gold.ASSET_HISTORY[0], props, ["vin"])
    export = lambda: gold.export_changes(spark, path, gold.ASSET_HISTORY, f"{folder}/positions", url, props)
    gold.vehicle_gold(spark, assignments, registry, folder, 1)
    assert export() == 1
    hours = [("D1", "V1", dt.datetime(2024, 5, 1, h), dt.datetime(2024, 5, 1, h, 5), 120, None, "OVERSPEEDING") for h in range(10)]
    sessions = spark.createDataFrame(hours, "driver_id string, vin string, start_ts timestamp, end_ts timestamp, max_speed long, zone_name string, strike_type string")
    ends = lambda: {r.vin: r.end_date for r in tables.read_table(spark, path).collect()}
    want = {"V1": dt.date(2024, 5, 1), "V2": None}
    telemetry.incident_batch(sessions, 1, f"{folder}/incidents", path)
    assert ends() == want and tables.versions(spark, path) == [1, 2]
    for day in (2, 3):
        gold.vehicle_gold(spark, assignments, registry, folder, day)
        telemetry.incident_batch(sessions, 1, f"{folder}/incidents", path)
        assert ends() == want
    export()
    assert {r.vin: r.end_date for r in spark.read.jdbc(url, gold.ASSET_HISTORY[0], properties=props).collect()} == want
    # an earlier end from the feed wins
    gold.vehicle_gold(spark, assignments.withColumn("end_date", F.lit("2024-04-20").cast("date")), registry, folder, 4)
    assert set(ends().values()) == {dt.date(2024, 4, 20)}


def test_standings_and_audits_are_exported_and_keep_their_first_time(spark, folder):
    url, props = f"jdbc:derby:{folder}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    row = lambda n, at: ("D1", "2024-05", dt.datetime(2024, 5, n, 1), n, 5.0, 95.0, dt.datetime(2024, 5, n, 1), at)
    cols = "driver_id string, month_year string, incident_ts timestamp, strike_number int, deduction_amount double, adjusted_rate double, incident_created_ts timestamp, epoch long"
    for n in (1, 2):
        tables.write_epoch(spark.createDataFrame([row(n, 0)], cols).drop("epoch"), f"{folder}/incidents", n, "month_year")
        telemetry.write_standing(spark, folder, "2024-05", n, as_of=f"2024-06-0{n} 00:00:00")
        if n == 1:
            first = tables.read_table(spark, f"{folder}/standing")
            jdbc.overwrite(first.limit(0), url, gold.DRIVER_STANDING[0], props, ["driver_id", "month_year"])
        gold.export_changes(spark, f"{folder}/standing", gold.DRIVER_STANDING, f"{folder}/positions", url, props)
    telemetry.write_standing(spark, folder, "2024-05", 3, as_of="2024-06-09 00:00:00")
    got = spark.read.jdbc(url, gold.DRIVER_STANDING[0], properties=props).first()
    assert (got.current_strikes, got.updated_ts.day, got.created_ts.day) == (2, 2, 1)
    assert tables.read_table(spark, f"{folder}/standing").first().updated_ts.day == 2
    audit = spark.createDataFrame([("V1", dt.date(2024, 5, 1), "OK"), ("V2", dt.date(2024, 6, 1), "FLAGGED")], "vin string, audit_date date, status string")
    jdbc.overwrite(audit.limit(0), url, gold.FUEL_AUDIT[0], props, ["vin"])
    for n, rows in ((1, audit), (2, audit.withColumn("status", F.lit("OK")))):
        tables.merge_table(rows, f"{folder}/audit", str(n), ["vin", "audit_date"], F.date_format("audit_date", "yyyy-MM"), whole=True)
        gold.export_changes(spark, f"{folder}/audit", gold.FUEL_AUDIT, f"{folder}/positions", url, props)
    assert {r.status for r in spark.read.jdbc(url, gold.FUEL_AUDIT[0], properties=props).collect()} == {"OK"}


def events(spark, folder, epoch, numbers):
    rows = spark.createDataFrame([(n, "2024-05-01") for n in numbers], "n int, day string")
    tables.write_epoch(rows, folder, epoch, "day")


def test_compaction_loses_no_epoch(spark, folder, monkeypatch):
    read = lambda **k: sorted(r.n for r in tables.read_epochs(spark, folder, "day", **k).collect())
    events(spark, folder, 1, [1, 10])
    events(spark, folder, 2, [2])
    # an epoch that lands while the rewrite runs
    plain = tables.zordered

    def slow(*a):
        events(spark, folder, 3, [3])
        return plain(*a)

    monkeypatch.setattr(tables, "zordered", slow)
    tables.compact(spark, folder, "day", "2024-05-01", ["n"])
    monkeypatch.setattr(tables, "zordered", plain)
    assert read() == [1, 2, 3, 10] and read(values=["2024-05-01"]) == [1, 2, 3, 10]
    assert sorted(n for n in os.listdir(f"{folder}/day=2024-05-01")) == ["epoch=-1", "epoch=3"]
    # cut off after the rename: old folders are still there, readers pass over them, an epoch lands, the next run clears up
    with monkeypatch.context() as m:
        m.setattr(tables, "_clear_replaced", lambda *a: None)
        tables.compact(spark, folder, "day", "2024-05-01", ["n"])
    assert {"epoch=-1", "epoch=-2", "epoch=3"} <= set(os.listdir(f"{folder}/day=2024-05-01"))
    events(spark, folder, 4, [4])
    assert read() == [1, 2, 3, 4, 10] and read(below=4) == [1, 2, 3, 10]
    # cut off before the rename: the hidden folder counts for nothing
    os.makedirs(f"{folder}/day=2024-05-01/.compact-x")
    assert read() == [1, 2, 3, 4, 10]
    tables.compact(spark, folder, "day", "2024-05-01", ["n"])
    assert os.listdir(f"{folder}/day=2024-05-01") == ["epoch=-3"] and read() == [1, 2, 3, 4, 10]
    # streams do not see rows twice
    live = telemetry.silver_stream(spark, folder, "n int, day string, epoch long")
    seen = []
    telemetry.each_batch(live, lambda d, e: seen.extend(d.collect()), f"{folder}-c").awaitTermination(120)
    assert seen == []


def test_bad_payloads_are_kept_apart_and_recent_copies_stay_in_state(spark, folder):
    at = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)
    good = json.dumps({"driver_id": "D1", "lat": 1.0, "long": 2.0, "speed": 5, "vin": "V1"})
    raw = lambda rows: spark.createDataFrame([(v, "t", 0, k, at) for k, v in rows], "value string, topic string, partition int, offset long, timestamp timestamp")
    now = F.lit("2024-05-02 00:00:00").cast("timestamp")
    tables.write_snapshot(spark.createDataFrame([("V1", "D1", dt.date(2024, 1, 1), None)], "vin string, driver_id string, start_date date, end_date date"), f"{folder}/assets", 1)
    with open(f"{folder}/zones.json", "w") as f:
        f.write(json.dumps([{"zone_name": "Z", "min_lat": 50.0, "max_lat": 51.0, "min_long": 1.0, "max_long": 3.0}]))
    batch = telemetry.flatten(raw([(0, "x"), (1, "y"), (2, "{}"), (2, "{}"), (3, good), (4, good)]), now)
    telemetry.silver_batch(batch, 1, f"{folder}/silver", f"{folder}/arch", f"{folder}/zones.json", f"{folder}/assets")
    assert held(spark.read.parquet(f"{folder}/arch/errors"), "offset", "error_reason") == [(k, "NULL_KEY") for k in range(3)]
    assert tables.read_epochs(spark, f"{folder}/silver", "event_date").count() == 1
    # a copy in the next batch, after a restart of the stream
    schema, seen = "value string, topic string, partition int, offset long, timestamp timestamp", []
    for rows in ([(5, good), (6, "bad")], [(7, good), (8, "bad")]):
        raw(rows).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = telemetry.once_within(telemetry.flatten(telemetry.file_source(spark, f"{folder}/in", schema, files=1), now))
        telemetry.each_batch(stream, lambda d, e: seen.extend(r.offset for r in d.collect()), f"{folder}/c").awaitTermination(180)
    assert sorted(seen) == [5, 6, 8]


def test_a_filter_on_the_second_column_reads_few_files_of_a_z_order(spark, folder):
    d = spark.range(40_000).selectExpr("format_string('V%05d', id * 7919 % 2000) vin", "timestamp_seconds(1700000000 + id * 104729 % 40000 * 60) at", "cast(id as int) n")
    tables.zordered(d, ["vin", "at"], 16).write.parquet(f"{folder}/z")
    all_files = files(f"{folder}/z")
    spans = spark.read.parquet(f"{folder}/z").groupBy(F.input_file_name()).agg(F.min("vin").alias("lv"), F.max("vin").alias("hv"), F.min("at").alias("la"), F.max("at").alias("ha"))
    hit = lambda lo, hi, value: spans.where((F.col(lo) <= value) & (F.col(hi) >= value)).count()
    middle = F.timestamp_seconds(F.lit(1_700_000_000 + 20_123 * 60))
    assert len(all_files) >= 12 and hit("la", "ha", middle) <= len(all_files) // 2 and hit("lv", "hv", F.lit("V00777")) <= len(all_files) // 2
    # a lexicographic order has every file read for the second column
    d.repartitionByRange(16, "vin", "at").sortWithinPartitions("vin", "at").write.parquet(f"{folder}/lex")
    lex = spark.read.parquet(f"{folder}/lex").groupBy(F.input_file_name()).agg(F.min("at").alias("la"), F.max("at").alias("ha"))
    assert lex.where((F.col("la") <= middle) & (F.col("ha") >= middle)).count() >= 12
    # the same for a merged table
    month = F.date_format("day", "yyyy-MM")
    rows = d.selectExpr("n k", "cast(at as date) day", "vin v")
    tables.merge_table(rows, f"{folder}/t", "1", ["k", "day"], month)
    assert tables.optimize(spark, f"{folder}/t", ["v", "day"]) == 2
    assert tables.read_table(spark, f"{folder}/t").count() == 40_000 and tables.read_changes(spark, f"{folder}/t", 2) is None
    odd = spark.createDataFrame([(None, None), ("a", 1.0), (None, 2.0), ("b", None)], "s string, x double")
    assert tables.zordered(odd, ["s", "x"]).count() == 4 and tables.zordered(odd.limit(0), ["s", "x"]).count() == 0


def test_an_epoch_reaches_the_database_once(spark, folder):
    import threading

    url, props = f"jdbc:derby:{folder}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    row = lambda v: spark.createDataFrame([(1, v)], "k int, v int")
    jdbc.overwrite(row(0), url, "t", props)
    held_now = lambda: [tuple(r) for r in spark.read.jdbc(url, "t", properties=props).collect()]
    put = lambda v, n, stream="s": jdbc.staged_upsert(row(v), url, "t", ["k"], props, epoch=(stream, n))
    assert put(1, 0) and put(2, 1) and not put(3, 1) and not put(4, 0) and held_now() == [(1, 2)]
    assert put(5, 0, "other") and held_now() == [(1, 5)]
    # two writers of one epoch at once
    done = []
    both = [threading.Thread(target=lambda v=v: done.append((v, put(v, 2)))) for v in (6, 7)]
    for t in both:
        t.start()
    for t in both:
        t.join(120)
    assert sorted(x for _, x in done) == [False, True] and held_now() == [(1, next(v for v, x in done if x))]
    # a batch that fails leaves neither rows nor its number, nor a staging table
    with pytest.raises(Exception, match="NOPE|nope"):
        jdbc.staged_upsert(spark.createDataFrame([(1, 9)], "k int, nope int"), url, "t", ["k"], props, epoch=("s", 3))
    assert put(8, 3) and held_now() == [(1, 8)]
    names = [r[0] for r in spark.read.jdbc(url, "SYS.SYSTABLES", properties=props).select("TABLENAME").collect()]
    assert not [n for n in names if "STAGE" in n.upper()]


def test_a_landing_run_that_died_is_done_again_and_bronze_compacts(spark, folder, monkeypatch):
    from drayage.sources import landing

    os.makedirs(f"{folder}/in")
    put = lambda name, rows: open(f"{folder}/in/{name}.csv", "w").write("vin,model,mfg_year,fuel_type\n" + "".join(f"V{n},M,2020,D\n" for n in rows))
    run = lambda day: landing.ingest(spark, "registry", f"{folder}/in", f"{folder}/bronze", f"{folder}/manifest", f"2024-05-0{day} 00:00:00")
    vins = lambda: sorted(r.vin for r in tables.read_epochs(spark, f"{folder}/bronze", "ingestion_date").collect())
    put("a", [1, 2])
    with monkeypatch.context() as m:
        m.setattr(landing, "manifest_rows", lambda *a: spark.createDataFrame([("x",)], "boom string"))
        with pytest.raises(Exception):
            run(1)
    assert vins() == ["V1", "V2"] and not tables.table_exists(spark, f"{folder}/manifest")
    put("b", [3])
    run(2)
    assert vins() == ["V1", "V2", "V3"]
    assert {(r.file_name, r.processed_at.day) for r in spark.read.parquet(f"{folder}/manifest").collect()} == {("a.csv", 1), ("b.csv", 1)}
    put("c", [4])
    run(2)
    put("d", [5, 4])
    run(2)
    assert vins() == ["V1", "V2", "V3", "V4", "V5"]
    tables.compact(spark, f"{folder}/bronze", "ingestion_date", "2024-05-02", ["vin"])
    assert os.listdir(f"{folder}/bronze/ingestion_date=2024-05-02") == ["epoch=-1"] and vins() == ["V1", "V2", "V3", "V4", "V5"]
    errors = spark.createDataFrame([("V1", "BAD")], "vin string, error_reason string")
    for n in (1, 2):
        tables.archive(errors, f"{folder}/arch", str(n), "error_reason")
    tables.compact(spark, f"{folder}/arch", "error_reason", "BAD", ["vin"])
    assert tables.read_epochs(spark, f"{folder}/arch", "error_reason").count() == 2


def test_files_to_keyed_messages_to_bronze(spark, folder):
    """The path through a broker, with a folder in its place: lines, keyed messages, typed rows, files of bounded size."""
    os.makedirs(f"{folder}/lines")
    rows = [{"driver_id": f"D{n % 3}", "lat": n / 2, "long": -1.0, "speed": n, "vin": f"V{n % 3}"} for n in range(50)]
    with open(f"{folder}/lines/a.json", "w") as f:
        f.write("\n".join(map(json.dumps, rows)))
    messages = telemetry.keyed_messages(telemetry.file_source(spark, f"{folder}/lines", telemetry.PAYLOAD, "json"))
    sent = messages.writeStream.format("parquet").option("path", f"{folder}/topic").option("checkpointLocation", f"{folder}/c0").trigger(availableNow=True).start()
    sent.awaitTermination(120)
    assert {r.key for r in spark.read.parquet(f"{folder}/topic").collect()} == {"D0", "D1", "D2"}
    held = spark.read.parquet(f"{folder}/topic").withColumns({"topic": F.lit("t"), "partition": F.pmod(F.hash("key"), F.lit(2)), "offset": F.monotonically_increasing_id(), "timestamp": F.lit("2024-05-01 10:00:00").cast("timestamp")})
    held.coalesce(1).write.parquet(f"{folder}/broker")
    stream = telemetry.file_source(spark, f"{folder}/broker", "key string, value string, topic string, partition int, offset long, timestamp timestamp")
    bronze = telemetry.flatten(stream, F.lit("2024-05-02 00:00:00").cast("timestamp"))
    telemetry.append_stream(bronze, f"{folder}/bronze", f"{folder}/c1", rows_a_file=20).awaitTermination(120)
    got = spark.read.parquet(f"{folder}/bronze")
    assert sorted((r.vin, r.speed) for r in got.collect()) == sorted((r["vin"], r["speed"]) for r in rows)
    sizes = [r["count"] for r in got.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) <= 20 and len(sizes) == 3

"""Telemetry streams: source to bronze, bronze to silver, silver to sessions, incidents and JDBC."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from drayage.functions.values import surrogate_id
from drayage.operators import quality, strikes
from drayage.operators.history import disjoint
from drayage.plans import gold as gold_jobs
from drayage.plans import jobs
from drayage.sources import jdbc
from drayage.sources.tables import archive, merge_table, read_epochs, read_table, require_nonempty, write_epoch

#: The fields of a broker message's payload and of the zone file.
PAYLOAD = "driver_id string, lat double, long double, speed bigint, vin string"
ZONES = "zone_name string, min_lat double, max_lat double, min_long double, max_long double"


def kafka_source(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", most: int = 60_000) -> DataFrame:
    r = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return r.option("startingOffsets", starting).option("maxOffsetsPerTrigger", most).load()


def file_source(spark: SparkSession, folder: str, schema: str, kind: str = "parquet", files: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(kind).load(folder)


def keyed_messages(lines: DataFrame, key: str = "driver_id") -> DataFrame:
    """(key, value) of broker messages: rows as JSON, keyed so that a driver's messages keep their order in one partition."""
    return lines.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def to_topic(lines: DataFrame, servers: str, topic: str, checkpoint: str, key: str = "driver_id") -> StreamingQuery:
    """Rows as JSON messages; the checkpoint makes it resumable."""
    w = keyed_messages(lines, key).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return w.option("topic", topic).option("checkpointLocation", checkpoint).start()


def flatten(messages: DataFrame, as_of: F.Column | None = None) -> DataFrame:
    """Broker messages (value, topic, partition, offset, timestamp) as typed columns; a bad payload leaves nulls."""
    now = as_of if as_of is not None else F.current_timestamp()
    m = messages.select(
        F.col("value").cast("string").alias("value_str"), "topic", "partition", "offset", F.col("timestamp").cast("long").alias("kafka_timestamp")
    ).withColumn("payload", F.from_json("value_str", PAYLOAD))
    return m.select("value_str", "topic", "partition", "offset", "kafka_timestamp", "payload.*").withColumn("ingestion_timestamp", now.cast("long")).withColumn("ingestion_date", now.cast("date"))


def append_stream(df: DataFrame, out: str, checkpoint: str, partition: str = "ingestion_date", every: str | None = None, rows_a_file: int = 1_000_000) -> StreamingQuery:
    w = df.writeStream.format("parquet").partitionBy(partition).option("maxRecordsPerFile", rows_a_file).option("path", out).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def each_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None) -> StreamingQuery:
    w = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=every) if every else w.trigger(availableNow=True)).start()


def moments(bronze: DataFrame) -> tuple[DataFrame, list[str]]:
    """(events with event_timestamp and the columns that tell copies apart, their names): vehicle, moment and place to six decimals.

    A message that lacks one of them is a copy of the same message only, by topic, partition and offset, so bad payloads of
    one moment do not collapse into one.
    """
    t = bronze.withColumn("event_timestamp", F.timestamp_seconds("kafka_timestamp"))
    own = {f"__{c}": F.col(c).try_cast("decimal(10,6)") for c in ("lat", "long")}
    keyless = F.col("vin").isNull() | F.col("event_timestamp").isNull() | F.col("lat").isNull() | F.col("long").isNull()
    message = F.when(keyless, F.concat_ws("-", "topic", "partition", "offset"))
    return t.withColumns(own | {"__message": message}), ["vin", "event_timestamp", "__lat", "__long", "__message"]


def once_within(bronze: DataFrame, late: str = "10 minutes") -> DataFrame:
    """A stream of events without copies that come within `late`: recent keys are state of the stream, which survives a restart.

    What gets through is what silver_batch has to look for in its table: copies that come later than that.
    """
    t, keys = moments(bronze)
    # an event without a moment cannot wait in state: the clock of its arrival stands for it
    t = t.withColumn("__seen", F.coalesce("event_timestamp", F.timestamp_seconds("ingestion_timestamp"))).withWatermark("__seen", late)
    return t.dropDuplicatesWithinWatermark(keys).drop("__seen", "__lat", "__long", "__message", "event_timestamp")


def silver_batch(batch: DataFrame, epoch: int, silver: str, archives: str, zones: str, assignments: str, limit: int = 110) -> None:
    """One micro-batch: dedup, label, classify trips, find breaches, add new events by date and epoch.

    Replaying an epoch replaces its own folders. Events that earlier epochs have are found by one anti join with the folders
    of the batch's dates; those of other dates are not even listed.
    """
    spark = batch.sparkSession
    t, keys = moments(batch)
    t = t.dropDuplicates(keys).drop("__lat", "__long", "__message")
    t = t.withColumn("event_id", surrogate_id(["driver_id", "vin", "event_timestamp", "lat", "long"])).withColumn("event_date", F.date_format("event_timestamp", "yyyy-MM-dd"))
    history = require_nonempty(read_table(spark, assignments), "asset history")
    boxes = spark.read.schema(ZONES).option("multiLine", True).json(zones)
    labelled = jobs.telemetry_labelled(t).persist()
    try:
        clean, errors = quality.split(labelled)
        archive(errors, f"{archives}/errors", str(epoch), "error_reason")
        trips = jobs.trips(clean, history, sweep=disjoint(history, ["vin"]))
        archive(trips.where("trip_type != 'VALID'"), f"{archives}/invalid", str(epoch), "trip_type")
        valid = trips.where("trip_type = 'VALID'").select(*clean.columns)
        found = jobs.violations(valid, boxes, limit).drop("value_str", "topic", "partition", "offset", "kafka_timestamp", "ingestion_timestamp", "ingestion_date")
        dates = [r[0] for r in labelled.select("event_date").where("event_date IS NOT NULL").distinct().collect()]
        held = read_epochs(spark, silver, "event_date", dates, below=epoch)
        if held is not None:
            found = found.join(held.select("event_id", "event_date"), ["event_id", "event_date"], "left_anti")
        write_epoch(found, silver, epoch, "event_date")
    finally:
        labelled.unpersist()


def silver_stream(spark: SparkSession, silver: str, schema: str, files: int = 20) -> DataFrame:
    """The silver table as a stream: files are read once, in the order in which epochs wrote them; rewritten ones are passed over."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(silver).where("epoch >= 0")


def session_stream(silver: DataFrame, gap: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Violations of a stream as sessions, emitted once the watermark has passed their end; later rows are dropped."""
    return strikes.sessions(silver.where("is_violation").withWatermark("event_timestamp", late), gap)


def incident_batch(batch: DataFrame, epoch: int, gold: str, assignments: str) -> None:
    """Closed sessions of a batch as incidents, added by month and epoch, and a change file for this epoch.

    Strike numbers follow arrival: a month's later batch goes on where the table stood below this epoch. Only the months of
    the batch are read. Sessions that no assignment covers go to an archive. Replaying an epoch replaces what it wrote; an
    assignment is ended once.
    """
    spark = batch.sparkSession
    history = require_nonempty(read_table(spark, assignments), "asset history")
    # the batch is worked out once: what follows reads the written sessions
    batch.write.mode("overwrite").parquet(f"{gold}/sessions/epoch={epoch}")
    batch = spark.read.schema(batch.schema).parquet(f"{gold}/sessions/epoch={epoch}")
    months = [r[0] for r in batch.select(F.date_format("start_ts", "yyyy-MM")).distinct().collect()]
    existing = read_epochs(spark, f"{gold}/incidents", "month_year", months, below=epoch)
    standing = read_table(spark, f"{gold}/standing")
    new = jobs.incidents(batch, history, existing, standing).withColumn("incident_created_ts", F.col("incident_ts")).persist()
    try:
        write_epoch(new, f"{gold}/incidents", epoch, "month_year")
        new.withColumn("_change_type", F.lit("insert")).withColumn("_commit_version", F.lit(epoch).cast("long")).write.mode("overwrite").parquet(f"{gold}/changes/epoch={epoch}")
        archive(jobs.unassigned(batch, history), f"{gold}/unassigned", str(epoch))
        ended = new.where("status_after_strike = 'SUSPENDED'").select("driver_id", "vin", F.to_date("incident_ts").alias("suspended_date"))
        gold_jobs.end_suspended(spark, history, ended, assignments, f"incidents-{epoch}")
    finally:
        new.unpersist()


def incident_changes(spark: SparkSession, gold: str, schema: str, files: int = 20) -> DataFrame:
    """The incidents' change files as a stream, from the first on."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{gold}/changes")


def safety_status_stream(changes: DataFrame, url: str, table: str, properties: dict[str, str], checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Change rows of a stream to a database table, batch by batch; a batch that fails is undone and comes again."""
    return each_batch(changes, lambda batch, epoch: safety_status_batch(batch, epoch, url, table, properties), checkpoint, every)


def safety_status_batch(batch: DataFrame, epoch: int, url: str, table: str, properties: dict[str, str], stream: str = "safety_status") -> None:
    """Change rows of a batch, the newest of each driver, vehicle and month, upserted by JDBC exactly once: see jdbc.staged_upsert."""
    from drayage.operators.dedup import keep_first

    # fixed values: the columns of the database table
    rows = batch.where(F.col("_change_type").isin("insert", "update_postimage")).select(
        "driver_id", "vin", "base_rate", F.col("strike_number").alias("strike_count"), F.col("strike_type").alias("current_strike_type"),
        F.col("adjusted_rate").alias("current_adjusted_rate"), F.col("status_after_strike").alias("status"), F.to_date("incident_ts").alias("incident_day"),
        F.col("month_year").alias("month"), "_commit_version",
    )
    newest = keep_first(rows, ["driver_id", "vin", "month"], [F.desc("_commit_version"), F.desc("strike_count")]).drop("_commit_version")
    jdbc.staged_upsert(newest, url, table, ["driver_id", "vin", "month"], properties, epoch=(stream, epoch))


def write_standing(spark: SparkSession, gold: str, month: str, version: int, report: str | None = None, as_of: str | None = None) -> DataFrame:
    """The month's standings merged where strikes or status changed, with updated_ts, and the text report."""
    incidents = require_nonempty(read_epochs(spark, f"{gold}/incidents", "month_year", [month]), f"incidents of {month}")
    new = require_nonempty(strikes.standings(incidents), f"incidents of {month}")
    new = new.withColumn("updated_ts", F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp())
    when = (F.col("t.current_strikes") != F.col("s.current_strikes")) | (F.col("t.status") != F.col("s.status"))
    # fixed values: the columns that an update sets; created_ts stays
    update = ["current_strikes", "total_deductions", "final_payable_rate", "status", "suspension_date", "updated_ts"]
    merge_table(new, f"{gold}/standing", str(version), ["driver_id", "month_year"], F.col("month_year"), update, when)
    if report:
        strikes.report_lines(new).orderBy("driver_id").select("value").coalesce(1).write.mode("overwrite").text(report)
    return new

"""Landing files to bronze: checksums, header validation, manifest, one scan, fingerprints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drayage.functions.values import ROW_HASH_KEYS, row_hash
from drayage.sources.tables import _delete, _names, put_text, read_epochs, table_exists, write_epoch

#: The columns that each feed must have, in the order in which a reason names those that are missing.
REQUIRED = {
    "registry": ["vin", "model", "mfg_year", "fuel_type"],
    "assignment": ["vin", "driver_id", "start_timestamp", "end_timestamp", "daily_rate", "region"],
    "fuel": ["transaction_id", "vin", "fuel_liters", "odometer_reading", "timestamp"],
    "maintenance": ["vin", "service_date", "service_type"],
}
MANIFEST = "file_name string, file_path string, file_checksum string, file_status string, processed_at timestamp"


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """(path, start, line_no, value): the lines of all CSV files of a folder, whatever their size; line numbers grow within a split."""
    lines = spark.read.option("pathGlobFilter", "*.csv").text(folder)
    return lines.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line_no"), F.regexp_replace("value", r"\r$", "").alias("value"))


def landing_files(spark: SparkSession, folder: str, required: list[str]) -> DataFrame:
    """(path, name, checksum, first, header, reason) of every CSV file; reason is null for a valid header.

    Files are read as lines, by split, and summed up: no file is held whole. The checksum covers number, length and hashes
    of the lines, so files of the same lines count as the same content.
    """
    hashed = F.xxhash64("value")
    f = _lines(spark, folder).groupBy("path").agg(
        F.min_by("value", F.when(F.col("start") == 0, F.col("line_no"))).alias("first"),
        F.sha2(F.concat_ws("-", F.count(F.lit(1)), F.sum(F.length("value")), F.sum(hashed.cast("decimal(20,0)")), F.bit_xor(hashed), F.bit_xor(F.xxhash64(F.lit(1), "value"))), 256).alias("checksum"),
    )
    f = f.withColumn("first", F.try_validate_utf8("first")).withColumn("name", F.element_at(F.split("path", "/"), -1))
    names = F.transform(F.split("first", ","), lambda c: F.lower(F.trim(F.regexp_replace(c, '^[ "]+|[ "]+$', ""))))
    f = f.withColumn("header", names).withColumn("missing", F.array_except(F.array(*map(F.lit, required)), "header"))
    reason = F.when(F.trim("first") == "", "EMPTY_FILE").when(F.col("first").isNull(), F.concat(F.lit("UNREADABLE_FILE:"), "name"))
    reason = reason.when(F.size("missing") > 0, F.concat(F.lit("MISSING_REQUIRED_COLUMNS:"), F.array_join("missing", ",")))
    f = f.select("path", "name", "checksum", "first", "header", reason.alias("reason"))
    # Spark's file sources leave out files without a byte; the folder's listing has them
    fs = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    empty = [s.getPath() for s in fs.listStatus(spark._jvm.org.apache.hadoop.fs.Path(folder)) if s.isFile() and s.getLen() == 0 and s.getPath().getName().endswith(".csv")]
    if not empty:
        return f
    rows = spark.createDataFrame([(str(x.toString()), x.getName()) for x in empty], "path string, name string")
    none = rows.select("path", "name", F.sha2(F.lit(b""), 256).alias("checksum"), F.lit("").alias("first"), F.array().cast("array<string>").alias("header"), F.lit("EMPTY_FILE").alias("reason"))
    return f.unionByName(none)


def unseen(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files whose content no manifest row has; of several with the same content the first by name."""
    new = files.join(manifest.select(F.col("file_checksum").alias("checksum")), "checksum", "left_anti")
    first = new.groupBy("checksum").agg(F.min("path").alias("path"))
    return new.join(first, ["checksum", "path"], "left_semi")


def manifest_rows(files: DataFrame, as_of: Column) -> DataFrame:
    status = F.when(F.col("reason").isNull(), "PROCESSED").otherwise(F.concat(F.lit("REJECTED:"), "reason"))
    return files.select(
        F.col("name").alias("file_name"), F.col("path").alias("file_path"), F.col("checksum").alias("file_checksum"), status.alias("file_status"), as_of.cast("timestamp").alias("processed_at")
    )


def read_csv(spark: SparkSession, folder: str, files: DataFrame, as_of: Column) -> DataFrame | None:
    """All valid files as one frame of strings with normalised names, tagged with file and ingestion time.

    One scan for all files and header layouts: each line meets its file's header by path. Only the distinct column names come
    to the driver. A quoted field may hold commas, but no line end.
    """
    valid = files.where("reason IS NULL")
    names = [r["c"] for r in valid.select(F.explode("header").alias("c")).distinct().orderBy("c").collect()]
    if not names:
        return None
    widest = valid.agg(F.max(F.size("header"))).first()[0]
    lines = _lines(spark, folder).join(valid.select("path", "name", "first", "header"), "path").where("value != first AND trim(value) != ''")
    cells = F.from_csv("value", ", ".join(f"c{k} string" for k in range(widest)))
    lines = lines.withColumn("cells", cells).withColumn("cells", F.array(*[F.col(f"cells.c{k}") for k in range(widest)]))
    at = lambda c: F.get("cells", F.nullif(F.array_position("header", c), F.lit(0)).cast("int") - 1)
    out = lines.select(*[at(c).alias(c) for c in names], F.col("name").alias("source_file"))
    return out.withColumn("ingestion_time", as_of.cast("timestamp")).withColumn("ingestion_date", as_of.cast("date"))


def fresh_rows(rows: DataFrame, feed: str, today: DataFrame | None) -> DataFrame:
    """Rows with a fingerprint that neither this batch (first by file, then by the other columns) nor today's partition has."""
    rows = rows.withColumn("_row_hash", row_hash(ROW_HASH_KEYS[feed]))
    whole = F.struct("source_file", *[c for c in rows.columns if c not in ("source_file", "_row_hash")])
    rows = rows.groupBy("_row_hash").agg(F.min(whole).alias("r")).select("r.*", "_row_hash").select(*rows.columns)
    return rows if today is None else rows.join(today.select("_row_hash"), "_row_hash", "left_anti")


def ingest(spark: SparkSession, feed: str, folder: str, bronze: str, manifest: str, as_of: str) -> DataFrame:
    """One bronze run: scan new files, add new rows by ingestion date and epoch, append the manifest. Returns the manifest rows.

    What a run is about to do stands in the manifest's folder until it is done. A run that finds such a note first does that
    run again, with its time and epoch, which replaces the rows that may be there: neither rows nor files count twice.
    """
    note = f"{manifest}/_running/note.txt"
    if left := _text(spark, note):
        at, epoch = left.split("|")
        _run(spark, feed, folder, bronze, manifest, at, int(epoch), note)
    epoch = 1 + max([-1, *(int(n.removeprefix("epoch=")) for n in _names(spark, f"{bronze}/ingestion_date={as_of[:10]}") if n.startswith("epoch="))])
    return _run(spark, feed, folder, bronze, manifest, as_of, epoch, note)


def _run(spark: SparkSession, feed: str, folder: str, bronze: str, manifest: str, as_of: str, epoch: int, note: str) -> DataFrame:
    at, day = F.lit(as_of), as_of[:10]
    old = spark.read.schema(MANIFEST).parquet(manifest) if table_exists(spark, manifest) else spark.createDataFrame([], MANIFEST)
    files = unseen(landing_files(spark, folder, REQUIRED[feed]), old).persist()
    try:
        found = manifest_rows(files, at)
        put_text(spark, note, f"{as_of}|{epoch}")
        rows = read_csv(spark, folder, files, at)
        if rows is not None:
            write_epoch(fresh_rows(rows, feed, read_epochs(spark, bronze, "ingestion_date", [day], below=epoch)), bronze, epoch, "ingestion_date")
        told = found.collect()  # one row a file
        spark.createDataFrame(told, MANIFEST).coalesce(1).write.mode("append").parquet(manifest)
        _delete(spark, note)
        return spark.createDataFrame(told, MANIFEST)
    finally:
        files.unpersist()


def _text(spark: SparkSession, path: str) -> str | None:
    """What a small file holds; None where it is not there."""
    folder, _, name = path.rpartition("/")
    return spark.read.text(path, wholetext=True).first()[0] if name in _names(spark, folder) else None

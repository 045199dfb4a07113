"""Tables of three kinds. Snapshots are written in full: readers take the newest complete one. Merged tables are cut into parts
by a function of their keys: a version has the parts that a merge touched and what it changed, both or neither, and readers take
the newest version of each part. Event tables only grow: rows lie in folders by day (or month) and epoch, a replayed epoch
replaces its own folders, and readers take all of them."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def table_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p)) and any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete snapshots, oldest first."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("v=")]
    done = [x for x in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(x, "_SUCCESS"))]
    return sorted(int(x.getName()[2:]) for x in done)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where it is not there."""
    fs, p = _fs(spark, path)
    return [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []


def _state(spark: SparkSession, path: str, version: int) -> tuple[dict[str, str], bool]:
    """(folders of the parts that a version wrote, whether older versions count no more). A plain snapshot is one part, ''."""
    inside = _names(spark, f"{path}/v={version}")
    for rows in ("rows=whole", "rows=table"):
        if rows in inside:
            at = f"{path}/v={version}/{rows}"
            return {n.removeprefix("part="): f"{at}/{n}" for n in _names(spark, at) if n.startswith("part=")}, rows == "rows=whole"
    merged = any(n.startswith("rows=") for n in inside)
    return ({}, False) if merged else ({"": f"{path}/v={version}"}, True)


def current_parts(spark: SparkSession, path: str, below: int | None = None) -> dict[str, str]:
    """The folder of each part: the newest version (before `below`) that wrote it."""
    out: dict[str, str] = {}
    for v in reversed([v for v in versions(spark, path) if below is None or v < below]):
        own, last = _state(spark, path, v)
        out = own | out
        if last:
            break
    return out


def read_table(spark: SparkSession, path: str, below: int | None = None, parts: list[str] | None = None) -> DataFrame | None:
    """The newest state, or that before version `below`, of all parts or some; None where there is none.

    Columns that came later are null in parts that were written before.
    """
    folders = current_parts(spark, path, below)
    if parts is not None:
        folders = {k: f for k, f in folders.items() if k in parts or k == ""}
    if not folders:
        return None
    return spark.read.option("mergeSchema", len(folders) > 1).parquet(*folders.values()).drop("_change_type")


def empty(spark: SparkSession, schema: str) -> DataFrame:
    """A typed frame without rows, for a table that is not there yet."""
    return spark.createDataFrame([], schema)


def write_snapshot(df: DataFrame, path: str, version: int, partition: list[str] | None = None, hashed: list[str] | None = None, keep: int | None = None) -> None:
    """Write version `version` in full; writing it again replaces it, so a replayed batch changes nothing.

    hashed: deal rows by these keys first, so that a key's rows are in one file. keep: delete all but the newest versions.
    """
    w = (df.repartition(*hashed) if hashed else df).write.mode("overwrite")
    # without a row a partitioned write leaves no file, hence no schema
    (w.partitionBy(*partition) if partition and not df.isEmpty() else w).parquet(f"{path}/v={version}")
    if keep:
        expire(df.sparkSession, path, keep)


def expire(spark: SparkSession, path: str, keep: int) -> None:
    """Delete what no reader of the newest `keep` versions needs: older snapshots, changes, and parts that were written anew."""
    have = versions(spark, path)
    needed = set(current_parts(spark, path, have[-keep] + 1).values()) if len(have) > keep else set()
    for v in have[:-keep]:
        folder = f"{path}/v={v}"
        own = _state(spark, path, v)[0].values()
        gone = [f for f in [*own, f"{folder}/rows=changes"] if f not in needed] if needed.intersection(own) else [folder]
        for f in gone:
            _delete(spark, f)


def _version_of(spark: SparkSession, path: str, run: str) -> tuple[int, bool]:
    """(the version of a run, whether it is to be written). The newest run may come again; an older one, on which others were
    built, stays as it is; a new one comes next. Only this function gives out numbers."""
    held = {n.partition("-")[2]: int(n.partition("-")[0]) for n in _names(spark, f"{path}/_runs")}
    newest = (versions(spark, path) or [0])[-1]
    known = held.get(run)
    return (newest + 1, True) if known is None or known > newest else (known, known == newest)


def merge_table(
    source: DataFrame, path: str, run: str, keys: list[str], by: Column | None = None, update: list[str] | None = None, when: Column | None = None,
    put: dict[str, Column] | None = None, whole: bool = False, sort: list[str] | None = None, keep: int | None = 10,
) -> int:
    """Merge rows with unique keys into a table; returns the version.

    by: the part of a row, a function of its keys. Only parts that the source has rows of are read and written; the others
    keep their files. One join of these parts with the source gives their new state and what changed, written by one job, so
    a version is there with its changes or not at all. update, when, put: see merge.with_changes. whole: the source is the
    table, and rows that it lacks are deletes. sort: order within files. A run that is repeated replaces its version.
    """
    from drayage.operators import merge

    spark = source.sparkSession
    version, due = _version_of(spark, path, run)
    if not due:
        return version
    incoming = f"{path}/_incoming/{uuid.uuid4().hex}"
    source.withColumn("part", F.lit("all") if by is None else by.cast("string")).write.parquet(incoming)
    new = spark.read.parquet(incoming)
    touched = [r["part"] for r in new.select("part").distinct().collect()]
    if whole and not touched:
        raise ValueError(f"{path}: a table cannot be replaced by nothing")
    if not touched:
        _delete(spark, incoming)
        return version - 1
    plain = "" in current_parts(spark, path, version)
    old = read_table(spark, path, version, None if whole or plain else touched)
    if old is not None:
        old = old.withColumn("part", F.lit("all") if by is None else by.cast("string"))
    rows = merge.with_changes(old, new, keys, update, when, put, whole)
    state = "whole" if whole or plain or old is None else "table"
    rows = rows.withColumn("rows", F.when(F.col("_change_type").isNull(), state).otherwise("changes"))
    # big parts in several files, small ones in one
    rows = rows.hint("rebalance", "rows", "part").sortWithinPartitions("rows", "part", *(sort or keys))
    rows.write.mode("overwrite").partitionBy("rows", "part").parquet(f"{path}/v={version}")
    put_text(spark, f"{path}/_runs/{version}-{run}", "")
    _delete(spark, incoming)
    if keep:
        expire(spark, path, keep)
    return version


def optimize(spark: SparkSession, path: str, by: list[str], files: int | None = None) -> int:
    """Rewrite the parts of a merged table in Z-order of some columns, as a version without changes; returns it."""
    folders = current_parts(spark, path)
    version = (versions(spark, path) or [0])[-1] + 1
    rows = None
    for part, folder in folders.items():
        own = zordered(spark.read.parquet(folder).drop("_change_type"), by, files).withColumn("part", F.lit(part or "all"))
        rows = own if rows is None else rows.unionByName(own, allowMissingColumns=True)
    rows.withColumn("rows", F.lit("whole")).write.mode("overwrite").partitionBy("rows", "part").parquet(f"{path}/v={version}")
    return version


def read_changes(spark: SparkSession, path: str, start: int = 0) -> DataFrame | None:
    """Change rows of version `start` and later, with _change_type and _commit_version; folders of earlier ones are not read."""
    found = {v: f"{path}/v={v}/rows=changes" for v in versions(spark, path) if v >= start and "rows=changes" in _names(spark, f"{path}/v={v}")}
    out = None
    for v, folder in found.items():
        own = spark.read.option("mergeSchema", True).parquet(folder).drop("part").withColumn("_commit_version", F.lit(v).cast("long"))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out


def write_epoch(df: DataFrame, path: str, epoch: int, by: str) -> None:
    """Add an epoch's rows to an event table, in folders by `by` and epoch. Only folders of this epoch are replaced."""
    w = df.withColumn("epoch", F.lit(epoch).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    w.partitionBy(by, "epoch").parquet(path)


def _replaced(spark: SparkSession, day: str) -> dict[str, list[str]]:
    """Rewritten folders of a day whose originals may still be there, and the names of these."""
    out = {}
    for name in _names(spark, day):
        if name.startswith("epoch=-") and "_replaces" in _names(spark, f"{day}/{name}"):
            out[name] = [r["value"] for r in spark.read.text(f"{day}/{name}/_replaces/names.txt").collect()]
    return out


def _epochs(spark: SparkSession, day: str) -> list[str]:
    """Names of a day's epoch folders, without those that a rewrite has replaced."""
    names = [n for n in _names(spark, day) if n.startswith("epoch=")]
    gone = {n for own in _replaced(spark, day).values() for n in own} if any(n.startswith("epoch=-") for n in names) else set()
    return sorted(n for n in names if n not in gone)


def read_epochs(spark: SparkSession, path: str, by: str, values: list[str] | None = None, below: int | None = None) -> DataFrame | None:
    """An event table, or its folders of the given values of `by`, of epochs before `below`. None where there is none.

    Only the folders of the given values are listed and read, so neither listing nor plan grows with other days.
    """
    days = [n for n in _names(spark, path) if n.startswith(f"{by}=")] if values is None else [f"{by}={v}" for v in values]
    folders = [f"{path}/{d}/{n}" for d in days for n in _epochs(spark, f"{path}/{d}") if below is None or int(n.removeprefix("epoch=")) < below]
    if not folders:
        return None
    df = spark.read.option("basePath", path).option("mergeSchema", True).parquet(*folders)
    return df.withColumn(by, F.col(by).cast("string"))


def compact(spark: SparkSession, path: str, by: str, value: str, cluster: list[str], below: int | None = None) -> None:
    """Rewrite a day's (or month's) epochs (before `below`) as one folder in Z-order, under a negative epoch, which comes before all.

    For event tables, bronze tables (by ingestion_date) and archives (by error_reason or trip_type).

    The folders to replace are listed first, and their names stand in the new folder when one rename makes it visible: from
    then on readers pass over them. An epoch that lands meanwhile is not among them and stays. A run that was cut off leaves
    a hidden folder, or replaced folders, which the next run removes. A replayed epoch finds its rows there and adds none.
    Streams over the table skip negative epochs, so `below` should be no more than what they have read.
    """
    day = f"{path}/{by}={value}"
    _clear_replaced(spark, day)
    old = [n for n in _epochs(spark, day) if below is None or int(n.removeprefix("epoch=")) < below]
    if len(old) < 2:
        return
    hidden = f"{day}/.compact-{uuid.uuid4().hex}"
    rows = spark.read.option("mergeSchema", True).parquet(*[f"{day}/{n}" for n in old])
    zordered(rows, cluster).write.parquet(hidden)
    put_text(spark, f"{hidden}/_replaces/names.txt", "\n".join(old))
    least = min(0, *(int(n.removeprefix("epoch=")) for n in _names(spark, day) if n.startswith("epoch=")))
    fs, _ = _fs(spark, day)
    fs.rename(spark._jvm.org.apache.hadoop.fs.Path(hidden), spark._jvm.org.apache.hadoop.fs.Path(f"{day}/epoch={least - 1}"))
    _clear_replaced(spark, day)


def _clear_replaced(spark: SparkSession, day: str) -> None:
    """Delete folders that a rewrite has replaced, and what a run that was cut off left."""
    for name, old in _replaced(spark, day).items():
        for n in [*old, f"{name}/_replaces"]:
            _delete(spark, f"{day}/{n}")
    for name in _names(spark, day):
        if name.startswith(".compact-"):
            _delete(spark, f"{day}/{name}")


def require_nonempty(df: DataFrame | None, name: str) -> DataFrame:
    if df is None or df.isEmpty():
        raise RuntimeError(f"{name} is missing or empty")
    return df


def clustered(df: DataFrame, by: list[str], files: int | None = None) -> DataFrame:
    """Rows in range order of `by`, so that file and row-group minima and maxima let readers skip."""
    ranged = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by)


def z_code(columns: list[str], bits: int) -> Column:
    """Numbers of `bits` bits each, bit by bit in turn, the first column's bits in front: one number that is near where all are."""
    out, n = F.lit(0).cast("long"), len(columns)
    for bit in range(bits):
        for k, c in enumerate(columns):
            one = F.shiftright(F.col(c).cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(one, bit * n + (n - 1 - k)))
    return out


def range_ranks(df: DataFrame, columns: list[str], bits: int = 6) -> DataFrame:
    """Adds `__rank_<column>`: the number of the range that a value lies in, of up to 2 ** bits ranges of about as many rows each.

    The bounds of numbers and times are approximate quantiles, of all columns in one pass; those of texts are where a range
    partitioning cuts them. Only bounds come to the driver. Nulls are in the first range.
    """
    kinds, ranges = dict(df.dtypes), 2**bits
    value = {c: F.col(c) if kinds[c] == "string" else F.col(c).cast("timestamp").cast("double") if kinds[c] == "date" else F.col(c).cast("double") for c in columns}
    shares = F.array(*[F.lit(k / ranges) for k in range(1, ranges)])
    quantiles = [F.percentile_approx(value[c], shares, F.lit(10_000)).alias(c) for c in columns if kinds[c] != "string"]
    found = df.agg(*quantiles).first() if quantiles else {}
    for c in columns:
        if kinds[c] == "string":
            cut = df.select(c).dropna().repartitionByRange(ranges, c).groupBy(F.spark_partition_id()).agg(F.min(c).alias("least"))
            bounds = sorted(r["least"] for r in cut.collect())
        else:
            bounds = sorted(set(found[c] or []))
        rank = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= value[c])) if bounds else F.lit(0)
        df = df.withColumn(f"__rank_{c}", F.coalesce(rank, F.lit(0)))
    return df


def zordered(df: DataFrame, columns: list[str], files: int | None = None, bits: int = 6) -> DataFrame:
    """Rows dealt to files and sorted by the Z-order of some columns, so that a filter on any of them reads few files."""
    ranks = [f"__rank_{c}" for c in columns]
    coded = range_ranks(df, columns, bits).withColumn("__z", z_code(ranks, bits)).drop(*ranks)
    ranged = coded.repartitionByRange(files, "__z") if files else coded.repartitionByRange("__z")
    return ranged.sortWithinPartitions("__z", *columns).drop("__z")


def key_bucket(column: str, buckets: int = 16) -> Column:
    """A part for tables whose keys have no time in them: a hash of the key."""
    return F.lpad(F.pmod(F.xxhash64(column), F.lit(buckets)).cast("string"), 3, "0")


def archive(df: DataFrame, path: str, run: str, by: str | None = None) -> None:
    """Rejected rows of one run in folders of its own, by `by` where given: running it again replaces them.

    Runs are numbers; an archive by a column is an event table, which compact() rewrites.
    """
    if by is None:
        df.write.mode("overwrite").parquet(f"{path}/run={run}")
    else:
        write_epoch(df, path, int(run), by)


def save_position(spark: SparkSession, path: str, positions: dict[str, int]) -> None:
    old = read_table(spark, path)
    rows = spark.createDataFrame(sorted(positions.items()), "name string, version long")
    if old is not None:
        rows = rows.unionByName(old.join(rows, "name", "left_anti"))
    write_snapshot(rows.coalesce(1), path, (versions(spark, path) or [0])[-1] + 1)


def load_position(spark: SparkSession, path: str, name: str) -> int:
    table = read_table(spark, path)
    row = table.where(F.col("name") == name).first() if table is not None else None
    return row["version"] if row else 0

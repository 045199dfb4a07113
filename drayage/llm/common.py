"""What the operators of this package share: input tables, durable intermediate tables, Arrow passes, and components of a link graph."""

from __future__ import annotations

import ctypes
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARROW = "spark.sql.execution.arrow"
#: Shuffle files of a write are of no use once the written table is there; Spark then removes them at the end of the job.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_shipped: set[str] = set()
_owner, _caches = "", []


def worker_cache(f: Callable) -> Callable:
    """lru_cache for what an operator keeps in a worker between tasks, until another operator's tasks come there."""
    cached = lru_cache(maxsize=2)(f)
    _caches.append(cached.cache_clear)
    return cached


def claim(owner: str) -> None:
    """Workers outlive a stage: an operator that begins in one lets go of what others have kept."""
    global _owner
    if owner != _owner:
        for clear in _caches:
            clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        pa.set_memory_pool(pa.system_memory_pool())  # Arrow's own pool keeps what batches have used
        libc = ctypes.CDLL(None)
        if trim := getattr(libc, "malloc_trim", None):  # glibc holds on to what was freed
            # a set threshold (option -3) no longer rises with what is freed: arrays of 1 MB and more go back at once
            libc.mallopt(-3, 1 << 20)
            trim(0)
        _owner = owner


def ship(spark: SparkSession) -> None:
    """Send this library to the executors, once for each application: Arrow functions import it there.

    Every operator with an Arrow stage calls it. Arrow batches are made smaller than Spark's default, since one row is a
    whole document; a session that sets these two sizes itself keeps its own.
    """
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        _shipped.add(app)
        for key, usual, most in ((f"{ARROW}.maxRecordsPerBatch", "10000", "1000"), (f"{ARROW}.maxBytesPerBatch", None, "8m")):
            if spark.conf.get(key, usual) == usual or (usual is None and key not in dict(spark.sparkContext.getConf().getAll())):
                spark.conf.set(key, most)
        root = Path(__file__).resolve().parents[2]
        folder = Path(tempfile.mkdtemp(prefix="spark-"))
        shutil.copytree(root / "drayage", folder / "lib" / "drayage", ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(str(folder / "drayage"), "zip", folder / "lib"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir. Only a local session that has none (tests) gets one made up."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith(("local[", "local-")) and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Scratch:
    """Intermediate tables of one run, as Parquet in the shared folder: lineage ends there, and a lost executor costs nothing.

    drop() deletes a table as soon as nothing reads it any more, so the folder holds what is in use and not what has been.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"
        self.held: list[tuple[DataFrame, str]] = []

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        """Write df and read it back."""
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.held.append((out, path))
        return out

    def drop(self, *tables: DataFrame | None) -> None:
        """Delete tables that cut() returned."""
        for df in tables:
            for own, path in self.held:
                if own is df:
                    p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                    p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        self.held = [x for x in self.held if not any(x[0] is df for df in tables)]

    def keep_only(self, *tables: DataFrame) -> None:
        self.drop(*[x for x, _ in self.held if not any(x is t for t in tables)])


def cut(df: DataFrame, name: str) -> DataFrame:
    """One table of a run of its own, written and read back; it stays until spark.checkpoint.dir is cleared."""
    return Scratch(df.sparkSession).cut(df, name)


def slices(sizes: Iterable[int], most: int, rows: int) -> Iterator[tuple[int, int]]:
    """(from, to) of stretches of rows of about `most` in size and at most `rows` rows: memory follows the longest row."""
    begin, held, at = 0, 0, -1
    for at, size in enumerate(sizes):
        held += size
        if held >= most or at + 1 - begin >= rows:
            yield begin, at + 1
            begin, held = at + 1, 0
    if at >= begin:
        yield begin, at + 1


def text_slices(batches: Iterable[pa.RecordBatch], text_col: str, chars: int, rows: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Arrow batches cut into slices of about `chars` characters, with their texts; a null text counts as empty."""
    for batch in batches:
        sizes = pc.fill_null(pc.utf8_length(batch.column(text_col)), 0).to_pylist()
        for a, b in slices(sizes, chars, rows):
            part = batch.slice(a, b - a)
            yield part, [t or "" for t in part.column(text_col).to_pylist()]


def add_from_texts(df: DataFrame, text_col: str, fn: Callable[[list[str]], list], new: str, keep: list[str], chars: int = 1_000_000, rows: int = 100_000) -> DataFrame:
    """The columns `keep` and the columns `new` (a schema), which fn makes from lists of whole texts.

    The kept columns go through Arrow as they are and never through a float: ids beside a null id stay exact.
    """
    ship(df.sparkSession)
    fields = T.StructType.fromDDL(new).fields
    schema = T.StructType([*(df.schema[c] for c in keep), *fields])
    names, owner = [f.name for f in fields], fn.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim(owner)
        for part, texts in text_slices(batches, text_col, chars, rows):
            made = [x if isinstance(x, pa.Array) else pa.array(x) for x in fn(texts)]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *made], names=[*keep, *names])

    return df.select(*dict.fromkeys([*(f"`{c}`" for c in keep), f"`{text_col}`"])).mapInArrow(run, schema)


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """Connected components of edges(a, b) -> (node, component): the smallest node that links reach. Nodes are longs or binary.

    Each round every node hooks to its neighbour of least hash, unless its own is less, hooks are followed to their ends, and
    edges are contracted to pairs of ends. The hash is another one each round, so a node stays an end with probability one
    half at most, whatever the graph and the ids: rounds grow with the logarithm of the nodes, and go on until no edge is
    left. Joins read written tables on either side, which lets adaptive execution split the rows of a hub. Nodes without an
    edge are absent.
    """
    s = scratch or Scratch(edges.sparkSession)
    pair = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = s.cut(edges.where("a != b").select(*pair).distinct(), "edges")
    hooked: list[DataFrame] = []
    while not hooked or not edges.isEmpty():
        hooked.append(_ends(edges, len(hooked), s))
        end = hooked[-1]
        moved = edges.join(end, edges.a == end.node).select(F.col("component").alias("a"), "b")
        moved = moved.join(end, moved.b == end.node).select("a", F.col("component").alias("b")).where("a != b")
        done, edges = edges, s.cut(moved.select(*pair).distinct(), "edges")
        s.drop(done)
    s.drop(edges)
    # the last rounds have the fewest nodes: follow ends from there
    labels = hooked.pop()
    while hooked:
        at = labels.select(F.col("node").alias("at"), F.col("component").alias("further"))
        own = hooked.pop()
        new = s.cut(own.join(at, own.component == at["at"], "left").select("node", F.coalesce("further", "component").alias("component")), "labels")
        s.drop(own, labels)
        labels = new
    least = s.cut(labels.groupBy(F.col("component").alias("end")).agg(F.min("node").alias("least")), "labels-least")
    out = s.cut(labels.join(least, labels.component == least.end).select("node", F.col("least").alias("component")), "labels")
    s.drop(labels, least)
    return out


def _ends(edges: DataFrame, seed: int, s: Scratch) -> DataFrame:
    """(node, component): the node at the end of each node's hooks."""

    def order(node: str) -> Column:
        return F.struct(F.xxhash64(F.lit(seed), node).alias("h"), F.col(node).alias("node"))

    both = edges.select("a", "b").union(edges.select("b", "a"))
    near = both.groupBy(F.col("a").alias("node")).agg(F.min(order("b"))["node"].alias("near"))
    ends = s.cut(near.select("node", F.when(order("near") < order("node"), F.col("near")).otherwise(F.col("node")).alias("component")), "hooks")
    while True:
        at = ends.select(F.col("node").alias("at"), F.col("component").alias("further"))
        new = s.cut(ends.join(at, ends.component == at["at"]).select("node", F.col("component").alias("old"), F.col("further").alias("component")), "hooks")
        s.drop(ends)
        if new.where("component != old").isEmpty():
            return new
        ends = new

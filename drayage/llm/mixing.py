"""Mix sources to target weights: a van der Corput schedule of slots over cumulative quotas, joined to equal-token blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from drayage.llm.common import Scratch

WORDS = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of runs of characters other than space, tab and line ends; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, cap: float = 3.0) -> DataFrame:
    """(source, source_size) -> (source, rank, source_size, weight, target).

    Sources by code point, null last, weigh 1, 2, 3, 1, ...; targets share the sum of all sizes by weight, none above
    cap times its source's size, what is cut off going to the others by weight. Solved in closed form: ordered by
    cap / weight, the capped sources come first. One row for each source, so one task holds sources, not documents.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    s = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    s = s.withColumn("weight", (F.col("rank") % 3 + 1).cast("double")).withColumn("most", F.lit(cap) * F.col("source_size"))
    order = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    weights = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    s = s.withColumn("level", left / weights).withColumn("full", F.col("most") / F.col("weight") <= F.col("level"))
    # after the first source that is not full, the level stays
    free = F.min(F.when(~F.col("full"), F.struct(F.col("most") / F.col("weight"), F.col("rank"), F.col("level")))).over(every)["level"]
    return s.withColumn("target", F.when(F.col("full"), F.col("most")).otherwise(F.col("weight") * free)).select(
        "source", "rank", "source_size", "weight", "target"
    )


def quotas(goals: DataFrame, block: int) -> DataFrame:
    """Slots of each source: enough blocks for its target; `first` to `first + slots` is its stretch of the cumulative line."""
    q = goals.withColumn("take", F.least(F.round("target"), 3 * F.col("source_size")).cast("long"))
    q = q.withColumn("slots", F.ceil(F.col("take") / block).cast("long"))
    upto = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    return q.withColumn("first", F.coalesce(F.sum("slots").over(upto), F.lit(0)))


def schedule(q: DataFrame, chunk: int = 65536) -> DataFrame:
    """(slot, rank, nth): which source each slot of the mix draws from and how many slots that source had before.

    Slot t maps to the van der Corput point of t (its bits reversed) on the cumulative line of quotas; points past the end
    are idle. Reversing bits is its own inverse, so each source lists the points of its stretch and reverses them: no slot
    is compared with a stretch. All points of a power of two are met once, so every source gets exactly its quota, spread
    evenly. The nth comes from counts by chunk of slots, so no source is ever listed or ordered in one task.
    """
    total = q.agg(F.sum("slots")).first()[0] or 0
    bits = max(1, (total - 1).bit_length()) if total else 1
    line = q.where("slots > 0").select("rank", F.col("first").alias("lo"), (F.col("first") + F.col("slots")).alias("end"))
    line = line.select("rank", "end", F.explode(F.sequence("lo", F.col("end") - 1, F.lit(chunk).cast("long"))).alias("lo")).repartition("rank", "lo")
    points = line.select("rank", F.explode(F.sequence("lo", F.least(F.col("lo") + chunk, "end") - 1)).alias("point"))
    placed = points.select("rank", F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("long").alias("slot")).withColumn("part", F.floor(F.col("slot") / chunk))
    before = Window.partitionBy("rank").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("rank", "part").agg(F.count(F.lit(1)).alias("n")).withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    within = Window.partitionBy("rank", "part").orderBy("slot")
    numbered = placed.withColumn("at", F.row_number().over(within) - 1)
    # Spark takes the exploded points for as small as the quotas they come from, and would broadcast them
    return numbered.hint("merge").join(starts.select("rank", "part", "start"), ["rank", "part"]).select("slot", "rank", (F.col("start") + F.col("at")).alias("nth"))


def order_key(id_col: Column, digest: Column) -> Column:
    """Where a document stands in its source's shuffled stream; only rows of one id and one text share a place."""
    return F.struct(F.xxhash64(F.lit("mix"), id_col, digest).alias("h"), id_col.alias("id"), digest.alias("digest"))


def streams(rows: DataFrame, parts: int = 256) -> DataFrame:
    """rows(rank, key, size, ...) with `begin`, the words before a document in its source's shuffled stream.

    The order is that of order_key(); sums by its leading bits precede, so a source with most rows is not sorted whole.
    """
    rows = rows.withColumn("__part", F.floor((F.col("key.h") / 2.0**63 + 1) * parts / 2).cast("int"))
    before = Window.partitionBy("rank").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("rank", "__part").agg(F.sum("size").alias("__n")).withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    within = Window.partitionBy("rank", "__part").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    return rows.join(starts.select("rank", "__part", "__start"), ["rank", "__part"]).withColumn("begin", F.col("__start") + F.col("__before")).drop("__part", "__start", "__before")


def mixed(docs: DataFrame, block: int = 256, cap: float = 3.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", scratch: Scratch | None = None):
    """The mix: (documents with row, key, size, source_size, target and begin; pieces of the mix).

    A source's documents form one shuffled stream that repeats; block n holds its words n * block to (n + 1) * block, the
    last one of a source ends at its target. pieces(slot, row, doc_id, words, skip): slot t holds `words` words of the
    document, from word `skip` on; read in slot order they are the mix. Sources repeat at most `cap` times, so no document is
    taken more than that. Null texts have size 0 and are never drawn; a null source is a source, named last; null ids,
    repeated rows and extra columns are fine; an empty table gives no rows. The same rows give the same mix.
    """
    s = scratch or Scratch(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("digest"))
    base = s.cut(base.select("doc_id", "source", "size", order_key(F.col("doc_id"), F.col("digest")).alias("key")), "mix-sizes")
    q = s.cut(quotas(targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), cap), block), "mix-quotas")
    # one row for each source: it is broadcast below spark.sql.autoBroadcastJoinThreshold and shuffled above it
    rows = base.join(q.select("source", "rank", "source_size", "target", "take"), base.source.eqNullSafe(q.source)).drop(q.source)
    rows = s.cut(streams(rows).withColumn("row", F.monotonically_increasing_id()), "mix-streams")
    s.drop(base)
    drawn = rows.where("size > 0").withColumn("lap", F.explode(F.sequence(F.lit(0), F.lit(int(cap)))))
    drawn = drawn.withColumn("lo", F.col("lap") * F.col("source_size") + F.col("begin")).withColumn("hi", F.least(F.col("lo") + F.col("size"), "take"))
    drawn = drawn.where("lo < hi").withColumn("nth", F.explode(F.sequence(F.floor(F.col("lo") / block), F.floor((F.col("hi") - 1) / block))))
    first, last = F.greatest("lo", F.col("nth") * block), F.least("hi", (F.col("nth") + 1) * block)
    parts = drawn.select("rank", "nth", "row", "doc_id", (last - first).alias("words"), (first - F.col("lo")).alias("skip"))
    pieces = schedule(q).hint("merge").join(parts, ["rank", "nth"]).select("slot", "row", "doc_id", "words", "skip")
    return rows, pieces


def _taken(docs: DataFrame, block: int, cap: float, scratch: Scratch, **cols) -> DataFrame:
    rows, pieces = mixed(docs, block, cap, scratch=scratch, **cols)
    taken = pieces.groupBy("row").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"), F.count(F.lit(1)).alias("n_pieces"))
    return rows.join(taken.hint("merge"), "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long")).withColumn("n_pieces", F.coalesce("n_pieces", F.lit(0)).cast("long"))


def mix_documents(docs: DataFrame, block: int = 256, cap: float = 3.0, **cols) -> DataFrame:
    """What the mix takes of each document: (doc_id, source, size, source_size, target, taken, first_slot, n_pieces).

    first_slot is the slot of the schedule that first holds words of the document (null where none does), n_pieces the number
    of blocks, repeats counted, that it is cut into. See mixed() for the edge cases.
    """
    s = Scratch(docs.sparkSession)
    out = _taken(docs, block, cap, s, **cols)
    out = s.cut(out.select("doc_id", "source", "size", "source_size", F.col("target").cast("double").alias("target"), "taken", "first_slot", "n_pieces"), "mix-taken")
    s.keep_only(out)
    return out


def mix_rows(docs: DataFrame, block: int = 256, cap: float = 3.0) -> DataFrame:
    """The documents as the mix takes them, columns unchanged: each as often as the mix begins it, so never, once or up to cap times.

    Along a source's stream all documents up to one are begun once more than those after it, so a source is told by that
    document and two numbers, and no text is shuffled. The last document of a source is taken whole: a source exceeds its
    target by less than one document, or one group of rows of one id and one text, which are taken alike. Documents
    without words are in no mix. Null ids and sources, ties, repeated rows, very long texts and extra columns are fine; an
    empty table gives no rows.
    """
    s = Scratch(docs.sparkSession)
    took = s.cut(_taken(docs, block, cap, s).where("size > 0").select("source", "key", F.ceil(F.col("taken") / F.col("size")).cast("int").alias("times")), "mix-times")
    ends = took.groupBy("source").agg(F.min("times").alias("__least"), F.max("times").alias("__most"), F.max(F.struct("times", "key"))["key"].alias("__upto"))
    ends = s.cut(ends.withColumnRenamed("source", "__source"), "mix-ends")
    s.keep_only(ends)
    key = order_key(F.col("doc_id"), F.xxhash64("text"))
    rows = docs.where(F.col("text").rlike(WORDS)).join(ends, F.col("source").eqNullSafe(F.col("__source")))
    times = F.when(key <= F.col("__upto"), F.col("__most")).otherwise(F.col("__least"))
    rows = rows.withColumn("__times", times).where("__times > 0").withColumn("__lap", F.explode(F.sequence(F.lit(1), "__times")))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])

"""Document fingerprints by consistent weighted sampling: every text's words, weighted by how often they come, give a signature
whose elements two texts share with a probability equal to their generalised Jaccard similarity.

For a word and a sample, gamma variates r and c (each -ln of a product of two uniforms) and a uniform b come from a hash of both.
A word of weight S is given t = floor(ln S / r + b) and the value c exp(-r (t - b)) exp(-r); the least value of all words is the
text's sample. A value depends on the word and on t alone, so two texts have the same least value when the same word at the same
t is least in both.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows between two boundaries, about, and the most boundaries that the driver holds, which are searched in two steps.
BLOCK, BOUNDS, STEP = 4096, 16_384, 128
#: Characters of scripts without spaces (CJK, kana, Hangul) are words of their own.
ALONE = "[⺀-鿿가-힯]"
SPACE = r"[\x20\x09-\x0D]+"
HEAD = r"(?s)^(?:.*[\x20\x09-\x0D])?"


def words(text: Column) -> Column:
    """All words of a text in lower case; where it begins or ends with a space, also an empty one."""
    text = F.lower(text)
    alone = (F.octet_length(text) > F.length(text)) & text.rlike(ALONE)
    return F.split(F.when(alone, F.regexp_replace(text, f"({ALONE})", " $1 ")).otherwise(text), SPACE)


def _uniform(bits: str, width: int) -> str:
    return f"(({bits} & {2**width - 1}L) + 0.5D) / {float(2**width)}D"


def sample(word: str, log_weight: str, n: int) -> str:
    """SQL text of the value that a word (64-bit hash) of a weight (its logarithm) has in sample n; null where the weight is null."""
    one, two = f"xxhash64({word}, {2 * n})", f"xxhash64({word}, {2 * n + 1})"
    shrink = f"({_uniform(one, 21)} * {_uniform(f'shiftrightunsigned({one}, 21)', 21)})"
    r, b = f"(-ln({shrink}))", f"((shiftrightunsigned({one}, 42) + 0.5D) / {float(2**22)}D)"
    c = f"(-ln({_uniform(two, 32)} * {_uniform(f'shiftrightunsigned({two}, 32)', 32)}))"
    return f"{c} * {shrink} * exp({r} * ({b} - floor({log_weight} / {r} + {b})))"


def _elements(side: str, samples: int) -> Column:
    """Samples as four hexadecimal digits each; 0000 is a text without words."""
    one = "lpad(lower(hex(if({0} is null, 0L, pmod(xxhash64({0}), 65535L) + 1L))), 4, '0')"
    return F.expr(f"concat({', '.join(one.format(f'{side}{k}') for k in range(samples))})")


def likeness(a: str, b: str, samples: int) -> Column:
    """The share of samples in which two fingerprints agree."""
    same = " + ".join(f"int(substring({a}, {4 * k + 1}, 4) = substring({b}, {4 * k + 1}, 4))" for k in range(samples))
    return F.expr(f"({same}) / {samples}D")


def _boundaries(rows: DataFrame, block: int) -> list[tuple]:
    """Keys that cut the rows, in order, into stretches of about `block`; the first is the least key of all. At most BOUNDS."""
    parts = min(BOUNDS, -(-rows.count() // block))
    if parts == 0:
        return [(False, 0, 0)]
    cut = rows.select("key").repartitionByRange(parts, "key").groupBy(F.spark_partition_id()).agg(F.min("key").alias("key"))
    return sorted({tuple(r["key"]) for r in cut.collect()})


def _place(key: Column, bounds: list[tuple]) -> tuple[Column, Column]:
    """(the number of the stretch that a key lies in, whether it is the key that begins it)."""

    names, groups = ("none", "id", "digest"), [bounds[k : k + STEP] for k in range(0, len(bounds), STEP)]
    kind = "struct<none:boolean,id:bigint,digest:bigint>"
    held = F.from_json(F.lit(json.dumps([[dict(zip(names, b)) for b in g] for g in groups])), f"array<array<{kind}>>")
    first = F.from_json(F.lit(json.dumps([dict(zip(names, g[0])) for g in groups])), f"array<{kind}>")
    group = F.size(F.filter(first, lambda b: b <= key)) - 1
    inner = F.get(held, group)
    within = F.size(F.filter(inner, lambda b: b <= key)) - 1
    return (group * STEP + within).cast("int"), F.get(inner, within) == key


def fingerprint_edits(docs: DataFrame, samples: int = 32, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """Fingerprints of every text and of its edited text: (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next).

    Documents follow one another by ascending id, ids that are null last, rows of one id by a hash of the text; the last is
    followed by the first. The edited text gives up its last half (rounded down) for as many first characters of the next
    document, or all it has. A null text is empty; texts without words have equal fingerprints, unlike all others; repeated
    rows each get a row; one row alone is followed by itself; an empty table gives no rows; extra columns are ignored. Words
    are hashed to 64 bits.

    Rows are dealt once, to stretches of the order, which an ordered sample of keys cuts about evenly; the row that begins a
    stretch also goes, as a guest, to the stretch before, so every row meets the next one there. All that follows keeps that
    partitioning. Only rows that agree in id and text cannot be parted.
    """
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).cast("long").alias("id"), F.xxhash64("text").alias("digest"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("key", key)
    bounds = _boundaries(rows, block)
    own, begins = _place(F.col("key"), bounds)
    before = F.when(F.col("own") == 0, F.lit(len(bounds) - 1)).otherwise(F.col("own") - 1)
    visit = lambda at, guest: F.struct(at.alias("block"), F.lit(guest).alias("guest"))
    visits = F.when(F.col("begins"), F.array(visit(F.col("own"), False), visit(before, True))).otherwise(F.array(visit(F.col("own"), False)))
    rows = rows.withColumns({"own": own, "begins": begins}).select("doc_id", "text", "key", F.inline(visits))

    order = Window.partitionBy("block").orderBy("guest", "key.none", "key.id", "key.digest")
    rows = rows.withColumns({"at": F.row_number().over(order), "next": F.coalesce(F.lead("text").over(order), F.lit(""))})
    rows = rows.select("doc_id", "text", "block", "guest", "at", "next", F.length("text").cast("long").alias("n_chars"))
    rows = rows.withColumn("half", F.floor(F.col("n_chars") / 2).cast("int")).withColumn("kept", F.expr("left(text, cast(n_chars as int) - half)"))
    rows = rows.withColumn("edited", F.concat("kept", F.expr("left(next, half)")))

    # both texts share what lies before the last space of what is kept: its words are counted once
    rows = rows.withColumns({"head": F.regexp_extract("kept", HEAD, 0), "sha": F.unhex(F.sha2(F.col("edited").cast("binary"), 256))})
    rest = lambda text: F.expr(f"substring({text}, length(head) + 1)")
    own = ["block", "at", "guest", "doc_id", "n_chars", "sha"]
    each = rows.select(*own, F.posexplode(F.array(F.col("head"), rest("text"), rest("edited"))).alias("part", "t"))
    each = each.select(*own, "part", F.explode(words(F.col("t"))).alias("word")).withColumn("word", F.when(F.col("word") != "", F.xxhash64("word")))
    counted = lambda other: F.log(F.count_if(F.col("word").isNotNull() & (F.col("part") != other)))
    weights = each.groupBy(*own, "word").agg(counted(2).alias("own"), counted(1).alias("edited"))
    least = [F.expr(f"min({sample('word', side, k)}) as {side}{k}") for side in ("own", "edited") for k in range(samples)]
    made = weights.groupBy(*own).agg(*least)
    made = made.select(*own, _elements("own", samples).alias("fingerprint"), _elements("edited", samples).alias("edited_fingerprint"))
    made = made.withColumn("next", F.lead("fingerprint").over(Window.partitionBy("block").orderBy("at"))).where("NOT guest")
    near = lambda other: likeness("fingerprint", other, samples)
    return made.select(
        "doc_id", "n_chars", F.lower(F.hex("sha")).alias("edited_sha256"), "fingerprint", "edited_fingerprint", near("edited_fingerprint").alias("near_edited"), near("next").alias("near_next")
    )

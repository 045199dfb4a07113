"""Hierarchical weighted hash tree: documents descend region, rack and shard by weighted hash draws."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A tree is a list of regions, a region a list of racks, a rack a list of (shard, weight).
Tree = list[list[list[tuple[int, float]]]]


def tree(shards: int, base: int = 40, regions: int = 4, racks: int = 2) -> Tree:
    """`base` shards dealt evenly over regions and racks; every shard beyond base is a region of its own.

    A region's draw depends on its own weight only, so a region that joins takes rows from all others and gives none:
    with one more shard, rows move into that shard alone.
    """
    first = min(shards, base)
    grid: Tree = [[[] for _ in range(racks)] for _ in range(regions)]
    for s in range(first):
        region = s * regions // first
        begin, end = -(-region * first // regions), -(-(region + 1) * first // regions)
        grid[region][(s - begin) * racks // (end - begin)].append((s, 1.0))
    grid = [[rack for rack in region if rack] for region in grid]
    return [region for region in grid if region] + [[[(s, 1.0)]] for s in range(first, shards)]


def _weight(node) -> float:
    return node[1] if isinstance(node, tuple) else sum(map(_weight, node))


def _pick(key: Column, children: Column) -> Column:
    """The number of the child with the least draw, -ln(u) / weight for u in (0, 1) from key and the child's name.

    children: an array of (name, n, weight). A child wins in proportion to its weight; ties go to the smaller number.
    """

    def draw(c: Column) -> Column:
        digits = F.substring(F.md5(F.concat(key, F.lit("/"), c["name"]).cast("binary")), 1, 13)
        return F.struct((-F.log((F.conv(digits, 16, 10).cast("double") + 0.5) / float(2**52)) / c["weight"]).alias("d"), c["n"].alias("n"))

    return F.array_min(F.transform(children, draw))["n"]


def _children(nodes: list[tuple[str, int, float]]) -> Column:
    return F.array(*[F.struct(F.lit(name).alias("name"), F.lit(n).alias("n"), F.lit(float(w)).alias("weight")) for name, n, w in nodes if w > 0])


def assign(df: DataFrame, key: Column, layout: Tree, out: str) -> DataFrame:
    """Add column `out`, the shard that key (string) reaches in `layout`; weight 0 takes nothing.

    Raising a shard's weight raises the weights of its rack and region only: rows move into that region, inside it into
    that rack, and nothing moves between other subtrees.
    """
    regions = _children([(f"r{n}", n, _weight(x)) for n, x in enumerate(layout)])
    racks = F.array(*[_children([(f"r{n}k{m}", m, _weight(y)) for m, y in enumerate(x)]) for n, x in enumerate(layout)])
    shards = F.array(*[F.array(*[_children([(f"s{s}", s, w) for s, w in y]) for y in x]) for x in layout])
    r, k, at = f"__{out}_region", f"__{out}_rack", f"__{out}_key"
    df = df.withColumn(at, key).withColumn(r, _pick(F.col(at), regions)).withColumn(k, _pick(F.col(at), F.get(racks, F.col(r))))
    return df.withColumn(out, _pick(F.col(at), F.get(F.get(shards, F.col(r)), F.col(k)))).drop(r, k, at)


def numbered(df: DataFrame, counts_of: DataFrame, group: str, part: str, order: list[str], out: str) -> DataFrame:
    """Add `out`: rows of each `group` numbered from 0 by (part, order), without bringing a group into one task.

    counts_of has the same (group, part) rows and may be a cheaper read of the same input. Only (group, part) is ever
    sorted together; what precedes a part comes from the counts, one row for each part.
    """
    before = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts_of.groupBy(group, part).agg(F.count(F.lit(1)).alias("__n"))
    starts = starts.select(group, part, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy(group, part).orderBy(*order)
    return df.withColumn("__at", F.row_number().over(within) - 1).join(starts, [group, part]).withColumn(out, F.col("__start") + F.col("__at")).drop("__at", "__start")


def shard_rows(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text", parts: int = 1024) -> DataFrame:
    """Shard, slot and grown shard of every row: (doc_id, size, text_crc32, law, shard, slot, grown_shard).

    Law `key`: id and shard count alone decide; with one more shard, rows move only into it (grown_shard). Slots run from 0
    without a gap in each shard, ordered by a hash part of the id, the id, size and checksum. Null ids share one key; null
    texts have size 16 and a null checksum becomes 0; repeated rows each get a slot; extra columns are ignored; an empty
    table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    rows = rows.select(
        "doc_id",
        (F.coalesce(F.octet_length("__text"), F.lit(0)).cast("long") + 16).alias("size"),
        F.coalesce(F.crc32(F.col("__text").cast("binary")), F.lit(0).cast("long")).alias("text_crc32"),
    )
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))

    def placed(df: DataFrame) -> DataFrame:
        part = F.conv(F.substring(F.md5(F.concat(key, F.lit("#slot")).cast("binary")), 1, 8), 16, 10).cast("long") % parts
        return assign(df.withColumn("__part", part), key, tree(shards), "shard")

    out = numbered(placed(rows), placed(rows.select("doc_id")), "shard", "__part", ["doc_id", "size", "text_crc32"], "slot")
    out = assign(out, key, tree(shards + 1), "grown_shard")
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int"), F.col("slot").cast("long"), F.col("grown_shard").cast("int")
    )

"""Points in boxes through cells of several sizes: an equi-join on the cell, then the exact test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sane_zones(zones: DataFrame) -> DataFrame:
    """Boxes with all bounds in range and in order, not all zero, each box once (the least name stays)."""
    bounds = ["min_lat", "max_lat", "min_long", "max_long"]
    ok = F.col("min_lat").between(-90, 90) & F.col("max_lat").between(-90, 90) & F.col("min_long").between(-180, 180) & F.col("max_long").between(-180, 180)
    ok = ok & (F.col("min_lat") < F.col("max_lat")) & (F.col("min_long") < F.col("max_long"))
    zero = (F.col("min_lat") == 0) & (F.col("max_lat") == 0) & (F.col("min_long") == 0) & (F.col("max_long") == 0)
    return zones.dropna(subset=bounds).where(ok & ~zero).groupBy(*bounds).agg(F.min("zone_name").alias("zone_name"))


def cover(zones: DataFrame) -> DataFrame:
    """Each zone under the cells of its own level that it touches: (level, cell_lat, cell_long) are added.

    Cells of level n are 180 / 2 ** n degrees wide. A zone's level has the smallest cells that are as wide as the zone, down
    to level 20, so it touches two in each direction, or four cells in all, whether it is a continent or a street.
    """
    size = F.greatest(F.col("max_lat") - F.col("min_lat"), F.col("max_long") - F.col("min_long"))
    fits = F.least(F.lit(20), F.greatest(F.lit(0), F.floor(F.log2(F.lit(180.0) / size)))).cast("int")
    out = zones.withColumn("level", fits)
    for axis in ("lat", "long"):
        out = out.withColumn(f"cell_{axis}", F.explode(F.sequence(_cell(f"min_{axis}", "level"), _cell(f"max_{axis}", "level"))))
    return out


def _cell(c: str, level: str) -> Column:
    return F.floor(F.col(c) * F.pow(F.lit(2.0), F.col(level)) / F.lit(180.0)).cast("int")


def point_in_zone(points: DataFrame, zones: DataFrame, key: str, lat: str = "lat", long: str = "long") -> DataFrame:
    """Each point once, with is_zone_breach and the least name of the zones that hold it, edges included; unnamed: UNKNOWN_ZONE.

    Zones lie under cells of their own size, points under their cell of every level that zones have, so an equi-join finds the
    few zones that may hold a point, however different they are in size.
    """
    listed = cover(sane_zones(zones))
    levels = sorted(r["level"] for r in listed.select("level").distinct().collect())  # 21 at most
    if not levels:
        return points.withColumns({"breached_zone_name": F.lit(None).cast("string"), "is_zone_breach": F.lit(False)})
    sought = points.select(key, F.col(lat).alias("__lat"), F.col(long).alias("__long"), F.explode(F.array(*map(F.lit, levels))).alias("__level"))
    cond = (F.col("__level") == F.col("level")) & (_cell("__lat", "__level") == F.col("cell_lat")) & (_cell("__long", "__level") == F.col("cell_long"))
    inside = F.col("__lat").between(F.col("min_lat"), F.col("max_lat")) & F.col("__long").between(F.col("min_long"), F.col("max_long"))
    hits = sought.join(listed, cond & inside).groupBy(key).agg(F.min(F.coalesce("zone_name", F.lit("UNKNOWN_ZONE"))).alias("breached_zone_name"))
    return points.join(hits, key, "left").withColumn("is_zone_breach", F.col("breached_zone_name").isNotNull())

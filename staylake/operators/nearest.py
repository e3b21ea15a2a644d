"""The known place nearest to a coordinate.

Distinct places are laid into a grid whose cells are cut into 4 x 4 smaller
ones until none holds more than ``LEAF`` places, so a crowded cell is cut more
often than the rest.  Every cell keeps its places' bounding box.  A coordinate
starts at the whole grid and goes down level by level: of the cells it still has
it keeps those whose box can come nearer than the farthest point of the best
box, the way a ring around it would widen.  The places of the cells left are
compared.  Every step is an equi-join on a cell; equal coordinates are
searched once.

The distance is the squared difference in degrees, longitude weighted by
``lon_scale`` (the cosine of the region's latitude makes it one on the ground).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import run_dir

LEAF = 32           # places that a cell may hold before it is cut
MAX_LEVELS = 12     # cells of the last level are a 4^12th of the extent wide


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def _square(dlat: Column, dlon: Column, lon_scale: float) -> Column:
    x = dlon * F.lit(float(lon_scale))
    return dlat * dlat + x * x


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _beyond(at: Column, low: Column, high: Column) -> Column:
    """Distance of a coordinate from an interval."""
    return F.greatest(low - at, at - high, F.lit(0.0))


def _farthest(at: Column, low: Column, high: Column) -> Column:
    return F.greatest(F.abs(low - at), F.abs(high - at))


def nearest_place(points: DataFrame, places: DataFrame, place_id: str, lat: str = "latitude",
                  lon: str = "longitude", lon_scale: float = 1.0) -> DataFrame:
    """``points`` with ``place_id`` of the nearest place and ``distance_sq``.

    Equal distances go to the smallest id; repeated places count once.  Points
    and places without two finite coordinates, and places without an id, take no
    part: such points keep their rows with NULLs, as all do without places.
    """
    spark = points.sparkSession
    known = _stored(
        places.where(_finite(F.col(lat).cast("double")) & _finite(F.col(lon).cast("double"))
                     & F.col(place_id).isNotNull())
        .groupBy(F.col(lat).cast("double").alias("plat"), F.col(lon).cast("double").alias("plon"))
        .agg(F.min(place_id).alias("pid")), "nearest-places")
    box = known.agg(F.min("plat").alias("a"), F.max("plat").alias("b"), F.min("plon").alias("c"),
                    F.max("plon").alias("d")).first()
    out = points.withColumn("__lat", F.col(lat).cast("double")).withColumn(
        "__lon", F.col(lon).cast("double"))
    kind = known.schema["pid"].dataType
    if box["a"] is None:
        return (out.drop("__lat", "__lon").withColumn(place_id, F.lit(None).cast(kind))
                .withColumn("distance_sq", F.lit(None).cast("double")))
    # the extent as [0, 1); doublings of it are exact, so a cell's parent is one shift
    wide = max(box["b"] - box["a"], box["d"] - box["c"], 1e-9) * (1 + 1e-9)
    unit = known.select("pid", "plat", "plon",
                        ((F.col("plat") - box["a"]) / wide).alias("u"),
                        ((F.col("plon") - box["c"]) / wide).alias("v"))

    def cell(level: int) -> list[Column]:
        return [F.floor(F.col(c) * F.lit(float(4 ** level))).cast("long").alias(f"{c}{level}")
                for c in "uv"]

    crowds = (unit.select(F.posexplode(F.array(*[
        F.array(*cell(n)) for n in range(MAX_LEVELS + 1)])).alias("level", "c"))
        .groupBy("level", "c").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("level").agg(F.max("n").alias("n")).collect())         # a row per level
    fine = [r["level"] for r in crowds if r["n"] <= LEAF]
    levels = min(fine, default=MAX_LEVELS)
    placed = _stored(unit.select("*", *[c for n in range(1, levels + 1) for c in cell(n)]),
                     "nearest-cells")

    asked = (out.where(_finite(F.col("__lat")) & _finite(F.col("__lon")))
             .select("__lat", "__lon").distinct())
    left = asked.select("__lat", "__lon", F.lit(0).cast("long").alias("x"),
                        F.lit(0).cast("long").alias("y"))
    by_point = Window.partitionBy("__lat", "__lon")
    for level in range(1, levels + 1):
        child = (placed.groupBy(F.col(f"u{level}").alias("cx"), F.col(f"v{level}").alias("cy"))
                 .agg(F.min("plat").alias("a"), F.max("plat").alias("b"),
                      F.min("plon").alias("c"), F.max("plon").alias("d"))
                 .withColumn("x", F.shiftright("cx", 2)).withColumn("y", F.shiftright("cy", 2)))
        at, to = F.col("__lat"), F.col("__lon")
        near = _square(_beyond(at, F.col("a"), F.col("b")), _beyond(to, F.col("c"), F.col("d")),
                       lon_scale)
        far = _square(_farthest(at, F.col("a"), F.col("b")),
                      _farthest(to, F.col("c"), F.col("d")), lon_scale)
        left = (left.join(child, ["x", "y"])
                .select("__lat", "__lon", F.col("cx").alias("x"), F.col("cy").alias("y"),
                        near.alias("near"), far.alias("far"))
                .withColumn("best", F.min("far").over(by_point))
                .where(F.col("near") <= F.col("best")).select("__lat", "__lon", "x", "y"))
        if level % 3 == 0:
            left = _stored(left, "nearest-left")    # keeps the plan short
    if levels:
        leaf = placed.select("pid", "plat", "plon", F.col(f"u{levels}").alias("x"),
                             F.col(f"v{levels}").alias("y"))
    else:
        leaf = placed.select("pid", "plat", "plon", F.lit(0).cast("long").alias("x"),
                             F.lit(0).cast("long").alias("y"))
    distance = _square(F.col("plat") - F.col("__lat"), F.col("plon") - F.col("__lon"), lon_scale)
    best = (left.join(leaf, ["x", "y"]).groupBy("__lat", "__lon")
            .agg(F.min(F.struct(distance.alias("d"), "pid")).alias("m"))
            .select(F.col("__lat").alias("__a"), F.col("__lon").alias("__b"),
                    F.col("m.pid").alias(place_id), F.col("m.d").alias("distance_sq")))
    same = (F.col("__lat") == F.col("__a")) & (F.col("__lon") == F.col("__b"))
    return out.join(best, same, "left").drop("__lat", "__lon", "__a", "__b")

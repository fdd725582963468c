"""Joins of points, boxes and polygons: equal grid cells first, then the exact test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rings import boxes_intersect, contains

BOX = "struct<min_x:double,min_y:double,max_x:double,max_y:double>"


def polygon_bounds(rings: Column, x: str = "lon", y: str = "lat") -> Column:
    points = F.flatten(rings)
    xs, ys = F.transform(points, lambda p: p[x]), F.transform(points, lambda p: p[y])
    return F.struct(F.array_min(xs).alias("min_x"), F.array_min(ys).alias("min_y"), F.array_max(xs).alias("max_x"), F.array_max(ys).alias("max_y")).cast(BOX)


def cell(v: Column, size: float) -> Column:
    return F.floor(v / F.lit(float(size))).cast("long")


def cells_of_box(rows: DataFrame, box: str, size: float) -> DataFrame:
    """rows once for each grid cell (cx, cy) that their box meets."""
    b = lambda k: F.col(f"{box}.{k}")
    rows = rows.select("*", F.explode(F.sequence(cell(b("min_x"), size), cell(b("max_x"), size))).alias("cx"))
    return rows.select("*", F.explode(F.sequence(cell(b("min_y"), size), cell(b("max_y"), size))).alias("cy"))


def points_in_polygons(points: DataFrame, polygons: DataFrame, x: str, y: str, rings: str, size: float = 1.0) -> DataFrame:
    """Pairs of points and the polygons around them.

    Polygons are spread over the grid cells of their boxes, so that the join is on equal cells at any size
    of either side; the even-odd test follows.
    """
    spread = cells_of_box(polygons.withColumn("__box", polygon_bounds(F.col(rings))), "__box", size)
    placed = points.withColumn("cx", cell(F.col(x), size)).withColumn("cy", cell(F.col(y), size))
    return placed.join(spread, ["cx", "cy"]).where(contains(F.col(rings), F.col(x), F.col(y))).drop("cx", "cy", "__box")


def boxes_that_intersect(left: DataFrame, right: DataFrame, a: str, b: str, size: float, condition: Column | None = None) -> DataFrame:
    """Pairs of rows whose boxes share area, each pair once, by the grid cell of their common corner."""
    one, two = cells_of_box(left, a, size), cells_of_box(right, b, size)
    pairs = one.join(two, ["cx", "cy"]).where(boxes_intersect(F.col(a), F.col(b)))
    corner = (cell(F.greatest(f"{a}.min_x", f"{b}.min_x"), size) == F.col("cx")) & (cell(F.greatest(f"{a}.min_y", f"{b}.min_y"), size) == F.col("cy"))
    pairs = pairs.where(corner).drop("cx", "cy")
    return pairs.where(condition) if condition is not None else pairs


def aggregate_bounds(boxes: DataFrame, box: str, *by: str) -> DataFrame:
    c = lambda k: F.col(f"{box}.{k}")
    return boxes.groupBy(*by).agg(F.min(c("min_x")).alias("min_x"), F.min(c("min_y")).alias("min_y"), F.max(c("max_x")).alias("max_x"), F.max(c("max_y")).alias("max_y"))

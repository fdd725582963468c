"""Scenes by region and quarter, resume, and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def scenes_for(scenes: DataFrame, regions: DataFrame, quarter: str) -> DataFrame:
    """Preloaded scenes of a quarter, for every region: they are not filtered by region.  regions is a small list."""
    return regions.select("region").crossJoin(scenes.where(F.col("quarter") == quarter))


def pending(tiles: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Tiles without an output yet."""
    return tiles.join(outputs.select(key).distinct(), key, "left_anti")


def finished(tiles: DataFrame, outputs: DataFrame, key: str) -> DataFrame:
    """Tiles with an output; order by their ordinal for search order."""
    return tiles.join(outputs.select(key).distinct(), key, "left_semi")


def quarter_summary(runs: DataFrame, quarter: str = "quarter", status: str = "status") -> DataFrame:
    """attempted, succeeded, failed and skipped runs of each quarter."""
    n = lambda s: F.count_if(F.col(status) == s).alias(s)
    return runs.groupBy(quarter).agg(F.count("*").alias("attempted"), n("succeeded"), n("failed"), n("skipped"))


def overlay(pixels: DataFrame, keys: list[str], order: str, precedence: str = "last") -> DataFrame:
    """One row for each of ``keys``: that of the last (or first) source by ``order``."""
    by = F.desc(order) if precedence == "last" else F.asc(order)
    return pixels.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(by))).where("__n = 1").drop("__n")


def level_stats(tiles: DataFrame, z: str = "z", data: str = "has_data") -> DataFrame:
    """(z, total, rendered, empty) of each level, and of all with a null z."""
    return tiles.rollup(z).agg(F.count("*").alias("total"), F.count_if(F.col(data)).alias("rendered"), F.count_if(~F.col(data)).alias("empty"))


def archive_stats(tiles: DataFrame) -> DataFrame:
    """Zoom range, tiles and bytes of tiles (z, has_data, data) that an archive would hold."""
    full = tiles.where("has_data")
    return full.agg(F.min("z").alias("min_zoom"), F.max("z").alias("max_zoom"), F.count("*").alias("tiles"), F.coalesce(F.sum(F.length("data")), F.lit(0)).alias("bytes"))

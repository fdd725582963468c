"""Joins of charts, masks, regions and processed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import key_strict, output_name, stem, terminal_keys

#: Keys of terminal charts that stand for one another.
ALIASES = {
    "dallasfortworth": ("dallasftworth",),
    "dallasftworth": ("dallasfortworth",),
    "sanjuan": ("puertoricovi", "puertoricovitac"),
    "puertoricovi": ("sanjuan",),
    "puertoricovitac": ("sanjuan",),
}


def alias_table(spark: SparkSession, aliases: dict[str, tuple[str, ...]] = ALIASES) -> DataFrame:
    """(key, variant) without the keys themselves."""
    return spark.createDataFrame([(k, v) for k, vs in aliases.items() for v in vs], "key string, variant string")


def with_variants(rows: DataFrame, key: str, aliases: DataFrame) -> DataFrame:
    """rows once for their own key and once for each variant of it, in ``variant``."""
    own = rows.withColumn("variant", F.col(key))
    other = rows.join(aliases.select(F.col("key").alias("__k"), F.col("variant")), F.col(key) == F.col("__k")).drop("__k")
    return own.unionByName(other)


def select_charts(charts: DataFrame, requested: list[str] | None, all_charts: bool = False) -> DataFrame:
    """charts (chart_key, chart_name, ...) that are asked for, with ``position`` in the order of asking.

    Names are compared by key and count once; unknown ones raise with the list of known charts.
    """
    if requested and all_charts:
        raise ValueError("Use either names or all charts, not both.")
    if not requested and not all_charts:
        raise ValueError("At least one chart must be named unless all are wanted.")
    if all_charts:
        return charts.withColumn("position", F.row_number().over(Window.orderBy(F.lower("chart_name"), "chart_name")) - 1)
    spark = charts.sparkSession
    wanted = spark.createDataFrame([(i, n) for i, n in enumerate(requested)], "position int, name string")
    wanted = wanted.groupBy(key_strict(F.col("name")).alias("chart_key")).agg(F.min("position").alias("position"), F.min_by("name", "position").alias("name"))
    names = charts.select("chart_key", "chart_name").distinct()
    if lost := wanted.join(names, "chart_key", "left_anti").orderBy("position").limit(1).collect():
        known = ", ".join(r[0] for r in names.select("chart_name").distinct().orderBy("chart_name").collect())
        raise ValueError(f"Requested chart {lost[0].name!r} was not found. Known charts: {known}")
    return charts.join(wanted.select("chart_key", "position"), "chart_key")


def chart_jobs(entries: DataFrame, masks: DataFrame) -> DataFrame:
    """entries (chart_name, chart_key, chart_type, coverage_key, file) with their mask path and output name.

    masks: (family, coverage_key, mask_path); family is sectional, or tac for both terminal types.  mask_path
    is null where there is no mask.
    """
    family = F.when(F.col("chart_type") == "sectional", "sectional").otherwise("tac")
    per = Window.partitionBy("chart_key")
    named = entries.withColumn("family", family).withColumn("output_name", output_name(F.col("chart_name"), stem(F.col("file")), F.count("*").over(per), F.col("chart_type")))
    return named.join(masks, ["family", "coverage_key"], "left")


def jobs_without_mask(entries: DataFrame, masks: DataFrame) -> DataFrame:
    """Entries that no mask covers, with a message."""
    family = F.when(F.col("chart_type") == "sectional", "sectional").otherwise("tac")
    lost = entries.withColumn("family", family).join(masks.select("family", "coverage_key"), ["family", "coverage_key"], "left_anti")
    return lost.withColumn("message", F.concat(F.lit("No coverage mask for "), F.col("chart_type"), F.lit(" chart "), F.col("chart_name"), F.lit(" ("), F.col("coverage_key"), F.lit(")")))


def sectional_inputs(regions: DataFrame, files: DataFrame) -> DataFrame:
    """(region, chart_ordinal, chart, path) of regions (region, ordinal, chart) and files (dir, path), by folder."""
    left = regions.select("region", F.col("ordinal").alias("chart_ordinal"), "chart", key_strict(F.col("chart")).alias("key"))
    right = files.select(key_strict(F.col("dir")).alias("key"), "path")
    return left.join(right, "key").drop("key")


def terminal_inputs(regions: DataFrame, files: DataFrame, chart_type: str, aliases: DataFrame) -> DataFrame:
    """(region, chart_ordinal, chart, path) through the keys of files (file, path) and aliases on both sides."""
    left = regions.select("region", F.col("ordinal").alias("chart_ordinal"), "chart", key_strict(F.col("chart")).alias("key"))
    right = files.select("path", F.explode(terminal_keys(F.col("file"), chart_type)).alias("file_key"))
    right = with_variants(right, "file_key", aliases).select("path", "variant").distinct()
    return with_variants(left, "key", aliases).join(right, "variant").select("region", "chart_ordinal", "chart", "path").distinct()


def region_mosaics(inputs: DataFrame) -> DataFrame:
    """(region, position, path): each path once in a region, in the order first met: by chart, then by path."""
    first = inputs.groupBy("region", "path").agg(F.min("chart_ordinal").alias("chart_ordinal"))
    place = F.row_number().over(Window.partitionBy("region").orderBy("chart_ordinal", F.lower("path"), "path"))
    return first.select("region", place.alias("position"), "path")


def mosaic_plan(mosaics: DataFrame, chart_type: str) -> DataFrame:
    """(region, output, inputs): what a mosaic is made of, in order."""
    packed = mosaics.groupBy("region").agg(F.array_sort(F.collect_list(F.struct("position", "path"))).alias("p"))
    return packed.select("region", F.concat(F.lit(f"{chart_type}-"), "region", F.lit("-mosaic.clip.jxl.vrt")).alias("output"), F.transform("p", lambda r: r["path"]).alias("inputs"))


def regions_without_input(regions: DataFrame, inputs: DataFrame) -> DataFrame:
    """(region, ordinal, chart) for which nothing was found."""
    return regions.join(inputs.select("region", "chart").distinct(), ["region", "chart"], "left_anti").select("region", "ordinal", "chart")


def relative_sources(rows: DataFrame, path: str, folder: str) -> DataFrame:
    """rows with ``source`` and relative: paths below the manifest's folder are written relative to it."""
    base = folder.rstrip("/") + "/"
    below = F.col(path).startswith(base)
    return rows.withColumn("source", F.when(below, F.substring(path, len(base) + 1, 1 << 30)).otherwise(F.col(path))).withColumn("relative", below)

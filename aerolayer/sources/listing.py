"""Listings of files, and charts found in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import failing, key_lenient, key_strict, stem, terminal_base_name

# Chart types, and files that are no charts.
CHART_TYPES = ["sectional", "tac", "fly"]
TERMINAL_SKIP = ["anchorage graphic.tif", "caribbean planning chart.tif", "new york tac vfr planning charts.tif"]
SECTIONAL_SKIP = ["honolulu inset sec.tif"]


def read_listing(spark: SparkSession, root: str) -> DataFrame:
    """(path, dir, file, size) of all files below a folder; contents are not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("size"))
    parts = F.split("path", "/")
    return rows.select("path", F.element_at(parts, -2).alias("dir"), F.element_at(parts, -1).alias("file"), "size")


def terminal_type(file: Column) -> Column:
    """tac or fly by a terminal file's name; null for files to skip; other names raise."""
    name = F.lower(file)
    s = F.regexp_replace(name, r"\.[^.]*$", "")
    unknown = failing(F.concat(F.lit("Unrecognized terminal chart name: "), file)).cast("string")
    return F.when(name.isin(TERMINAL_SKIP), F.lit(None)).when(s.endswith(" fly"), "fly").when(s.contains(" tac"), "tac").otherwise(unknown)


def discover(files: DataFrame, chart_types: list[str] = CHART_TYPES) -> DataFrame:
    """(chart_name, chart_key, chart_type, coverage_key, file, ordinal) of charts in files (dir, file).

    Folders ending in _TAC hold terminal charts, others sectional ones; ordinal is the place within a
    folder by lower-case name.  Only .tif files of the wanted types count.
    """
    if bad := [t for t in chart_types if t not in CHART_TYPES]:
        raise ValueError(f"Unsupported chart type(s): {', '.join(sorted(bad))}")
    name = F.lower("file")
    terminal = F.col("dir").endswith("_TAC")
    rows = files.where(name.endswith(".tif")).withColumn("__t", terminal)
    base = terminal_base_name(stem(F.col("file")))
    tac = rows.where("__t").withColumn("chart_type", terminal_type(F.col("file"))).where("chart_type is not null")
    tac = tac.where(F.col("chart_type").isin(chart_types)).withColumn("coverage_key", key_strict(F.concat(base, F.lit("_TAC"))))
    sec = rows.where(~F.col("__t")).where(name.endswith(" sec.tif") & ~name.isin(SECTIONAL_SKIP) & F.lit("sectional" in chart_types))
    sec = sec.withColumn("chart_type", F.lit("sectional")).withColumn("coverage_key", key_strict(F.col("dir")))
    both = tac.unionByName(sec)
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("dir").orderBy(name, "file")) - 1
    return both.select(F.col("dir").alias("chart_name"), key_strict(F.col("dir")).alias("chart_key"), "chart_type", "coverage_key", "file", place.alias("ordinal"))


def duplicate_keys(rows: DataFrame, key: str, value: str) -> DataFrame:
    """(key, n, members): keys that several distinct values share; empty if all is well."""
    return rows.groupBy(key).agg(F.count_distinct(value).alias("n"), F.array_sort(F.collect_set(value)).alias("members")).where("n > 1")


def require_unique(rows: DataFrame, key: str, value: str) -> None:
    """Raises if several values share a key."""
    if bad := duplicate_keys(rows, key, value).limit(1).collect():
        raise ValueError(f"Duplicate normalized chart key {bad[0][0]!r} from {', '.join(map(str, bad[0].members))}.")


def mask_paths(files: DataFrame) -> DataFrame:
    """(chart_key, path) of mask files by lenient stem; equal keys of two files raise."""
    rows = files.select(key_lenient(stem(F.col("path"))).alias("chart_key"), "path")
    require_unique(rows, "chart_key", "path")
    return rows


def processed_files(files: DataFrame, token: str = ".clip.", chart_type: str = "sectional") -> DataFrame:
    """Processed .tif files whose names have the token, and for terminal types their marker; by lower-case name."""
    name = F.lower("file")
    ok = name.endswith(".tif") & name.contains(token.lower())
    if chart_type in ("tac", "fly"):
        ok &= name.contains(f".{chart_type}.")
    return files.where(ok).orderBy(name)

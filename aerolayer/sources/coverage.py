"""Chart coverage: coordinate tables, GeoJSON masks and their indexes, region files."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import dms_to_degrees
from ..functions.rings import RING, geometry_of_corners, point
from ..functions.text import key_lenient, stem

#: The order of corners in a table row.
CORNERS = ["SW", "NW", "SE", "NE"]
#: All polygons as polygon -> ring -> position; positions are arrays of two numbers or more.
GEOMETRY = "struct<type:string,coordinates:string>"
MULTI = "array<array<array<array<double>>>>"


def table_rows(lines: DataFrame, headers: list[str]) -> DataFrame:
    """(chart, source_fields, corners, parse_error) of rows ``line``: the last eight words are coordinates.

    headers are the table's nine names, the first of them Chart.
    """
    if len(headers) != 9 or headers[0] != "Chart":
        raise ValueError("Unexpected coverage header format.")
    words = F.split(F.btrim("line", F.lit(" \t\r\n")), r"\s+")
    rows = lines.where(F.btrim("line", F.lit(" \t\r\n")) != "").withColumn("__w", words)
    short = F.size("__w") < 9
    rows = rows.withColumn("__v", F.when(~short, F.slice("__w", -8, 8)))
    chart = F.when(~short, F.array_join(F.slice("__w", F.lit(1), F.size("__w") - 8), " "))
    degrees = F.transform("__v", dms_to_degrees)
    corners = F.map_from_arrays(F.array(*map(F.lit, CORNERS)), F.array(*[point(F.col("__d")[4 + i], F.col("__d")[i]) for i in range(4)]))
    bad = F.exists("__d", lambda d: d.isNull())
    error = F.when(short, F.concat(F.lit("Coverage row has too few fields: "), F.col("line"))).when(bad, F.concat(F.lit("Unsupported coordinate format: "), F.array_join("__v", " ")))
    fields = F.map_from_arrays(F.array(*map(F.lit, headers[1:])), F.col("__v"))
    out = rows.withColumn("__d", degrees)
    keep = [c for c in lines.columns if c != "line"]
    return out.select(*keep, chart.alias("chart"), F.when(~short, fields).alias("source_fields"), F.when(~short & ~bad, corners).alias("corners"), error.alias("parse_error"))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a coverage text file; its first line that is not blank is the quoted header."""
    text = spark.read.text(path, wholetext=True)
    head = text.select(F.regexp_extract_all("value", F.lit('"([^"\n]+)"'), F.lit(1)).alias("h")).first()
    headers = (head.h if head else [])[:9]
    lines = text.select(F.posexplode(F.split("value", r"\r?\n")).alias("pos", "line")).where("trim(line) <> ''")
    first = lines.agg(F.min("pos")).first()[0]
    rows = table_rows(lines.where(F.col("pos") > (first if first is not None else -1)), headers)
    if rows.isEmpty():
        raise ValueError("Coverage file must include a header and at least one row.")
    return rows


def chart_features(rows: DataFrame) -> DataFrame:
    """(chart, geom_type, polygons, properties) of good rows: corners in decimals, split at the antimeridian."""
    g = geometry_of_corners(F.col("corners"))
    decimals = F.transform_values("corners", lambda k, p: F.struct(p["lat"].alias("latitude"), p["lon"].alias("longitude")))
    properties = F.struct("chart", decimals.alias("corner_decimal_degrees"), "source_fields")
    rest = [c for c in rows.columns if c not in ("chart", "source_fields", "corners", "parse_error")]
    return rows.where("parse_error is null").withColumn("__g", g).select(*rest, "chart", F.col("__g.type").alias("geom_type"), F.col("__g.polygons").alias("polygons"), properties.alias("properties"))


def feature_json(features: DataFrame) -> DataFrame:
    """(chart, value): each feature as GeoJSON; a MultiPolygon nests once more."""
    ring = lambda r: F.transform(r, lambda p: F.array(p["lon"], p["lat"]))
    single = F.to_json(F.struct(F.array(ring(F.col("polygons")[0])).alias("coordinates"), F.lit("Polygon").alias("type")))
    multi = F.to_json(F.struct(F.transform("polygons", lambda r: F.array(ring(r))).alias("coordinates"), F.lit("MultiPolygon").alias("type")))
    geometry = F.when(F.col("geom_type") == "Polygon", single).otherwise(multi)
    value = F.concat(F.lit('{"geometry":'), geometry, F.lit(',"properties":'), F.to_json("properties"), F.lit(',"type":"Feature"}'))
    return features.select("chart", value.alias("value"))


def multi_polygon(kind: Column, coordinates: Column) -> Column:
    """Coordinates (JSON) of a Polygon or MultiPolygon as a MultiPolygon; other kinds and none raise."""
    deep = F.from_json(F.when(kind == "Polygon", F.concat(F.lit("["), coordinates, F.lit("]"))).when(kind == "MultiPolygon", coordinates), MULTI)
    bad = F.raise_error(F.concat(F.lit("Unsupported geometry type: "), F.coalesce(kind, F.lit("null")))).cast(MULTI)
    return F.when(kind.isin("Polygon", "MultiPolygon") & coordinates.isNotNull(), deep).otherwise(bad)


def features_of(texts: DataFrame, column: str, properties: str = "map<string,string>") -> DataFrame:
    """texts with a row for each feature of a FeatureCollection: ordinal, properties, kind, coordinates (JSON).

    Other documents raise.
    """
    schema = f"struct<type:string,features:array<struct<type:string,properties:{properties},geometry:{GEOMETRY}>>>"
    doc = F.from_json(F.col(column), schema)
    bad = F.raise_error(F.lit("not a GeoJSON FeatureCollection")).cast(schema)
    rows = texts.withColumn("__c", doc).withColumn("__c", F.when((F.col("__c.type") == "FeatureCollection") & F.col("__c.features").isNotNull(), F.col("__c")).otherwise(bad))
    rows = rows.select(*texts.columns, F.posexplode("__c.features").alias("ordinal", "__f"))
    return rows.select(*texts.columns, "ordinal", F.col("__f.properties").alias("properties"), F.col("__f.geometry.type").alias("kind"), F.col("__f.geometry.coordinates").alias("coordinates"))


def chart_index(features: DataFrame) -> DataFrame:
    """(chart_key, chart, polygons): features by lenient chart key, the last of equal keys."""
    chart = F.col("properties")["chart"]
    named = F.when(chart.isNotNull(), chart).otherwise(F.raise_error(F.lit("coverage feature has no chart")).cast("string"))
    rows = features.select(key_lenient(named).alias("chart_key"), named.alias("chart"), multi_polygon(F.col("kind"), F.col("coordinates")).alias("polygons"), "ordinal")
    best = rows.groupBy("chart_key").agg(F.max_by(F.struct("chart", "polygons"), "ordinal").alias("r"))
    return best.select("chart_key", "r.chart", "r.polygons")


def mask_index(files: DataFrame) -> DataFrame:
    """(chart_key, polygons) of mask files (path, value): all polygons of a file as one MultiPolygon, in order."""
    rows = features_of(files.select("path", "value"), "value").where("kind in ('Polygon', 'MultiPolygon')")
    rows = rows.select(key_lenient(stem(F.col("path"))).alias("chart_key"), "path", "ordinal", multi_polygon(F.col("kind"), F.col("coordinates")).alias("polygons"))
    return merge_geometries(rows, ["chart_key"], ["path", "ordinal"])


def merge_geometries(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """(keys, polygons): the polygons of each key in ``order``, joined without dissolving."""
    packed = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, "polygons"))).alias("p"))
    return packed.select(*keys, F.flatten(F.transform("p", lambda r: r["polygons"])).alias("polygons"))


def region_geometries(texts: DataFrame, column: str = "value") -> DataFrame:
    """(region, polygons) of region files; unnamed ones are 'unknown', those without geometry are left out."""
    rows = features_of(texts.select(column), column).where("kind is not null")
    return rows.select(F.coalesce(F.col("properties")["region-name"], F.lit("unknown")).alias("region"), multi_polygon(F.col("kind"), F.col("coordinates")).alias("polygons"))


def read_whole(spark: SparkSession, path: str) -> DataFrame:
    """(path, value) of text files as a whole."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def region_mapping(texts: DataFrame, chart_type: str, column: str = "value") -> DataFrame:
    """(region, ordinal, chart) of region mapping JSON, for a chart type."""
    keys = {"sectional": "sectional", "tac": "terminal_area", "fly": "terminal_area"}
    if chart_type not in keys:
        raise ValueError(f"Unsupported chart type for region mapping: {chart_type}")
    schema = "map<string,map<string,array<string>>>"
    chosen = F.from_json(F.col(column), schema)[keys[chart_type]]
    bad = F.raise_error(F.lit(f"Mapping JSON missing .{keys[chart_type]} object")).cast("map<string,array<string>>")
    rows = texts.select(F.explode(F.coalesce(chosen, bad)).alias("region", "charts"))
    return rows.select("region", F.posexplode("charts").alias("ordinal", "chart"))


def exterior(polygons: Column) -> Column:
    """The rings of a MultiPolygon as arrays of (lon, lat)."""
    return F.transform(F.flatten(polygons), lambda r: F.transform(r, lambda p: point(p[0], p[1]))).cast(f"array<{RING}>")


def load_resolutions(text: str) -> list[float]:
    """``resolutions`` of a config JSON."""
    found = json.loads(text).get("resolutions")
    if not isinstance(found, list) or not found:
        raise ValueError("config needs a list of resolutions")
    return [float(v) for v in found]

"""Whole pipelines: from source files to GeoJSON, plans and tiles."""

from __future__ import annotations

import datetime as dt
import json
import logging
import os
import urllib.request

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grid, rings, text, tone
from ..functions.features import to_features
from ..functions.projection import crs_name, from_lambert
from ..operators import charts, packages, scenes
from ..raster import kernels, longform
from ..raster.render import render_tiles
from ..sinks import archive, geojson
from ..sources import coverage, listing, navaids, obstacles, web

log = logging.getLogger("aerolayer")


def parse_obstacles(spark: SparkSession, out: str, input: str | None = None, input_dir: str | None = None, states=None, system: str = "wgs84", amsl_z: bool = False) -> dict:
    """Obstacle files to one GeoJSON file; returns the counts, and the messages of wrong lines as a DataFrame."""
    if (input is None) == (input_dir is None):
        raise ValueError("give either a file or a directory")
    text.state_filter(states)
    lines = obstacles.read_lines(spark, input) if input else obstacles.read_state_files(spark, input_dir)
    parsed = obstacles.parse(lines).persist()
    try:
        kept = obstacles.normalize(obstacles.good(parsed).where(obstacles.in_states(states)))
        geojson.write_features(to_features(kept, system, amsl_z), out, crs_name(system))
        counts = obstacles.summary(parsed, states).first().asDict()
        files = 1 if input else lines.select("file").distinct().count()
        return counts | {"file_count": files, "errors": obstacles.errors(parsed)}
    finally:
        parsed.unpersist()


def parse_navaids(spark: SparkSession, input: str, out: str, system: str = "wgs84") -> dict:
    """Navigation aids of an XML file to GeoJSON; returns counts and the effective date."""
    members = navaids.read_members(spark, input).withColumn("n", F.monotonically_increasing_id()).persist()
    try:
        raw = navaids.raw_navaids(members).where("parse_error is null").drop("parse_error", "has_location")
        rcc = navaids.last_of_each(navaids.channels(members), "rcc_id", "n")
        full = navaids.normalize(navaids.resolve(raw, rcc, "n"))
        geojson.write_features(to_features(full, system), out, crs_name(system), keep_nulls=False)
        return navaids.summary(members).first().asDict() | {"effective_date": navaids.effective_date(spark, input)}
    finally:
        members.unpersist()


def convert_coverage(spark: SparkSession, input: str, output: str | None = None, folder: str | None = None, indent: int = 2) -> int:
    """A coverage table to one GeoJSON file or a folder of files; wrong rows raise.  Returns the number of charts."""
    if (output is None) == (folder is None):
        raise ValueError("give either an output file or a folder")
    rows = coverage.read_table(spark, input)
    if bad := rows.where("parse_error is not null").orderBy("pos").limit(1).collect():
        raise ValueError(f"Invalid coverage row at line {bad[0].pos + 1}: {bad[0].parse_error}")
    features = coverage.feature_json(coverage.chart_features(rows).orderBy("pos"))
    if folder:
        return geojson.write_feature_folder(features, folder, indent)
    geojson.write_collection(features, output, indent)
    return rows.count()


def fetch_plan(spark: SparkSession, root_url: str, fetch=web.fetch_text, exists=web.url_exists, cycle: str | None = None, chart_types: list[str] | None = None) -> tuple[str, DataFrame]:
    """The newest complete cycle (or the given one) and its packages."""
    types = text.normalized_list(chart_types, list(packages.SUBFOLDERS))
    if cycle is None:
        pages = spark.createDataFrame([(fetch(root_url),)], "html string")
        known = [r.cycle for r in packages.cycles(pages).orderBy(F.desc("cycle_date")).collect()]
        if not known:
            raise ValueError("Unable to discover chart cycles.")
        cycle = next((c for c in known if all(exists(f"{root_url}{c}/All_Files/{f}") for f in packages.COMPLETE_SETS.values())), None)
        if cycle is None:
            raise ValueError("Unable to find a published chart cycle with all sets.")
    urls = [(t, cycle, f"{root_url}{cycle}/{packages.SUBFOLDERS[t]}/") for t in types]
    specs = packages.packages(spark.createDataFrame([(*u, fetch(u[2])) for u in urls], "chart_type string, cycle string, index_url string, html string"))
    found = {r[0] for r in specs.select("chart_type").distinct().collect()}
    if lost := [u for u in urls if u[0] not in found]:
        raise ValueError(f"No zip packages found for {lost[0][0]} at {lost[0][2]}")
    return cycle, specs


def fetch_manifest(results: DataFrame, cycle: str, chart_types: list[str], root_url: str) -> dict:
    return geojson.manifest(results, cycle, chart_types, root_url, dt.datetime.now(dt.UTC).isoformat())


def fetch(spark: SparkSession, specs: DataFrame, cycle: str, chart_types: list[str], root_url: str, folder: str, opener=None, force: bool = False, extract: bool = True, dry_run: bool = False) -> dict:
    """Downloads and unpacks packages that are not there yet, and writes the manifest; returns it.

    There are some hundred packages of a cycle, so the driver fetches them one after another.
    """
    rows = specs.withColumn("zip_path", F.concat("chart_type", F.lit("/"), "zip_name"))
    there = [(r.zip_path, os.path.getsize(p)) for r in rows.collect() if os.path.exists(p := os.path.join(folder, r.zip_path))]
    planned = packages.with_status(rows, spark.createDataFrame(there, "zip_path string, size long"), not force, dry_run)
    results = []
    for r in planned.orderBy("chart_type", "folder_name").collect():
        target, got, files = os.path.join(folder, r.zip_path), {"headers": {}}, 0
        if r.downloaded:
            got = packages.download(r.url, target, opener or urllib.request.urlopen)
        if r.downloaded and extract:
            files = packages.safe_unzip(target, os.path.join(folder, r.chart_type, r.folder_name))
        h = got["headers"]
        size = os.path.getsize(target) if os.path.exists(target) else None
        length = h.get("content-length", "")
        results.append((r.chart_type, r.zip_name, r.folder_name, r.url, r.zip_path, r.status, r.downloaded, files, size, int(length) if length.strip().isdigit() else None, h.get("etag"), h.get("last-modified")))
    schema = "chart_type string, zip_name string, folder_name string, url string, zip_path string, status string, downloaded boolean, extracted_files int, size_bytes long, content_length long, etag string, last_modified string"
    out = fetch_manifest(spark.createDataFrame(results, schema), cycle, chart_types, root_url)
    geojson.write_json(out, os.path.join(folder, f"fetch-manifest-{cycle}.json"), sort_keys=True)
    return out


def preprocess_jobs(spark: SparkSession, raw: str, masks: DataFrame, requested: list[str] | None, all_charts: bool = False, chart_types: list[str] | None = None, continue_on_error: bool = False) -> tuple[DataFrame, DataFrame]:
    """(jobs, failures) of charts below a folder; a chart without a mask raises unless failures may go on."""
    found = listing.discover(listing.read_listing(spark, raw), text.normalized_list(chart_types, listing.CHART_TYPES))
    listing.require_unique(found, "chart_key", "chart_name")
    chosen = charts.select_charts(found, requested, all_charts)
    failures = charts.jobs_without_mask(chosen, masks)
    if not continue_on_error and (bad := failures.limit(1).collect()):
        raise ValueError(bad[0].message)
    return charts.chart_jobs(chosen, masks).where("mask_path is not null"), failures


def region_mosaics(spark: SparkSession, mapping: str, processed: str, chart_type: str, token: str = ".clip.") -> tuple[DataFrame, DataFrame]:
    """(plan, missing): inputs of each region's mosaic in order, and charts for which there is none."""
    wanted = coverage.region_mapping(coverage.read_whole(spark, mapping), chart_type)
    files = listing.processed_files(listing.read_listing(spark, processed), token, chart_type)
    if chart_type == "sectional":
        inputs = charts.sectional_inputs(wanted, files)
    else:
        inputs = charts.terminal_inputs(wanted, files, chart_type, charts.alias_table(spark))
    return charts.mosaic_plan(charts.region_mosaics(inputs), chart_type), charts.regions_without_input(wanted, inputs)


def slope_layer(dem: DataFrame, keys: list[str], least: float = 10.0, kernel: int = 0, cell_x: float = 1.0, cell_y: float = 1.0, scale: float = 1.0) -> DataFrame:
    """(keys, row, col, l, a): slopes in degrees, smoothed, cut off below ``least``, as luminance and alpha."""
    s = longform.box_mean(longform.slope(dem, keys, cell_x, cell_y, scale), keys, kernel)
    return s.withColumn("p", tone.luminance_alpha(tone.threshold(F.col("v"), least))).select(*keys, "row", "col", "p.l", "p.a")


def true_color_layer(bands: DataFrame, r: str = "r", g: str = "g", b: str = "b") -> DataFrame:
    """bands (digital numbers in columns r, g, b) with those replaced by colours, and alpha in ``a``."""
    keep = [c for c in bands.columns if c not in (r, g, b, "a")]
    return bands.withColumn("__p", tone.true_color(F.col(r), F.col(g), F.col(b))).select(*keep, "__p.r", "__p.g", "__p.b", "__p.a")


def chart_layers(pixels: DataFrame, palette: DataFrame, geo, cutline) -> tuple[DataFrame, DataFrame]:
    """(full, clipped) colours of a chart's palette indexes: the coloured pixels are kept for both, as a tee.

    pixels: keys, row, col, index; geo and cutline are columns as clip_to_polygon takes them.
    """
    full = longform.apply_palette(pixels, palette).persist()
    return full, longform.clip_to_polygon(full, geo, cutline)


def quarter_report(runs: DataFrame) -> list[dict]:
    """For each quarter: counts of runs by status, and its regions with theirs (runs: quarter, region, status)."""
    packed = runs.groupBy("quarter").agg(F.array_sort(F.collect_list(F.struct("region", "status"))).alias("regions"))
    rows = scenes.quarter_summary(runs).join(packed, "quarter").orderBy("quarter")
    return list(geojson.rows_of(rows))


def write_quarter_report(runs: DataFrame, path: str) -> None:
    """quarter_report as a JSON file."""
    geojson.write_json({"quarters": quarter_report(runs)}, path)


def write_scene_list(scene_rows: DataFrame, path: str) -> None:
    """Saved scenes (value: scene JSON) as one JSON list that the scene source reads again."""
    geojson.write_json([json.loads(r["value"]) for r in geojson.rows_of(scene_rows.select("value"))], path)


def chart_masks(pixels: DataFrame, keys: list[str], options: kernels.MaskOptions | None = None) -> DataFrame:
    """(keys, row, col, on): the area of each chart of palette indexes ``v``."""
    return kernels.per_raster(pixels, keys, "v", lambda a: {"on": kernels.chart_mask(a.astype("uint8"), options)[0]}, "on boolean")


def wgs84_bounds(spark: SparkSession, bounds: tuple[float, float, float, float]) -> tuple[float, float, float, float]:
    """A projected box in degrees, from 22 points on each side."""
    b = spark.range(1).select(grid.box(*bounds).alias("b")).select(rings.densify(F.col("b"), 22).alias("p"))
    p = b.select(F.transform("p", lambda q: from_lambert(q["x"], q["y"])).alias("p"))
    return tuple(p.select(rings.bounds_of_points(F.col("p"), "lon", "lat").alias("b")).select("b.*").first())


def build_tiles(spark: SparkSession, rasters: DataFrame, bounds: tuple[float, float, float, float], out: str, resolutions: list[float], kind: str = "archive", fmt: str = "png", quality: int = 30, tile_size: int = grid.TILE_SIZE, crs: str = "ESRI:102009") -> dict:
    """Tiles of one raster (see render_tiles; key ``raster``) as an archive or a folder; returns the tile config."""
    if kind not in ("archive", "folder"):
        raise ValueError("kind is archive or folder")
    steps = grid.validate_resolutions(resolutions)
    specs = grid.tile_specs(rasters.select("raster").withColumn("b", grid.box(*bounds)), "b", steps, tile_size=tile_size)
    tiles = render_tiles(specs, rasters, "raster", fmt, quality, tile_size).persist()
    try:
        wgs84 = wgs84_bounds(spark, bounds)
        config = geojson.tile_config(crs, bounds, wgs84, steps, (bounds[0], bounds[3]), tile_size, fmt)
        if kind == "archive":
            archive.write_archive(tiles, out, wgs84, {"tileConfig": config}, fmt)
        else:
            archive.write_tile_folder(tiles, out, fmt, tile_size).collect()
        stats = {r["z"]: r.asDict() for r in scenes.level_stats(tiles).collect()}
        log.info("tiles written", extra={"levels": stats})
        return config
    finally:
        tiles.unpersist()

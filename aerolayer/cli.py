"""Command line: python -m aerolayer.cli COMMAND ..."""

from __future__ import annotations

import argparse
import json
import logging
import sys

from .functions.grid import RESOLUTIONS
from .operators.packages import SUBFOLDERS
from .sources.listing import CHART_TYPES


class JsonLines(logging.Formatter):
    """Records as JSON, with whatever was passed as extra."""

    STANDARD = frozenset(logging.LogRecord("", 0, "", 0, "", (), None).__dict__) | {"message", "asctime", "taskName"}

    def format(self, record: logging.LogRecord) -> str:
        extra = {k: v for k, v in record.__dict__.items() if k not in self.STANDARD}
        return json.dumps({"time": self.formatTime(record), "level": record.levelname, "logger": record.name, "message": record.getMessage(), **extra}, default=str)


def configure_logging(level: str = "INFO", structured: bool = False) -> None:
    """Sets up the package's logger once, however often it is called."""
    root = logging.getLogger("aerolayer")
    root.setLevel(level.upper())
    for h in list(root.handlers):
        root.removeHandler(h)
    h = logging.StreamHandler()
    h.setFormatter(JsonLines() if structured else logging.Formatter("%(levelname)s %(message)s"))
    root.addHandler(h)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="aerolayer")
    p.add_argument("--master", default=None)
    p.add_argument("--log-level", default="INFO")
    p.add_argument("--json-logs", action="store_true")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("parse-obstacles")
    source = c.add_mutually_exclusive_group(required=True)
    source.add_argument("--input")
    source.add_argument("--input-dir")
    c.add_argument("--geojson-out", required=True)
    c.add_argument("--state", action="append")
    c.add_argument("--coordinate-system", default="wgs84", choices=["wgs84", "esri:102009"])
    c.add_argument("--include-amsl-z", action="store_true")
    c = sub.add_parser("parse-navaids")
    c.add_argument("--input", required=True)
    c.add_argument("--geojson-out", required=True)
    c.add_argument("--coordinate-system", default="wgs84", choices=["wgs84", "esri:102009"])
    c = sub.add_parser("convert-coverage")
    c.add_argument("--input", required=True)
    target = c.add_mutually_exclusive_group(required=True)
    target.add_argument("--output")
    target.add_argument("--coverage-dir")
    c.add_argument("--indent", type=int, default=2)
    c = sub.add_parser("fetch-plan")
    c.add_argument("--root-url", required=True)
    c.add_argument("--cycle")
    c.add_argument("--chart-type", action="append")
    c = sub.add_parser("fetch")
    c.add_argument("--root-url", required=True)
    c.add_argument("--cycle")
    c.add_argument("--chart-type", action="append")
    c.add_argument("--output-dir", required=True)
    c.add_argument("--force", action="store_true")
    c.add_argument("--no-extract", action="store_true")
    c.add_argument("--dry-run", action="store_true")
    for name in ("slope", "true-color", "chart-mask"):
        c = sub.add_parser(name, help="of rasters as rows in Parquet: raster, row, col and v (or r, g, b)")
        c.add_argument("--input", required=True)
        c.add_argument("--output", required=True)
        c.add_argument("--slope-threshold", type=float, default=10.0)
        c.add_argument("--smooth-kernel", type=int, default=0)
        c.add_argument("--pixel-size", type=float, default=1.0)
    c = sub.add_parser("region-mosaics")
    c.add_argument("--mapping-json", required=True)
    c.add_argument("--processed-root", required=True)
    c.add_argument("--chart-type", required=True, choices=CHART_TYPES)
    c.add_argument("--file-match-token", default=".clip.")
    c = sub.add_parser("build-tiles")
    c.add_argument("--rasters", required=True, help="Parquet of rasters: raster, bands, rows, cols, affine, pixels, nodata")
    c.add_argument("--bounds", required=True, type=float, nargs=4)
    c.add_argument("--output", required=True)
    c.add_argument("--output-kind", default="archive", choices=["archive", "folder"])
    c.add_argument("--format", default="png")
    c.add_argument("--quality", type=int, default=30)
    ladder = c.add_mutually_exclusive_group()
    ladder.add_argument("--config")
    ladder.add_argument("--resolution", action="append", type=float)
    return p


def main(argv: list[str] | None = None) -> int:
    """0 if all went well, 1 on an error of the input."""
    a = parser().parse_args(argv)
    configure_logging(a.log_level, a.json_logs)
    from .plans import api
    from .session import session
    from .sources.coverage import load_resolutions

    spark = session(a.master)
    try:
        if a.command == "parse-obstacles":
            done = api.parse_obstacles(spark, a.geojson_out, a.input, a.input_dir, a.state, a.coordinate_system, a.include_amsl_z)
            for r in done.pop("errors").toLocalIterator():
                print(r.message, file=sys.stderr)
            print(json.dumps(done))
        elif a.command == "parse-navaids":
            print(json.dumps(api.parse_navaids(spark, a.input, a.geojson_out, a.coordinate_system)))
        elif a.command == "convert-coverage":
            print(json.dumps({"charts": api.convert_coverage(spark, a.input, a.output, a.coverage_dir, a.indent)}))
        elif a.command == "fetch-plan":
            cycle, specs = api.fetch_plan(spark, a.root_url, cycle=a.cycle, chart_types=a.chart_type)
            print(json.dumps({"cycle": cycle, "packages": [r.asDict() for r in specs.toLocalIterator()]}))
        elif a.command == "fetch":
            types = a.chart_type or list(SUBFOLDERS)
            cycle, specs = api.fetch_plan(spark, a.root_url, cycle=a.cycle, chart_types=types)
            print(json.dumps(api.fetch(spark, specs, cycle, types, a.root_url, a.output_dir, force=a.force, extract=not a.no_extract, dry_run=a.dry_run)))
        elif a.command in ("slope", "true-color", "chart-mask"):
            rows = spark.read.parquet(a.input)
            if a.command == "slope":
                out = api.slope_layer(rows, ["raster"], a.slope_threshold, a.smooth_kernel, a.pixel_size, a.pixel_size)
            else:
                out = api.true_color_layer(rows) if a.command == "true-color" else api.chart_masks(rows, ["raster"])
            out.write.parquet(a.output)
        elif a.command == "region-mosaics":
            plan, missing = api.region_mosaics(spark, a.mapping_json, a.processed_root, a.chart_type, a.file_match_token)
            for r in missing.toLocalIterator():
                print(f"Warning: {a.chart_type} chart '{r.chart}' of region '{r.region}' not found", file=sys.stderr)
            for r in plan.toLocalIterator():
                print(json.dumps(r.asDict()))
        else:
            steps = a.resolution or RESOLUTIONS
            if a.config:
                with open(a.config) as f:
                    steps = load_resolutions(f.read())
            config = api.build_tiles(spark, spark.read.parquet(a.rasters), tuple(a.bounds), a.output, steps, a.output_kind, a.format, a.quality)
            print(json.dumps(config))
        return 0
    except ValueError as e:
        print(f"error: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())

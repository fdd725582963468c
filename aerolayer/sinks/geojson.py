"""GeoJSON files and folders, and JSON documents about runs."""

from __future__ import annotations

import gzip
import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..functions.features import to_json_text
from ..functions.text import chart_filename
from ..sources.listing import require_unique


def uri_of(path: str) -> str:
    return path if "://" in path else "file://" + path


@dataclass
class _Part(WriterCommitMessage):
    path: str
    ordinal: int
    count: int


class FeatureCollectionSink(DataSource):
    """Format ``feature_collection``: rows (value) of feature JSON become one gzip FeatureCollection.

    Options: path; crs, a name for projected coordinates.  Each task stages its features as a gzip member;
    committing joins the members in the order of partitions between header and footer, as gzip files may be
    concatenated.
    """

    @classmethod
    def name(cls) -> str:
        return "feature_collection"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _CollectionWriter(dict(self.options))


class _CollectionWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.path, self.crs = uri_of(options["path"]), options.get("crs")
        self.stage = f"{self.path}.parts-{uuid.uuid4().hex}"

    def write(self, iterator) -> WriterCommitMessage:
        from pyspark import TaskContext

        fs, stage = pafs.FileSystem.from_uri(self.stage)
        fs.create_dir(stage, recursive=True)
        path, count = f"{stage}/{uuid.uuid4().hex}", 0
        with fs.open_output_stream(path) as raw, gzip.GzipFile(fileobj=raw, mode="wb", mtime=0) as out:
            for r in iterator:
                out.write((("," if count else "") + r.value).encode())
                count += 1
        context = TaskContext.get()
        return _Part(path, context.partitionId() if context else 0, count)

    def abort(self, messages) -> None:
        fs, stage = pafs.FileSystem.from_uri(self.stage)
        if fs.get_file_info(stage).type != pafs.FileType.NotFound:
            fs.delete_dir(stage)

    def commit(self, messages) -> None:
        fs, target = pafs.FileSystem.from_uri(self.path)
        parts = sorted((m for m in messages if m and m.count), key=lambda m: m.ordinal)
        crs = json.dumps({"type": "name", "properties": {"name": self.crs}}, sort_keys=True)
        head = '{"type":"FeatureCollection",' + (f'"crs":{crs},' if self.crs else "") + '"features":['
        with fs.open_output_stream(f"{target}.tmp") as out:
            out.write(gzip.compress(head.encode(), mtime=0))
            for i, p in enumerate(parts):
                if i:
                    out.write(gzip.compress(b",", mtime=0))
                with fs.open_input_stream(p.path) as data:
                    while block := data.read(1 << 20):
                        out.write(block)
            out.write(gzip.compress(b"]}\n", mtime=0))
        fs.move(f"{target}.tmp", target)
        self.abort(messages)


def write_features(features: DataFrame, path: str, crs: str | None = None, keep_nulls: bool = True) -> None:
    """Features (type, geometry, properties) as one gzip FeatureCollection with sorted keys."""
    features.sparkSession.dataSource.register(FeatureCollectionSink)
    w = to_json_text(features, keep_nulls).write.format("feature_collection").mode("append")
    (w.option("crs", crs) if crs else w).save(path)


def read_collection(path: str) -> dict:
    fs, p = pafs.FileSystem.from_uri(uri_of(path))
    raw = fs.open_input_file(p).read()
    return json.loads(gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw)


def write_feature_folder(features: DataFrame, folder: str, indent: int = 2) -> int:
    """One file for each row (chart, value), named by the chart's slug; equal names raise before any is written."""
    named = features.withColumn("file", chart_filename(F.col("chart")))
    counts = named.groupBy("file").count().where("count > 1").limit(1).collect()
    if counts:
        raise ValueError(f"Duplicate output path for chart: {counts[0].file!r}")
    require_unique(named, "file", "chart")
    uri = uri_of(folder)

    def run(frames):
        import pandas as pd

        fs, root = pafs.FileSystem.from_uri(uri)
        fs.create_dir(root, recursive=True)
        for df in frames:
            for file, value in zip(df["file"], df["value"], strict=True):
                with fs.open_output_stream(f"{root}/{file}") as f:
                    f.write((json.dumps(json.loads(value), indent=indent, ensure_ascii=False) + "\n").encode())
            yield pd.DataFrame({"n": [len(df)]})

    return named.select("file", "value").mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def write_json(document: object, path: str, indent: int = 2, sort_keys: bool = False) -> None:
    fs, p = pafs.FileSystem.from_uri(uri_of(path))
    fs.create_dir(p.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(p) as f:
        f.write((json.dumps(document, indent=indent, sort_keys=sort_keys, ensure_ascii=False) + "\n").encode())


def rows_of(df: DataFrame) -> Iterable[dict]:
    """The rows of a report, which is small by nature, streamed partition by partition."""
    return (r.asDict(recursive=True) for r in df.toLocalIterator())


def write_collection(features: DataFrame, path: str, indent: int = 2) -> None:
    """Rows (value) of feature JSON as one indented FeatureCollection."""
    write_json({"type": "FeatureCollection", "features": [json.loads(r["value"]) for r in rows_of(features.select("value"))]}, path, indent)


def manifest(results: DataFrame, cycle: str, chart_types: list[str], root_url: str, generated: str) -> dict:
    """A fetch manifest: counts and packages, in order of type and folder."""
    rows = list(rows_of(results.orderBy("chart_type", "folder_name")))
    return {
        "generated_at_utc": generated,
        "cycle": cycle,
        "chart_types": chart_types,
        "source": {"visual_root_url": root_url},
        "package_count": len(rows),
        "downloaded_count": sum(bool(r["downloaded"]) for r in rows),
        "skipped_count": sum(r["status"] == "skipped-existing" for r in rows),
        "packages": rows,
    }


def tile_config(crs: str, bounds: tuple, wgs84: tuple, resolutions: list[float], origin: tuple[float, float], tile_size: int = 512, fmt: str = "webp") -> dict:
    """The document that tells a map client how tiles are laid out."""
    if not resolutions:
        raise ValueError("At least one resolution is required.")
    return {
        "schemaVersion": "1.0",
        "crs": {"type": "wkt", "value": crs},
        "tile": {"tileSizePx": tile_size, "format": fmt, "origin": list(origin), "resolutions": list(resolutions)},
        "extent": {"crsUnits": list(bounds), "wgs84": list(wgs84)},
        "sources": [],
    }


def tile_config_name(archive: str | None) -> str:
    """tile_config.json, or {stem}-config.json beside an archive."""
    return "tile_config.json" if archive is None else archive.rpartition("/")[2].rsplit(".", 1)[0] + "-config.json"

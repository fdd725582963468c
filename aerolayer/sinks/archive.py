"""Single-file tile archives (version 3) and tile folders."""

from __future__ import annotations

import gzip
import json
import struct
import uuid
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from ..functions.grid import tile_id, with_archive_zoom

# Fixed values of the format: header, compressions, tile types, sizes of directories.
MAGIC, VERSION, HEADER = b"PMTiles", 3, 127
NO_COMPRESSION, GZIP = 1, 2
TILE_TYPES = {"png": 2, "webp": 4, "avif": 5}
ROOT_LIMIT, FIRST_LEAF = 16384 - HEADER, 4096
FIELDS = ["root_offset", "root_length", "metadata_offset", "metadata_length", "leaf_offset", "leaf_length", "data_offset", "data_length", "addressed", "entries", "contents"]


def entries_of(tiles: DataFrame) -> DataFrame:
    """(tile_id, offset, length, run_length) of tiles (tile_id, length), in the order of ids.

    Offsets are sums over range partitions, plus each partition's base: no global window gathers all
    tiles in one task.
    """
    part = tiles.select("tile_id", "length").repartitionByRange("tile_id").withColumn("p", F.spark_partition_id())
    within = Window.partitionBy("p").orderBy("tile_id").rowsBetween(Window.unboundedPreceding, -1)
    local = part.withColumn("local", F.coalesce(F.sum("length").over(within), F.lit(0)))
    sums = part.groupBy("p").agg(F.sum("length").alias("n"))
    # One row for each partition: the only window over all rows sees those.
    base = sums.select(F.col("p").alias("q"), F.coalesce(F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    return local.join(base, F.col("p") == F.col("q")).select("tile_id", (F.col("base") + F.col("local")).cast("long").alias("offset"), F.col("length").cast("long").alias("length"), F.lit(1).cast("long").alias("run_length"))


def directory_rows(entries: DataFrame, leaf_size: int = FIRST_LEAF) -> DataFrame:
    """entries with what a directory stores: id_delta, stored_offset (0: contiguous, else offset + 1), leaf."""
    w = Window.orderBy("tile_id")
    end = F.lag(F.col("offset") + F.col("length")).over(w)
    return entries.select(
        "*",
        (F.col("tile_id") - F.lag("tile_id", 1, 0).over(w)).alias("id_delta"),
        F.when(end == F.col("offset"), F.lit(0).cast("long")).otherwise(F.col("offset") + 1).alias("stored_offset"),
        F.floor((F.row_number().over(w) - 1) / F.lit(leaf_size)).cast("long").alias("leaf"),
    )


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def encode_directory(entries: list[tuple[int, int, int, int]]) -> bytes:
    """Of (tile_id, offset, length, run_length) in order of ids; none raises."""
    if not entries:
        raise ValueError("Directory entries cannot be empty.")
    ids, offsets, lengths, runs = zip(*entries, strict=True)
    deltas = [b - a for a, b in zip((0, *ids), ids)]
    ends = [None, *(o + n for o, n in zip(offsets, lengths, strict=True))]
    stored = [0 if e == o else o + 1 for e, o in zip(ends, offsets)]
    return gzip.compress(b"".join(map(varint, [len(ids), *deltas, *runs, *lengths, *stored])), mtime=0)


def decode_directory(raw: bytes) -> list[tuple[int, int, int, int]]:
    data, at = gzip.decompress(raw), 0

    def read() -> int:
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 127) << shift
            if b < 128:
                return n
            shift += 7

    count = read()
    deltas, runs, lengths, stored = ([read() for _ in range(count)] for _ in range(4))
    out, tid = [], 0
    for d, r, n, s in zip(deltas, runs, lengths, stored, strict=True):
        tid += d
        out.append((tid, out[-1][1] + out[-1][2] if s == 0 and out else s - 1, n, r))
    return out


def directories(entries: list[tuple[int, int, int, int]], limit: int = ROOT_LIMIT, leaf: int = FIRST_LEAF) -> tuple[bytes, bytes]:
    """(root, leaves): leaves of doubling size until the root fits."""
    root = encode_directory(entries)
    if len(root) < limit:
        return root, b""
    while True:
        leaves = [(entries[i][0], encode_directory(entries[i : i + leaf])) for i in range(0, len(entries), leaf)]
        at, tops = 0, []
        for tid, raw in leaves:
            tops.append((tid, at, len(raw), 0))
            at += len(raw)
        root = encode_directory(tops)
        if len(root) < limit:
            return root, b"".join(raw for _, raw in leaves)
        leaf *= 2


def encode_header(h: dict[str, int], bounds: tuple[float, float, float, float], zooms: tuple[int, int], fmt: str, clustered: bool = False) -> bytes:
    if fmt not in TILE_TYPES:
        raise ValueError(f"Unsupported raster format: {fmt}")
    e7 = lambda v: int(v * 10_000_000)
    centre = e7((bounds[0] + bounds[2]) / 2), e7((bounds[1] + bounds[3]) / 2)
    out = MAGIC + bytes([VERSION]) + struct.pack("<11Q", *(h[f] for f in FIELDS))
    out += struct.pack("<6B", clustered, GZIP, NO_COMPRESSION, TILE_TYPES[fmt], *zooms) + struct.pack("<4i", *map(e7, bounds)) + struct.pack("<B2i", zooms[0], *centre)
    if len(out) != HEADER:
        raise ValueError(f"Invalid header length: expected {HEADER}, got {len(out)}")
    return out


def decode_header(raw: bytes) -> dict:
    if raw[:7] != MAGIC or raw[7] != VERSION:
        raise ValueError("not a version 3 tile archive")
    out = dict(zip(FIELDS, struct.unpack("<11Q", raw[8:96]), strict=True))
    names = ["clustered", "internal_compression", "tile_compression", "tile_type", "min_zoom", "max_zoom", "min_lon_e7", "min_lat_e7", "max_lon_e7", "max_lat_e7", "center_zoom", "center_lon_e7", "center_lat_e7"]
    return out | dict(zip(names, struct.unpack("<6B4iB2i", raw[96:HEADER]), strict=True))


def read_archive(path: str) -> tuple[dict, dict, dict[int, bytes]]:
    """(header, metadata, tiles by id) of a small archive, for tests and inspection."""
    fs, p = pafs.FileSystem.from_uri(path)
    raw = fs.open_input_file(p).read()
    h = decode_header(raw)
    tiles, todo = {}, [raw[h["root_offset"] : h["root_offset"] + h["root_length"]]]
    while todo:
        for tid, at, n, run in decode_directory(todo.pop()):
            if run:
                tiles[tid] = raw[h["data_offset"] + at : h["data_offset"] + at + n]
            else:
                todo.append(raw[h["leaf_offset"] + at : h["leaf_offset"] + at + n])
    return h, json.loads(gzip.decompress(raw[h["metadata_offset"] : h["metadata_offset"] + h["metadata_length"]])), tiles


@dataclass
class _Part(WriterCommitMessage):
    path: str
    first: int
    count: int


class ArchiveSink(DataSource):
    """Format ``tile_archive`` for writing rows (tile_id, z, archive_z, data) sorted within range partitions.

    Options: path, and JSON ``archive`` with metadata, bounds (WGS84), format, zoom_offset.  Tasks stage tile
    data and entries in a folder beside the target, which all executors share; committing writes header,
    directories and metadata and streams the staged data behind them in the order of ids.
    """

    @classmethod
    def name(cls) -> str:
        return "tile_archive"

    def schema(self) -> str:
        return "tile_id long, z int, archive_z int, data binary"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _ArchiveWriter(dict(self.options))


class _ArchiveWriter(DataSourceWriter):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"] if "://" in options["path"] else "file://" + options["path"]
        self.stage, self.about = f"{self.path}.parts-{uuid.uuid4().hex}", json.loads(options.get("archive", "{}"))

    def write(self, iterator) -> WriterCommitMessage:
        fs, stage = pafs.FileSystem.from_uri(self.stage)
        fs.create_dir(stage, recursive=True)
        path, first, count, at = f"{stage}/{uuid.uuid4().hex}", -1, 0, 0
        with fs.open_output_stream(f"{path}.data") as data, fs.open_output_stream(f"{path}.entries") as entries:
            for r in iterator:
                body = bytes(r.data)
                data.write(body)
                entries.write(struct.pack("<4Q", r.tile_id, len(body), r.z, r.archive_z))
                first, count, at = r.tile_id if count == 0 else first, count + 1, at + len(body)
        return _Part(path, first, count)

    def _clear(self, fs, stage: str) -> None:
        if fs.get_file_info(stage).type != pafs.FileType.NotFound:
            fs.delete_dir(stage)

    def abort(self, messages) -> None:
        self._clear(*pafs.FileSystem.from_uri(self.stage))

    def commit(self, messages) -> None:
        fs, stage = pafs.FileSystem.from_uri(self.stage)
        parts = sorted((m for m in messages if m and m.count), key=lambda m: m.first)
        try:
            if not parts:
                raise ValueError("No tiles with data were rendered; nothing to write.")
            entries, zooms, offset = [], {}, 0
            for p in parts:
                for tid, n, z, az in struct.iter_unpack("<4Q", fs.open_input_file(f"{p.path}.entries").read()):
                    entries.append((tid, offset, n, 1))
                    zooms[z] = az
                    offset += n
            root, leaves = directories(entries)
            metadata = self.about.get("metadata", {}) | {"localZoomToPmtilesZoom": {str(z): a for z, a in sorted(zooms.items())}, "pmtilesZoomOffset": self.about.get("zoom_offset", 0)}
            meta = gzip.compress(json.dumps(metadata).encode(), mtime=0)
            sizes = [("root", root), ("metadata", meta), ("leaf", leaves)]
            h, at = {}, HEADER
            for name, raw in sizes:
                h |= {f"{name}_offset": at, f"{name}_length": len(raw)}
                at += len(raw)
            h |= {"data_offset": at, "data_length": offset, "addressed": len(entries), "entries": len(entries), "contents": len(entries)}
            target = pafs.FileSystem.from_uri(self.path)[1]
            with fs.open_output_stream(f"{target}.tmp") as out:
                out.write(encode_header(h, tuple(self.about.get("bounds", (-180.0, -90.0, 180.0, 90.0))), (min(zooms.values()), max(zooms.values())), self.about.get("format", "png")))
                out.write(root + meta + leaves)
                for p in parts:
                    with fs.open_input_stream(f"{p.path}.data") as data:
                        while block := data.read(1 << 20):
                            out.write(block)
            fs.move(f"{target}.tmp", target)
        finally:
            self._clear(fs, stage)


def write_archive(tiles: DataFrame, path: str, bounds: tuple[float, float, float, float], metadata: dict | None = None, fmt: str = "png") -> None:
    """tiles (z, x, y, has_data, data) as an archive; zooms move by the offset of all tiles, empty ones are skipped."""
    tiles.sparkSession.dataSource.register(ArchiveSink)
    placed = with_archive_zoom(tiles)
    offset = placed.select("zoom_offset").limit(1).collect()
    about = {"metadata": metadata or {}, "bounds": list(bounds), "format": fmt, "zoom_offset": offset[0][0] if offset else 0}
    rows = placed.where("has_data").select(tile_id(F.col("archive_z"), F.col("x"), F.col("y")).alias("tile_id"), F.col("z").cast("int").alias("z"), "archive_z", "data")
    rows = rows.repartitionByRange("tile_id").sortWithinPartitions("tile_id")
    rows.write.format("tile_archive").option("archive", json.dumps(about)).mode("append").save(path)


def write_tile_folder(tiles: DataFrame, folder: str, fmt: str = "png", size: int = 512, bands: int = 4) -> DataFrame:
    """tiles/{z}/{x}/{y}.{fmt} for every tile, empty ones too (as transparent pixels); returns (files)."""
    import numpy as np
    import pandas as pd

    from ..raster.render import encode_tile

    uri = folder if "://" in folder else "file://" + folder

    def run(frames):
        fs, root = pafs.FileSystem.from_uri(uri)
        blank = encode_tile(np.zeros((size, size, bands), np.uint8), fmt)
        for df in frames:
            for r in df.itertuples(index=False):
                d = f"{root}/tiles/{r.z}/{r.x}"
                fs.create_dir(d, recursive=True)
                with fs.open_output_stream(f"{d}/{r.y}.{fmt}") as f:
                    f.write(blank if r.data is None else bytes(r.data))
            yield pd.DataFrame({"n": [len(df)]})

    return tiles.select("z", "x", "y", "data").mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("files"))

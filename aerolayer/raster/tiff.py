"""GeoTIFF files: headers and windows by byte ranges, tiled writing with overviews.

Samples are unsigned integers of 8 or 16 bits or floats, plain or deflated, in strips or tiles, in classic
or large files; other codecs need libraries that are not here, and raise.  Files are opened by pyarrow's file systems, in
tasks: the driver sees neither headers nor pixels unless it is asked to.
"""

from __future__ import annotations

import math
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grid
from ..operators.spatial import boxes_that_intersect
from .render import encode_tile, encoder, resample

#: Fixed values of the format: struct code and size by field type; tags; sample formats; compressions.
FIELDS = {1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 5: ("II", 8), 6: ("b", 1), 8: ("h", 2), 9: ("i", 4), 11: ("f", 4), 12: ("d", 8), 13: ("I", 4), 16: ("Q", 8), 17: ("q", 8), 18: ("Q", 8)}
SUBFILE, WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIP_AT, SAMPLES, STRIP_ROWS, STRIP_SIZE, PLANAR, PREDICTOR, PALETTE = 254, 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317, 320
TILE_WIDTH, TILE_HEIGHT, TILE_AT, TILE_BYTES, EXTRA, FORMAT = 322, 323, 324, 325, 338, 339
SCALE, TIEPOINT, MATRIX, GEO_KEYS, GEO_TEXT, NODATA = 33550, 33922, 34264, 34735, 34737, 42113
SAMPLE_TYPES = {(1, 8): "u1", (1, 16): "u2", (1, 32): "u4", (2, 16): "i2", (3, 32): "f4", (3, 64): "f8"}
PLAIN, DEFLATE, OLD_DEFLATE = 1, 8, 32946


@dataclass
class Level:
    """A raster of a file: the full one, or an overview."""

    width: int
    height: int
    tile_width: int
    tile_height: int
    at: list[int]
    sizes: list[int]


@dataclass
class Header:
    bands: int
    dtype: str
    compression: int
    predictor: int
    planar: int
    order: str
    affine: list[float]
    crs: str | None
    nodata: float | None
    palette: dict[int, tuple[int, int, int]] | None
    levels: list[Level] = field(default_factory=list)

    @property
    def width(self) -> int:
        return self.levels[0].width

    @property
    def height(self) -> int:
        return self.levels[0].height


def _entries(f, at: int, order: str, large: bool) -> tuple[dict[int, list], int]:
    """The fields of a directory, and where the next one is."""
    head, entry, inline = ("Q", 20, 8) if large else ("H", 12, 4)
    f.seek(at)
    n = struct.unpack(order + head, f.read(struct.calcsize(head)))[0]
    raw = f.read(n * entry + inline)
    out = {}
    for i in range(n):
        tag, kind = struct.unpack_from(order + "HH", raw, i * entry)
        count = struct.unpack_from(order + ("Q" if large else "I"), raw, i * entry + 4)[0]
        if kind not in FIELDS:
            continue
        code, size = FIELDS[kind]
        body = raw[i * entry + entry - inline : i * entry + entry]
        if count * size > inline:
            f.seek(struct.unpack(order + ("Q" if large else "I"), body)[0])
            body = f.read(count * size)
        out[tag] = [body[:count].rstrip(b"\0").decode("latin-1")] if kind == 2 else list(struct.unpack(order + code * count, body[: count * size]))
    return out, struct.unpack_from(order + ("Q" if large else "I"), raw, n * entry)[0]


def _crs(e: dict[int, list]) -> str | None:
    keys = e.get(GEO_KEYS, [])
    held = {k: (where, n, v) for k, where, n, v in zip(*(keys[4 + i :: 4] for i in range(4)), strict=True)}
    for key in (3072, 2048):  # projected, then geographic
        if key in held and held[key][2] != 32767:
            return f"EPSG:{held[key][2]}"
    for key in (3073, 1026):  # citations
        if key in held:
            _, n, at = held[key]
            return e.get(GEO_TEXT, [""])[0][at : at + n].rstrip("|")
    return None


def read_header(f) -> Header:
    """The header of an open file; overviews count as levels, masks and other images do not."""
    f.seek(0)
    start = f.read(16)
    order = {b"II": "<", b"MM": ">"}.get(start[:2])
    if order is None or (version := struct.unpack_from(order + "H", start, 2)[0]) not in (42, 43):
        raise ValueError("not a TIFF file")
    large = version == 43
    at = struct.unpack_from(order + ("Q" if large else "I"), start, 8 if large else 4)[0]
    out = None
    while at:
        e, at = _entries(f, at, order, large)
        if out is not None and e.get(SUBFILE, [0])[0] != 1:
            continue
        width, height = e[WIDTH][0], e[HEIGHT][0]
        tiled = TILE_AT in e
        level = Level(width, height, e[TILE_WIDTH][0] if tiled else width, e[TILE_HEIGHT][0] if tiled else min(height, e.get(STRIP_ROWS, [height])[0]), e[TILE_AT if tiled else STRIP_AT], e[TILE_BYTES if tiled else STRIP_SIZE])
        if out is None:
            kind = (e.get(FORMAT, [1])[0], e.get(BITS, [1])[0])
            if kind not in SAMPLE_TYPES or e.get(COMPRESSION, [1])[0] not in (PLAIN, DEFLATE, OLD_DEFLATE):
                raise ValueError(f"unsupported samples {kind} or compression {e.get(COMPRESSION)}")
            if MATRIX in e:
                m = e[MATRIX]
                affine = [m[3], m[0], m[1], m[7], m[4], m[5]]
            elif SCALE in e and TIEPOINT in e:
                (sx, sy), (i, j, _, x, y, _) = e[SCALE][:2], e[TIEPOINT][:6]
                affine = [x - i * sx, sx, 0.0, y + j * sy, 0.0, -sy]
            else:
                affine = [0.0, 1.0, 0.0, 0.0, 0.0, 1.0]
            colours = e.get(PALETTE)
            n = len(colours) // 3 if colours else 0
            palette = {i: tuple(colours[i + c * n] >> 8 for c in range(3)) for i in range(n)} if colours else None
            nodata = float(e[NODATA][0]) if e.get(NODATA, [""])[0].strip() else None
            out = Header(e.get(SAMPLES, [1])[0], SAMPLE_TYPES[kind], e.get(COMPRESSION, [1])[0], e.get(PREDICTOR, [1])[0], e.get(PLANAR, [1])[0], order, affine, _crs(e), nodata, palette)
        out.levels.append(level)
    if out is None:
        raise ValueError("a TIFF file without images")
    return out


def _block(f, h: Header, level: Level, k: int, bands: int) -> np.ndarray:
    """(rows, cols, bands) of tile or strip k."""
    if not level.sizes[k]:
        return np.zeros((level.tile_height, level.tile_width, bands), h.dtype)
    f.seek(level.at[k])
    raw = f.read(level.sizes[k])
    raw = raw if h.compression == PLAIN else zlib.decompress(raw)
    a = np.frombuffer(raw, np.dtype(h.dtype).newbyteorder(h.order))
    a = a.reshape(-1, level.tile_width, bands).astype(h.dtype)
    return np.cumsum(a, axis=1, dtype=a.dtype) if h.predictor == 2 else a


def read_window(f, h: Header, row: int, col: int, rows: int, cols: int, level: int = 0) -> np.ndarray:
    """(bands, rows, cols) of a window that lies within a level: only the tiles or strips that it meets are read."""
    at = h.levels[level]
    across, down = -(-at.width // at.tile_width), -(-at.height // at.tile_height)
    out = np.zeros((rows, cols, h.bands), h.dtype)
    each = h.bands if h.planar == 1 else 1
    for ty in range(row // at.tile_height, -(-(row + rows) // at.tile_height)):
        for tx in range(col // at.tile_width, -(-(col + cols) // at.tile_width)):
            y0, x0 = ty * at.tile_height, tx * at.tile_width
            a, b = max(row, y0), max(col, x0)
            for plane in range(h.bands // each):
                block = _block(f, h, at, plane * across * down + ty * across + tx, each)
                c, d = min(row + rows, y0 + len(block)), min(col + cols, x0 + at.tile_width)
                out[a - row : c - row, b - col : d - col, plane * each : plane * each + each] = block[a - y0 : c - y0, b - x0 : d - x0]
    return np.moveaxis(out, 2, 0)


def _geo_fields(affine: list[float], crs: str | None) -> dict[int, tuple[int, list]]:
    out: dict[int, tuple[int, list]] = {}
    if affine[2] or affine[4]:
        out[MATRIX] = (12, [affine[1], affine[2], 0.0, affine[0], affine[4], affine[5], 0.0, affine[3], 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0])
    else:
        out[SCALE], out[TIEPOINT] = (12, [affine[1], -affine[5], 0.0]), (12, [0.0, 0.0, 0.0, affine[0], affine[3], 0.0])
    if crs and crs.upper().startswith("EPSG:"):
        code = int(crs[5:])
        plain = code == 4326
        out[GEO_KEYS] = (3, [1, 1, 0, 3, 1024, 0, 1, 2 if plain else 1, 1025, 0, 1, 1, 2048 if plain else 3072, 0, 1, code])
    elif crs:
        out[GEO_KEYS] = (3, [1, 1, 0, 4, 1024, 0, 1, 1, 1025, 0, 1, 1, 3072, 0, 1, 32767, 3073, GEO_TEXT, len(crs) + 1, 0])
        out[GEO_TEXT] = (2, [crs + "|"])
    return out


def tiff_bytes(a: np.ndarray, affine: list[float], crs: str | None = None, nodata: float | None = None, palette: dict[int, tuple] | None = None, tile: int = 256, overviews: bool = True, alpha: bool = False, compress: bool = True) -> bytes:
    """A tiled file of (bands, rows, cols): directories first, then overviews and pixels, so that a reader finds what it needs by ranges.

    Overviews halve the raster by nearest pixels until one tile holds it.  ``alpha`` marks the last band as such.
    """
    a = a if a.ndim == 3 else a[None]
    kind = {v: k for k, v in SAMPLE_TYPES.items()}[a.dtype.str[1:]]
    images = [a]
    while overviews and max(images[-1].shape[1:]) > tile:
        images.append(images[-1][:, ::2, ::2])
    bodies, fields = [], []
    for i, image in enumerate(images):
        bands, height, width = image.shape
        blocks = []
        for y in range(0, height, tile):
            for x in range(0, width, tile):
                block = np.zeros((tile, tile, bands), a.dtype.newbyteorder("<"))
                part = np.moveaxis(image[:, y : y + tile, x : x + tile], 0, 2)
                block[: part.shape[0], : part.shape[1]] = part
                blocks.append(zlib.compress(block.tobytes(), 6) if compress else block.tobytes())
        bodies.append(blocks)
        e = {SUBFILE: (4, [int(i > 0)]), WIDTH: (4, [width]), HEIGHT: (4, [height]), BITS: (3, [kind[1]] * bands), COMPRESSION: (3, [DEFLATE if compress else PLAIN]), PHOTOMETRIC: (3, [3 if palette else 2 if bands - alpha == 3 else 1]), SAMPLES: (3, [bands]), PLANAR: (3, [1]), FORMAT: (3, [kind[0]] * bands), TILE_WIDTH: (4, [tile]), TILE_HEIGHT: (4, [tile]), TILE_AT: (4, [0] * len(blocks)), TILE_BYTES: (4, [len(b) for b in blocks])}
        if alpha:
            e[EXTRA] = (3, [2])
        if palette:
            e[PALETTE] = (3, [palette.get(j, (0, 0, 0))[c] * 257 for c in range(3) for j in range(1 << kind[1])])
        if i == 0:
            e |= _geo_fields(affine, crs)
        if nodata is not None:
            e[NODATA] = (2, [f"{nodata:g}"])
        fields.append(e)

    def size(kind_: int, values: list) -> int:
        return len(values[0]) + 1 if kind_ == 2 else FIELDS[kind_][1] * len(values)

    starts, at = [], 8
    for e in fields:
        starts.append(at)
        at += 2 + 12 * len(e) + 4 + sum(-(-size(*v) // 2) * 2 for v in e.values() if size(*v) > 4)
    for e, blocks in reversed(list(zip(fields, bodies, strict=True))):
        for j, b in enumerate(blocks):
            e[TILE_AT][1][j] = at
            at += len(b)
    if at >= 1 << 32:
        raise ValueError("a raster of over 4 GB is written as several files")
    out = bytearray(struct.pack("<2sHI", b"II", 42, 8))
    for i, e in enumerate(fields):
        far, extra = starts[i] + 2 + 12 * len(e) + 4, b""
        out += struct.pack("<H", len(e))
        for tag, (kind_, values) in sorted(e.items()):
            body = values[0].encode("latin-1") + b"\0" if kind_ == 2 else struct.pack("<" + FIELDS[kind_][0] * len(values), *values)
            count = len(body) if kind_ == 2 else len(values)
            out += struct.pack("<HHI", tag, kind_, count)
            if len(body) <= 4:
                out += body.ljust(4, b"\0")
            else:
                out += struct.pack("<I", far + len(extra))
                extra += body + b"\0" * (len(body) % 2)
        out += struct.pack("<I", starts[i + 1] if i + 1 < len(fields) else 0) + extra
    return bytes(out) + b"".join(b for blocks in reversed(bodies) for b in blocks)


def uri_of(path: str) -> str:
    return path if "://" in path else "file://" + path if path.startswith("/") else path


def opened(path: str):
    fs, p = pafs.FileSystem.from_uri(uri_of(path))
    return fs.open_input_file(p)


def read_rasters(spark: SparkSession, paths: list[str] | DataFrame, checked: bool = True) -> DataFrame:
    """(path, ordinal, width, height, bands, dtype, affine, crs, nodata, bounds) of raster files, in order.

    Checked: rasters of 1 to 4 bands with a coordinate system; others raise.  Headers are read in tasks.
    """
    rows = paths if isinstance(paths, DataFrame) else spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "ordinal int, path string")

    def run(frames):
        import pandas as pd

        for df in frames:
            out = []
            for r in df.itertuples(index=False):
                with opened(r.path) as f:
                    h = read_header(f)
                if checked and h.bands not in (1, 2, 3, 4):
                    raise ValueError(f"rasters of 1 to 4 bands are supported, not {h.bands}: {r.path}")
                if checked and not h.crs:
                    raise ValueError(f"raster without a projection: {r.path}")
                out.append((r.path, r.ordinal, h.width, h.height, h.bands, h.dtype, h.affine, h.crs, h.nodata))
            yield pd.DataFrame(out, columns=["path", "ordinal", "width", "height", "bands", "dtype", "affine", "crs", "nodata"])

    read = rows.select("ordinal", "path").mapInPandas(run, "path string, ordinal int, width int, height int, bands int, dtype string, affine array<double>, crs string, nodata double")
    return read.withColumn("bounds", grid.affine_bounds(F.col("affine"), F.col("width").cast("double"), F.col("height").cast("double")))


def read_blocks(rasters: DataFrame, size: int = 512) -> DataFrame:
    """rasters with a row for each block: block_row, block_col, rows, cols, pixels (band by band), affine of the block."""
    span = lambda n: F.explode(F.sequence(F.lit(0), F.floor((F.col(n) - 1) / size).cast("int")))
    blocks = rasters.withColumn("block_row", span("height")).withColumn("block_col", span("width"))

    def run(frames):
        for df in frames:
            made = []
            for r in df.itertuples(index=False):
                with opened(r.path) as f:
                    h = read_header(f)
                    top, left = r.block_row * size, r.block_col * size
                    a = read_window(f, h, top, left, min(size, h.height - top), min(size, h.width - left))
                g = list(r.affine)
                made.append((a.shape[1], a.shape[2], a.tobytes(), [g[0] + left * g[1] + top * g[2], g[1], g[2], g[3] + left * g[4] + top * g[5], g[4], g[5]]))
            df["rows"], df["cols"], df["pixels"], df["affine"] = zip(*made, strict=True) if made else ([], [], [], [])
            yield df[["path", "ordinal", "block_row", "block_col", "bands", "dtype", "rows", "cols", "pixels", "affine", "nodata"]]

    schema = "path string, ordinal int, block_row int, block_col int, bands int, dtype string, rows int, cols int, pixels binary, affine array<double>, nodata double"
    return blocks.mapInPandas(run, schema)


def write_rasters(rasters: DataFrame, folder: str, suffix: str = ".tif", tile: int = 256, compress: bool = True) -> DataFrame:
    """(path, bytes) of files written, one for each row (name, bands, rows, cols, affine, pixels, crs, nodata); eager.

    pixels are uint8, band by band; two and four bands end in alpha.  A file is written under another name and moved.
    """
    uri = uri_of(folder)

    def run(frames):
        import pandas as pd

        fs, root = pafs.FileSystem.from_uri(uri)
        fs.create_dir(root, recursive=True)
        for df in frames:
            out = []
            for r in df.itertuples(index=False):
                a = np.frombuffer(r.pixels, np.uint8).reshape(r.bands, r.rows, r.cols)
                body = tiff_bytes(a, list(r.affine), r.crs, None if pd.isna(r.nodata) else r.nodata, tile=tile, alpha=r.bands in (2, 4), compress=compress)
                path = f"{root}/{r.name}{suffix}"
                with fs.open_output_stream(path + ".tmp") as f:
                    f.write(body)
                fs.move(path + ".tmp", path)
                out.append((path, len(body)))
            yield pd.DataFrame(out, columns=["path", "bytes"])

    rows = rasters.select("name", "bands", "rows", "cols", "affine", "pixels", "crs", F.col("nodata").cast("double").alias("nodata"))
    done = rows.mapInPandas(run, "path string, bytes long").toArrow()  # a line for each file
    return rasters.sparkSession.createDataFrame(done)


def vrt_xml(rasters: list[dict], path: str) -> str:
    """A virtual mosaic of rasters (path, width, height, bands, dtype, affine, crs, nodata), later ones on top; sources below its folder by relative paths."""
    from xml.sax.saxutils import escape

    if not rasters:
        raise ValueError("a mosaic needs a raster")
    kinds = {"u1": "Byte", "u2": "UInt16", "i2": "Int16", "u4": "UInt32", "f4": "Float32", "f8": "Float64"}
    sx, sy = min(r["affine"][1] for r in rasters), max(r["affine"][5] for r in rasters)
    left, top = min(r["affine"][0] for r in rasters), max(r["affine"][3] for r in rasters)
    right = max(r["affine"][0] + r["width"] * r["affine"][1] for r in rasters)
    bottom = min(r["affine"][3] + r["height"] * r["affine"][5] for r in rasters)
    folder = path.rpartition("/")[0] + "/"
    out = [f'<VRTDataset rasterXSize="{math.ceil((right - left) / sx - 1e-9)}" rasterYSize="{math.ceil((bottom - top) / sy - 1e-9)}">', f"<SRS>{escape(rasters[0]['crs'] or '')}</SRS>", f"<GeoTransform>{left!r}, {sx!r}, 0.0, {top!r}, 0.0, {sy!r}</GeoTransform>"]
    for band in range(1, rasters[0]["bands"] + 1):
        out.append(f'<VRTRasterBand dataType="{kinds[rasters[0]["dtype"]]}" band="{band}">')
        for r in rasters:
            below = r["path"].startswith(folder)
            g = r["affine"]
            tag = "ComplexSource" if r["nodata"] is not None else "SimpleSource"
            out.append(f'<{tag}><SourceFilename relativeToVRT="{int(below)}">{escape(r["path"].removeprefix(folder) if below else r["path"])}</SourceFilename><SourceBand>{band}</SourceBand><SrcRect xOff="0" yOff="0" xSize="{r["width"]}" ySize="{r["height"]}"/>')
            out.append(f'<DstRect xOff="{(g[0] - left) / sx!r}" yOff="{(g[3] - top) / sy!r}" xSize="{r["width"] * g[1] / sx!r}" ySize="{r["height"] * g[5] / sy!r}"/>' + (f"<NODATA>{r['nodata']:g}</NODATA>" if r["nodata"] is not None else "") + f"</{tag}>")
        out.append("</VRTRasterBand>")
    return "\n".join([*out, "</VRTDataset>", ""])


def write_vrt(rasters: DataFrame, path: str) -> None:
    """rasters (see read_rasters), in the order of ``ordinal``, as one virtual mosaic: a line for each band of each file."""
    rows = [r.asDict(recursive=True) for r in rasters.orderBy("ordinal").toLocalIterator()]
    fs, p = pafs.FileSystem.from_uri(uri_of(path))
    fs.create_dir(p.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(p) as f:
        f.write(vrt_xml(rows, p).encode())


def drawn(f, h: Header, box: dict, size: int, nodata: float | None) -> tuple[np.ndarray, np.ndarray]:
    """size x size samples of a file over a box in its own coordinates, from the coarsest level that is fine enough, and where they are valid."""
    g = h.affine
    k = 0
    while k + 1 < len(h.levels) and h.width / h.levels[k + 1].width * g[1] <= (box["max_x"] - box["min_x"]) / size * 1.0001:
        k += 1
    level = h.levels[k]
    sx, sy = g[1] * h.width / level.width, g[5] * h.height / level.height
    window = [(box["min_x"] - g[0]) / sx, (box["max_y"] - g[3]) / sy, (box["max_x"] - g[0]) / sx, (box["min_y"] - g[3]) / sy]
    margin = 4 + math.ceil(2 * (window[2] - window[0]) / size)
    left, top = max(0, math.floor(window[0]) - margin), max(0, math.floor(window[1]) - margin)
    right, bottom = min(level.width, math.ceil(window[2]) + margin), min(level.height, math.ceil(window[3]) + margin)
    if right <= left or bottom <= top:
        return np.zeros((h.bands, size, size), np.uint8), np.zeros((size, size), bool)
    a = read_window(f, h, top, left, bottom - top, right - left, k)
    valid = np.ones(a.shape[1:], bool) if nodata is None else (a != nodata).any(axis=0)
    return resample(a, valid, (window[0] - left, window[1] - top, window[2] - left, window[3] - top), size)


def render_files(specs: DataFrame, rasters: DataFrame, cell: float, fmt: str = "png", quality: int = 30, size: int = grid.TILE_SIZE) -> DataFrame:
    """(z, x, y, has_data, data) of tile specs (z, x, y, tile box) over raster files (see read_rasters) that meet them.

    Tiles find files by their boxes, through grid cells of ``cell`` units; files overlay each other in the order
    of ``ordinal``, later ones on top where they show.  Each task reads the windows it needs by byte ranges.
    """
    encoder(fmt)
    wanted = specs.select("z", "x", "y", "tile").dropDuplicates(["z", "x", "y"])
    files = rasters.select("ordinal", "path", "bounds", "nodata")
    pairs = boxes_that_intersect(wanted, files, "tile", "bounds", cell)
    held = pairs.groupBy("z", "x", "y").agg(F.first("tile").alias("tile"), F.array_sort(F.collect_list(F.struct("ordinal", "path", "nodata"))).alias("files"))

    def run(frames):
        import pandas as pd

        for df in frames:
            out = []
            for r in df.itertuples(index=False):
                tile = np.zeros((size, size, 4), np.uint8)
                grey = True
                for s in r.files:
                    with opened(s["path"]) as f:
                        h = read_header(f)
                        nodata = s["nodata"]
                        a, valid = drawn(f, h, r.tile, size, None if nodata is None or pd.isna(nodata) else nodata)
                    alpha = np.where(valid, a[-1] if h.bands in (2, 4) else 255, 0)
                    show = alpha > 0
                    tile[show] = np.concatenate((np.moveaxis(a[:1].repeat(3, axis=0) if h.bands < 3 else a[:3], 0, 2), alpha[..., None]), axis=2)[show]
                    grey &= h.bands < 3
                shows = bool((tile[..., 3] > 0).any())
                out.append((r.z, r.x, r.y, shows, encode_tile(tile[..., [0, 3]] if grey else tile, fmt, quality) if shows else None))
            yield pd.DataFrame(out, columns=["z", "x", "y", "has_data", "data"])

    found = held.mapInPandas(run, "z int, x long, y long, has_data boolean, data binary")
    rest = wanted.join(held, ["z", "x", "y"], "left_anti").select(F.col("z").cast("int").alias("z"), "x", "y", F.lit(False).alias("has_data"), F.lit(None).cast("binary").alias("data"))
    return found.unionByName(rest)


def write_mask_files(masks: DataFrame, folder: str) -> int:
    """A black and white PNG and a JSON of corner pixels for each row (name, rows, cols, pixels: 0 or 1, row by row); returns their number."""
    import json

    from .kernels import corner_points
    from .render import encode_png

    uri = uri_of(folder)

    def run(frames):
        import pandas as pd

        fs, root = pafs.FileSystem.from_uri(uri)
        fs.create_dir(root, recursive=True)
        for df in frames:
            for r in df.itertuples(index=False):
                on = np.frombuffer(r.pixels, np.uint8).reshape(r.rows, r.cols) > 0
                corners = {k: {"row": y, "col": x} for k, (y, x) in corner_points(on).items()}
                for name, body in ((f"{r.name}.png", encode_png(on[..., None].astype(np.uint8) * 255)), (f"{r.name}.corners.json", (json.dumps(corners, indent=2) + "\n").encode())):
                    with fs.open_output_stream(f"{root}/{name}") as f:
                        f.write(body)
            yield pd.DataFrame({"n": [len(df)]})

    return masks.select("name", "rows", "cols", "pixels").mapInPandas(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


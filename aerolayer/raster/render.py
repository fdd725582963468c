"""Tiles from rasters: block reads, cubic resampling, masks, PNG."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grid import TILE_SIZE

#: Encoders by format: other formats are plugged in with ``register_encoder``.
ENCODERS: dict = {}
#: Fixed value: pixel modes of PNG by bands.
PNG_MODES = {1: 0, 2: 4, 3: 2, 4: 6}


def encode_png(pixels: np.ndarray, quality: int = 0) -> bytes:
    """Lossless PNG of height x width x bands samples."""
    h, w, bands = pixels.shape
    rows = np.zeros((h, w * bands + 1), np.uint8)
    rows[:, 1:] = pixels.reshape(h, -1)
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", w, h, 8, PNG_MODES[bands], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def decode_png(data: bytes) -> np.ndarray:
    """Of images that encode_png made."""
    at, body = 8, b""
    while at < len(data):
        n, kind = struct.unpack(">I", data[at : at + 4])[0], data[at + 4 : at + 8]
        if kind == b"IHDR":
            w, h, _, mode = struct.unpack(">IIBB", data[at + 8 : at + 18])
        elif kind == b"IDAT":
            body += data[at + 8 : at + 8 + n]
        at += 12 + n
    bands = {v: k for k, v in PNG_MODES.items()}[mode]
    return np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, -1)[:, 1:].reshape(h, w, bands)


ENCODERS["png"] = encode_png


def register_encoder(name: str, encode) -> None:
    """encode(pixels, quality) -> bytes."""
    ENCODERS[name] = encode


def encoder(name: str):
    """The encoder of a format; raises if support for it is missing."""
    if name not in ENCODERS:
        raise RuntimeError(f"{name} support is missing; plug in an encoder with register_encoder")
    return ENCODERS[name]


def encode_tile(pixels: np.ndarray, fmt: str = "png", quality: int = 30) -> bytes:
    if pixels.ndim != 3 or pixels.shape[2] not in (2, 3, 4):
        raise ValueError("Rendered tile array must be HxWx2, HxWx3, or HxWx4 uint8 data.")
    return encoder(fmt)(np.ascontiguousarray(pixels, np.uint8), quality)


def cubic(t: np.ndarray) -> np.ndarray:
    """Weights of four neighbours for a fraction t (Catmull-Rom)."""
    d = np.abs(np.stack([t + 1, t, 1 - t, 2 - t], axis=-1))
    return np.where(d <= 1, 1.5 * d**3 - 2.5 * d**2 + 1, np.where(d < 2, -0.5 * d**3 + 2.5 * d**2 - 4 * d + 2, 0))


def resample(bands: np.ndarray, valid: np.ndarray, window: tuple[float, float, float, float], size: int) -> tuple[np.ndarray, np.ndarray]:
    """size x size samples of bands (n, rows, cols) over a window (left, top, right, bottom) in pixels.

    Cubic, with the kernel widened when it shrinks; weights of invalid pixels count nothing.  Returns the
    samples and where their nearest pixel is valid.
    """
    h, w = valid.shape

    def axis(a: float, b: float, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        step = (b - a) / size
        centre = a + (np.arange(size) + 0.5) * step
        wide = max(1.0, step)
        taps = int(np.ceil(2 * wide)) * 2
        first = np.floor(centre - 0.5).astype(int) - taps // 2 + 1
        i = first[:, None] + np.arange(taps)
        d = np.abs((i + 0.5 - centre[:, None]) / wide)
        k = np.where(d <= 1, 1.5 * d**3 - 2.5 * d**2 + 1, np.where(d < 2, -0.5 * d**3 + 2.5 * d**2 - 4 * d + 2, 0))
        k = np.where((i >= 0) & (i < n), k, 0)
        return np.clip(i, 0, n - 1), k, np.floor(centre).astype(int)

    ri, rk, rn = axis(window[1], window[3], h)
    ci, ck, cn = axis(window[0], window[2], w)
    inside = ((rn >= 0) & (rn < h))[:, None] & ((cn >= 0) & (cn < w))[None, :]
    near = inside & valid[np.clip(rn, 0, h - 1)][:, np.clip(cn, 0, w - 1)]
    rows, cols = np.zeros((size, h)), np.zeros((size, w))
    np.add.at(rows, (np.arange(size)[:, None], ri), rk)
    np.add.at(cols, (np.arange(size)[:, None], ci), ck)
    weight = rows @ valid.astype(float) @ cols.T
    out = np.stack([rows @ (b * valid) @ cols.T for b in bands.astype(float)])
    out = np.where(np.abs(weight) > 1e-6, out / np.where(np.abs(weight) > 1e-6, weight, 1), 0)
    return np.clip(np.rint(out), 0, 255).astype(np.uint8), near


def render(bands: np.ndarray, valid: np.ndarray, window: tuple[float, float, float, float], size: int = TILE_SIZE) -> tuple[np.ndarray, bool]:
    """A tile of 1 to 4 bands as size x size x 2 (luminance, alpha) or x 4, and whether any pixel shows.

    The second of two bands and the fourth of four are alpha; otherwise pixels are opaque; invalid ones never.
    """
    n = len(bands)
    if n not in (1, 2, 3, 4):
        raise ValueError(f"rasters of 1 to 4 bands are supported, not {n}")
    out, near = resample(bands, valid, window, size)
    alpha = np.where(near, out[-1] if n in (2, 4) else 255, 0).astype(np.uint8)
    return np.stack([*(out[:1] if n < 3 else out[:3]), alpha], axis=-1), bool((alpha > 0).any())


def render_tiles(specs: DataFrame, rasters: DataFrame, key: str, fmt: str = "png", quality: int = 30, size: int = TILE_SIZE) -> DataFrame:
    """(key, z, x, y, has_data, data) of tile specs (key, z, x, y, tile box) over rasters.

    rasters: key, bands, rows, cols, affine (6 doubles, no rotation), pixels (uint8, band by band), nodata
    (null: none).  Each spec meets its raster by key; a raster too large for a row is given as blocks with
    keys and affines of their own.  Empty tiles have has_data false and no data.
    """
    encoder(fmt)

    def run(frames):
        for df in frames:
            out = []
            for r in df.itertuples(index=False):
                a = list(r.affine)
                bands = np.frombuffer(r.pixels, np.uint8).reshape(r.bands, r.rows, r.cols)
                valid = np.ones(bands.shape[1:], bool) if r.nodata is None or pd.isna(r.nodata) else (bands != r.nodata).all(axis=0)
                t = r.tile
                window = ((t["min_x"] - a[0]) / a[1], (t["max_y"] - a[3]) / a[5], (t["max_x"] - a[0]) / a[1], (t["min_y"] - a[3]) / a[5])
                tile, shows = render(bands, valid, window, size)
                out.append((getattr(r, key), r.z, r.x, r.y, shows, encode_tile(tile, fmt, quality) if shows else None))
            yield pd.DataFrame(out, columns=[key, "z", "x", "y", "has_data", "data"])

    kind = dict(specs.dtypes)[key]
    rows = specs.select(key, "z", "x", "y", "tile").join(rasters.select(key, "bands", "rows", "cols", "affine", "pixels", "nodata"), key)
    return rows.mapInPandas(run, f"{key} {kind}, z int, x long, y long, has_data boolean, data binary")


def pack(pixels: DataFrame, keys: list[str], band: str = "band", value: str = "v") -> DataFrame:
    """(keys, bands, rows, cols, pixels) of long-form uint8 samples, band by band, row-major."""
    cell = F.array_sort(F.collect_list(F.struct(band, "row", "col", F.col(value).cast("int").alias("v"))))
    rows = pixels.groupBy(*keys).agg((F.max(band) + 1).alias("bands"), (F.max("row") + 1).alias("rows"), (F.max("col") + 1).alias("cols"), cell.alias("c"))
    as_bytes = F.unhex(F.array_join(F.transform("c", lambda s: F.lpad(F.hex(s["v"]), 2, "0")), ""))
    return rows.withColumn("pixels", as_bytes).drop("c")

"""Raster files: round trips, windows, overviews, foreign layouts, mosaics."""

import io
import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolayer.functions import grid
from aerolayer.raster import render, tiff

AFFINE = [1000.0, 10.0, 0.0, 2000.0, 0.0, -10.0]


@pytest.mark.parametrize("kind", ["u1", "u2", "i2", "f4", "f8"])
def test_round_trip_and_windows(kind):
    rng = np.random.default_rng(1)
    a = (rng.random((3, 130, 75)) * 200).astype(kind)
    for compress in (True, False):
        body = tiff.tiff_bytes(a, AFFINE, "EPSG:4326", nodata=7, tile=32, compress=compress)
        f = io.BytesIO(body)
        h = tiff.read_header(f)
        assert (h.bands, h.height, h.width, h.dtype, h.affine, h.crs, h.nodata) == (3, 130, 75, kind, AFFINE, "EPSG:4326", 7.0)
        assert (tiff.read_window(f, h, 0, 0, 130, 75) == a).all()
        assert (tiff.read_window(f, h, 30, 17, 70, 50) == a[:, 30:100, 17:67]).all()
        assert [(v.height, v.width) for v in h.levels] == [(130, 75), (65, 38), (33, 19), (17, 10)]
        assert (tiff.read_window(f, h, 0, 0, 65, 38, 1) == a[:, ::2, ::2]).all()


def test_palettes_rotation_and_names():
    a = np.arange(12, dtype=np.uint8).reshape(3, 4)
    f = io.BytesIO(tiff.tiff_bytes(a, [0.0, 2.0, 0.5, 1.0, 0.25, -2.0], "ESRI:102009", palette={0: (1, 2, 3), 5: (250, 0, 9)}))
    h = tiff.read_header(f)
    assert h.palette[5] == (250, 0, 9) and h.palette[1] == (0, 0, 0) and h.crs == "ESRI:102009" and h.affine == [0.0, 2.0, 0.5, 1.0, 0.25, -2.0]
    with pytest.raises(ValueError):
        tiff.read_header(io.BytesIO(b"PNG, not this"))


def test_strips_other_byte_order_planes_and_predictor():
    a = np.random.default_rng(2).integers(0, 60000, (2, 5, 6)).astype(np.uint16)
    strips = []
    for plane in a:
        for y in (0, 2, 4):
            rows = plane[y : y + 2].astype(np.int64)
            rows[:, 1:] = rows[:, 1:] - plane[y : y + 2, :-1]
            strips.append(zlib.compress((rows % 65536).astype(">u2").tobytes()))
    entries = {256: (3, [6]), 257: (3, [5]), 258: (3, [16, 16]), 259: (3, [8]), 277: (3, [2]), 278: (3, [2]), 284: (3, [2]), 317: (3, [2]), 339: (3, [1, 1])}
    at = 8
    offsets = []
    for s in strips:
        offsets.append(at)
        at += len(s)
    entries |= {273: (4, offsets), 279: (4, [len(s) for s in strips])}
    body, extra, far = struct.pack(">2sHI", b"MM", 42, at) + b"".join(strips), b"", at + 2 + 12 * len(entries) + 4
    body += struct.pack(">H", len(entries))
    for tag, (kind, values) in sorted(entries.items()):
        raw = struct.pack(">" + {3: "H", 4: "I"}[kind] * len(values), *values)
        body += struct.pack(">HHI", tag, kind, len(values)) + (raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack(">I", far + len(extra)))
        extra += raw if len(raw) > 4 else b""
    f = io.BytesIO(body + struct.pack(">I", 0) + extra)
    h = tiff.read_header(f)
    assert (tiff.read_window(f, h, 0, 0, 5, 6) == a).all() and (tiff.read_window(f, h, 1, 2, 3, 3) == a[:, 1:4, 2:5]).all()


def rasters(spark, folder, made, tile=32):
    rows = [(name, a.shape[0], a.shape[1], a.shape[2], g, bytearray(a.tobytes()), "ESRI:102009", nodata) for name, a, g, nodata in made]
    df = spark.createDataFrame(rows, "name string, bands int, rows int, cols int, affine array<double>, pixels binary, crs string, nodata double")
    return [r.path for r in tiff.write_rasters(df, str(folder), tile=tile).orderBy("path").collect()]


def test_tiles_over_several_files(spark, tmp_path):
    rng = np.random.default_rng(3)
    one, two = rng.integers(1, 255, (1, 64, 64)).astype(np.uint8), rng.integers(1, 255, (3, 64, 64)).astype(np.uint8)
    two[:, :20] = 0  # no data: the raster below shows
    paths = rasters(spark, tmp_path, [("a", one, [0.0, 10.0, 0.0, 640.0, 0.0, -10.0], None), ("b", two, [320.0, 10.0, 0.0, 640.0, 0.0, -10.0], 0.0)], tile=64)
    files = tiff.read_rasters(spark, paths)
    assert [(r.width, r.bands, r.bounds.max_x) for r in files.orderBy("ordinal").collect()] == [(64, 1, 640.0), (64, 3, 960.0)]
    box = spark.range(1).select(grid.box(0, 0, 1280, 640).alias("b"))
    specs = grid.tile_specs(box, "b", [20.0], tile_size=16)
    tiles = {(r.x, r.y): r for r in tiff.render_files(specs, files, 500.0, size=16).collect()}
    assert len(tiles) == 4 * 2 and not tiles[3, 0].has_data and not tiles[3, 1].has_data
    full = lambda a, g: lambda x, y: render.resample(a, (a != 0).any(axis=0) if len(a) == 3 else np.ones((64, 64), bool), ((x * 320 - g) / 10, y * 32, (x * 320 + 320 - g) / 10, y * 32 + 32), 16)
    for (x, y), t in tiles.items():
        if not t.has_data:
            continue
        below, seen = full(one, 0)(x, y)
        above, on = full(two, 320)(x, y)
        got = render.decode_png(t.data)
        if got.shape[2] == 2:
            assert not on.any() and (got[..., 0][seen] == below[0][seen]).all()
        else:
            want = np.where(on, above, np.repeat(below, 3, axis=0))
            assert (np.moveaxis(got[..., :3], 2, 0)[:, seen | on] == want[:, seen | on]).all() and ((got[..., 3] > 0) == (seen | on)).all()


def test_blocks_mosaics_and_masks(spark, tmp_path):
    a = np.random.default_rng(4).integers(0, 255, (2, 70, 50)).astype(np.uint8)
    paths = rasters(spark, tmp_path, [("a", a, AFFINE, None), ("b", a[:1, :5, :9], [1500.0, 10.0, 0.0, 2000.0, 0.0, -10.0], 3.0)])
    files = tiff.read_rasters(spark, paths)
    out = np.zeros_like(a)
    for r in tiff.read_blocks(files.where("ordinal = 0"), 32).collect():
        out[:, r.block_row * 32 :, r.block_col * 32 :][:, : r.rows, : r.cols] = np.frombuffer(r.pixels, np.uint8).reshape(r.bands, r.rows, r.cols)
        assert list(r.affine) == [1000.0 + 320 * r.block_col, 10.0, 0.0, 2000.0 - 320 * r.block_row, 0.0, -10.0]
    assert (out == a).all()
    tiff.write_vrt(files, f"{tmp_path}/all.vrt")
    text = open(f"{tmp_path}/all.vrt").read()
    assert 'rasterXSize="59" rasterYSize="70"' in text and text.count('relativeToVRT="1">a.tif<') == 2 and "<NODATA>3</NODATA>" in text
    bad = rasters(spark, tmp_path / "five", [("x", np.zeros((5, 4, 4), np.uint8), AFFINE, None)])
    with pytest.raises(Exception, match="1 to 4 bands"):
        tiff.read_rasters(spark, bad).collect()
    on = np.zeros((4, 6), np.uint8)
    on[1:3, 2:5] = 1
    assert tiff.write_mask_files(spark.createDataFrame([("m", 4, 6, bytearray(on.tobytes()))], "name string, rows int, cols int, pixels binary"), f"{tmp_path}/masks") == 1
    assert json.load(open(f"{tmp_path}/masks/m.corners.json"))["se"] == {"row": 2, "col": 4}
    assert (render.decode_png(open(f"{tmp_path}/masks/m.png", "rb").read())[..., 0] == on * 255).all()
    row = spark.range(1).select(grid.downsampled_affine(F.array(*map(F.lit, AFFINE)), F.lit(50), F.lit(70), F.lit(35)).alias("g")).first()
    assert list(row.g) == [1000.0, 20.0, 0.0, 2000.0, 0.0, -20.0]

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolayer.functions import grid, tone
from aerolayer.plans import api
from aerolayer.raster import kernels as k
from aerolayer.raster import longform, render
from aerolayer.sinks import archive


def test_tone_map_golden(spark):
    r, g, b = [[800, 1300, 2500], [500, 1800, 3200]], [[900, 1500, 2400], [600, 1700, 3000]], [[700, 900, 2200], [400, 1400, 2800]]
    rows = [(i, *(int(x[i // 3][i % 3]) for x in (r, g, b))) for i in range(6)]
    got = spark.createDataFrame(rows, "i int, r int, g int, b int").select("i", tone.true_color(F.col("r"), F.col("g"), F.col("b")).alias("p")).orderBy("i").collect()
    assert [x.p.r for x in got] == [121, 152, 191, 92, 173, 204]
    assert [x.p.g for x in got] == [129, 163, 189, 104, 169, 201]
    assert [x.p.b for x in got] == [111, 125, 183, 78, 155, 196]


def naive_labels(m):
    out, n = np.zeros(m.shape, int), 0
    for y, x in zip(*np.nonzero(m)):
        if out[y, x]:
            continue
        n += 1
        todo = [(y, x)]
        while todo:
            i, j = todo.pop()
            if 0 <= i < m.shape[0] and 0 <= j < m.shape[1] and m[i, j] and not out[i, j]:
                out[i, j] = n
                todo += [(i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)]
    return out


def test_kernels_against_plain_loops():
    rng = np.random.default_rng(0)
    for _ in range(30):
        m = rng.random((rng.integers(1, 14), rng.integers(1, 14))) < rng.choice([0.3, 0.55, 0.8])
        assert (k.labels(m) == naive_labels(m)).all()
        p = np.pad(m, 1)
        near = lambda a, f: np.array([[f(a[y : y + 3, x : x + 3]) for x in range(m.shape[1])] for y in range(m.shape[0])])
        assert (k.dilate(m) == near(p, np.any)).all()
        assert (k.erode(m) == near(np.pad(m, 1, constant_values=True), np.all)).all()
        a = rng.random(m.shape)
        for size in (2, 3, 4, 5):
            q = np.pad(a, size, mode="edge")
            want = np.array([[q[y + size - size // 2 : y + 2 * size - size // 2, x + size - size // 2 : x + 2 * size - size // 2].mean() for x in range(m.shape[1])] for y in range(m.shape[0])])
            assert np.allclose(k.box_mean(a, size), want, atol=1e-5)


def test_polygonize_area_and_holes():
    rng = np.random.default_rng(1)
    area = lambda r: sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:])) / 2
    for _ in range(30):
        m = rng.random((9, 9)) < 0.6
        of, polygons = k.labels(m), k.polygonize(m)
        assert [round(abs(area(p[0])) - sum(abs(area(h)) for h in p[1:])) for p in polygons] == np.bincount(of.ravel())[1:].tolist()
    ring = np.ones((5, 5), bool)
    ring[2, 2] = False
    assert len(k.polygonize(ring)[0]) == 2
    g = k.mask_geometry(ring, [10, 2, 0, 20, 0, -2])
    assert g["type"] == "Polygon" and [10.0, 20.0] in g["coordinates"][0]


def test_chart_mask_and_corners():
    data = np.zeros((30, 30), np.uint8)
    data[6:24, 6:20] = 90
    data[10:12, 21:23] = 70  # near the core, thin
    mask, stages = k.chart_mask(data, k.MaskOptions(ink=-1))
    assert stages["core"].sum() == 18 * 14 and mask[8, 8]
    assert [r["reason"] for r in stages["component_report"]] == ["below_min_area"]
    block = np.zeros((5, 5), bool)
    block[1:4, 1:4] = True
    assert k.corner_points(block) == {"nw": (1, 1), "ne": (1, 3), "se": (3, 3), "sw": (3, 1)}
    with pytest.raises(ValueError):
        k.corner_points(np.zeros((2, 2), bool))


def test_grid_arguments():
    assert grid.validate_resolutions([640, 320]) == [640.0, 320.0]
    for bad in ([], [-1], [123], [320, 640], [640, 640]):
        with pytest.raises(ValueError):
            grid.validate_resolutions(bad)
    assert grid.zoom_levels(10, 10240, 5120) == (0, 1, [20.0, 10.0])


def test_tile_ids_are_a_bijection(spark):
    rows = [(3, x, y) for x in range(8) for y in range(8)]
    ids = spark.createDataFrame(rows, "z int, x long, y long").select(grid.tile_id(F.col("z"), F.col("x"), F.col("y")).alias("i")).collect()
    assert sorted(r.i for r in ids) == list(range(21, 85))
    with pytest.raises(Exception, match="outside zoom"):
        spark.createDataFrame([(1, 2, 0)], "z int, x long, y long").select(grid.tile_id(F.col("z"), F.col("x"), F.col("y"))).collect()


def test_directories_round_trip():
    entries, at = [], 0
    rng = np.random.default_rng(4)
    for i, n in enumerate(rng.integers(50, 100_000, 30_000).tolist()):
        entries.append((i * 7 + i % 3, at, n, 1))
        at += n + (i % 11 == 0)
    assert archive.decode_directory(archive.encode_directory(entries)) == entries
    root, leaves = archive.directories(entries)
    assert len(root) < archive.ROOT_LIMIT and leaves
    assert archive.decode_directory(root)[0][3] == 0


def test_render_is_exact_at_full_size():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 256, (4, 64, 64)).astype(np.uint8)
    a[3] = 255
    tile, shows = render.render(a, np.ones((64, 64), bool), (0, 0, 64, 64), 64)
    assert shows and np.abs(tile[..., :3].astype(int) - a[:3].transpose(1, 2, 0)).max() <= 1
    assert (render.decode_png(render.encode_png(tile)) == tile).all()
    _, shows = render.render(a, np.ones((64, 64), bool), (100, 100, 164, 164), 64)
    assert not shows
    with pytest.raises(RuntimeError, match="support is missing"):
        render.encode_tile(tile, "webp")


def test_build_tiles_archive_and_folder(spark, tmp_path):
    a = np.zeros((3, 64, 64), np.uint8)
    a[0], a[1], a[2] = 120, 90, 60
    x0, y1 = -2_000_000.0, 1_100_000.0
    row = [("r", 3, 64, 64, [x0, 1000.0, 0.0, y1, 0.0, -1000.0], bytearray(a.tobytes()), None)]
    rasters = spark.createDataFrame(row, "raster string, bands int, rows int, cols int, affine array<double>, pixels binary, nodata int")
    bounds = (x0, y1 - 64_000.0, x0 + 64_000.0, y1)
    out = str(tmp_path / "t.pmtiles")
    config = api.build_tiles(spark, rasters, bounds, out, [640, 320], tile_size=64)
    header, meta, tiles = archive.read_archive("file://" + out)
    assert header["tile_type"] == 2 and header["entries"] == len(tiles) == 4 + 16
    assert meta["pmtilesZoomOffset"] == 1 and meta["localZoomToPmtilesZoom"] == {"0": 1, "1": 2}
    inner = render.decode_png(tiles[1])
    assert inner.shape == (64, 64, 4) and tuple(inner[0, 0]) == (120, 90, 60, 255)
    assert config["tile"]["origin"] == [x0, y1] and len(config["extent"]["wgs84"]) == 4
    api.build_tiles(spark, rasters, bounds, str(tmp_path / "zxy"), [640], kind="folder", tile_size=64)
    assert sorted(p.name for p in (tmp_path / "zxy" / "tiles" / "0" / "1").iterdir()) == ["0.png", "1.png"]
    assert json.dumps(config)


def test_slope_layer(spark):
    rows = [(1, y, x, float(x * 100)) for y in range(6) for x in range(6)]
    dem = spark.createDataFrame(rows, "key int, row int, col int, v double")
    got = {(r.row, r.col): (r.l, r.a) for r in api.slope_layer(dem, ["key"], cell_x=100.0, cell_y=100.0).collect()}
    assert got[3, 3] == (45, 255) and len(got) == 36
    flat = longform.slope(dem.withColumn("v", F.lit(5.0)), ["key"]).agg(F.max("v")).first()[0]
    assert flat == 0


def test_reproject_and_mask(spark):
    rows = [("r", y, x, float(10 * y + x)) for y in range(4) for x in range(4)]
    px = spark.createDataFrame(rows, "raster string, row int, col int, v double")
    same = longform.reproject(px, ["raster"], [0, 1, 0, 4, 0, -1], [0, 2, 0, 4, 0, -2], 2, 2, lambda x, y: F.struct(x.alias("x"), y.alias("y")))
    assert {(r.row, r.col): r.v for r in same.collect()} == {(0, 0): 11.0, (0, 1): 13.0, (1, 0): 31.0, (1, 1): 33.0}
    data = [("r", y, x, 90 if 4 <= y < 16 and 4 <= x < 16 else 200) for y in range(20) for x in range(20)]
    on = api.chart_masks(spark.createDataFrame(data, "raster string, row int, col int, v int"), ["raster"], k.MaskOptions(ink=-1)).where("on")
    assert on.count() == 144


def test_layers_and_report(spark):
    px = spark.createDataFrame([("r", 0, 0, 1), ("r", 0, 1, 9)], "raster string, row int, col int, index int")
    palette = spark.createDataFrame([(1, 5, 6, 7, None)], "index int, r int, g int, b int, a int")
    from aerolayer.functions import rings

    ring = F.array(*[rings.point(F.lit(x), F.lit(y)) for x, y in ((0.0, 0.0), (1.0, 0.0), (1.0, -1.0), (0.0, -1.0))])
    full, cut = api.chart_layers(px, palette, F.array(*map(F.lit, [0.0, 1.0, 0.0, 0.0, 0.0, -1.0])), F.array(ring))
    assert [(r.r, r.g, r.b, r.a) for r in full.orderBy("col").collect()] == [(5, 6, 7, 255), (0, 0, 0, 0)] and [r.col for r in cut.collect()] == [0]
    runs = spark.createDataFrame([("2024-Q1", "a", "failed"), ("2024-Q1", "b", "succeeded")], "quarter string, region string, status string")
    assert api.quarter_report(runs)[0]["failed"] == 1

from pyspark.sql import functions as F

from aerolayer.operators import charts, packages, scenes, spatial
from aerolayer.functions import rings
from aerolayer.sources import listing
from aerolayer.streaming import streams
from tests.test_records import line


def test_stream_matches_batch_and_resumes(spark, tmp_path):
    src, seen = tmp_path / "in", []
    src.mkdir()
    (src / "49-UT.Dat").write_text(line() + "\n" + line(c39="75") + "\n")
    sink = lambda df, _: seen.append(df.count())
    run = lambda: streams.each_batch(streams.obstacle_features(streams.obstacle_lines(spark, str(src))), sink, str(tmp_path / "cp"))
    run()
    assert sum(seen) == 1
    (src / "08-CO.Dat").write_text(line(c16="CO") + "\n")
    run()
    assert sum(seen) == 2


def test_discovery_and_selection(spark):
    files = [("Denver", "Denver SEC.tif"), ("Denver", "Honolulu Inset SEC.tif"), ("Denver_TAC", "Denver TAC.tif"), ("Denver_TAC", "Denver FLY.tif"), ("Denver_TAC", "Anchorage Graphic.tif")]
    found = listing.discover(spark.createDataFrame(files, "dir string, file string"))
    assert sorted((r.chart_type, r.coverage_key) for r in found.collect()) == [("fly", "denvertac"), ("sectional", "denver"), ("tac", "denvertac")]
    assert {r.chart_name for r in charts.select_charts(found, ["denver", "DENVER "]).collect()} == {"Denver"}
    try:
        charts.select_charts(found, ["Nowhere"])
    except ValueError as e:
        assert "Denver_TAC" in str(e)
    else:
        raise AssertionError


def test_mosaic_inputs_through_aliases(spark):
    regions = spark.createDataFrame([("south", 0, "Dallas-Ft Worth"), ("south", 1, "Lost")], "region string, ordinal int, chart string")
    files = spark.createDataFrame([("/p/dallas/a--dallas-fort-worth-tac.tac.clip.tif", "a--dallas-fort-worth-tac.tac.clip.tif")], "path string, file string")
    got = charts.terminal_inputs(regions, files, "tac", charts.alias_table(spark))
    assert [r.chart for r in got.collect()] == ["Dallas-Ft Worth"]
    assert [r.chart for r in charts.regions_without_input(regions, got).collect()] == ["Lost"]
    assert charts.region_mosaics(got).first().position == 1


def test_status_and_resume(spark):
    specs = spark.createDataFrame([("a", "tac"), ("b", "tac"), ("c", "tac")], "zip_path string, chart_type string")
    there = spark.createDataFrame([("a", 5), ("b", 0)], "zip_path string, size long")
    got = {r.zip_path: r.status for r in packages.with_status(specs, there).collect()}
    assert got == {"a": "skipped-existing", "b": "downloaded", "c": "downloaded"}
    assert {r.status for r in packages.with_status(specs, there, dry_run=True).collect()} == {"dry-run"}
    tiles = spark.createDataFrame([("x",), ("y",)], "t string")
    assert scenes.pending(tiles, tiles.where("t = 'x'"), "t").first().t == "y"


def test_unsafe_zip(tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("../evil.txt", "x")
    try:
        packages.safe_unzip(str(tmp_path / "z.zip"), str(tmp_path / "out"))
    except ValueError as e:
        assert "Unsafe" in str(e)
    else:
        raise AssertionError
    assert not (tmp_path / "evil.txt").exists()


def test_point_in_polygon_with_hole(spark):
    ring = lambda a, b: F.array(*[rings.point(F.lit(float(x)), F.lit(float(y))) for x, y in ((a, a), (b, a), (b, b), (a, b))])
    poly = spark.range(1).select(F.array(ring(0, 10), ring(4, 6)).alias("rings"))
    pts = spark.createDataFrame([(1, 2.0, 2.0), (2, 5.0, 5.0), (3, 11.0, 5.0)], "id int, x double, y double")
    assert [r.id for r in spatial.points_in_polygons(pts, poly, "x", "y", "rings", 3.0).collect()] == [1]

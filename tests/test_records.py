import gzip
import json

import pytest
from pyspark.sql import functions as F

from aerolayer.functions import measures, projection, text
from aerolayer.functions.features import to_features
from aerolayer.plans import api
from aerolayer.sources import coverage, navaids, obstacles, scenes, web


def line(**put):
    base = {1: "49", 3: "-", 4: "123456", 11: "O", 13: "US", 16: "UT", 19: "SALT LAKE CITY", 36: "40", 39: "30", 42: "30.00", 47: "N", 49: "111", 53: "45", 56: "30.00", 61: "W", 63: "TOWER", 82: "1", 84: "00850", 90: "01320", 96: "R", 98: "1", 100: "B", 102: "M", 104: "2020ST00001OE", 119: "A", 121: "2016038"}
    base |= {int(k[1:]): v for k, v in put.items()}
    out = [" "] * 127
    for at, v in base.items():
        out[at - 1 : at - 1 + len(v)] = v
    return "".join(out)


def parse(spark, *lines):
    df = spark.createDataFrame([("f", i + 1, x) for i, x in enumerate(lines)], "file string, line_number int, line string")
    return obstacles.parse(df)


def test_obstacle_golden(spark):
    n = obstacles.normalize(obstacles.good(parse(spark, line())))
    r = n.first()
    assert (r.obstacle_id, r.location.latitude, r.location.longitude) == ("49-123456", 40.50833333, -111.75833333)
    assert r.heights.agl.meters == 259.08 and r.heights.amsl.meters == 402.336
    assert r.lighting.description == "Red" and r.vertical_accuracy.meters == 3.048
    x, y = to_features(n, "esri:102009").first().geometry.coordinates
    assert (round(x, 6), round(y, 6)) == (-1247788.196368, 166073.217645)


def test_second_projected_point(spark):
    p = spark.range(1).select(projection.to_lambert(F.lit(-93.213272), F.lit(36.318308)).alias("p")).first().p
    assert abs(p.x - 235804.89) < 1 and abs(p.y + 380638.79) < 1


@pytest.mark.parametrize(
    ("put", "error"),
    [
        ({"c16": "  "}, "missing state identifier for US record"),
        ({"c39": "75"}, "lat minutes must be in [0, 59]"),
        ({"c39": "XX"}, "invalid lat coordinate numeric component"),
        ({"c61": "Q"}, "lon hemisphere must be E or W"),
        ({"c82": "X"}, "quantity must be an integer when present"),
        ({"c84": "ABCDE"}, "AGL height must be an integer"),
        ({"c121": "20X6038"}, "julian date must be a 7-digit numeric value"),
        ({"c39": "75", "c121": "20X6038"}, "lat minutes must be in [0, 59]"),
        ({"c63": " " * 18}, "missing obstacle type"),
    ],
)
def test_first_error(spark, put, error):
    assert parse(spark, line(**put)).first().parse_error == error


def test_files_counts_and_filter(spark, tmp_path):
    for name, n in (("08-CO", 4), ("16-ID", 1), ("32-NV", 3), ("49-UT", 2)):
        rows = ["header", ""] + [line(c1=name[:2], c16=name[3:]) for _ in range(n)]
        (tmp_path / f"{name}.Dat").write_bytes("\r\n".join(rows).encode() + b"\r\n")
    (tmp_path / "readme.txt").write_text("no")
    out = str(tmp_path / "o.geojson.gz")
    got = api.parse_obstacles(spark, out, input_dir=str(tmp_path), states=["UT"])
    assert (got["file_count"], got["scanned_record_lines"], got["parsed_count"], got["skipped_by_state_count"], got["error_count"]) == (4, 10, 2, 8, 0)
    doc = json.loads(gzip.decompress(open(out, "rb").read()))
    assert len(doc["features"]) == 2 and "crs" not in doc
    assert doc["features"][0]["properties"]["source"]["line_number"] in (3, 4)
    with pytest.raises(ValueError):
        obstacles.read_state_files(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        text.state_filter(["UTA"])


def test_invalid_bytes_keep_columns(spark, tmp_path):
    raw = bytearray(line().encode())
    raw[20] = 0xD1
    (tmp_path / "49-UT.Dat").write_bytes(bytes(raw) + b"\n")
    r = obstacles.parse(obstacles.read_state_files(spark, str(tmp_path))).first()
    assert r.parse_error is None and r.julian_date == "2016038"


XML = """<faa:SubscriberFile xmlns:faa="f" xmlns:aixm="a" xmlns:gml="g" xmlns:xlink="x" xmlns:nav="n" validFrom="2026-01-22">
<faa:Member><aixm:Navaid gml:id="N1"><aixm:timeSlice><aixm:NavaidTimeSlice><aixm:type>VOR_DME</aixm:type><aixm:designator>SLC</aixm:designator><aixm:name>SALT LAKE</aixm:name>
<aixm:navaidEquipment><aixm:NavaidComponent><aixm:theNavaidEquipment xlink:href="#/faa:SubscriberFile/faa:Member/aixm:RadioCommunicationChannel[@gml:id='R1']"/></aixm:NavaidComponent></aixm:navaidEquipment>
<aixm:navaidEquipment><aixm:NavaidComponent><aixm:theNavaidEquipment xlink:href="#/faa:SubscriberFile/faa:Member/aixm:RadioCommunicationChannel[@gml:id='R2']"/></aixm:NavaidComponent></aixm:navaidEquipment>
<aixm:location><aixm:ElevatedPoint><gml:pos>-111.979722 40.850556</gml:pos><aixm:elevation uom="FT">4220.0</aixm:elevation></aixm:ElevatedPoint></aixm:location></aixm:NavaidTimeSlice></aixm:timeSlice></aixm:Navaid></faa:Member>
<faa:Member><aixm:Navaid gml:id="N2"><aixm:timeSlice><aixm:NavaidTimeSlice><aixm:type>ILS</aixm:type><aixm:designator>X</aixm:designator><aixm:name>Y</aixm:name></aixm:NavaidTimeSlice></aixm:timeSlice></aixm:Navaid></faa:Member>
<faa:Member><aixm:Navaid gml:id="N3"><aixm:timeSlice><aixm:NavaidTimeSlice><aixm:type>NDB</aixm:type><aixm:designator>B</aixm:designator><aixm:name>BAD</aixm:name><aixm:location><aixm:ElevatedPoint><gml:pos>5</gml:pos></aixm:ElevatedPoint></aixm:location></aixm:NavaidTimeSlice></aixm:timeSlice></aixm:Navaid></faa:Member>
<faa:Member><aixm:RadioCommunicationChannel gml:id="R1"><aixm:timeSlice><aixm:RadioCommunicationChannelTimeSlice><aixm:frequencyTransmission uom="MHZ">116.8</aixm:frequencyTransmission><aixm:channel></aixm:channel></aixm:RadioCommunicationChannelTimeSlice></aixm:timeSlice></aixm:RadioCommunicationChannel></faa:Member>
<faa:Member><aixm:RadioCommunicationChannel gml:id="R2"><aixm:timeSlice><aixm:RadioCommunicationChannelTimeSlice><aixm:frequencyTransmission uom="MHZ">x</aixm:frequencyTransmission><aixm:channel>115X</aixm:channel></aixm:RadioCommunicationChannelTimeSlice></aixm:timeSlice></aixm:RadioCommunicationChannel></faa:Member>
</faa:SubscriberFile>"""


def test_navaids(spark, tmp_path):
    (tmp_path / "n.xml").write_text(XML)
    out = str(tmp_path / "n.geojson.gz")
    got = api.parse_navaids(spark, str(tmp_path / "n.xml"), out)
    assert got == {"navaid_count": 1, "rcc_count": 2, "error_count": 1, "effective_date": "2026-01-22"}
    f = json.loads(gzip.decompress(open(out, "rb").read()))["features"][0]
    assert f["geometry"]["coordinates"] == [-111.979722, 40.850556]
    p = f["properties"]
    assert p["frequency"] == {"mhz": 116.8, "channel": "115X"} and p["elevation"]["feet"] == 4220.0 and "state_name" not in p
    assert navaids.NAVAID_TYPES[0] == "VOR"


HEADER = '"Chart" "SW N" "NW N" "SE N" "NE N" "SW W" "NW W" "SE W" "NE W"'


def test_coverage_table(spark, tmp_path):
    rows = ["Denver (East) 35°45'N 40°15'N 35°45'N 40°15'N 111°00'W 111°00'W 104°00'W 104°00'W", "Western Aleutian 51°00'N 56°00'N 51°00'N 56°00'N 169°00'E 169°00'E 173°00'W 173°00'W"]
    (tmp_path / "c.txt").write_text("\n".join([HEADER, "", *rows]))
    assert api.convert_coverage(spark, str(tmp_path / "c.txt"), output=str(tmp_path / "c.geojson")) == 2
    one, two = json.loads((tmp_path / "c.geojson").read_text())["features"]
    assert one["properties"]["chart"] == "Denver (East)" and one["geometry"]["type"] == "Polygon"
    assert one["geometry"]["coordinates"][0][0] == one["geometry"]["coordinates"][0][-1]
    assert one["properties"]["corner_decimal_degrees"]["SW"] == {"latitude": 35.75, "longitude": -111.0}
    assert two["geometry"]["type"] == "MultiPolygon" and len(two["geometry"]["coordinates"]) == 2
    assert api.convert_coverage(spark, str(tmp_path / "c.txt"), folder=str(tmp_path / "d")) == 2
    assert (tmp_path / "d" / "denver-east.geojson").exists()
    (tmp_path / "bad.txt").write_text("\n".join([HEADER, "Denver 1 2"]))
    with pytest.raises(ValueError, match="too few"):
        api.convert_coverage(spark, str(tmp_path / "bad.txt"), output=str(tmp_path / "x"))


def test_regions_and_scenes(spark):
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}}, {"type": "Feature", "properties": {"region-name": "x"}, "geometry": None}]}
    got = coverage.region_geometries(spark.createDataFrame([(json.dumps(doc),)], "value string")).collect()
    assert [r.region for r in got] == ["unknown"]
    scene = {"tile_id": "t", "quarter": "2024-Q3", "geometry": {}, "href_red": "r", "href_green": "g", "href_blue": "b", "more": 1}
    ok = scenes.saved_scenes(spark.createDataFrame([(json.dumps([scene]),)], "value string")).first()
    assert (ok.tile_id, ok.href_red) == ("t", "r")
    del scene["href_blue"]
    with pytest.raises(Exception, match="href_blue"):
        scenes.saved_scenes(spark.createDataFrame([(json.dumps([scene]),)], "value string")).collect()


def test_quarters(spark):
    q = spark.createDataFrame([("2024-Q1",), ("2024-Q4",)], "q string").select(measures.quarter_bounds(F.col("q")).alias("b")).collect()
    assert [(r.b.start, r.b.end) for r in q] == [("2024-01-01T00:00:00Z", "2024-04-01T00:00:00Z"), ("2024-10-01T00:00:00Z", "2025-01-01T00:00:00Z")]
    with pytest.raises(Exception, match="not a quarter"):
        spark.createDataFrame([("2024-Q5",)], "q string").select(measures.quarter_bounds(F.col("q"))).collect()


def test_fetch_plan(spark):
    root = "https://x.example/visual/"
    pages = {root: '<a href="/visual/01-22-2026/"> <a HREF=\'/visual/03-19-2026/\'>', f"{root}01-22-2026/sectional-files/": '<a href="Denver.zip"><a href="https://y.example/a/Miami.zip"><a href=n.txt>', f"{root}01-22-2026/tac-files/": "<a href=Denver_TAC.zip>"}
    cycle, specs = api.fetch_plan(spark, root, fetch=lambda u: pages[u], exists=lambda u: "01-22-2026" in u)
    rows = specs.collect()
    assert cycle == "01-22-2026" and [(r.chart_type, r.folder_name) for r in rows] == [("sectional", "Denver"), ("sectional", "Miami"), ("tac", "Denver_TAC")]
    assert rows[1].url == "https://y.example/a/Miami.zip"


def test_retry_and_probe():
    calls, naps = [], []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return 7

    assert web.with_retry(flaky, sleep=naps.append) == 7 and naps == [8, 64]
    import urllib.error

    def opener(request, timeout):
        raise urllib.error.URLError("no")

    assert web.url_exists("http://x", opener=opener) is False

"""Driver queries of listings, configurations, indexes, files and chart masks, and DuckDB SQL for them."""

from __future__ import annotations

import json
import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ..functions import grid, measures, projection, text
from ..operators import charts, packages, scenes
from ..raster import kernels
from ..sinks import geojson
from ..sources import coverage, listing, obstacles, web
from . import carriers
from .raster_queries import LABELS, QUANTIZED, quantized

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def nations(spark, d):
    return carriers.table(spark, d, "nation").select(col("n_nationkey").alias("k"), col("n_name").alias("name"), col("n_regionkey").alias("r"))


def collection(rows, *keys):
    """FeatureCollections of rows (feature JSON in f, in the order of k), one for each of keys."""
    held = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("k", "f"))).alias("fs"))
    return held.select(*keys, F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.transform("fs", lambda s: s["f"]), ","), F.lit("]}")).alias("value"))


def square(k):
    return F.concat(F.lit("[[["), k, F.lit(",0],["), k + 1, F.lit(",0],["), k + 1, F.lit(",1],["), k, F.lit(",0]]]"))


def shape(k):
    """A Polygon, or for every third a MultiPolygon of two."""
    two = F.concat(F.lit('{"type":"MultiPolygon","coordinates":['), square(k), F.lit(","), square(k + 100), F.lit("]}"))
    return F.when(k % 3 == 0, two).otherwise(F.concat(F.lit('{"type":"Polygon","coordinates":'), square(k), F.lit("}")))


@query("""SELECT lower(r_name) || 'file' AS chart_key, CAST(sum(CASE WHEN n_nationkey % 3 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS polygons, CAST(arg_min(n_nationkey, n_nationkey) AS BIGINT) AS first_x
FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY r_name""".replace("lower(r_name)", "regexp_replace(lower(r_name), '[^a-z0-9]', '', 'g')"))
def mask_merge(spark, d):
    """A mask file for each region, with a feature for each nation: one MultiPolygon for each file, in order."""
    k = col("k")
    rows = nations(spark, d).select("k", "r", F.concat(F.lit('{"type":"Feature","properties":{},"geometry":'), shape(k), F.lit("}")).alias("f"))
    files = collection(rows, "r").join(carriers.table(spark, d, "region"), col("r") == col("r_regionkey"))
    index = coverage.mask_index(files.select(F.concat(F.lit("/masks/"), "r_name", F.lit(" file.geojson")).alias("path"), "value"))
    return index.select("chart_key", F.size("polygons").cast("long").alias("polygons"), col("polygons")[0][0][0][0].cast("long").alias("first_x"))


@query("SELECT regexp_replace(lower(n_name), '[^a-z0-9]', '', 'g') AS chart_key, '/masks/' || n_nationkey || '/' || n_name || ' SEC.geojson' AS path FROM nation")
def mask_paths(spark, d):
    files = nations(spark, d).select(F.concat(F.lit("/masks/"), "k", F.lit("/"), "name", F.lit(" SEC.geojson")).alias("path"))
    return listing.mask_paths(files)


@query("SELECT CASE WHEN n_nationkey % 4 = 0 THEN 'unknown' ELSE n_name END AS region, CAST(count(*) AS BIGINT) AS features, CAST(sum(CASE WHEN n_nationkey % 3 = 0 THEN 2 ELSE 1 END) AS BIGINT) AS polygons FROM nation WHERE n_nationkey % 5 <> 1 GROUP BY 1")
def region_polygons(spark, d):
    """Region features: some without a name, some without geometry."""
    k = col("k")
    named = F.when(k % 4 == 0, F.lit('{"other":"x"}')).otherwise(F.concat(F.lit('{"region-name":"'), "name", F.lit('"}')))
    f = F.concat(F.lit('{"type":"Feature","properties":'), named, F.lit(',"geometry":'), F.when(k % 5 == 1, "null").otherwise(shape(k)), F.lit("}"))
    found = coverage.region_geometries(collection(nations(spark, d).select("k", f.alias("f"))))
    return found.groupBy("region").agg(F.count("*").alias("features"), F.sum(F.size("polygons")).cast("long").alias("polygons"))


@query("SELECT r_name AS region, CAST(row_number() OVER (PARTITION BY r_name ORDER BY n_name) - 1 AS INT) AS ordinal, n_name AS chart FROM nation JOIN region ON r_regionkey = n_regionkey")
def region_mapping(spark, d):
    n = carriers.table(spark, d, "nation").join(carriers.table(spark, d, "region"), col("n_regionkey") == col("r_regionkey"))
    lists = n.groupBy("r_name").agg(F.array_sort(F.collect_list("n_name")).alias("charts"))
    doc = lists.agg(F.map_from_entries(F.collect_list(F.struct("r_name", "charts"))).alias("m")).select(F.to_json(F.create_map(F.lit("terminal_area"), "m")).alias("value"))
    return coverage.region_mapping(doc, "tac")


LOCATION = "CASE p_partkey % 4 WHEN 0 THEN 's3://b/' || p_name WHEN 1 THEN 'https://h.org/p/' || p_name || '.tif?x=1' WHEN 2 THEN '/data/' || p_name || '.tar.gz' ELSE 'x/' || p_name END"


def locations(spark, d):
    p = carriers.table(spark, d, "part").select(col("p_partkey").alias("k"), "p_name")
    kinds = [F.concat(F.lit("s3://b/"), "p_name"), F.concat(F.lit("https://h.org/p/"), "p_name", F.lit(".tif?x=1")), F.concat(F.lit("/data/"), "p_name", F.lit(".tar.gz")), F.concat(F.lit("x/"), "p_name")]
    return p.select("k", "p_name", F.element_at(F.array(*kinds), (col("k") % 4).cast("int") + 1).alias("u"))


@query(f"""WITH u AS (SELECT p_partkey AS k, {LOCATION} AS u FROM part)
SELECT k, CASE WHEN u LIKE 's3://%' THEN '/vsis3/' || substr(u, 6) WHEN u LIKE 'https://%' THEN '/vsicurl/' || u ELSE u END AS virtual FROM u""")
def virtual_paths(spark, d):
    return locations(spark, d).select("k", text.virtual_path(col("u")).alias("virtual"))


@query("""SELECT p_partkey AS k, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name || '.tif' WHEN 2 THEN p_name || '.tar.gz' ELSE p_name END AS base,
  CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name WHEN 2 THEN p_name || '.tar' ELSE p_name END AS stem,
  CASE p_partkey % 4 WHEN 0 THEN 'https://site.org/a/s3://b/' || p_name WHEN 1 THEN 'https://h.org/p/' || p_name || '.tif?x=1' WHEN 2 THEN 'https://site.org/data/' || p_name || '.tar.gz' ELSE 'https://site.org/a/x/' || p_name END AS joined FROM part""")
def url_parts(spark, d):
    return locations(spark, d).select("k", text.base_name(col("u")).alias("base"), text.stem(col("u")).alias("stem"), text.url_join(F.lit("https://site.org/a/index.html"), col("u")).alias("joined"))


@query("SELECT o_orderkey AS k, strftime(o_orderdate, '%m-%d-%Y') || CASE WHEN o_orderkey % 2 = 0 THEN ',12-31-1999' ELSE '' END AS tokens, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey * 7 END AS size FROM orders")
def cycle_tokens(spark, d):
    """Dates among the parts of a URL's path, and content lengths, some of them no numbers."""
    o = carriers.table(spark, d, "orders").select(col("o_orderkey").alias("k"), F.date_format("o_orderdate", "MM-dd-yyyy").alias("t"))
    k = col("k")
    url = F.concat(F.lit("https://h.org/visual/"), "t", F.when(k % 2 == 0, "/12-31-1999/").otherwise("/1-1-1999/"), F.lit("x?c=01-01-2001"))
    size = F.when(k % 3 == 0, "many").otherwise(F.concat(F.lit(" "), k * 7, F.lit(" ")))
    return o.select("k", F.array_join(text.cycle_tokens(url), ",").alias("tokens"), text.optional_long(size).alias("size"))


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS value FROM customer")
def tag_lookup(spark, d):
    k = col("c_custkey")
    key = F.when(k % 3 == 0, "other").when(k % 3 == 1, "TIFFTAG-Image_Description").otherwise("tifftag image description")
    tags = F.create_map(F.lit("a"), F.lit("b"), key, F.concat(F.lit(" "), "c_name", F.lit(" ")))
    return carriers.table(spark, d, "customer").select(k.alias("id"), text.tag_value(tags, "TIFFTAG_IMAGEDESCRIPTION").alias("value"))


@query("SELECT n_name AS chart_name, CAST(row_number() OVER (ORDER BY lower(n_name)) - 1 AS INT) AS position FROM nation")
def chart_selection(spark, d):
    """All charts in order; asked for by other spellings, the same charts come in the order of asking."""
    c = nations(spark, d).select(text.key_strict(col("name")).alias("chart_key"), col("name").alias("chart_name"))
    every = charts.select_charts(c, None, all_charts=True).select("chart_name", "position")
    asked = [r[0] for r in every.orderBy("position").collect()]
    some = charts.select_charts(c, [n.lower().replace(" ", "-") for n in asked] + asked[:2])
    return some.select("chart_name", "position").intersect(every.select("chart_name", col("position").cast("int").alias("position")))


@query("SELECT base, z, base * pow(2.0::DOUBLE, top - z) AS resolution FROM (SELECT base, top, unnest(generate_series(0, top)) AS z FROM (SELECT CAST(b AS DOUBLE) AS base, CAST(greatest(0, ceil(log2(greatest(1126.0, 795.0) * 10000 / b / 512))) AS BIGINT) AS top FROM (VALUES (20), (40), (80), (160), (320)) v(b)))")
def zoom_ladder(spark, d):
    rows = []
    for base in (20.0, 40.0, 80.0, 160.0, 320.0):
        low, top, resolutions = grid.zoom_levels(base, 11_260_000.0, 7_950_000.0)
        rows += [(base, z, resolutions[z]) for z in range(low, top + 1)]
    return spark.createDataFrame(rows, "base double, z long, resolution double")


@query("SELECT * FROM (VALUES (0, '2560.0'), (1, '640.0'), (2, '20.0'), (3, 'Resolutions must be listed from coarse to fine.'), (4, 'At least one resolution is required.'), (5, 'Resolutions must be positive values.'), (6, 'fly'), (7, 'sectional'), (8, 'tac')) v(i, shown)")
def argument_lists(spark, d):
    """Ladders and type lists as they are checked and tidied before a run."""
    rows = [str(v) for v in grid.validate_resolutions(coverage.load_resolutions('{"resolutions": [2560, 640, 20]}'))]
    for bad in ([640, 2560], [], [-1]):
        try:
            grid.validate_resolutions(bad)
        except ValueError as e:
            rows.append(str(e))
    rows += sorted(text.normalized_list([" TAC", "fly", "tac", "", "Sectional "], listing.CHART_TYPES))
    return spark.createDataFrame(list(enumerate(rows)), "i int, shown string")


@query("SELECT n_nationkey AS id, CAST(ceil((n_nationkey + 1) * 100000.0 / (512 * 160)) AS BIGINT) AS tiles_x, CAST(ceil((n_nationkey % 7) * 100000.0 / (512 * 160)) AS BIGINT) AS tiles_y FROM nation")
def tile_counts(spark, d):
    k = col("n_nationkey").cast("double")
    n = carriers.table(spark, d, "nation").select(col("n_nationkey").alias("id"), grid.tile_counts((k + 1) * 100000.0, (k % 7) * 100000.0, F.lit(160.0)).alias("t"))
    return n.select("id", "t.tiles_x", "t.tiles_y")


@query("""WITH a AS (SELECT n_nationkey AS id, n_nationkey * 10.0::DOUBLE AS x, 2.0::DOUBLE AS dx, 0.5::DOUBLE AS rx, n_nationkey * -3.0::DOUBLE AS y, 0.25::DOUBLE AS ry, -2.0::DOUBLE AS dy FROM nation)
SELECT id, x AS min_x, y - 60.0 AS min_y, x + 40 * 2.0 + 30 * 0.5 AS max_x, y + 40 * 0.25 AS max_y, CAST(trunc((x / 7.0) * 10000000.0) AS INT) AS e7 FROM a""")
def raster_corners(spark, d):
    """Boxes of rotated rasters of 40 by 30 pixels, and a coordinate as archive headers hold it."""
    k = col("n_nationkey").cast("double")
    n = carriers.table(spark, d, "nation").select(col("n_nationkey").alias("id"), F.array(k * 10.0, F.lit(2.0), F.lit(0.5), k * -3.0, F.lit(0.25), F.lit(-2.0)).alias("g"))
    n = n.select("id", grid.affine_bounds(col("g"), F.lit(40.0), F.lit(30.0)).alias("b"), grid.e7(col("g")[0] / 7.0).alias("e7"))
    return n.select("id", "b.min_x", "b.min_y", "b.max_x", "b.max_y", "e7")


@query("SELECT c_custkey AS id, -124.0::DOUBLE + (c_custkey % 5700) / 100.0::DOUBLE AS x, 25.0::DOUBLE + (c_custkey % 2300) / 100.0::DOUBLE AS y FROM customer")
def identity_projection(spark, d):
    return carriers.points(spark, d).withColumn("p", projection.transform("wgs84")(col("lon"), col("lat"))).select("id", "p.x", "p.y")


@query("SELECT strftime(o_orderdate, '%m-%d-%Y') AS cycle, CAST(min(CAST(o_orderdate AS DATE)) AS VARCHAR) AS cycle_date FROM orders GROUP BY 1")
def cycles_found(spark, d):
    """Cycles that an index page for each order priority links to."""
    link = F.concat(F.lit('<a href="/visual/'), F.date_format("o_orderdate", "MM-dd-yyyy"), F.lit('/">'))
    pages = carriers.table(spark, d, "orders").groupBy("o_orderpriority").agg(F.array_join(F.collect_set(link), "").alias("html"))
    return packages.cycles(pages).select("cycle", col("cycle_date").cast("string").alias("cycle_date"))


@query("""SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'sectional' ELSE 'tac' END AS chart_type, n_nationkey || '.zip' AS zip_name, CAST(n_nationkey AS VARCHAR) AS folder_name,
  CASE WHEN n_nationkey % 3 = 0 THEN 'https://h.org/x/' || n_nationkey || '.zip' ELSE 'https://h.org/v/1/' || n_nationkey || '.zip?d=' || n_regionkey END AS url FROM nation""")
def package_list(spark, d):
    """Zip links of two index pages: relative, absolute and repeated ones, and others that don't count."""
    k = col("n_nationkey")
    once = F.concat(F.lit('<a href="'), k, F.lit('.zip?d='), "n_regionkey", F.lit('">x</a><a href="a.txt">'))
    again = F.when(k % 3 == 0, F.concat(F.lit('<a href="/x/'), k, F.lit('.zip">'))).otherwise("")
    kind = F.when(k % 2 == 0, "sectional").otherwise("tac")
    pages = carriers.table(spark, d, "nation").groupBy(kind.alias("chart_type")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), F.concat(once, again).alias("h")))), lambda s: s["h"]), "\n").alias("html"))
    rows = packages.packages(pages.withColumn("cycle", F.lit("01-01-2024")).withColumn("index_url", F.lit("https://h.org/v/1/")))
    return rows.select("chart_type", "zip_name", "folder_name", "url")


@query("SELECT CAST(min(z) AS INT) AS min_zoom, CAST(max(z) AS INT) AS max_zoom, count(*) AS tiles, CAST(sum(n) AS BIGINT) AS bytes FROM (SELECT o_orderkey % 11 AS z, o_orderkey % 100 AS n FROM orders WHERE o_orderkey % 3 <> 0)")
def archive_stats(spark, d):
    k = col("o_orderkey")
    tiles = carriers.table(spark, d, "orders").select((k % 11).cast("int").alias("z"), (k % 3 != 0).alias("has_data"), F.repeat(F.lit("x"), (k % 100).cast("int")).cast("binary").alias("data"))
    return scenes.archive_stats(tiles)


def scratch_folder(spark) -> str:
    """A folder for files that a query writes before it reads them: below spark.checkpoint.dir where that is set."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    return tempfile.mkdtemp(prefix="aerolayer-", dir=base.removeprefix("file://") if base and os.path.isdir(base.removeprefix("file://")) else None)


@query("SELECT lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0') || '-AA.Dat' AS file, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS INT) AS line_number, n_name || chr(65533) AS line FROM nation")
def state_lines(spark, d):
    """Lines of state files, with bytes that are no UTF-8, and files beside them that don't count."""
    folder = scratch_folder(spark)
    for r in range(5):
        names = [x[0] for x in nations(spark, d).where(col("r") == r).orderBy("k").select("name").collect()]
        with open(f"{folder}/{r + 1:02d}-AA.Dat", "wb") as f:
            f.write(b"\xff\r\n".join(n.encode() for n in names) + b"\xff\n")
    with open(f"{folder}/notes.txt", "w") as f:
        f.write("nothing\n")
    return obstacles.read_state_files(spark, folder).select(F.element_at(F.split("file", "/"), -1).alias("file"), "line_number", "line")


@query("SELECT 'https://h.org/' || n_name AS url FROM nation")
def url_list(spark, d):
    path = f"{scratch_folder(spark)}/urls.txt"
    with open(path, "w") as f:
        f.write("# a list\n\n" + "".join(f"  https://h.org/{r.name} \n#{r.k}\n" for r in nations(spark, d).orderBy("k").collect()))
    return web.url_list(spark, path)


@query("SELECT n_name AS name, CAST(n_nationkey AS DOUBLE) AS x, CAST(CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE n_regionkey END AS BIGINT) AS r FROM nation")
def feature_file(spark, d):
    """Features written as one gzip collection by several tasks, and read again."""
    path = f"{scratch_folder(spark)}/out.geojson.gz"
    k = col("k")
    f = F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array(k.cast("double"), F.lit(1.0)).alias("coordinates")).alias("geometry"), F.struct("name", F.when(k % 4 == 0, None).otherwise(col("r")).alias("r")).alias("properties")), {"ignoreNullFields": "false"})
    spark.dataSource.register(geojson.FeatureCollectionSink)
    nations(spark, d).repartition(4, "k").select(f.alias("value")).write.format("feature_collection").mode("append").save(path)
    doc = spark.createDataFrame([(json.dumps(geojson.read_collection(path)),)], "value string")
    got = coverage.features_of(doc, "value", "struct<name:string,r:bigint>")
    return got.select("properties.name", F.from_json("coordinates", "array<double>")[0].alias("x"), "properties.r")


@query("SELECT r_name AS chart, regexp_replace(lower(r_name), '[^a-z0-9]+', '-', 'g') || '.geojson' AS file FROM region")
def feature_folder(spark, d):
    """A file for each chart, named by its slug."""
    folder = scratch_folder(spark)
    rows = carriers.table(spark, d, "region").select(col("r_name").alias("chart"), F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct("r_name").alias("properties"))).alias("value"))
    geojson.write_feature_folder(rows, folder)
    files = coverage.read_whole(spark, folder)
    return files.select(F.get_json_object("value", "$.properties.r_name").alias("chart"), F.element_at(F.split("path", "/"), -1).alias("file"))


@query(LABELS + "SELECT vec_id, r AS row, c AS col FROM lab JOIN (SELECT vec_id, root, count(*) AS area FROM lab GROUP BY 1, 2) USING (vec_id, root) WHERE area >= 3")
def component_prune(spark, d):
    return kernels.per_raster(carriers.masks(spark, d), ["vec_id"], "on", lambda a: {"kept": kernels.prune(a, 3)}, "kept boolean").where("kept").drop("kept")


@query(
    LABELS + """, st AS (SELECT vec_id, root, count(*) AS area, max(c) AS rt, greatest(max(r) - min(r), max(c) - min(c)) + 1 AS span FROM lab GROUP BY 1, 2),
main AS (SELECT vec_id, arg_max(root, area * 1000 - root) AS root FROM st GROUP BY 1)
SELECT lab.vec_id, r AS row, c AS col FROM lab JOIN st USING (vec_id, root) JOIN main ON main.vec_id = lab.vec_id WHERE lab.root = main.root OR (rt >= 8 - 2 AND area >= 2 AND span >= 2)"""
)
def main_and_islands(spark, d):
    """The largest component and the islands at the east edge."""
    return kernels.per_raster(carriers.masks(spark, d), ["vec_id"], "on", lambda a: {"kept": kernels.main_and_islands(a, 2, 2, 2)}, "kept boolean").where("kept").drop("kept")


@query(QUANTIZED + ", p AS (SELECT vec_id, r, c, v + 5 AS i FROM q) SELECT vec_id, r AS row, c AS col, CAST(CASE WHEN i BETWEEN 0 AND 24 THEN i * 10 ELSE 0 END AS INT) AS red, CAST(CASE WHEN i BETWEEN 0 AND 24 THEN i * 5 ELSE 0 END AS INT) AS green, CAST(CASE WHEN i BETWEEN 0 AND 24 THEN i ELSE 0 END AS INT) AS blue FROM p WHERE i >= 0")
def palette_view(spark, d):
    """Indexes as colours of a palette; indexes without one are black."""
    palette = {i: (i * 10, i * 5, i) for i in range(25)}

    def run(a):
        rgb = kernels.as_rgb(a.clip(min=0), palette).astype(int)
        return {"i": a, "red": rgb[..., 0], "green": rgb[..., 1], "blue": rgb[..., 2]}

    px = quantized(spark, d).withColumn("v", col("v") + 5)
    return kernels.per_raster(px, ["vec_id"], "v", run, "i int, red int, green int, blue int").where("i >= 0").drop("i")


@query(
    QUANTIZED + """, e AS (SELECT vec_id, v, sum((r < 2)::INT + (r > 5)::INT + (c < 2)::INT + (c > 5)::INT) AS n FROM q WHERE r < 2 OR r > 5 OR c < 2 OR c > 5 GROUP BY 1, 2),
b AS (SELECT vec_id, arg_max(v, n * 100000 - v) AS g FROM e GROUP BY 1) SELECT vec_id, r AS row, c AS col FROM q JOIN b USING (vec_id) WHERE v = g"""
)
def background_mask(spark, d):
    """Pixels of the commonest value along the edges."""
    from ..raster.longform import edge_mode

    px = quantized(spark, d)
    found = edge_mode(px, ["vec_id"], 2)
    return px.join(found, "vec_id").where(col("v") == col("background")).select("vec_id", "row", "col")


@query(
    """SELECT n_name AS name, CAST(n_nationkey % 7 + 4 AS INT) AS width, CAST(n_nationkey % 5 + 3 AS INT) AS height, n_nationkey * 100.0::DOUBLE AS min_x, 7000 - n_nationkey * 50.0::DOUBLE - 10 * (n_nationkey % 5 + 3) AS min_y,
  n_nationkey * 100.0::DOUBLE + 10 * (n_nationkey % 7 + 4) AS max_x, 7000 - n_nationkey * 50.0::DOUBLE AS max_y, CAST(n_nationkey * (n_nationkey % 7 + 4) * (n_nationkey % 5 + 3) AS BIGINT) AS total FROM nation"""
)
def raster_files(spark, d):
    """Rasters of one value each, written as files, and their headers and pixels read again."""
    from ..raster import tiff

    k, folder = col("k"), scratch_folder(spark)
    size = ((k % 7 + 4) * (k % 5 + 3)).cast("int")
    made = nations(spark, d).select("name", F.lit(1).alias("bands"), (k % 5 + 3).cast("int").alias("rows"), (k % 7 + 4).cast("int").alias("cols"), F.array(k * 100.0, F.lit(10.0), F.lit(0.0), 7000 - k * 50.0, F.lit(0.0), F.lit(-10.0)).alias("affine"), F.unhex(F.repeat(F.lpad(F.hex(k), 2, "0"), size)).alias("pixels"), F.lit("ESRI:102009").alias("crs"), F.lit(None).alias("nodata"))
    paths = tiff.write_rasters(made, folder).select(F.monotonically_increasing_id().cast("int").alias("ordinal"), "path")
    files = tiff.read_rasters(spark, paths).persist()
    total = F.aggregate(F.transform(F.filter(F.split(F.regexp_replace(F.hex("pixels"), "(..)", "$1 "), " "), lambda x: x != ""), lambda x: F.conv(x, 16, 10).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    sums = tiff.read_blocks(files, 4).groupBy("path").agg(F.sum(total).alias("total"))
    name = F.regexp_extract("path", "([^/]*)[.]tif$", 1)
    return files.join(sums, "path").select(name.alias("name"), "width", "height", "bounds.min_x", "bounds.min_y", "bounds.max_x", "bounds.max_y", "total")


@query("SELECT e.event_id, year(ts) || '-Q' || quarter(ts) AS quarter, coalesce(n.n, 0) AS same FROM events e LEFT JOIN (SELECT year(ts) AS y, quarter(ts) AS q, count(*) AS n FROM events GROUP BY 1, 2) n ON n.y = year(e.ts) AND n.q = quarter(e.ts)")
def events_of_quarter(spark, d):
    e = carriers.table(spark, d, "events").select("event_id", measures.quarter_of(col("ts")).alias("quarter"))
    return e.join(e.groupBy("quarter").agg(F.count("*").alias("same")), "quarter").select("event_id", "quarter", "same")

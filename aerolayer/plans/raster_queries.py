"""Driver queries of the grid, geometry and raster paths, and DuckDB SQL that computes them another way."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ..functions import grid, projection, rings, tone
from ..functions.projection import from_lambert, to_lambert
from ..operators import scenes, spatial
from ..raster import kernels, longform
from ..sinks.archive import directory_rows, entries_of
from ..sources import coverage
from . import carriers
from .record_queries import LCC, POINTS

QUERIES, SQL = {}, {}
LADDER = [2560.0, 640.0, 160.0]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


BOXES = """WITH bx AS (SELECT n_nationkey AS id, n_regionkey AS region, n_nationkey * 200000.0::DOUBLE - 2500000.0 AS x0, (n_nationkey % 5) * 100000.0::DOUBLE - 1000000.0 AS y0,
  n_nationkey * 200000.0::DOUBLE - 2500000.0 + 450000.0 + n_nationkey * 1000.0 AS x1, (n_nationkey % 5) * 100000.0::DOUBLE - 1000000.0 + 320000.0 AS y1 FROM nation),
lad AS (SELECT * FROM (VALUES (0, 2560.0::DOUBLE), (1, 640.0::DOUBLE), (2, 160.0::DOUBLE)) v(z, res)),
ox AS (SELECT min(x0) AS ox, max(y1) AS oy FROM bx),
rg AS (SELECT *, CAST(floor((x0 - ox) / (512 * res)) AS BIGINT) AS xa, CAST(ceil((x1 - ox) / (512 * res)) AS BIGINT) - 1 AS xb, CAST(floor((oy - y1) / (512 * res)) AS BIGINT) AS ya, CAST(ceil((oy - y0) / (512 * res)) AS BIGINT) - 1 AS yb FROM bx, lad, ox),
specs AS (SELECT id, z, res, ox, oy, x, y FROM rg, LATERAL (SELECT unnest(generate_series(xa, xb)) AS x) a, LATERAL (SELECT unnest(generate_series(ya, yb)) AS y) b) """


def placed_boxes(spark, d):
    """Boxes, and the upper left corner of all of them."""
    b = carriers.boxes(spark, d)
    total = spatial.aggregate_bounds(b, "b").select(F.struct(col("min_x").alias("x"), col("max_y").alias("y")).alias("o"))
    return b.crossJoin(total)


def specs(spark, d):
    return grid.tile_specs(placed_boxes(spark, d), "b", LADDER, col("o"))


@query(BOXES + "SELECT id, z, xa AS x_min, ya AS y_min, xb AS x_max, yb AS y_max FROM rg")
def tile_index(spark, d):
    b = placed_boxes(spark, d).select("*", F.posexplode(grid.ladder(LADDER)).alias("z", "res"))
    return b.select("id", "z", grid.index_range(col("b"), col("o"), col("res")).alias("r")).select("id", "z", "r.x_min", "r.y_min", "r.x_max", "r.y_max")


@query(BOXES + "SELECT id, z, x, y, ox + x * 512 * res AS min_x, oy - y * 512 * res AS max_y FROM specs")
def tile_enumerate(spark, d):
    return specs(spark, d).select("id", "z", "x", "y", col("tile.min_x").alias("min_x"), col("tile.max_y").alias("max_y"))


@query(
    "WITH " + POINTS + LCC + f""", lad AS (SELECT unnest([0, 1, 2, 3, 4, 5, 6, 7]) AS z, unnest({grid.RESOLUTIONS}) AS res)
SELECT z, CAST(floor((x - ({grid.EXTENT[0]})) / (512 * res)) AS BIGINT) AS x, CAST(floor(({grid.EXTENT[3]} - y) / (512 * res)) AS BIGINT) AS y, count(*) AS n FROM lcc, lad GROUP BY 1, 2, 3"""
)
def tile_point_bucket(spark, d):
    """Customers per tile of every level of the full grid."""
    p = carriers.points(spark, d).select(to_lambert(col("lon"), col("lat")).alias("p")).select("p", F.posexplode(grid.ladder(grid.RESOLUTIONS)).alias("z", "res"))
    x0, y0 = grid.full_extent_origin()
    span = col("res") * 512
    p = p.select("z", F.floor((col("p.x") - F.lit(x0)) / span).cast("long").alias("x"), F.floor((F.lit(y0) - col("p.y")) / span).cast("long").alias("y"))
    return p.groupBy("z", "x", "y").agg(F.count("*").alias("n"))


@query(
    """WITH RECURSIVE t AS (SELECT p_partkey AS k, CAST(p_partkey % 7 AS BIGINT) AS z, CAST(p_partkey * 13 % (1 << CAST(p_partkey % 7 AS INT)) AS BIGINT) AS x, CAST(p_partkey * 29 % (1 << CAST(p_partkey % 7 AS INT)) AS BIGINT) AS y FROM part),
h AS (SELECT k, z, x AS x0, y AS y0, CAST((pow(4, z) - 1) / 3 AS BIGINT) AS acc, x, y, z - 1 AS lv FROM t
  UNION ALL SELECT k, z, x0, y0, acc + CAST((s * CASE WHEN rx > 0 AND ry > 0 THEN 2 WHEN rx > 0 THEN 3 WHEN ry > 0 THEN 1 ELSE 0 END) * s AS BIGINT),
    CASE WHEN ry = 0 THEN (CASE WHEN rx > 0 THEN s - 1 - y ELSE y END) ELSE x END, CASE WHEN ry = 0 THEN (CASE WHEN rx > 0 THEN s - 1 - x ELSE x END) ELSE y END, lv - 1
  FROM (SELECT *, (1 << CAST(lv AS INT)) AS s, x & (1 << CAST(lv AS INT)) AS rx, y & (1 << CAST(lv AS INT)) AS ry FROM h WHERE lv >= 0))
SELECT k, z, x0 AS x, y0 AS y, acc AS tile_id FROM h WHERE lv = -1"""
)
def pmtiles_tile_id(spark, d):
    k, z = col("p_partkey"), (col("p_partkey") % 7)
    side = F.pow(F.lit(2.0), z).cast("long")
    p = carriers.table(spark, d, "part").select(k.alias("k"), z.alias("z"), (k * 13 % side).alias("x"), (k * 29 % side).alias("y"))
    return p.withColumn("tile_id", grid.tile_id(col("z").cast("int"), col("x"), col("y")))


@query(
    BOXES + """, req AS (SELECT *, CASE WHEN greatest(x, y) = 0 THEN 0 ELSE length(ltrim(bin(greatest(x, y)), '0')) END AS need FROM specs), off AS (SELECT greatest(0, max(greatest(z, need) - z)) AS o FROM req)
SELECT z, CAST(o AS INT) AS zoom_offset, CAST(z + o AS INT) AS archive_z, count(*) AS tiles FROM req, off GROUP BY ALL"""
)
def pmtiles_zoom_map(spark, d):
    return grid.with_archive_zoom(specs(spark, d)).groupBy("z", "zoom_offset", "archive_z").agg(F.count("*").alias("tiles"))


@query(
    """WITH t AS (SELECT DISTINCT o_orderkey * 3 % 50021 AS tile_id FROM orders), l AS (SELECT tile_id, CAST(100 + tile_id % 900 AS BIGINT) AS length FROM t),
e AS (SELECT *, CAST(coalesce(sum(length) OVER (ORDER BY tile_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS offset_bytes FROM l)
SELECT tile_id, offset_bytes, length, tile_id - lag(tile_id, 1, 0) OVER (ORDER BY tile_id) AS id_delta, CASE WHEN row_number() OVER (ORDER BY tile_id) = 1 THEN 1::BIGINT ELSE 0::BIGINT END AS stored_offset, (row_number() OVER (ORDER BY tile_id) - 1) // 4096 AS leaf FROM e"""
)
def pmtiles_directory(spark, d):
    t = carriers.table(spark, d, "orders").select((col("o_orderkey") * 3 % 50021).alias("tile_id")).distinct().withColumn("length", 100 + col("tile_id") % 900)
    return directory_rows(entries_of(t)).select("tile_id", col("offset").alias("offset_bytes"), "length", "id_delta", "stored_offset", "leaf")


GRIDS = """WITH RECURSIVE px AS (SELECT vec_id, CAST(i // 8 AS INT) AS r, CAST(i % 8 AS INT) AS c, CAST(embedding[i + 1] AS DOUBLE) AS v FROM embeddings, LATERAL (SELECT unnest(range(64)) AS i) s) """


@query(GRIDS + "SELECT label AS z, count(*) AS total, count(*) FILTER (m > 0.25) AS rendered, count(*) FILTER (NOT m > 0.25) AS empty FROM (SELECT label, list_max(embedding) AS m FROM embeddings) GROUP BY ROLLUP (label)")
def tile_level_stats(spark, d):
    t = carriers.table(spark, d, "embeddings").select(col("label").alias("z"), F.exists("embedding", lambda a: a > 0.25).alias("has_data"))
    return scenes.level_stats(t)


CORNERS = """WITH c AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 6 = 0 THEN 176.0::DOUBLE ELSE 150.0 - n_nationkey * 4 END AS w, CASE WHEN n_nationkey % 6 = 0 THEN 183.0::DOUBLE ELSE 156.0 - n_nationkey * 4 END AS e,
  n_nationkey % 30 + 20 + n_nationkey * 2 / 60.0::DOUBLE AS s, n_nationkey % 30 + 24 + n_nationkey * 2 / 60.0::DOUBLE AS n, 'CHART ' || n_name AS chart FROM nation) """


@query(
    CORNERS + """SELECT k AS id, chart, CASE WHEN e > 180 THEN 'MultiPolygon' ELSE 'Polygon' END AS type, 0 AS part, w AS min_lon, least(e, 180.0) AS max_lon, round(s, 9) AS min_lat, round(n, 9) AS max_lat, round((least(e, 180.0) - w) * (n - s), 6) AS area, 5 AS vertices FROM c
UNION ALL SELECT k, chart, 'MultiPolygon', 1, -180.0, e - 360, round(s, 9), round(n, 9), round((e - 180) * (n - s), 6), 5 FROM c WHERE e > 180"""
)
def dms_polygon(spark, d):
    headers = ["Chart", "SW N", "NW N", "SE N", "NE N", "SW W", "NW W", "SE W", "NE W"]
    f = coverage.chart_features(coverage.table_rows(carriers.corners(spark, d), headers))
    f = f.select("id", "chart", col("geom_type").alias("type"), F.posexplode("polygons").alias("part", "ring"))
    lons, lats = F.transform("ring", lambda p: p["lon"]), F.transform("ring", lambda p: p["lat"])
    area = rings.signed_area(F.slice("ring", F.lit(1), F.size("ring") - 1))
    return f.select("id", "chart", "type", "part", F.array_min(lons).alias("min_lon"), F.array_max(lons).alias("max_lon"), F.round(F.array_min(lats), 9).alias("min_lat"), F.round(F.array_max(lats), 9).alias("max_lat"), F.round(area, 6).alias("area"), F.size("ring").alias("vertices"))


@query("SELECT c_custkey AS id, round(((0 * (c_custkey % 5) - a * 0) + (a * b - (a + 1) * (c_custkey % 5)) + ((a + 1) * (b + 2) - 0 * b) + (0 * 0 - 0 * (b + 2))) / 2.0::DOUBLE, 6) AS area FROM (SELECT c_custkey, CAST(c_custkey % 17 + 1 AS DOUBLE) AS a, CAST(c_custkey % 11 + 3 AS DOUBLE) AS b FROM customer)")
def ring_area(spark, d):
    k = col("c_custkey")
    a, b, s = (k % 17 + 1).cast("double"), (k % 11 + 3).cast("double"), (k % 5).cast("double")
    z = F.lit(0.0)
    ring = F.array(rings.point(z, z), rings.point(a, s), rings.point(a + 1, b), rings.point(z, b + 2))
    return carriers.table(spark, d, "customer").select(k.alias("id"), F.round(rings.signed_area(ring), 6).alias("area"))


@query(BOXES + "SELECT region, min(x0) AS min_x, min(y0) AS min_y, max(x1) AS max_x, max(y1) AS max_y FROM bx GROUP BY region")
def bounds_agg(spark, d):
    return spatial.aggregate_bounds(carriers.boxes(spark, d), "b", "region")


@query(BOXES + "SELECT a.id AS a, b.id AS b FROM bx a, bx b WHERE a.id < b.id AND NOT (a.x1 <= b.x0 OR a.x0 >= b.x1 OR a.y1 <= b.y0 OR a.y0 >= b.y1)")
def boxes_intersect(spark, d):
    b = carriers.boxes(spark, d)
    one, two = b.select(col("id").alias("a"), col("b").alias("ba")), b.select(col("id").alias("b"), col("b").alias("bb"))
    return spatial.boxes_that_intersect(one, two, "ba", "bb", 250000.0, col("a") < col("b")).select("a", "b")


@query(
    """WITH p AS (SELECT c_custkey AS id, -124.0::DOUBLE + (c_custkey % 5700) / 100.0::DOUBLE AS x, 25.0::DOUBLE + (c_custkey % 2300) / 100.0::DOUBLE AS y FROM customer),
g AS (SELECT r_regionkey AS g, -121.037::DOUBLE + r_regionkey * 10 AS cx, 36.513::DOUBLE + r_regionkey AS cy FROM region)
SELECT id, g AS region FROM p, g WHERE abs(x - cx) / 6.0 + abs(y - cy) / 5.0 < 1"""
)
def point_in_region(spark, d):
    """Customers in five lozenges."""
    r = carriers.table(spark, d, "region")
    cx, cy = F.lit(-121.037) + col("r_regionkey") * 10, F.lit(36.513) + col("r_regionkey")
    ring = F.array(rings.point(cx - 6, cy), rings.point(cx, cy - 5), rings.point(cx + 6, cy), rings.point(cx, cy + 5))
    found = spatial.points_in_polygons(carriers.points(spark, d), r.select(col("r_regionkey").alias("region"), F.array(ring).alias("rings")), "lon", "lat", "rings", 2.0)
    return found.select("id", "region")


@query(
    BOXES + """, st AS (SELECT unnest(range(5)) AS i), p AS (SELECT id, x0 + (x1 - x0) * i / 4.0::DOUBLE AS x, y0 AS y FROM bx, st UNION ALL SELECT id, x1, y0 + (y1 - y0) * i / 4.0::DOUBLE FROM bx, st WHERE i >= 1
  UNION ALL SELECT id, x1 - (x1 - x0) * i / 4.0::DOUBLE, y1 FROM bx, st WHERE i >= 1 UNION ALL SELECT id, x0, y0 + (y1 - y0) * i / 4.0::DOUBLE FROM bx, st WHERE i BETWEEN 1 AND 3 UNION ALL SELECT id, x0, y0 FROM bx)
SELECT id, round(x, 3) AS x, round(y, 3) AS y, count(*) AS n FROM p GROUP BY ALL"""
)
def densify(spark, d):
    p = carriers.boxes(spark, d).select("id", F.explode(rings.densify(col("b"), 5)).alias("p"))
    return p.select("id", F.round("p.x", 3).alias("x"), F.round("p.y", 3).alias("y")).groupBy("id", "x", "y").agg(F.count("*").alias("n"))


def inverse_sql() -> str:
    """Degrees of projected points p(id, x, y), by as many fixed-point steps as it takes."""
    step = lambda f: f"pi() / 2 - 2 * atan(t * pow((1 - e * sin({f})) / (1 + e * sin({f})), e / 2))"
    out = f"""u AS (SELECT id, {projection.E!r}::DOUBLE AS e, atan2(x, {projection.RHO0!r}::DOUBLE - y) AS th, pow(sqrt(x * x + pow({projection.RHO0!r}::DOUBLE - y, 2)) / {projection.SCALE!r}::DOUBLE, 1 / {projection.N!r}::DOUBLE) AS t FROM p),
f0 AS (SELECT *, pi() / 2 - 2 * atan(t) AS f FROM u)"""
    for i in range(6):
        out += f", f{i + 1} AS (SELECT * REPLACE ({step('f')} AS f) FROM f{i})"
    return out + f", ll AS (SELECT id, degrees(th) / {projection.N!r}::DOUBLE - 96.0 AS lon, degrees(f) AS lat FROM f6) "


@query(
    BOXES + """, st AS (SELECT unnest(range(22)) AS i), p AS (SELECT id, x0 + (x1 - x0) * i / 21.0::DOUBLE AS x, y0 AS y FROM bx, st UNION ALL SELECT id, x0 + (x1 - x0) * i / 21.0::DOUBLE, y1 FROM bx, st
  UNION ALL SELECT id, x0, y0 + (y1 - y0) * i / 21.0::DOUBLE FROM bx, st UNION ALL SELECT id, x1, y0 + (y1 - y0) * i / 21.0::DOUBLE FROM bx, st), """
    + inverse_sql()
    + "SELECT id, round(min(lon), 6) AS min_x, round(min(lat), 6) AS min_y, round(max(lon), 6) AS max_x, round(max(lat), 6) AS max_y FROM ll GROUP BY id"
)
def bounds_to_wgs84(spark, d):
    """Boxes in degrees, from 22 points on each side."""
    p = carriers.boxes(spark, d).select("id", rings.densify(col("b"), 22).alias("ps"))
    p = p.select("id", F.transform("ps", lambda q: from_lambert(q["x"], q["y"])).alias("ll"))
    return p.select("id", rings.bounds_of_points(col("ll"), "lon", "lat").alias("b")).select("id", *[F.round(f"b.{c}", 6).alias(c) for c in ("min_x", "min_y", "max_x", "max_y")])


@query(GRIDS + "SELECT vec_id, r AS row, c AS col, CASE WHEN v * 100 < 5 OR v <= 0 THEN 0 ELSE CAST(least(greatest(ceil(v * 100), 1), 255) AS INT) END AS l, CASE WHEN v * 100 < 5 OR v <= 0 THEN 0 ELSE 255 END AS a FROM px")
def raster_threshold(spark, d):
    g = carriers.grids(spark, d).withColumn("p", tone.luminance_alpha(tone.threshold(col("v") * 100, 5.0)))
    return g.select("vec_id", "row", "col", "p.l", "p.a")


def smooth_sql(k: int) -> str:
    return GRIDS + f""", off AS (SELECT unnest(range({-(k // 2)}, {k - k // 2})) AS o)
SELECT a.vec_id, a.r AS row, a.c AS col, round(avg(b.v), 6) AS v FROM px a, off dy, off dx, px b WHERE b.vec_id = a.vec_id AND b.r = least(greatest(a.r + dy.o, 0), 7) AND b.c = least(greatest(a.c + dx.o, 0), 7) GROUP BY 1, 2, 3"""


def smoothed(spark, d, k):
    return longform.box_mean(carriers.grids(spark, d), ["vec_id"], k).select("vec_id", "row", "col", F.round("v", 6).alias("v"))


@query(smooth_sql(3))
def raster_smooth_k3(spark, d):
    return smoothed(spark, d, 3)


@query(smooth_sql(4))
def raster_smooth_k4(spark, d):
    return smoothed(spark, d, 4)


@query(
    GRIDS + """, n AS (SELECT a.vec_id, a.r, a.c, sum(b.v * (w.dx * (2 - abs(w.dy)))) AS gx, sum(b.v * (w.dy * (2 - abs(w.dx)))) AS gy FROM px a, (SELECT y.o AS dy, x.o AS dx FROM (SELECT unnest([-1, 0, 1]) AS o) y, (SELECT unnest([-1, 0, 1]) AS o) x) w, px b
  WHERE b.vec_id = a.vec_id AND b.r = least(greatest(a.r + w.dy, 0), 7) AND b.c = least(greatest(a.c + w.dx, 0), 7) GROUP BY 1, 2, 3)
SELECT vec_id, r AS row, c AS col, round(degrees(atan(sqrt(gx * gx + gy * gy) / 8)), 6) AS slope FROM n"""
)
def raster_slope(spark, d):
    return longform.slope(carriers.grids(spark, d), ["vec_id"]).select("vec_id", "row", "col", F.round("v", 6).alias("slope"))


TONE = """WITH n AS (SELECT row_number() OVER () AS rid, * FROM lineitem), t AS (SELECT rid, l_orderkey, l_linenumber, unnest([0, 1, 2]) AS b, unnest([l_partkey * 3 % 4000, l_partkey * 5 % 4000, l_partkey * 7 % 4000]) AS dn FROM n),
c AS (SELECT *, least(1.0::DOUBLE, dn / 10000.0::DOUBLE / 3.0) AS x, 0.13::DOUBLE / 3.0 AS m FROM t), s AS (SELECT *, x * (x * m - 1) / (x * (2 * m - 1) - m) AS y FROM c),
g AS (SELECT *, (pow(y + 0.01::DOUBLE, 1.8) - pow(0.01::DOUBLE, 1.8)) / (pow(1.01::DOUBLE, 1.8) - pow(0.01::DOUBLE, 1.8)) AS q FROM s),
k AS (SELECT *, greatest(0.0, least(1.0, avg(q) OVER (PARTITION BY rid) * (1 - 1.15::DOUBLE) + q * 1.15::DOUBLE)) AS u FROM g),
o AS (SELECT *, CAST(floor(least(255.0, 255 * CASE WHEN u <= 0.0031308 THEN u * 12.92 ELSE 1.055 * pow(u, 1 / 2.4::DOUBLE) - 0.055 END)) AS INT) AS v FROM k) """


@query(TONE + "SELECT l_orderkey, l_linenumber, max(v) FILTER (b = 0) AS r, max(v) FILTER (b = 1) AS g, max(v) FILTER (b = 2) AS b, max(CASE WHEN dn <> 0 THEN 255 ELSE 0 END) AS a FROM o GROUP BY rid, l_orderkey, l_linenumber")
def true_color(spark, d):
    k = col("l_partkey")
    rgb = tone.true_color(k * 3 % 4000, k * 5 % 4000, k * 7 % 4000)
    return carriers.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", rgb.alias("p")).select("l_orderkey", "l_linenumber", "p.r", "p.g", "p.b", "p.a")


@query("SELECT l_orderkey, l_linenumber, coalesce(n_nationkey * 10, 0) AS r, coalesce(n_nationkey * 5, 0) AS g, coalesce(n_nationkey, 0) AS b, CASE WHEN n_nationkey IS NULL THEN 0 WHEN n_nationkey % 2 = 0 THEN 255 ELSE 128 END AS a FROM lineitem LEFT JOIN nation ON n_nationkey = l_partkey % 32")
def palette_apply(spark, d):
    k = col("n_nationkey")
    palette = carriers.table(spark, d, "nation").select(k.alias("index"), (k * 10).alias("r"), (k * 5).alias("g"), k.alias("b"), F.when(k % 2 == 1, 128).alias("a"))
    px = carriers.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (col("l_partkey") % 32).cast("int").alias("index"))
    return longform.apply_palette(px, palette).select("l_orderkey", "l_linenumber", "r", "g", "b", "a")


QUANTIZED = GRIDS + ", q AS (SELECT vec_id, r, c, CAST(floor(v * 10) AS INT) AS v FROM px) "


def quantized(spark, d):
    return carriers.grids(spark, d).withColumn("v", F.floor(col("v") * 10).cast("int"))


@query(
    QUANTIZED + """, e AS (SELECT vec_id, v, sum((r < 2)::INT + (r > 5)::INT + (c < 2)::INT + (c > 5)::INT) AS n FROM q WHERE r < 2 OR r > 5 OR c < 2 OR c > 5 GROUP BY 1, 2)
SELECT vec_id, arg_max(v, n * 100000 - v) AS background FROM e GROUP BY 1"""
)
def edge_mode(spark, d):
    return longform.edge_mode(quantized(spark, d), ["vec_id"], 2)


@query(
    GRIDS + """, rw AS (SELECT vec_id, r FROM px GROUP BY 1, 2 HAVING count(*) FILTER (v <= 0) >= 4), cl AS (SELECT vec_id, c FROM px GROUP BY 1, 2 HAVING count(*) FILTER (v <= 0) >= 4)
SELECT e.vec_id, a.t AS top, a.b AS bottom, x.l AS "left", x.r AS "right" FROM embeddings e LEFT JOIN (SELECT vec_id, CASE WHEN count(*) > 1 THEN min(r) END AS t, CASE WHEN count(*) > 1 THEN max(r) END AS b FROM rw GROUP BY 1) a USING (vec_id)
LEFT JOIN (SELECT vec_id, CASE WHEN count(*) > 1 THEN min(c) END AS l, CASE WHEN count(*) > 1 THEN max(c) END AS r FROM cl GROUP BY 1) x USING (vec_id)"""
)
def neatline(spark, d):
    return longform.neatline(carriers.grids(spark, d), ["vec_id"], col("v") <= 0, 0.6)


@query(
    GRIDS + """, m AS (SELECT vec_id, r, c, v > 0 AS p FROM px), near AS (SELECT a.vec_id, a.r, a.c, bool_or(b.p) AS dil, bool_and(b.p) AS ero FROM m a JOIN m b ON a.vec_id = b.vec_id AND abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 GROUP BY 1, 2, 3),
cl AS (SELECT a.vec_id, a.r, a.c, bool_and(b.dil) AS closed FROM near a JOIN near b ON a.vec_id = b.vec_id AND abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 GROUP BY 1, 2, 3)
SELECT vec_id, r AS row, c AS col, dil AS dilated, ero AS eroded, closed FROM near JOIN cl USING (vec_id, r, c)"""
)
def morphology(spark, d):
    m, key = carriers.masks(spark, d).select("vec_id", "row", "col", "on"), ["vec_id", "row", "col"]
    out = longform.dilate(m, ["vec_id"]).withColumnRenamed("on", "dilated")
    out = out.join(longform.erode(m, ["vec_id"]).withColumnRenamed("on", "eroded"), key)
    return out.join(longform.close(m, ["vec_id"], 1).withColumnRenamed("on", "closed"), key)


LABELS = GRIDS + """, m AS (SELECT vec_id, r * 8 + c AS i, r, c FROM px WHERE v > 0),
fl(vec_id, i, root) AS (SELECT vec_id, i, i FROM m UNION SELECT b.vec_id, b.i, fl.root FROM fl JOIN m a ON a.vec_id = fl.vec_id AND a.i = fl.i JOIN m b ON b.vec_id = a.vec_id AND abs(a.r - b.r) + abs(a.c - b.c) = 1 AND fl.root < b.i),
lab AS (SELECT m.vec_id, m.i, m.r, m.c, min(root) AS root FROM fl JOIN m USING (vec_id, i) GROUP BY 1, 2, 3, 4),
num AS (SELECT vec_id, root, row_number() OVER (PARTITION BY vec_id ORDER BY root) AS label FROM (SELECT DISTINCT vec_id, root FROM lab)) """


def labelled(spark, d):
    return kernels.per_raster(carriers.masks(spark, d), ["vec_id"], "on", lambda a: {"label": kernels.labels(a)}, "label long").where("label > 0")


@query(LABELS + "SELECT vec_id, label, count(*) AS area, min(r) AS min_row, min(c) AS min_col, max(r) AS max_row, max(c) AS max_col, round(count(*) / ((max(r) - min(r) + 1) * (max(c) - min(c) + 1))::DOUBLE, 6) AS fill_ratio FROM lab JOIN num USING (vec_id, root) GROUP BY 1, 2")
def components(spark, d):
    s = longform.component_stats(labelled(spark, d), ["vec_id"])
    return s.select("vec_id", "label", "area", "min_row", "min_col", "max_row", "max_col", F.round("fill_ratio", 6).alias("fill_ratio"))


@query(LABELS + "SELECT vec_id, arg_max(label, area * 1000 - label) AS label, max(area) AS area FROM (SELECT vec_id, label, count(*) AS area FROM lab JOIN num USING (vec_id, root) GROUP BY 1, 2) GROUP BY 1")
def largest_component(spark, d):
    s = longform.component_stats(labelled(spark, d), ["vec_id"])
    return longform.largest_component(s, ["vec_id"]).join(s.groupBy("vec_id").agg(F.max("area").alias("area")), "vec_id")


EXT = dict(min_area=2, max_area_ratio=0.5, max_fill=0.8, max_thickness=1, gap=0)


@query(
    LABELS + """, st AS (SELECT vec_id, label, count(*) AS area, min(r) AS t, min(c) AS l, max(r) AS b, max(c) AS rt FROM lab JOIN num USING (vec_id, root) GROUP BY 1, 2),
core AS (SELECT s.* FROM st s JOIN (SELECT vec_id, arg_max(label, area * 1000 - label) AS label FROM st GROUP BY 1) USING (vec_id, label)),
x AS (SELECT s.vec_id, row_number() OVER (PARTITION BY s.vec_id ORDER BY s.label) - 1 AS id, s.area, greatest(1, CAST(floor(k.area * 0.5) AS INT)) AS most, s.area / ((s.b - s.t + 1) * (s.rt - s.l + 1))::DOUBLE AS fill, least(s.b - s.t, s.rt - s.l) + 1 AS thick,
  greatest(0, k.t - s.t) AS n, greatest(0, s.b - k.b) AS so, greatest(0, k.l - s.l) AS w, greatest(0, s.rt - k.rt) AS e FROM st s JOIN core k ON s.vec_id = k.vec_id AND s.label <> k.label)
SELECT vec_id, id, area, CASE WHEN area < 2 THEN 'below_min_area' WHEN area > most THEN 'above_max_area' WHEN fill > 0.8 AND thick > 1 THEN 'above_fill_ratio' WHEN n > 1 THEN 'above_overhang_north' WHEN so > 1 THEN 'above_overhang_south'
  WHEN w > 2 THEN 'above_overhang_west' WHEN e > 2 THEN 'above_overhang_east' ELSE 'not_attached_to_core' END AS reason FROM x"""
)
def extension_select(spark, d):
    """Components besides the largest, with the reason each is no extension of it (without a gap none touches)."""
    import numpy as np
    import pyarrow as pa

    options = kernels.MaskOptions(**EXT, overhang={"north": 1, "south": 1, "west": 2, "east": 2})

    def run(t: pa.Table) -> pa.Table:
        a = np.zeros((8, 8), bool)
        a[t.column("row").to_numpy(), t.column("col").to_numpy()] = t.column("on").to_numpy()
        report = kernels.extensions(a, kernels.largest(a), options)[1] if a.any() else []
        key = pa.array([t.column("vec_id")[0].as_py()] * len(report), pa.int64())
        return pa.table([key, *(pa.array([r[k] for r in report], y) for k, y in (("id", pa.int64()), ("area", pa.int64()), ("reason", pa.string())))], ["vec_id", "id", "area", "reason"])

    return carriers.masks(spark, d).groupBy("vec_id").applyInArrow(run, "vec_id long, id long, area long, reason string")


@query(
    GRIDS + """, m AS (SELECT vec_id, r, c FROM px WHERE v > 0), fl(vec_id, r, c) AS (SELECT vec_id, r, c FROM m WHERE r IN (0, 7) OR c IN (0, 7) UNION SELECT m.vec_id, m.r, m.c FROM fl JOIN m ON m.vec_id = fl.vec_id AND abs(m.r - fl.r) + abs(m.c - fl.c) = 1)
SELECT vec_id, r AS row, c AS col FROM fl"""
)
def flood_fill(spark, d):
    return kernels.per_raster(carriers.masks(spark, d), ["vec_id"], "on", lambda a: {"outside": kernels.outside(a)}, "outside boolean").where("outside").drop("outside")


@query(
    GRIDS + """, m AS (SELECT vec_id, r, c, r * 8 + c AS i FROM px WHERE v > 0) SELECT vec_id, CAST(arg_min(i, (r + c) * 64 + i) AS BIGINT) AS nw, CAST(arg_min(i, (r - c) * 64 + i) AS BIGINT) AS ne, CAST(arg_min(i, (-r - c) * 64 + i) AS BIGINT) AS se, CAST(arg_min(i, (c - r) * 64 + i) AS BIGINT) AS sw FROM m GROUP BY 1"""
)
def corner_points(spark, d):
    c = longform.corner_points(carriers.masks(spark, d), ["vec_id"])
    return c.select("vec_id", *[(col(f"{k}.row") * 8 + col(f"{k}.col")).cast("long").alias(k) for k in ("nw", "ne", "se", "sw")])


@query(GRIDS + "SELECT label, r AS row, c AS col, arg_max(v, vec_id) AS last_v, arg_min(v, vec_id) AS first_v FROM px JOIN embeddings USING (vec_id) GROUP BY 1, 2, 3")
def scene_overlay(spark, d):
    g = carriers.grids(spark, d).join(carriers.table(spark, d, "embeddings").select("vec_id", "label"), "vec_id")
    last = scenes.overlay(g, ["label", "row", "col"], "vec_id").withColumnRenamed("v", "last_v").drop("vec_id")
    first = scenes.overlay(g, ["label", "row", "col"], "vec_id", "first").withColumnRenamed("v", "first_v").drop("vec_id")
    return last.join(first, ["label", "row", "col"])


@query(GRIDS + "SELECT vec_id, r AS row, c AS col FROM px WHERE abs(c + 0.5 - 4.2) + abs(r + 0.5 - 3.9) < 3")
def raster_clip(spark, d):
    g = carriers.grids(spark, d)
    p = lambda x, y: rings.point(F.lit(x), F.lit(y))
    ring = F.array(p(14.2, 93.1), p(17.2, 96.1), p(14.2, 99.1), p(11.2, 96.1))
    geo = F.array(*map(F.lit, [10.0, 1.0, 0.0, 100.0, 0.0, -1.0]))
    return longform.clip_to_polygon(g, geo, F.array(ring)).select("vec_id", "row", "col")


@query(GRIDS + "SELECT vec_id, r // 2 AS row, c // 2 AS col, v FROM px WHERE r % 2 = 1 AND c % 2 = 1")
def raster_downsample(spark, d):
    return longform.downsample(carriers.grids(spark, d), ["vec_id"], 4)


@query(GRIDS + "SELECT vec_id, r AS row, c AS col, v > 0 AND v2 > 0 AS inter, v > 0 OR v2 > 0 AS uni, v > 0 AND NOT v2 > 0 AS diff FROM (SELECT *, lag(v, 1, 0.0) OVER (PARTITION BY vec_id, r ORDER BY c) AS v2 FROM px)")
def mask_algebra(spark, d):
    """A mask and itself moved by a column: intersection, union, difference on equal cells."""
    m = carriers.masks(spark, d).select("vec_id", "row", "col", "on")
    moved = m.select("vec_id", "row", (col("col") + 1).alias("col"), col("on").alias("other"))
    both = m.join(moved, ["vec_id", "row", "col"], "left").withColumn("other", F.coalesce("other", F.lit(False)))
    return both.select("vec_id", "row", "col", (col("on") & col("other")).alias("inter"), (col("on") | col("other")).alias("uni"), (col("on") & ~col("other")).alias("diff"))


@query()
def tile_render(spark, d):
    """Embeddings as 8 x 8 rasters of 160 m pixels, drawn on their tiles as PNG."""
    from ..raster.render import pack, render_tiles

    g = carriers.grids(spark, d).withColumn("v", F.least(F.greatest(F.floor((col("v") + 1) * 127), F.lit(0)), F.lit(255))).withColumn("band", F.lit(0))
    r = pack(g, ["vec_id"]).withColumn("affine", F.array(*map(F.lit, [0.0, 160.0, 0.0, 1280.0, 0.0, -160.0]))).withColumn("nodata", F.lit(0))
    b = r.select("vec_id", grid.box(0, 0, 1280, 1280).alias("b"))
    s = grid.tile_specs(b, "b", [20.0], tile_size=64)
    return render_tiles(s, r, "vec_id", size=64).select("vec_id", "z", "x", "y", "has_data", F.length("data").alias("bytes"))

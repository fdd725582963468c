"""Driver queries of the record path, and DuckDB SQL that computes them from the original columns."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.functions import col

from ..functions import measures as m
from ..functions import projection, text
from ..functions.features import to_features
from ..operators import charts, packages, scenes
from ..sources import coverage, listing, navaids, obstacles, web
from ..sources.scenes import missing_keys
from . import carriers

QUERIES, SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


OBSTACLES = """WITH raw AS (SELECT o_orderkey AS k FROM orders),
ob AS (SELECT k, CASE WHEN k % 101 = 0 THEN 'lat minutes must be in [0, 59]' WHEN k % 103 = 0 THEN 'AGL height must be an integer'
    WHEN k % 97 = 0 THEN 'julian date must be a 7-digit numeric value' END AS err,
  lpad(CAST(k % 56 + 1 AS VARCHAR), 2, '0') AS oas, lpad(CAST(k % 1000000 AS VARCHAR), 6, '0') AS num,
  CASE WHEN k % 11 = 0 THEN 'MX' ELSE 'US' END AS country,
  CASE WHEN k % 11 = 0 THEN NULL ELSE (['UT', 'CO', 'NV', 'ID'])[CAST(k % 4 AS INT) + 1] END AS state,
  round((k % 24 + 25) + (k % 60) / 60.0 + ((k % 6000) / 100.0) / 3600.0, 8) AS lat,
  -round((k % 58 + 66) + (k * 7 % 60) / 60.0 + ((k * 13 % 6000) / 100.0) / 3600.0, 8) AS lon FROM raw) """


def parsed(spark, d):
    return obstacles.parse(carriers.obstacle_lines(spark, d))


@query(
    OBSTACLES
    + """SELECT k AS line_number, oas || '-' || num AS obstacle_id, CASE WHEN k % 2 = 0 THEN 'O' ELSE 'U' END AS verification, country, state,
  'CITY ' || (k % 50) AS city_name, lat AS latitude, lon AS longitude, (['TOWER', 'BLDG', 'POLE', 'WINDMILL'])[CAST(k % 4 AS INT) + 1] AS obstacle_type,
  CAST(CASE WHEN k % 5 = 0 THEN NULL ELSE 1 + k % 9 END AS INT) AS quantity, CAST(20 + k % 2000 AS INT) AS agl_ft, CAST(100 + k % 9000 AS INT) AS amsl_ft,
  round((20 + k % 2000) * 0.3048::DOUBLE, 3) AS agl_m,
  CASE WHEN k % 3 = 0 THEN NULL ELSE '2020ST' || lpad(CAST(k % 100000 AS VARCHAR), 5, '0') || 'OE' END AS study,
  CASE WHEN k % 2 = 0 THEN 'A' ELSE 'C' END AS action, CAST(2013001 + k % 365 AS VARCHAR) AS julian_date FROM ob WHERE err IS NULL"""
)
def obstacle_parse(spark, d):
    return obstacles.good(parsed(spark, d)).select(
        "line_number",
        F.concat_ws("-", "oas_code", "obstacle_number").alias("obstacle_id"),
        col("verification_status_code").alias("verification"),
        col("country_identifier").alias("country"),
        col("state_identifier").alias("state"),
        "city_name",
        "latitude",
        "longitude",
        "obstacle_type",
        "quantity",
        col("agl_height_ft").alias("agl_ft"),
        col("amsl_height_ft").alias("amsl_ft"),
        m.feet_to_meters(col("agl_height_ft")).alias("agl_m"),
        col("faa_study_number").alias("study"),
        "action",
        "julian_date",
    )


@query(OBSTACLES + "SELECT 'part-' || (k % 5) AS file, k AS line_number, 'part-' || (k % 5) || ':' || k || ': parse error: ' || err AS message FROM ob WHERE err IS NOT NULL")
def obstacle_errors(spark, d):
    return obstacles.errors(parsed(spark, d))


IN_STATES = "(coalesce(state, '') IN ('UT', 'NV', '03') OR country IN ('UT', 'NV', '03') OR oas IN ('UT', 'NV', '03'))"


@query(
    OBSTACLES
    + f"""SELECT 'part-' || (k % 5) AS file, count(*) AS scanned_record_lines, count(*) FILTER (err IS NULL AND {IN_STATES}) AS parsed_count,
  count(*) FILTER (err IS NULL AND NOT {IN_STATES}) AS skipped_by_state_count, count(*) FILTER (err IS NOT NULL) AS error_count FROM ob GROUP BY ROLLUP ('part-' || (k % 5))"""
)
def obstacle_summary(spark, d):
    return obstacles.summary(parsed(spark, d), ["ut ", "NV", "03"], "file")


@query(OBSTACLES + f"SELECT k AS line_number, state, country, oas FROM ob WHERE err IS NULL AND {IN_STATES}")
def obstacle_state_filter(spark, d):
    rows = obstacles.good(parsed(spark, d)).where(obstacles.in_states(["UT", "nv", " 03", ""]))
    return rows.select("line_number", col("state_identifier").alias("state"), col("country_identifier").alias("country"), col("oas_code").alias("oas"))


def cases(code: str, values: dict, part: int | None, default: str) -> str:
    shown = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else f"'{v}'"
    return f"CASE {code} " + " ".join(f"WHEN '{k}' THEN {shown(v if part is None else v[part])}" for k, v in values.items()) + f" ELSE {default} END"


@query(
    OBSTACLES
    + f""", c AS (SELECT k, CASE WHEN k % 7 = 0 THEN '' ELSE substr('RDHMSFCWLN', CAST(k % 10 AS INT) + 1, 1) END AS lc, CAST(k % 9 + 1 AS VARCHAR) AS hc,
  substr('ABCDEFGHI', CAST(k % 9 AS INT) + 1, 1) AS vc, substr('MPFLRWK', CAST(k % 7 AS INT) + 1, 1) AS mc FROM ob WHERE err IS NULL)
SELECT k AS line_number, {cases("lc", m.LIGHTING, None, "'Unknown'")} AS lighting, {cases("hc", m.HORIZONTAL_ACCURACY, 0, "'Unknown'")} AS horizontal,
  CAST({cases("hc", m.HORIZONTAL_ACCURACY, 1, "NULL")} AS INT) AS horizontal_ft, {cases("vc", m.VERTICAL_ACCURACY, 0, "'Unknown'")} AS vertical,
  round({cases("vc", m.VERTICAL_ACCURACY, 1, "NULL")} * 0.3048::DOUBLE, 3) AS vertical_m, {cases("mc", m.MARKING, None, "'Unknown'")} AS marking,
  CASE WHEN k % 2 = 0 THEN 'Verified' ELSE 'Unverified' END AS verification FROM c"""
)
def obstacle_decode(spark, d):
    n = obstacles.normalize(obstacles.good(parsed(spark, d)))
    return n.select(
        col("source.line_number").alias("line_number"),
        col("lighting.description").alias("lighting"),
        col("horizontal_accuracy.description").alias("horizontal"),
        col("horizontal_accuracy.feet").alias("horizontal_ft"),
        col("vertical_accuracy.description").alias("vertical"),
        col("vertical_accuracy.meters").alias("vertical_m"),
        col("mark_indicator.description").alias("marking"),
        col("verification_status.description").alias("verification"),
    )


LCC = f"""phi AS (SELECT *, radians(lat) AS p, {projection.E!r}::DOUBLE AS e FROM pts),
tt AS (SELECT *, tan(pi() / 4 - p / 2) / pow((1 - e * sin(p)) / (1 + e * sin(p)), e / 2) AS t, {projection.N!r}::DOUBLE * (radians(lon) - radians(-96.0::DOUBLE)) AS th FROM phi),
xy AS (SELECT *, {projection.SCALE!r}::DOUBLE * pow(t, {projection.N!r}::DOUBLE) AS rho FROM tt),
lcc AS (SELECT *, rho * sin(th) AS x, {projection.RHO0!r}::DOUBLE - rho * cos(th) AS y FROM xy) """
POINTS = "pts AS (SELECT c_custkey AS id, -124.0::DOUBLE + (c_custkey % 5700) / 100.0::DOUBLE AS lon, 25.0::DOUBLE + (c_custkey % 2300) / 100.0::DOUBLE AS lat FROM customer), "


@query(OBSTACLES + ", pts AS (SELECT k, lon, lat FROM ob WHERE err IS NULL), " + LCC + "SELECT k AS line_number, 'Feature' AS type, 'Point' AS geometry_type, round(x, 3) AS x, round(y, 3) AS y, round((100 + k % 9000) * 0.3048::DOUBLE, 3) AS z, lpad(CAST(k % 56 + 1 AS VARCHAR), 2, '0') || '-' || lpad(CAST(k % 1000000 AS VARCHAR), 6, '0') AS obstacle_id FROM lcc")
def obstacle_feature_json(spark, d):
    """Through JSON text and back, as the feature writer emits it."""
    from ..functions.features import to_json_text

    f = to_features(obstacles.normalize(obstacles.good(parsed(spark, d))), "esri:102009", amsl_z=True)
    schema = "type string, geometry struct<type:string,coordinates:array<double>>, properties struct<obstacle_id:string,source:struct<line_number:bigint>>"
    j = to_json_text(f).select(F.from_json("value", schema).alias("f"))
    at = lambda i: F.round(col("f.geometry.coordinates")[i], 3)
    return j.select(col("f.properties.source.line_number").alias("line_number"), col("f.type").alias("type"), col("f.geometry.type").alias("geometry_type"), at(0).alias("x"), at(1).alias("y"), at(2).alias("z"), col("f.properties.obstacle_id").alias("obstacle_id"))


@query("WITH " + POINTS + LCC + "SELECT id, round(x, 3) AS x, round(y, 3) AS y FROM lcc")
def obstacle_lcc(spark, d):
    p = carriers.points(spark, d).withColumn("p", projection.to_lambert(col("lon"), col("lat")))
    return p.select("id", F.round("p.x", 3).alias("x"), F.round("p.y", 3).alias("y"))


@query("WITH " + POINTS + "z AS (SELECT 1) SELECT id, round(lon, 6) AS lon, round(lat, 6) AS lat FROM pts")
def lcc_inverse(spark, d):
    """There and back again."""
    p = carriers.points(spark, d).withColumn("p", projection.to_lambert(col("lon"), col("lat")))
    p = p.withColumn("q", projection.from_lambert(col("p.x"), col("p.y")))
    return p.select("id", F.round("q.lon", 6).alias("lon"), F.round("q.lat", 6).alias("lat"))


NAVAIDS = """WITH t AS (SELECT p_partkey AS k, (['VOR','VOR_DME','VORTAC','NDB','NDB_DME','TACAN','DME','OTHER:VOT','OTHER:FAN_MARKER','OTHER:MARINE_NDB','ILS'])[CAST(p_partkey % 11 AS INT) + 1] AS typ FROM part),
nav AS (SELECT * FROM t WHERE typ <> 'ILS') """


def members(spark, d):
    return navaids.members_of(carriers.navaid_members(spark, d), "xml").select("k", "member")


@query(
    NAVAIDS
    + """, rcc AS (SELECT s_suppkey AS r, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE CAST((s_suppkey % 10 + 108) || '.' || (s_suppkey % 10) AS DOUBLE) END AS f,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_suppkey || 'X' END AS c FROM supplier),
refs AS (SELECT k, u.pos, u.ref FROM nav, LATERAL (SELECT unnest([0, 1, 2]) AS pos, unnest([k % 120, k * 3 % 120, k * 7 % 120]) AS ref) u),
hit AS (SELECT k, arg_min(f, pos) FILTER (f IS NOT NULL) AS frequency_mhz, arg_min(c, pos) FILTER (c IS NOT NULL) AS channel FROM refs JOIN rcc ON refs.ref = rcc.r GROUP BY k)
SELECT nav.k, 'D' || nav.k || '-' || typ AS navaid_id, typ AS navaid_type, 'NAME ' || nav.k AS name,
  CASE WHEN nav.k % 13 = 0 THEN 0.0::DOUBLE ELSE round(-124.0::DOUBLE + (nav.k % 5700) / 100.0::DOUBLE, 2) END AS longitude,
  CASE WHEN nav.k % 13 = 0 THEN 0.0::DOUBLE ELSE round(25.0::DOUBLE + (nav.k % 2300) / 100.0::DOUBLE, 2) END AS latitude,
  CASE WHEN nav.k % 17 = 0 THEN NULL ELSE round((nav.k % 9000) * 0.3048::DOUBLE, 3) END AS elevation_m, frequency_mhz, channel
FROM nav LEFT JOIN hit ON nav.k = hit.k"""
)
def navaid_resolve(spark, d):
    rows = members(spark, d)
    raw = navaids.raw_navaids(rows).where("parse_error is null").drop("parse_error")
    rcc = navaids.last_of_each(navaids.channels(rows), "rcc_id", "k")
    full = navaids.resolve(raw, rcc, "k")
    out = navaids.normalize(full.withColumn("name", F.concat_ws("|", "name", "k")))
    name = F.split("name", "[|]")
    return out.select(
        name[1].cast("long").alias("k"), "navaid_id", "navaid_type", name[0].alias("name"), F.round("location.longitude", 2).alias("longitude"), F.round("location.latitude", 2).alias("latitude"),
        col("elevation.meters").alias("elevation_m"), col("frequency.mhz").alias("frequency_mhz"), col("frequency.channel").alias("channel"),
    )


@query(NAVAIDS + "SELECT typ AS navaid_type, count(*) AS n FROM nav GROUP BY typ")
def navaid_type_filter(spark, d):
    return navaids.raw_navaids(members(spark, d)).groupBy("navaid_type").agg(F.count("*").alias("n"))


@query(NAVAIDS + "SELECT (SELECT count(*) FROM nav) AS navaid_count, (SELECT count(*) FROM supplier) AS rcc_count, CAST(0 AS BIGINT) AS error_count")
def navaid_summary(spark, d):
    return navaids.summary(members(spark, d))


@query(
    """SELECT p_partkey AS k, regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g') AS strict_key, regexp_replace(lower(p_name) , '[^\\p{L}\\p{N}]', '', 'g') AS lenient_key,
  trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') || '.geojson' AS file FROM part"""
)
def chart_normalize(spark, d):
    p = carriers.table(spark, d, "part")
    shown = F.concat("p_name", F.lit("_SEC"))
    return p.select(col("p_partkey").alias("k"), text.key_strict(col("p_name")).alias("strict_key"), text.key_lenient(shown).alias("lenient_key"), text.chart_filename(col("p_name")).alias("file"))


CHARTS = """WITH base AS (SELECT p_partkey AS k, p_name, list_aggregate(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', ' ') || ' ' || p_partkey AS n FROM part),
found AS (SELECT k, CASE WHEN k % 2 = 0 THEN n || '_TAC' ELSE n END AS chart_name, unnest(CASE WHEN k % 2 = 0 THEN ['tac', 'fly'] ELSE ['sectional'] END) AS chart_type, n,
  unnest(CASE WHEN k % 2 = 0 THEN [n || ' TAC.tif', n || ' FLY.tif'] ELSE [n || ' SEC.tif'] END) AS file FROM base),
keyed AS (SELECT *, regexp_replace(lower(chart_name), '[^a-z0-9]+', '', 'g') AS chart_key, CASE WHEN chart_type = 'sectional' THEN 'sectional' ELSE 'tac' END AS family,
  regexp_replace(lower(CASE WHEN chart_type = 'sectional' THEN n ELSE n || '_TAC' END), '[^a-z0-9]+', '', 'g') AS coverage_key FROM found),
masks AS (SELECT family, coverage_key, 'masks/' || min(coverage_key) || '.geojson' AS mask_path FROM keyed WHERE k % 4 <> 1 GROUP BY family, coverage_key) """


def found_charts(spark, d):
    files = carriers.chart_files(spark, d)
    rows = listing.discover(files.select("dir", "file"))
    return rows


def chart_masks(spark, d):
    files = carriers.chart_files(spark, d).where("k % 4 <> 1").select("dir", "file")
    rows = listing.discover(files).select(F.when(col("chart_type") == "sectional", "sectional").otherwise("tac").alias("family"), "coverage_key").distinct()
    return rows.withColumn("mask_path", F.concat(F.lit("masks/"), "coverage_key", F.lit(".geojson")))


@query(CHARTS + "SELECT chart_name, chart_key, chart_type, coverage_key, file FROM keyed")
def chart_classify(spark, d):
    return found_charts(spark, d).select("chart_name", "chart_key", "chart_type", "coverage_key", "file")


@query(
    CHARTS
    + """SELECT chart_name, chart_type, keyed.coverage_key, trim(regexp_replace(lower(chart_name), '[^a-z0-9]+', '-', 'g'), '-') ||
  CASE WHEN chart_type = 'sectional' THEN '' ELSE '--' || trim(regexp_replace(lower(n || ' ' || chart_type), '[^a-z0-9]+', '-', 'g'), '-') || '.' || chart_type END AS output_name, mask_path
FROM keyed LEFT JOIN masks ON keyed.family = masks.family AND keyed.coverage_key = masks.coverage_key"""
)
def chart_jobs(spark, d):
    return charts.chart_jobs(found_charts(spark, d), chart_masks(spark, d)).select("chart_name", "chart_type", "coverage_key", "output_name", "mask_path")


@query(CHARTS + "SELECT chart_name, chart_type, coverage_key, 'No coverage mask for ' || chart_type || ' chart ' || chart_name || ' (' || coverage_key || ')' AS message FROM keyed k WHERE NOT EXISTS (SELECT 1 FROM masks m WHERE m.family = k.family AND m.coverage_key = k.coverage_key)")
def chart_jobs_missing(spark, d):
    return charts.jobs_without_mask(found_charts(spark, d), chart_masks(spark, d)).select("chart_name", "chart_type", "coverage_key", "message")


@query("SELECT regexp_replace(lower(p_name), '[^a-z0-9]+', '', 'g') AS chart_key, count(DISTINCT p_partkey) AS n FROM part GROUP BY 1 HAVING count(DISTINCT p_partkey) > 1")
def dup_keys(spark, d):
    p = carriers.table(spark, d, "part").select(text.key_strict(col("p_name")).alias("chart_key"), "p_partkey")
    return listing.duplicate_keys(p, "chart_key", "p_partkey").select("chart_key", "n")


REGIONS = """WITH regs AS (SELECT r_name AS region, n_name AS chart, row_number() OVER (PARTITION BY r_name ORDER BY n_name) - 1 AS ordinal FROM region JOIN nation ON r_regionkey = n_regionkey),
alias AS (SELECT * FROM (VALUES ('unitedstates', 'usa'), ('unitedkingdom', 'uk'), ('uk', 'unitedkingdom')) v(key, variant)),
files AS (SELECT s_suppkey AS s, CASE WHEN s_nationkey % 7 = 3 THEN 'lost-' || s_suppkey WHEN n_name = 'UNITED STATES' THEN 'usa' ELSE lower(replace(n_name, ' ', '-')) END AS stem, '/p/' || s_suppkey || '/' FROM supplier JOIN nation ON s_nationkey = n_nationkey),
paths AS (SELECT '/p/' || s || '/' || stem || '--' || stem || '-tac.tac.clip.tif' AS path, regexp_replace(stem, '[^a-z0-9]+', '', 'g') AS fk FROM files),
fkeys AS (SELECT path, fk || 'tac' AS key FROM paths UNION SELECT path, fk FROM paths), fvars AS (SELECT path, key AS variant FROM fkeys UNION SELECT path, variant FROM fkeys JOIN alias USING (key)),
ckeys AS (SELECT *, regexp_replace(lower(chart), '[^a-z0-9]+', '', 'g') AS key FROM regs), cvars AS (SELECT *, key AS variant FROM ckeys UNION ALL SELECT ckeys.*, alias.variant FROM ckeys JOIN alias USING (key)),
hits AS (SELECT DISTINCT region, ordinal, chart, path FROM cvars JOIN fvars USING (variant)) """


def regions(spark, d):
    from pyspark.sql import Window

    r = carriers.table(spark, d, "region").join(carriers.table(spark, d, "nation"), col("r_regionkey") == col("n_regionkey"))
    place = F.row_number().over(Window.partitionBy("r_name").orderBy("n_name")) - 1
    return r.select(col("r_name").alias("region"), col("n_name").alias("chart"), place.cast("long").alias("ordinal"))


def region_inputs(spark, d):
    s = carriers.table(spark, d, "supplier").join(carriers.table(spark, d, "nation"), col("s_nationkey") == col("n_nationkey"))
    # Files of some nations have names that no chart answers to.
    stem = F.when(col("s_nationkey") % 7 == 3, F.concat(F.lit("lost-"), "s_suppkey")).when(col("n_name") == "UNITED STATES", "usa").otherwise(F.lower(F.replace("n_name", F.lit(" "), F.lit("-"))))
    name = F.concat(stem, F.lit("--"), stem, F.lit("-tac.tac.clip.tif"))
    files = s.select(F.concat(F.lit("/p/"), "s_suppkey", F.lit("/"), name).alias("path"), name.alias("file"))
    aliases = charts.alias_table(spark, {"unitedstates": ("usa",), "unitedkingdom": ("uk",), "uk": ("unitedkingdom",)})
    return charts.terminal_inputs(regions(spark, d), listing.processed_files(files, ".clip.", "tac"), "tac", aliases)


@query(REGIONS + "SELECT region, CAST(row_number() OVER (PARTITION BY region ORDER BY o, lower(path), path) AS INT) AS position, path FROM (SELECT region, path, min(ordinal) AS o FROM hits GROUP BY region, path)")
def region_mosaic(spark, d):
    return charts.region_mosaics(region_inputs(spark, d))


@query(REGIONS + "SELECT region, ordinal, chart FROM regs WHERE (region, chart) NOT IN (SELECT (region, chart) FROM hits)")
def region_missing(spark, d):
    return charts.regions_without_input(regions(spark, d), region_inputs(spark, d))


@query("SELECT page_id, CAST(u.pos AS INT) AS pos, u.href FROM pages, LATERAL (SELECT unnest(regexp_extract_all(html, '(?i)href\\s*=\\s*[\"'']?([^\"''\\s>]+)', 1)) AS href, generate_subscripts(regexp_extract_all(html, '(?i)href\\s*=\\s*[\"'']?([^\"''\\s>]+)', 1), 1) - 1 AS pos) u")
def href_extract(spark, d):
    return carriers.table(spark, d, "pages").select("page_id", F.posexplode(web.hrefs(col("html"))).alias("pos", "href"))


@query("SELECT n_nationkey AS id, 'Originator ' || n_name AS originator, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE CAST(least(n_nationkey, 20) AS DOUBLE) END AS min_lon, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE CAST(greatest(n_nationkey, 20) AS DOUBLE) END AS max_lon, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE n_nationkey + 0.5::DOUBLE END AS min_lat, CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE n_nationkey + 1.5::DOUBLE END AS max_lat FROM nation")
def html_bounds(spark, d):
    """Sidecar pages made from nations: meta tags, body fields or neither; some with sides reversed."""
    n, k = carriers.table(spark, d, "nation"), col("n_nationkey")
    meta = lambda name, v: F.concat(F.lit(f'<META name="dc.coverage.{name}" scheme="x" content="'), v, F.lit('">\n'))
    body = lambda name, v: F.concat(F.lit(f"<dt><em>{name}_Bounding_Coordinate:</em>\n "), v, F.lit(" </dt>"))
    w, e, s, t = k.cast("string"), F.lit("20"), (k + 0.5).cast("string"), (k + 1.5).cast("string")
    tags = F.concat(meta("x.min", w), meta("x.max", e), meta("y.min", s), meta("y.max", t))
    fields = F.concat(body("West", w), body("East", e), body("South", s), body("North", t))
    html = F.concat(F.lit("<dt><em>Originator:</em> <dd>Originator\n "), "n_name", F.lit(" </dd>"), F.when(k % 4 == 0, meta("x.min", w)).when(k % 2 == 0, tags).otherwise(fields))
    rows = n.select(k.alias("id"), html.alias("h")).select("id", web.sidecar_bounds(col("h")).alias("b"), web.sidecar_metadata(col("h")).alias("m"))
    return rows.select("id", "m.originator", "b.min_lon", "b.max_lon", "b.min_lat", "b.max_lat")


@query("WITH c AS (SELECT strftime(o_orderdate, '%m-%d-%Y') AS cycle, CAST(o_orderdate AS DATE) AS dt, o_orderpriority AS kind FROM orders) SELECT cycle, CAST(dt AS VARCHAR) AS cycle_date FROM (SELECT cycle, dt FROM c WHERE kind IN ('1-URGENT', '2-HIGH', '5-LOW') GROUP BY cycle, dt HAVING count(DISTINCT kind) = 3 ORDER BY dt DESC LIMIT 1)")
def cycle_latest(spark, d):
    o = carriers.table(spark, d, "orders").select(F.date_format("o_orderdate", "MM-dd-yyyy").alias("cycle"), col("o_orderpriority").alias("chart_type"))
    o = o.withColumn("cycle_date", F.to_date("cycle", "MM-dd-yyyy"))
    return packages.latest_complete(o, ["1-URGENT", "2-HIGH", "5-LOW"]).select("cycle", col("cycle_date").cast("string").alias("cycle_date"))


@query("SELECT o_orderpriority AS chart_type, count(*) AS package_count, count(*) FILTER (NOT (o_orderkey % 3 = 0 AND o_orderkey % 2 = 1)) AS downloaded_count, count(*) FILTER (o_orderkey % 3 = 0 AND o_orderkey % 2 = 1) AS skipped_count FROM orders GROUP BY 1")
def fetch_manifest(spark, d):
    o = carriers.table(spark, d, "orders")
    specs = o.select(F.concat(col("o_orderkey"), F.lit(".zip")).alias("zip_path"), col("o_orderpriority").alias("chart_type"))
    there = o.where("o_orderkey % 3 = 0").select(F.concat(col("o_orderkey"), F.lit(".zip")).alias("zip_path"), (col("o_orderkey") % 2).alias("size"))
    return packages.summary(packages.with_status(specs, there), "chart_type")


@query("SELECT e.event_id, CAST(year(e.ts) AS VARCHAR) || '-Q' || quarter(e.ts) AS quarter, strftime(date_trunc('quarter', e.ts), '%Y-%m-%dT%H:%M:%SZ') AS start, strftime(date_trunc('quarter', e.ts) + INTERVAL 3 MONTH, '%Y-%m-%dT%H:%M:%SZ') AS \"end\" FROM events e")
def quarter_bounds(spark, d):
    e = carriers.table(spark, d, "events").select("event_id", m.quarter_of(col("ts")).alias("quarter"))
    return e.select("event_id", "quarter", m.quarter_bounds(col("quarter")).alias("b")).select("event_id", "quarter", "b.start", "b.end")


@query("SELECT CAST(year(o_orderdate) AS VARCHAR) || '-Q' || quarter(o_orderdate) AS quarter, count(*) AS attempted, count(*) FILTER (o_orderstatus = 'F') AS succeeded, count(*) FILTER (o_orderstatus = 'O') AS failed, count(*) FILTER (o_orderstatus = 'P') AS skipped FROM orders GROUP BY 1")
def quarter_summary(spark, d):
    status = F.when(col("o_orderstatus") == "F", "succeeded").when(col("o_orderstatus") == "O", "failed").when(col("o_orderstatus") == "P", "skipped")
    o = carriers.table(spark, d, "orders").select(m.quarter_of(col("o_orderdate")).alias("quarter"), status.alias("status"))
    return scenes.quarter_summary(o)


@query("SELECT o_orderkey AS tile, o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45) AS pending FROM orders")
def resume_pending(spark, d):
    tiles = carriers.table(spark, d, "orders").select(col("o_orderkey").alias("tile"))
    done = carriers.table(spark, d, "lineitem").where("l_quantity > 45").select(col("l_orderkey").alias("tile"))
    return scenes.pending(tiles, done, "tile").withColumn("pending", F.lit(True)).unionByName(scenes.finished(tiles, done, "tile").withColumn("pending", F.lit(False)))


@query("SELECT r_name AS region, o_orderkey AS scene FROM region CROSS JOIN orders WHERE CAST(year(o_orderdate) AS VARCHAR) || '-Q' || quarter(o_orderdate) = '1995-Q2'")
def scenes_by_quarter(spark, d):
    """A small dimension, regions, meets every scene of one quarter: preloaded scenes are not filtered by region."""
    s = carriers.table(spark, d, "orders").select(col("o_orderkey").alias("scene"), m.quarter_of(col("o_orderdate")).alias("quarter"))
    r = carriers.table(spark, d, "region").select(col("r_name").alias("region"))
    return scenes.scenes_for(s, r, "1995-Q2").select("region", "scene")


@query("SELECT event_id, array_to_string(list_sort(list_filter(['ip', 'k', 'page', 'ref', 'v'], lambda x: NOT list_contains(json_keys(props), x))), ',') AS missing FROM events")
def scene_required_keys(spark, d):
    rows = missing_keys(carriers.table(spark, d, "events"), "props", ["ip", "k", "page", "ref", "v"])
    return rows.select("event_id", F.array_join("missing", ",").alias("missing"))


@query(
    """WITH f AS (SELECT n_nationkey AS k, n_name, 'chart' || (n_nationkey % 7) AS key FROM nation)
SELECT key AS chart_key, arg_max(k, k) AS last_id, CAST(arg_max(k % 2 + 1, k) AS BIGINT) AS polygons FROM f GROUP BY key"""
)
def geojson_index(spark, d):
    """A FeatureCollection of nations under seven charts: the last of equal keys stays."""
    k = col("n_nationkey")
    ring = F.array(*[F.array((k + i).cast("double"), F.lit(float(j))) for i, j in ((0, 0), (1, 0), (1, 1), (0, 0))])
    geometry = F.when(k % 2 == 0, F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))).otherwise(F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), F.array(F.array(ring), F.array(ring)).alias("coordinates"))))
    feature = F.concat(F.lit('{"type":"Feature","properties":{"chart":"'), F.concat(F.lit("Chart-"), k % 7), F.lit('"},"geometry":'), geometry, F.lit("}"))
    rows = carriers.table(spark, d, "nation").select(k.alias("k"), feature.alias("f"))
    doc = rows.groupBy().agg(F.array_sort(F.collect_list(F.struct("k", "f"))).alias("fs")).select(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.transform("fs", lambda s: s["f"]), ","), F.lit("]}")).alias("value"))
    index = coverage.chart_index(coverage.features_of(doc, "value"))
    return index.select("chart_key", col("polygons")[0][0][0][0].cast("int").alias("last_id"), F.size("polygons").cast("long").alias("polygons"))


@query("SELECT CAST(year(ts) AS VARCHAR) || '-Q' || quarter(ts) AS quarter, count(*) AS n FROM events GROUP BY 1")
def stream_quarter_counts(spark, d):
    """The events table as a stream, through to its end; complete mode into a memory table."""
    import uuid

    from ..streaming.streams import quarter_counts

    path = f"{d}/events.parquet"
    schema = spark.read.parquet(path).schema
    # A file source wants folders or globs: the last letter as a class matches the file itself.
    stream = spark.readStream.schema(schema).parquet(path[:-1] + "[t]")
    name = f"quarters_{uuid.uuid4().hex}"
    q = quarter_counts(stream).writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)

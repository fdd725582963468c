"""Deterministic inputs for the driver's queries, derived from its tables by integer arithmetic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """rows over all cores where a table of one small file would keep a single one busy."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores, key)


def number(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def pick(index: Column, values: str | list[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, list(values))), index.cast("int") + 1)


def obstacle_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, line_number, line): an obstacle record for each order; some are malformed in known ways.

    The explode keeps the text from being built anew for each field that is cut from it.
    """
    o = spread(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")), "k")
    digits = lambda x, n: f"lpad(CAST({x} AS STRING), {n}, '0')"
    seconds = lambda x: f"{digits(f'({x}) DIV 100', 2)} || '.' || {digits(f'({x}) % 100', 2)}"
    one = lambda index, values: f"substring('{values}', CAST({index} AS INT) + 1, 1)"
    any_of = lambda index, values: f"element_at(array({', '.join(map(repr, values))}), CAST({index} AS INT) + 1)"
    fields = [
        f"{digits('k % 56 + 1', 2)} || '-' || {digits('k % 1000000', 6)}",
        "if(k % 2 = 0, 'O', 'U')",
        "if(k % 11 = 0, 'MX', 'US')",
        f"if(k % 11 = 0, '  ', {any_of('k % 4', ['UT', 'CO', 'NV', 'ID'])})",
        "rpad('CITY ' || (k % 50), 16, ' ')",
        digits("k % 24 + 25", 2),
        f"if(k % 101 = 0, '75', {digits('k % 60', 2)})",
        f"{seconds('k % 6000')} || 'N'",
        digits("k % 58 + 66", 3),
        digits("k * 7 % 60", 2),
        f"{seconds('k * 13 % 6000')} || 'W'",
        f"rpad({any_of('k % 4', ['TOWER', 'BLDG', 'POLE', 'WINDMILL'])}, 18, ' ')",
        "if(k % 5 = 0, ' ', CAST(k % 9 + 1 AS STRING))",
        f"if(k % 103 = 0, 'ABCDE', {digits('k % 2000 + 20', 5)})",
        digits("k % 9000 + 100", 5),
        f"if(k % 7 = 0, ' ', {one('k % 10', 'RDHMSFCWLN')})",
        "CAST(k % 9 + 1 AS STRING)",
        one("k % 9", "ABCDEFGHI"),
        one("k % 7", "MPFLRWK"),
        f"rpad(if(k % 3 = 0, '', '2020ST' || {digits('k % 100000', 5)} || 'OE'), 14, ' ')",
        "if(k % 2 = 0, 'A', 'C')",
        "if(k % 97 = 0, '20X6038', CAST(k % 365 + 2013001 AS STRING))",
    ]
    line = F.expr(f"array(concat_ws(' ', {', '.join(fields)}))")
    return o.select(F.expr("'part-' || (k % 5)").alias("file"), F.col("k").alias("line_number"), F.explode(line).alias("line"))


def navaid_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, xml): a navigation aid for each part and a radio channel for each supplier, as member XML.

    Every eleventh part has a type that does not count; references are three channel ids, some of nothing.
    """
    types = ["VOR", "VOR_DME", "VORTAC", "NDB", "NDB_DME", "TACAN", "DME", "OTHER:VOT", "OTHER:FAN_MARKER", "OTHER:MARINE_NDB", "ILS"]
    p = spread(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k")), "k")
    k = F.col("k")
    ref = lambda n: F.concat(F.lit("<aixm:navaidEquipment><aixm:NavaidComponent><aixm:theNavaidEquipment xlink:href=\"#/faa:SubscriberFile/faa:Member/aixm:RadioCommunicationChannel[@gml:id='RCC_"), n.cast("string"), F.lit("']\"/></aixm:NavaidComponent></aixm:navaidEquipment>"))
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), c, F.lit(f"</{name}>"))
    pos = F.when(k % 13 == 0, "").otherwise(tag("gml:pos", F.concat((F.lit(-124.0) + (k % 5700) / 100).cast("decimal(8,2)").cast("string"), F.lit(" "), (F.lit(25.0) + (k % 2300) / 100).cast("decimal(8,2)").cast("string"))))
    elevation = F.when(k % 17 == 0, "").otherwise(F.concat(F.lit('<aixm:elevation uom="FT">'), (k % 9000).cast("string"), F.lit(".0</aixm:elevation>")))
    navaids = p.select(
        k,
        F.concat(
            F.lit('<faa:Member><aixm:Navaid gml:id="N_'), k.cast("string"), F.lit('"><aixm:timeSlice><aixm:NavaidTimeSlice>'), tag("aixm:type", pick(k % 11, types)), tag("aixm:designator", F.concat(F.lit("D"), k)), tag("aixm:name", F.concat(F.lit("NAME "), k)),
            ref(k % 120), ref(k * 3 % 120), ref(k * 7 % 120), F.lit("<aixm:location><aixm:ElevatedPoint>"), pos, elevation, F.lit("</aixm:ElevatedPoint></aixm:location></aixm:NavaidTimeSlice></aixm:timeSlice></aixm:Navaid></faa:Member>"),
        ).alias("xml"),
    )
    s = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") * -1).alias("k"), F.col("s_suppkey").alias("r"))
    r = F.col("r")
    frequency = F.when(r % 4 == 0, "").otherwise(tag("aixm:frequencyTransmission", F.concat((r % 10 + 108).cast("string"), F.lit("."), (r % 10).cast("string"))))
    channel = F.when(r % 3 == 0, "<aixm:channel></aixm:channel>").otherwise(tag("aixm:channel", F.concat(r, F.lit("X"))))
    rcc = s.select(
        "k",
        F.concat(F.lit('<faa:Member><aixm:RadioCommunicationChannel gml:id="RCC_'), r.cast("string"), F.lit('"><aixm:timeSlice><aixm:RadioCommunicationChannelTimeSlice>'), frequency, channel, F.lit("</aixm:RadioCommunicationChannelTimeSlice></aixm:timeSlice></aixm:RadioCommunicationChannel></faa:Member>")).alias("xml"),
    )
    return navaids.unionByName(rcc).select("k", F.explode(F.array("xml")).alias("xml"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, lon, lat) of customers over North America."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("id"), (F.lit(-124.0) + (k % 5700) / 100).alias("lon"), (F.lit(25.0) + (k % 2300) / 100).alias("lat"))


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, b): a box in projected metres for each nation."""
    k = F.col("n_nationkey").cast("double")
    x, y = k * 200000.0 - 2500000.0, (k % 5) * 100000.0 - 1000000.0
    b = F.struct(x.alias("min_x"), y.alias("min_y"), (x + 450000.0 + k * 1000.0).alias("max_x"), (y + 320000.0).alias("max_y"))
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_regionkey").alias("region"), b.alias("b"))


def corners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, line): a coverage table row for each nation; every sixth passes the antimeridian."""
    k = F.col("n_nationkey")
    west = F.when(k % 6 == 0, 176).otherwise(150 - k * 4)
    east = F.when(k % 6 == 0, 183).otherwise(150 - k * 4 + 6)
    dms = lambda d, m, plus, minus: F.concat(number(F.abs(d), 3), F.lit("°"), number(m, 2), F.lit("'"), F.when(d >= 0, plus).otherwise(minus))
    turned = lambda lon: F.when(lon > 180, lon - 360).otherwise(lon)
    south, north = k % 30 + 20, k % 30 + 24
    lat = [dms(x, k * 2, F.lit("N"), F.lit("S")) for x in (south, north, south, north)]
    lon = [dms(turned(x), F.lit(0), F.lit("E"), F.lit("W")) for x in (west, west, east, east)]
    return table(spark, sf_dir, "nation").select(k.alias("id"), F.concat_ws(" ", F.concat(F.lit("CHART "), "n_name"), *lat, *lon).alias("line"))


def grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, row, col, v): embeddings as 8 x 8 rasters."""
    from ..raster.longform import from_vectors

    return from_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 8)


def masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grids(spark, sf_dir).withColumn("on", F.col("v") > 0)


def chart_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dir, file) of raw charts for parts: sectional folders, terminal folders of two files, and distractors."""
    k, n = F.col("p_partkey"), F.initcap("p_name")
    p = table(spark, sf_dir, "part").select(k.alias("k"), F.concat(n, F.lit(" "), k.cast("string")).alias("n"))
    terminal = F.col("k") % 2 == 0
    folder = F.when(terminal, F.concat("n", F.lit("_TAC"))).otherwise(F.col("n"))
    files = F.when(terminal, F.array(F.concat("n", F.lit(" TAC.tif")), F.concat("n", F.lit(" FLY.tif")), F.lit("Anchorage Graphic.tif"))).otherwise(F.array(F.concat("n", F.lit(" SEC.tif")), F.concat("n", F.lit(" SEC.htm")), F.lit("Honolulu Inset SEC.tif")))
    return p.select("k", folder.alias("dir"), F.explode(files).alias("file"))

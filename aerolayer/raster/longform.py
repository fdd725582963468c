"""Rasters as rows (raster keys, row, col, value): neighbourhood and whole-raster operators in DataFrame form.

Keys name the raster; each works at any number of rasters, and windows or joins never cross one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def from_vectors(rows: DataFrame, key: str, vector: str, width: int) -> DataFrame:
    """(key, row, col, v) of arrays in row-major order."""
    out = rows.select(key, F.posexplode(vector).alias("i", "x"))
    return out.select(key, F.floor(F.col("i") / width).cast("int").alias("row"), (F.col("i") % width).cast("int").alias("col"), F.col("x").cast("double").alias("v"))


def _extent(keys: list[str]) -> tuple[Column, Column]:
    w = Window.partitionBy(*keys)
    return F.max("row").over(w), F.max("col").over(w)


def box_mean(pixels: DataFrame, keys: list[str], k: int) -> DataFrame:
    """(keys, row, col, v) averaged over k x k pixels from k//2 before to k-1-k//2 after; edges are replicated.

    Two passes, rows then columns: each pixel goes to the places it is seen from, edge pixels more than
    once, and sums are partial on the map side.
    """
    if k <= 1:
        return pixels
    before, after = k // 2, k - 1 - k // 2
    rows = pixels.withColumn("__h", _extent(keys)[0]).withColumn("__w", _extent(keys)[1])

    def spread(df: DataFrame, axis: str, last: str) -> DataFrame:
        # A pixel at i is seen from j when clamp(j + d) = i for some d of the window; edge pixels by several d.
        steps = F.sequence(F.lit(-before), F.lit(after))
        seen = F.transform(steps, lambda d: F.struct(d.alias("d")))
        out = df.select("*", F.explode(F.sequence(F.greatest(F.col(axis) - after, F.lit(0)), F.least(F.col(axis) + before, F.col(last)))).alias("__j"))
        count = F.size(F.filter(seen, lambda s: F.least(F.greatest(F.col("__j") + s["d"], F.lit(0)), F.col(last)) == F.col(axis)))
        return out.withColumn("v", F.col("v") * count)

    across = spread(rows, "col", "__w").groupBy(*keys, "row", "__h", F.col("__j").alias("col")).agg(F.sum("v").alias("v"))
    down = spread(across, "row", "__h").groupBy(*keys, F.col("__j").alias("row"), "col").agg((F.sum("v") / F.lit(float(k * k))).alias("v"))
    return down


def neighbours(pixels: DataFrame, keys: list[str], value: str, replicate: bool) -> DataFrame:
    """pixels with array ``n`` of the 3 x 3 values around each, row-major; outside is null or the nearest pixel."""
    across, down = Window.partitionBy(*keys, "row").orderBy("col"), Window.partitionBy(*keys, "col").orderBy("row")
    c = F.col(value)
    other = c if replicate else F.lit(None).cast(pixels.schema[value].dataType)
    side = F.array(F.coalesce(F.lag(value).over(across), other), c, F.coalesce(F.lead(value).over(across), other))
    rows = pixels.withColumn("__s", side)
    edge = F.col("__s") if replicate else F.transform("__s", lambda _: F.lit(None).cast(pixels.schema[value].dataType))
    three = F.concat(F.coalesce(F.lag("__s").over(down), edge), F.col("__s"), F.coalesce(F.lead("__s").over(down), edge))
    return rows.withColumn("n", three).drop("__s")


def slope(pixels: DataFrame, keys: list[str], cell_x: float = 1.0, cell_y: float = 1.0, scale: float = 1.0) -> DataFrame:
    """Slope in degrees by weighted differences over 3 x 3 pixels (Horn); edges are replicated."""
    n = lambda i: F.col("n")[i]
    dx = ((n(2) + 2 * n(5) + n(8)) - (n(0) + 2 * n(3) + n(6))) / F.lit(8.0 * cell_x * scale)
    dy = ((n(6) + 2 * n(7) + n(8)) - (n(0) + 2 * n(1) + n(2))) / F.lit(8.0 * cell_y * scale)
    return neighbours(pixels, keys, "v", True).withColumn("v", F.degrees(F.atan(F.sqrt(dx * dx + dy * dy)))).drop("n")


def dilate(masks: DataFrame, keys: list[str]) -> DataFrame:
    """Pixels that are on or next to one that is, in eight directions; outside is off."""
    return neighbours(masks, keys, "on", False).withColumn("on", F.exists("n", lambda x: F.coalesce(x, F.lit(False)))).drop("n")


def erode(masks: DataFrame, keys: list[str]) -> DataFrame:
    """Pixels that are on with all eight neighbours; outside is on."""
    return neighbours(masks, keys, "on", False).withColumn("on", F.forall("n", lambda x: F.coalesce(x, F.lit(True)))).drop("n")


def close(masks: DataFrame, keys: list[str], times: int) -> DataFrame:
    for _ in range(max(0, times)):
        masks = erode(dilate(masks, keys), keys)
    return masks


def edge_mode(pixels: DataFrame, keys: list[str], width: int, value: str = "v") -> DataFrame:
    """(keys, background): the commonest value of the edge bands; corners count twice, ties go to the least value."""
    h, w = _extent(keys)
    rows = pixels.withColumn("__h", h).withColumn("__w", w)
    band = lambda c, last: (F.col(c) < width).cast("int") + (F.col(c) > F.col(last) - width).cast("int")
    counted = rows.withColumn("__n", band("row", "__h") + band("col", "__w")).where("__n > 0")
    sums = counted.groupBy(*keys, value).agg(F.sum("__n").alias("n"))
    return sums.groupBy(*keys).agg(F.max_by(F.col(value), F.struct("n", (-F.col(value)).alias("v"))).alias("background"))


def neatline(pixels: DataFrame, keys: list[str], ink: Column, ratio: float) -> DataFrame:
    """(keys, top, bottom, left, right): outermost rows and columns with ink on ``ratio`` of their pixels.

    Null where fewer than two qualify.
    """
    h, w = _extent(keys)
    rows = pixels.withColumn("__ink", ink.cast("int")).withColumn("__h", h + 1).withColumn("__w", w + 1)

    def lines(axis: str, across: str, first: str, last: str) -> DataFrame:
        counts = rows.groupBy(*keys, axis, across).agg(F.sum("__ink").alias("n"))
        full = counts.where(F.col("n") >= F.floor(F.col(across) * F.lit(ratio)))
        two = F.count("*") >= 2
        return full.groupBy(*keys).agg(F.when(two, F.min(axis)).alias(first), F.when(two, F.max(axis)).alias(last))

    found = lines("row", "__w", "top", "bottom").join(lines("col", "__h", "left", "right"), keys, "full")
    return pixels.select(*keys).distinct().join(found, keys, "left")


def outside_neatline(pixels: DataFrame, lines: DataFrame, keys: list[str], background: str) -> DataFrame:
    """pixels whose ``background`` also holds outside the neatline."""
    out = (F.col("row") < F.col("top")) | (F.col("row") > F.col("bottom")) | (F.col("col") < F.col("left")) | (F.col("col") > F.col("right"))
    return pixels.join(lines, keys, "left").withColumn(background, F.col(background) | F.coalesce(out, F.lit(False))).drop("top", "bottom", "left", "right")


def corner_points(masks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, nw, ne, se, sw): the on pixels that reach furthest into each corner; ties to the first in row-major order."""
    p = F.struct("row", "col")
    s, d = F.col("row") + F.col("col"), F.col("row") - F.col("col")
    pick = lambda key: F.min_by(p, F.struct(key.alias("k"), "row", "col"))
    return masks.where("on").groupBy(*keys).agg(pick(s).alias("nw"), pick(d).alias("ne"), pick(-s).alias("se"), pick(-d).alias("sw"))


def component_stats(labels: DataFrame, keys: list[str], label: str = "label") -> DataFrame:
    """Area, box, fill ratio and thickness of labelled components."""
    a = labels.groupBy(*keys, label).agg(
        F.count("*").alias("area"), F.min("row").alias("min_row"), F.min("col").alias("min_col"), F.max("row").alias("max_row"), F.max("col").alias("max_col")
    )
    h, w = F.col("max_row") - F.col("min_row") + 1, F.col("max_col") - F.col("min_col") + 1
    return a.withColumn("fill_ratio", F.col("area") / (h * w)).withColumn("min_thickness", F.least(h, w))


def largest_component(stats: DataFrame, keys: list[str], label: str = "label") -> DataFrame:
    """(keys, label) of the largest area; ties to the first label."""
    return stats.groupBy(*keys).agg(F.max_by(F.col(label), F.struct("area", (-F.col(label)).alias("l"))).alias(label))


def apply_palette(pixels: DataFrame, palette: DataFrame, index: str = "index") -> DataFrame:
    """pixels with r, g, b, a of palette (index, r, g, b, a); colours without alpha are opaque, missing ones all 0."""
    rows = pixels.join(palette.withColumnRenamed("index", index), index, "left").withColumn("__there", F.col("r").isNotNull())
    zero = F.lit(0)
    out = {c: F.coalesce(c, zero) for c in "rgb"} | {"a": F.when(F.col("__there"), F.coalesce("a", F.lit(255))).otherwise(zero)}
    return rows.withColumns(out).drop("__there")


def clip_to_polygon(pixels: DataFrame, geo: Column, rings: Column) -> DataFrame:
    """Pixels whose centres lie within the rings; geo is the array of six affine coefficients."""
    from ..functions.rings import contains

    cx, cy = F.col("col") + 0.5, F.col("row") + 0.5
    x = geo[0] + cx * geo[1] + cy * geo[2]
    y = geo[3] + cx * geo[4] + cy * geo[5]
    return pixels.where(contains(rings, x, y))


def downsample(pixels: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The nearest pixels of a raster whose longer side becomes ``most`` (smaller rasters stay), renumbered."""
    h, w = _extent(keys)
    rows = pixels.withColumn("__h", h + 1).withColumn("__w", w + 1)
    factor = F.greatest(F.lit(1.0), F.greatest("__h", "__w") / F.lit(float(most)))
    size = lambda n: F.greatest(F.lit(1), F.floor(F.col(n) / F.col("__f")).cast("int"))
    rows = rows.withColumn("__f", factor).withColumn("__nh", size("__h")).withColumn("__nw", size("__w"))
    # New pixel j shows old pixel floor((j + 0.5) * n / m).
    pick = lambda c, n, m: F.filter(F.transform(F.sequence(F.greatest(F.floor(F.col(c) * F.col(m) / F.col(n)).cast("int") - 1, F.lit(0)), F.least(F.floor(F.col(c) * F.col(m) / F.col(n)).cast("int") + 1, F.col(m) - 1)), lambda j: F.struct(j.alias("j"), F.floor((j + 0.5) * F.col(n) / F.col(m)).cast("int").alias("o"))), lambda s: s["o"] == F.col(c))
    rows = rows.withColumn("__r", pick("row", "__h", "__nh")).withColumn("__c", pick("col", "__w", "__nw")).where("size(__r) > 0 and size(__c) > 0")
    return rows.withColumn("row", F.col("__r")[0]["j"]).withColumn("col", F.col("__c")[0]["j"]).drop("__h", "__w", "__f", "__nh", "__nw", "__r", "__c")


def reproject(pixels: DataFrame, keys: list[str], source: list[float], target: list[float], rows: int, cols: int, inverse=None) -> DataFrame:
    """(keys, row, col, v) on a target grid: each pixel takes the nearest of the source, others stay out.

    source and target are six affine coefficients without rotation; inverse maps target coordinates (x, y) to
    source coordinates, as a struct of two; by default from the conic projection to degrees.
    """
    from ..functions.projection import from_lambert

    turn = inverse or from_lambert
    spark = pixels.sparkSession
    grid = spark.range(rows).select(F.col("id").cast("int").alias("row")).select("row", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))).alias("col"))
    at = turn(F.lit(target[0]) + (F.col("col") + 0.5) * target[1], F.lit(target[3]) + (F.col("row") + 0.5) * target[5])
    grid = grid.withColumn("__p", at)
    x, y = (F.col("__p").getField(f) for f in grid.schema["__p"].dataType.names)
    grid = grid.withColumn("__c", F.floor((x - source[0]) / source[1]).cast("int")).withColumn("__r", F.floor((y - source[3]) / source[5]).cast("int")).drop("__p")
    seen = pixels.withColumnRenamed("row", "__r").withColumnRenamed("col", "__c")
    return grid.join(seen, ["__r", "__c"]).drop("__r", "__c")

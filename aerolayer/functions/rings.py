"""Polygon rings as arrays of struct(lon, lat) or (x, y): folds over vertices, no Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: distances below this count as none.
EPSILON = 1e-9
RING = "array<struct<lon:double,lat:double>>"


def point(lon, lat) -> Column:
    return F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat"))


def none() -> Column:
    return F.array().cast(RING)


def unwrap(ring: Column) -> Column:
    """Longitudes moved by whole turns so that each is nearest to the one before; ties to the smaller."""

    def step(out: Column, p: Column) -> Column:
        last = F.element_at(out, -1)["lon"]
        turns = F.array(p["lon"] - 360.0, p["lon"], p["lon"] + 360.0)
        nearest = F.array_min(F.transform(turns, lambda c, i: F.struct(F.abs(c - last).alias("d"), i.alias("i"), c.alias("c"))))["c"]
        return F.concat(out, F.array(point(F.when(F.size(out) == 0, p["lon"]).otherwise(nearest), p["lat"])))

    first = F.slice(ring, 1, 1)
    return F.aggregate(F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))), first.cast(RING), lambda o, p: step(o, p))


def antimeridian(ring: Column) -> Column:
    """180 or -180 if the ring passes it, east first, else null."""
    lons = F.transform(ring, lambda p: p["lon"])
    return F.when(F.array_max(lons) > 180.0 + EPSILON, 180.0).when(F.array_min(lons) < -180.0 - EPSILON, -180.0)


def clip(ring: Column, at: Column, below: bool) -> Column:
    """The part of a ring on one side of a meridian (Sutherland-Hodgman)."""
    inside = lambda p: p["lon"] <= at + EPSILON if below else p["lon"] >= at - EPSILON

    def crossing(a: Column, b: Column) -> Column:
        run = b["lon"] - a["lon"]
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.try_divide(at - a["lon"], run)))
        return point(at, F.when(F.abs(run) < EPSILON, a["lat"]).otherwise(a["lat"] + (b["lat"] - a["lat"]) * t))

    state = lambda out, prev: F.struct(out.alias("out"), prev.alias("prev"))

    def step(s: Column, p: Column) -> Column:
        enters, leaves = ~inside(s["prev"]) & inside(p), inside(s["prev"]) & ~inside(p)
        new = F.when(enters, F.array(crossing(s["prev"], p), p)).when(inside(p), F.array(p)).when(leaves, F.array(crossing(s["prev"], p))).otherwise(none())
        return state(F.concat(s["out"], new.cast(RING)), p)

    last = F.element_at(ring, -1)
    start = state(none(), point(last["lon"], last["lat"]))
    folded = F.aggregate(ring, start, lambda s, p: step(s, point(p["lon"], p["lat"])), lambda s: s["out"])
    return F.when(F.size(ring) == 0, none()).otherwise(folded)


def shift(ring: Column, by: Column) -> Column:
    return F.transform(ring, lambda p: point(p["lon"] + by, p["lat"]))


def dedupe(ring: Column) -> Column:
    """Without vertices that lie on the last one kept; the last is not compared with the first."""

    def step(out: Column, p: Column) -> Column:
        last = F.element_at(out, -1)
        apart = (F.abs(p["lon"] - last["lon"]) > EPSILON) | (F.abs(p["lat"] - last["lat"]) > EPSILON)
        return F.when((F.size(out) == 0) | apart, F.concat(out, F.array(point(p["lon"], p["lat"])))).otherwise(out)

    first = F.slice(ring, 1, 1).cast(RING)
    return F.aggregate(F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))), first, step)


def signed_area(ring: Column, x: str = "lon", y: str = "lat") -> Column:
    """Positive if counter-clockwise; the ring need not be closed."""
    following = F.concat(F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
    terms = F.zip_with(ring, following, lambda a, b: a[x] * b[y] - b[x] * a[y])
    return F.aggregate(terms, F.lit(0.0), lambda s, t: s + t) / 2


def finish(ring: Column) -> Column:
    """Deduped, counter-clockwise, rounded to 10 decimals and closed; fewer than three vertices raise."""

    def closed(clean: Column) -> Column:
        turned = F.when(signed_area(clean) < 0, F.reverse(clean)).otherwise(clean)
        rounded = F.transform(F.concat(turned, F.slice(turned, 1, 1)), lambda p: point(F.round(p["lon"], 10), F.round(p["lat"], 10)))
        return F.when(F.size(clean) < 3, F.raise_error(F.lit("Polygon ring requires at least three distinct vertices.")).cast(RING)).otherwise(rounded)

    # A transform over one element computes it once, however often it is used.
    return F.element_at(F.transform(F.array(dedupe(ring)), closed), 1)


def geometry_of_corners(corners: Column) -> Column:
    """struct(type, polygons) of map SW, NW, SE, NE to (lon, lat); split where it passes the antimeridian.

    polygons is an array of rings, one for a Polygon.
    """
    ring = unwrap(F.array(*[corners[k] for k in ("SW", "NW", "NE", "SE")]).cast(RING))
    # Transforms over one element compute each part once, however often it is used.
    once = lambda value, f: F.element_at(F.transform(F.array(value), f), 1)

    def split(c: Column) -> Column:
        r, at = c["ring"], c["at"]
        left = shift(clip(r, at, True), F.when(at == 180.0, 0.0).otherwise(360.0))
        right = shift(clip(r, at, False), F.when(at == 180.0, -360.0).otherwise(0.0))
        parts = F.filter(F.transform(F.array(left, right), dedupe), lambda p: F.size(p) >= 3)
        return F.when(at.isNull(), F.array(r)).otherwise(parts)

    whole = once(ring, lambda r: once(F.struct(r.alias("ring"), antimeridian(r).alias("at")), split))
    polygons = F.transform(whole, finish)
    return F.struct(F.when(F.size(polygons) == 1, "Polygon").otherwise("MultiPolygon").alias("type"), polygons.alias("polygons"))


def densify(bounds: Column, steps: int = 21) -> Column:
    """Points along the outline of a box, closed: ``steps`` on each side, corners once."""
    if steps < 2:
        raise ValueError("steps must be at least 2.")
    b, t = bounds, lambda i: i / F.lit(float(steps - 1))
    w, h = b["max_x"] - b["min_x"], b["max_y"] - b["min_y"]
    p = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    side = lambda first, last, f: F.transform(F.sequence(F.lit(first), F.lit(last)), lambda i: f(t(i))) if last >= first else F.array().cast("array<struct<x:double,y:double>>")
    out = F.concat(
        side(0, steps - 1, lambda t: p(b["min_x"] + w * t, b["min_y"])),
        side(1, steps - 1, lambda t: p(b["max_x"], b["min_y"] + h * t)),
        side(1, steps - 1, lambda t: p(b["max_x"] - w * t, b["max_y"])),
        side(1, steps - 2, lambda t: p(b["min_x"], b["min_y"] + h * t)),
    )
    return F.when(F.element_at(out, 1) != F.element_at(out, -1), F.concat(out, F.slice(out, 1, 1))).otherwise(out)


def bounds_of_points(points: Column, x: str = "x", y: str = "y") -> Column:
    """struct(min_x, min_y, max_x, max_y); no points raise."""
    xs, ys = F.transform(points, lambda p: p[x]), F.transform(points, lambda p: p[y])
    out = F.struct(F.array_min(xs).alias("min_x"), F.array_min(ys).alias("min_y"), F.array_max(xs).alias("max_x"), F.array_max(ys).alias("max_y"))
    kind = "struct<min_x:double,min_y:double,max_x:double,max_y:double>"
    return F.when(F.size(points) == 0, F.raise_error(F.lit("Geometry has no coordinate points.")).cast(kind)).otherwise(out.cast(kind))


def boxes_intersect(a: Column, b: Column) -> Column:
    """Whether boxes share area; touching edges do not count."""
    return ~((a["max_x"] <= b["min_x"]) | (a["min_x"] >= b["max_x"]) | (a["max_y"] <= b["min_y"]) | (a["min_y"] >= b["max_y"]))


def contains(rings: Column, px: Column, py: Column, x: str = "lon", y: str = "lat") -> Column:
    """Even-odd test of a point against closed or open rings (outer ones and holes together)."""

    def crossings(ring: Column) -> Column:
        following = F.concat(F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
        hit = lambda a, b: ((a[y] > py) != (b[y] > py)) & (px < F.try_divide((b[x] - a[x]) * (py - a[y]), b[y] - a[y]) + a[x])
        return F.aggregate(F.zip_with(ring, following, lambda a, b: F.coalesce(hit(a, b), F.lit(False)).cast("int")), F.lit(0), lambda s, v: s + v)

    return F.aggregate(F.transform(rings, crossings), F.lit(0), lambda s, v: s + v) % 2 == 1

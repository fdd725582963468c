"""Units, coordinates in degrees and minutes, quarters, and code tables (Column expressions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FEET_TO_METERS = 0.3048
#: Fixed value: the form of coordinates in coverage tables.
DMS = r"^(\d+)[^\d]+(\d+)[^A-Za-z]*([NSEW])$"

# Codes of obstacle records and their meanings.
LIGHTING = {
    "R": "Red",
    "D": "Dual Red and Medium Intensity White Strobe",
    "H": "High Intensity White",
    "M": "Medium Intensity White",
    "S": "Dual Medium Intensity White Strobe and Red",
    "F": "Flood",
    "C": "Dual Red and High Intensity White",
    "W": "Synchronized Red Lighting",
    "L": "Lighted (Type Unknown)",
    "N": "Unlighted",
}
HORIZONTAL_ACCURACY = {
    "1": ("+/- 20 ft", 20),
    "2": ("+/- 50 ft", 50),
    "3": ("+/- 100 ft", 100),
    "4": ("+/- 500 ft", 500),
    "5": ("+/- 1,000 ft", 1000),
    "6": ("+/- 2,000 ft", 2000),
    "7": ("+/- 1/2 NM", None),
    "8": ("+/- 1 NM", None),
    "9": ("Unknown", None),
}
VERTICAL_ACCURACY = {
    "A": ("+/- 3 ft", 3),
    "B": ("+/- 10 ft", 10),
    "C": ("+/- 20 ft", 20),
    "D": ("+/- 50 ft", 50),
    "E": ("+/- 125 ft", 125),
    "F": ("+/- 250 ft", 250),
    "G": ("+/- 500 ft", 500),
    "H": ("+/- 1,000 ft", 1000),
    "I": ("Unknown", None),
}
VERIFICATION = {"O": "Verified", "U": "Unverified"}
MARKING = {
    "M": "Marked",
    "P": "Orange or Orange and White Paint",
    "F": "Flag Marker",
    "L": "High Visibility Markers",
    "R": "Spherical Markers",
    "W": "High Visibility Spherical Markers",
    "K": "Marked and Lighted",
}


def feet_to_meters(c: Column) -> Column:
    """Metres to three decimals; null stays null."""
    return F.round(c.cast("double") * F.lit(FEET_TO_METERS), 3)


def lookup(code: Column, values: dict[str, object], default=None) -> Column:
    pairs = [F.lit(x) for kv in values.items() if kv[1] is not None for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.upper(code)), F.lit(default))


def description(code: Column, values: dict) -> Column:
    """What a code means; 'Unknown' if nothing."""
    return lookup(code, {k: v[0] if isinstance(v, tuple) else v for k, v in values.items()}, "Unknown")


def accuracy_feet(code: Column, values: dict) -> Column:
    return lookup(code, {k: v[1] for k, v in values.items()})


def dms_to_degrees(c: Column) -> Column:
    """Degrees of texts like 32°00'N (any marks, case ignored); null if the text has another form."""
    t = F.upper(F.btrim(c))
    pattern = DMS
    part = lambda i: F.regexp_extract(t, pattern, i)
    value = part(1).try_cast("int") + part(2).try_cast("int") / F.lit(60.0)
    return F.when(t.rlike(pattern), F.when(part(3).isin("S", "W"), -value).otherwise(value))


def coordinate_error(degrees: Column, minutes: Column, seconds: Column, hemisphere: Column, axis: str) -> Column:
    """The first thing wrong with the parts of a coordinate (texts), or null; axis is lat or lon."""
    d, m, s = degrees.try_cast("int"), minutes.try_cast("int"), seconds.try_cast("double")
    most, letters = (90, ("N", "S")) if axis == "lat" else (180, ("E", "W"))
    return (
        F.when(d.isNull() | m.isNull() | s.isNull() | F.isnan(s), f"invalid {axis} coordinate numeric component")
        .when((m < 0) | (m >= 60), f"{axis} minutes must be in [0, 59]")
        .when((s < 0) | (s >= 60), f"{axis} seconds must be in [0, 60)")
        .when((d < 0) | (d > most), f"{axis} degrees must be in [0, {most}]")
        .when(~F.upper(hemisphere).isin(*letters), f"{axis} hemisphere must be {letters[0]} or {letters[1]}")
    )


def coordinate(degrees: Column, minutes: Column, seconds: Column, hemisphere: Column) -> Column:
    """Decimal degrees to eight decimals; null if a part is no number."""
    value = degrees.try_cast("int") + minutes.try_cast("int") / F.lit(60.0) + seconds.try_cast("double") / F.lit(3600.0)
    return F.round(F.when(F.upper(hemisphere).isin("S", "W"), -value).otherwise(value), 8)


def gml_position(c: Column) -> Column:
    """struct(lon, lat) of 'lon lat'; null if there are fewer numbers."""
    parts = F.split(F.btrim(c, F.lit(" \t\r\n")), r"\s+")
    at = lambda i: F.try_element_at(parts, F.lit(i)).try_cast("double")
    return F.when(at(1).isNotNull() & at(2).isNotNull(), F.struct(at(1).alias("lon"), at(2).alias("lat")))


def channel_id(href: Column) -> Column:
    """The quoted id in a reference to a radio channel; null for other references."""
    return F.when(href.contains("RadioCommunicationChannel") & href.rlike("'.*'"), F.regexp_extract(href, "'(.*)'", 1))


def quarter_start(c: Column) -> Column:
    """First moment of 'YYYY-Qn'; other texts raise."""
    ok = c.rlike("^[0-9]{4}-Q[1-4]$")
    start = F.make_timestamp_ntz(F.substring(c, 1, 4).cast("int"), F.substring(c, 7, 1).cast("int") * 3 - 2, F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    return F.when(ok, start).otherwise(F.raise_error(F.concat(F.lit("not a quarter like 2024-Q1: "), c)).cast("timestamp_ntz"))


def quarter_bounds(c: Column) -> Column:
    """struct(start, end): the half-open interval of a quarter as ISO times."""
    start = quarter_start(c)
    iso = lambda t: F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.struct(iso(start).alias("start"), iso(F.add_months(start.cast("date"), 3).cast("timestamp_ntz")).alias("end"))


def quarter_of(ts: Column) -> Column:
    return F.concat(F.year(ts).cast("string"), F.lit("-Q"), F.quarter(ts).cast("string"))

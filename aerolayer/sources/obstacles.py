"""Fixed-width obstacle files: scan, validation in column order, decoding."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import measures as m
from ..functions.text import state_filter

#: What record lines and state files look like.
RECORD_LINE = "^[A-Z0-9]{2}-[A-Z0-9]{6}"
RECORD_LENGTH = 127
STATE_FILE = "(?i)^[0-9]{2}-[A-Z]{2}[.]DAT$"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_number, line) of text files; lines are numbered from 1, invalid bytes replaced."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.make_valid_utf8("value").alias("value"))
    # A line break ends a line, so the piece after the last one is no line.
    lines = F.split(F.regexp_replace("value", r"\r\n?|\n$", "\n"), "\n")
    numbered = whole.select("file", F.posexplode(lines).alias("pos", "line"), F.size(lines).alias("n"))
    return numbered.where("not (pos = n - 1 and line = '')").select("file", (F.col("pos") + 1).alias("line_number"), "line")


def read_state_files(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of all state files of a folder; raises if it is missing or has none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        raise ValueError(f"Input directory does not exist: {folder}")
    if not fs.getFileStatus(path).isDirectory():
        raise ValueError(f"Input path is not a directory: {folder}")
    names = sorted(s.getPath().getName() for s in fs.listStatus(path) if s.isFile())
    import re

    names = [n for n in names if re.fullmatch(STATE_FILE.removeprefix("(?i)^").removesuffix("$"), n, re.I)]
    if not names:
        raise ValueError(f"No obstacle state files found in {folder} (expected names like 49-UT.Dat).")
    return read_lines(spark, [os.path.join(folder, n) for n in names])


def is_record(line: Column) -> Column:
    return (F.length(line) >= RECORD_LENGTH) & line.rlike(RECORD_LINE)


#: Columns of a record line, from 1, inclusive.
FIELDS = {
    "oas": (1, 2), "number": (4, 9), "verification": (11, 11), "country": (13, 14), "state": (16, 17), "city": (19, 34),
    "lat_degrees": (36, 37), "lat_minutes": (39, 40), "lat_seconds": (42, 46), "lat_hemisphere": (47, 47),
    "lon_degrees": (49, 51), "lon_minutes": (53, 54), "lon_seconds": (56, 60), "lon_hemisphere": (61, 61),
    "kind": (63, 80), "quantity": (82, 82), "agl": (84, 88), "amsl": (90, 94), "lighting": (96, 96), "horizontal": (98, 98),
    "vertical": (100, 100), "mark": (102, 102), "study": (104, 117), "action": (119, 119), "julian": (121, 127),
}


#: What is wrong with a place, in column order: condition on the parts d, m, s, h of an axis, and message.
PLACE_RULES = [
    ("{d} = ''", "missing {axis} degrees"),
    ("{m} = ''", "missing {axis} minutes"),
    ("{s} = ''", "missing {axis} seconds"),
    ("{h} = ''", "missing {axis} hemisphere"),
    ("{d}_n IS NULL OR {m}_n IS NULL OR {s}_n IS NULL OR isnan({s}_n)", "invalid {short} coordinate numeric component"),
    ("{m}_n < 0 OR {m}_n >= 60", "{short} minutes must be in [0, 59]"),
    ("{s}_n < 0 OR {s}_n >= 60", "{short} seconds must be in [0, 60)"),
    ("{d}_n < 0 OR {d}_n > {most}", "{short} degrees must be in [0, {most}]"),
    ("upper({h}) NOT IN ('{plus}', '{minus}')", "{short} hemisphere must be {plus} or {minus}"),
]
AXES = [
    {"short": "lat", "axis": "latitude", "most": 90, "plus": "N", "minus": "S"},
    {"short": "lon", "axis": "longitude", "most": 180, "plus": "E", "minus": "W"},
]
for _a in AXES:
    _a |= {p[0]: f"__{_a['short']}_{p}" for p in ("degrees", "minutes", "seconds", "hemisphere")}
#: What is wrong with a record, in column order.
RULES = [
    ("__oas = ''", "missing OAS code"),
    ("__number = ''", "missing obstacle number"),
    ("__verification = ''", "missing verification status"),
    ("__country = ''", "missing country identifier"),
    ("upper(__country) = 'US' AND __state = ''", "missing state identifier for US record"),
    *[(rule.format(**a), message.format(**a)) for a in AXES for rule, message in PLACE_RULES],
    ("__kind = ''", "missing obstacle type"),
    ("__quantity <> '' AND __quantity_n IS NULL", "quantity must be an integer when present"),
    ("__agl = ''", "missing AGL height"),
    ("__agl_n IS NULL", "AGL height must be an integer"),
    ("__amsl = ''", "missing AMSL height"),
    ("__amsl_n IS NULL", "AMSL height must be an integer"),
    ("__action = ''", "missing action"),
    ("__julian = ''", "missing julian date"),
    ("NOT (__julian RLIKE '^[0-9]+$')", "julian date must be a 7-digit numeric value"),
]
NUMBERS = {"lat_degrees": "int", "lat_minutes": "int", "lat_seconds": "double", "lon_degrees": "int", "lon_minutes": "int", "lon_seconds": "double", "quantity": "int", "agl": "int", "amsl": "int"}


def parse(lines: DataFrame) -> DataFrame:
    """Record lines of ``lines`` (line, and any other columns) with their fields and parse_error.

    parse_error is the first thing wrong in column order, or null; other lines are left out.  Fields are cut
    once, in a projection of their own, since costly columns with several uses are not merged into those; and
    errors are made once: a condition on the partition keeps filters on them from being pushed below.
    """
    keep = [c for c in lines.columns if c != "line"]
    rows = lines.where(is_record(F.col("line")))
    rows = rows.select(*keep, *[F.expr(f"btrim(substring(line, {a}, {b - a + 1}), ' \\t\\r\\n\\u000B\\u000C') AS __{name}") for name, (a, b) in FIELDS.items()])
    rows = rows.select("*", *[F.expr(f"try_cast(__{c} AS {t}) AS __{c}_n") for c, t in NUMBERS.items()])
    error = " ".join(f"WHEN {rule} THEN '{message}'" for rule, message in RULES)
    place = "round(if(upper({h}) = '{minus}', -1, 1) * ({d}_n + {m}_n / 60.0D + {s}_n / 3600.0D), 8) AS {axis}"
    return rows.select(
        *keep,
        F.expr(f"CASE WHEN spark_partition_id() < 0 THEN '' {error} END AS parse_error"),
        *[F.expr(f"nullif(__{c}, '') AS {name}") for c, name in (("oas", "oas_code"), ("number", "obstacle_number"))],
        *[F.expr(f"nullif(upper(__{c}), '') AS {name}") for c, name in (("verification", "verification_status_code"), ("country", "country_identifier"), ("state", "state_identifier"))],
        F.expr("nullif(__city, '') AS city_name"),
        *[F.expr(place.format(**a)) for a in AXES],
        F.expr("nullif(__kind, '') AS obstacle_type"),
        *[F.expr(x) for x in ("__quantity_n AS quantity", "__agl_n AS agl_height_ft", "__amsl_n AS amsl_height_ft")],
        *[F.expr(f"upper(__{c}) AS {name}") for c, name in (("lighting", "lighting_code"), ("horizontal", "horizontal_accuracy_code"), ("vertical", "vertical_accuracy_code"), ("mark", "mark_indicator_code"))],
        *[F.expr(x) for x in ("nullif(__study, '') AS faa_study_number", "nullif(upper(__action), '') AS action", "nullif(__julian, '') AS julian_date")],
    )


def good(parsed: DataFrame) -> DataFrame:
    return parsed.where("parse_error is null").drop("parse_error")


def errors(parsed: DataFrame, file: str = "file") -> DataFrame:
    """(file, line_number, message): what is reported of lines that don't parse."""
    text = F.concat(F.col(file), F.lit(":"), F.col("line_number"), F.lit(": parse error: "), F.col("parse_error"))
    return parsed.where("parse_error is not null").select(file, "line_number", text.alias("message"))


def in_states(states) -> Column:
    """Whether a record is of one of the states, countries or OAS codes; everything if there are none."""
    wanted = state_filter(states)
    if wanted is None:
        return F.lit(True)
    return F.coalesce("state_identifier", F.lit("")).isin(wanted) | F.col("country_identifier").isin(wanted) | F.upper("oas_code").isin(wanted)


def summary(parsed: DataFrame, states=None, by: str | None = None) -> DataFrame:
    """Counts of scanned, parsed, skipped and wrong record lines; with ``by``, of each value and the total."""
    ok = F.col("parse_error").isNull()
    counts = [
        F.count("*").alias("scanned_record_lines"),
        F.count_if(ok & in_states(states)).alias("parsed_count"),
        F.count_if(ok & ~in_states(states)).alias("skipped_by_state_count"),
        F.count_if(~ok).alias("error_count"),
    ]
    return parsed.rollup(by).agg(*counts) if by else parsed.agg(*counts)


def normalize(records: DataFrame) -> DataFrame:
    """Records as nested objects with decoded codes and metres; all keys are there, null or not."""
    s, c = F.struct, F.col
    heights = lambda name: s(c(name).alias("feet"), m.feet_to_meters(c(name)).alias("meters"))
    coded = lambda name, values: s(c(name).alias("code"), m.description(c(name), values).alias("description"))

    def accuracy(name: str, values: dict) -> Column:
        feet = m.accuracy_feet(c(name), values)
        return s(c(name).alias("code"), m.description(c(name), values).alias("description"), feet.alias("feet"), m.feet_to_meters(feet).alias("meters"))

    return records.select(
        F.concat_ws("-", "oas_code", "obstacle_number").alias("obstacle_id"),
        s(c("line_number")).alias("source"),
        "country_identifier",
        "state_identifier",
        "city_name",
        s("latitude", "longitude").alias("location"),
        "obstacle_type",
        "quantity",
        s(heights("agl_height_ft").alias("agl"), heights("amsl_height_ft").alias("amsl")).alias("heights"),
        coded("lighting_code", m.LIGHTING).alias("lighting"),
        accuracy("horizontal_accuracy_code", m.HORIZONTAL_ACCURACY).alias("horizontal_accuracy"),
        accuracy("vertical_accuracy_code", m.VERTICAL_ACCURACY).alias("vertical_accuracy"),
        coded("verification_status_code", m.VERIFICATION).alias("verification_status"),
        coded("mark_indicator_code", m.MARKING).alias("mark_indicator"),
        "faa_study_number",
        "action",
        "julian_date",
    )

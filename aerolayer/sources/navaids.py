"""Navigation aids in AIXM XML: members, radio channels, and the join between them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import channel_id, feet_to_meters, gml_position
from ..functions.text import text_or_null

#: Types that count as navigation aids.
NAVAID_TYPES = ["VOR", "VOR_DME", "VORTAC", "NDB", "NDB_DME", "TACAN", "DME", "OTHER:VOT", "OTHER:FAN_MARKER", "OTHER:MARINE_NDB"]

_POINT = "ElevatedPoint struct<pos:string,elevation:struct<_VALUE:string,_uom:string>>"
_NAVAID = f"""_id string, timeSlice struct<NavaidTimeSlice:struct<type:string,designator:string,name:string,
  location:struct<{_POINT}>,
  navaidEquipment:array<struct<NavaidComponent:struct<theNavaidEquipment:struct<_VALUE:string,_href:string>>>>,
  extension:struct<NavaidExtension:struct<navaidClass:string,navaidStatus:string,stateName:string,
    associatedCity:struct<City:struct<name:string>>,
    contact:struct<ContactInformation:struct<address:struct<PostalAddress:struct<administrativeArea:string>>>>>>>>"""
_CHANNEL = """_id string, timeSlice struct<RadioCommunicationChannelTimeSlice:struct<frequencyTransmission:struct<_VALUE:string,_uom:string>,channel:string>>"""
MEMBER = f"Navaid struct<{_NAVAID.replace(' string', ':string').replace('timeSlice struct', 'timeSlice:struct').replace('ElevatedPoint struct', 'ElevatedPoint:struct')}>, RadioCommunicationChannel struct<{_CHANNEL.replace(' string', ':string').replace('timeSlice struct', 'timeSlice:struct')}>"
OPTIONS = {"ignoreNamespace": "true", "rowTag": "Member", "mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false"}


def read_members(spark: SparkSession, path: str) -> DataFrame:
    """(member): one struct for each member of XML files."""
    rows = spark.read.format("xml").options(**OPTIONS).schema(MEMBER).load(path)
    return rows.select(F.struct(*rows.columns).alias("member"))


def members_of(texts: DataFrame, column: str) -> DataFrame:
    """texts with ``member`` parsed from a column of member XML, once: the explode keeps it from being merged into its uses."""
    parsed = F.from_xml(F.col(column), MEMBER, {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false"})
    return texts.select(*[c for c in texts.columns if c != "member"], F.explode(F.array(parsed)).alias("member"))


def effective_date(spark: SparkSession, path: str) -> str | None:
    """validFrom of the root element, or None."""
    root = spark.read.text(path, wholetext=True).select(F.regexp_extract("value", r"<(?:\w+:)?SubscriberFile\b[^>]*?\bvalidFrom\s*=\s*[\"']([^\"']*)", 1).alias("d"))
    found = root.where("d <> ''").limit(1).collect()
    return found[0].d if found else None


def raw_navaids(members: DataFrame) -> DataFrame:
    """Navigation aids with references ``rcc_ids`` in order, and parse_error; other members are left out.

    A position or elevation that is no number is an error; no position at all means (0, 0), as
    has_location tells.
    """
    t = lambda path: text_or_null(F.col(f"member.Navaid.timeSlice.NavaidTimeSlice.{path}"))
    pos = t("location.ElevatedPoint.pos")
    elevation = t("location.ElevatedPoint.elevation._VALUE")
    at = gml_position(pos)
    refs = F.transform(F.coalesce("member.Navaid.timeSlice.NavaidTimeSlice.navaidEquipment", F.array()), lambda e: channel_id(e["NavaidComponent"]["theNavaidEquipment"]["_href"]))
    error = (
        F.when(F.size(F.split(F.btrim(pos, F.lit(" \t\r\n")), r"\s+")) < 2, F.concat(F.lit("gml:pos requires at least 2 coordinates, got: "), pos))
        .when(pos.isNotNull() & at.isNull(), F.concat(F.lit("could not convert position to numbers: "), pos))
        .when(elevation.isNotNull() & elevation.try_cast("double").isNull(), F.concat(F.lit("could not convert string to float: "), elevation))
    )
    ext = "extension.NavaidExtension"
    fits = F.col("member.Navaid.timeSlice.NavaidTimeSlice").isNotNull() & t("type").isin(NAVAID_TYPES) & t("designator").isNotNull() & t("name").isNotNull()
    return members.where(fits).select(
        *[c for c in members.columns if c != "member"],
        error.alias("parse_error"),
        t("type").alias("navaid_type"),
        t("designator").alias("designator"),
        t("name").alias("name"),
        F.coalesce(at["lat"], F.lit(0.0)).alias("latitude"),
        F.coalesce(at["lon"], F.lit(0.0)).alias("longitude"),
        pos.isNotNull().alias("has_location"),
        elevation.try_cast("double").alias("elevation_ft"),
        F.filter(refs, lambda r: r.isNotNull()).alias("rcc_ids"),
        t(f"{ext}.navaidClass").alias("navaid_class"),
        t(f"{ext}.navaidStatus").alias("navaid_status"),
        t(f"{ext}.stateName").alias("state_name"),
        t(f"{ext}.contact.ContactInformation.address.PostalAddress.administrativeArea").alias("administrative_area"),
        t(f"{ext}.associatedCity.City.name").alias("associated_city"),
    )


def channels(members: DataFrame) -> DataFrame:
    """(rcc_id, frequency_mhz, channel, other columns) of each radio channel with an id."""
    c = "member.RadioCommunicationChannel"
    s = f"{c}.timeSlice.RadioCommunicationChannelTimeSlice"
    return members.where(F.col(f"{c}._id").isNotNull()).select(
        *[x for x in members.columns if x != "member"],
        F.col(f"{c}._id").alias("rcc_id"),
        text_or_null(F.col(f"{s}.frequencyTransmission._VALUE")).try_cast("double").alias("frequency_mhz"),
        F.nullif(text_or_null(F.col(f"{s}.channel")), F.lit("")).alias("channel"),
    )


def last_of_each(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each key: the one with the largest ``order``."""
    rest = [c for c in rows.columns if c not in (key, order)]
    best = rows.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("r"))
    return best.select(key, *[f"r.{c}" for c in rest])


def resolve(navaids: DataFrame, rcc: DataFrame, key: str) -> DataFrame:
    """navaids (with unique ``key`` and rcc_ids) plus frequency_mhz and channel.

    Each is the first that is not null among the referenced channels, in the order of references;
    references to nothing are ignored, and every navaid stays.
    """
    refs = navaids.select(key, F.posexplode("rcc_ids").alias("pos", "rcc_id")).join(rcc, "rcc_id")
    first = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("pos"))).alias(c)
    found = refs.groupBy(key).agg(first("frequency_mhz"), first("channel"))
    return navaids.join(found, key, "left").drop("rcc_ids")


def summary(members: DataFrame) -> DataFrame:
    """navaid_count, rcc_count (repeated ids count) and error_count."""
    raw = raw_navaids(members.select("member"))
    counts = raw.agg(F.count_if(F.col("parse_error").isNull()).alias("navaid_count"), F.count_if(F.col("parse_error").isNotNull()).alias("error_count"))
    return counts.crossJoin(channels(members.select("member")).agg(F.count("*").alias("rcc_count"))).select("navaid_count", "rcc_count", "error_count")


def normalize(navaids: DataFrame) -> DataFrame:
    """Navaids as nested objects; structs without a value are null, so that JSON leaves them out."""
    c = F.col
    frequency = F.struct(c("frequency_mhz").alias("mhz"), c("channel").alias("channel"))
    return navaids.select(
        F.concat_ws("-", "designator", "navaid_type").alias("navaid_id"),
        "navaid_type",
        "designator",
        "name",
        F.struct("latitude", "longitude").alias("location"),
        F.when(c("elevation_ft").isNotNull(), F.struct(c("elevation_ft").alias("feet"), feet_to_meters(c("elevation_ft")).alias("meters"))).alias("elevation"),
        F.when(c("frequency_mhz").isNotNull() | c("channel").isNotNull(), frequency).alias("frequency"),
        "navaid_class",
        "navaid_status",
        "state_name",
        "administrative_area",
        "associated_city",
    )

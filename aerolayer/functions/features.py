"""GeoJSON features from normalized records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .projection import transform


def amsl_meters() -> Column:
    meters = F.col("heights.amsl.meters")
    return F.coalesce(meters, F.raise_error(F.lit("normalized record heights.amsl.meters must be numeric")).cast("double"))


def to_features(records: DataFrame, system: str = "wgs84", amsl_z: bool = False) -> DataFrame:
    """(type, geometry, properties): points of ``location``, all other columns as properties, keys sorted."""
    p = transform(system)(F.col("location.longitude"), F.col("location.latitude"))
    xyz = [p["x"], p["y"], *([amsl_meters()] if amsl_z else [])]
    located = F.col("location.longitude").isNotNull() & F.col("location.latitude").isNotNull()
    position = F.when(located, F.array(*xyz)).otherwise(F.raise_error(F.lit("normalized record location must include numeric latitude/longitude")).cast("array<double>"))
    properties = F.struct(*sorted(c for c in records.columns if c != "location"))
    return records.select(
        F.struct(position.alias("coordinates"), F.lit("Point").alias("type")).alias("geometry"), properties.alias("properties"), F.lit("Feature").alias("type")
    )


def to_json_text(features: DataFrame, keep_nulls: bool = True) -> DataFrame:
    """(value): one feature a row as JSON."""
    return features.select(F.to_json(F.struct(*sorted(features.columns)), {"ignoreNullFields": str(not keep_nulls).lower()}).alias("value"))

"""The session that the command line and tests use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, **conf) -> SparkSession:
    """A session in UTC with adaptive execution; shuffle partitions are left to the cluster unless given."""
    b = SparkSession.builder.appName("aerolayer").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.ui.showConsoleProgress", "false")
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()

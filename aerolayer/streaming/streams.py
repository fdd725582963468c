"""Structured Streaming forms of the record operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.features import to_features
from ..functions.measures import quarter_of
from ..sources import obstacles


def obstacle_lines(spark: SparkSession, folder: str, files_at_once: int = 16) -> DataFrame:
    """A stream of obstacle lines of new files: the same columns as the batch reader."""
    raw = spark.readStream.format("text").option("wholetext", "true").option("maxFilesPerTrigger", files_at_once).load(folder)
    lines = F.split(F.regexp_replace(F.make_valid_utf8("value"), "\r\n?", "\n"), "\n")
    return raw.select(F.col("_metadata.file_path").alias("file"), F.posexplode(lines).alias("pos", "line")).select("file", (F.col("pos") + 1).alias("line_number"), "line")


def obstacle_features(lines: DataFrame, system: str = "wgs84", states=None) -> DataFrame:
    """Features of a stream (or batch) of lines; wrong lines are left out."""
    good = obstacles.good(obstacles.parse(lines)).where(obstacles.in_states(states))
    return to_features(obstacles.normalize(good), system)


def each_batch(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str):
    """Runs a stream over what is there, batch by batch, and returns when it is through.

    The checkpoint makes a later call resume after the batches already written.
    """
    q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def quarter_counts(events: DataFrame, ts: str = "ts", watermark: str | None = None) -> DataFrame:
    """(quarter, n) of a stream or batch; watermark bounds the state of an endless stream."""
    rows = events.withWatermark(ts, watermark) if watermark else events
    return rows.groupBy(quarter_of(F.col(ts)).alias("quarter")).agg(F.count("*").alias("n"))

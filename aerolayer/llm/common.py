"""Helpers shared by the training-data operators: scratch tables, tokens, components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Byte table that lower-cases A-Z and turns ASCII punctuation and digits into spaces.
LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 or c in (9, 10, 11, 12, 13) else 32 for c in range(256)
)


def release() -> None:
    """Gives freed memory of a Python worker back before it waits for its next task."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except OSError:  # another C library
        pass


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a local one only where that is unset."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="aerolayer-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/aerolayer-llm/{name}-{uuid.uuid4().hex}"


class Scratch:
    """Written tables that cut lineage; ``drop`` frees those that later steps no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, {}

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(self.spark, f"{self.name}-{label}")
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            if path := self.paths.pop(id(t), None):
                p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of undirected ``edges`` (long columns a and b).

    Alternates large-star and small-star steps on written tables, so each step moves at most the
    edges, converges in a logarithmic number of rounds and never gathers a component in one task:
    minima are pre-aggregated and written, so that the joins back are plain sort-merge joins, whose hot
    keys AQE splits.
    component is the smallest node reachable.
    """
    scratch = Scratch(edges.sparkSession, "components")
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = scratch.write(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    seen = None
    while True:
        # Large star: every larger neighbour of u is tied to the least of u and its neighbours.
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = scratch.write(least, "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.write(large.where("u <> v").distinct(), "large")
        # Small star: u and its smaller neighbours are tied to the least of those.
        lesser = scratch.write(large.groupBy("u").agg(F.min("v").alias("m")), "lesser")
        small = large.join(lesser, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            lesser.select("u", F.col("m").alias("v"))
        )
        small = scratch.write(small.where("u <> v").distinct(), "small")
        state = small.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        scratch.drop(e, least, large, lesser)
        e = small
        if tuple(state) == seen:
            break
        seen = tuple(state)
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)

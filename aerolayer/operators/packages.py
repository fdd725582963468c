"""Cycles and packages of an index site: discovery, plan, manifest."""

from __future__ import annotations

import os
import zipfile
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import base_name, cycle_tokens, stem, url_join
from ..sources.web import hrefs

# Folders of the chart types below a cycle, and the sets whose presence shows that it is out.
SUBFOLDERS = {"sectional": "sectional-files", "tac": "tac-files"}
COMPLETE_SETS = {"sectional": "Sectional.zip", "tac": "Terminal.zip"}


def cycles(pages: DataFrame, html: str = "html") -> DataFrame:
    """(cycle, cycle_date) of the distinct MM-DD-YYYY parts of all links, sorted by date."""
    parts = pages.select(F.explode(hrefs(F.col(html))).alias("href")).select(F.explode(cycle_tokens(F.col("href"))).alias("cycle")).distinct()
    return parts.select("cycle", F.to_date("cycle", "MM-dd-yyyy").alias("cycle_date")).orderBy("cycle_date")


def latest_complete(published: DataFrame, chart_types: list[str], cycle: str = "cycle", kind: str = "chart_type", order: str = "cycle_date") -> DataFrame:
    """The newest cycle of ``published`` (one row for each cycle and type that is out) with all chart types."""
    rows = published.where(F.col(kind).isin(chart_types)).groupBy(cycle, order).agg(F.count_distinct(kind).alias("n"))
    return rows.where(F.col("n") == len(set(chart_types))).orderBy(F.desc(order)).limit(1).select(cycle, order)


def packages(indexes: DataFrame) -> DataFrame:
    """(chart_type, cycle, zip_name, folder_name, url) of indexes (chart_type, cycle, index_url, html).

    Of links to one zip name the last counts; sorted by type and folder.
    """
    links = indexes.select("chart_type", "cycle", "index_url", F.posexplode(hrefs(F.col("html"))).alias("pos", "href"))
    url = url_join(F.col("index_url"), F.col("href"))
    path = F.regexp_extract(url, "^([^?#]*)", 1)
    zips = links.select("chart_type", "cycle", "pos", url.alias("url"), path.alias("path")).where(F.lower("path").endswith(".zip"))
    zips = zips.groupBy("chart_type", "cycle", base_name(F.col("path")).alias("zip_name")).agg(F.max_by("url", "pos").alias("url"))
    return zips.select("chart_type", "cycle", "zip_name", stem(F.col("zip_name")).alias("folder_name"), "url").orderBy("chart_type", "folder_name")


def with_status(specs: DataFrame, existing: DataFrame, skip_existing: bool = True, dry_run: bool = False) -> DataFrame:
    """specs (zip_path, ...) with status and downloaded; existing: (zip_path, size) of files that are there."""
    rows = specs.join(existing.select("zip_path", F.col("size").alias("existing_size")), "zip_path", "left")
    there = (F.coalesce("existing_size", F.lit(0)) > 0) & F.lit(skip_existing and not dry_run)
    status = F.when(there, "skipped-existing").otherwise("dry-run" if dry_run else "downloaded")
    return rows.withColumn("status", status).withColumn("downloaded", F.col("status") == "downloaded")


def summary(results: DataFrame, *by: str) -> DataFrame:
    return results.groupBy(*by).agg(
        F.count("*").alias("package_count"), F.count_if("downloaded").alias("downloaded_count"), F.count_if(F.col("status") == "skipped-existing").alias("skipped_count")
    )


def download(url: str, target: str, opener: Callable, chunk: int = 1 << 20) -> dict:
    """Writes to target.tmp in chunks and renames it at the end; nothing stays behind after an error."""
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    part, n = f"{target}.tmp", 0
    try:
        with opener(url) as r, open(part, "wb") as f:
            headers = {k.lower(): v for k, v in dict(getattr(r, "headers", {})).items()}
            while data := r.read(chunk):
                f.write(data)
                n += len(data)
        os.replace(part, target)
    finally:
        if os.path.exists(part):
            os.unlink(part)
    return {"bytes_written": n, "headers": headers}


def safe_unzip(archive: str, folder: str) -> int:
    """Number of files extracted; a member that would land outside the folder raises before any is written."""
    root = os.path.realpath(folder)
    os.makedirs(root, exist_ok=True)
    with zipfile.ZipFile(archive) as z:
        for m in z.infolist():
            if os.path.commonpath([root, os.path.realpath(os.path.join(root, m.filename))]) != root:
                raise ValueError(f"Unsafe zip entry path: {m.filename}")
        z.extractall(root)
        return sum(not m.is_dir() for m in z.infolist())

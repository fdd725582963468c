"""HTML indexes and sidecars, URL lists, and checked access to remote files."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# How links and sidecar fields are written.
HREF = r"(?i)href\s*=\s*[\"']?([^\"'\s>]+)"
META = {"originator": ("dc\\.creator", r"Originator:</em>\s*<dd>\s*(.*?)\s*</dd>"), "publication_date": ("dc\\.date", r"Publication_Date:</em>\s*([^<]+)</dt>")}
SERIES = r"(?is)Series_Name:</em>\s*([^<]+)</dt>"
SIDES = {"min_lon": ("x\\.min", "West"), "max_lon": ("x\\.max", "East"), "min_lat": ("y\\.min", "South"), "max_lat": ("y\\.max", "North")}


def hrefs(html: Column) -> Column:
    """All link targets in order, quoted or not."""
    return F.transform(F.regexp_extract_all(html, F.lit(HREF), F.lit(1)), lambda h: F.btrim(h))


def found(html: Column, pattern: str) -> Column:
    """The first group of a pattern with white space collapsed; null if it is not there or empty."""
    text = F.btrim(F.regexp_replace(F.regexp_extract(html, pattern, 1), r"\s+", " "))
    return F.when(html.rlike(pattern), F.nullif(text, F.lit("")))


def sidecar_metadata(html: Column) -> Column:
    """struct(originator, publication_date, series_name); the body wins over meta tags."""
    values = [F.coalesce(found(html, "(?is)" + body), found(html, f'(?is)<meta name="{meta}" content="([^"]+)"')).alias(k) for k, (meta, body) in META.items()]
    return F.struct(*values, found(html, SERIES).alias("series_name"))


def sidecar_bounds(html: Column) -> Column:
    """struct(min_lon, min_lat, max_lon, max_lat) or null: all four from meta tags, or else all four from the body."""
    meta = {k: found(html, f'(?is)<meta name="dc\\.coverage\\.{m}"[^>]*content="([^"]+)"') for k, (m, _) in SIDES.items()}
    body = {k: found(html, rf"(?is){b}_Bounding_Coordinate:</em>\s*([^<]+)</dt>") for k, (_, b) in SIDES.items()}
    whole = lambda d: d["min_lon"].isNotNull() & d["max_lon"].isNotNull() & d["min_lat"].isNotNull() & d["max_lat"].isNotNull()
    v = {k: F.when(whole(meta), meta[k]).otherwise(body[k]).cast("double") for k in SIDES}
    out = F.struct(
        F.least(v["min_lon"], v["max_lon"]).alias("min_lon"), F.least(v["min_lat"], v["max_lat"]).alias("min_lat"), F.greatest(v["min_lon"], v["max_lon"]).alias("max_lon"), F.greatest(v["min_lat"], v["max_lat"]).alias("max_lat")
    )
    return F.when(whole(meta) | whole(body), out)


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """(url) of a list file; blank lines and # comments are left out."""
    line = F.btrim("value")
    return spark.read.text(path).select(line.alias("url")).where((F.col("url") != "") & ~F.col("url").startswith("#"))


def fetch_text(url: str, timeout: float = 30, opener: Callable = urllib.request.urlopen) -> str:
    with opener(urllib.request.Request(url, headers={"User-Agent": "aerolayer"}), timeout=timeout) as r:
        return r.read().decode("utf-8", "replace")


def url_exists(url: str, timeout: float = 30, opener: Callable = urllib.request.urlopen) -> bool:
    """By HEAD, or GET where HEAD is not allowed; errors of the network mean no."""
    for method in ("HEAD", "GET"):
        try:
            with opener(urllib.request.Request(url, method=method, headers={"User-Agent": "aerolayer"}), timeout=timeout) as r:
                return 200 <= r.status < 400
        except urllib.error.HTTPError as e:
            if method == "GET" or e.code not in (405, 501):
                return False
        except urllib.error.URLError:
            return False
    return False


def is_transient(error: Exception) -> bool:
    """Whether a request may succeed when it is repeated: not where the server has refused it."""
    if isinstance(error, urllib.error.HTTPError):
        return error.code == 429 or error.code >= 500
    return isinstance(error, OSError)


def with_retry(action: Callable, transient: tuple | Callable = is_transient, attempts: int = 3, base: float = 8, sleep: Callable = time.sleep):
    """action(), repeated after base**attempt seconds on transient errors (a test or exception types); the last error is raised."""
    passing = transient if callable(transient) and not isinstance(transient, type) else lambda e: isinstance(e, transient)
    for attempt in range(1, attempts + 1):
        try:
            return action()
        except Exception as e:
            if attempt == attempts or not passing(e):
                raise
            sleep(base**attempt)

"""Names, keys and other strings (Column expressions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Endings of terminal chart names, in the order they are tried.
TERMINAL_SUFFIXES = [" TAC VFR Planning Charts", " TAC", " FLY", " Graphic", " Planning Chart"]


def failing(message: Column | str) -> Column:
    return F.raise_error(F.lit(message) if isinstance(message, str) else message)


def text_or_null(c: Column) -> Column:
    """Trimmed text; null stays null and empty becomes null, but white space alone becomes ''."""
    return F.when(F.length(c) > 0, F.btrim(c, F.lit(" \t\r\n\f\v")))


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.btrim(c, F.lit(" \t\r\n\f\v")), F.lit(""))


def key_strict(c: Column, checked: bool = True) -> Column:
    """Lower-case letters and digits of a chart name; an empty key raises if checked, else is null."""
    key = F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")
    empty = failing(F.concat(F.lit("chart name has no letters or digits: "), c)) if checked else F.lit(None)
    return F.when(key == "", empty.cast("string")).otherwise(key)


def key_lenient(c: Column) -> Column:
    """Letters and digits of any script, lower-cased, without a trailing ' sec' or ' sectional'."""
    spaced = F.btrim(F.regexp_replace(F.regexp_replace(F.lower(c), "[_-]", " "), r"\s+", " "))
    return F.regexp_replace(F.regexp_replace(spaced, " (?:sec|sectional)$", ""), r"[^\p{L}\p{N}]", "")


def slug(c: Column, checked: bool = True) -> Column:
    """Runs of other characters become '-', trimmed at both ends; empty raises if checked, else is null."""
    s = F.btrim(F.regexp_replace(F.lower(F.btrim(c)), "[^a-z0-9]+", "-"), F.lit("-"))
    empty = failing(F.concat(F.lit("no file name for chart: "), c)) if checked else F.lit(None)
    return F.when(s == "", empty.cast("string")).otherwise(s)


def chart_filename(c: Column) -> Column:
    return F.concat(slug(c), F.lit(".geojson"))


def terminal_base_name(stem: Column, checked: bool = True) -> Column:
    """Without the first of TERMINAL_SUFFIXES that it ends with; case matters.

    A name with none of them, or nothing before it, raises if checked, else is null.
    """
    out = F.lit(None).cast("string")
    for suffix in reversed(TERMINAL_SUFFIXES):
        out = F.when(stem.endswith(suffix), F.btrim(F.substring(stem, F.lit(1), F.length(stem) - len(suffix)))).otherwise(out)
    out = F.nullif(out, F.lit(""))
    return F.coalesce(out, failing(F.concat(F.lit("no base name in terminal chart: "), stem)).cast("string")) if checked else out


def output_name(chart: Column, source: Column, entries: Column, chart_type: Column) -> Column:
    """Slug of the chart, and of the source where that has several entries; terminal types are appended."""
    name = F.when(entries > 1, F.concat(slug(chart), F.lit("--"), slug(source))).otherwise(slug(chart))
    return F.when(chart_type.isin("tac", "fly"), F.concat(name, F.lit("."), chart_type)).otherwise(name)


def terminal_keys(file_name: Column, chart_type: str) -> Column:
    """Keys under which a processed terminal file is found: its own, and that without tac or fly at the end.

    The source part of the name counts, between '--' if there is one and '.tac.' or '.fly.'; files without
    that marker have no keys.
    """
    prefix = F.element_at(F.split(F.lower(file_name), f"[.]{chart_type}[.]", 2), 1)
    source = F.when(prefix.contains("--"), F.element_at(F.split(prefix, "--", 2), -1)).otherwise(prefix)
    key = key_strict(source, checked=False)
    trimmed = F.regexp_replace(key, "(?:tac|fly)$", "")
    keys = F.array_distinct(F.filter(F.array(key, trimmed), lambda k: k != ""))
    return F.when(F.lower(file_name).contains(f".{chart_type}."), keys).otherwise(F.array().cast("array<string>"))


def cycle_tokens(url: Column) -> Column:
    """Parts of a URL's path that are MM-DD-YYYY dates."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    return F.filter(F.split(path, "/"), lambda p: p.rlike(r"^\d{2}-\d{2}-\d{4}$"))


def url_join(base: Column, href: Column) -> Column:
    """href against the folder base; absolute URLs and absolute paths win."""
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1)
    folder = F.regexp_replace(base, "[^/]*$", "")
    return F.when(href.rlike(r"(?i)^https?://"), href).when(href.startswith("/"), F.concat(origin, href)).otherwise(F.concat(folder, href))


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/?#]*)(?:[?#].*)?$", 1)


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]*$", "")


def optional_long(c: Column) -> Column:
    """An integer header, or null if it is none."""
    return F.btrim(c).try_cast("bigint")


def virtual_path(c: Column) -> Column:
    """s3 and http locations in the notation of virtual file systems, other paths as they are."""
    return (
        F.when(c.startswith("s3://"), F.concat(F.lit("/vsis3/"), F.substring(c, F.lit(6), F.length(c))))
        .when(c.rlike("^https?://"), F.concat(F.lit("/vsicurl/"), c))
        .otherwise(c)
    )


def tag_value(tags: Column, key: str) -> Column:
    """The first value of map ``tags`` whose key has the letters and digits of ``key``, trimmed."""
    wanted = "".join(ch for ch in key.lower() if ch.isalnum())
    hits = F.filter(F.map_entries(tags), lambda e: F.regexp_replace(F.lower(e["key"]), r"[^\p{L}\p{N}]", "") == wanted)
    return F.btrim(F.try_element_at(hits, F.lit(1))["value"])


def normalized_list(values: list[str] | None, known: list[str] | None = None) -> list[str]:
    """Trimmed, lower-cased values in order without repeats; none gives all that are known; others raise."""
    out = list(dict.fromkeys(v.strip().lower() for v in values or [] if v.strip()))
    if known is not None and (bad := [v for v in out if v not in known]):
        raise ValueError(f"unknown chart types {bad}; known: {known}")
    return out or list(known or [])


def state_filter(values) -> list[str] | None:
    """Two-letter codes, upper-cased, sorted; None without any."""
    out = sorted({v.strip().upper() for v in values or [] if v.strip()})
    for v in out:
        if len(v) != 2:
            raise ValueError(f"Invalid state filter '{v}'. Expected 2-character state identifiers.")
    return out or None

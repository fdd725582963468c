"""Scene lists and catalogs: saved JSON, and a data source over an item search."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .web import with_retry

#: What a saved scene must have, and the assets of its bands.
REQUIRED = ["geometry", "href_blue", "href_green", "href_red", "quarter", "tile_id"]
ASSETS = {"href_red": "B04", "href_green": "B03", "href_blue": "B02"}
SCENE = "tile_id string, quarter string, geometry string, href_red string, href_green string, href_blue string"


def missing_keys(rows: DataFrame, column: str, required: list[str]) -> DataFrame:
    """rows with ``missing``: the required keys that a JSON object lacks, sorted; all if it is no object."""
    keys = F.coalesce(F.json_object_keys(F.col(column)), F.array().cast("array<string>"))
    return rows.withColumn("missing", F.array_sort(F.array_except(F.array(*map(F.lit, required)), keys)))


def saved_scenes(texts: DataFrame, column: str = "value") -> DataFrame:
    """Scenes of saved lists in order; an entry without a required key raises, other keys are ignored."""
    items = texts.select(F.posexplode(F.from_json(F.col(column), "array<string>")).alias("ordinal", "item"))
    rows = missing_keys(items, "item", REQUIRED)
    message = F.concat(F.lit("Scene entry "), F.col("ordinal"), F.lit(" missing required fields: "), F.array_join("missing", ", "))
    scene = F.when(F.size("missing") == 0, F.from_json("item", SCENE)).otherwise(F.raise_error(message).cast(f"struct<{SCENE.replace(' ', ':').replace(',:', ',')}>"))
    return rows.select("ordinal", scene.alias("s")).select("ordinal", "s.*")


class SceneCatalog(DataSource):
    """Format ``scene_catalog``: an item search, one task for each quarter.

    Options: quarters (comma-separated), region (GeoJSON geometry), search: the dotted name of a function
    (quarter, region) -> items with id, geometry and assets, imported on the executors.  Items that lack an
    asset are left out; transient errors are retried with growing pauses.
    """

    @classmethod
    def name(cls) -> str:
        return "scene_catalog"

    def schema(self) -> str:
        return SCENE

    def reader(self, schema) -> DataSourceReader:
        return _CatalogReader(dict(self.options))


class _CatalogReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(q.strip()) for q in self.options["quarters"].split(",") if q.strip()]

    def read(self, partition: InputPartition):
        import importlib

        module, _, name = self.options["search"].rpartition(".")
        search: Callable = getattr(importlib.import_module(module), name)
        pause = float(self.options.get("pause", "8"))
        for item in with_retry(lambda: list(search(partition.value, self.options.get("region"))), base=pause):
            hrefs = {k: item.get("assets", {}).get(a, {}).get("href") for k, a in ASSETS.items()}
            if all(hrefs.values()):
                yield (item["id"], partition.value, json.dumps(item["geometry"]), hrefs["href_red"], hrefs["href_green"], hrefs["href_blue"])

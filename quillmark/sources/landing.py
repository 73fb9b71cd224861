"""Paged provider results from a landing folder as a Python data source, and the folder's cache key.

Connectors fetch outside Spark and drop one JSON page a file; a page names its
provider, its number and its records. The source deals pages to tasks.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "provider string, page int, hits int, record string"


class Pages(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class LandingReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.per_task = options["path"], int(options.get("pagesPerTask", "16"))

    def partitions(self) -> list[Pages]:
        import pyarrow.fs as fs

        store, path = fs.FileSystem.from_uri(self.folder) if "://" in self.folder else (fs.LocalFileSystem(), self.folder)
        names = sorted(x.path for x in store.get_file_info(fs.FileSelector(path, recursive=True)) if x.path.endswith(".json"))
        return [Pages(names[i : i + self.per_task]) for i in range(0, len(names), self.per_task)] or [Pages([])]

    def read(self, partition: Pages) -> Iterator[tuple]:
        import pyarrow.fs as fs

        store = fs.FileSystem.from_uri(self.folder)[0] if "://" in self.folder else fs.LocalFileSystem()
        for path in partition.paths:
            with store.open_input_stream(path) as f:
                page = json.loads(f.read())
            if page.get("error"):
                raise ValueError(f"{path}: {page['error']}")
            for record in page.get("records", []):
                yield page.get("provider", ""), int(page.get("page", 0)), int(page.get("hits", 0)), json.dumps(record, sort_keys=True)


class LandingSource(DataSource):
    """``spark.read.format("landing").load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "landing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LandingReader:
        return LandingReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LandingSource)


def cache_key(url: Column, params: Column) -> Column:
    """SHA-256 of the URL and its parameters (a map) in key order."""
    entries = F.array_sort(F.transform(F.map_entries(params), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return F.sha2(F.concat(url, F.lit("?"), F.array_join(entries, "&")), 256)

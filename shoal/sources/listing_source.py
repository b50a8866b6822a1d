"""A Python data source that lists a folder's files as objects, with the prefix pushed down to the folders it walks.

``spark.read.format("object_listing").option("path", root).load()``: key, size, last_modified. Partitions are the top folders, listed in the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, InputPartition, StringStartsWith

SCHEMA = "key string, size bigint, last_modified timestamp"


class Folder(InputPartition):
    def __init__(self, path: str, recursive: bool):
        self.path, self.recursive = path, recursive


class ListingReader(DataSourceReader):
    def __init__(self, options: dict):
        if not options.get("path"):
            raise ValueError("a path is needed")
        self.root, self.prefix = options["path"].rstrip("/"), options.get("prefix", "")

    def pushFilters(self, filters: list[Filter]):
        for f in filters:
            if isinstance(f, (StringStartsWith, EqualTo)) and f.attribute == ("key",) and f.value.startswith(self.prefix):
                self.prefix = f.value  # the longest; others still run in Spark
            yield f

    def _system(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.root if "://" in self.root else f"file://{self.root}")

    def partitions(self) -> list[Folder]:
        system, root = self._system()
        start = self.prefix.rpartition("/")[0]
        base = f"{root}/{start}".rstrip("/")
        found = system.get_file_info(fs.FileSelector(base, allow_not_found=True))
        return [Folder(base, False), *[Folder(x.path, True) for x in found if x.type == fs.FileType.Directory and f"{x.path[len(root) + 1:]}/".startswith(self.prefix[: len(x.path) - len(root)])]]

    def read(self, partition: Folder) -> Iterator[tuple[str, int, datetime]]:
        system, root = self._system()
        for x in system.get_file_info(fs.FileSelector(partition.path, allow_not_found=True, recursive=partition.recursive)):
            key = x.path[len(root) + 1 :]
            if x.type == fs.FileType.File and key.startswith(self.prefix):
                yield key, x.size, x.mtime


class ListingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "object_listing"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ListingReader:
        return ListingReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ListingSource)

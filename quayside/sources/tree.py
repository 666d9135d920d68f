"""Listings made by tasks: a data source whose partitions are folders.

The driver looks at folders from the top down only until it has enough of them to deal
out; each task walks its own and hands on its files in batches. So the driver
never holds the files of a source, as the file index of a reader does. A folder that is
split gives one partition for the files right in it and one for every folder below.

Stores are reached through Arrow's file systems, from driver and tasks alike. Names
that Spark's readers hide are hidden here too, and times have their milliseconds.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as stores
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quayside.sources import folders

# Tasks get this module with their work; they need not have the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "quayside-tree"
DDL = "path string, uri string, modified timestamp, size bigint"
#: Folders the driver deals out, unless there are fewer.
FOLDERS = 512
#: Files a task hands on at a time.
BATCH = 10_000
# Schemes that Hadoop and Arrow name differently.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def hidden(name: str) -> bool:
    """Names Spark's readers pass over."""
    return name.startswith("_") and "=" not in name or name.startswith(".") or name.endswith("._COPYING_")


@dataclass
class Folder(InputPartition):
    """A folder by its place in the store; with ``below`` all folders in it too."""

    path: str
    below: bool


def opened(uri: str) -> tuple[stores.FileSystem, str]:
    scheme, found, rest = uri.partition("://")
    if not found:  # file:/a/b
        scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return stores.LocalFileSystem(), "/" + rest.lstrip("/")
    return stores.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")


def level(store: stores.FileSystem, path: str) -> tuple[list[stores.FileInfo], list[str]]:
    """Files and folders right in a folder, without what is hidden."""
    found = store.get_file_info(stores.FileSelector(path, allow_not_found=True))
    seen = [info for info in found if not hidden(info.base_name)]
    files = [info for info in seen if info.type == stores.FileType.File]
    return files, [info.path for info in seen if info.type == stores.FileType.Directory]


def walked(store: stores.FileSystem, folder: Folder) -> Iterator[stores.FileInfo]:
    waiting = [folder.path]
    while waiting:
        files, below = level(store, waiting.pop())
        yield from files
        if folder.below:
            waiting += below


class TreeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.roots = options["root"], options["folders"].split("\n")
        self.enough = int(options["enough"])

    def partitions(self) -> list[Folder]:
        store, root = opened(self.root)
        whole = [Folder(f"{root}/{folder}".rstrip("/"), True) for folder in self.roots]
        flat: list[Folder] = []
        while whole and len(whole) + len(flat) < self.enough:
            split, whole = whole, []
            for number, folder in enumerate(split):
                if len(whole) + len(flat) + len(split) - number >= self.enough:
                    whole += split[number:]
                    break
                flat.append(Folder(folder.path, False))
                whole += [Folder(path, True) for path in level(store, folder.path)[1]]
        return flat + whole

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        store, root = opened(self.root)
        kinds = pa.schema([("path", pa.string()), ("uri", pa.string()), ("modified", pa.timestamp("us", "UTC")), ("size", pa.int64())])

        def batch(files: list[stores.FileInfo]) -> pa.RecordBatch:
            times = [info.mtime_ns // 1_000_000 * 1_000 for info in files]
            columns = [[info.path[len(root.rstrip("/")) + 1 :] for info in files], [None] * len(files), times, [info.size for info in files]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)

        held: list[stores.FileInfo] = []
        for info in walked(store, partition):
            held.append(info)
            if len(held) == BATCH:
                yield batch(held)
                held = []
        yield batch(held)


class TreeSource(DataSource):
    """Files below some folders of a store."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return DDL

    def reader(self, schema: object) -> TreeReader:
        return TreeReader(self.options)


def reachable(spark: SparkSession, root: str) -> bool:
    """Whether Arrow has a file system for the store."""
    try:
        opened(folders.qualified(spark, root))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError, ValueError):
        return False
    return True


def listed(spark: SparkSession, root: str, below: list[str], enough: int = FOLDERS) -> DataFrame:
    """Files below the folders ``below`` of ``root``; ``uri`` is not known here."""
    spark.dataSource.register(TreeSource)
    options = {"root": folders.qualified(spark, root), "folders": "\n".join(below), "enough": str(enough)}
    return spark.read.format(NAME).options(**options).load().select("path", F.col("uri"), "modified", "size")

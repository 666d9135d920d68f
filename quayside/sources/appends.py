"""Appended files of control tables, made, read and removed by tasks.

Each is a Parquet file of a few rows, so what there is to do is a call or two of the store
for every file. Tasks do that side by side, each for its share of the keys or names. What
tasks append is dealt over folders by its name, so that tasks can list it as well and
the driver never holds the names. Stores are reached as in ``tree``.
"""

from __future__ import annotations

import contextlib
import sys
from collections.abc import Iterable, Iterator, Mapping, Sequence
from hashlib import blake2b
from itertools import groupby, islice
from operator import itemgetter
from uuid import uuid4

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as stores
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quayside.sources.tree import opened

# Tasks get this module with their work; they need not have the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Files of a task, and files whose rows it hands on at a time.
FILES, BATCH = 1024, 256
#: Folders that hold what tasks append; a task lists one after the other. Names in stores depend on the number.
SHARD, SHARDS = "shard-", 1024

Batches = Iterator[pa.RecordBatch]


def content(rows: Iterable[Mapping], kinds: pa.Schema) -> pa.Buffer:
    """A file of some rows."""
    out = pa.BufferOutputStream()
    pq.write_table(pa.Table.from_pylist(list(rows), schema=kinds), out)
    return out.getvalue()


def names(uri: str) -> dict[str, bool]:
    """What stands directly in a folder, and whether it is a folder."""
    store, path = opened(uri)
    found = store.get_file_info(stores.FileSelector(path, allow_not_found=True))
    return {info.base_name: info.type == stores.FileType.Directory for info in found}


def contents(rows: DataFrame, ddl: str, keys: Sequence[str]) -> DataFrame:
    """``name`` and ``content`` of a file for the rows of each key. A task that is run again gives its files the same names."""
    kinds, token = to_arrow_schema(T.StructType.fromDDL(ddl)), uuid4().hex
    key = itemgetter(*keys)

    def made(batches: Batches) -> Batches:
        groups = groupby((row for batch in batches for row in batch.to_pylist()), key)
        files = ((f"append-{token}-{blake2b(repr(at).encode(), digest_size=12).hexdigest()}", content(group, kinds).to_pybytes()) for at, group in groups)
        while some := list(islice(files, BATCH)):
            yield pa.RecordBatch.from_pydict(dict(zip(("name", "content"), map(list, zip(*some)))))

    spark = rows.sparkSession
    # By number, as few bytes may be many files.
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.select(*kinds.names).repartition(tasks, *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(made, "name string, content binary")


def put(files: DataFrame, uri: str) -> None:
    """Files of some ``name`` and ``content``, each there whole or not at all, in the shards of a folder."""

    def written(batches: Batches) -> Batches:
        store, path = opened(uri)
        made: set[str] = set()
        for batch in batches:
            for name, bytes_ in zip(*(column.to_pylist() for column in batch.columns)):
                shard = f"{path}/{SHARD}{int(name[-8:], 16) % SHARDS:04d}"
                if isinstance(store, stores.LocalFileSystem) and shard not in made:
                    store.create_dir(shard)
                    made.add(shard)
                if store.get_file_info(f"{shard}/{name}").type == stores.FileType.NotFound:
                    hidden = f"{shard}/_writing-{uuid4().hex}"
                    with store.open_output_stream(hidden) as out:
                        out.write(bytes_)
                    store.move(hidden, f"{shard}/{name}")
            yield batch.select(["name"])

    files.mapInArrow(written, "name string").agg(F.count(F.lit(1))).first()


def listed(spark: SparkSession, uri: str) -> DataFrame:
    """``name`` of each file in the shards of a folder, with its shard."""

    def found(batches: Batches) -> Batches:
        store, path = opened(uri)
        for batch in batches:
            for number in batch.column(0).to_pylist():
                shard = f"{SHARD}{number:04d}"
                files = store.get_file_info(stores.FileSelector(f"{path}/{shard}", allow_not_found=True))
                some = [f"{shard}/{info.base_name}" for info in files if info.base_name.startswith("append-")]
                yield pa.RecordBatch.from_pydict({"name": pa.array(some, pa.string())})

    # A task of its own for a shard would take longer to begin than to list it.
    tasks = min(spark.sparkContext.defaultParallelism, SHARDS)
    return spark.range(0, SHARDS, 1, tasks).mapInArrow(found, "name string")


def read(files: DataFrame, number: int, uri: str, ddl: str) -> DataFrame:
    """Rows of files, so many, of some ``name``; columns a file lacks are null."""
    kinds = to_arrow_schema(T.StructType.fromDDL(ddl))

    def rows(store: stores.FileSystem, place: str) -> pa.Table:
        with store.open_input_file(place) as file:
            found = pq.ParquetFile(file).read()
        if found.schema.equals(kinds):
            return found
        columns = [found[kind.name].cast(kind.type) if kind.name in found.column_names else pa.nulls(len(found), kind.type) for kind in kinds]
        return pa.Table.from_arrays(columns, schema=kinds)

    def found(batches: Batches) -> Batches:
        store, path = opened(uri)
        for batch in batches:
            some = batch.column(0).to_pylist()
            for begin in range(0, len(some), BATCH):
                tables = [rows(store, f"{path}/{name}").replace_schema_metadata() for name in some[begin : begin + BATCH]]
                yield from pa.concat_tables(tables).combine_chunks().to_batches()

    return _dealt(files, number).mapInArrow(found, ddl)


def remove(files: DataFrame, number: int, uri: str) -> None:
    """Remove files, so many, of some ``name``, also if others do so meanwhile."""

    def removed(batches: Batches) -> Batches:
        store, path = opened(uri)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                folder, _, last = name.rpartition("/")
                # Hadoop keeps a checksum beside each local file it writes; it wrote none in a shard.
                for place in (name, f".{last}.crc") if isinstance(store, stores.LocalFileSystem) and not folder else (name,):
                    with contextlib.suppress(FileNotFoundError):
                        store.delete_file(f"{path}/{place}")
            yield batch

    _dealt(files, number).mapInArrow(removed, "name string").agg(F.count(F.lit(1))).first()


def _dealt(files: DataFrame, number: int) -> DataFrame:
    tasks = -(-number // FILES)
    return files.select("name").repartition(max(tasks, files.sparkSession.sparkContext.defaultParallelism))

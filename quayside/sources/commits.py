"""Folders whose rows change by one commit.

Rows are first written to an attempt, a hidden folder beside the data. Its files are
moved in among the old ones, whose names they never share, and then a manifest with
the names of the new files appears: that is the commit. Only after it the old files
go. Whatever stops a write, the last manifest names a whole set of files, the old or
the new one; the next write clears away what was left.

A folder has one writer at a time. Readers that know of manifests see one commit or
the other, at any time; readers that take all files of the folder see the same at
rest, and old beside new files while a commit is under way.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.concurrency import run_all
from quayside.functions import paths
from quayside.sources import folders

MANIFESTS = "_commits"


@dataclass(frozen=True)
class Commit:
    """What a folder holds: names of files, their rows and bytes, and their schema as JSON.

    ``rows`` and ``schema`` are unknown for files that were there before any commit.
    """

    number: int
    names: tuple[str, ...]
    bytes: int
    rows: int | None = None
    schema: str | None = None


def _split(folder: str) -> tuple[str, str, str]:
    folder = folder.rstrip("/")
    parent, _, name = folder.rpartition("/")
    return folder, parent, name


def _data(spark: SparkSession, folder: str) -> list[folders.Entry]:
    """Files of a folder that readers do not hide."""
    found = folders.entries(spark, folder)
    return [e for e in found if not e.is_folder and not re.match(r"[._]", e.name)]


def last(spark: SparkSession, folder: str) -> Commit | None:
    """The last commit of a folder, if it ever had one."""
    manifests = [e.name for e in folders.entries(spark, f"{folder.rstrip('/')}/{MANIFESTS}") if e.name[0].isdigit()]
    if not manifests:
        return None
    facts = folders.get_json(spark, f"{folder.rstrip('/')}/{MANIFESTS}/{max(manifests)}")
    return Commit(**{**facts, "names": tuple(facts["names"])})


def _publish(spark: SparkSession, folder: str, commit: Commit) -> Commit:
    name = f"{commit.number:010d}-{uuid4().hex}.json"
    folders.put_json(spark, f"{folder}/{MANIFESTS}/{name}", {**vars(commit), "names": list(commit.names)})
    return commit


def write(spark: SparkSession, folder: str, fill: Callable[[str], tuple[int, T.StructType]],
          keep_if_empty: bool = False, workers: int = 8) -> Commit | None:
    """Replace the rows of a folder by those that ``fill`` writes to the folder it is given.

    ``fill`` returns how many rows it wrote and their schema. With ``keep_if_empty`` no
    rows are no commit, and the old ones stay.
    """
    folder, parent, name = _split(folder)
    attempt = f"{parent}/_attempt-{name}-{uuid4().hex}"
    try:
        rows, schema = fill(attempt)
        if keep_if_empty and not rows:
            return None
        before = last(spark, folder)
        if before is None and (old := _data(spark, folder)):
            # Files that came without a manifest are the old state until the commit.
            names = tuple(entry.name for entry in old)
            before = _publish(spark, folder, Commit(0, names, sum(entry.bytes for entry in old)))
        new = _data(spark, attempt)
        moves = [(f"{attempt}/{entry.name}", f"{folder}/{entry.name}") for entry in new]
        run_all(spark, lambda pair: folders.move(spark, *pair), moves, workers)
        number = 1 if before is None else before.number + 1
        names = tuple(entry.name for entry in new)
        done = _publish(spark, folder, Commit(number, names, sum(e.bytes for e in new), rows, schema.json()))
    finally:
        folders.remove(spark, attempt)
    tidy(spark, folder, workers)
    return done


def tidy(spark: SparkSession, folder: str, workers: int = 8) -> Commit | None:
    """Remove what the last commit of a folder does not name, and attempts nobody finished."""
    folder, parent, name = _split(folder)
    commit = last(spark, folder)
    stale = [
        f"{parent}/{e.name}" for e in folders.entries(spark, parent)
        if re.fullmatch(rf"_attempt-{re.escape(name)}-[0-9a-f]{{32}}", e.name)
    ]
    if commit is not None:
        named = set(commit.names)
        stale += [f"{folder}/{e.name}" for e in _data(spark, folder) if e.name not in named]
        manifests = folders.entries(spark, f"{folder}/{MANIFESTS}")
        stale += [f"{folder}/{MANIFESTS}/{e.name}" for e in manifests[:-1] if e.name[0].isdigit()]
    run_all(spark, lambda path: folders.remove(spark, path), stale, workers)
    return commit


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the last commit; of all files, if there never was one."""
    commit = last(spark, folder)
    if commit is None:
        return spark.read.parquet(paths.literal_path(folder))
    if commit.schema is None:
        return spark.read.parquet(*[paths.literal_path(f"{folder.rstrip('/')}/{name}") for name in commit.names])
    schema = T.StructType.fromJson(json.loads(commit.schema))
    if not commit.names:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    return reader.parquet(*[paths.literal_path(f"{folder.rstrip('/')}/{name}") for name in commit.names])


def counted(rows: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """Write rows and return how many there were, counted by the tasks that write them."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    return seen.get.get("rows", 0)

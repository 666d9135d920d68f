"""Writes of pulled and landed entities."""

from __future__ import annotations

from collections.abc import Collection, Iterator, Mapping, Sequence
from dataclasses import dataclass
from itertools import batched, islice

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.concurrency import run_all
from quayside.constants import PATHS_PER_READ
from quayside.functions.values import all_string
from quayside.sources import commits, files


def write_pull(rows: DataFrame, folder: str, rebalance: bool = True) -> commits.Commit | None:
    """Write a pull over an earlier one; an empty pull leaves that in place.

    The pull is read once, and counted by the tasks that write it. A pull takes few
    rows out of each of many splits, so it is rebalanced into files of the advisory
    size. That shuffles only what is written; a first full pull can do without.
    """
    sized = rows.hint("rebalance") if rebalance else rows

    def fill(attempt: str) -> tuple[int, T.StructType]:
        return commits.counted(sized, attempt), rows.schema

    return commits.write(rows.sparkSession, folder, fill, keep_if_empty=True)


@dataclass(frozen=True)
class EntityFiles:
    """What a landing plan says of one entity: files taken, and those that land."""

    entity: str
    taken: int
    lands: int


def entity_summary(plan: DataFrame) -> list[EntityFiles]:
    """The entities of a landing plan that get files; one row per entity."""
    rows = (
        plan.groupBy("entity")
        .agg(F.count_if("taken").alias("taken"), F.count_if("lands").alias("lands"))
        .where("lands > 0")
        .orderBy("entity")
    )
    return [EntityFiles(**row.asDict()) for row in rows.collect()]


def write_entity(plan: DataFrame, entity: str, source_root: str, target: str,
                 paths_per_read: int = PATHS_PER_READ, as_text: bool = False) -> commits.Commit:
    """Write the files the plan lands for one entity to its target folder, in one commit.

    Files are read by name, exactly those of the plan, in one schema found
    before. ``paths_per_read`` bounds the names the driver holds at a time; each
    such read is a write of its own to the same attempt. No row is shuffled, joined
    or tested to tell whether its file belongs here.

    Files whose types have no type in common, say ``int`` and ``string``, fail. With
    ``as_text`` all columns land as text instead, cast as pulls are, and files with any
    types land side by side: each run of files is read in the types it has.
    """
    spark = plan.sparkSession
    lands = plan.where((F.col("entity") == entity) & F.col("lands"))
    in_time = lands.select("path", "modified").orderBy("modified", "path")

    def chunks() -> Iterator[list[str]]:
        for rows in batched(in_time.toLocalIterator(), paths_per_read):
            yield [f"{source_root.rstrip('/')}/{row.path}" for row in rows]

    def fill(attempt: str) -> tuple[int, T.StructType]:
        schema = files.merged_schema(spark, entity, chunks())
        written = [commits.counted(files.entity_files(spark, names, schema), attempt, "append") for names in chunks()]
        return sum(written), schema

    def fill_text(attempt: str) -> tuple[int, T.StructType]:
        # Per run of files a schema and a number; names are read anew for the write.
        found = [[(kind, len(names)) for kind, names in files.schema_runs(spark, chunk)] for chunk in chunks()]
        schema = files.text_schema(kind for runs in found for kind, _ in runs)
        rows = 0
        for chunk, runs in zip(chunks(), found, strict=True):
            names = iter(chunk)
            for kind, n in runs:
                part = files.entity_files(spark, list(islice(names, n)), kind)
                rows += commits.counted(all_string(part, schema.names), attempt, "append")
        return rows, schema

    return commits.write(spark, target, fill_text if as_text else fill)


def write_entities(plan: DataFrame, entities: Sequence[str], source_root: str,
                   targets: Mapping[str, str], workers: int = 8,
                   paths_per_read: int = PATHS_PER_READ, as_text: Collection[str] = ()) -> dict[str, commits.Commit]:
    """Write several entities at a time, each by its own jobs: their schemas
    differ, and alone the end of one job would leave the cluster idle. Those in
    ``as_text`` land as text."""

    def write(entity: str) -> commits.Commit:
        return write_entity(plan, entity, source_root, targets[entity], paths_per_read, entity in as_text)

    return dict(zip(entities, run_all(plan.sparkSession, write, entities, workers)))

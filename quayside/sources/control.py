"""Control tables: schemas, store, lookups and watermark upserts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce
from operator import and_
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quayside.concurrency import run_all
from quayside.functions import paths
from quayside.sources import appends, folders, tree
from quayside.sources.relations import relation, shared_folder

SCHEMAS = {
    "job_config": "process_id string, job_id string, job_name string, seq bigint",
    "source_metadata": (
        "source_metadata_id string, source_system string, country_code string, "
        "entity string, entity_status string, subject_area string, data_product string, "
        "table_type string, timestamp_fields array<string>, "
        "column_metadata array<struct<name:string>>, last_run_ts timestamp"
    ),
    "process_config": (
        "source_system string, tenant string, source_prefix string, landing_bucket string, "
        "source_format string, landing_database string"
    ),
    "path_config": (
        "source_cluster string, source_bucket string, source_template string, "
        "search_template string, landing_root string, landing_template string, "
        "cluster string, source_system string, last_run_start_time timestamp"
    ),
    "process_log": (
        "layer string, load_id string, process_id string, country_code string, "
        "job_run_status string, error_message string, logged_at timestamp, job_id string"
    ),
    "run_details": (
        "entity string, row_count bigint, error_count bigint, start_time timestamp, "
        "end_time timestamp, status string, load_id string, job_id string"
    ),
    "file_watermark": (
        "source_cluster string, last_run_start_time timestamp, load_id string, "
        "logged_at timestamp"
    ),
    "entity_watermark": (
        "source_metadata_id string, source_system string, last_run_ts timestamp, "
        "load_id string, logged_at timestamp"
    ),
    "landed": (
        "source_cluster string, load_id string, entity string, folder string, files bigint, "
        "row_count bigint, bytes bigint, columns string, landed_at timestamp"
    ),
}

WATERMARK_ORDER = ["logged_at", "load_id"]
#: Tables of which only the last row of a key counts.
LAST_BY = {
    "file_watermark": ["source_cluster"],
    "entity_watermark": ["source_metadata_id", "source_system"],
    "landed": ["source_cluster", "load_id", "entity"],
}
ORDERS = {"file_watermark": WATERMARK_ORDER, "entity_watermark": WATERMARK_ORDER, "landed": ["landed_at"]}
#: Appended files of a table before they are compacted, and compacted parts before they are merged.
TAIL, PARTS = 64, 16


#: A listing of shards: names, and whether the pointer covers them.
LISTING_DDL = "name string, covered boolean"


@dataclass(frozen=True)
class Snapshot:
    """What a control table consists of: compacted parts, and what was appended since.

    Names in shards may be very many, so they are a table; only ``tail``, ``names`` and
    ``files`` bring them to the driver.
    """

    number: int
    parts: tuple[str, ...]
    #: Names covered right in the table's folder, names appended there since, and what of those are files.
    covered: tuple[str, ...]
    lone: tuple[str, ...]
    lone_files: frozenset[str]
    #: The written listing of the shards, how many of its names were appended since, and how many are covered.
    listing: str | None
    dealt: DataFrame | None
    many: int
    many_covered: int

    @property
    def size(self) -> int:
        """How many parts and appended names there are."""
        return len(self.parts) + self.appended

    @property
    def appended(self) -> int:
        return len(self.lone) + self.many

    @cached_property
    def _dealt_names(self) -> tuple[str, ...]:
        return tuple(sorted(row.name for row in self.dealt.where("not covered").collect())) if self.many else ()

    @property
    def tail(self) -> tuple[str, ...]:
        return (*self.lone, *self._dealt_names)

    @property
    def files(self) -> frozenset[str]:
        """What of the tail are single files, not folders."""
        return self.lone_files.union(self._dealt_names)

    @property
    def names(self) -> tuple[str, ...]:
        return (*self.parts, *self.tail)


class ControlStore:
    """Control tables as Parquet folders below one root.

    Tables are only appended to. Parquet tables cannot be updated in place, and
    a lost writer must not leave one half rewritten, so an update is a new row
    and reading takes the latest. Every append is a file of its own, so loads
    that append at the same time share no committer.

    Now and then the appended files are compacted into a part, of which only the last
    row of a key stays where no other counts. A pointer, a small file, then names the
    parts and the appended files they cover; the pointer with the highest name counts.
    What is appended meanwhile is covered by none and so still read. Covered files
    are removed by the compaction after the next pointer, when no reader that
    found them can be at work still, unless it takes as long as that.

    What tasks append stands in shards, folders in that of the table. Tasks list them, and
    what a pointer covers there is a table of names beside the parts, so the driver
    holds no name of a shard.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def snapshot(self, name: str) -> Snapshot:
        """One listing of the table's folder, which holds no more than its parts, the appends of drivers and shards,
        and one of the shards."""
        return self._snapshot(name, lambda number: shared_folder(self.spark, "appended"), "not covered")

    def _snapshot(self, name: str, place: Callable[[int], str], kept: str) -> Snapshot:
        """The shards' names of a kind are listed into the folder that ``place`` gives for the pointer's number."""
        while True:
            found, facts = self._pointed(name)
            covered, number = set(facts["covered"]), facts["number"]
            lone = [entry for entry in found if entry.startswith("append-") and entry not in covered]
            files = frozenset(entry for entry in lone if not found[entry])
            state = (number, tuple(facts["parts"]), tuple(facts["covered"]), tuple(lone), files)
            if not any(entry.startswith(appends.SHARD) for entry in found):
                return Snapshot(*state, None, None, 0, 0)
            listing = place(number)
            self._listed(name, facts["dealt"]).where(kept).write.parquet(listing)
            dealt = self.spark.read.schema(LISTING_DDL).parquet(listing)
            many, of_them = dealt.agg(F.count_if(~F.col("covered")), F.count_if("covered")).first()
            outrun = self._pointer_number(self._found(name)) > number
            if many + of_them and not outrun:
                return Snapshot(*state, listing, dealt, many, of_them)
            folders.remove(self.spark, listing)
            # Pointers that came meanwhile may have covered and removed names before they were listed.
            if not outrun:
                return Snapshot(*state, None, None, 0, 0)

    def _pointed(self, name: str) -> tuple[dict[str, bool], dict]:
        """What stands in the table's folder, and what the pointer says."""
        found = self._found(name)
        pointers = [entry for entry in found if entry.startswith("_pointer-")]
        facts = {"number": 0, "parts": [], "covered": [], "dealt": None}
        if pointers:
            facts |= folders.get_json(self.spark, f"{self.path(name)}/{max(pointers)}")
        return found, facts

    @staticmethod
    def _pointer_number(found: Mapping[str, bool]) -> int:
        return max((int(entry.split("-")[1]) for entry in found if entry.startswith("_pointer-")), default=0)

    def _listed(self, name: str, covered: str | None) -> DataFrame:
        """Names in the table's shards, and whether they are among the covered ones."""
        if not self._by_tasks:
            raise ValueError(f"{self.path(name)} has shards, but tasks cannot reach it")
        found = appends.listed(self.spark, self._uri(name))
        if covered is None:
            return found.withColumn("covered", F.lit(False))
        known = self.spark.read.schema(LISTING_DDL).parquet(f"{self.path(name)}/{covered}").select("name", F.lit(True).alias("covered"))
        # Merged, as names of few bytes in files may be many to bring to the driver.
        joined = found.join(known.hint("merge"), "name", "left")
        return joined.select("name", F.col("covered").isNotNull().alias("covered"))

    @cached_property
    def _by_tasks(self) -> bool:
        """Whether tasks can reach the tables; else the driver and Spark's reader do all."""
        return tree.reachable(self.spark, self.root)

    def _uri(self, name: str) -> str:
        return folders.qualified(self.spark, self.path(name))

    def _found(self, name: str) -> dict[str, bool]:
        """What stands in the table's folder by name, and whether it is a folder."""
        if self._by_tasks:
            return dict(sorted(appends.names(self._uri(name)).items()))
        return {entry.name: entry.is_folder for entry in folders.entries(self.spark, self.path(name))}

    def read(self, name: str) -> DataFrame:
        found = self.snapshot(name)
        return self._rows(name, found, found.parts)

    def _rows(self, name: str, found: Snapshot, parts: Sequence[str]) -> DataFrame:
        """Rows of some parts, and of what was appended since."""
        names, pieces = [*parts, *found.lone], []
        if found.many:
            pieces.append(appends.read(found.dealt.where("not covered"), found.many, self._uri(name), SCHEMAS[name]))
        # The reader takes milliseconds for each file it opens, and more to look for it by name.
        if self._by_tasks and len(found.lone_files) > TAIL:
            names = [part for part in names if part not in found.lone_files]
            pieces.append(appends.read(self._names(found.lone_files), len(found.lone_files), self._uri(name), SCHEMAS[name]))
        if names:
            reader = self.spark.read.schema(SCHEMAS[name]).option("recursiveFileLookup", True)
            pieces.append(reader.parquet(*[paths.literal_path(f"{self.path(name)}/{part}") for part in names]))
        return reduce(DataFrame.unionByName, pieces) if pieces else relation(self.spark, [], SCHEMAS[name])

    def _names(self, names: Iterable[str]) -> DataFrame:
        return relation(self.spark, [{"name": name} for name in names], "name string")

    def append_rows(self, name: str, rows: Sequence[Mapping], token: str | None = None) -> None:
        """Append a few rows. An append with the token of an earlier one is that one: it adds nothing."""
        schema = T.StructType.fromDDL(SCHEMAS[name])
        place = f"{self.path(name)}/append-{token or uuid4().hex}"
        # A compacted append leaves its name in the pointer until long after.
        if token and (folders.exists(self.spark, place) or place.rpartition("/")[2] in self._pointed(name)[1]["covered"]):
            return
        folders.put(self.spark, place, appends.content(rows, to_arrow_schema(schema)).to_pybytes())

    def append_each(self, name: str, rows: DataFrame, keys: Sequence[str]) -> None:
        """Append rows of any number, the few of each key by an append of their own, from many tasks at a time.

        They come one after the other, so a reader may find some of them. ``rows`` must give
        the same rows when read again.
        """
        made = appends.contents(rows, SCHEMAS[name], keys)
        if self._by_tasks:
            appends.put(made, self._uri(name))
            return
        for file in made.toLocalIterator():
            folders.put(self.spark, f"{self.path(name)}/{file.name}", bytes(file.content))

    def append(self, name: str, rows: DataFrame) -> None:
        """Append rows of any number."""
        columns = T.StructType.fromDDL(SCHEMAS[name]).names
        rows.select(*columns).coalesce(1).write.parquet(f"{self.path(name)}/append-{uuid4().hex}")

    def compact(self, name: str) -> Snapshot:
        """Bring the appended rows of a table into a part; see the class."""
        token = uuid4().hex
        before = self._snapshot(name, lambda number: f"{self.path(name)}/covered-{number + 1:010d}-{token}", "true")
        if not before.appended:
            if before.listing:
                folders.remove(self.spark, before.listing)
            return self.snapshot(name)
        merged = name in LAST_BY or len(before.parts) >= PARTS
        rows = self._rows(name, before, before.parts if merged else ())
        if name in LAST_BY:
            rows = latest(rows, LAST_BY[name], ORDERS[name]).select(*rows.columns)
        part = f"part-{before.number + 1:010d}-{token}"
        rows.hint("rebalance").write.parquet(f"{self.path(name)}/{part}")
        parts = (part,) if merged else (*before.parts, part)
        stale = self._stale(name, before)
        # Names are covered until they are gone, or a reader would take them for appended again.
        facts = {"number": before.number + 1, "parts": parts, "covered": [*(e for e in before.covered if e in stale), *before.lone]}
        facts["dealt"] = before.listing and before.listing.rpartition("/")[2]
        pointer = f"_pointer-{facts['number']:010d}-{uuid4().hex}.json"
        folders.put_json(self.spark, f"{self.path(name)}/{pointer}", facts)
        if before.many_covered:
            appends.remove(before.dealt.where("covered"), before.many_covered, self._uri(name))
        by_tasks = [entry for entry, is_folder in stale.items() if not is_folder and entry.startswith("append-")]
        if self._by_tasks and len(by_tasks) > TAIL:
            appends.remove(self._names(by_tasks), len(by_tasks), self._uri(name))
            stale = stale.keys() - set(by_tasks)
        for entry in stale:
            folders.remove(self.spark, f"{self.path(name)}/{entry}")
        return self.snapshot(name)

    def _stale(self, name: str, before: Snapshot) -> dict[str, bool]:
        """What the pointer of ``before`` has replaced, and whether it is a folder: files it covers, parts, tables
        of covered names and pointers older than it."""
        found = self._found(name)
        pointers = sorted(entry for entry in found if entry.startswith("_pointer-"))[:-1]
        made = [e for e in found if e.startswith(("part-", "covered-")) and e not in before.parts and int(e.split("-")[1]) < before.number]
        return {e: found[e] for e in (*pointers, *made, *before.covered) if e in found}

    def maintain(self, tail: int = TAIL) -> list[str]:
        """Compact the tables that have more appended files than ``tail``; their names."""
        due = [name for name in SCHEMAS if self.snapshot(name).appended > tail]
        run_all(self.spark, self.compact, due)
        return due

    def path_config(self) -> DataFrame:
        """Path configuration with the latest file watermark of each source."""
        marks = latest(self.read("file_watermark"), ["source_cluster"], WATERMARK_ORDER)
        updates = marks.select("source_cluster", "last_run_start_time")
        return _overlay(self.read("path_config"), updates, ["source_cluster"])

    def source_metadata(self) -> DataFrame:
        """Source metadata with the latest watermark of each entity."""
        keys = ["source_metadata_id", "source_system"]
        marks = latest(self.read("entity_watermark"), keys, WATERMARK_ORDER)
        return _overlay(self.read("source_metadata"), marks.select(*keys, "last_run_ts"), keys)


def lookup(table: DataFrame, keys: Mapping[str, object], attributes: Sequence[str]) -> DataFrame:
    """Attributes of the rows that match all key values."""
    matches = reduce(and_, [F.col(name) == F.lit(value) for name, value in keys.items()])
    return table.where(matches).select(*attributes)


def first(rows: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """The first row in a stated order."""
    return rows.orderBy(*order).limit(1)


def latest(log: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row of every key of a log.

    An aggregate, not a window: each task first reduces a key to one row, so a
    key with very many rows never meets in one place.
    """
    values = [name for name in log.columns if name not in keys]
    last = F.max_by(F.struct(*values), F.struct(*order)).alias("_last")
    return log.groupBy(*keys).agg(last).select(*keys, "_last.*")


def upsert(old: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` with the columns of ``updates`` replaced for the keys they share,
    plus the keys only ``updates`` has. Keys are unique within each side."""
    tagged = old.withColumn("_seq", F.lit(0)).unionByName(
        updates.withColumn("_seq", F.lit(1)), allowMissingColumns=True
    )
    picked = [
        (F.max_by if name in updates.columns else F.min_by)(name, "_seq").alias(name)
        for name in old.columns
        if name not in keys
    ]
    return tagged.groupBy(*keys).agg(*picked)


def _overlay(config: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Configuration rows with updated columns; keys without configuration are
    left out."""
    changed = [name for name in updates.columns if name not in keys]
    renamed = updates.select(
        *keys, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in changed]
    )
    joined = config.join(renamed, keys, "left")
    return joined.select(
        *[
            F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c)
            if c in changed
            else F.col(c)
            for c in config.columns
        ]
    )

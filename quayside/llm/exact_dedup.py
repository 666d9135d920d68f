"""Exact duplicates against a persistent index of digests.

The index has one row per digest, in Parquet tables bucketed and sorted by it. A batch
is reduced to one row per digest before and after its shuffle; sort-merge anti joins
with the index leave what is new, which is appended. Only DataFrame operations are used.

Each append is a run: a table of its own with one sorted file a bucket, which a join reads
as it is. Runs are merged by ``FAN`` of a size into one of the next, so a digest is
rewritten, and a batch joined, a number of times that grows with the logarithm of the
number of batches. A run counts once its note is there; what a lost append or merge left
is passed over.

Every row of the index names the batch that added it. A batch that is run again under its
id, because what came after it was lost, meets its own rows as if they were not there
yet and so keeps what it kept before.

Null texts count as empty. Of equal texts in a batch the row with the largest id
stays; a digest that an earlier batch added stays with the row that added it, so
adding a batch again changes nothing. Ids may be null (the smallest) or repeat.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.spread import join_unique, whole
from quayside.sources import folders
from quayside.sources.relations import shared_folder, written

SCHEMA = "digest binary, keep_id bigint, group_size bigint, repeats bigint, batch string"

#: Runs of a size that are merged into one.
FAN = 4


def digest(text: str = "text") -> Column:
    """SHA-256 of the UTF-8 text, as bytes."""
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


@dataclass(frozen=True)
class Run:
    """Sorted files of the appends ``first`` to ``last``, as a table; one file a bucket."""

    first: int
    last: int
    folder: str
    table: str


class DigestIndex:
    """The index at ``path``; ``buckets`` must be the same at every opening.

    It has one writer at a time. A merge removes the runs it replaces, so what ``rows``
    returned before an append is not to be read after it.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        # Says that a bucket that is one sorted file is read as sorted.
        spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
        self.runs: list[Run] = []
        noted = [entry.name for entry in folders.entries(spark, f"{self.path}/_runs")]
        for name in _live(noted):
            first, last, _ = name.split("-")
            self.runs.append(Run(int(first), int(last), f"{self.path}/{name}", self._table(f"{self.path}/{name}")))

    def _table(self, folder: str) -> str:
        name = f"digests_{uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {name} ({SCHEMA}) USING parquet CLUSTERED BY (digest)"
            f" SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{folder}'"
        )
        return name

    def rows(self) -> DataFrame:
        return self._plain(self.runs)

    def _plain(self, runs: list[Run]) -> DataFrame:
        """Rows of some runs, as files: of a union of bucketed tables the planner holds that
        it needs no shuffle by digest, and then does not read it by buckets."""
        empty = self.spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in map(str.split, SCHEMA.split(", "))])
        return self.spark.read.schema(SCHEMA).parquet(*[run.folder for run in runs]) if runs else empty

    def close(self) -> None:
        """Forget the names of tables; their files stay."""
        for run in self.runs:
            self.spark.sql(f"DROP TABLE IF EXISTS {run.table}")

    def without(self, rows: DataFrame, batches: Column) -> DataFrame:
        """``rows(digest, ...)`` whose digest no row of some batches has: by a merge with each
        run in turn, for which ``rows`` is shuffled and sorted once and no run is."""
        rows = rows.repartition(self.buckets, "digest")
        for run in self.runs:
            known = self.spark.table(run.table).where(batches).select("digest").hint("merge")
            rows = rows.join(known, "digest", "left_anti")
        return rows

    def found(self, rows: DataFrame) -> DataFrame:
        """Rows of the index whose digest is in ``rows(digest, ...)``, which has each once, with the
        columns of both; merged with each run in turn, no run being shuffled or sorted."""
        placed = rows.repartition(self.buckets, "digest").hint("merge")
        parts = [self.spark.table(run.table).join(placed, "digest") for run in self.runs]
        return reduce(DataFrame.unionByName, parts) if parts else self.rows().join(rows, "digest")

    def add(self, rows: DataFrame, doc_id: str = "doc_id", batch: str | None = None) -> DataFrame:
        """Add the digests of ``rows(digest, doc_id)`` that no other batch added; returns them.

        ``group_size`` is the number of rows with the digest in the batch that
        added it, ``repeats`` how many of them have the id that stays.
        """
        batch = batch or uuid4().hex
        fresh = written(self.without(one_per_digest(rows, doc_id), F.col("batch") != batch), "fresh")
        self.append(self.without(fresh, F.col("batch") == batch).withColumn("batch", F.lit(batch)))
        return fresh

    def append(self, fresh: DataFrame) -> None:
        """Append rows whose digests the index lacks, as a run; then merge runs until
        fewer than ``FAN`` in a row hold equally many appends."""
        number = self.runs[-1].last + 1 if self.runs else 0
        self.runs.append(self._written(fresh, number, number))
        while len(group := self.runs[-FAN:]) == FAN and len({run.last - run.first for run in group}) == 1:
            self.runs[-FAN:] = [self._written(self._plain(group), group[0].first, group[-1].last)]
            for run in group:
                self.spark.sql(f"DROP TABLE IF EXISTS {run.table}")
                folders.remove(self.spark, f"{self.path}/_runs/{run.folder.rpartition('/')[2]}")
                folders.remove(self.spark, run.folder)

    def _written(self, rows: DataFrame, first: int, last: int) -> Run:
        """A run of ``rows``: it is part of the index once its note is there."""
        name = f"{first:09}-{last:09}-{uuid4().hex}"
        run = Run(first, last, f"{self.path}/{name}", self._table(f"{self.path}/{name}"))
        (
            rows.select(*[column.split()[0] for column in SCHEMA.split(", ")])
            .repartition(self.buckets, "digest")
            .write.format("parquet").mode("append")
            .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(run.table)
        )
        folders.put_json(self.spark, f"{self.path}/_runs/{name}", {"buckets": self.buckets})
        return run


def _live(names: list[str]) -> list[str]:
    """Names of runs, in order, without those whose appends a merged run holds."""
    live: list[str] = []
    end = -1
    # Of runs that begin alike the longest comes first.
    for name in sorted((n for n in names if not n.startswith("_")), key=lambda n: (n.split("-")[0], -int(n.split("-")[1]))):
        if int(name.split("-")[1]) > end:
            live.append(name)
            end = int(name.split("-")[1])
    return live


def one_per_digest(batch: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row per digest. Counting by digest and id first keeps a large group
    of copies from meeting in one task."""
    by_id = batch.groupBy("digest", F.col(doc_id).alias("keep_id")).agg(F.count(F.lit(1)).alias("n"))
    return by_id.groupBy("digest").agg(
        F.max("keep_id").alias("keep_id"),
        F.sum("n").alias("group_size"),
        F.max_by("n", F.struct("keep_id")).alias("repeats"),
    )


def memberships(docs: DataFrame, index: DigestIndex, doc_id: str = "doc_id", batch: str | None = None) -> DataFrame:
    """``(doc_id, digest, keep_id, group_size)`` of every row; adds it to the index, which
    may be closed after."""
    digests = written(docs.select(F.col(doc_id).alias("doc_id"), digest().alias("digest")), "digests")
    index.add(digests, batch=batch)
    counts = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("share"))
    facts = written(index.found(counts).drop("repeats", "batch"), "facts")
    return join_unique(digests, facts, "digest", "share")


def keep_one(docs: DataFrame, index: DigestIndex, doc_id: str = "doc_id", text: str = "text", batch: str | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, whole: one per text that is new to the index.

    The join is by digest and id, so copies of a text spread by their ids. The index may
    be closed after; a caller whose rows are lost runs it again with the same ``batch``.
    """
    keyed = docs.select(whole(docs), F.col(doc_id).alias("_id"), digest(text).alias("_digest"))
    fresh = index.add(keyed.select(F.col("_id").alias("keep_id"), F.col("_digest").alias("digest")), "keep_id", batch)

    def chosen(which: DataFrame) -> DataFrame:
        which = which.select("digest", "keep_id")
        same = (F.col("_digest") == F.col("digest")) & F.col("_id").eqNullSafe(F.col("keep_id"))
        return keyed.join(which, same, "left_semi")

    single = chosen(fresh.where("repeats = 1"))
    again = chosen(fresh.where("repeats > 1")).dropDuplicates(["_digest"])
    return single.unionByName(again).select("_whole.*")


def fresh_index(spark: SparkSession, buckets: int | None = None) -> DigestIndex:
    """An empty index in the shared folder, with a bucket for each shuffle partition unless
    told otherwise: an append then writes one file a bucket."""
    found = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return DigestIndex(spark, shared_folder(spark, "digest-index"), found)

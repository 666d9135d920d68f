"""Incremental pulls from tables: changed rows between two watermarks."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import or_
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.times import bound, from_micros, to_micros
from quayside.sources import commits, folders
from quayside.sources.relations import relation


def incremental(source: DataFrame, columns: Sequence[str], ts_column: str,
                last: datetime, current: datetime) -> DataFrame:
    """Declared columns of the rows changed in ``[last, current]``.

    Both ends belong to the window, so a row on the old watermark comes again.
    """
    changed = F.col(ts_column).between(
        bound(source, ts_column, last), bound(source, ts_column, current)
    )
    return source.where(changed).select(*columns)


def incremental_many(source: DataFrame, watermarks: DataFrame, entity_column: str,
                     ts_column: str, current: datetime) -> DataFrame:
    """Rows of a table that holds many entities, each from its own watermark.

    ``watermarks`` has one row ``(entity, last_ts)`` per entity. The lowest
    watermark and the current time reach the scan as row-group filters; the join
    then applies each entity's own bound.
    """
    marks = watermarks.select(
        F.col("entity").alias("_entity"), F.col("last_ts").alias("_last_ts")
    )
    lowest = marks.select(F.min("_last_ts")).scalar()
    ts = F.col(ts_column)
    changed = source.where((ts >= lowest) & (ts <= bound(source, ts_column, current)))
    own_window = (F.col(entity_column) == F.col("_entity")) & (ts >= F.col("_last_ts"))
    return changed.join(marks, own_window).select(*source.columns)


#: Entities whose windows are one pushed filter; beyond, they are joined by time slice.
FILTERED = 200
#: Time slices between the lowest watermark and the current time.
SLICES = 64


def incremental_sliced(source: DataFrame, watermarks: DataFrame, entity_column: str, ts_column: str,
                       current: datetime, filtered: int = FILTERED) -> DataFrame:
    """As ``incremental_many``, without a join on the entity alone.

    The windows of a few entities are one disjunction, which reaches the row groups and
    moves no row. Otherwise rows are joined with the watermarks by entity and slice
    of time, so that an entity with a third of all rows is many keys. Both give the
    same rows; the first costs a longer filter with every entity.
    """
    at = F.unix_micros(F.col("last_ts").cast("timestamp")).alias("at")
    few = watermarks.select("entity", at).limit(filtered + 1).collect()
    ts, upper = F.col(ts_column), bound(source, ts_column, current)
    if len(few) <= filtered:
        known = [row for row in few if row["at"] is not None and row.entity is not None]
        windows = [(F.col(entity_column) == row.entity) & (ts >= bound(source, ts_column, from_micros(row["at"]))) for row in known]
        return source.where(reduce(or_, windows, F.lit(False)) & (ts <= upper))
    end = to_micros(current)
    lowest = watermarks.select(F.min(at)).first()[0]
    width = max(1, -(-(end - lowest + 1) // SLICES)) if lowest is not None else 1

    def part(micros: Column) -> Column:
        return F.floor((micros - (lowest or 0)) / width)

    marks = watermarks.select(F.col("entity").alias("_entity"), F.col("last_ts").alias("_last_ts"), at).where(f"at <= {end}")
    sliced = marks.select("_entity", "_last_ts", F.explode(F.sequence(part(F.col("at")), part(F.lit(end)))).alias("_mark_slice"))
    changed = source.where((ts >= bound(source, ts_column, from_micros(lowest or 0))) & (ts <= upper))
    cut = changed.withColumn("_slice", part(F.unix_micros(ts.cast("timestamp"))))
    own = (F.col(entity_column) == F.col("_entity")) & (F.col("_slice") == F.col("_mark_slice")) & (ts >= F.col("_last_ts"))
    return cut.join(sliced, own).select(*source.columns)


class Boundaries:
    """Rows on the upper bound of earlier pulls, as digests with their number, below ``root``.

    The next window of an entity begins on the bound the last one ended on. What was on it
    then is not pulled again; what came to it since is. Of equal rows as many are
    left out as were pulled. A pull notes its bound before its load has succeeded, which
    does no harm: only a load whose window begins there asks for it.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _folder(self, entity: str, at: datetime) -> str:
        return f"{self.root}/{quote(entity, safe='')}/{to_micros(at)}"

    def seen(self, entity: str, at: datetime) -> DataFrame:
        """``(digest, n)`` of the rows pulled so far with that very time."""
        folder = self._folder(entity, at)
        if not folders.exists(self.spark, folder):
            return relation(self.spark, [], "digest binary, n bigint")
        return commits.read(self.spark, folder)

    def pulled(self, source: DataFrame, entity: str, columns: Sequence[str], ts_column: str,
               last: datetime, current: datetime) -> DataFrame:
        """Declared columns of the rows changed in ``[last, current]`` and not pulled before."""
        ts = F.col(ts_column)
        lower, upper = bound(source, ts_column, last), bound(source, ts_column, current)
        on_upper = numbered(source.where(ts == upper), columns).select("digest", "n")
        landed = numbered(source.where(ts == lower), columns).join(
            self.seen(entity, last).withColumnRenamed("n", "_seen"), "digest", "left"
        )
        left = F.greatest(F.col("n") - F.coalesce("_seen", F.lit(0)), F.lit(0))
        again = landed.select(F.explode(F.array_repeat(F.col("row"), left.cast("int"))).alias("row")).select("row.*")
        inside = source.where((ts > lower) & (ts <= upper)).select(*columns)
        commits.write(self.spark, self._folder(entity, current), lambda at: (commits.counted(on_upper, at), on_upper.schema))
        return inside.unionByName(again)


def numbered(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(digest, row, n)``: each different row once, with its digest and number."""
    row = F.struct(*[F.col(name) for name in columns])
    digest = F.unhex(F.sha2(F.to_json(row, {"ignoreNullFields": "false"}).cast("binary"), 256))
    return rows.groupBy(digest.alias("digest")).agg(F.first(row).alias("row"), F.count(F.lit(1)).alias("n"))

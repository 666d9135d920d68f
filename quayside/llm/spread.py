"""Joins and numbers that hold when one key has a third of all rows."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])

#: A key is hot if it has more than one in so many of all rows; so there are at
#: most this many hot keys, however large the input.
HOT_SHARE = 1_000


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{known}:{ROOT}".strip(":")


def whole(rows: DataFrame) -> Column:
    """A row as one struct, safe from clashes with columns put beside it."""
    return F.struct(*[F.col(f"`{name}`") for name in rows.columns]).alias("_whole")


def join_unique(rows: DataFrame, facts: DataFrame, key: str, share: str) -> DataFrame:
    """``rows`` left-joined with ``facts``, which has each ``key`` once.

    ``facts[share]`` is the number of rows each key has in ``rows``. Keys with
    over one in ``HOT_SHARE`` of all rows are joined by broadcast, being at most
    ``HOT_SHARE``; the rest is left to the planner, and no key of it is large.
    Null keys match nothing. ``share`` is dropped from the result.
    """
    total = facts.agg(F.coalesce(F.sum(share), F.lit(0))).first()[0]
    hot = F.col(share) * HOT_SHARE > F.lit(total)
    names = [name for name in facts.columns if name not in (key, share)]
    few = facts.where(hot).select(key, F.struct(*names).alias("_hot"))
    marked = rows.join(F.broadcast(few), key, "left")
    found = marked.where("_hot is not null").select(*rows.columns, *[f"_hot.{n}" for n in names])
    rest = marked.where("_hot is null").select(*rows.columns)
    cold = facts.where(~hot).select(key, *names)
    return found.unionByName(rest.join(cold, key, "left").select(*rows.columns, *names))


def learnt_from(doc_id: str = "doc_id") -> Column:
    """Whether a row may be learnt from: crc32 of its id mod 5 is not 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 != 0, F.lit(False))

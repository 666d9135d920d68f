"""Small driver-side rows as relations, and folders for intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quayside.sources import folders


def relation(spark: SparkSession, rows: Iterable[Mapping], ddl: str) -> DataFrame:
    """Control-plane rows as a DataFrame.

    Built from Arrow, so Spark holds it as a local relation of known size and
    can decide by that size whether a join broadcasts it.
    """
    schema = T.StructType.fromDDL(ddl)
    table = pa.Table.from_pylist(list(rows), schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the folder every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``. Where it does not, the
    warehouse holds it, unless that is a folder of one machine and the executors are not on it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    base = named or spark.conf.get("spark.sql.warehouse.dir")
    if not named and base.startswith("file:") and spark.conf.get("spark.master", "local").split("[")[0] != "local":
        raise ValueError(f"spark.checkpoint.dir is not set, and {base} may be a folder of one machine")
    return f"{base.rstrip('/')}/quayside-{name}-{uuid4().hex}"


def written(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written to the shared folder and read back, in folders by some columns.

    Cuts the lineage: later steps reread files instead of recomputing, also
    after executors are lost, and see exact sizes.
    """
    return _kept(df, shared_folder(df.sparkSession, name), by)


def _kept(df: DataFrame, path: str, by: tuple[str, ...]) -> DataFrame:
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """``written`` for tables that nothing needs after the block: their files go with it."""
    made: list[str] = []

    def keep(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
        made.append(shared_folder(spark, name))
        return _kept(df, made[-1], by)

    try:
        yield keep
    finally:
        for path in made:
            folders.remove(spark, path)

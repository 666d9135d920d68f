"""Landing tables in the catalog."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from quayside.concurrency import run_all
from quayside.sources import folders


@dataclass(frozen=True)
class EntityTable:
    """One landed entity to publish."""

    entity: str
    location: str
    schema: T.StructType


def _quoted(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def _kinds(spark: SparkSession, database: str) -> dict[str, str]:
    """Tables and views of a database, without temporary ones, with their kind."""
    if not spark.catalog.databaseExists(database):
        return {}
    found = spark.catalog.listTables(_quoted(database))
    return {item.name: item.tableType for item in found if not item.isTemporary}


def tables(spark: SparkSession, database: str) -> list[str]:
    """Tables and views of a database. Empty if there is no such database."""
    return sorted(_kinds(spark, database))


def drop(spark: SparkSession, database: str, names: Sequence[str], workers: int = 8) -> None:
    """Drop tables and views; the files of external tables stay.

    A table that owns its files is refused: dropping it would delete data.
    """
    kinds = _kinds(spark, database)
    owned = [name for name in names if kinds.get(name) == "MANAGED"]
    if owned:
        raise ValueError(f"{database} has tables that own their data: {', '.join(owned)}")

    def gone(name: str) -> None:
        kind = "VIEW" if kinds.get(name) == "VIEW" else "TABLE"
        spark.sql(f"DROP {kind} IF EXISTS {_quoted(database, name)}")

    run_all(spark, gone, names, workers)


def clear(spark: SparkSession, database: str) -> list[str]:
    """Drop every table and view of a database and return their names."""
    dropped = tables(spark, database)
    drop(spark, database, dropped)
    return dropped


def publish(spark: SparkSession, database: str, entities: Sequence[EntityTable], workers: int = 8) -> None:
    """Make the database hold exactly one external Parquet table per entity.

    Missing tables are created and changed ones moved to their new place or,
    with a new schema, replaced; unchanged ones are left alone. What no entity
    has is dropped last. A publish that fails puts back what it changed.
    """
    if not spark.catalog.databaseExists(database):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    kinds = _kinds(spark, database)
    stale = sorted(set(kinds) - {item.entity for item in entities})
    owned = [name for name, kind in kinds.items() if kind == "MANAGED"]
    if owned:
        raise ValueError(f"{database} has tables that own their data: {', '.join(sorted(owned))}")

    undo: list[EntityTable | str] = []

    def put(item: EntityTable) -> None:
        name = _quoted(database, item.entity)
        kind = kinds.get(item.entity)
        if kind == "EXTERNAL":
            undo.append(EntityTable(item.entity, _location(spark, name), spark.table(name).schema))
        elif kind is None:
            undo.append(item.entity)
        if kind == "EXTERNAL" and spark.table(name).schema == item.schema:
            if folders.key_root(spark, _location(spark, name)) != folders.key_root(spark, item.location):
                spark.sql(f"ALTER TABLE {name} SET LOCATION '{_text(item.location)}'")
            spark.catalog.refreshTable(name)
            return
        if kind is not None:
            drop(spark, database, [item.entity])
        spark.catalog.createTable(name, path=item.location, source="parquet", schema=item.schema)

    try:
        run_all(spark, put, entities, workers)
    except Exception:
        for old in list(undo):
            if isinstance(old, str):
                spark.sql(f"DROP TABLE IF EXISTS {_quoted(database, old)}")
            else:
                _restore(spark, database, old)
        raise
    drop(spark, database, stale, workers)


def _restore(spark: SparkSession, database: str, old: EntityTable) -> None:
    """The table as it was."""
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(database, old.entity)}")
    spark.catalog.createTable(_quoted(database, old.entity), path=old.location, source="parquet", schema=old.schema)


def switch(spark: SparkSession, database: str, entities: Sequence[EntityTable], generation: str, workers: int = 8) -> None:
    """Make the database show exactly one view per entity, all of one generation.

    The tables of the generation are built first, in a database of their own, beside
    those of the one before. Only when all are there the views are turned to them; if one
    cannot be, those turned already are turned back. So a publish that fails leaves the
    old set whole. Generations before the last two are dropped, their files stay.
    """
    behind = f"{database}__{generation}"
    earlier = _generations(spark, database)
    shown = {name: _definition(spark, database, name) for name in views(spark, database)}
    kinds = _kinds(spark, database)
    tables_there = sorted(set(kinds) - set(shown))
    if tables_there:
        raise ValueError(f"{database} has tables beside its views: {', '.join(tables_there)}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    publish(spark, behind, entities, workers)
    turned: list[str] = []

    def show(name: str, query: str) -> None:
        spark.sql(f"CREATE OR REPLACE VIEW {_quoted(database, name)} AS {query}")

    try:
        for item in entities:
            turned.append(item.entity)
            show(item.entity, f"SELECT * FROM {_quoted(behind, item.entity)}")
        stale = sorted(set(shown) - {item.entity for item in entities})
        for name in stale:
            turned.append(name)
            spark.sql(f"DROP VIEW {_quoted(database, name)}")
    except Exception:
        for name in turned:
            if name in shown:
                show(name, shown[name])
            else:
                spark.sql(f"DROP VIEW IF EXISTS {_quoted(database, name)}")
        raise
    for old in [g for g in earlier if g != behind][:-1]:
        clear(spark, old)
        spark.sql(f"DROP DATABASE IF EXISTS {_quoted(old)}")


def views(spark: SparkSession, database: str) -> list[str]:
    return sorted(name for name, kind in _kinds(spark, database).items() if kind == "VIEW")


def _generations(spark: SparkSession, database: str) -> list[str]:
    """Databases of the generations, oldest first by name."""
    found = [item.name for item in spark.catalog.listDatabases(f"{database}__*")]
    return sorted(name for name in found if name.startswith(f"{database}__"))


def _definition(spark: SparkSession, database: str, name: str) -> str:
    """The query of a view."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {_quoted(database, name)}")
    return described.where("col_name = 'View Text'").first().data_type


def _text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def _location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    return described.first().data_type

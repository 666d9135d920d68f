"""JSON access, text casts and names out of column metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_field(text: Column, name: str) -> Column:
    """One field of a JSON object as text; null where it is absent."""
    return F.get_json_object(text, f"$.{name}")


def all_string(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The declared columns, by name and in declared order, as strings.

    A declared column the data lacks becomes null; undeclared ones are dropped.
    """
    present = {name.lower(): name for name in df.columns}

    def as_text(name: str) -> Column:
        found = present.get(name.lower())
        source = F.lit(None) if found is None else F.col(f"`{found}`")
        return source.cast("string").alias(name)

    return df.select(*[as_text(name) for name in columns])


def column_names(column_metadata: Column) -> Column:
    """Names out of the array of column descriptions in the source metadata."""
    return F.transform(column_metadata, lambda item: item["name"])

"""Load ids, watermark texts and typed time bounds."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.constants import ENTITY_WATERMARK_SUFFIX, ISO_FORMAT, LOAD_ID_FORMAT


def load_id_timestamp(load_id: Column) -> Column:
    """Time of a load id; null where the text is not a load id."""
    return F.try_to_timestamp(load_id, F.lit(LOAD_ID_FORMAT))


def file_watermark_text(load_id: Column) -> Column:
    """Load id as ISO text, the form of the file watermark."""
    return F.date_format(load_id_timestamp(load_id), ISO_FORMAT)


def entity_watermark_text(load_id: Column) -> Column:
    """Load id as ISO text with milliseconds, the form of the entity watermark."""
    return F.concat(file_watermark_text(load_id), F.lit(ENTITY_WATERMARK_SUFFIX))


def utc(value: datetime) -> datetime:
    """``value`` as an aware UTC datetime; a naive one is taken as UTC."""
    if value.tzinfo is None:
        return value.replace(tzinfo=timezone.utc)
    return value.astimezone(timezone.utc)


def bound(df: DataFrame, column: str, value: datetime) -> Column:
    """``value`` as a literal of the type of ``column``.

    Comparing two timestamp types would put a cast on the column and keep the
    predicate from the Parquet reader, so the literal takes the column's type.
    """
    value = utc(value)
    kind = df.select(column).schema[0].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(value.replace(tzinfo=None).isoformat(" ")).cast("timestamp_ntz")
    if isinstance(kind, T.StringType):
        text = value.strftime("%Y-%m-%dT%H:%M:%S") + f".{value.microsecond // 1000:03d}Z"
        return F.lit(text)
    return F.lit(value)


def from_micros(micros: int) -> datetime:
    """UTC time of ``unix_micros``; collecting timestamps themselves would give
    them in the time zone of the driver process."""
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)


def to_micros(value: datetime) -> int:
    """The ``unix_micros`` of a time."""
    return (utc(value) - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def run_time() -> Column:
    """Time of the running query, for start, end and log times."""
    return F.current_timestamp()

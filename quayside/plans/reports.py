"""Reports over a change feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.operators import runs, selection
from quayside.params import ChangeWindow


def landing_report(feed: DataFrame, declared: DataFrame, entity_column: str, ts_column: str,
                   window: ChangeWindow) -> DataFrame:
    """Row counts of the declared entities that changed in the window."""
    counts = (
        selection.changed(feed, ts_column, window)
        .groupBy(F.lower(entity_column).alias("entity"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return runs.entity_report(declared, counts)

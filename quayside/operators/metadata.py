"""Entities, their configuration and job ids out of the control tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.constants import ACTIVE, QUERY_TABLE
from quayside.functions import paths
from quayside.functions.values import column_names
from quayside.sources.control import lookup


def active_entities(metadata: DataFrame, source: str, country: str) -> DataFrame:
    """Active entities of a source and country, with product and subject area."""
    keys = {"source_system": source, "country_code": country, "entity_status": ACTIVE}
    return lookup(metadata, keys, ["entity", "data_product", "subject_area"])


def query_entities(metadata: DataFrame, source: str, country: str) -> DataFrame:
    """Active entities of a source and country that are pulled by query."""
    keys = {
        "source_system": source,
        "country_code": country,
        "table_type": QUERY_TABLE,
        "entity_status": ACTIVE,
    }
    return lookup(metadata, keys, ["entity"]).distinct()


def entity_config(entities: DataFrame, metadata: DataFrame, source: str,
                  country: str) -> DataFrame:
    """Pull configuration of each entity: declared columns, the first timestamp
    column and the watermark, by metadata key."""
    keyed = entities.withColumn(
        "source_metadata_id", paths.metadata_key(F.lit(country), F.col("entity"))
    )
    config = lookup(
        metadata,
        {"source_system": source},
        ["source_metadata_id", "timestamp_fields", "column_metadata", "last_run_ts"],
    )
    return keyed.join(config, "source_metadata_id").select(
        "entity",
        "source_metadata_id",
        column_names(F.col("column_metadata")).alias("columns"),
        F.get("timestamp_fields", F.lit(0)).alias("ts_column"),
        "last_run_ts",
    )


def job_ids(jobs: DataFrame, order: str = "seq") -> DataFrame:
    """Id of each job of each process; of several the last in order."""
    return jobs.groupBy("process_id", "job_name").agg(F.max_by("job_id", order).alias("job_id"))


def job_id(jobs: DataFrame, process_id: str, job_name: str) -> DataFrame:
    """Id of one job of a process."""
    found = lookup(jobs, {"process_id": process_id, "job_name": job_name}, jobs.columns)
    return job_ids(found).select("job_id")

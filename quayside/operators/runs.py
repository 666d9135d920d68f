"""Run log, rerun checks, run details and the entity report."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.constants import FAILED, LAYER, SUCCESS
from quayside.functions.times import run_time, utc
from quayside.params import LoadParams
from quayside.sources.control import ControlStore, latest, lookup

LOAD_KEYS = ["layer", "load_id", "process_id", "country_code"]


def succeeded(log: DataFrame, params: LoadParams) -> DataFrame:
    """One row ``is_rerun``: has this load succeeded before?"""
    keys = {
        "layer": LAYER,
        "load_id": params.load_id,
        "process_id": params.process_id,
        "country_code": params.country,
        "job_run_status": SUCCESS,
    }
    return any_match(lookup(log, keys, ["load_id"]), "is_rerun")


def any_match(rows: DataFrame, name: str) -> DataFrame:
    """One row that says whether there is any row; stops at the first."""
    return rows.limit(1).agg((F.count(F.lit(1)) > 0).alias(name))


def done(loads: DataFrame, log: DataFrame, keys: list[str] = LOAD_KEYS) -> DataFrame:
    """Loads the log reports as succeeded."""
    return loads.join(log.where(F.col("job_run_status") == SUCCESS), keys, "left_semi")


def pending(loads: DataFrame, log: DataFrame, keys: list[str] = LOAD_KEYS) -> DataFrame:
    """Loads the log does not report as succeeded."""
    return loads.join(log.where(F.col("job_run_status") == SUCCESS), keys, "left_anti")


def status_row(params: LoadParams, status: str, message: str | None = None,
               job_id: str | None = None) -> dict:
    return {
        "layer": LAYER,
        "load_id": params.load_id,
        "process_id": params.process_id,
        "country_code": params.country,
        "job_run_status": status,
        "error_message": message,
        "job_id": job_id,
    }


def append_status(control: ControlStore, params: LoadParams, status: str, message: str | None = None,
                  job_id: str | None = None, token: str | None = None) -> None:
    """Log a status of this load."""
    row = status_row(params, status, message, job_id)
    control.append_rows("process_log", [{**row, "logged_at": datetime.now(timezone.utc)}], token)


def append_failure(control: ControlStore, params: LoadParams, error: BaseException,
                   job_id: str | None = None) -> None:
    append_status(control, params, FAILED, f"{type(error).__name__}: {error}", job_id)


def latest_status(log: DataFrame, keys: list[str] = LOAD_KEYS) -> DataFrame:
    """Last logged status of every load."""
    return latest(log, keys, ["logged_at"])


def details(counts: DataFrame, load_id: str, start: datetime | None = None,
            status: str = SUCCESS, job_id: str | None = None) -> DataFrame:
    """Run detail rows out of entity counts."""
    return counts.select(
        F.lower("entity").alias("entity"),
        "row_count",
        F.lit(0).cast("bigint").alias("error_count"),
        F.lit(start).cast("timestamp").alias("start_time"),
        run_time().alias("end_time"),
        F.lit(status).alias("status"),
        F.lit(load_id).alias("load_id"),
        F.lit(job_id).cast("string").alias("job_id"),
    )


def append_details(control: ControlStore, counts: DataFrame, load_id: str, start: datetime,
                   job_id: str | None = None, token: str | None = None) -> None:
    """Log the details of a run, one row per entity."""
    found = details(counts, load_id, None, job_id=job_id).drop("start_time", "end_time").collect()
    times = {"start_time": utc(start), "end_time": datetime.now(timezone.utc)}
    control.append_rows("run_details", [{**row.asDict(), **times} for row in found], token)


def entity_report(active: DataFrame, counts: DataFrame, match_case: bool = False) -> DataFrame:
    """Active entities with their landed row counts; entities without data are
    left out.

    Counts carry lower-cased names. Declared names are lower-cased too, unless
    ``match_case`` asks for the stricter match in which a declared name with
    upper case finds nothing.
    """
    declared = active if match_case else active.withColumn("entity", F.lower("entity"))
    return declared.join(counts, "entity")

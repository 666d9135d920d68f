"""Physical plans: what reaches the scan, what is shuffled, what is broadcast."""

from __future__ import annotations

import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from quayside.plans import acceptance
from quayside.sources import pull
from tools import plan_text, values

SF_DIR = "/root/testdata/sf0.01"

PUSHED = {
    "incremental_half_open": ["GreaterThan(ts,2024-01-08T00:00)", "LessThanOrEqual(ts,2024-01-15T12:00)"],
    "pull_between_inclusive": ["GreaterThanOrEqual(o_orderdate,1997", "LessThanOrEqual(o_orderdate,1997"],
    "landing_report": ["GreaterThan(ts,2024-01-08T00:00)", "LessThanOrEqual(ts,2024-01-15T12:00)"],
    "per_entity_watermark_pull": ["GreaterThanOrEqual(ts,ScalarSubquery", "LessThanOrEqual(ts,2024-01-15T12:00)"],
    "active_entities": ["EqualTo(lang,en)", "EqualTo(quality,1)"],
    "rerun_exists": ["EqualTo(event_type,purchase)", "EqualTo(user_id,8)"],
}

# Columns each query may read, per scan.
READ = {
    "landing_report": {"ts", "event_type"},
    "window_file_count": {"ts"},
    "watermark_upsert": {"ts", "event_type"},
    "expand_landing_path": {"doc_id", "lang", "source"},
    "props_json": {"event_id", "props"},
    "job_id_last_match": {"o_orderkey", "o_custkey", "o_orderstatus"},
    "suffix_semi_join": {"page_id", "url", "lang"},
    "not_marker": {"page_id", "url"},
}

NO_SHUFFLE = [
    "incremental_half_open", "pull_between_inclusive", "window_or_forced_entity",
    "entity_from_path", "rejected_keys", "expand_landing_path", "all_string_rows", "page_union",
    "props_json", "load_id_to_iso", "not_marker",
]


def details(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("name", sorted(PUSHED))
def test_filters_reach_the_scan(spark, name):
    text = details(acceptance.queries()[name](spark, SF_DIR))
    pushed = " ".join(re.findall(r"PushedFilters: (.*)", text))
    assert all(item in pushed for item in PUSHED[name]), pushed


@pytest.mark.parametrize("name", sorted(READ))
def test_scans_read_only_what_is_used(spark, name):
    text = details(acceptance.queries()[name](spark, SF_DIR))
    read = set(re.findall(r"(\w+):", " ".join(re.findall(r"ReadSchema: struct<(.*)>", text))))
    assert read <= READ[name]


@pytest.mark.parametrize("name", NO_SHUFFLE)
def test_no_shuffle(spark, name):
    assert "Exchange" not in plan_text(acceptance.queries()[name](spark, SF_DIR))


@pytest.mark.parametrize("query", acceptance.QUERIES, ids=lambda query: query.__name__)
def test_no_row_python_no_cross_join(spark, query):
    text = plan_text(query(spark, SF_DIR))
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "NestedLoopJoin", "Window", "ExistingRDD"):
        assert bad not in text, bad


@pytest.mark.parametrize(
    "name",
    ["suffix_semi_join", "active_entities", "not_yet_loaded", "already_loaded", "landing_plan",
     "per_entity_watermark_pull", "query_entity_config"],
)
def test_broadcasts_depend_on_size(spark, name):
    """Nothing is broadcast by hint: past the size limit the same query shuffles
    both sides and gives the same rows."""
    query = acceptance.queries()[name]
    small = query(spark, SF_DIR)
    assert "BroadcastHashJoin" in plan_text(small)
    expected = values(small)
    limits = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    try:
        for limit in limits:
            spark.conf.set(limit, -1)
        large = query(spark, SF_DIR)
        assert "Broadcast" not in plan_text(large)
        assert values(large) == expected
    finally:
        for limit in limits:
            spark.conf.unset(limit)


def test_hot_entity_with_own_watermark(spark):
    """A third of all rows belong to one entity; checked against brute force,
    with and without broadcast."""
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("id"), F.lit(10_000)))
    feed = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id") % 50)).alias("e"),
        at.alias("ts"),
        "id",
    )
    marks = feed.select("e").distinct().select(
        F.col("e").alias("entity"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.length("e") * 1000).alias("last_ts"),
    )
    current = datetime.fromtimestamp(1_700_008_000, timezone.utc)
    found = pull.incremental_many(feed, marks, "e", "ts", current)
    expected = [
        row.id
        for row in feed.withColumn("s", F.unix_seconds("ts")).collect()
        if 1_700_000_000 + len(row.e) * 1000 <= row.s <= 1_700_008_000
    ]
    assert sorted(row.id for row in found.collect()) == sorted(expected)


def test_a_hot_entity_is_many_keys(spark):
    """A third of all rows in one entity, no broadcast: the largest task is near the median."""
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("id"), F.lit(10_000)))
    name = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(900))))
    feed = spark.range(90_000).select(name.alias("e"), at.alias("ts"), "id")
    marks = feed.select(F.col("e").alias("entity")).distinct().withColumn("last_ts", F.timestamp_seconds(F.lit(1_700_000_000)))
    current = datetime.fromtimestamp(1_700_010_000, timezone.utc)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": -1, "spark.sql.adaptive.autoBroadcastJoinThreshold": -1,
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.adaptive.skewJoin.enabled": "false",
    }
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        found = pull.incremental_sliced(feed, marks, "e", "ts", current, filtered=0)
        sizes = sorted(row[0] for row in found.groupBy(F.spark_partition_id()).count().select("count").collect())
        whole = pull.incremental_many(feed, marks, "e", "ts", current)
        skewed = sorted(row[0] for row in whole.groupBy(F.spark_partition_id()).count().select("count").collect())
        assert values(found) == values(whole) and sum(sizes) == 90_000
    finally:
        for key in settings:
            spark.conf.unset(key)
    median = sizes[len(sizes) // 2]
    assert sizes[-1] < 1.6 * median < skewed[-1]


def test_few_windows_are_one_pushed_filter(spark):
    feed = spark.read.parquet(f"{SF_DIR}/events.parquet").select("event_type", "ts", "event_id")
    marks = feed.select(F.col("event_type").alias("entity")).distinct().withColumn("last_ts", F.lit("2024-01-02").cast("timestamp_ntz"))
    found = pull.incremental_sliced(feed, marks, "event_type", "ts", datetime(2024, 1, 9))
    text = details(found)
    assert "Join" not in text and "Exchange" not in text and "GreaterThanOrEqual(ts" in text


def test_rows_on_a_bound_come_once(spark, tmp_path):
    """Equal rows count: as many are left out as were pulled before."""
    def day(n):
        return datetime(2024, 1, n)

    def table(*rows):
        return spark.createDataFrame([(day(n), key, None) for n, key in rows], "at timestamp_ntz, id string, x string")

    known = pull.Boundaries(spark, str(tmp_path / "b"))

    def ids(source, last, current):
        return sorted(row.id for row in known.pulled(source, "de/ord", ["id", "x"], "at", day(last), day(current)).collect())

    rows = [(1, "a"), (2, "b"), (2, "b"), (3, "c")]
    assert ids(table(*rows), 1, 2) == ["a", "b", "b"]
    assert ids(table(*rows, (2, "b"), (2, "late")), 2, 3) == ["b", "c", "late"]
    assert ids(table(*rows), 3, 4) == []
    # The same window again gives the same rows.
    assert ids(table(*rows, (2, "b"), (2, "late")), 2, 3) == ["b", "c", "late"]

from __future__ import annotations

import pytest

from quayside.sources.relations import relation, shared_folder, written
from tools import plan_text, values


class Settings:
    """A session that only has settings."""

    def __init__(self, **found):
        self.conf = self
        self.found = {name.replace("_", "."): value for name, value in found.items()}

    def get(self, name, default=None):
        return self.found.get(name, default)


def test_relation_has_a_known_size(spark):
    df = relation(spark, [{"a": "x", "b": None}], "a string, b array<struct<name:string>>")
    assert values(df) == [("x", None)]
    assert "LocalTableScan" in plan_text(df)
    stats = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert int(str(stats)) < 1000
    assert relation(spark, [], "a string").count() == 0


def test_shared_folder_is_the_one_the_cluster_names(spark):
    session = Settings(spark_checkpoint_dir="s3a://bucket/shared/", spark_master="yarn")
    one, other = shared_folder(session, "x"), shared_folder(session, "x")
    assert one != other and one.startswith("s3a://bucket/shared/quayside-x-")


def test_without_one_the_warehouse_is_shared():
    session = Settings(**{"spark.sql.warehouse.dir": "s3a://bucket/warehouse"})
    assert shared_folder(session, "x").startswith("s3a://bucket/warehouse/quayside-x-")


def test_a_warehouse_on_one_machine_is_not_shared():
    found = {"spark.sql.warehouse.dir": "file:/tmp/warehouse"}
    with pytest.raises(ValueError, match="spark.checkpoint.dir is not set"):
        shared_folder(Settings(**found, spark_master="spark://host:7077"), "x")
    assert shared_folder(Settings(**found, spark_master="local[8]"), "x").startswith("file:/tmp/warehouse/")


def test_written_cuts_the_lineage(spark):
    df = spark.range(10).selectExpr("id", "id % 2 = 0 as even").where("even")
    found = written(df, "numbers")
    assert values(found) == values(df)
    assert "Range" not in plan_text(found) and found.dtypes == df.dtypes

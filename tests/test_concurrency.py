from __future__ import annotations

import time

import pytest

from quayside.concurrency import run_all


def test_results_in_order_and_job_properties(spark):
    spark.sparkContext.setLocalProperty("mark", "caller")
    try:
        found = run_all(
            spark,
            lambda n: (spark.range(n).count(), spark.sparkContext.getLocalProperty("mark")),
            range(20),
            workers=4,
        )
    finally:
        spark.sparkContext.setLocalProperty("mark", None)
    assert found == [(n, "caller") for n in range(20)]


def test_failure_stops_what_has_not_begun(spark):
    begun = []

    def action(n):
        begun.append(n)
        time.sleep(1 if n == 0 else 0.02)
        if n == 3:
            raise ValueError("third")
        return n

    with pytest.raises(ValueError, match="third"):
        run_all(spark, action, range(1000), workers=2)
    assert 4 <= len(begun) < 500

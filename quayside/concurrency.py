"""Several Spark jobs at a time from one driver."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from functools import partial
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")


def run_all(spark: SparkSession, action: Callable[[Item], Result], items: Iterable[Item],
            workers: int = 8) -> list[Result]:
    """``action`` of every item, in order, ``workers`` at a time.

    The jobs keep the tags, job group and scheduler pool of the caller. A
    failure is raised once the jobs under way have ended; the rest is dropped.
    """
    with ThreadPoolExecutor(max_workers=workers) as pool:
        # Wrapped once per item: each wrap carries its own copy of the caller's
        # job properties, which Spark changes while a query runs.
        begun = [
            pool.submit(inheritable_thread_target(spark)(partial(action, item))) for item in items
        ]
        done, _ = wait(begun, return_when=FIRST_EXCEPTION)
        pool.shutdown(cancel_futures=True)
    for future in done:
        future.result()
    return [future.result() for future in begun]

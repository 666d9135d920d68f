"""Small source trees with known change times."""

from __future__ import annotations

import os
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

from quayside.params import ChangeWindow

LAST = datetime(2022, 1, 16, 10, tzinfo=timezone.utc)
CURRENT = datetime(2022, 1, 17, 10, 11, 12, tzinfo=timezone.utc)
LOAD_ID = "20220117101112"
WINDOW = ChangeWindow(LAST, CURRENT)
SECOND = timedelta(seconds=1)
HOUR = timedelta(hours=1)

TEMPLATE = "<source-system>/<cluster>/<source-system>_<cluster>_<entity>/<folder>/<file>"
LANDING = "<source-system>/<cluster>/<loadid>/<entity>/<file>"


def put(root: Path, key: str, modified: datetime, columns: dict | None = None) -> None:
    """Write a Parquet file, or some bytes where ``columns`` is ``None``."""
    target = Path(root) / key
    target.parent.mkdir(parents=True, exist_ok=True)
    if columns is None:
        target.write_bytes(b"marker")
    else:
        pq.write_table(pa.table(columns), target)
    touch(root, key, modified)


def touch(root: Path, key: str, modified: datetime) -> None:
    stamp = modified.timestamp()
    os.utime(Path(root) / key, (stamp, stamp))


def values(df, *columns):
    """Rows as a sorted list of tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in chosen.collect()), key=repr)


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df) -> list:
    """Leaf nodes of the executed plan; run the query first."""

    def leaves(plan):
        nodes = plan.collectLeaves().iterator()
        while nodes.hasNext():
            node = nodes.next()
            if node.nodeName().startswith("AdaptiveSparkPlan"):
                yield from leaves(node.executedPlan())
            elif "QueryStage" in node.nodeName():
                yield from leaves(node.plan())
            else:
                yield node

    return list(leaves(df._jdf.queryExecution().executedPlan()))


def files_read(df) -> int:
    """Files the scans of an executed query read."""
    metrics = [node.metrics() for node in scans(df)]
    return sum(m.get("numFiles").get().value() for m in metrics if m.contains("numFiles"))

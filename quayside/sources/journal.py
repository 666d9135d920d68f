"""A journal of one load: which of its steps are done, and with what result.

A step's result is written as a small file of its own before the next step begins. A
load that is run again under the same id finds the steps that ended, does not repeat
them and uses what they recorded; above all the windows it opened with, however far
watermarks have moved since. The first record of a step stays.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions import paths
from quayside.params import LoadParams
from quayside.sources import folders
from quayside.sources.relations import relation

TABLE = "load_journal"
DDL = "process_id string, country_code string, load_id string, step string, facts string"

#: Called as ``(step, "did")`` once a step has taken effect and ``(step, "noted")`` once that is
#: recorded. What it raises ends the load.
Progress = Callable[[str, str], None]


class Journal:
    """Steps of one load, below the root of the control tables."""

    def __init__(self, spark: SparkSession, root: str, params: LoadParams, progress: Progress | None = None):
        names = (params.process_id, params.country, params.load_id)
        self.spark, self.progress = spark, progress or (lambda step, state: None)
        self.folder = "/".join([root.rstrip("/"), TABLE, *(quote(name, safe="") for name in names)])
        #: Names this load's appends to control tables, so that none is made twice.
        self.token = "-".join(quote(name, safe="") for name in names)

    def _file(self, step: str) -> str:
        return f"{self.folder}/{quote(step, safe='')}.json"

    def steps(self) -> dict[str, dict]:
        """All recorded steps with their results."""
        found = [entry.name for entry in folders.entries(self.spark, self.folder) if entry.name.endswith(".json")]
        return {unquote(name.removesuffix(".json")): folders.get_json(self.spark, f"{self.folder}/{name}") for name in found}

    def known(self, step: str) -> dict | None:
        file = self._file(step)
        return folders.get_json(self.spark, file) if folders.exists(self.spark, file) else None

    def once(self, step: str, work: Callable[[], dict]) -> dict:
        """The result of a step, which is done now unless it has been."""
        facts = self.known(step)
        if facts is None:
            facts = work()
            self.progress(step, "did")
            folders.put_json(self.spark, self._file(step), facts)
            self.progress(step, "noted")
        return facts


def table(spark: SparkSession, root: str) -> DataFrame:
    """All journals as rows: load, step, and the result as JSON."""
    base = f"{root.rstrip('/')}/{TABLE}"
    if not folders.exists(spark, base):
        return relation(spark, [], DDL)
    lines = spark.read.option("recursiveFileLookup", True).option("wholetext", True).text(paths.literal_path(base))
    parts = F.split(F.url_decode(F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B")), "/")
    part = lambda at: F.url_decode(F.element_at(parts, -at))
    return lines.select(
        part(4).alias("process_id"),
        part(3).alias("country_code"),
        part(2).alias("load_id"),
        F.regexp_replace(part(1), r"\.json$", "").alias("step"),
        F.col("value").alias("facts"),
    )

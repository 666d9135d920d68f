"""Which files a load takes, and where each of them goes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.constants import LOAD_ID_FORMAT
from quayside.functions import paths
from quayside.functions.times import bound
from quayside.params import ChangeWindow


def in_window(df: DataFrame, column: str, window: ChangeWindow) -> Column:
    """``last < column <= current``."""
    value = F.col(column)
    return (value > bound(df, column, window.last)) & (value <= bound(df, column, window.current))


def changed(df: DataFrame, column: str, window: ChangeWindow) -> DataFrame:
    """Rows changed in the half-open window."""
    return df.where(in_window(df, column, window))


def changed_or_forced(df: DataFrame, column: str, window: ChangeWindow,
                      forced: Column) -> DataFrame:
    """Rows in the window or forced, each once, in one pass."""
    return df.where(in_window(df, column, window) | forced)


def in_forced_folder(files: DataFrame, suffixes: DataFrame, path: str = "path",
                     segments: int = 2) -> DataFrame:
    """Files whose parent folder ends with one of the suffixes (column ``suffix``).

    Suffixes are ``segments`` whole path segments, so the match is a hash semi
    join on the last segments of the parent. A leading ``/`` asks for a folder
    above them.
    """
    key = F.col(path)
    with_name = F.substring_index(key, "/", -segments - 1)
    tail = F.substring_index(with_name, "/", segments)
    wanted = suffixes.select(
        F.ltrim(F.col("suffix"), F.lit("/")).alias("_suffix"),
        F.startswith("suffix", F.lit("/")).alias("_below"),
    )
    match = (tail == F.col("_suffix")) & (~F.col("_below") | (with_name != key))
    # A key with too few segments is its own tail, file name included.
    return files.where(tail != with_name).join(wanted, match, "left_semi")


def summary(df: DataFrame, column: str, window: ChangeWindow) -> DataFrame:
    """Number of rows, and of rows changed in the window, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(in_window(df, column, window)).alias("in_window"),
    )


def last_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              values: Sequence[str] = ()) -> DataFrame:
    """Of the rows of each key, the last in order.

    Reduced inside each task before the shuffle, so a key that many rows share
    is no hot spot.
    """
    picked = F.max(F.struct(*order, *values)).alias("_last")
    return df.groupBy(*keys).agg(picked).select(*keys, "_last.*")


def pull_folders(entities: DataFrame, source: str, country: str) -> DataFrame:
    """Folder names that hold the pulls of the given entities (column ``entity``)."""
    name = paths.pull_folder_name(F.lit(source), F.lit(country), F.col("entity"))
    return entities.select(name.alias("pull_folder")).distinct()


def near(files: DataFrame, window: ChangeWindow, load_id: str) -> Column:
    """Files that may be candidates, by name and time alone."""
    return in_window(files, "modified", window) | F.contains("path", F.lit(f"/{load_id}/"))


def candidates(files: DataFrame, window: ChangeWindow, folders: DataFrame, load_id: str,
               relands: bool = False) -> DataFrame:
    """Data files in the window or in a folder this load pulled into.

    Adds ``in_window``, ``forced`` and ``taken``. Files an earlier load pulled
    carry times after that load's own id and so fall into this window; that
    load has landed them, hence they are candidates but not taken, unless
    ``relands`` is set.
    """
    pull_folder = paths.segment(F.col("path"), -3)
    pulled_by = paths.segment(F.col("path"), -2)
    is_load_id = F.try_to_timestamp(pulled_by, F.lit(LOAD_ID_FORMAT)).isNotNull()
    known = folders.select("pull_folder", F.lit(True).alias("_pulled"))
    # A test of file names and times alone: Spark drops the other files while
    # planning the listing, before any task looks at them.
    marked = (
        files.where(near(files, window, load_id) & paths.is_data_file(F.col("path")))
        .withColumns({"pull_folder": pull_folder, "_pulled_by": pulled_by})
        .join(known, "pull_folder", "left")
        .withColumns(
            {
                "in_window": in_window(files, "modified", window),
                "forced": F.col("_pulled").isNotNull() & (F.col("_pulled_by") == load_id),
                "_earlier": F.col("_pulled").isNotNull()
                & is_load_id
                & (F.col("_pulled_by") < load_id),
            }
        )
    )
    marked = changed_or_forced(marked, "modified", window, F.col("forced"))
    taken = F.lit(True) if relands else ~F.col("_earlier")
    return marked.withColumn("taken", taken).select(
        *files.columns, "in_window", "forced", "taken"
    )


def select_files(files: DataFrame, window: ChangeWindow, folders: DataFrame, load_id: str,
                 relands: bool = False) -> DataFrame:
    """Files a load takes."""
    found = candidates(files, window, folders, load_id, relands)
    return found.where("taken").select(*files.columns)


def with_target(files: DataFrame, rule: paths.EntityRule, template: str,
                source_system: str, cluster: str, load_id: str) -> DataFrame:
    """Files with their entity, in lower case, and their target path.

    Names of an entity that differ only in case are one entity with one folder.
    """
    path = F.col("path")
    entity = F.lower(rule.entity(path))
    target = paths.landing_path(
        template, source_system, cluster, load_id, entity, paths.file_name(path)
    )
    return files.withColumns({"entity": entity, "target_path": target})


def mappable(files: DataFrame, rule: paths.EntityRule) -> tuple[DataFrame, DataFrame]:
    """Files whose key fits the template, and the rejected others."""
    fits = paths.is_mappable(F.col("path"), rule)
    return files.where(fits), files.where(~fits)


def landing_plan(found: DataFrame) -> DataFrame:
    """Candidates with ``lands``: taken, and not overwritten by a later key of
    the same target path.

    The winners are joined back on the path, which is unique, so neither step
    brings the files of one target together.
    """
    winners = last_wins(found.where("taken"), ["target_path"], ["path"])
    winners = winners.select("path", F.lit(True).alias("_wins"))
    return (
        found.join(winners, "path", "left")
        .withColumn("lands", F.col("_wins").isNotNull())
        .drop("_wins")
    )

"""File listings and entity scans."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.constants import FORMATS, METADATA_TASKS
from quayside.functions import paths, schemas
from quayside.sources import folders, tree
from quayside.sources.relations import relation

LISTING_DDL = "path string, uri string, modified timestamp, size bigint"
CHILDREN_DDL = "entity string, child string, is_folder boolean, bytes bigint"


def listing(spark: SparkSession, root: str, *prefixes: str) -> DataFrame:
    """Files below ``root`` whose key starts with one of the prefixes, all
    without any.

    No file content is read. Keys are relative to ``root``; ``uri`` is the
    name the readers report. Only the folder parts of the prefixes are listed. A
    folder that does not exist has no files, if it is the only one.
    """
    root = root.rstrip("/")
    below = {prefix.rpartition("/")[0] for prefix in prefixes or ("",)}
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load([paths.literal_path(f"{root}/{folder}" if folder else root) for folder in sorted(below)])
            .coalesce(METADATA_TASKS)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return relation(spark, [], LISTING_DDL)
    keyed = files.select(
        paths.key_under(folders.key_root(spark, root), F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("_metadata.file_size").alias("size"),
    )
    return with_prefix(keyed, *prefixes)


def listing_by_tasks(spark: SparkSession, root: str, *prefixes: str, enough: int = tree.FOLDERS) -> DataFrame:
    """As ``listing``, by tasks that walk the folders, so that the driver holds folders only.

    ``uri`` is null. A store that tasks cannot reach is listed by the driver.
    """
    if not tree.reachable(spark, root):
        return listing(spark, root, *prefixes)
    below = sorted({prefix.rpartition("/")[0] for prefix in prefixes or ("",)})
    # A folder within another would be walked twice.
    outer = [f for f in below if not any(f != o and (not o or f.startswith(f"{o}/")) for o in below)]
    return with_prefix(tree.listed(spark, root, outer, enough), *prefixes)


def inventory(files: DataFrame) -> DataFrame:
    """An inventory table ``(path, modified)`` in the form of a listing.

    For sources with so many files that an inventory of the store is cheaper
    than listing them. Names the readers hide are left out, as in a listing, and
    of a key with several versions the latest counts.
    """
    hidden = F.rlike("path", F.lit(r"(^|/)(\.[^/]*|_[^/=]*)(/|$)"))
    latest = files.where(~hidden).groupBy("path").agg(F.max("modified").alias("modified"))
    return latest.select(
        "path",
        F.lit(None).cast("string").alias("uri"),
        "modified",
        F.lit(None).cast("bigint").alias("size"),
    )


def with_prefix(files: DataFrame, *prefixes: str) -> DataFrame:
    """Files whose key starts with one of the prefixes; all if one is empty."""
    if not all(prefixes):
        return files
    tests = [F.startswith("path", F.lit(prefix)) for prefix in prefixes]
    return files.where(reduce(or_, tests)) if tests else files


def children(files: DataFrame) -> DataFrame:
    """First path segments of a listing: ``(entity, child, is_folder, bytes)``.

    The entity is the lower-cased name, without the ending of a lone file.
    """
    child = F.split_part("path", F.lit("/"), F.lit(1))
    below = files.groupBy(child.alias("child")).agg(
        F.bool_or(F.contains("path", F.lit("/"))).alias("is_folder"),
        F.sum("size").alias("bytes"),
    )
    name = F.lower(F.regexp_replace("child", r"\.parquet$", ""))
    return below.select(name.alias("entity"), "child", "is_folder", "bytes")


def collected_children(spark: SparkSession, root: str) -> DataFrame:
    """Children of a root as a local relation: one row per landed entity."""
    found = children(listing(spark, root))
    return relation(spark, [row.asDict() for row in found.collect()], CHILDREN_DDL)


def entities(children: DataFrame) -> DataFrame:
    """Folders among the children as ``(entity, folder)``.

    Of folders that differ only in case none can be chosen; they fail the query.
    """
    one = F.min("child")
    clash = F.raise_error(F.concat(one, F.lit(" and "), F.max("child"), F.lit(" are one entity")))
    folder = F.when(F.count(F.lit(1)) == 1, one).otherwise(clash)
    return children.where("is_folder").groupBy("entity").agg(folder.alias("folder"))


def check_format(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt!r} is not one of {', '.join(FORMATS)}")
    return fmt


def entity(spark: SparkSession, path: str, fmt: str = "parquet",
           merge_schema: bool = False) -> DataFrame:
    """Scan of one entity folder."""
    reader = spark.read.format(check_format(fmt)).option("mergeSchema", merge_schema)
    return reader.load(paths.literal_path(path))


def entity_files(spark: SparkSession, files: Sequence[str], schema: T.StructType) -> DataFrame:
    """Scan of some files of one entity. A column a file lacks is null, one of a
    narrower type is widened by the reader."""
    reader = spark.read.schema(schema).option("recursiveFileLookup", True)
    return reader.parquet(*map(paths.literal_path, files))


def merged_schema(spark: SparkSession, entity: str, chunks: Iterable[Sequence[str]]) -> T.StructType:
    """All columns any of the files has, each in the narrowest type that holds
    its values in all of them.

    The reader merges footers, but not those that differ in a type. Where it
    fails, the files are halved; in order of time, as they should be given, types
    change seldom and few halves are left.
    """
    found: T.StructType | None = None
    seen: list[tuple[T.StructType, str]] = []
    for chunk in chunks:
        for schema, names in schema_runs(spark, chunk):
            try:
                found = schema if found is None else schemas.widened(found, schema)
            except schemas.NotWidened as error:
                other = next(name for known, name in seen if not schemas.fit(known, schema))
                raise ValueError(f"entity {entity}: {error} in {other} and {names[0]}") from None
            seen.append((schema, names[0]))
    assert found is not None, "an entity that lands has files"
    return found


def schema_runs(spark: SparkSession, files: Sequence[str]) -> list[tuple[T.StructType, Sequence[str]]]:
    """Files in runs whose footers the reader can merge, each with its merged schema."""
    reader = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True)
    try:
        return [(reader.parquet(*map(paths.literal_path, files)).schema, files)]
    except (Py4JJavaError, PySparkException) as error:
        if len(files) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    half = len(files) // 2
    return [*schema_runs(spark, files[:half]), *schema_runs(spark, files[half:])]


def text_schema(found: Iterable[T.StructType]) -> T.StructType:
    """All columns of some schemas as text, in the order they are first met; names that
    differ in case only are one column, as the reader has it."""
    names: dict[str, str] = {}
    for schema in found:
        for name in schema.names:
            names.setdefault(name.lower(), name)
    return T.StructType([T.StructField(name, T.StringType(), True) for name in names.values()])

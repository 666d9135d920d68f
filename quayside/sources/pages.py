"""Landed response pages as rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.constants import FAILED_RESPONSES
from quayside.functions import paths
from quayside.sources.relations import written


def page_schema(columns: Sequence[str]) -> T.StructType:
    """Schema of a response page whose records hold the declared columns.

    Records are read by name: a missing key is null, an undeclared one is
    dropped, and a value that is not text is kept as its JSON text.
    """
    record = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    details = T.StructType([T.StructField("next_page", T.StringType())])
    return T.StructType(
        [
            T.StructField("responseStatus", T.StringType()),
            T.StructField("responseDetails", details),
            T.StructField("errors", T.StringType()),
            T.StructField("data", T.ArrayType(record)),
        ]
    )


def read(spark: SparkSession, folder: str, columns: Sequence[str],
         one_per_line: bool = False) -> DataFrame:
    """Response pages below ``folder``, with the name of the file of each.

    A file holds one page, or one page per line; the second form can be split
    between tasks.
    """
    return (
        spark.read.schema(page_schema(columns))
        .option("multiLine", not one_per_line)
        .option("mode", "FAILFAST")
        .option("recursiveFileLookup", True)
        .json(paths.literal_path(folder))
        .select("*", F.col("_metadata.file_path").alias("page"))
    )


def is_failed() -> Column:
    return F.col("responseStatus").isin(*FAILED_RESPONSES)


def summary(pages: DataFrame) -> DataFrame:
    """Failed pages, the errors of the first of them, and rows, in one pass."""
    errors = F.when(is_failed(), F.coalesce("errors", F.lit("")))
    return pages.agg(
        F.count_if(is_failed()).alias("failed_pages"),
        F.min_by(errors, F.when(is_failed(), F.col("page"))).alias("errors"),
        F.coalesce(F.sum(F.coalesce(F.size("data"), F.lit(0))), F.lit(0)).alias("row_count"),
    )


def checked(pages: DataFrame) -> DataFrame:
    """The pages; one that reports a failure fails the query that reads it.

    A pull of pages so reads and parses them once.
    """
    message = F.concat(F.lit("response page "), "page", F.lit(" failed: "), F.coalesce("errors", F.lit("")))
    data = F.when(is_failed(), F.raise_error(message)).otherwise(F.col("data"))
    return pages.withColumn("data", data)


def to_rows(pages: DataFrame, with_order: bool = False) -> DataFrame:
    """All records of all pages. ``with_order`` adds the page and the position in
    it, which give the order of the response; nothing is sorted here."""
    if with_order:
        numbered = pages.select("page", F.posexplode("data").alias("position", "record"))
        return numbered.select("page", "position", "record.*")
    return pages.select(F.inline("data"))


def file_stem(path: Column) -> Column:
    """Last part of a path without its ending: the usual name of a page."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")


def ordered(pages: DataFrame, name: Column | None = None, follows: Column | None = None,
            response: Column | None = None) -> DataFrame:
    """Pages with ``place``, counted from 0 along the links of their response.

    ``name`` is what links call a page, by default its file's name without ending;
    ``follows`` is the name of the page after it, null at the end, by default the last
    part of ``next_page``; ``response`` tells responses apart. Every page has to be
    reached from the first of its response: a link to a page that is not there, two
    pages of a name, two first pages and a ring fail, with an example.

    Links are doubled: after n rounds a page knows the page 2**n after it, so a
    response of a million pages takes twenty joins, none of which gathers it.
    """
    target = F.col("responseDetails.next_page") if follows is None else follows
    links = written(
        pages.select(
            (F.lit("") if response is None else response.cast("string")).alias("response"),
            (file_stem(F.col("page")) if name is None else name).cast("string").alias("name"),
            (F.nullif(F.regexp_extract(target, "([^/=]+)/?$", 1), F.lit("")) if follows is None else target).cast("string").alias("to"),
        ),
        "page-links",
    )
    key = ["response", "name"]
    twice = links.groupBy(*key).count().where("count > 1")
    _none(twice, "two pages are named {0.name} in response {0.response!r}")
    there = links.select("response", F.col("name").alias("to"))
    _none(links.where("to is not null").join(there, ["response", "to"], "left_anti"), "page {0.to} after {0.name} of response {0.response!r} is missing")
    pointed = links.where("to is not null").groupBy("response", F.col("to").alias("name")).count()
    _none(pointed.where("count > 1"), "several pages lead to page {0.name} of response {0.response!r}")
    # Where no page has two before it, one page without any is one chain, beside rings at most.
    firsts = links.select(*key).join(pointed, key, "left_anti").groupBy("response").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("name"))
    _none(firsts.where("n > 1"), "response {0.response!r} has {0.n} first pages, one is {0.name}")
    sizes = links.groupBy("response").agg(F.count(F.lit(1)).alias("pages"))
    now = links.select(*key, "to", F.when(F.col("to").isNull(), 0).otherwise(1).cast("bigint").alias("steps"))
    for _ in range((sizes.agg(F.max("pages")).first()[0] or 0).bit_length()):
        ahead = now.select("response", F.col("name").alias("to"), F.col("to").alias("_to"), F.col("steps").alias("_steps"))
        further = now.where("to is not null").join(ahead, ["response", "to"]).select(*key, F.col("_to").alias("to"), (F.col("steps") + F.col("_steps")).alias("steps"))
        now = written(now.where("to is null").unionByName(further), "page-links")
    _none(now.where("to is not null"), "page {0.name} of response {0.response!r} leads back to itself")
    place = (F.col("pages") - 1 - F.col("steps")).alias("place")
    places = now.join(sizes, "response").select(F.col("response").alias("_of"), F.col("name").alias("_called"), place)
    named = pages.withColumns({"_response": F.lit("") if response is None else response.cast("string"), "_name": (file_stem(F.col("page")) if name is None else name).cast("string")})
    same = (F.col("_response") == F.col("_of")) & (F.col("_name") == F.col("_called"))
    return named.join(places, same).select(*pages.columns, "place")


def _none(rows: DataFrame, message: str) -> None:
    found = rows.first()
    if found is not None:
        raise ValueError(message.format(found))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Bag union of page data by column name."""
    return reduce(DataFrame.unionByName, parts)

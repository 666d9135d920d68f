"""Acceptance queries: each operator over the supplied tables.

``queries()`` pairs with the SQL in ``quayside.plans.oracle``; both name their
columns alike.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from quayside.concurrency import run_all
from quayside.constants import PATHS_PER_READ
from quayside.functions import paths, times, values
from quayside.operators import metadata, profile, runs, selection
from quayside.params import ChangeWindow, LoadParams
from quayside.plans import batch, reports
from quayside.sources import catalog, commits, control, files, landing, pages, pull
from quayside.sources.relations import relation, shared_folder, written

WINDOW = ChangeWindow(datetime(2024, 1, 8), datetime(2024, 1, 15, 12))
ALWAYS = ChangeWindow(datetime(1970, 1, 1), datetime(2100, 1, 1))
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
DECLARED = ("click", "View", "error", "missing")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page urls without query and fragment, as object keys."""
    key = F.regexp_replace("url", "[?#].*$", "")
    return table(spark, sf_dir, "pages").select("page_id", key.alias("path"))


def _declared(spark: SparkSession) -> DataFrame:
    return relation(spark, [{"entity": name} for name in DECLARED], "entity string")


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def entity_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.row_counts(spark, sf_dir, lone_files=True)


def entity_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.schemas(spark, {name: f"{sf_dir}/{name}.parquet" for name in TABLES})
    return profile.columns(spark, found).join(
        profile.row_counts(spark, sf_dir, lone_files=True), "entity"
    )


def incremental_half_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return selection.changed(events, "ts", WINDOW).select("event_id", "ts", "event_type")


def pull_between_inclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pull.incremental(
        table(spark, sf_dir, "orders"),
        ["o_orderkey", "o_custkey", "o_orderdate"],
        "o_orderdate",
        datetime(1997, 1, 1),
        datetime(1997, 1, 31),
    )


def window_or_forced_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    forced = F.col("event_type").isin("signup", "error")
    taken = selection.changed_or_forced(events, "ts", WINDOW, forced)
    return taken.select("event_id", "event_type")


def suffix_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").where(F.col("lang").isin("fr", "de"))
    suffixes = documents.select(F.concat(F.lit("/"), "lang").alias("suffix")).distinct()
    matched = selection.in_forced_folder(_keys(spark, sf_dir), suffixes, segments=1)
    return matched.select("page_id", paths.parent(F.col("path")).alias("parent"))


def entity_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("path")
    rule = paths.EntityRule.of("<scheme>//<host>/<entity>/<file>")
    return _keys(spark, sf_dir).select(
        "page_id",
        paths.segment(path, 3).alias("host"),
        F.coalesce(F.lower(rule.entity(path)), F.lit("")).alias("entity"),
        paths.file_name(path).alias("file_name"),
    )


def rejected_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = paths.EntityRule.of("<scheme>//<host>/<section>/<name>/<entity>")
    _, rejected = selection.mappable(_keys(spark, sf_dir), rule)
    return rejected.select("page_id", "path")


def expand_landing_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = paths.expand(
        "<source-system>/<cluster>/<loadid>/<entity>/part.parquet",
        {
            "<source-system>": F.col("source"),
            "<cluster>": F.col("lang"),
            "<loadid>": F.lit("20240115120000"),
            "<entity>": F.col("doc_id").cast("string"),
        },
    )
    return table(spark, sf_dir, "documents").select("doc_id", target.alias("target_path"))


def last_wins_per_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id")
    return selection.last_wins(events, ["user_id", "event_type"], ["ts", "event_id"])


def active_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    keys = {"quality": 1, "lang": "en"}
    return control.lookup(described, keys, ["doc_id", "source", "lang"])


def active_entities_of_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    described = customers.select(
        F.col("c_mktsegment").alias("source_system"),
        F.col("c_nationkey").cast("string").alias("country_code"),
        F.col("c_name").alias("entity"),
        F.when(F.col("c_acctbal") > 0, "1").otherwise("0").alias("entity_status"),
        F.col("c_custkey").cast("string").alias("data_product"),
        F.lower("c_mktsegment").alias("subject_area"),
    )
    return metadata.active_entities(described, "BUILDING", "7")


def query_entity_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    key = paths.metadata_key(F.lit("de"), F.col("c_name"))
    described = customers.select(
        F.col("c_mktsegment").alias("source_system"),
        key.alias("source_metadata_id"),
        F.array(F.lit("ts"), F.lit("other")).alias("timestamp_fields"),
        F.array(F.struct(F.col("c_name").alias("name"))).alias("column_metadata"),
        _ntz("2024-01-08 00:00:00").alias("last_run_ts"),
    )
    entities = customers.select(F.upper("c_name").alias("entity"))
    config = metadata.entity_config(entities, described, "BUILDING", "de")
    return config.select(
        "entity", "source_metadata_id", F.get("columns", F.lit(0)).alias("first_column"),
        "ts_column", "last_run_ts",
    )


def per_entity_watermark_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    last = _ntz("2024-01-02 00:00:00") + F.make_dt_interval(F.length("entity"))
    entities = events.select(F.col("event_type").alias("entity")).distinct()
    marks = entities.withColumn("last_ts", last)
    feed = events.select("event_id", "event_type", "ts")
    return pull.incremental_many(feed, marks, "event_type", "ts", WINDOW.current)


def declared_vs_landed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = (
        table(spark, sf_dir, "events")
        .groupBy(F.lower("event_type").alias("entity"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return runs.entity_report(_declared(spark), counts, match_case=True)


def rerun_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    matches = control.lookup(
        events, {"event_type": "purchase", "user_id": 8}, ["ts"]
    ).where(F.col("ts") <= times.bound(events, "ts", WINDOW.current))
    return runs.any_match(matches, "is_rerun")


def _document_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    loads = table(spark, sf_dir, "documents").select("doc_id", "source")
    status = F.when(F.col("quality") == 1, "success").otherwise("Failed")
    log = table(spark, sf_dir, "labels").select("doc_id", status.alias("job_run_status"))
    return loads, log


def not_yet_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.pending(*_document_log(spark, sf_dir), keys=["doc_id"])


def already_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.done(*_document_log(spark, sf_dir), keys=["doc_id"])


def window_file_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.summary(table(spark, sf_dir, "events"), "ts", WINDOW)


def watermark_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")

    def marks(until: str, without: str) -> DataFrame:
        seen = events.where((F.col("ts") <= _ntz(until)) & (F.col("event_type") != without))
        return seen.groupBy(F.col("event_type").alias("k")).agg(F.max("ts").alias("v"))

    old = marks("2024-01-03 00:00:00", "signup")
    return control.upsert(old, marks("2024-01-15 12:00:00", "error"), ["k"])


def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("process_id"),
        F.when(F.col("o_orderstatus") == "F", "success").otherwise("Failed").alias(
            "job_run_status"
        ),
        F.col("o_orderdate").alias("logged_at"),
        F.col("o_orderkey").alias("load_id"),
    )
    return control.latest(log, ["process_id"], ["logged_at", "load_id"])


def job_id_last_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("process_id"),
        F.col("o_orderstatus").alias("job_name"),
        F.col("o_orderkey").alias("job_id"),
    )
    found = metadata.job_ids(jobs, order="job_id")
    return found.withColumnsRenamed({"process_id": "o_custkey", "job_name": "o_orderstatus"})


def first_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return control.first(orders, [F.desc("o_orderdate"), "o_orderkey"])


def all_string_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    return values.all_string(table(spark, sf_dir, "orders"), declared)


def page_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return pages.union_all([turns.where("turn = 0"), turns.where("turn > 0")])


def response_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed response page per conversation turn, read back as rows."""
    found = _turns_as_pages(spark, sf_dir, F.lit("SUCCESS"))
    return pages.to_rows(pages.checked(found))


def failed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages, those of all roles but one reporting a failure."""
    status = (
        F.when(F.col("role") == "user", "SUCCESS")
        .when(F.col("turn") == 1, "FAILURE")
        .otherwise("EXCEPTION")
    )
    found = _turns_as_pages(spark, sf_dir, status)
    return pages.summary(found).select("failed_pages", "row_count")


def ordered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn as a page of its conversation's response that names the page after it: the
    place of each along those links."""
    turns = table(spark, sf_dir, "conversations")
    ahead = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.lit(True).alias("more"))
    page = F.struct(
        F.lit("SUCCESS").alias("responseStatus"),
        F.struct(F.when(F.col("more"), F.concat(F.lit("/api/turns?page="), (F.col("turn") + 1).cast("string"))).alias("next_page")).alias("responseDetails"),
        F.array(F.struct("text", "role", "turn", "conv_id")).alias("data"),
    )
    folder = shared_folder(spark, "response-pages")
    turns.join(ahead, ["conv_id", "turn"], "left").select(F.to_json(page).alias("value")).write.text(folder)
    found = pages.read(spark, folder, ["conv_id", "turn", "role"], one_per_line=True)
    record = F.get("data", F.lit(0))
    placed = pages.ordered(pages.checked(found), name=record["turn"], follows=F.nullif(F.regexp_extract("responseDetails.next_page", "page=(.*)$", 1), F.lit("")), response=record["conv_id"])
    return placed.select("place", F.inline("data"))


def switched_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views over three generations of tables, of which the second cannot be built: rows
    before and after the failure, and of the generation shown at last."""
    database = f"landing_{uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_folder(spark, 'database')}'")
    names = ("region", "nation", "orders", "customer")
    locations = {name: f"{sf_dir}/{name}.parquet" for name in names}
    kinds = profile.schemas(spark, locations)
    swapped = dict(zip(names, (*names[1:], names[0])))

    def generation(places: dict[str, str]) -> list[catalog.EntityTable]:
        return [catalog.EntityTable(name, locations[at], kinds[at]) for name, at in places.items()]

    def shown() -> dict[str, int]:
        found = catalog.views(spark, database)
        return dict(zip(found, run_all(spark, lambda name: spark.table(f"{database}.{name}").count(), found)))

    same = {name: name for name in names}
    catalog.switch(spark, database, [*generation(same), catalog.EntityTable("gone", locations["region"], kinds["region"])], "g1")
    before = shown()
    broken = generation(swapped)
    try:
        catalog.switch(spark, database, [*broken[:2], catalog.EntityTable("bad", "nostore://x", kinds["region"]), *broken[2:]], "g2")
    except Exception:
        after = shown()
    catalog.switch(spark, database, generation(swapped), "g3")
    rows = [{"name": name, "first": before.get(name), "after_failure": after.get(name), "last": shown().get(name)} for name in sorted({*before, *after})]
    return relation(spark, rows, "name string, first bigint, after_failure bigint, last bigint")


def sliced_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items pulled from a watermark for each part, a third of them being of one entity:
    by a join of time slices, and for the lines of few suppliers by one filter."""
    lines = table(spark, sf_dir, "lineitem")
    hot = F.pmod("l_orderkey", F.lit(3)) == 0
    feed = lines.select("l_orderkey", "l_linenumber", "l_shipdate", F.when(hot, F.lit("hot")).otherwise(F.concat(F.lit("p"), "l_partkey")).alias("entity"))
    since = _ntz("1995-01-01 00:00:00") + F.make_dt_interval(F.length("entity") * 100)
    marks = feed.select("entity").distinct().withColumn("last_ts", since)
    current = datetime(1997, 6, 30)
    joined = pull.incremental_sliced(feed, marks, "entity", "l_shipdate", current, filtered=0)
    few = pull.incremental_sliced(feed, marks.where("entity in ('hot', 'p1', 'p22')"), "entity", "l_shipdate", current)
    return joined.withColumn("way", F.lit("joined")).unionByName(few.withColumn("way", F.lit("filtered")))


def pull_without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders pulled in three windows that meet on days with orders: no row comes twice, and
    rows that reach a bound after it was pulled come once."""
    orders = table(spark, sf_dir, "orders")
    bounds = [datetime(1993, 1, 1), datetime(1994, 6, 15), datetime(1996, 2, 29), datetime(1998, 1, 1)]
    known = pull.Boundaries(spark, shared_folder(spark, "boundaries"))
    late = F.pmod("o_orderkey", F.lit(7)) == 0
    found = []
    for number, (last, current) in enumerate(zip(bounds, bounds[1:])):
        # Every seventh order of the bound is not there yet when that bound is pulled.
        there = orders.where(~(late & (F.col("o_orderdate") == times.bound(orders, "o_orderdate", current))))
        rows = known.pulled(there, "de_orders", ["o_orderkey", "o_custkey", "o_orderdate"], "o_orderdate", last, current)
        found.append(written(rows.withColumn("pull", F.lit(number)), "pulled"))
    return pages.union_all(found)


def _turns_as_pages(spark: SparkSession, sf_dir: str, status: Column) -> DataFrame:
    record = F.struct("text", "role", "turn", "conv_id")
    page = F.struct(
        status.alias("responseStatus"),
        F.struct(F.lit("/next").alias("next_page")).alias("responseDetails"),
        F.array(record).alias("data"),
    )
    folder = shared_folder(spark, "response-pages")
    turns = table(spark, sf_dir, "conversations")
    turns.select(F.to_json(page).alias("value")).write.text(folder)
    columns = ["conv_id", "turn", "role", "text"]
    return pages.read(spark, folder, columns, one_per_line=True)


def props_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = values.json_field(F.col("props"), "k")
    return table(spark, sf_dir, "events").select("event_id", k.alias("k"))


def load_id_to_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    load_id = F.date_format("o_orderdate", "yyyyMMddHHmmss").alias("load_id")
    ids = table(spark, sf_dir, "orders").select("o_orderkey", load_id)
    return ids.select(
        "o_orderkey",
        "load_id",
        times.file_watermark_text(F.col("load_id")).alias("file_watermark"),
        times.entity_watermark_text(F.col("load_id")).alias("entity_watermark"),
    )


def not_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keys(spark, sf_dir).where(paths.is_data_file(F.col("path"))).select("page_id")


def run_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = runs.details(profile.row_counts(spark, sf_dir, lone_files=True), "20240115120000")
    return rows.select("entity", "row_count", "error_count", "status")


def landing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = table(spark, sf_dir, "events")
    return reports.landing_report(feed, _declared(spark), "event_type", "ts", WINDOW)


LOAD_ID = "20240115120000"
SOURCE_TEMPLATE = "<source-system>/<cluster>/<source-system>_<cluster>_<entity>/<folder>/<file>"
LANDING_TEMPLATE = "<source-system>/<cluster>/<loadid>/<entity>/<file>"


def _document_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing with a key per document: language as entity, length as file name
    and source as folder, two of the sources being ids of loads."""
    folder = (
        F.when(F.col("source") == "src1", F.lit(LOAD_ID))
        .when(F.col("source") == "src2", F.lit("20240108000000"))
        .otherwise(F.col("source"))
    )
    path = F.concat(
        F.lit("src/de/src_de_"), "lang", F.lit("/"), folder, F.lit("/"),
        F.col("n_chars").cast("string"), F.lit(".parquet"),
    )
    since = F.make_dt_interval(hours=F.col("n_chars").cast("int"))
    modified = _ntz("2023-12-20 00:00:00") + since
    listed = table(spark, sf_dir, "documents").select(
        path.alias("path"), modified.alias("modified")
    )
    # Keys are unique in a listing.
    return listed.groupBy("path").agg(F.max("modified").alias("modified"))


def _document_folders(spark: SparkSession) -> DataFrame:
    pulled = relation(spark, [{"entity": "EN"}, {"entity": "fr"}], "entity string")
    return selection.pull_folders(pulled, "src", "de")


def select_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.select_files(
        _document_listing(spark, sf_dir), WINDOW, _document_folders(spark), LOAD_ID
    )


def landing_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = selection.candidates(
        _document_listing(spark, sf_dir), WINDOW, _document_folders(spark), LOAD_ID
    )
    rule = paths.EntityRule.of(SOURCE_TEMPLATE)
    targeted = selection.with_target(found, rule, LANDING_TEMPLATE, "src", "de", LOAD_ID)
    plan = selection.landing_plan(targeted)
    return plan.select(
        "path", "entity", "target_path", "in_window", "forced", "taken", "lands"
    )


def _write_feed(spark: SparkSession, rows: DataFrame, entity: Column, root: str) -> None:
    """Write rows as a source of many entities, one folder per entity."""
    folder = F.concat(F.lit("src_de_"), entity)
    rows.withColumn("feed", folder).write.partitionBy("feed").parquet(f"{root}/src/de")


FEED_TEMPLATE = "<source-system>/<cluster>/feed=<source-system>_<cluster>_<entity>/<file>"


def landed_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a source of five entities, listed, selected and landed."""
    _, done = _landed_events(spark, sf_dir)
    landed = [
        files.entity(spark, folder).withColumn("entity", F.lit(entity))
        for entity, (folder, _) in done.items()
    ]
    return pages.union_all(landed).select(
        "entity", "event_id", "ts", "user_id", "event_type", "value", "props"
    )


def written_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pull written as text columns, over which an empty one is written."""
    orders = table(spark, sf_dir, "orders")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"]
    folder = shared_folder(spark, "pull")
    for last, current in (
        (datetime(1990, 1, 1), datetime(2000, 1, 1)),
        (datetime(2090, 1, 1), datetime(2091, 1, 1)),
    ):
        rows = pull.incremental(orders, columns, "o_orderdate", last, current)
        landing.write_pull(values.all_string(rows, columns), folder)
    return files.entity(spark, folder)


def published_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables published to a database, counted through the catalog."""
    database = f"landing_{uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_folder(spark, 'database')}'")
    locations = {name: f"{sf_dir}/{name}.parquet" for name in TABLES}
    schemas = profile.schemas(spark, locations)
    stale = catalog.EntityTable("stale", locations["region"], schemas["region"])
    catalog.publish(spark, database, [stale])
    catalog.publish(
        spark,
        database,
        [catalog.EntityTable(name, locations[name], schemas[name]) for name in TABLES],
    )
    counts = [
        spark.table(f"{database}.{name}").agg(
            F.lit(name).alias("entity"), F.count(F.lit(1)).alias("row_count")
        )
        for name in catalog.tables(spark, database)
    ]
    return reduce(DataFrame.unionByName, counts)


BATCH = LoadParams(source="src", country="de", region="eu", load_id="20991231235959")
PULLED = {
    "orders": ("o_orderdate", ["o_orderkey", "o_orderdate"]),
    "lineitem": ("l_shipdate", ["l_orderkey", "l_linenumber", "l_shipdate"]),
    "events": ("ts", ["event_id", "ts", "event_type"]),
}


def _site(spark: SparkSession, source: str, entities: list[tuple[str, str | None, list[str], str]],
          last: datetime) -> control.ControlStore:
    """Control tables of a source ``src`` whose entities are ``(name, time column, columns, kind)``."""
    store = control.ControlStore(spark, shared_folder(spark, "control"))
    metadata_rows = [
        {
            "source_metadata_id": f"de_{name}",
            "source_system": "src",
            "country_code": "de",
            "entity": name.title(),
            "entity_status": "1",
            "subject_area": kind,
            "data_product": f"product {name}",
            "table_type": kind,
            "timestamp_fields": [ts] if ts else [],
            "column_metadata": [{"name": column} for column in columns],
            "last_run_ts": times.utc(last),
        }
        for name, ts, columns, kind in entities
    ]
    store.append_rows("source_metadata", metadata_rows)
    target = shared_folder(spark, "landing")
    database = f"landing_{uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_folder(spark, 'database')}'")
    process = {
        "source_system": "src",
        "tenant": "t",
        "source_prefix": "src/<country>/<loadid>/",
        "landing_bucket": target,
        "source_format": "parquet",
        "landing_database": database,
    }
    store.append_rows("process_config", [process])
    place = {
        "source_cluster": "src-de",
        "source_bucket": source,
        "source_template": SOURCE_TEMPLATE,
        "search_template": "<source-system>/<cluster>/",
        "landing_root": target,
        "landing_template": LANDING_TEMPLATE,
        "cluster": "de",
        "source_system": "src",
        "last_run_start_time": times.utc(datetime(1970, 1, 1)),
    }
    store.append_rows("path_config", [place])
    return store


def land_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole load: three tables pulled by watermark, documents by language as
    files, all landed, counted, published and reported."""
    source = shared_folder(spark, "source")
    lang = F.coalesce("lang", F.lit("none"))
    documents = table(spark, sf_dir, "documents").withColumn("_feed", lang)
    languages = sorted(row[0] for row in documents.select("_feed").distinct().collect())
    for name in languages:
        rows = documents.where(F.col("_feed") == name).drop("_feed")
        rows.write.parquet(f"{source}/src/de/src_de_doc_{name}/all")
    entities = [(name, *PULLED[name], "query") for name in PULLED]
    entities += [(f"doc_{name}", None, [], "file") for name in languages]
    store = _site(spark, source, entities, datetime(1990, 1, 1))
    tables = {name: table(spark, sf_dir, name) for name in PULLED}
    outcome = batch.land_batch(spark, BATCH, store, batch.from_tables(tables))
    return outcome.report


class _Stopped(Exception):
    """A load was ended on purpose."""


def resumed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load stopped before and after each step's record, and run again each time: the
    rows it publishes, the counts it logs and the watermarks it leaves. Its upper bound is
    the time of the last orders, so rows lie exactly on it."""
    orders = table(spark, sf_dir, "orders")
    last = orders.agg(F.date_format(F.max("o_orderdate"), "yyyyMMddHHmmss")).first()[0]
    columns = ["o_orderkey", "o_orderdate"]
    store = _site(spark, shared_folder(spark, "source"), [("orders", "o_orderdate", columns, "query")], datetime(1995, 1, 1))
    params = LoadParams(source="src", country="de", region="eu", load_id=last)
    source = batch.from_tables({"orders": orders})
    for stop in [(step, state) for step in ("opened", "pulled Orders", "landed", "published", "marked") for state in ("did", "noted")]:

        def progress(*at: str) -> None:
            if at == stop:
                raise _Stopped(*at)

        try:
            batch.land_batch(spark, params, store, source, progress=progress)
        except _Stopped:
            continue
        raise RuntimeError(f"the load did not come to {stop}")
    outcome = batch.land_batch(spark, params, store, source)
    details = store.read("run_details").where("entity = 'orders'").agg(F.count(F.lit(1)).alias("details"), F.sum("row_count").alias("detailed"))
    found = {
        "row_count": outcome.report.select("row_count").scalar(),
        "details": details.select("details").scalar(),
        "detailed": details.select("detailed").scalar(),
        "file_mark": store.path_config().select(F.col("last_run_start_time").cast("timestamp_ntz")).scalar(),
        "entity_mark": store.source_metadata().select(F.col("last_run_ts").cast("timestamp_ntz")).scalar(),
    }
    database = store.read("process_config").first().landing_database
    return spark.table(f"{database}.orders").select(*columns).withColumns(found)


def committed_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder over which two writes fail and one succeeds: how many rows readers found after
    the first write and after the failures, and the rows they find at the end."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    folder = shared_folder(spark, "committed")
    share = F.pmod("o_orderkey", F.lit(3))
    landing.write_pull(orders.where(share == 0), folder)
    seen = [commits.read(spark, folder).count()]

    def stopped(attempt: str) -> tuple:
        commits.counted(orders.where(share == 1), attempt)
        raise _Stopped(attempt)

    for _ in range(2):
        try:
            commits.write(spark, folder, stopped)
        except _Stopped:
            seen.append(commits.read(spark, folder).count())
    done = landing.write_pull(orders.where(share == 2), folder)
    counts = {"first": seen[0], "after_one": seen[1], "after_two": seen[2], "written": done.rows}
    return commits.read(spark, folder).withColumns({name: F.lit(n).cast("bigint") for name, n in counts.items()})


def compacted_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A status and a watermark for every user and type of events, written by several writers
    while the tables are compacted: the last status and mark of each user, and whether
    the tables were read through few files. Each user's statuses are one append, and so is
    every mark; the tasks of a job are the writers."""
    events = table(spark, sf_dir, "events")
    loads = events.groupBy("user_id", "event_type").agg(F.max("ts").cast("timestamp").alias("at"), F.count(F.lit(1)).alias("n"))
    loads = written(loads, "loads")
    store = control.ControlStore(spark, shared_folder(spark, "control"))
    user, null = F.col("user_id").cast("string"), F.lit(None).cast("string")

    def statuses(some: DataFrame) -> None:
        common = {"layer": F.lit("Landing"), "load_id": user, "process_id": F.lit("p"), "country_code": F.lit("de")}
        own = {"job_run_status": F.col("event_type"), "error_message": F.col("n").cast("string"), "logged_at": F.col("at"), "job_id": null}
        store.append_each("process_log", some.select(*[value.alias(name) for name, value in (common | own).items()]), ["load_id"])

    def marks(some: DataFrame) -> None:
        mark = {"source_metadata_id": user, "source_system": F.lit("src"), "last_run_ts": F.col("at"), "load_id": F.col("event_type"), "logged_at": F.col("at")}
        store.append_each("entity_watermark", some.select(*[value.alias(name) for name, value in mark.items()]), ["source_metadata_id", "load_id"])

    names = ("process_log", "entity_watermark")
    for part in range(3):
        some = loads.where(F.pmod(F.xxhash64("user_id"), F.lit(3)) == part)
        writers = [lambda write=write: write(some) for write in (statuses, marks)]
        compactions = [lambda name=name: store.compact(name) for name in names] if part else []
        run_all(spark, lambda action: action(), compactions + writers)
    store.maintain(tail=0)
    few = all(store.snapshot(name).size <= control.PARTS for name in names)
    status = runs.latest_status(store.read("process_log")).select(F.col("load_id").cast("bigint").alias("user_id"), "job_run_status", "error_message")
    logged = store.read("process_log").groupBy(F.col("load_id").cast("bigint").alias("logs_of")).agg(F.count(F.lit(1)).alias("logged"))
    keys = ["source_metadata_id", "source_system"]
    last = control.latest(store.read("entity_watermark"), keys, control.WATERMARK_ORDER).select(
        F.col("source_metadata_id").cast("bigint").alias("mark_of"), F.col("last_run_ts").cast("timestamp_ntz").alias("mark")
    )
    # A user that is null has a status and a mark like others.
    found = status.join(logged, F.equal_null("user_id", "logs_of")).join(last, F.equal_null("user_id", "mark_of"))
    return found.drop("logs_of", "mark_of").withColumn("few_files", F.lit(few))


def _landed_events(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, tuple[str, commits.Commit]]]:
    """Events landed by type: the root, and each entity's folder and commit."""
    source, target = shared_folder(spark, "source"), shared_folder(spark, "landing")
    _write_feed(spark, table(spark, sf_dir, "events"), F.col("event_type"), source)
    nothing_pulled = relation(spark, [], "pull_folder string")
    listed = files.listing(spark, source, "src/de/")
    found = selection.candidates(listed, ALWAYS, nothing_pulled, LOAD_ID)
    targeted = selection.with_target(found, paths.EntityRule.of(FEED_TEMPLATE), LANDING_TEMPLATE, "src", "de", LOAD_ID)
    plan = written(selection.landing_plan(targeted), "landing-plan", by=("entity",))
    targets = {item.entity: f"{target}/{item.entity}" for item in landing.entity_summary(plan)}
    done = landing.write_entities(plan, list(targets), source, targets)
    return target, {entity: (targets[entity], commit) for entity, commit in done.items()}


def observed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each landed entity as the tasks that wrote it counted them, beside those its footers have."""
    target, done = _landed_events(spark, sf_dir)
    rows = [{"entity": entity, "observed": commit.rows, "columns": len(json.loads(commit.schema)["fields"])} for entity, (_, commit) in done.items()]
    return relation(spark, rows, "entity string, observed bigint, columns bigint").join(profile.row_counts(spark, target), "entity")


def landed_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What three loads noted of what they landed: rows of each within a window, without a listing."""
    _, done = _landed_events(spark, sf_dir)
    store = control.ControlStore(spark, shared_folder(spark, "control"))
    begin = datetime.now(timezone.utc)
    for load_id in ("20240101000000", "20240102000000", "20240103000000"):
        batch.note_landed(store, LoadParams("src", "de", "eu", load_id), done, token=load_id)
        # Noted again by a retry, and by another source.
        batch.note_landed(store, LoadParams("src", "de", "eu", load_id), done, token=load_id)
        batch.note_landed(store, LoadParams("src", "fr", "eu", load_id), done)
    window = ChangeWindow(begin, datetime(2100, 1, 1, tzinfo=timezone.utc))
    number = sum(len(commit.names) for _, commit in done.values())
    found = batch.landed_since(store, "src-de", window).select((F.col("files") / number).cast("bigint").alias("loads"))
    before = batch.landed_since(store, "src-de", ChangeWindow(datetime(2000, 1, 1), begin)).select(F.col("files").alias("before"))
    noted = store.read("landed").where("source_cluster = 'src-de'").groupBy("load_id").agg(F.sum("row_count").alias("row_count"))
    return noted.withColumns({"loads": found.scalar(), "before": before.scalar()})


def landed_exactly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a source whose folders hold more than a load may take: files of the same names
    in two folders, of which the later key overwrites the other, an old nested folder,
    keys that fit no template, and a column whose type grew. Landed by one, two and
    very many names at a time."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    root = shared_folder(spark, "source")
    share = F.pmod("o_orderkey", F.lit(5))
    narrow = orders.withColumn("o_orderkey", F.col("o_orderkey").cast("int"))
    # One write to both folders gives the parts of a task the same name in each.
    twice = narrow.where(share < 2).withColumn("folder", F.when(share == 0, F.lit("a")).otherwise(F.lit("b")))
    twice.repartition(6, "o_custkey").write.partitionBy("folder").parquet(f"{root}/src/de/src_de_ord")
    orders.where(share == 2).write.parquet(f"{root}/src/de/src_de_ord/c")
    narrow.where(share == 3).write.parquet(f"{root}/src/de/src_de_ord/c/deeper/nested")
    orders.where(share == 4).write.mode("append").parquet(f"{root}/src/de")
    # The nested folder counts as changed before the window.
    listed = files.listing(spark, root, "src/de/")
    old = F.contains("path", F.lit("/nested/"))
    timed = written(listed.withColumn("modified", F.when(old, F.lit(datetime(1960, 1, 1))).otherwise(F.col("modified"))), "listing")
    rule = paths.EntityRule.of(SOURCE_TEMPLATE)
    found = selection.candidates(timed, ALWAYS, relation(spark, [], "pull_folder string"), LOAD_ID)
    fits, _ = selection.mappable(found, rule)
    targeted = selection.with_target(fits, rule, LANDING_TEMPLATE, "src", "de", LOAD_ID)
    plan = written(selection.landing_plan(targeted), "landing-plan", by=("entity",))
    landed = []
    for chunk in (1, 2, PATHS_PER_READ):
        target = shared_folder(spark, "landing")
        landing.write_entity(plan, "ord", root, target, paths_per_read=chunk)
        landed.append(files.entity(spark, target).select("o_orderkey", "o_custkey", F.lit(chunk).alias("chunk")))
    return pages.union_all(landed)


def landed_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose key is a whole number, a text or a decimal by folder, and whose customer some
    files lack: no types hold all, so the entity lands as text, by few and by very many names."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    root = shared_folder(spark, "source")
    key, share = F.col("o_orderkey"), F.pmod("o_orderkey", F.lit(4))
    kinds = [
        orders.where(share == 0),
        orders.where(share == 1).withColumn("o_orderkey", key.cast("string")),
        orders.where(share == 2).withColumn("o_orderkey", key.cast("decimal(30,0)")),
        orders.where(share == 3).drop("o_custkey"),
    ]
    for folder, rows in zip("abcd", kinds):
        rows.write.parquet(f"{root}/src/de/src_de_ord/{folder}")
    listed = files.listing_by_tasks(spark, root, "src/de/")
    rule = paths.EntityRule.of(SOURCE_TEMPLATE)
    found = selection.candidates(listed, ALWAYS, relation(spark, [], "pull_folder string"), LOAD_ID)
    fits, _ = selection.mappable(found, rule)
    targeted = selection.with_target(fits, rule, LANDING_TEMPLATE, "src", "de", LOAD_ID)
    plan = written(selection.landing_plan(targeted), "landing-plan", by=("entity",))
    landed = []
    for chunk in (3, PATHS_PER_READ):
        target = shared_folder(spark, "landing")
        landing.write_entity(plan, "ord", root, target, paths_per_read=chunk, as_text=True)
        landed.append(files.entity(spark, target).withColumn("chunk", F.lit(chunk)))
    return pages.union_all(landed)


def allowed_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders scanned in each format a configuration may name; how many formats are refused."""
    scanned, refused = [], 0
    for name in ("parquet", "csv", "Parquet", "delta"):
        try:
            scanned.append(files.entity(spark, f"{sf_dir}/orders.parquet", name).withColumn("format", F.lit(name)))
        except ValueError:
            refused += 1
    return pages.union_all(scanned).select("o_orderkey", "format", F.lit(refused).alias("refused"))


def run_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run details of each type of events: their end is one time, and lies within the run."""
    start = datetime.now(timezone.utc)
    counts = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("entity")).agg(F.count(F.lit(1)).alias("row_count"))
    logged = written(runs.details(counts, LOAD_ID, start), "details")
    end = times.to_micros(datetime.now(timezone.utc))
    ends = logged.select("end_time").distinct().count()
    within = F.unix_micros("end_time").between(F.unix_micros("start_time"), F.lit(end))
    started = F.unix_micros("start_time") == F.lit(times.to_micros(start))
    return logged.select("entity", "row_count", (within & started).alias("within"), F.lit(ends).cast("bigint").alias("ends"))


def control_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load per month of orders writes its status, details and watermarks, several
    at a time; the control tables as a load reads them give the last of each priority."""
    orders = table(spark, sf_dir, "orders")
    months = (
        orders.groupBy(F.date_format("o_orderdate", "yyyyMM01000000").alias("load_id"))
        .agg(F.count(F.lit(1)).alias("row_count"), F.max("o_orderdate").alias("last"))
    )
    store = control.ControlStore(spark, shared_folder(spark, "control"))
    store.append_rows("path_config", [{"source_cluster": "src-de"}])
    store.append_rows("source_metadata", [{"source_metadata_id": "de_ord", "source_system": "src"}])

    def record(row: Row) -> None:
        params = LoadParams("src", "de", "eu", row.load_id)
        at = times.from_micros(row.at)
        runs.append_status(store, params, "Failed", "first try")
        runs.append_status(store, params, "success")
        counts = relation(spark, [{"entity": "Ord", "row_count": row.row_count}], "entity string, row_count bigint")
        runs.append_details(store, counts, row.load_id, at)
        marks = {"load_id": row.load_id, "logged_at": at}
        store.append_rows("file_watermark", [{"source_cluster": "src-de", "last_run_start_time": at, **marks}])
        store.append_rows(
            "entity_watermark",
            [{"source_metadata_id": "de_ord", "source_system": "src", "last_run_ts": at, **marks}],
        )

    last = F.unix_micros(F.col("last").cast("timestamp")).alias("at")
    run_all(spark, record, months.select("load_id", "row_count", last).collect())
    status = runs.latest_status(store.read("process_log")).select("load_id", "job_run_status")
    details = store.read("run_details").select("load_id", "entity", "row_count")
    marks = {
        "file_mark": store.path_config().select(F.col("last_run_start_time").cast("timestamp_ntz")).scalar(),
        "entity_mark": store.source_metadata().select(F.col("last_run_ts").cast("timestamp_ntz")).scalar(),
    }
    return status.join(details, "load_id").withColumns(marks)


def published_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed from folders whose entity names differ in case: the counts a
    load reports beside those of the tables it publishes."""
    events = table(spark, sf_dir, "events")
    source, target = shared_folder(spark, "source"), shared_folder(spark, "landing")
    odd = F.pmod("event_id", F.lit(2)) == 1
    name = F.when(odd, F.initcap("event_type")).otherwise(F.col("event_type"))
    _write_feed(spark, events, name, source)
    found = selection.candidates(
        files.listing(spark, source, "src/de/"), ALWAYS, relation(spark, [], "pull_folder string"), LOAD_ID
    )
    rule = paths.EntityRule.of(FEED_TEMPLATE)
    targeted = selection.with_target(found, rule, LANDING_TEMPLATE, "src", "de", LOAD_ID)
    # Parts of both folders have the names of their tasks; here all of them count.
    apart = targeted.withColumn("target_path", F.col("path"))
    plan = written(selection.landing_plan(apart), "landing-plan", by=("entity",))
    places = {item.entity: f"{target}/{item.entity}" for item in landing.entity_summary(plan)}
    landing.write_entities(plan, list(places), source, places)
    children = files.collected_children(spark, target)
    counts = profile.row_counts(spark, target, children)
    database = f"landing_{uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_folder(spark, 'database')}'")
    kinds = profile.schemas(spark, places)
    catalog.publish(spark, database, [catalog.EntityTable(n, places[n], kinds[n]) for n in places])
    names = catalog.tables(spark, database)
    numbers = run_all(spark, lambda name: spark.table(f"{database}.{name}").count(), names)
    rows = [{"entity": name, "table_count": number} for name, number in zip(names, numbers)]
    return counts.join(relation(spark, rows, "entity string, table_count bigint"), "entity")


def cleared_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What clearing a database of tables and a view drops; the files stay."""
    database = f"landing_{uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{shared_folder(spark, 'database')}'")
    locations = {name: f"{sf_dir}/{name}.parquet" for name in ("region", "nation", "orders")}
    kinds = profile.schemas(spark, locations)
    catalog.publish(spark, database, [catalog.EntityTable(n, locations[n], kinds[n]) for n in locations])
    spark.sql(f"CREATE VIEW {database}.seen AS SELECT 1 AS x")
    dropped = catalog.clear(spark, database)
    rows = [{"name": name, "left_over": len(catalog.tables(spark, database))} for name in dropped]
    counts = profile.row_counts(spark, sf_dir, lone_files=True).withColumnRenamed("entity", "name")
    return relation(spark, rows, "name string, left_over bigint").join(counts, "name", "left")


def inventory_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File selection out of an inventory with several versions of each key."""
    listed = _document_listing(spark, sf_dir)
    older = listed.withColumn("modified", F.col("modified") - F.make_dt_interval(F.lit(40)))
    later = F.col("modified") > _ntz("2024-01-08 00:00:00")
    mine = F.contains("path", F.lit(f"/{LOAD_ID}/"))
    known = files.inventory(listed.unionByName(older).where(later | mine))
    return selection.select_files(known, WINDOW, _document_folders(spark), LOAD_ID).select("path", "modified")


def listed_by_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in a folder a month and priority, listed by tasks over few and over many
    folders and by the driver: files and bytes that each finds, and rows they hold."""
    orders = table(spark, sf_dir, "orders")
    root = shared_folder(spark, "tree")
    month = F.date_format("o_orderdate", "yyyy-MM")
    placed = orders.select("o_orderkey", "o_orderpriority", month.alias("month")).repartition(8, "month")
    placed.write.partitionBy("month", "o_orderpriority").parquet(root)
    found = [
        files.listing(spark, root, "month=").withColumn("by", F.lit("driver")),
        files.listing_by_tasks(spark, root, "month=", enough=1).withColumn("by", F.lit("one")),
        files.listing_by_tasks(spark, root, "month=").withColumn("by", F.lit("tasks")),
    ]
    part = F.regexp_extract("path", "month=([^/]*)/", 1)
    listed = pages.union_all(found).groupBy(part.alias("month"), "path", "modified", "size").agg(F.count(F.lit(1)).alias("ways"))
    folders_of = listed.groupBy("month").agg(
        F.count_distinct(F.substring_index("path", "/", 2)).alias("folders"), F.min("ways").alias("ways")
    )
    held = spark.read.parquet(root).groupBy(F.col("month").cast("string").alias("month")).agg(F.count(F.lit(1)).alias("row_count"))
    return folders_of.join(held, "month")


QUERIES: tuple[Callable[[SparkSession, str], DataFrame], ...] = (
    landing_report,
    entity_row_counts,
    entity_columns,
    incremental_half_open,
    pull_between_inclusive,
    window_or_forced_entity,
    suffix_semi_join,
    entity_from_path,
    rejected_keys,
    expand_landing_path,
    last_wins_per_target,
    active_entities,
    active_entities_of_source,
    query_entity_config,
    per_entity_watermark_pull,
    declared_vs_landed_counts,
    rerun_exists,
    not_yet_loaded,
    already_loaded,
    window_file_count,
    watermark_upsert,
    latest_status,
    job_id_last_match,
    first_row,
    all_string_rows,
    page_union,
    response_pages,
    failed_pages,
    props_json,
    load_id_to_iso,
    not_marker,
    run_details,
    select_files,
    landing_plan,
    landed_entities,
    written_pull,
    published_tables,
    land_batch,
    landed_exactly,
    control_round_trip,
    published_counts,
    cleared_tables,
    inventory_selection,
    resumed_load,
    committed_landing,
    compacted_control,
    observed_counts,
    landed_since,
    listed_by_tasks,
    ordered_pages,
    switched_tables,
    sliced_pull,
    pull_without_repeats,
    landed_as_text,
    allowed_formats,
    run_times,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES}

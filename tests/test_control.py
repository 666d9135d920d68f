from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quayside.operators import metadata, runs
from quayside.params import LoadParams
from quayside.sources import appends, control, folders, tree
from quayside.sources.relations import relation, shared_folder
from tools import CURRENT, LAST, values

PARAMS = LoadParams("src", "de", "eu", "20220117101112")


def meta(entity, **changes):
    return {
        "source_metadata_id": f"de_{entity.lower()}",
        "source_system": "src",
        "country_code": "de",
        "entity": entity,
        "entity_status": "1",
        "subject_area": "area",
        "data_product": "product",
        "table_type": "query",
        "timestamp_fields": ["changed", "created"],
        "column_metadata": [{"name": "id"}, {"name": "changed"}],
        "last_run_ts": LAST,
        **changes,
    }


@pytest.fixture(scope="module")
def metadata_table(spark):
    rows = [
        meta("Ord"),
        meta("Off", entity_status="0"),
        meta("Off2", entity_status="01"),
        meta("Elsewhere", country_code="fr"),
        meta("Other", source_system="oth"),
        meta("Files", table_type="file"),
    ]
    return relation(spark, rows, control.SCHEMAS["source_metadata"])


def test_active_entities(metadata_table):
    found = metadata.active_entities(metadata_table, "src", "de")
    assert values(found) == [("Files", "product", "area"), ("Ord", "product", "area")]


def test_query_entities_respect_country_and_status(metadata_table):
    assert values(metadata.query_entities(metadata_table, "src", "de")) == [("Ord",)]


def test_entity_config(metadata_table):
    queried = metadata.query_entities(metadata_table, "src", "de")
    found = metadata.entity_config(queried, metadata_table, "src", "de")
    row = found.select("entity", "columns", "ts_column").first()
    assert tuple(row) == ("Ord", ["id", "changed"], "changed")


def test_job_id_is_the_last_match(spark):
    rows = [
        {"process_id": "p", "job_id": "7", "job_name": "load", "seq": 1},
        {"process_id": "p", "job_id": "3", "job_name": "load", "seq": 2},
        {"process_id": "p", "job_id": "9", "job_name": "other", "seq": 3},
        {"process_id": "q", "job_id": "8", "job_name": "load", "seq": 4},
    ]
    jobs = relation(spark, rows, control.SCHEMAS["job_config"])
    assert values(metadata.job_id(jobs, "p", "load")) == [("3",)]
    assert metadata.job_id(jobs, "p", "missing").count() == 0
    assert control.first(jobs, [F.desc("seq")]).first().job_id == "8"


def test_upsert_keeps_other_columns(spark):
    old = relation(
        spark,
        [{"k": "a", "v": 1, "w": "x"}, {"k": "b", "v": 2, "w": "y"}],
        "k string, v int, w string",
    )
    updates = relation(spark, [{"k": "b", "v": None}, {"k": "c", "v": 3}], "k string, v int")
    found = control.upsert(old, updates, ["k"])
    assert values(found, "k", "v", "w") == [("a", 1, "x"), ("b", None, "y"), ("c", 3, None)]


def test_latest_with_a_hot_key(spark):
    log = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("at"),
        F.col("id").alias("seq"),
    )
    best: dict = {}
    for row in log.collect():
        best[row.k] = max(best.get(row.k, (-1, -1)), (row["at"], row.seq))
    found = control.latest(log, ["k"], ["at", "seq"])
    assert {row.k: (row["at"], row.seq) for row in found.collect()} == best


def test_store_watermarks(spark):
    store = control.ControlStore(spark, shared_folder(spark, "control"))
    assert store.read("process_log").count() == 0
    store.append_rows("source_metadata", [meta("Ord"), meta("Inv")])
    later = CURRENT + timedelta(days=1)
    marks = [
        {
            "source_metadata_id": "de_ord", "source_system": "src", "last_run_ts": at,
            "load_id": load, "logged_at": logged,
        }
        # The last write counts, also where it moves the watermark back.
        for at, load, logged in [(later, "2", CURRENT), (CURRENT, "1", later)]
    ]
    marks.append({**marks[0], "source_metadata_id": "de_unknown"})
    store.append_rows("entity_watermark", marks)
    found = store.source_metadata().select("entity", F.unix_seconds("last_run_ts").alias("t"))
    assert values(found) == [
        ("Inv", int(LAST.timestamp())), ("Ord", int(CURRENT.timestamp())),
    ]


def test_statuses(spark):
    store = control.ControlStore(spark, shared_folder(spark, "control"))
    assert not runs.succeeded(store.read("process_log"), PARAMS).first().is_rerun
    runs.append_failure(store, PARAMS, ValueError("no footer"))
    assert not runs.succeeded(store.read("process_log"), PARAMS).first().is_rerun
    runs.append_status(store, PARAMS, "success")
    log = store.read("process_log")
    assert runs.succeeded(log, PARAMS).first().is_rerun
    for other in (
        LoadParams("src", "de", "eu", "20220118101112"),
        LoadParams("src", "fr", "eu", "20220117101112"),
        LoadParams("src", "de", "us", "20220117101112"),
    ):
        assert not runs.succeeded(log, other).first().is_rerun
    assert values(runs.latest_status(log), "job_run_status") == [("success",)]
    loads = log.select(*runs.LOAD_KEYS).distinct()
    assert runs.done(loads, log).count() == 1
    assert runs.pending(loads, log).count() == 0
    failure = log.where("job_run_status = 'Failed'").first()
    assert failure.error_message == "ValueError: no footer"


def test_report_case_rules(spark):
    counts = relation(
        spark, [{"entity": "ord", "row_count": 5}, {"entity": "x", "row_count": 1}],
        "entity string, row_count bigint",
    )
    active = relation(spark, [{"entity": "Ord"}, {"entity": "none"}], "entity string")
    assert values(runs.entity_report(active, counts)) == [("ord", 5)]
    assert values(runs.entity_report(active, counts, match_case=True)) == []


def test_run_details(spark):
    counts = relation(spark, [{"entity": "Ord", "row_count": 5}], "entity string, row_count bigint")
    store = control.ControlStore(spark, shared_folder(spark, "control"))
    runs.append_details(store, counts, "1", datetime(2022, 1, 1))
    row = store.read("run_details").first()
    assert (row.entity, row.row_count, row.error_count, row.status) == ("ord", 5, 0, "success")
    assert row.start_time is not None and row.end_time is not None


def test_appends_at_the_same_time(spark, tmp_path):
    """Every row of 16 writers is there once, and no append fails."""
    from concurrent.futures import ThreadPoolExecutor

    store = control.ControlStore(spark, str(tmp_path / "control"))

    def write(writer):
        for n in range(6):
            runs.append_status(store, LoadParams("src", "de", "eu", f"{writer}-{n}"), "success")

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(write, range(16)))
    found = sorted(row.load_id for row in store.read("process_log").collect())
    assert found == sorted(f"{writer}-{n}" for writer in range(16) for n in range(6))


#: Appends of a writer; the test was run once with 625, ten thousand in all.
EACH = 60


def test_many_appends_are_read_through_few_files(spark, tmp_path):
    """Appends of 16 writers, compacted by two others meanwhile, are neither lost nor doubled."""
    from concurrent.futures import ThreadPoolExecutor

    store = control.ControlStore(spark, str(tmp_path / "control"))

    def write(writer):
        for n in range(EACH):
            row = runs.status_row(LoadParams("src", "de", "eu", f"{writer}-{n}"), "success")
            store.append_rows("process_log", [{**row, "logged_at": CURRENT}])

    with ThreadPoolExecutor(18) as pool:
        writers = [pool.submit(write, writer) for writer in range(16)]

        def compact():
            while not all(writer.done() for writer in writers):
                store.compact("process_log")

        compactors = [pool.submit(compact) for _ in range(2)]
        for future in (*writers, *compactors):
            future.result()
    expected = sorted(f"{writer}-{n}" for writer in range(16) for n in range(EACH))
    assert sorted(row.load_id for row in store.read("process_log").collect()) == expected
    store.maintain(tail=0)
    assert len(store.snapshot("process_log").names) <= control.PARTS
    found = store.read("process_log")
    assert sorted(row.load_id for row in found.collect()) == expected
    assert len(found.inputFiles()) <= 4 * control.PARTS
    # Covered files go with the compactions that follow.
    for _ in range(3):
        runs.append_status(store, PARAMS, "success")
        store.compact("process_log")
    left = [e.name for e in folders.entries(spark, store.path("process_log"))]
    assert len(left) < 3 * control.PARTS
    assert store.read("process_log").count() == 16 * EACH + 3


def test_only_the_last_mark_of_a_key_stays(spark, tmp_path):
    store = control.ControlStore(spark, str(tmp_path / "control"))
    for n in range(40):
        at = LAST + timedelta(seconds=n)
        mark = {"source_cluster": f"s{n % 2}", "last_run_start_time": at, "load_id": str(n), "logged_at": at}
        store.append_rows("file_watermark", [mark])
        if n % 10 == 9:
            store.compact("file_watermark")
    found = store.read("file_watermark")
    assert values(found, "source_cluster", "load_id") == [("s0", "38"), ("s1", "39")]
    assert store.compact("file_watermark").tail == ()


def test_an_append_with_a_token_is_made_once(spark, tmp_path):
    store = control.ControlStore(spark, str(tmp_path / "control"))
    for _ in range(2):
        for _ in range(2):
            runs.append_status(store, PARAMS, "success", token="src-load")
        store.compact("process_log")
    runs.append_status(store, PARAMS, "success", token="other-load")
    assert store.read("process_log").count() == 2


def test_a_table_of_folders_is_still_read(spark, tmp_path):
    store = control.ControlStore(spark, str(tmp_path / "control"))
    rows = relation(spark, [{"process_id": "p", "job_id": "1", "job_name": "a", "seq": 1}], control.SCHEMAS["job_config"])
    store.append("job_config", rows)
    store.append_rows("job_config", [{"process_id": "p", "job_id": "2", "job_name": "b", "seq": 2}])
    assert values(store.read("job_config"), "job_id") == [("1",), ("2",)]
    store.compact("job_config")
    assert values(store.read("job_config"), "job_id") == [("1",), ("2",)]


def _loads(spark, number):
    """Three rows of each of some loads, one of them without an id."""
    load = F.when(F.col("id") >= 3, F.floor(F.col("id") / 3).cast("string"))
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))
    named = {"load_id": load, "job_run_status": F.pmod("id", F.lit(3)).cast("string"), "logged_at": at}
    columns = [named.get(name, F.lit(None).cast("string")).alias(name) for name in spark.createDataFrame([], control.SCHEMAS["process_log"]).columns]
    return spark.range(3 * number).select(*columns)


@pytest.mark.parametrize("by_tasks", [True, False])
def test_an_append_for_each_key(spark, tmp_path, monkeypatch, by_tasks):
    """Every key's rows are one append, and compactions neither lose nor double any, whoever reaches the store."""
    if not by_tasks:
        monkeypatch.setattr(tree, "reachable", lambda spark, root: False)
    store = control.ControlStore(spark, str(tmp_path / "control"))
    rows = _loads(spark, control.TAIL + 10)
    expected = values(rows)
    store.append_each("process_log", rows, ["load_id"])
    found = store.snapshot("process_log")
    assert len(found.tail) == len(found.files) == control.TAIL + 10
    assert values(store.read("process_log")) == expected
    store.append("process_log", rows)
    store.append_rows("process_log", [{"load_id": "x"}])
    assert len(store.snapshot("process_log").files) == control.TAIL + 11
    assert store.read("process_log").count() == 2 * len(expected) + 1
    store.compact("process_log")
    assert store.read("process_log").where("load_id is null or load_id != 'x'").count() == 2 * len(expected)
    # What the pointer covers goes with the next compaction, checksums too.
    runs.append_status(store, PARAMS, "success")
    store.compact("process_log")
    left = [entry.name for entry in (tmp_path / "control" / "process_log").iterdir() if "append-" in entry.name and not entry.name.endswith(".crc")]
    assert len(left) == 1
    if by_tasks:
        assert len([entry for entry in (tmp_path / "control" / "process_log").iterdir() if entry.name.startswith(".append-")]) <= 1
    assert store.read("process_log").count() == 2 * len(expected) + 2


def _shard_files(store, name):
    """Names of files in the shards of a table."""
    return sorted(row.name for row in appends.listed(store.spark, store._uri(name)).collect())


def test_the_driver_holds_no_names_of_what_tasks_append(spark, tmp_path, monkeypatch):
    """Neither listings nor pointers grow with the appends, while rows and covered files do what they did."""

    def never(snapshot):
        raise AssertionError("names came to the driver")

    monkeypatch.setattr(control.Snapshot, "_dealt_names", property(never))
    monkeypatch.setattr(appends, "SHARDS", 8)
    store = control.ControlStore(spark, str(tmp_path / "control"))
    rows = _loads(spark, 300)
    store.append_each("process_log", rows, ["load_id"])
    assert store.snapshot("process_log").size == len(_shard_files(store, "process_log")) == 300
    assert len(folders.entries(spark, store.path("process_log"))) <= 8
    assert values(store.read("process_log")) == values(rows)
    assert store.maintain() == ["process_log"]
    store.append_each("process_log", _loads(spark, 100), ["load_id"])
    for covered in (100, 0, 0):
        found = store.compact("process_log")
        assert (found.appended, found.many_covered) == (0, 0)
        assert len(_shard_files(store, "process_log")) == covered
        pointers = [entry for entry in folders.entries(spark, store.path("process_log")) if entry.name.startswith("_pointer-")]
        assert max(entry.bytes for entry in pointers) < 1000
        assert store.read("process_log").where("load_id is null or load_id != 'x'").count() == 1200
        store.append_rows("process_log", [{"load_id": "x"}])
    assert len([entry for entry in folders.entries(spark, store.path("process_log")) if entry.name.startswith("covered-")]) <= 2


@pytest.mark.parametrize("dealt", [True, False])
def test_a_compaction_lost_before_it_removes_doubles_no_row(spark, tmp_path, monkeypatch, dealt):
    """Covered names stay covered until they are gone."""
    store = control.ControlStore(spark, str(tmp_path / "control"))
    if dealt:
        store.append_each("process_log", _loads(spark, 5), ["load_id"])
    else:
        store.append_rows("process_log", [{"load_id": str(n)} for n in range(15)])
    store.compact("process_log")
    store.append_rows("process_log", [{"load_id": "x"}])
    with monkeypatch.context() as lost:
        lost.setattr(appends, "remove", lambda *_: None)
        lost.setattr(folders, "remove", lambda *_: None)
        store.compact("process_log")
        assert store.read("process_log").count() == 16
    store.append_rows("process_log", [{"load_id": "y"}])
    store.compact("process_log")
    assert store.read("process_log").count() == 17
    assert _shard_files(store, "process_log") == []


def test_a_listing_outrun_by_compactions_is_made_again(spark, tmp_path, monkeypatch):
    """Two compactions between the pointer and the listing of the shards remove what the pointer does not cover."""
    store, other = (control.ControlStore(spark, str(tmp_path / "control")) for _ in range(2))
    store.append_each("process_log", _loads(spark, 5), ["load_id"])
    listed, outrun = store._listed, []

    def late(*at):
        if not outrun:
            outrun.append(at)
            for _ in range(2):
                other.append_rows("process_log", [{"load_id": "x"}])
                other.compact("process_log")
            assert _shard_files(other, "process_log") == []
        return listed(*at)

    monkeypatch.setattr(store, "_listed", late)
    assert store.read("process_log").count() == 17


def test_appends_of_tasks_while_others_compact(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    store = control.ControlStore(spark, str(tmp_path / "control"))
    with ThreadPoolExecutor(4) as pool:
        writers = [pool.submit(store.append_each, "process_log", _loads(spark, 40), ["load_id"]) for _ in range(3)]
        while not all(writer.done() for writer in writers):
            store.compact("process_log")
        for writer in writers:
            writer.result()
    assert store.read("process_log").count() == 360
    store.maintain(tail=0)
    assert store.snapshot("process_log").size <= control.PARTS
    assert values(store.read("process_log")) == sorted(3 * values(_loads(spark, 40)), key=repr)


def test_shards_that_tasks_cannot_reach_are_not_passed_over(spark, tmp_path, monkeypatch):
    control.ControlStore(spark, str(tmp_path / "control")).append_each("process_log", _loads(spark, 5), ["load_id"])
    monkeypatch.setattr(tree, "reachable", lambda spark, root: False)
    with pytest.raises(ValueError, match="has shards"):
        control.ControlStore(spark, str(tmp_path / "control")).read("process_log")


def test_appends_of_an_older_schema_are_read_by_tasks(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    store = control.ControlStore(spark, str(tmp_path / "control"))
    folder = tmp_path / "control" / "job_config"
    folder.mkdir(parents=True)
    for n in range(control.TAIL + 1):
        pq.write_table(pa.table({"seq": pa.array([n], pa.int32()), "job_id": [str(n)]}), folder / f"append-{n}")
    found = store.read("job_config")
    assert values(found) == sorted(((None, str(n), None, n) for n in range(control.TAIL + 1)), key=repr)
    assert found.schema.simpleString() == spark.createDataFrame([], control.SCHEMAS["job_config"]).schema.simpleString()


def test_marks_of_many_appends_are_compacted_while_they_are_made(spark, tmp_path):
    """Events of a null user and of many others, more appends than a table may keep, and ties of none."""
    from quayside.plans import acceptance

    user = F.when(F.col("id") % 101 != 0, F.col("id") % 101)
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).cast("timestamp_ntz")
    kind = F.concat(F.lit("t"), F.col("id") % 3)
    spark.range(1212).select(user.alias("user_id"), kind.alias("event_type"), at.alias("ts")).write.parquet(f"{tmp_path}/events.parquet")
    found = acceptance.compacted_control(spark, str(tmp_path)).withColumn("at", F.unix_seconds(F.col("mark").cast("timestamp")) - 1_700_000_000)
    last = [1111 + n for n in range(101)]
    expected = sorted(((n or None, f"t{i % 3}", "4", 3, i, True) for n, i in enumerate(last)), key=repr)
    assert values(found, "user_id", "job_run_status", "error_message", "logged", "at", "few_files") == expected

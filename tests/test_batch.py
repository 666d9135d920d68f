from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from quayside.params import LoadParams
from quayside.plans import batch
from quayside.sources import catalog, control, journal
from tools import CURRENT, HOUR, LANDING, LAST, LOAD_ID, SECOND, TEMPLATE, put, touch, values

NEXT_ID = "20220118101112"
NEXT = datetime(2022, 1, 18, 10, 11, 12, tzinfo=timezone.utc)
ORDERS = [
    ("1", LAST - SECOND), ("2", LAST), ("3", LAST + HOUR), ("4", CURRENT), ("5", CURRENT + SECOND),
]


class Site:
    """A source, its control tables and a landing zone in one folder."""

    def __init__(self, spark, folder, query=True, **path_changes):
        self.spark, self.folder = spark, folder
        self.source, self.landing = folder / "source", folder / "landing"
        self.database = f"land_{folder.name}_de"
        self.store = control.ControlStore(spark, str(folder / "control"))
        entities = [self.meta("Acc", "file"), self.meta("Gone", "file"), self.meta("Off", "file", "0")]
        if query:
            entities += [self.meta("Ord", "query"), self.meta("Idle", "query", "0")]
        self.store.append_rows("source_metadata", entities)
        self.store.append_rows(
            "process_config",
            [
                {
                    "source_system": "src", "tenant": "t", "source_prefix": "Src/<country>/<loadid>/",
                    "landing_bucket": str(self.landing), "source_format": "parquet",
                    "landing_database": f"land_{folder.name}_<country>", **path_changes.pop("process", {}),
                }
            ],
        )
        self.store.append_rows(
            "path_config",
            [
                {
                    "source_cluster": "src-de", "source_bucket": str(self.source),
                    "source_template": TEMPLATE, "search_template": "<source-system>/<cluster>/",
                    "landing_root": str(self.landing), "landing_template": LANDING,
                    "cluster": "de", "source_system": "src", "last_run_start_time": LAST,
                    **path_changes,
                }
            ],
        )

    @staticmethod
    def meta(entity, kind, status="1"):
        return {
            "source_metadata_id": f"de_{entity.lower()}", "source_system": "src",
            "country_code": "de", "entity": entity, "entity_status": status,
            "subject_area": "s", "data_product": f"p {entity}", "table_type": kind,
            "timestamp_fields": ["changed", "created"],
            "column_metadata": [{"name": "id"}, {"name": "changed"}], "last_run_ts": LAST,
        }

    def orders(self):
        rows = [{"changed": at.replace(tzinfo=None), "id": key, "extra": 1} for key, at in ORDERS]
        return control.relation(self.spark, rows, "changed timestamp_ntz, id string, extra int")

    def load(self, load_id=LOAD_ID, **options):
        options.setdefault("pull_source", batch.from_tables({"ord": self.orders()}))
        return batch.land_batch(
            self.spark, LoadParams("src", "de", "eu", load_id), self.store, **options
        )

    def tables(self):
        return {
            name: self.spark.table(f"{self.database}.{name}").count()
            for name in catalog.tables(self.spark, self.database)
        }

    def statuses(self):
        log = self.store.read("process_log").orderBy("logged_at")
        return [(row.load_id, row.job_run_status) for row in log.collect()]

    def marks(self):
        files = self.store.path_config().select(F.unix_seconds("last_run_start_time")).first()[0]
        entity = (
            self.store.source_metadata().where("entity = 'Ord'")
            .select(F.unix_seconds("last_run_ts")).first()
        )
        return files, entity and entity[0]


def seconds(value):
    return int(value.timestamp())


def test_two_loads_a_rerun_and_an_empty_load(spark, tmp_path):
    site = Site(spark, tmp_path)
    put(site.source, "src/de/src_de_acc/a/f0.parquet", LAST, {"id": [0]})
    put(site.source, "src/de/src_de_acc/a/f1.parquet", LAST + SECOND, {"id": [1, 2]})
    put(site.source, "src/de/src_de_extra/a/e1.parquet", CURRENT, {"id": ["x"]})

    first = site.load()
    # Rows on both ends of the window are pulled; the pull is newer than the
    # load and lands because its folder is forced.
    assert (first.action, first.is_rerun, first.files > 2, first.pulled) == (
        batch.REBUILT, False, True, ("Ord",),
    )
    assert values(first.report, "entity", "data_product", "row_count") == [
        ("acc", "p Acc", 2), ("ord", "p Ord", 3),
    ]
    assert site.tables() == {"acc": 2, "extra": 1, "ord": 3}
    ordered = spark.table(f"{site.database}.ord")
    assert [f.dataType.simpleString() for f in ordered.schema] == ["string", "string"]
    assert values(ordered, "id") == [("2",), ("3",), ("4",)]
    assert site.marks() == (seconds(CURRENT), seconds(CURRENT))
    assert site.statuses() == [(LOAD_ID, "success")]
    details = site.store.read("run_details")
    assert values(details, "entity", "row_count", "load_id") == [
        ("acc", 2, LOAD_ID), ("extra", 1, LOAD_ID), ("ord", 3, LOAD_ID),
    ]

    # What the first load pulled carries times inside the next window.
    for file in (site.source / f"src/de/src_de_ord/{LOAD_ID}").glob("*.parquet"):
        touch(site.source, str(file.relative_to(site.source)), CURRENT + HOUR)
    put(site.source, "src/de/src_de_acc/b/f2.parquet", CURRENT + HOUR, {"id": [3]})
    second = site.load(NEXT_ID)
    assert second.action == batch.REBUILT and second.pulled == ("Ord",)
    # The row on the old watermark comes again, the one after it is new.
    assert site.tables() == {"acc": 1, "ord": 2}
    assert values(spark.table(f"{site.database}.ord"), "id") == [("4",), ("5",)]
    assert site.marks() == (seconds(NEXT), seconds(NEXT))

    again = site.load(NEXT_ID)
    assert (again.action, again.is_rerun, again.files, again.pulled) == (
        batch.REBUILT, True, 0, (),
    )
    assert site.tables() == {"acc": 1, "ord": 2}
    assert values(again.report, "entity", "row_count") == [("acc", 1), ("ord", 2)]

    # Landed files are newer than every load here; move them before the window.
    for file in site.landing.rglob("*.parquet"):
        touch(site.landing, str(file.relative_to(site.landing)), LAST)
    empty = site.load("20220119101112")
    assert (empty.action, empty.files, empty.report, empty.pulled) == (
        batch.CLEARED, 0, None, (),
    )
    assert site.tables() == {}
    # Nothing landed: the file watermark stays, that of the pulled entity moves.
    assert site.marks() == (seconds(NEXT), seconds(NEXT + timedelta(days=1)))
    assert [status for _, status in site.statuses()] == ["success"] * 4


def test_relands_restores_double_landing(spark, tmp_path):
    site = Site(spark, tmp_path)
    put(site.source, "src/de/src_de_ord/20220116100000/p.parquet", LAST + HOUR, {"id": ["9"]})
    idle = batch.from_tables({"ord": site.orders().limit(0)})
    assert site.load(pull_source=idle).files == 0
    other = Site(spark, tmp_path / "other")
    put(other.source, "src/de/src_de_ord/20220116100000/p.parquet", LAST + HOUR, {"id": ["9"]})
    assert other.load(pull_source=idle, relands=True).files == 1


def test_files_landed_since_the_watermark_rebuild(spark, tmp_path):
    """No new source files, but the landing zone changed in the window."""
    site = Site(spark, tmp_path, query=False)
    put(site.landing, "src/de/20220116235959/acc/f.parquet", LAST + HOUR, {"id": [1]})
    outcome = site.load(landed_by_others=True)
    assert (outcome.action, outcome.files) == (batch.REBUILT, 0)
    assert site.tables() == {} and outcome.report.count() == 0


def test_unfinished_load_with_moved_watermark_rebuilds(spark, tmp_path):
    site = Site(spark, tmp_path, query=False, last_run_start_time=CURRENT)
    put(site.landing, f"src/de/{LOAD_ID}/Acc/f.parquet", LAST, {"id": [1, 2, 3]})
    outcome = site.load()
    assert (outcome.action, outcome.files) == (batch.REBUILT, 0)
    assert site.tables() == {"acc": 3}
    assert values(outcome.report, "entity", "row_count") == [("acc", 3)]


def test_failure_is_logged_raised_and_repeatable(spark, tmp_path):
    site = Site(spark, tmp_path)
    put(site.source, "src/de/src_de_acc/a/f1.parquet", LAST + SECOND, {"id": [1]})
    put(site.source, "src/de/src_de_bad/a/f1.parquet", LAST + SECOND)
    with pytest.raises(Exception):
        site.load()
    (status,) = site.store.read("process_log").collect()
    assert status.job_run_status == "Failed" and status.error_message
    # Neither watermark moved, so the retry takes the same window.
    assert site.marks() == (seconds(LAST), seconds(LAST))
    put(site.source, "src/de/src_de_bad/a/f1.parquet", LAST + SECOND, {"id": [7]})
    outcome = site.load()
    assert not outcome.is_rerun and site.tables() == {"acc": 1, "bad": 1, "ord": 3}


def test_key_that_fits_no_template(spark, tmp_path):
    site = Site(spark, tmp_path, query=False)
    put(site.source, "src/de/f6.parquet", LAST + SECOND, {"id": [1]})
    put(site.source, "src/de/src_de_acc/a/f1.parquet", LAST + SECOND, {"id": [1]})
    with pytest.raises(ValueError, match="1 key.*src/de/f6.parquet"):
        site.load()
    outcome = site.load(allow_rejected=True)
    assert values(outcome.rejected, "path") == [("src/de/f6.parquet",)]
    assert outcome.files == 1 and site.tables() == {"acc": 1}


def test_missing_configuration_fails(spark, tmp_path):
    site = Site(spark, tmp_path)
    with pytest.raises(ValueError, match="no path configuration for src-fr"):
        batch.land_batch(spark, LoadParams("src", "fr", "eu", LOAD_ID), site.store)
    assert site.statuses() == [(LOAD_ID, "Failed")]
    with pytest.raises(ValueError, match="no source to pull Ord"):
        site.load(pull_source=None)


def test_unknown_format_fails(spark, tmp_path):
    site = Site(spark, tmp_path, process={"source_format": "csv"})
    with pytest.raises(ValueError, match="csv"):
        site.load()
    assert site.statuses() == [(LOAD_ID, "Failed")]


def test_landing_outside_the_profiled_root_fails(spark, tmp_path):
    """The landed root is lower-cased, target paths are not."""
    site = Site(spark, tmp_path, query=False, cluster="DE", search_template="src/")
    put(site.source, "src/de/src_de_acc/a/f1.parquet", LAST + SECOND, {"id": [1]})
    with pytest.raises(ValueError, match="none below"):
        site.load()


def test_pulls_that_would_not_be_found_fail(spark, tmp_path):
    """Pull folders are lower-cased, the search prefix is not."""
    site = Site(spark, tmp_path, cluster="DE")
    with pytest.raises(ValueError, match="pulls of Ord would not be under src/DE/"):
        site.load()


def test_pull_from_response_pages(spark, tmp_path):
    site = Site(spark, tmp_path)
    folder = tmp_path / "pages" / "ord"
    folder.mkdir(parents=True)
    for number, data in enumerate(([{"id": 1, "changed": "x"}], [{"changed": "y", "id": 2}])):
        answer = {"responseStatus": "SUCCESS", "responseDetails": {}, "data": data}
        (folder / f"p{number}.json").write_text(json.dumps(answer))
    source = batch.from_pages(spark, lambda entity: str(tmp_path / "pages" / entity))
    site.load(pull_source=source)
    assert values(spark.table(f"{site.database}.ord")) == [("1", "x"), ("2", "y")]
    failed = {"responseStatus": "FAILURE", "errors": "expired"}
    (folder / "p2.json").write_text(json.dumps(failed))
    with pytest.raises(Exception, match="failed: expired"):
        site.load(NEXT_ID, pull_source=source)


def test_inventory_replaces_the_listing(spark, tmp_path):
    """Only what the inventory names is landed, plus what this load pulled."""
    site = Site(spark, tmp_path)
    for name in ("f1", "f2"):
        put(site.source, f"src/de/src_de_acc/a/{name}.parquet", LAST + SECOND, {"id": [1]})
    known = control.relation(
        spark,
        [{"path": "src/de/src_de_acc/a/f1.parquet", "modified": LAST + n * SECOND} for n in (1, 2)],
        "path string, modified timestamp",
    )
    site.load(inventory=known)
    assert site.tables() == {"acc": 1, "ord": 3}


def test_pulls_without_a_folder_of_their_own_fail(spark, tmp_path):
    """Without the load id in its path no load would find a pull again."""
    site = Site(spark, tmp_path, source_template=TEMPLATE.replace("/<folder>", ""))
    with pytest.raises(ValueError, match="pulls of Ord would not be found"):
        site.load()
    assert site.marks() == (seconds(LAST), seconds(LAST))
    assert not site.source.exists()


def test_a_pull_that_does_not_land_moves_no_watermark(spark, tmp_path):
    """An inventory cannot hide it, but a file of the same name can win over it."""
    site = Site(spark, tmp_path)
    found = batch.land_files

    def without_pulls(*args, **options):
        return batch.Landed(found(*args, **options).files, None, frozenset())

    batch.land_files = without_pulls
    try:
        with pytest.raises(ValueError, match="pulls of Ord were not landed"):
            site.load()
    finally:
        batch.land_files = found
    assert site.marks() == (seconds(LAST), seconds(LAST))
    assert site.load().action == batch.REBUILT


@pytest.mark.parametrize("form", ["file://{}", "file:{}/", "{}//"])
def test_a_root_spelled_in_another_way(spark, tmp_path, form):
    site = Site(spark, tmp_path, query=False, source_bucket=form.format(tmp_path / "source"))
    put(site.source, "src/de/src_de_acc/a/f1.parquet", LAST + SECOND, {"id": [1]})
    assert site.load().action == batch.REBUILT
    assert site.tables() == {"acc": 1}


def test_loose_files_and_views_in_the_landing_zone(spark, tmp_path):
    site = Site(spark, tmp_path, query=False)
    put(site.source, "src/de/src_de_Acc/a/f1.parquet", LAST + SECOND, {"id": [1, 2]})
    put(site.source, "src/de/src_de_acc/a/f2.parquet", LAST + SECOND, {"id": [3]})
    put(site.landing, f"src/de/{LOAD_ID}/acc.parquet", LAST + SECOND, {"id": [9]})
    put(site.landing, f"src/de/{LOAD_ID}/manifest.json", LAST + SECOND)
    spark.sql(f"create database {site.database}")
    spark.sql(f"create view {site.database}.old as select 1 x")
    outcome = site.load()
    assert site.tables() == {"acc": 3}
    assert values(outcome.report, "entity", "row_count") == [("acc", 3)]


def test_job_id_in_the_records(spark, tmp_path):
    site = Site(spark, tmp_path, query=False)
    put(site.source, "src/de/src_de_acc/a/f1.parquet", LAST + SECOND, {"id": [1]})
    params = LoadParams("src", "de", "eu", LOAD_ID, job_name="landing")
    with pytest.raises(ValueError, match="no job landing of src_eu"):
        batch.land_batch(spark, params, site.store)
    site.store.append_rows(
        "job_config",
        [{"process_id": "src_eu", "job_id": f"j{n}", "job_name": "landing", "seq": n} for n in (1, 2)],
    )
    batch.land_batch(spark, params, site.store)
    assert {row.job_id for row in site.store.read("run_details").collect()} == {"j2"}
    status = site.store.read("process_log").where("job_run_status = 'success'")
    assert [row.job_id for row in status.collect()] == ["j2"]


STEPS = ["opened", "pulled Ord", "landed", "published", "marked"]


def stopped(step, state):
    def progress(*at):
        if at == (step, state):
            raise KeyboardInterrupt(at)

    return progress


def outcome_of(site):
    """Rows, counts and marks after a load."""
    ordered = values(site.spark.table(f"{site.database}.ord"), "id")
    details = values(site.store.read("run_details"), "entity", "row_count", "load_id")
    return ordered, site.tables(), details, site.marks()


@pytest.mark.parametrize("step, state", [*((step, "did") for step in STEPS), ("pulled Ord", "noted"), ("marked", "noted")])
def test_a_load_stopped_after_any_step_goes_on(spark, tmp_path, step, state):
    """With rows on both bounds, which a pull from a moved watermark would take for all there is."""

    def make(folder):
        site = Site(spark, folder)
        put(site.source, "src/de/src_de_acc/a/f1.parquet", LAST + SECOND, {"id": [1, 2]})
        return site

    calm, rough = make(tmp_path / f"calm_{state}"), make(tmp_path / f"rough_{state}")
    expected = calm.load()
    with pytest.raises(KeyboardInterrupt):
        rough.load(progress=stopped(step, state))
    assert rough.statuses() == []
    found = rough.load()
    assert (found.action, found.is_rerun, found.files, found.pulled) == (
        expected.action, False, expected.files, expected.pulled,
    )
    assert values(found.report) == values(expected.report)
    assert outcome_of(rough) == outcome_of(calm)
    assert outcome_of(rough)[0] == [("2",), ("3",), ("4",)]
    assert rough.statuses() == [(LOAD_ID, "success")]
    # The next load starts where an undisturbed one would have.
    for site in (calm, rough):
        for file in (site.source / f"src/de/src_de_ord/{LOAD_ID}").glob("*.parquet"):
            touch(site.source, str(file.relative_to(site.source)), CURRENT + HOUR)
        assert site.load(NEXT_ID).pulled == ("Ord",)
        assert values(spark.table(f"{site.database}.ord"), "id") == [("4",), ("5",)]


def test_a_load_whose_success_row_was_not_written(spark, tmp_path, monkeypatch):
    """Ten rows were published and watermarks moved; a retry must not pull the rows on the bound alone."""
    site = Site(spark, tmp_path)
    written = batch.runs.append_status

    def fails(control, params, status, *args, **options):
        if status == "success":
            raise OSError("no space left")
        return written(control, params, status, *args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(batch.runs, "append_status", fails)
        with pytest.raises(OSError):
            site.load()
    assert site.marks() == (seconds(CURRENT), seconds(CURRENT))
    outcome = site.load()
    assert outcome.action == batch.REBUILT and site.tables() == {"ord": 3}
    assert site.statuses() == [(LOAD_ID, "Failed"), (LOAD_ID, "success")]


def test_what_a_journal_says(spark, tmp_path):
    site = Site(spark, tmp_path)
    site.load()
    rows = journal.table(spark, site.store.root)
    assert sorted(row.step for row in rows.collect()) == sorted(STEPS)
    opened = json.loads(rows.where("step = 'opened'").first().facts)
    assert opened["last"] == seconds(LAST) * 1_000_000
    assert values(rows, "process_id", "country_code", "load_id")[0] == ("src_eu", "de", LOAD_ID)
    assert journal.table(spark, str(tmp_path / "none")).count() == 0


def test_a_load_neither_lists_nor_reads_footers_of_what_it_landed(spark, tmp_path, monkeypatch):
    site = Site(spark, tmp_path)
    put(site.source, "src/de/src_de_acc/a/f1.parquet", LAST + SECOND, {"id": [1, 2]})
    monkeypatch.setattr(batch.files, "collected_children", None)
    monkeypatch.setattr(batch.profile, "row_counts", None)
    monkeypatch.setattr(batch.profile, "schemas", None)
    outcome = site.load()
    assert values(outcome.report, "entity", "row_count") == [("acc", 2), ("ord", 3)]
    noted = site.store.read("landed")
    assert values(noted, "entity", "files", "row_count", "load_id") == [("acc", 1, 2, LOAD_ID), ("ord", 1, 3, LOAD_ID)]
    # Two hundred loads later nothing is listed either to tell whether any landed since.
    window = batch.ChangeWindow(CURRENT, datetime(2100, 1, 1, tzinfo=timezone.utc))
    assert batch.landed_since(site.store, "src-de", window).first().files == 2
    assert batch.landed_since(site.store, "src-fr", window).first().files == 0


def test_intermediate_tables_are_removed(spark, tmp_path):
    from pathlib import Path

    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    site = Site(spark, tmp_path)
    before = set(shared.glob("*")) if shared.exists() else set()
    site.load()
    assert (set(shared.glob("*")) if shared.exists() else set()) == before

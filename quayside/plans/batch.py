"""One landing batch: pull, select, land, profile, publish, record."""

from __future__ import annotations

import json
from collections.abc import Callable, Collection, Mapping
from dataclasses import dataclass, replace
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.concurrency import run_all
from quayside.constants import CLUSTER, ENTITY, FILE, LOAD_ID, SOURCE_SYSTEM, SUCCESS
from quayside.functions import paths
from quayside.functions.times import from_micros, to_micros
from quayside.functions.values import all_string
from quayside.operators import metadata, profile, runs, selection
from quayside.params import ChangeWindow, LoadParams
from quayside.sources import catalog, commits, files, folders, landing, pages, pull
from quayside.sources.control import ControlStore, first, latest, lookup
from quayside.sources.journal import Journal, Progress
from quayside.sources.relations import relation, scratch, shared_folder

REBUILT = "rebuilt"
CLEARED = "cleared"
REJECTED_DDL = "path string, modified timestamp"


@dataclass(frozen=True)
class EntityPull:
    """One entity to pull: what, and which change window."""

    entity: str
    source_metadata_id: str
    columns: tuple[str, ...]
    ts_column: str
    last: datetime
    current: datetime


PullSource = Callable[[EntityPull], DataFrame]


def from_tables(tables: Mapping[str, DataFrame] | Callable[[str], DataFrame],
                boundaries: pull.Boundaries | None = None) -> PullSource:
    """Pull entities from tables Spark can read, by lower-cased entity name. With
    ``boundaries`` a row on the bound between two loads comes with the first only."""
    find = tables.__getitem__ if isinstance(tables, Mapping) else tables

    def rows(item: EntityPull) -> DataFrame:
        table = find(item.entity.lower())
        if boundaries is None:
            return pull.incremental(table, item.columns, item.ts_column, item.last, item.current)
        return boundaries.pulled(table, item.source_metadata_id, item.columns, item.ts_column, item.last, item.current)

    return rows


def from_pages(spark: SparkSession, folder: Callable[[str], str],
               one_per_line: bool = False, linked: bool = False) -> PullSource:
    """Pull entities from landed response pages; a failed page fails the load. So does, with
    ``linked``, a page that is not there though another leads to it by its file's name."""

    def rows(item: EntityPull) -> DataFrame:
        found = pages.read(spark, folder(item.entity.lower()), item.columns, one_per_line)
        if linked:
            found = pages.ordered(found)
        return pages.to_rows(pages.checked(found))

    return rows


@dataclass(frozen=True)
class Layout:
    """Where a source is read from, landed and published."""

    source_root: str
    source_template: str
    search_prefix: str
    landing_root: str
    landing_template: str
    cluster: str
    source_system: str
    last: datetime
    landed_root: str
    database: str
    source_format: str

    @classmethod
    def of(cls, control: ControlStore, params: LoadParams) -> Layout:
        configs = lookup(
            control.path_config(),
            {"source_cluster": params.source_cluster},
            [
                "source_bucket", "source_template", "search_template", "landing_root",
                "landing_template", "cluster", "source_system",
                F.unix_micros("last_run_start_time").alias("last"),
            ],
        )
        config = first(configs, ["landing_root", "source_bucket"]).first()
        if config is None:
            raise ValueError(f"no path configuration for {params.source_cluster}")
        if config.last is None:
            raise ValueError(f"no file watermark for {params.source_cluster}")
        process = _process_config(control, params)
        files.check_format(process.source_format)
        if f"{ENTITY}/{FILE}" not in config.landing_template:
            raise ValueError(f"landing template needs a folder per entity: {config.landing_template}")
        landed = paths.landed_root(process.source_prefix, params).strip("/")
        return cls(
            source_root=config.source_bucket.rstrip("/"),
            source_template=config.source_template,
            search_prefix=paths.expand_text(
                config.search_template,
                {SOURCE_SYSTEM: config.source_system, CLUSTER: config.cluster},
            ),
            landing_root=config.landing_root.rstrip("/"),
            landing_template=config.landing_template,
            cluster=config.cluster,
            source_system=config.source_system,
            last=from_micros(config.last),
            landed_root=f"{process.landing_bucket.rstrip('/')}/{landed}",
            database=paths.database_name(process.landing_database, params),
            source_format=process.source_format,
        )

    def _landing_prefix(self, load_id: str, entity: str) -> str:
        return paths.expand_text(
            self.landing_template.partition(FILE)[0],
            {
                SOURCE_SYSTEM: self.source_system,
                CLUSTER: self.cluster,
                LOAD_ID: load_id,
                ENTITY: entity,
            },
        )

    def entity_folder(self, load_id: str, entity: str) -> str:
        return f"{self.landing_root}/{self._landing_prefix(load_id, entity).rstrip('/')}"

    def all_loads_prefix(self) -> str:
        """Common prefix of what all loads of this source landed."""
        before = self.landing_template.partition(LOAD_ID)[0].partition(ENTITY)[0]
        return paths.expand_text(
            before, {SOURCE_SYSTEM: self.source_system, CLUSTER: self.cluster}
        )


def _process_config(control: ControlStore, params: LoadParams) -> Row:
    """Configuration of the first tenant of the source."""
    configs = control.read("process_config")
    of_source = lookup(configs, {"source_system": params.source}, configs.columns)
    found = first(of_source, ["tenant", "landing_database", "landing_bucket"]).first()
    if found is None:
        raise ValueError(f"no process configuration for {params.source}")
    return found


@dataclass(frozen=True)
class LoadOutcome:
    """What a load did. ``report`` has the active entities with their row counts
    and is ``None`` where nothing was rebuilt; ``rejected`` has the keys that
    did not fit the source template."""

    action: str
    is_rerun: bool
    files: int
    pulled: tuple[str, ...]
    report: DataFrame | None = None
    rejected: DataFrame | None = None


def land_batch(spark: SparkSession, params: LoadParams, control: ControlStore,
               pull_source: PullSource | None = None, inventory: DataFrame | None = None,
               relands: bool = False, allow_rejected: bool = False,
               rebalance_pulls: bool = True, workers: int = 8,
               landed_by_others: bool = False, progress: Progress | None = None,
               as_text: Collection[str] = ()) -> LoadOutcome:
    """Run one load.

    Its steps are journalled (``sources/journal.py``): windows are frozen when the load
    opens, and a load run again under its id goes on after the last step that ended.
    So a load that was stopped anywhere comes to the rows, counts and watermarks it
    would have come to undisturbed. Files are selected anew until they have landed.
    Watermarks move only after the tables are published and the success row comes
    last. A failure is logged and raised.

    What earlier loads landed is known from the control table ``landed``;
    ``landed_by_others`` also lists the landing zone, for files put there by hand.
    Entities named in ``as_text`` land with all columns as text, so that files whose types
    differ beyond widening land together.
    """
    start = datetime.now(timezone.utc)
    job_id: str | None = None
    try:
        job_id, layout, is_rerun, planned = run_all(
            spark,
            lambda read: read(),
            [
                partial(_job_id, control, params),
                partial(Layout.of, control, params),
                lambda: runs.succeeded(control.read("process_log"), params).first().is_rerun,
                partial(pull_plan, control, params),
            ],
        )
        if is_rerun:
            report = rebuild(spark, layout, params, control, start, job_id, landed_by_others)
            runs.append_status(control, params, SUCCESS, job_id=job_id)
            return LoadOutcome(REBUILT, True, 0, (), report)
        journal = Journal(spark, control.root, params, progress)
        layout, pulls = _opened(journal, layout, planned(), params)
        pulled = pull_entities(spark, layout, params, pulls, pull_source, rebalance_pulls, workers, journal)

        def land() -> dict:
            listed = source_files(spark, layout, params, pulls, inventory)
            found = land_files(spark, layout, params, pulls, listed, control, relands, allow_rejected, workers, journal.token, as_text)
            lost = [name for name in pulled if _pull_name(params, name) not in found.pulled]
            if lost:
                raise ValueError(f"pulls of {', '.join(lost)} were not landed")
            return {"files": found.files, "rejected": found.rejected}

        def publish() -> dict:
            if not (landed["files"] or _landed_before(spark, layout, params, control, landed_by_others)):
                catalog.clear(spark, layout.database)
                return {"action": CLEARED}
            counts = publish_landed(spark, layout, params, control, landed["files"], landed_by_others)
            runs.append_details(control, counts, params.load_id, start, job_id, journal.token)
            return {"action": REBUILT, "counts": [row.asDict() for row in counts.collect()]}

        def mark() -> dict:
            _advance_watermarks(control, params, pulls, landed["files"], journal.token)
            return {}

        landed = journal.once("landed", land)
        published = journal.once("published", publish)
        journal.once("marked", mark)
        runs.append_status(control, params, SUCCESS, job_id=job_id, token=journal.token)
        control.maintain()
    except Exception as error:
        runs.append_failure(control, params, error, job_id)
        raise
    rejected = landed["rejected"] and spark.read.schema(REJECTED_DDL).parquet(landed["rejected"])
    report = None
    if published["action"] == REBUILT:
        report = _report(control, params, relation(spark, published["counts"], profile.COUNTS_DDL))
    return LoadOutcome(published["action"], False, landed["files"], tuple(pulled), report, rejected)


def _opened(journal: Journal, layout: Layout, planned: list[EntityPull], params: LoadParams) -> tuple[Layout, list[EntityPull]]:
    """Layout and pulls with the windows the load had when it was first opened."""

    def bounds() -> dict:
        pulls = [{**vars(item), "last": to_micros(item.last), "current": None} for item in planned]
        return {"last": to_micros(layout.last), "pulls": pulls}

    facts = journal.once("opened", bounds)
    pulls = [
        EntityPull(**{**item, "columns": tuple(item["columns"]), "last": from_micros(item["last"]), "current": params.current})
        for item in facts["pulls"]
    ]
    return replace(layout, last=from_micros(facts["last"])), pulls


def _job_id(control: ControlStore, params: LoadParams) -> str | None:
    """Id of the job that runs the load, for its records."""
    if params.job_name is None:
        return None
    found = metadata.job_id(control.read("job_config"), params.process_id, params.job_name).first()
    if found is None:
        raise ValueError(f"no job {params.job_name} of {params.process_id}")
    return found.job_id


def _pull_name(params: LoadParams, entity: str) -> str:
    """Name of the folder that holds the pulls of an entity, as keys have it."""
    return f"{params.source}_{params.country}_{entity}".lower()


def pull_plan(control: ControlStore, params: LoadParams) -> Callable[[], list[EntityPull]]:
    """Query entities of this load with columns and window, one row each; raises, when
    called, for those without a watermark."""
    meta = control.source_metadata()
    queried = metadata.query_entities(meta, params.source, params.country)
    config = metadata.entity_config(queried, meta, params.source, params.country)
    rows = config.withColumn("last", F.unix_micros("last_run_ts")).orderBy("entity").collect()

    def pulls() -> list[EntityPull]:
        missing = [row.entity for row in rows if row.last is None]
        if missing:
            raise ValueError(f"no watermark for {', '.join(missing)}")
        return [
            EntityPull(
                row.entity, row.source_metadata_id, tuple(row.columns), row.ts_column,
                from_micros(row.last), params.current,
            )
            for row in rows
        ]

    return pulls


def pull_entities(spark: SparkSession, layout: Layout, params: LoadParams,
                  pulls: list[EntityPull], pull_source: PullSource | None, rebalance: bool,
                  workers: int, journal: Journal) -> list[str]:
    """Write the changed rows of each query entity below the source root, all
    columns as text. Returns the entities that had rows."""
    if pulls and pull_source is None:
        raise ValueError(f"no source to pull {', '.join(item.entity for item in pulls)} from")

    folders_of = {
        item.entity: paths.pull_folder(layout.source_template, params, item.entity)
        for item in pulls
    }
    outside = [name for name, folder in folders_of.items()
               if not folder.startswith(layout.search_prefix)]
    if outside:
        raise ValueError(f"pulls of {', '.join(outside)} would not be under {layout.search_prefix}")
    unfound = [
        name for name, folder in folders_of.items()
        if folder.rstrip("/").split("/")[-2:] != [_pull_name(params, name), params.load_id]
    ]
    if unfound:
        raise ValueError(
            f"pulls of {', '.join(unfound)} would not be found: {layout.source_template} has no "
            "folder of the entity's name and the load id in it"
        )

    def write(item: EntityPull) -> int:
        folder = f"{layout.source_root}/{folders_of[item.entity].rstrip('/')}"

        def pull() -> dict:
            rows = all_string(pull_source(item), item.columns)
            commit = landing.write_pull(rows, folder, rebalance)
            return {"rows": commit.rows if commit else 0}

        known = journal.known(f"pulled {item.entity}")
        if known and known["rows"]:
            commits.tidy(spark, folder)
        return journal.once(f"pulled {item.entity}", pull)["rows"]

    wrote = run_all(spark, write, pulls, workers)
    return [item.entity for item, rows in zip(pulls, wrote) if rows]


@dataclass(frozen=True)
class Landed:
    """Files taken, folder of the rejected keys if they are wanted, and pull folders that landed."""

    files: int
    rejected: str | None
    pulled: frozenset[str]


def source_files(spark: SparkSession, layout: Layout, params: LoadParams,
                 pulls: list[EntityPull], inventory: DataFrame | None = None) -> DataFrame:
    """Files of the source, listed, or out of an inventory.

    An inventory is older than what this load pulled, so those folders alone
    are listed besides it.
    """
    if inventory is None:
        return files.listing_by_tasks(spark, layout.source_root, layout.search_prefix)
    # Versions that cannot matter leave before the inventory is brought together:
    # of a key whose latest version is in the window, that version stays.
    later = F.col("modified") > F.lit(layout.last)
    mine = F.contains("path", F.lit(f"/{params.load_id}/"))
    known = files.with_prefix(files.inventory(inventory.where(later | mine)), layout.search_prefix)
    own = [paths.pull_folder(layout.source_template, params, item.entity) for item in pulls]
    own = [name for name in own if folders.exists(spark, f"{layout.source_root}/{name}")]
    if not own:
        return known
    pulled = files.with_prefix(files.listing_by_tasks(spark, layout.source_root, *own), layout.search_prefix)
    return pulled.unionByName(known.join(pulled, "path", "left_anti"))


def land_files(spark: SparkSession, layout: Layout, params: LoadParams, pulls: list[EntityPull],
               listed: DataFrame, control: ControlStore, relands: bool = False, allow_rejected: bool = False,
               workers: int = 8, token: str | None = None, as_text: Collection[str] = ()) -> Landed:
    """Select the files of this load, write each entity's to its folder, and note what landed."""
    window = ChangeWindow(layout.last, params.current)
    queried = relation(spark, [{"entity": item.entity} for item in pulls], "entity string")
    pulls_in = selection.pull_folders(queried, params.source, params.country)
    found = selection.candidates(listed, window, pulls_in, params.load_id, relands)
    rule = paths.EntityRule.of(layout.source_template)
    # Listing and selection run once; all later steps read this table.
    with scratch(spark) as keep:
        found = keep(found.withColumn("fits", paths.is_mappable(F.col("path"), rule)), "selection")
        rejected, folder = found.where("taken AND NOT fits").select("path", "modified"), None
        if allow_rejected:
            folder = shared_folder(spark, "rejected")
            rejected.write.parquet(folder)
        else:
            example = rejected.select(F.count(F.lit(1)).alias("n"), F.min("path").alias("path")).first()
            if example.n:
                raise ValueError(f"{example.n} key(s) do not fit the template, e.g. {example.path}")
        targeted = selection.with_target(
            found.where("fits"), rule, layout.landing_template, layout.source_system,
            layout.cluster, params.load_id,
        )
        plan = keep(selection.landing_plan(targeted), "landing-plan", by=("entity",))
        items = landing.entity_summary(plan)
        targets = {item.entity: layout.entity_folder(params.load_id, item.entity) for item in items}
        texts = {name.lower() for name in as_text}
        done = landing.write_entities(plan, list(targets), layout.source_root, targets, workers, as_text=texts)
        pulled = plan.where("forced AND taken").select(paths.segment(F.col("path"), -3)).distinct()
        pulled_folders = frozenset(row[0] for row in pulled.collect())
    note_landed(control, params, {entity: (targets[entity], commit) for entity, commit in done.items()}, token)
    return Landed(sum(item.taken for item in items), folder, pulled_folders)


def note_landed(control: ControlStore, params: LoadParams, done: Mapping[str, tuple[str, commits.Commit]],
                token: str | None = None) -> None:
    """Add what landed, an entity a row, to the control table ``landed``."""
    rows = [
        {
            "source_cluster": params.source_cluster,
            "load_id": params.load_id,
            "entity": entity,
            "folder": folder,
            "files": len(commit.names),
            "row_count": commit.rows,
            "bytes": commit.bytes,
            "columns": commit.schema,
            "landed_at": datetime.now(timezone.utc),
        }
        for entity, (folder, commit) in done.items()
    ]
    if rows:
        control.append_rows("landed", rows, token)


def landed_since(control: ControlStore, source_cluster: str, window: ChangeWindow) -> DataFrame:
    """One row ``files``: landed files of a source whose commits fall in the window. Nothing is listed."""
    of_source = lookup(control.read("landed"), {"source_cluster": source_cluster}, ["files", "landed_at"])
    return selection.changed(of_source, "landed_at", window).agg(F.coalesce(F.sum("files"), F.lit(0)).alias("files"))


def _landed_before(spark: SparkSession, layout: Layout, params: LoadParams, control: ControlStore,
                   landed_by_others: bool) -> bool:
    """This load has landed files but not finished, or files landed since the
    last watermark."""
    if layout.last == params.current:
        return True
    window = ChangeWindow(layout.last, params.current)
    if landed_since(control, params.source_cluster, window).first().files > 0:
        return True
    if not landed_by_others:
        return False
    landed = files.listing_by_tasks(spark, layout.landing_root, layout.all_loads_prefix())
    data = selection.changed(landed, "modified", window).where(
        paths.is_data_file(F.col("path"))
    )
    return selection.summary(data, "modified", window).first().in_window > 0


@dataclass(frozen=True)
class LandedEntity:
    """A landed entity: its rows and schema, and the folder that holds them."""

    rows: int
    folder: str
    schema: T.StructType


def landed_entities(spark: SparkSession, layout: Layout, params: LoadParams, control: ControlStore,
                    landed_by_others: bool = False) -> dict[str, LandedEntity]:
    """Entities of this load, by what it noted when it wrote them: no listing, no footers.

    A load without notes, or one whose folder others write to as well, is listed and
    its footers are read.
    """
    noted = lookup(
        control.read("landed"),
        {"source_cluster": params.source_cluster, "load_id": params.load_id},
        ["source_cluster", "load_id", "entity", "folder", "row_count", "columns", "landed_at"],
    )
    known = latest(noted, ["source_cluster", "load_id", "entity"], ["landed_at"]).orderBy("entity").collect()
    if known and not landed_by_others:
        root = folders.key_root(spark, layout.landed_root)
        outside = [row.folder for row in known if folders.key_root(spark, row.folder).rpartition("/")[0] != root]
        if outside:
            raise ValueError(f"files were landed, but none below {layout.landed_root}: {outside[0]}")
        return {
            row.entity: LandedEntity(row.row_count, row.folder, T.StructType.fromJson(json.loads(row.columns)))
            for row in known
        }
    children = files.collected_children(spark, layout.landed_root)
    locations = {
        row.entity: f"{layout.landed_root}/{row.folder}"
        for row in files.entities(children).orderBy("entity").collect()
    }
    counts = {row.entity: row.row_count for row in profile.row_counts(spark, layout.landed_root, children).collect()}
    schemas = profile.schemas(spark, locations, fmt=layout.source_format)
    return {name: LandedEntity(counts[name], locations[name], schemas[name]) for name in locations}


def publish_landed(spark: SparkSession, layout: Layout, params: LoadParams, control: ControlStore,
                   landed_files: int, landed_by_others: bool = False) -> DataFrame:
    """Publish what this load landed; returns its counts."""
    found = landed_entities(spark, layout, params, control, landed_by_others)
    if landed_files and not found:
        raise ValueError(f"files were landed, but none below {layout.landed_root}")
    catalog.publish(
        spark,
        layout.database,
        [catalog.EntityTable(name, item.folder, item.schema) for name, item in found.items()],
    )
    rows = [{"entity": name, "row_count": item.rows} for name, item in found.items()]
    return relation(spark, rows, profile.COUNTS_DDL)


def rebuild(spark: SparkSession, layout: Layout, params: LoadParams, control: ControlStore,
            start: datetime, job_id: str | None = None, landed_by_others: bool = False) -> DataFrame:
    """Count and publish again what a load landed; returns the entity report."""
    counts = publish_landed(spark, layout, params, control, 0, landed_by_others)
    runs.append_details(control, counts, params.load_id, start, job_id)
    return _report(control, params, counts)


def _report(control: ControlStore, params: LoadParams, counts: DataFrame) -> DataFrame:
    active = metadata.active_entities(control.read("source_metadata"), params.source, params.country)
    return runs.entity_report(active, counts)


def _advance_watermarks(control: ControlStore, params: LoadParams, pulls: list[EntityPull],
                        landed_files: int, token: str | None = None) -> None:
    load = {"load_id": params.load_id, "logged_at": datetime.now(timezone.utc)}
    marks = [
        {"source_metadata_id": item.source_metadata_id, "source_system": params.source, "last_run_ts": item.current, **load}
        for item in pulls
    ]
    if marks:
        control.append_rows("entity_watermark", marks, token)
    if landed_files:
        mark = {"source_cluster": params.source_cluster, "last_run_start_time": params.current, **load}
        control.append_rows("file_watermark", [mark], token)

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quayside.functions import paths
from quayside.operators import selection
from quayside.sources import files
from quayside.sources.relations import relation
from tools import (
    CURRENT, HOUR, LANDING, LAST, LOAD_ID, SECOND, TEMPLATE, WINDOW, files_read, put, values,
)

# Key, change time, selected (None: rejected by the template).
CASES = [
    ("src/de/src_de_acc/a/f1.parquet", LAST, False),
    ("src/de/src_de_acc/a/f2.parquet", LAST + SECOND, True),
    ("src/de/src_de_acc/a/f3.parquet", CURRENT, True),
    ("src/de/src_de_acc/a/f4.parquet", CURRENT + SECOND, False),
    (f"src/de/src_de_ord/{LOAD_ID}/p.parquet", CURRENT + HOUR, True),
    ("src/de/src_de_ord/20220116100000/p.parquet", LAST + HOUR, False),
    ("src/de/src_de_my_ent/a/f5.parquet", LAST + SECOND, True),
    ("src/de/src_de_acc/b/f2.parquet", LAST + 2 * SECOND, True),
    ("src/de/src_de_acc_$folder$", LAST + SECOND, False),
    # A pull folder is matched as a whole path segment.
    (f"src/de/xsrc_de_ord/{LOAD_ID}/p.parquet", CURRENT + HOUR, False),
    # The load id alone does not force a folder.
    (f"src/de/src_de_acc/{LOAD_ID}/p.parquet", CURRENT + HOUR, False),
]


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("source")
    for key, modified, _ in CASES:
        put(root, key, modified, None if "$" in key else {"id": [1]})
    put(root, "src/de/src_de_acc/a/_SUCCESS", LAST + SECOND)
    put(root, "other/de/src_de_acc/a/f2.parquet", LAST + SECOND, {"id": [1]})
    return str(root)


@pytest.fixture(scope="module")
def folders(spark):
    queried = relation(spark, [{"entity": "Ord"}], "entity string")
    return selection.pull_folders(queried, "src", "de")


def test_listing(spark, tree):
    found = values(files.listing(spark, tree, "src/de/"), "path", "modified")
    assert [key for key, _ in found] == sorted((key for key, *_ in CASES), key=repr)
    assert files.listing(spark, tree).count() == len(CASES) + 1
    assert files.listing(spark, tree, "src/de/src_de_a").count() == 7
    assert files.listing(spark, tree, "missing/").count() == 0


def test_select_files(spark, tree, folders):
    found = selection.select_files(files.listing(spark, tree, "src/de/"), WINDOW, folders, LOAD_ID)
    assert values(found, "path") == sorted((key,) for key, _, kept in CASES if kept)


def test_earlier_pulls_can_be_landed_again(spark, tree, folders):
    found = selection.select_files(
        files.listing(spark, tree, "src/de/"), WINDOW, folders, LOAD_ID, relands=True
    )
    kept = [(key,) for key, _, kept in CASES if kept]
    kept.append(("src/de/src_de_ord/20220116100000/p.parquet",))
    assert values(found, "path") == sorted(kept)


def test_inventory_selects_the_same(spark, tree, folders):
    rows = [{"path": key, "modified": modified} for key, modified, _ in CASES]
    rows += [
        {"path": "src/de/src_de_acc/", "modified": LAST + SECOND},
        {"path": "src/de/src_de_acc/a/_SUCCESS", "modified": LAST + SECOND},
        {"path": "src/de/src_de_acc/_temporary/f.parquet", "modified": LAST + SECOND},
    ]
    listed = files.inventory(relation(spark, rows, "path string, modified timestamp"))
    found = selection.select_files(listed, WINDOW, folders, LOAD_ID)
    assert values(found, "path") == sorted((key,) for key, _, kept in CASES if kept)


def test_planning_drops_files_outside(spark, tree, folders):
    """Files that cannot be selected are not even opened for their status."""
    found = selection.candidates(files.listing(spark, tree, "src/de/"), WINDOW, folders, LOAD_ID)
    found.collect()
    near = [key for key, at, _ in CASES if LAST < at <= CURRENT or f"/{LOAD_ID}/" in key]
    assert files_read(found) == sum(1 for key in near if "$" not in key) < len(CASES)


def test_window_ends(spark):
    rows = [{"m": LAST}, {"m": LAST + SECOND}, {"m": CURRENT}, {"m": CURRENT + SECOND}]
    df = relation(spark, rows, "m timestamp")
    assert selection.changed(df, "m", WINDOW).count() == 2
    assert tuple(selection.summary(df, "m", WINDOW).first()) == (4, 2)
    forced = F.col("m") >= F.lit(CURRENT)
    assert selection.changed_or_forced(df, "m", WINDOW, forced).count() == 3


def test_forced_folder_is_anchored(spark):
    keys = [
        f"src/de/src_de_ord/{LOAD_ID}/p.parquet",
        f"src/de/xsrc_de_ord/{LOAD_ID}/p.parquet",
        f"src/de/src_de_ord/{LOAD_ID}/deeper/p.parquet",
        f"src_de_ord/{LOAD_ID}",
    ]
    df = relation(spark, [{"path": key} for key in keys], "path string")
    queried = relation(spark, [{"entity": "Ord"}, {"entity": "ORD"}], "entity string")
    suffixes = selection.pull_folders(queried, "Src", "DE").select(
        F.concat("pull_folder", F.lit(f"/{LOAD_ID}")).alias("suffix")
    )
    assert values(selection.in_forced_folder(df, suffixes)) == [(keys[0],)]


def test_landing_plan(spark, tree, folders):
    rule = paths.EntityRule.of(TEMPLATE)
    found = selection.candidates(files.listing(spark, tree, "src/de/"), WINDOW, folders, LOAD_ID)
    fits, rejected = selection.mappable(found, rule)
    assert rejected.count() == 0
    targeted = selection.with_target(fits, rule, LANDING, "src", "de", LOAD_ID)
    plan = selection.landing_plan(targeted)
    prefix = f"src/de/{LOAD_ID}"
    assert values(plan.where("lands"), "target_path", "path") == sorted(
        [
            (f"{prefix}/acc/f2.parquet", "src/de/src_de_acc/b/f2.parquet"),
            (f"{prefix}/acc/f3.parquet", "src/de/src_de_acc/a/f3.parquet"),
            (f"{prefix}/my_ent/f5.parquet", "src/de/src_de_my_ent/a/f5.parquet"),
            (f"{prefix}/ord/p.parquet", f"src/de/src_de_ord/{LOAD_ID}/p.parquet"),
        ]
    )


def test_rejected_keys(spark):
    rule = paths.EntityRule.of(TEMPLATE)
    df = relation(
        spark, [{"path": "f6.parquet"}, {"path": "src/de/src_de_acc/a/f"}], "path string"
    )
    fits, rejected = selection.mappable(df, rule)
    assert values(fits) == [("src/de/src_de_acc/a/f",)]
    assert values(rejected) == [("f6.parquet",)]


def test_last_wins_with_a_hot_key(spark):
    """A third of all rows share one key."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).alias("k"),
        F.pmod(F.xxhash64("id"), F.lit(50)).alias("ts"),
        "id",
    )
    best: dict = {}
    for row in df.collect():
        best[row.k] = max(best.get(row.k, (-1, -1)), (row.ts, row.id))
    found = selection.last_wins(df, ["k"], ["ts", "id"])
    assert Counter(values(found)) == Counter((k, ts, i) for k, (ts, i) in best.items())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_entities_of_a_listing(spark):
    keys = ["Ord/p1", "ord/p2", "acc/p3", "acc/deep/p4", "lone.parquet"]
    df = relation(
        spark,
        [{"path": key, "size": 1, "modified": datetime(2022, 1, 1)} for key in keys],
        "path string, size bigint, modified timestamp",
    )
    with pytest.raises(Exception, match="Ord and ord are one entity"):
        files.entities(files.children(df)).collect()
    alone = df.where("path not like 'Ord%'")
    assert values(files.entities(files.children(alone))) == [("acc", "acc"), ("ord", "ord")]
    assert values(files.children(df), "entity", "child", "is_folder", "bytes") == [
        ("acc", "acc", True, 2),
        ("lone", "lone.parquet", False, 1),
        ("ord", "Ord", True, 1),
        ("ord", "ord", True, 1),
    ]


def test_random_listing_against_brute_force(spark):
    """Selection and landing plan against the rules spelled out row by row. A
    third of the files have the same name."""
    rng = random.Random(7)
    rows = {}
    for number in range(4000):
        feed = rng.choice(["src_de_acc", "src_de_ord", "xsrc_de_ord", "src_de_inv", "src_de_a_b"])
        folder = rng.choice(["a", "b", LOAD_ID, "20220116100000", "20220118000000", "2022011"])
        name = "same.parquet" if number % 3 == 0 else f"f{rng.randrange(300)}.parquet"
        ending = rng.choice(["", "", "", "/", "_$folder$"])
        root = rng.choice(["src/de", "src/de", "src/de/deeper"])
        at = LAST + rng.randrange(-50, 90) * HOUR / 2 + rng.choice([0, 0, 1, -1]) * SECOND
        rows[f"{root}/{feed}/{folder}/{name}{ending}"] = at

    def split(path):
        parts = path.split("/")
        return parts, f"{parts[-3]}/{parts[-2]}"

    taken, expected = {}, {}
    for path, at in rows.items():
        if path.endswith(("/", "$folder$")):
            continue
        parts, tail = split(path)
        pulled = parts[-3] in ("src_de_ord", "src_de_inv")
        window = LAST < at <= CURRENT
        forced = pulled and parts[-2] == LOAD_ID
        earlier = pulled and parts[-2] == "20220116100000"
        if window or forced:
            name = parts[2].split("_", 2)
            entity = name[2] if len(name) > 2 else None
            expected[path] = (window, forced, not earlier, entity)
            if not earlier and entity is not None:
                target = f"src/de/{LOAD_ID}/{entity}/{parts[-1]}"
                taken[target] = max(taken.get(target, ""), path)
    listed = relation(
        spark, [{"path": path, "modified": at} for path, at in rows.items()],
        "path string, modified timestamp",
    )
    queried = relation(spark, [{"entity": "Ord"}, {"entity": "inv"}], "entity string")
    folders = selection.pull_folders(queried, "src", "de")
    rule = paths.EntityRule.of(TEMPLATE)
    found = selection.candidates(listed, WINDOW, folders, LOAD_ID)
    marked = found.withColumn("entity", rule.entity(F.col("path")))
    assert {
        row.path: (row.in_window, row.forced, row.taken, row.entity) for row in marked.collect()
    } == expected
    fits, _ = selection.mappable(found, rule)
    plan = selection.landing_plan(
        selection.with_target(fits, rule, LANDING, "src", "de", LOAD_ID)
    ).where("lands")
    assert {row.target_path: row.path for row in plan.collect()} == taken

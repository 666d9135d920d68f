from __future__ import annotations

import pytest

from quayside.sources import files, tree
from tools import HOUR, LAST, SECOND, plan_text, put, values

KEYS = [
    "src/de/a/f1.parquet", "src/de/a/deeper/f2.parquet", "src/de/b c+d/[x].parquet", "src/de/loose.parquet",
    "src/de/a/_hidden", "src/de/_folder/f.parquet", "src/de/_k=v/f.parquet", "src/de/.dot/f.parquet", "src/de/a/_metadata",
    "src/de/a/x_$folder$", "src/fr/f3.parquet", "top.parquet", "src/de/ä/ü.parquet", "src/de/a/part._COPYING_",
]


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    for n, key in enumerate(KEYS):
        put(root, key, LAST + n * SECOND + HOUR / 3_600_000, {"id": list(range(n + 1))})
    (root / "src/de/empty").mkdir()
    return root


@pytest.mark.parametrize("enough", [1, 3, 5, 512])
@pytest.mark.parametrize("prefixes", [(), ("src/",), ("src/de/a",), ("src/de/a/", "src/"), ("src/de/a/", "src/de/b c+d/"), ("none/",)])
def test_as_the_listing_of_the_driver(spark, root, prefixes, enough):
    columns = ("path", "modified", "size")
    found = files.listing_by_tasks(spark, str(root), *prefixes, enough=enough)
    assert values(found, *columns) == values(files.listing(spark, str(root), *prefixes), *columns)


def test_the_driver_has_folders_not_files(spark, root):
    """No file index in the plan, and partitions that name no file."""
    found = files.listing_by_tasks(spark, str(root), "src/")
    plan = plan_text(found)
    assert "FileScan" not in plan and "InMemoryFileIndex" not in plan and "BatchScan" in plan
    reader = tree.TreeReader({"root": f"file:{root}", "folders": "src", "enough": "512"})
    parts = reader.partitions()
    assert {p.path.removeprefix(f"{root}/") for p in parts} == {
        "src", "src/de", "src/fr", "src/de/a", "src/de/a/deeper", "src/de/b c+d", "src/de/_k=v", "src/de/ä", "src/de/empty",
    }
    assert not any(p.below for p in parts)
    for enough in range(1, 12):
        few = tree.TreeReader({"root": f"file:{root}", "folders": "src", "enough": str(enough)})
        rows = [b for p in few.partitions() for b in few.read(p)]
        assert sum(b.num_rows for b in rows) == found.count()
        assert len(few.partitions()) <= max(enough, 1) + 8


def test_a_root_spelled_in_another_way(spark, root):
    for form in (f"{root}/", f"file://{root}", f"file:{root}"):
        assert values(files.listing_by_tasks(spark, form, "src/fr/"), "path") == [("src/fr/f3.parquet",)]


def test_a_store_only_spark_reads_is_listed_by_the_driver(spark, root, monkeypatch):
    monkeypatch.setattr(tree, "reachable", lambda spark, root: False)
    assert "FileScan" in plan_text(files.listing_by_tasks(spark, str(root), "src/"))

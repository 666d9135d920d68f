from __future__ import annotations

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from quayside.llm import exact_dedup
from quayside.sources import folders
from quayside.sources.relations import shared_folder

DOCS = "doc_id bigint, text string, digest string, _id int, keep_id string"


def docs_of(spark):
    rows = [(n, "hot", "x", n, "y") for n in range(100)]
    rows += [(200, None, "x", 1, "y"), (201, "", "x", 2, "y"), (202, "Hot", "x", 3, "y"), (203, "hot ", "x", 4, None)]
    rows += [(204, "twice", "x", 5, "y")] * 2 + [(None, "null id", "x", 6, "y"), (None, "hot", "x", 7, "y")]
    return spark.createDataFrame(rows, DOCS), rows


def test_memberships(spark):
    docs, rows = docs_of(spark)
    found = exact_dedup.memberships(docs, exact_dedup.fresh_index(spark, 4)).collect()
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(text or "", []).append(doc_id)
    expected = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        expected += [(i, sha256(text.encode()).digest(), max(known) if known else None, len(ids)) for i in ids]
    assert sorted(map(repr, expected)) == sorted(
        repr((r.doc_id, bytes(r.digest), r.keep_id, r.group_size)) for r in found
    )


def test_rows_that_stay_are_whole_and_one_a_text(spark):
    docs, _ = docs_of(spark)
    kept = exact_dedup.keep_one(docs, exact_dedup.fresh_index(spark, 4))
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [
        (-1, "null id"), (99, "hot"), (201, ""), (202, "Hot"), (203, "hot "), (204, "twice"),
    ]
    assert exact_dedup.keep_one(docs.where("false"), exact_dedup.fresh_index(spark, 4)).count() == 0


def test_the_index_persists_and_grows(spark):
    """A later batch loses what an earlier one added; adding again changes nothing."""
    path = shared_folder(spark, "index")
    docs = spark.createDataFrame([(n, f"text {n % 5}") for n in range(20)], "doc_id bigint, text string")
    index = exact_dedup.DigestIndex(spark, path, 4)
    assert sorted(r.doc_id for r in exact_dedup.keep_one(docs, index).collect()) == [15, 16, 17, 18, 19]
    index.close()
    index = exact_dedup.DigestIndex(spark, path, 4)
    later = spark.createDataFrame([(30, "text 1"), (31, "new"), (32, "new")], "doc_id bigint, text string")
    assert [r.doc_id for r in exact_dedup.keep_one(later, index).collect()] == [32]
    assert exact_dedup.keep_one(later, index).count() == 0
    found = {(r.doc_id, r.keep_id) for r in exact_dedup.memberships(later, index).collect()}
    assert found == {(30, 16), (31, 32), (32, 32)}
    assert index.rows().count() == 6


def test_plan_has_no_python_and_merges_by_sort(spark):
    """The batch is sorted once; the runs of the index are read as sorted, without a shuffle."""
    index = exact_dedup.fresh_index(spark, 4)
    docs, _ = docs_of(spark)
    digests = docs.select("doc_id", exact_dedup.digest().alias("digest"))
    for n in range(3):
        index.add(digests.withColumn("digest", F.concat("digest", F.lit(f"{n}").cast("binary"))))
    assert [(run.first, run.last) for run in index.runs] == [(0, 0), (1, 1), (2, 2)]
    rows = digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
    left = index.without(rows, F.col("batch") != "x")
    assert left.count() == rows.count()
    text = left._jdf.queryExecution().executedPlan().toString()
    assert text.count("SortMergeJoin") == 3 and "Python" not in text and "Arrow" not in text
    assert text.count("Bucketed: true") == 3
    lines = text.splitlines()
    under = [lines[max(0, i - 4):i] for i, line in enumerate(lines) if "Bucketed: true" in line]
    assert not any(" Sort [" in line or "Exchange" in line for part in under for line in part[-3:])
    assert sum(" Sort [" in line for line in lines) == 1
    facts = index.found(digests.groupBy("digest").agg(F.count("*").alias("n")))
    text = facts._jdf.queryExecution().executedPlan().toString()
    assert text.count("Bucketed: true") == 3 and text.count(" Sort [") == 3
    index.close()


def test_runs_are_merged(spark):
    """After every append few runs are left, each with a file a bucket, and none is lost."""
    path = shared_folder(spark, "index")
    index = exact_dedup.DigestIndex(spark, path, 4)
    for n in range(17):
        docs = spark.createDataFrame([(10 * n + i, f"text {7 * n + i}") for i in range(10)], "doc_id bigint, text string")
        kept = sorted(r.doc_id for r in exact_dedup.keep_one(docs, index, batch=f"b{n}").collect())
        assert kept == [10 * n + i for i in range(10) if n == 0 or i >= 3]
        assert index.rows().count() == index.rows().select("digest").distinct().count() == 7 * n + 10
    spans = [(run.first, run.last) for run in index.runs]
    assert spans == [(0, 15), (16, 16)]
    for run in index.runs:
        names = [entry.name for entry in folders.entries(spark, run.folder) if entry.name.startswith("part-")]
        assert len(names) == len({name.split("_")[-1] for name in names}) <= 4
    assert len([entry for entry in folders.entries(spark, path) if entry.name != "_runs"]) == 2
    index.close()
    opened = exact_dedup.DigestIndex(spark, path, 4)
    assert [(run.first, run.last) for run in opened.runs] == spans and opened.rows().count() == 122
    opened.close()


@pytest.mark.parametrize("at", ["write", "note", "cleaning"])
def test_a_lost_merge_or_append_loses_nothing(spark, monkeypatch, at):
    """The fourth append is lost at its merge: opened again, the index has each digest once."""
    path = shared_folder(spark, "index")
    index = exact_dedup.DigestIndex(spark, path, 4)
    rows = [spark.createDataFrame([(n, f"{n}"), (n + 10, "same")], "doc_id bigint, text string") for n in range(4)]
    for n in range(3):
        exact_dedup.keep_one(rows[n], index, batch=f"b{n}")
    with monkeypatch.context() as patch:

        def lost(*args):
            raise RuntimeError("lost")

        plain = exact_dedup.DigestIndex._written
        if at == "write":
            patch.setattr(exact_dedup.DigestIndex, "_written", lambda self, rows, a, b: plain(self, rows, a, b) if a == b else lost())
        elif at == "note":
            put = folders.put_json
            patch.setattr(folders, "put_json", lambda s, p, v: put(s, p, v) if "/000000003-" in p else lost())
        else:
            patch.setattr(folders, "remove", lost)
        with pytest.raises(RuntimeError, match="lost"):
            exact_dedup.keep_one(rows[3], index, batch="b3")
    index.close()
    index = exact_dedup.DigestIndex(spark, path, 4)
    assert [r.doc_id for r in exact_dedup.keep_one(rows[3], index, batch="b3").collect()] == [3]
    assert sorted(r.keep_id for r in index.rows().collect()) == [0, 1, 2, 3, 10]
    index.close()


def test_a_batch_run_again_keeps_what_it_kept(spark):
    """What came after the index was lost; texts of other batches stay known."""
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (4, None)], "doc_id bigint, text string")
    more = spark.createDataFrame([(5, "b"), (6, "c"), (7, "c")], "doc_id bigint, text string")
    index = exact_dedup.fresh_index(spark, 4)

    def kept(rows, batch):
        return sorted(r.doc_id for r in exact_dedup.keep_one(rows, index, batch=batch).collect())

    assert kept(docs, "one") == kept(docs, "one") == [1, 3, 4]
    assert kept(more, "two") == kept(more, "two") == [7]
    assert kept(docs, "one") == [1, 3, 4] and kept(docs, "three") == []
    assert index.rows().count() == 4
    found = exact_dedup.keep_one(docs, index, batch="one")
    index.close()
    names = {run.table for run in index.runs}
    assert found.count() == 3 and not [t for t in spark.catalog.listTables() if t.name in names]


def test_very_long_texts(spark):
    long = "word " * 400_000
    docs = spark.createDataFrame([(1, long), (2, long), (3, long + "x")], "doc_id bigint, text string")
    index = exact_dedup.fresh_index(spark, 4)
    found = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.memberships(docs, index).collect()}
    index.close()
    assert found == {1: (2, 2), 2: (2, 2), 3: (3, 1)}

from __future__ import annotations

import zlib
from hashlib import sha256

import duckdb
import pytest

from quayside.llm import merkle, queries

SF_DIR = "/root/testdata/sf0.001"
DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree int, place string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    text = None if value is None else str(value)
    return "-" if text is None else f"{len(text.encode())}:{text}"


def record(row, text):
    return h(*map(field, (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def lowered(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def levels_of(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([h(*found[-1][i : i + 16]) for i in range(0, len(found[-1]), 16)])
    return found


def proof(levels, at):
    steps = []
    for nodes in levels[:-1]:
        first = at // 16 * 16
        steps.append((nodes[first:at], nodes[at + 1 : first + 16]))
        at //= 16
    return steps


def brute(rows):
    """All columns of op12, a row each, by plain lists."""
    trees = {}
    for row in rows:
        trees.setdefault(row["source"], []).append((row["doc_id"], record(row, row["text"]), row))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {}
    for source, members in trees.items():
        members.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1]))
        levels[source] = levels_of([leaf for _, leaf, _ in members])
    top = levels_of([levels[s][-1][0] for s in order])
    root = top[-1][0] if rows else None
    out = []
    for place, source in enumerate(order):
        for at, (doc_id, leaf, row) in enumerate(trees[source]):
            steps = proof(levels[source], at) + proof(top, place)
            tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
            node = record(row, lowered(row["text"])) if tampered else leaf
            for before, after in steps:
                node = h(*before, node, *after)
            siblings = "".join("".join(a) + "".join(b) for a, b in steps)
            out.append((doc_id, leaf, levels[source][-1][0], root, h(siblings), node, node == root))
    return out


def bag(rows):
    return sorted((tuple(row) for row in rows), key=repr)


def through(spark, tmp_path, rows):
    spark.createDataFrame(rows, DDL).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return queries.queries()["op12_merkle_manifest"](spark, str(tmp_path))


def make(doc_id, source, text="Some Text", **more):
    return {"doc_id": doc_id, "text": text, "lang": "en", "source": source, "n_chars": 4, "tree": 1, "place": "x", **more}


def test_odd_rows(spark, tmp_path):
    """Nulls anywhere, equal ids, repeated rows, lone rows, one source below and above a run."""
    rows = [make(i, "a") for i in range(300)] + [make(i, "ä", f"T {i}") for i in range(16)]
    rows += [make(i, None, None) for i in range(17)] + [make(5, "lone", "Z" * 100_000), make(7, "", "")]
    rows += [make(3, "c", "x"), make(3, "c", "y"), make(3, "c", "y"), make(None, "c"), make(None, "c", lang=None, n_chars=None)]
    found = through(spark, tmp_path, rows)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert bag(found.collect()) == bag(brute(rows))


def test_many_sources_and_no_rows(spark, tmp_path):
    rows = [make(i, f"s{i % 300}", f"Doc {i}") for i in range(900)]
    assert bag(through(spark, tmp_path / "a", rows).collect()) == bag(brute(rows))
    assert through(spark, tmp_path / "b", []).collect() == []
    lone = [make(1, "s", "Words")]
    assert bag(through(spark, tmp_path / "c", lone).collect()) == bag(brute(lone))


def test_several_sweeps(spark, tmp_path, monkeypatch):
    """Blocks of 16 nodes, so that trees of five levels take five sweeps each way."""
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 16)
    rows = [make(i, "hot" if i % 3 else f"s{i % 40}", f"Doc {i}") for i in range(6_000)]
    assert bag(through(spark, tmp_path, rows).collect()) == bag(brute(rows))


@pytest.mark.parametrize("size", [1, 2, 15, 16, 17, 255, 256, 257, 4_095, 4_096])
def test_families_of_any_size(size):
    leaves = [sha256(str(i).encode()).digest() for i in range(size)]
    found = list(merkle.families(enumerate(leaves), size, merkle.height(size)))
    expected = levels_of([leaf.hex() for leaf in leaves])
    assert sum(map(len, expected)) == size + len(found)
    for level, place, _, own in found:
        assert expected[level][place] == own.hex()
    for at, steps in merkle.suffixes(found, None, 0).items():
        for before, after in proof(expected, at):
            (i, others), steps = steps
            assert (i, others.hex()) == (len(before), "".join(before + after))
        assert steps is None


def test_a_proof_tells_what_was_changed(spark):
    docs = spark.range(5_000).select("id", (merkle.F.col("id") % 2).alias("s"), merkle.record_digest(["id"]).alias("d"))
    found = merkle.manifest(docs, "s", "id", "d", ["id"])
    good = found.select(merkle.folded(merkle.F.col("leaf")).alias("r"), "root").where("r <> lower(hex(root))")
    bad = found.select(merkle.folded(merkle.record_digest([merkle.F.col("id") + 1])).alias("r"), "root").where("r = lower(hex(root))")
    assert good.count() == bad.count() == 0


def test_as_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"create view documents as from '{SF_DIR}/documents.parquet'")
    expected = duck.execute(queries.oracle_sql()["op12_merkle_manifest"])
    columns = [c[0] for c in expected.description]
    found = queries.queries()["op12_merkle_manifest"](spark, SF_DIR)
    rows = bag(found.select(*columns).collect())
    assert rows == bag(expected.fetchall())
    docs = [row.asDict() for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert bag(found.collect()) == bag(brute(docs))
    assert {row[columns.index("verified")] for row in rows} == {True, False}

from __future__ import annotations

from hashlib import sha256

import corpus_pipeline
from quayside.llm import bpe

SF_DIR = "/root/testdata/sf0.001"


def test_each_stage_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF_DIR), "stage")
        kept[name] = docs.collect()
        if name != "bpe":
            assert docs.columns == columns
    assert [name for name, _ in corpus_pipeline.STAGES] == list(kept)
    texts = {name: [r.text or "" for r in rows] for name, rows in kept.items() if name != "bpe"}
    ids = {name: {r.doc_id for r in rows} for name, rows in kept.items()}
    assert 0 < len(texts["quality"]) and set(texts["exact dedup"]) == set(texts["quality"])
    assert len(texts["exact dedup"]) == len(set(texts["exact dedup"]))
    assert ids["near dedup"] <= ids["exact dedup"] <= ids["quality"] and ids["mixing"] <= ids["near dedup"]
    assert all(sum(r.doc_id == i for r in kept["mixing"]) <= 3 for i in ids["mixing"])
    text = {r.doc_id: (r.text or "").encode() for r in kept["mixing"]}
    assert sorted(r.doc_id for r in kept["bpe"]) == sorted(r.doc_id for r in kept["mixing"])
    known = bpe.encoder(*corpus_pipeline.BPE)
    for r in kept["bpe"]:
        assert known.decode(r.ids) == text[r.doc_id] and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == sha256(text[r.doc_id]).hexdigest()


def test_no_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF_DIR), "none")
        assert docs.count() == 0


def test_columns_with_clashing_names(spark):
    """Columns that the operators name themselves pass through every stage but the last."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    for name in ("fp", "digest", "key", "size", "score", "features", "copies", "_id", "place"):
        docs = docs.withColumn(name, docs.doc_id.cast("string"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF_DIR), "clashing")
        if name != "bpe":
            assert docs.columns == columns
            assert docs.where("fp <> cast(doc_id as string) or `_id` <> fp or size <> fp").count() == 0
    assert docs.columns[:3] == ["doc_id", "lang", "source"] and docs.count() > 0

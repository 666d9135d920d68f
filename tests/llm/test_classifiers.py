from __future__ import annotations

import os

import numpy as np
import pytest

from quayside.llm import langid, qda, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def test_scores_are_those_of_the_densities():
    chosen = np.random.default_rng(0)
    x = {0: chosen.normal(1, 2, (300, 4)), 1: chosen.normal(0, 1, (500, 4))}
    sums = {c: (float(len(v)), v.sum(axis=0), v.T @ v) for c, v in x.items()}
    model = qda.solved(sums, shrink=0.0, pool=0.0)

    def log_density(c, rows):
        cov = np.cov(x[c].T, bias=True) + qda.FLOOR * np.eye(4)
        d = rows - x[c].mean(axis=0)
        prior = np.log(len(x[c]) / 800)
        return prior - 0.5 * (np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) + np.linalg.slogdet(cov)[1])

    rows = chosen.normal(0, 2, (50, 4))
    expected = 1 / (1 + np.exp(log_density(0, rows) - log_density(1, rows)))
    assert np.allclose(model.scores(rows), expected)


def test_quality_on_what_was_held_out(spark):
    found = queries.queries()["op3_quality_discriminant"](spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found.collect())
    assert found.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 1), (1, None, 1), (None, "", 2), (3, "x" * 100_000, 3), (4, "a b\n" * 500, 4)],
        "doc_id bigint, text string, features int",
    )
    labels = spark.createDataFrame([(1, 1), (4, 0), (3, None)], "doc_id bigint, quality int")
    none = labels.where("false")
    assert qda.accepted(docs, none).count() == 5  # nothing is known: 0.5 each
    assert qda.accepted(docs, labels).columns == docs.columns
    assert qda.accepted(docs.where("false"), labels).count() == 0
    assert len(qda.statistics(None)) == len(qda.STATISTICS) and qda.statistics(None) == qda.statistics("")
    model = qda.solved({0: (1.0, np.zeros(2), np.zeros((2, 2))), 1: (1.0, np.ones(2), np.ones((2, 2)))})
    assert model.scores(np.array([[1.0, 1.0], [0.0, 0.0]]))[0] > 0.5


def test_language_on_what_was_held_out(spark):
    found = queries.queries()["op8_language"](spark, SF_DIR)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = found.join(docs, "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)
    assert found.count() == docs.count()


def test_language_of_odd_rows(spark):
    rows = [(n, "the cat sat on the mat and the dog ran", "en", 1) for n in range(30)]
    rows += [(n, "der Hund läuft über die Straße und schläft", "de", 1) for n in range(30, 60)]
    rows += [(60, None, "en", 1), (61, "", "de", 1), (62, "12 34 !?", "en", 1), (63, "der Hund schläft", None, 1), (None, "the house", "en", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int")
    model = langid.fit(docs)
    out = docs.select("doc_id", langid.predict("text", model).alias("p")).select("doc_id", "p.*").collect()
    by_id = {r.doc_id: r for r in out}
    assert len(out) == len(rows)
    assert all(by_id[n].lang == "en" for n in range(30)) and all(by_id[n].lang == "de" for n in range(30, 60))
    assert [(by_id[n].lang, by_id[n].score, by_id[n].rejected) for n in (60, 61, 62)] == [("und", 0.0, True)] * 3
    assert by_id[63].lang == "de" and by_id[None].lang == "en"
    assert by_id[0].score == pytest.approx(1, abs=1e-3) and not by_id[0].rejected
    # Text unlike all that was learnt is far from every centroid.
    assert model.predict(["qqq zzz xxx"])[2] == [True]
    empty = langid.fit(docs.where("false"))
    assert empty.predict(["the cat"]) == (["und"], [0.0], [True])


def test_centroids_against_brute_force():
    """Every centre is the mean direction of the rows nearest to it, and none is without rows."""
    chosen = np.random.default_rng(3)
    rows = np.abs(chosen.normal(size=(90, 12))) ** 3
    rows = np.concatenate((rows, rows[:5], rows[:5])).astype(np.float32)
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    centres, limits = langid.clustered(rows, 6, rounds=200)
    near = [max(range(len(centres)), key=lambda c: float(row @ centres[c])) for row in rows]
    for c, centre in enumerate(centres):
        own = rows[[i for i, n in enumerate(near) if n == c]]
        assert len(own)
        mean = own.sum(axis=0) / np.linalg.norm(own.sum(axis=0))
        assert np.allclose(mean, centre, atol=1e-3)
        likes = sorted(float(row @ centre) for row in own)
        assert limits[c] == pytest.approx(np.quantile(likes, langid.REJECTED) - langid.ROUNDING, abs=1e-4)
    same, limits = langid.clustered(np.tile(rows[:1], (7, 1)), 4)
    assert len(same) == len(limits) == 1 and limits[0] > 0.99

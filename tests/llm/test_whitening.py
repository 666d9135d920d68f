from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest

from quayside.llm import queries, whitening

SF_DIR = "/root/testdata/sf0.01"
DDL = "vec_id bigint, embedding array<float>, extra string"


def brute(vectors, components=8):
    """By fractions and one eigensolve in doubles."""
    x = [[int(np.floor(1024 * float(np.float32(c)))) + 100_000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    sums = [sum(row[i] for row in x) for i in range(dims)]
    off = [[Fraction(row[i]) - Fraction(sums[i], n) for i in range(dims)] for row in x]
    exact = [[sum(a[i] * a[j] for a in off) / n for j in range(dims)] for i in range(dims)]
    cov = np.array(exact, dtype=float)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    deviation = [sum((n * row[i] - sums[i]) ** 2 for i in range(dims)) for row in x]
    w = np.array(off, dtype=float) @ axes / np.sqrt(values)
    return n, deviation, w, values / np.trace(cov)


def table(spark, vectors, first=0):
    return spark.createDataFrame([(i, v, "own") for i, v in enumerate(vectors, first)], DDL)


def test_against_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(120, 10)) * np.linspace(1, 3, 10)).astype(np.float32).tolist()
    odd = [None, [], [None] + [0.0] * 9, [float("nan")] * 10, [float("inf")] + [0.0] * 9, [1.0, 2.0], [3e38] * 10]
    docs = table(spark, vectors).unionByName(table(spark, odd, 1_000)).repartition(7)
    n, deviation, w, explained = brute(vectors)
    found = whitening.by_component(docs).collect()
    assert len(found) == 8 * n and {r.vec_id for r in found} == set(range(n))
    signs = {}
    for r in sorted(found, key=lambda r: -abs(w[r.vec_id][r.component - 1])):
        expected = w[r.vec_id][r.component - 1]
        sign = signs.setdefault(r.component, np.sign(r.whitened * expected))
        assert r.whitened == pytest.approx(sign * expected, abs=1e-11)
        assert (r.n, int(r.deviation)) == (n, deviation[r.vec_id])
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-12)
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-12


def spectrum(values, seed=3):
    """A matrix with the given eigenvalues, made in the wide type."""
    rng = np.random.default_rng(seed)
    q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0].astype(whitening.WIDE)
    for _ in range(4):
        q = q @ (3 * np.eye(len(q), dtype=whitening.WIDE) - q.T @ q) / 2
    return (q * np.array(values, dtype=whitening.WIDE)) @ q.T


@pytest.mark.parametrize(
    "values",
    [
        [9, 7, 5, 3, 2, 1],
        [5, 5 - 1e-9, 5 - 2e-9, 1, 1 - 1e-8, 0.5],
        [5, 5 - 1e-12, 5 - 1e-6, 5 - 1e-6 - 1e-12, 1, 0],
        [3, 3, 3, 1, 1, 1],
        [1e12, 1e6, 1, 1e-3, 0, 0],
        list(np.linspace(1, 1.001, 40)),
    ],
)
def test_corrected_vectors(values):
    a = spectrum(values)
    a = (a + a.T) / 2
    found, x = whitening.eigen(a)
    size, eps = float(max(values)), float(np.finfo(whitening.WIDE).eps)
    assert np.abs(np.array(found, dtype=float) - sorted(values, reverse=True)).max() <= 1e-16 * size * 4
    assert np.abs(x.T @ x - np.eye(len(x))).max() < 64 * eps
    # What the float32 start leaves is gone: residuals are at the wide type's rounding.
    assert np.abs(a @ x - x * found).max() < 256 * eps * size


def test_start_alone_is_not_enough():
    a = spectrum([5, 5 - 1e-9, 3, 1])
    start = np.linalg.eigh(a.astype(np.float32))[1].astype(whitening.WIDE)
    values = (start * (a @ start)).sum(axis=0)
    assert np.abs(a @ start - start * values).max() > 1e-9


def test_exact_products_of_large_numbers():
    rng = np.random.default_rng(5)
    for most in (10, 10**6, 10**8, 2**61):
        rows = rng.integers(-most, most, size=(50, 3), endpoint=True)
        big = rows.astype(object)
        assert (whitening.exact_products(rows).astype(object) == big.T @ big).all()
    for value in (0, 1, -1, 2**41, -(2**42), 2**130, -(2**130)):
        assert sum(limb << whitening.LIMB * i for i, limb in enumerate(whitening.to_limbs(value))) == value


def test_large_entries_stay_exact(spark):
    """Squares that no long holds: the deviation is a decimal, and the query's null."""
    vectors = [[1e12, 0.0], [-1e12, 5.0], [3.0, 4.0]]
    found = whitening.by_component(table(spark, vectors)).collect()
    _, deviation, _, explained = brute(vectors)
    assert {r.vec_id: int(r.deviation) for r in found} == dict(enumerate(deviation))
    assert found[0].identity_error < 1e-10
    assert sorted({r.component: r.explained for r in found}.items())[0][1] == pytest.approx(explained[0])


def test_degenerate_tables(spark):
    empty = table(spark, []).drop("extra")
    assert whitening.by_component(empty).collect() == []
    one = whitening.by_component(table(spark, [[1.0, 2.0]] * 3)).collect()
    assert len(one) == 6 and {(r.whitened, r.explained, r.identity_error, int(r.deviation)) for r in one} == {(None, 0.0, None, 0)}
    flat = whitening.by_component(table(spark, [[1.0, 7.0], [2.0, 7.0], [2.0, 7.0]])).collect()
    by = {(r.vec_id, r.component): r.whitened for r in flat}
    assert by[1, 2] is None and by[1, 1] == by[2, 1] and by[0, 1] == pytest.approx(-2 * by[1, 1])
    nulls = spark.createDataFrame([(None, [1.0, 0.0], "a"), (None, [0.0, 1.0], "b")], DDL)
    assert [r.vec_id for r in whitening.by_component(nulls).collect()] == [None] * 4


def test_query_over_the_whole_table(spark):
    found = queries.queries()["op11_embedding_whitening"](spark, SF_DIR)
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    assert [f.dataType.simpleString() for f in found.select("component", "n", "deviation", "whitened").schema] == [
        "int", "bigint", "bigint", "double",
    ]
    vectors = [(r.vec_id, r.embedding) for r in rows.orderBy("vec_id").collect()]
    n, deviation, w, explained = brute([v[:] for _, v in vectors[:]]) if len(vectors) <= 600 else (None,) * 4
    got = {(r.vec_id, r.component): r for r in found.collect()}
    assert len(got) == 8 * n
    for at, (vec_id, _) in enumerate(vectors):
        r = got[vec_id, 1]
        assert (r.n, r.deviation) == (n, deviation[at]) and abs(r.whitened) == pytest.approx(abs(w[at][0]), abs=1e-9)
    assert all(got[vectors[0][0], k + 1].explained == pytest.approx(explained[k], rel=1e-9) for k in range(8))
    assert got[vectors[0][0], 1].identity_error < 1e-9

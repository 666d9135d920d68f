"""Quality of documents by a regularised quadratic discriminant.

Each text becomes a few statistics, transformed to be nearer to normal. Per class
the covariance is shrunk towards its diagonal and that towards the pooled one. The
score is the logistic of the difference of log densities, each from a Mahalanobis
distance by the inverse Cholesky factor, plus the log prior ratio.

Counts, sums and products of the labelled rows are summed by Spark over all of
them; only these sums reach the driver. Null and empty texts have the statistics
of no words and are scored like any other. Labels that are null are not learnt
from; where a class has no rows, every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.spread import learnt_from

SHRINK, POOL, FLOOR = 0.1, 0.2, 1e-3
THRESHOLD = 0.3
STATISTICS = (
    "chars", "words", "word_length", "word_spread", "upper", "digits", "exclaimed", "symbols",
    "bars", "marks", "other", "lines", "distinct_words", "repeated_lines",
)
_UPPER, _LOWER, _DIGIT = slice(65, 91), slice(97, 123), slice(48, 58)
_SYMBOLS = np.frombuffer(b"#$%&*+=<>@^_`~{}[]\\/", dtype=np.uint8)
_MARKS = np.frombuffer(b".,;:?'\"()-", dtype=np.uint8)


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a text, in the order of ``STATISTICS``."""
    text = text or ""
    data = text.encode()
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    words = data.split()
    n, chars, w = len(data) + 1.0, len(text), max(1, len(words))
    lengths = np.array([len(x) for x in words] or [0], dtype=np.float64)
    lines = [line for line in data.split(b"\n") if line]
    letters = counts[_UPPER].sum() + counts[_LOWER].sum() + 1.0

    def share(k: float, of: float) -> float:
        return float(np.sqrt(k / of))

    return [
        float(np.log1p(chars)),
        float(np.log1p(len(words))),
        float(np.log1p(lengths.mean())),
        float(np.log1p(lengths.std())),
        share(counts[_UPPER].sum(), letters),
        share(counts[_DIGIT].sum(), n),
        share(counts[33], n),
        share(counts[_SYMBOLS].sum(), n),
        share(counts[124], n),
        share(counts[_MARKS].sum(), n),
        share(counts[128:].sum(), n),
        float(np.log1p(len(lines) / w * 10)),
        share(len(set(data.lower().split())), w),
        share(len(lines) - len(set(lines)), max(1, len(lines))),
    ]


def measure(text: Column | str) -> Column:
    """``array<double>`` of statistics."""

    @F.arrow_udf("array<double>")
    def measured(texts: pa.Array) -> pa.Array:
        return pa.array([statistics(t.as_py()) for t in texts], pa.list_(pa.float64()))

    return measured(text)


@dataclass(frozen=True)
class Model:
    means: tuple[np.ndarray, ...]
    factors: tuple[np.ndarray, ...]  # inverse Cholesky factors
    offsets: tuple[float, ...]  # log prior less half the log determinant

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.means:
            return np.full(len(x), 0.5)
        bad, good = (
            offset - 0.5 * np.square((x - mean) @ factor.T).sum(axis=1)
            for mean, factor, offset in zip(self.means, self.factors, self.offsets)
        )
        return 1.0 / (1.0 + np.exp(np.clip(bad - good, -500, 500)))


def solved(sums: dict[int, tuple[float, np.ndarray, np.ndarray]], shrink: float = SHRINK, pool: float = POOL) -> Model:
    """The model from count, sum and sum of products of each class."""
    if any(sums.get(c, (0,))[0] < 1 for c in (0, 1)):
        return Model((), (), ())
    total = sum(n for n, _, _ in sums.values())
    within = {c: products / n - np.outer(s / n, s / n) for c, (n, s, products) in sums.items()}
    pooled = sum(sums[c][0] / total * within[c] for c in (0, 1))
    means, factors, offsets = [], [], []
    for c in (0, 1):
        n, s, _ = sums[c]
        mixed = (1 - pool) * within[c] + pool * pooled
        shrunk = (1 - shrink) * mixed + shrink * np.diag(np.diag(mixed)) + FLOOR * np.eye(len(s))
        lower = np.linalg.cholesky(shrunk)
        means.append(s / n)
        factors.append(np.linalg.inv(lower))
        offsets.append(float(np.log(n / total) - np.log(np.diag(lower)).sum()))
    return Model(tuple(means), tuple(factors), tuple(offsets))


def fit(rows: DataFrame, features: str = "features", label: str = "quality") -> Model:
    """Fit to all of ``rows(features, label)``; labels are 0 and 1."""
    k = len(STATISTICS)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((2, k + 1, k + 1))
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            # With a 1 behind the statistics, the products also hold sums and count.
            x = np.column_stack((x, np.ones(len(x))))
            classes = batch.column(0).to_numpy(zero_copy_only=False)
            for c in (0, 1):
                tables[c] += x[classes == c].T @ x[classes == c]
        found = pa.array(tables.reshape(2, -1).tolist(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), found], names=["label", "products"])

    learnt = rows.where(F.col(label).isin(0, 1)).select(F.col(label).cast("int").alias("label"), F.col(features))
    parts = learnt.mapInArrow(summed, "label int, products array<double>")
    sums = parts.select("label", F.posexplode("products").alias("at", "s")).groupBy("label", "at").agg(F.sum("s").alias("s"))
    tables = np.zeros((2, (k + 1) ** 2))
    for row in sums.collect():  # two classes of (k + 1) squared sums
        tables[row.label, row.at] = row.s
    tables = dict(enumerate(tables.reshape(2, k + 1, k + 1)))
    return solved({c: (t[k, k], t[k, :k], t[:k, :k]) for c, t in tables.items()})


def learn(rows: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Fit to ``rows(doc_id, features)`` that ``labels(doc_id, label)`` has, save
    those held out. An id that is labelled twice counts twice."""
    return fit(rows.where(learnt_from()).join(labels.select("doc_id", label), "doc_id"), label=label)


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, learnt from themselves."""
    model = learn(docs.select(F.col(doc_id).alias("doc_id"), measure(text).alias("features")), labels)
    return docs.where(score(measure(text), model) >= threshold)


def score(features: Column | str, model: Model) -> Column:
    """Score from 0 to 1; higher: label 1 likelier."""

    @F.arrow_udf("double")
    def scored(rows: pa.Array) -> pa.Array:
        x = rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
        return pa.array(model.scores(x))

    return scored(features)

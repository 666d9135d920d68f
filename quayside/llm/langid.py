"""Language of texts by the nearest of several centroids per language.

A text's letters become hashed n-grams of one to three UTF-8 bytes, weighted by
log count and inverse document frequency and scaled to length 1. Frequencies
count every learnt document. Centroids come from k-means by cosine within each
language, over a sample of at most ``SAMPLE`` documents that a hash of the id
picks. A text has the language of its nearest centroid; it is rejected if it is
farther from it than all but ``REJECTED`` of that centroid's own documents.

Null texts and texts without a letter are ``und`` with score 0; so is every text
if nothing could be learnt. Rows with a null language are not learnt from. Equally
near languages go by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.sources.relations import written

DIMENSIONS, LONGEST = 4_096, 3
SAMPLE, CENTROIDS, ROUNDS = 400, 4, 12
REJECTED = 0.002
UNKNOWN = "und"
#: What the likeness of a text to its own centre may differ by between batches.
ROUNDING = 1e-4
#: Texts of so many rows are held as dense vectors at once.
BLOCK = 256
_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[[b for b in range(128) if not chr(b).isalpha()]] = 32


def counts(text: str) -> np.ndarray:
    """Hashed n-gram counts of the letters of a text."""
    b = _FOLD[np.frombuffer(f" {text.lower()} ".encode(), dtype=np.uint8)]
    gap = b == 32
    b = b[~(gap & np.append(False, gap[:-1]))]
    found, gram = np.zeros(DIMENSIONS), b.copy()
    for n in range(1, LONGEST + 1):
        keys = (gram * np.uint32(2_654_435_761) + np.uint32(n)) * np.uint32(2_246_822_519)
        if n == 1:
            keys = keys[b != 32]
        found += np.bincount(keys >> np.uint32(20), minlength=DIMENSIONS)
        if n < LONGEST:
            gram = gram[:-1] * np.uint32(257) + b[n:]
    return found


def letters(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """A row per text: weighted, of length 1, or 0 without letters."""
    rows = np.array([np.log1p(counts(t)) for t in texts]).reshape(-1, DIMENSIONS) * idf
    return (rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def clustered(rows: np.ndarray, k: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Centroids by cosine, and the likeness at which each rejects."""
    at = [0]
    for _ in range(min(k, len(rows)) - 1):  # the next start is the farthest from those chosen
        at.append(int((rows @ rows[at].T).max(axis=1).argmin()))
    centres = rows[at]
    for _ in range(rounds):
        near = (rows @ centres.T).argmax(axis=1)
        sums = np.array([rows[near == c].sum(axis=0) if (near == c).any() else centres[c] for c in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    like = rows @ centres.T
    near = like.argmax(axis=1)
    held = np.unique(near)  # a centre that lost all its rows says nothing
    limits = [np.quantile(like[near == c, c], REJECTED) - ROUNDING for c in held]
    return centres[held].astype(np.float32), np.array(limits)


@dataclass(frozen=True)
class Model:
    idf: np.ndarray
    languages: tuple[str, ...]  # of each centroid
    centroids: np.ndarray
    limits: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        found, scores, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        some = [i for i, t in enumerate(texts) if letters(t)] if self.languages else []
        for at in range(0, len(some), BLOCK):
            block = some[at : at + BLOCK]
            like = vectors([texts[i] for i in block], self.idf) @ self.centroids.T
            for i, best, row in zip(block, like.argmax(axis=1), like):
                found[i] = self.languages[best]
                scores[i] = float(min(1.0, max(0.0, row[best])))
                rejected[i] = bool(row[best] < self.limits[best])
        return found, scores, rejected


def frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """Documents that have each n-gram, and the number of documents."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMENSIONS + 1, dtype=np.int64)
        for batch in batches:
            for t in batch.column(0):
                if letters(t.as_py()):
                    total[:DIMENSIONS] += counts(t.as_py()) > 0
                    total[DIMENSIONS] += 1
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], names=["df"])

    parts = docs.select(text).mapInArrow(counted, "df array<bigint>")
    sums = parts.select(F.posexplode("df").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n"))
    total = np.zeros(DIMENSIONS + 1, dtype=np.int64)
    for row in sums.collect():  # one row a dimension
        total[row.at] = row.n
    return total[:DIMENSIONS], int(total[DIMENSIONS])


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """Fit to the rows of ``docs`` whose language is not null."""
    docs = docs.where(F.col(lang).isNotNull()).select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    df, n = frequencies(docs)
    idf = np.log((1 + n) / (1 + df)) + 1
    sizes = written(docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    place = (F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    # Twice the sample is let through by the hash, so that the exact cut is over few rows.
    near = docs.join(sizes, "lang").withColumn("place", place).where(F.col("place") * F.col("n") < 2 * sample)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "tie"))

    @F.arrow_udf("array<float>")
    def vector(texts: pa.Array) -> pa.Array:
        found = [vectors([t.as_py() or ""], idf)[0] for t in texts]
        return pa.array(found, pa.list_(pa.float32()))

    rows = near.select("lang", "place", F.xxhash64("text").alias("tie"), vector("text").alias("v"))
    few = rows.withColumn("rank", rank).where(F.col("rank") <= sample).select("lang", "v")

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        rows = np.array(group["v"].tolist(), dtype=np.float32)
        rows = rows[rows.any(axis=1)]
        if not len(rows):
            return pd.DataFrame({"lang": [], "centroid": [], "limit": []})
        order = np.lexsort(rows[:, : 2 * BLOCK].T)  # arrival order must not matter
        centres, limits = clustered(rows[order], CENTROIDS)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "centroid": list(centres), "limit": limits})

    found = few.groupBy("lang").applyInPandas(centroids, "lang string, centroid array<float>, limit double")
    rows = sorted(found.collect(), key=lambda r: (r.lang, r.centroid))  # CENTROIDS a language
    return Model(
        idf,
        tuple(r.lang for r in rows),
        np.array([r.centroid for r in rows], dtype=np.float32).reshape(-1, DIMENSIONS),
        np.array([r.limit for r in rows]),
    )


def predict(text: Column | str, model: Model) -> Column:
    """``struct<lang, score, rejected>``."""

    @F.arrow_udf("lang string, score double, rejected boolean")
    def predicted(texts: pa.Array) -> pa.Array:
        found, scores, rejected = model.predict(texts.to_pylist())
        return pa.StructArray.from_arrays(
            [pa.array(found, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected, pa.bool_())],
            names=["lang", "score", "rejected"],
        )

    return predicted(text)

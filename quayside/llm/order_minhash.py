"""Document fingerprints by order MinHash.

The k-mers of a text are numbered by occurrence, so that a repeated k-mer counts
as often as it stands there. Each of ``HASHES`` hash functions selects the
``KEPT`` k-mers with the least hashes; kept in text order, they are hashed to one
element of the fingerprint. Two texts agree in an element about as often as they
share k-mers in the same order, so the likeness falls with edits and with moves.

k-mers are of code points. A shorter text is its own only k-mer; the empty text,
and null, has none and the fingerprint of no k-mers. A text with fewer than
``KEPT`` k-mers keeps what it has. Equal texts have equal fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.sources.relations import written

K, KEPT, HASHES = 8, 2, 64
#: k-mers whose hashes under all functions are held at once.
BLOCK = 2_048
_ODD = np.random.default_rng(2).integers(1 << 30, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_FLIP = np.random.default_rng(3).integers(0, 1 << 32, HASHES, dtype=np.uint32)
_FULL = np.uint32(2**32 - 1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Bits of ``x`` spread over all 64 (a finaliser of public hash functions)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbered_kmers(text: str, k: int = K) -> np.ndarray:
    """A hash of each k-mer and its occurrence number, in text order."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if not len(codes):
        return codes
    k = min(k, len(codes))
    n = len(codes) - k + 1
    kmers = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        kmers = kmers * _BASE + codes[i : i + n]
    kmers = _mix(kmers + np.uint64(k))
    # Equal k-mers side by side, in text order: the low bits carry the place.
    low = np.uint64(max(1, n.bit_length()))
    ordered = np.sort((kmers >> low << low) | np.arange(n, dtype=np.uint64))
    group = ordered >> low
    starts = np.append(True, group[1:] != group[:-1])
    at = np.arange(n)
    occurrence = np.empty(n, dtype=np.uint64)
    occurrence[(ordered & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)] = at - np.maximum.accumulate(np.where(starts, at, 0))
    return _mix(kmers + occurrence * _BASE)


def fingerprint(text: str | None, k: int = K) -> np.ndarray:
    """``HASHES`` elements of 16 bits."""
    kmers = numbered_kmers(text or "", k)
    if not len(kmers):
        return np.zeros(HASHES, dtype=np.uint16)
    least, places = [], []
    short = (kmers >> np.uint64(32)).astype(np.uint32)
    rows = np.arange(HASHES)
    for start in range(0, len(kmers), BLOCK):
        hashes = short[start : start + BLOCK] ^ _FLIP[:, None]
        hashes *= _ODD[:, None]
        for _ in range(min(KEPT, hashes.shape[1])):
            at = hashes.argmin(axis=1)
            least.append(hashes[rows, at])
            places.append(at + start)
            hashes[rows, at] = _FULL
    least, places = np.array(least).T, np.array(places).T
    if least.shape[1] > KEPT:
        best = np.argsort(least, axis=1, kind="stable")[:, :KEPT]
        places = np.take_along_axis(places, best, axis=1)
    places = np.sort(places, axis=1)
    element = np.zeros(HASHES, dtype=np.uint64)
    for at in places.T:
        element = _mix(element * _BASE + kmers[at])
    return (element >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal elements, 0 to 1."""
    return float((a == b).mean())


def fingerprints(text: Column | str) -> Column:
    """Fingerprint of each text as hexadecimal text."""

    @F.arrow_udf("string")
    def hashed(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t.as_py()).tobytes().hex() for t in texts], pa.string())

    return hashed(text)


def alike(a: Column | str, b: Column | str) -> Column:
    """Likeness of two fingerprints as ``fingerprints`` gives them."""

    @F.arrow_udf("double")
    def shared(left: pa.Array, right: pa.Array) -> pa.Array:
        def elements(x: pa.Scalar) -> np.ndarray:
            return np.frombuffer(bytes.fromhex(x.as_py()), dtype=np.uint16)

        return pa.array([likeness(elements(x), elements(y)) for x, y in zip(left, right)], pa.float64())

    return shared(a, b)


_ROW = "doc_id bigint, n_chars bigint, edited_sha256 binary, fp binary, edited_fp binary, near_edited double, near_next double"
_EDGE = ", part int, head string, tail string"


def _compared(text: str, following: str, fp: np.ndarray, next_fp: np.ndarray) -> list:
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    edited_fp = fingerprint(edited)
    return [
        len(text), sha256(edited.encode()).digest(), fp.tobytes(), edited_fp.tobytes(),
        likeness(fp, edited_fp), likeness(fp, next_fp),
    ]


def edited_by_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of the text with its latter half replaced by the
    start of the next document's, and their likeness.

    Documents are divided by ranges of ids, so a text is moved once and the next
    one is found by reading on; only the last row of a range has to meet the first
    row of the next range, and these few rows are joined by range number. Rows
    with equal ids follow each other by text.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranged = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    names = [f.split()[0] for f in (_ROW + _EDGE).split(", ")]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string()]

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last = None

        def batch_of(found: list) -> pa.RecordBatch:
            columns = list(zip(*found)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        for batch in batches:
            found = []
            for key, value in zip(batch.column(0), batch.column(1)):
                key, value = key.as_py(), value.as_py()
                fp = fingerprint(value)
                if last is None:
                    found.append([key, None, None, fp.tobytes(), None, None, None, part, value, None])
                else:
                    found.append([last[0], *_compared(last[1], value, last[2], fp), None, None, None])
                last = key, value, fp
            yield batch_of(found)
        if last is not None:
            yield batch_of([[last[0], None, None, last[2].tobytes(), None, None, None, part, None, last[1]]])

    found = written(ranged.mapInArrow(compared, _ROW + _EDGE), "order-minhash")
    inner = found.where("part is null").drop("part", "head", "tail")
    heads = found.where("head is not null").select("part", F.col("head").alias("next_text"), F.col("fp").alias("next_fp"))
    by_part = Window.orderBy("part")  # one small row a range
    following = heads.select("part").withColumn(
        "after", F.coalesce(F.lead("part").over(by_part), F.min("part").over(Window.partitionBy(F.lit(0))))
    )
    tails = (
        found.where("tail is not null").select("doc_id", "part", "tail", "fp")
        .join(following, "part").join(heads.withColumnRenamed("part", "after"), "after")
    )

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                fp, next_fp = (np.frombuffer(r[x], dtype=np.uint16) for x in ("fp", "next_fp"))
                rows.append([r["doc_id"], *_compared(r["tail"], r["next_text"], fp, next_fp)])
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names[:7])

    return inner.unionByName(tails.mapInArrow(met, _ROW))

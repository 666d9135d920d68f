"""Near duplicates by SimHash and covering locality-sensitive hashing.

A fingerprint bit is the majority of that bit over the hashes of all word
shingles. Fingerprints within ``radius`` bits are linked, and links are closed to
components.

Covering masks: give each bit position a random non-zero vector of radius + 1
bits; table ``v`` (one for each non-zero ``v``) keeps the positions whose vector
has an odd product with ``v``. The up to ``radius`` positions where two fingerprints
differ have vectors that some ``v`` is orthogonal to; that table keeps none of
them and has the two under one key: no pair is missed. Equal fingerprints are first reduced
to one. A group that is too large to compare is dealt out again, by a covering of the
bits its mask leaves free, and so on until every group is small; as a mask leaves half
of the free bits, few rounds do, and the last groups hold no more values than their
free bits can tell apart. Within a group the links are reduced to a spanning forest, so
no group emits its pairs.

Null texts are empty; texts without words have fingerprint 0 and are linked like
any other. Ids may repeat; a null id is the smallest of its component only if
there is no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.spread import join_unique, whole
from quayside.sources.relations import relation, written

SHINGLE, RADIUS, BITS, SEED = 3, 3, 64, 42
#: Groups up to this size are compared pair by pair.
COMPARED = 1_024
#: Edges a task hands on at a time.
EDGES = 10_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = (text or "").encode().lower().split()  # bytes: lowers A-Z, splits at \x20 \x09-\x0D
    if not words:
        return 0
    joined, ends = b" ".join(words), np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[: max(1, len(words) - shingle + 1)].tolist()
    stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], dtype=">u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 4_096):
        block = np.unpackbits(hashes[at : at + 4_096].view(np.uint8)).reshape(-1, BITS)
        counts += block.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)`` of every row; the fingerprint as a signed long."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(hashed, "doc_id bigint, fp bigint")


def covering(free: int, radius: int, seed: int = 7) -> list[int]:
    """Masks over the positions of ``free`` that cover every radius-``radius`` change."""
    positions = [b for b in range(BITS) if free >> b & 1]
    # Dealing the vectors round and round keeps every mask near half of the positions.
    vectors = np.random.default_rng(seed).permutation(len(positions)) % (2 ** (radius + 1) - 1) + 1
    return [
        sum(1 << b for b, m in zip(positions, vectors) if bin(int(m) & v).count("1") % 2)
        for v in range(1, 2 ** (radius + 1))
    ]


def compared(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that connect what links within ``radius`` bits connect among different values:
    each value is compared with those not yet reached."""
    edges, rest = [], values
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            at, front = front[0], front[1:]
            near = np.bitwise_count(rest ^ at) <= radius
            if near.any():
                edges += [(int(at), int(x)) for x in rest[near]]
                front, rest = np.concatenate((front, rest[near])), rest[~near]
    return edges


def signed(mask: int) -> int:
    return mask - 2**BITS if mask >= 2 ** (BITS - 1) else mask


def dealt(rows: DataFrame, radius: int, of: list[int]) -> DataFrame:
    """``rows(fp, fixed)`` under every mask that covers what ``fixed`` leaves free, once each:
    ``(fp, fixed, key)``. ``of`` are the values ``fixed`` has, at most one a mask."""
    wider = {f: sorted({signed(f | m) for m in covering(2**BITS - 1 & ~f, radius)}) for f in of}
    if len(of) == 1:
        out = rows.select("fp", F.explode(F.array(*[F.lit(m).cast("bigint") for m in wider[of[0]]])).alias("fixed"))
    else:
        table = relation(rows.sparkSession, [{"fixed": signed(f), "wider": m} for f, m in wider.items()], "fixed bigint, wider array<bigint>")
        # Two ways may come to one mask.
        out = rows.join(F.broadcast(table), "fixed").select("fp", F.explode("wider").alias("fixed")).distinct()
    return out.withColumn("key", F.col("fp").bitwiseAND(F.col("fixed")))


def links(distinct: DataFrame, radius: int = RADIUS, most: int = COMPARED) -> DataFrame:
    """``(a, b)``: a forest of links between the distinct fingerprints ``fp``.

    Groups of up to ``most`` are compared, each in a task; larger ones are dealt again,
    unless the few bits left free bound them.
    """
    edges, now, of = [], distinct.select("fp", F.lit(0).cast("bigint").alias("fixed")), [0]
    group = ["fixed", "key"]
    while True:
        rows = dealt(now, radius, of)
        sizes = written(rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "groups")
        large = (F.col("n") > most) & (BITS - F.bit_count("fixed") > 2 * (radius + 1))
        # Most keys are alone in their table; they leave before rows are brought together.
        edges.append(linked(rows.join(sizes.where(~large), group, "left_semi"), radius))
        of = [row.fixed % 2**BITS for row in sizes.where(large).select("fixed").distinct().collect()]
        if not of:
            return reduce(DataFrame.unionByName, edges).distinct()
        now = written(rows.join(sizes.where(large), group, "left_semi").select("fp", "fixed").distinct(), "large-groups")


def linked(rows: DataFrame, radius: int) -> DataFrame:
    """Edges within each group ``(fixed, key)``."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        now: tuple[int, int] | None = None
        edges: list[tuple[int, int]] = []

        def out() -> pa.RecordBatch:
            both = np.array(edges, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            edges.clear()
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            fixed, key, fp = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("fixed", "key", "fp"))
            cuts = np.flatnonzero((np.diff(fixed) != 0) | (np.diff(key) != 0)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(fp)]):
                this = (int(fixed[a]), int(key[a]))
                if this != now:
                    edges += compared(np.concatenate(held).view(np.uint64), radius) if held else []
                    held, now = [], this
                    if len(edges) >= EDGES:
                        yield out()
                held.append(fp[a:b])
        if held:
            edges += compared(np.concatenate(held).view(np.uint64), radius)
        yield out()

    ordered = rows.repartition("fixed", "key").sortWithinPartitions("fixed", "key", "fp")
    return ordered.select("fixed", "key", "fp").mapInArrow(found, "a bigint, b bigint")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is the smallest node.

    Large-star and small-star steps in turn, each written before the next; they
    halve the distances to the root and never gather a node's neighbours.
    """

    def unordered(e: DataFrame) -> DataFrame:
        return e.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def large(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return unordered(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))

    def small(e: DataFrame) -> DataFrame:
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        moved = e.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return unordered(moved.unionByName(least.select("a", F.col("m").alias("b"))))

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    now = written(unordered(edges), "edges")
    before, at = None, mark(now)
    while at != before:
        now = written(small(large(now)), "edges")
        before, at = at, mark(now)
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, fp, component_id)`` of every row; a component's id is its smallest."""
    rows = written(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    classes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("share")), "classes")
    nodes = components(links(classes.select("fp"), radius))
    rooted = classes.join(nodes, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    low = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    facts = written(rooted.join(low, "root").select("fp", "component_id", "share"), "components")
    return join_unique(rows, facts, "fp", "share")


def hexadecimal(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The row of each component that has its smallest id, whole.

    Of rows with equal ids one stays if any of them should.
    """
    groups = near_duplicates(docs, doc_id, text, shingle, radius)
    counts = groups.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.bool_or(F.col("doc_id").eqNullSafe(F.col("component_id"))).alias("stays")
    )
    # Rows that stay as they are need no partner: only the others, which are fewer, are joined.
    other = written(counts.where("NOT stays OR n > 1").select("doc_id", "stays"), "others")
    keyed = docs.select(whole(docs), F.col(doc_id).cast("bigint").alias("_id"))
    same = F.col("_id").eqNullSafe(F.col("doc_id"))
    again = keyed.join(other.where("stays"), same, "left_semi").dropDuplicates(["_id"])
    return keyed.join(other, same, "left_anti").unionByName(again).select("_whole.*")

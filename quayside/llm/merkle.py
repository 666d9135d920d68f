"""Merkle manifest of a dataset: a digest for every source and for the whole, and a
proof for every row.

A node is the SHA-256 of the digests, as lower-case hexadecimal text, of up to
``FAN`` children side by side. Nodes are labelled by the last leaf below them and then
by level, so that children come before parents. Digests go forward in time: a child
sends its digest to its parent's label, and nodes are met in the order of labels.
The messages wait in a priority queue. Its outer part is Spark's sorted shuffle, which
deals whole blocks of ``FAN ** LEVELS`` nodes to tasks; its inner part is the heap of a
task, which holds fewer than ``FAN`` messages a level. A sweep turns every block
into its top node, and the tops are the leaves of the next sweep. Then labels are met
backwards: every node gets the proof from its parent on, puts its brothers and
sisters before it and sends it to its children, down to the leaves.

Places in a source are counted by partitions of a range partitioning, so no source
is gathered in a task, and equal rows are dealt as well. Nulls come first. Rows with
equal ids stand by digest; equal rows are interchangeable. A source with one row has
that leaf as its root; without rows there is none. A proof is a list of steps, each
the number of digests to the left and the other digests of a run; a run of one is
hashed too and has no others.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from hashlib import sha256
from heapq import heappop, heappush
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quayside.sources.relations import written

FAN, LEVELS = 16, 3
BLOCK = FAN**LEVELS
BYTES = 32
#: Rows a sweep gives to Spark at a time.
ROWS_OUT = 2_048

NODES = (
    T.StructType().add("tree", T.StringType()).add("place", T.LongType())
    .add("size", T.LongType()).add("digest", T.BinaryType())
)
#: A proof, and the root of the tree it is of.
PROOF = (
    T.StructType().add("subroot", T.BinaryType()).add("places", T.ArrayType(T.IntegerType()))
    .add("others", T.ArrayType(T.BinaryType()))
)


def record_digest(columns: Sequence[Column | str]) -> Column:
    """SHA-256 of the columns in turn: ``-`` for null, else the number of bytes, ``:`` and the value."""
    texts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def parent_digest(children: Sequence[bytes]) -> bytes:
    return sha256(b"".join(children).hex().encode()).digest()


def height(size: int) -> int:
    """Levels above ``size`` leaves."""
    levels = 0
    while size > 1:
        size, levels = -(-size // FAN), levels + 1
    return levels


def shrunk(size: int, levels: int) -> int:
    """Nodes of a tree some levels up."""
    return -(-size // FAN**levels)


def families(nodes: Iterable[tuple[int, bytes]], size: int, levels: int) -> Iterator[tuple[int, int, list[bytes], bytes]]:
    """Every node above ``nodes`` in the order of labels: level, place, digests of its
    children, its own.

    ``nodes`` are places and digests of a block, in order, of a tree of ``size``.
    """
    queue: list[tuple[int, int, int, int, bytes]] = []

    def send(level: int, place: int, digest: bytes) -> None:
        to = place // FAN
        last = min((to + 1) * FAN ** (level + 1), size) - 1
        heappush(queue, (last, level + 1, to, place, digest))

    for now, digest in nodes:
        if levels:
            send(0, now, digest)
        while queue and queue[0][0] <= now:
            label, children = queue[0][:3], []
            while queue and queue[0][:3] == label:
                children.append(heappop(queue)[4])
            _, level, place = label
            own = parent_digest(children)
            yield level, place, children, own
            if level < levels:
                send(level, place, own)


Steps = tuple[tuple[int, bytes], "Steps"] | None


def suffixes(found: list[tuple[int, int, list[bytes], bytes]], above: Steps, first: int) -> dict[int, Steps]:
    """Proof of each leaf of a block, from all its families and the proof of its top.

    Families are met backwards; each sends its proof on, with the others of the run
    before it. Proofs share their ends.
    """
    if not found:
        return {first: above}
    waiting = {found[-1][:2]: above}
    for level, place, children, _ in reversed(found):
        rest = waiting.pop((level, place))
        for i in range(len(children)):
            others = b"".join(children[:i] + children[i + 1 :])
            waiting[level - 1, place * FAN + i] = ((i, others), rest)
    return {place: steps for (_, place), steps in waiting.items()}


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with ``place``, counted from 0 within their ``tree`` in the given order, and
    ``size``, the number of rows of the tree.

    Rows are sorted into ranges; a range adds what the ranges before it have of the
    tree. A window runs over the ranges of a tree only, never over its rows.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    ranged = tied.repartitionByRange("tree", *order, "_tie").sortWithinPartitions("tree", *order, "_tie").drop("_tie")
    at = F.monotonically_increasing_id()
    ranked = written(ranged.withColumn("_at", at).withColumn("_range", F.shiftright("_at", 33)), "ranked")
    parts = ranked.groupBy("tree", "_range").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("first"))
    ranges = Window.partitionBy("tree").orderBy("_range")
    offsets = parts.select(
        F.col("tree").alias("_tree"),
        F.col("_range").alias("_part"),
        (F.coalesce(F.sum("n").over(ranges.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("first")).alias("_shift"),
        F.sum("n").over(Window.partitionBy("tree")).alias("size"),
    )
    same = F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("_range") == F.col("_part"))
    joined = ranked.join(written(offsets, "ranges"), same)
    return joined.select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("place"), "size")


def in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """Rows of each block, which stand together."""
    rows = (row for batch in batches for row in batch.to_pylist())
    for key, block in groupby(rows, key=lambda row: (row["tree"], row["block"])):
        yield key, list(block)


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of a block in one partition, in order."""
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")


def in_batches(rows: Iterator[tuple], schema: T.StructType, kinds: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS_OUT:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema=kinds)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema=kinds)


def block_of(place: str = "place") -> Column:
    return F.floor(F.col(place) / BLOCK).cast("bigint").alias("block")


def climbed(nodes: DataFrame) -> DataFrame:
    """The top node of every block of ``nodes(tree, place, size, digest)``."""

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tops() -> Iterator[tuple]:
            for (tree, block), rows in in_blocks(batches):
                size = rows[0]["size"]
                levels = min(LEVELS, height(size))
                top = rows[0]["digest"]
                for *_, top in families(((r["place"], r["digest"]) for r in rows), size, levels):
                    pass
                yield tree, block, shrunk(size, levels), top

        yield from in_batches(tops(), NODES, to_arrow_schema(NODES))

    return dealt(nodes.select("tree", "place", "size", "digest", block_of())).mapInArrow(swept, NODES)


def stages(nodes: DataFrame) -> list[DataFrame]:
    """``nodes`` and the tops of one sweep after the other, down to a node a tree."""
    found = [nodes]
    while (found[-1].agg(F.max("size").alias("size")).first().size or 0) > 1:
        found.append(written(climbed(found[-1]), "tops"))
    return found


def descended(nodes: DataFrame, proofs: DataFrame, keep: str | None = None) -> DataFrame:
    """Proofs ``(tree, place, subroot, places, others)`` of ``nodes``, from those of the tops
    of their blocks, and the column ``keep`` of the nodes.

    A top's proof stands before its block like a node of place -1.
    """
    kept = nodes.schema[keep].dataType if keep else T.StructType([T.StructField("none", T.ByteType())])
    payload = F.col(keep).alias("kept") if keep else F.lit(None).cast(kept).alias("kept")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in PROOF]
    down = nodes.select("tree", block_of(), "place", "size", "digest", payload, *empty)
    none = [F.lit(None).cast(t).alias(n) for n, t in (("size", "bigint"), ("digest", "binary"), ("kept", kept))]
    first = proofs.select("tree", F.col("place").alias("block"), F.lit(-1).cast("bigint").alias("place"), *none, *PROOF.names)
    schema = T.StructType([*NODES.fields[:2], *PROOF.fields, T.StructField("kept", kept)])
    kinds = to_arrow_schema(schema)

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def leaves() -> Iterator[tuple]:
            for (tree, _), (top, *rows) in in_blocks(batches):
                above: Steps = None
                for step in reversed(list(zip(top["places"], top["others"]))):
                    above = (step, above)
                size = rows[0]["size"]
                found = list(families(((r["place"], r["digest"]) for r in rows), size, min(LEVELS, height(size))))
                proof = suffixes(found, above, rows[0]["place"])
                for row in rows:
                    places, others, rest = [], [], proof[row["place"]]
                    while rest is not None:
                        (place, other), rest = rest
                        places.append(place)
                        others.append(other)
                    yield tree, row["place"], top["subroot"], places, others, row["kept"]

        yield from in_batches(leaves(), schema, kinds)

    return dealt(down.unionByName(first)).mapInArrow(swept, schema)


def proofs_of(found: list[DataFrame], tops: DataFrame, keep: str) -> DataFrame:
    """Proofs of the first of some ``stages``, from those of the last."""
    for nodes in reversed(found[1:-1]):
        tops = written(descended(nodes, tops).drop("kept"), "proofs")
    if len(found) > 1:
        return descended(found[0], tops, keep)
    alone = tops.select(F.col("tree").alias("_tree"), "subroot", "places", "others")
    joined = found[0].join(alone, F.col("tree").eqNullSafe(F.col("_tree")))
    return joined.select("tree", "place", "subroot", "places", "others", F.col(keep).alias("kept"))


def manifest(rows: DataFrame, tree: str, order: str, digest: str, keep: Sequence[str]) -> DataFrame:
    """Columns ``keep`` of every row with ``leaf``, ``subroot``, ``root``, ``places`` and ``others``.

    ``digest`` is the leaf of a row, as bytes; the leaves of a ``tree`` stand by
    ``order``, then by digest.
    """
    leaves = rows.select(
        F.col(tree).cast("string").alias("tree"),
        F.col(order).alias("order"),
        F.col(digest).alias("digest"),
        F.struct(*[F.col(name) for name in keep], F.col(digest).alias("_leaf")).alias("own"),
    )
    found = stages(written(numbered(written(leaves, "leaves"), ["order", "digest"]).drop("order"), "numbered"))
    subroots = found[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest").withColumn("own", F.struct("source", "digest"))
    above = stages(written(numbered(written(subroots, "subroots"), ["source"]).drop("source"), "numbered"))
    top = above[-1].first()
    nothing = [F.array().cast("array<int>").alias("places"), F.array().cast("array<binary>").alias("others")]
    whole = above[-1].select("tree", "place", F.col("digest").alias("subroot"), *nothing)
    upper = written(proofs_of(above, whole, "own"), "proofs")
    tops = upper.select(F.col("kept.source").alias("tree"), F.lit(0).cast("bigint").alias("place"), F.col("kept.digest").alias("subroot"), "places", "others")
    lower = proofs_of(found, written(tops, "proofs"), "own")
    root = F.lit(bytes(top.digest) if top else None).cast("binary").alias("root")
    return lower.select(*[f"kept.{name}" for name in keep], F.col("kept._leaf").alias("leaf"), "subroot", root, "places", "others")


def hexadecimal(digest: Column | str) -> Column:
    return F.lower(F.hex(digest))


def folded(leaf: Column, places: str = "places", others: str = "others") -> Column:
    """The root, as hexadecimal text, that a leaf and its proof come to."""

    def step(node: Column, s: Column) -> Column:
        left = s["places"] * BYTES
        before = F.substring(s["others"], F.lit(1), left)
        after = F.substring(s["others"], left + 1, F.length(s["others"]) - left)
        return F.sha2(F.concat(hexadecimal(before), node, hexadecimal(after)).cast("binary"), 256)

    return F.aggregate(F.arrays_zip(F.col(places).alias("places"), F.col(others).alias("others")), hexadecimal(leaf), step)


def proof_digest(others: str = "others") -> Column:
    """SHA-256 of all other digests of a proof, as text, in turn."""
    return F.sha2(F.array_join(F.transform(others, hexadecimal), "").cast("binary"), 256)

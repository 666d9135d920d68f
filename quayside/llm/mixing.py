"""Mixing sources to target weights by entropy balancing.

Sizes are words. A document's rate is ``min(cap, exp(lam * size / mean size))``
with one ``lam`` per source: of all rates that give the source its target these
are the ones nearest to 1 in relative entropy. The dual is convex in ``lam``; it is
solved by Newton steps kept inside a bracket, each step one aggregate over the
counts by source and size. The rate's whole part is copied; the fraction is
rounded by a threshold on ``hash / fraction`` set from a histogram, so that the
words taken meet the target to within a document or a bin, and runs agree. Of a
few seeds for the hash each source takes the one that comes nearest.

Null texts and texts without words have size 0 and rate 1. A null source is a
source of its own, last in order. Rows with equal ids are rounded alike. State is
one row per source; the planner decides how it is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.spread import whole
from quayside.sources.relations import written

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
TOLERANCE = 1e-7
STEPS = 60
#: Bins of ``hash / fraction`` below ``REACH``; the threshold lies near 1.
BINS, REACH = 16_384, 4.0
SEEDS = 8


def words(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_key(source: str = "source") -> Column:
    """A key that is never null and orders like the source, null last."""
    return F.coalesce(F.concat(F.lit("0"), F.col(source)), F.lit("1"))


def targets(totals: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """``totals(key, source_size, n_docs)`` with ``target``.

    Weights repeat over the keys in order and share the sum of all sizes. Filling
    up: in order of cap by weight, a source is full if its share of what the
    fuller ones leave reaches its cap; the level of the first that is not full
    holds for all after it.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    everything = Window.partitionBy(F.lit(0))
    position = F.row_number().over(everything.orderBy("key")) - 1
    at = totals.withColumn("w", F.element_at(cycle, (position % len(weights) + 1).cast("int")))
    at = at.withColumn("full", cap * F.col("source_size"))
    ascending = everything.orderBy(F.col("full") / F.col("w"), "key")
    before = ascending.rowsBetween(Window.unboundedPreceding, -1)
    onwards = ascending.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("full").over(before), F.lit(0.0))
    at = at.withColumn("level", left / F.sum("w").over(onwards))
    open_ = F.when(F.col("level") < F.col("full") / F.col("w"), F.col("level"))
    level = F.coalesce(F.max(open_).over(everything), F.lit(float("inf")))
    target = F.least("full", level * F.col("w"))
    return at.withColumn("target", target).select("key", "source_size", "n_docs", "target")


def rate(cap: float) -> Column:
    tilted = F.least(F.lit(cap), F.exp(F.least(F.lit(30.0), F.col("lam") * F.col("size") / F.col("unit"))))
    return F.when(F.col("size") > 0, tilted).otherwise(1.0)


def balance(counts: DataFrame, goals: DataFrame, cap: float = CAP) -> DataFrame:
    """``goals`` with the dual solution ``lam`` of each source.

    ``counts(key, size, n)``; ``lam`` is infinite where the target is the cap.
    """
    unit = F.when(F.col("source_size") > 0, F.col("source_size") / F.col("n_docs")).otherwise(1.0)
    part = F.col("target") / F.col("source_size")
    goals = goals.withColumn("unit", unit)
    top = (F.col("source_size") == 0) | (F.col("target") >= cap * F.col("source_size") * (1 - TOLERANCE))
    state = written(
        goals.withColumn("done", top)
        .withColumn("lam", F.when(top, F.lit(float("inf"))).otherwise(F.lit(0.0)))
        .withColumn("lo", F.when(~top, F.least(F.lit(0.0), F.log(part)) * F.col("unit")))
        .withColumn("hi", F.when(~top, F.lit(float(cap))) * F.col("unit")),
        "dual",
    )
    for _ in range(STEPS):
        if state.where("not done").isEmpty():
            return state
        open_ = state.where("not done").select("key", "lam", "unit")
        taken = F.col("n") * F.col("size") * rate(cap)
        slope = F.when(rate(cap) < cap, taken * F.col("size") / F.col("unit")).otherwise(0.0)
        sums = (
            counts.join(open_, "key").groupBy("key")
            .agg(F.sum(taken).alias("taken"), F.sum(slope).alias("slope"))
        )
        gap = F.col("taken") - F.col("target")
        lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - gap / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > lo) & (newton < hi)
        near = (F.abs(gap) <= TOLERANCE * F.col("target")) | (hi - lo <= 1e-12 * F.abs(hi))
        step = F.when(near, F.col("lam")).when(inside, newton).otherwise((lo + hi) / 2)
        moved = state.join(sums, "key", "left")
        kept = F.col("done") | F.col("taken").isNull()
        state = written(
            moved.select(
                "key", "source_size", "n_docs", "target", "unit",
                (kept | near).alias("done"),
                F.when(kept, F.col("lam")).otherwise(step).alias("lam"),
                F.when(kept, F.col("lo")).otherwise(lo).alias("lo"),
                F.when(kept, F.col("hi")).otherwise(hi).alias("hi"),
            ),
            "dual",
        )
    left = state.where("not done").select("key").first()
    if left is not None:
        raise ArithmeticError(f"source {left.key[1:]!r} has no rates after {STEPS} steps")
    return state


def priority(doc_id: str) -> Column:
    """Place of a row's extra copy in its source's order: hash over fraction."""
    u = (F.pmod(F.xxhash64(doc_id, "seed"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    fraction = F.col("rate") - F.floor("rate")
    return F.when(fraction > 0, u / fraction)


def thresholds(sizes: DataFrame, dual: DataFrame, cap: float, doc_id: str) -> DataFrame:
    """``(key, seed, threshold)``: rows below it get an extra copy."""
    rated = sizes.join(dual, "key").withColumn("rate", rate(cap))
    rated = rated.withColumn("seed", F.explode(F.array(*[F.lit(n) for n in range(SEEDS)])))
    rated = rated.withColumn("bin", F.floor(priority(doc_id) * (BINS / REACH)))
    rated = rated.withColumn("bin", F.when(F.col("bin") < BINS, F.col("bin")).otherwise(-1))
    bins = rated.groupBy("key", "seed", "bin").agg(
        F.sum(F.col("size") * F.floor("rate")).alias("whole"),
        F.sum(F.when(F.col("bin") >= 0, F.col("size")).otherwise(0)).alias("extra"),
    )
    bins = bins.join(dual.select("key", "target"), "key")
    source = Window.partitionBy("key", "seed")
    taken = F.sum("whole").over(source) + F.sum("extra").over(source.orderBy("bin"))
    none = F.sum("whole").over(source)
    edge = (F.col("bin") + 1) * (REACH / BINS)

    def off(words_taken: Column, at: Column) -> Column:
        return F.struct(F.abs(words_taken - F.col("target")).alias("off"), "seed", at.alias("threshold"))

    best = F.least(off(taken, edge), off(none, F.lit(0.0)))
    return (
        bins.withColumn("best", best).groupBy("key").agg(F.min("best").alias("best"))
        .select("key", "best.seed", "best.threshold")
    )


def sized(docs: DataFrame, text: str = "text", source: str = "source") -> DataFrame:
    return docs.withColumn("size", words(text)).withColumn("key", source_key(source))


def plan(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP, doc_id: str = "doc_id"
) -> DataFrame:
    """One row per source of ``sizes(doc_id, size, key)``: target, dual, threshold."""
    counts = written(sizes.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")), "counts")
    totals = counts.groupBy("key").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs")
    )
    dual = balance(counts, targets(totals, weights, cap), cap)
    dual = dual.select("key", "source_size", "target", "unit", "lam")
    return written(dual.join(thresholds(sizes, dual, cap, doc_id), "key"), "mix")


def mixed(sizes: DataFrame, mix: DataFrame, cap: float = CAP, doc_id: str = "doc_id") -> DataFrame:
    """``sizes`` with ``source_size``, ``target``, ``rate`` and ``copies``."""
    rated = sizes.join(mix, "key").withColumn("rate", rate(cap))
    more = F.coalesce((priority(doc_id) < F.col("threshold")).cast("long"), F.lit(0))
    return rated.withColumn("copies", F.floor("rate") + more).drop("key", "unit", "lam", "seed", "threshold")


def copied(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with each row as often as the mix takes it."""
    rows = docs.select(
        whole(docs), F.col(doc_id).alias("doc_id"), words(text).alias("size"), source_key(source).alias("key")
    )
    sizes = written(rows.drop("_whole"), "sizes")
    taken = mixed(rows, plan(sizes))
    each = F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int")))
    return taken.select("_whole", each.alias("taken")).select("_whole.*")

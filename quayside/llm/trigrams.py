"""Boolean trigram queries: what a text must hold for a regular expression to match.

A query is a set of alternatives, each a set of trigrams that must all be there. It is
derived from the parsed expression: parts that match few texts are spelled out and
joined as long as they stand side by side; any other part ends the run, and the
trigrams of its spellings become mandatory. Letters are lower-cased, as the index is.
A query is necessary, never sufficient. ``ANYTHING`` asks for nothing: such an
expression has no mandatory trigram.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Query = frozenset[frozenset[str]]

ANYTHING: Query = frozenset([frozenset()])
#: Spellings of a part, alternatives of a query and characters of a class that are followed.
FOLLOWED = 64
REPEATS = ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT")
#: Trigrams that share a mask.
WORD = 62


def least(alternatives: Iterable[frozenset[str]]) -> Query:
    """Alternatives without those that ask for more than another."""
    found = set(alternatives)
    return frozenset(a for a in found if not any(b < a for b in found))


def both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > FOLLOWED:
        return min(a, b, key=len)  # asks for less, and still for nothing unneeded
    return least(x | y for x, y in product(a, b))


def spelled(texts: Iterable[str]) -> Query:
    """One of the texts is there."""
    return least(frozenset(t[i : i + 3] for i in range(len(t) - 2)) for t in texts)


def query(pattern: str) -> Query:
    texts, needed = _sequence(re._parser.parse(pattern))
    return needed if texts is None else spelled(texts)


Part = tuple[set[str] | None, Query]


def _sequence(parts: Sequence) -> Part:
    run, needed, whole = {""}, ANYTHING, True
    for kind, value in _unrolled(parts):
        texts, own = _part(kind, value)
        if texts is not None and len(texts) * len(run) <= FOLLOWED:
            run = {a + b for a, b in product(run, texts)}
            continue
        needed, whole = both(both(needed, spelled(run)), own), False
        run = {""} if texts is None else texts
    return (run, ANYTHING) if whole else (None, both(needed, spelled(run)))


def _unrolled(parts: Sequence) -> Iterator[tuple[str, object]]:
    """Parts with up to three of the copies a repeat must have before its rest."""
    for kind, value in parts:
        if str(kind) in REPEATS and value[0] and value[:2] != (1, 1):
            low, high, inner = value
            for _ in range(min(low, 3)):
                yield from _unrolled(inner)
            if low != high or low > 3:
                yield "REST", None
        else:
            yield str(kind), value


def _part(kind: str, value) -> Part:
    if kind == "LITERAL":
        return ({chr(value).lower()}, ANYTHING) if value < 128 else (None, ANYTHING)
    if kind == "IN":
        return _characters(value), ANYTHING
    if kind == "AT":
        return {""}, ANYTHING
    if kind == "SUBPATTERN":
        return _sequence(value[-1])
    if kind == "BRANCH":
        found = [_sequence(branch) for branch in value[1]]
        texts = None if any(t is None for t, _ in found) else set().union(*[t for t, _ in found])
        if texts is not None and len(texts) <= FOLLOWED:
            return texts, ANYTHING
        alternatives = [q if t is None else spelled(t) for t, q in found]
        return None, least(a for q in alternatives for a in q)
    if kind in REPEATS and value[1] == 1:
        texts, needed = _sequence(value[2])
        if value[0] == 1:
            return texts, needed
        return None if texts is None else texts | {""}, ANYTHING
    return None, ANYTHING


def _characters(items: Sequence) -> set[str] | None:
    found: set[str] = set()
    for kind, value in items:
        if str(kind) not in ("LITERAL", "RANGE"):
            return None
        first, last = (value, value) if str(kind) == "LITERAL" else value
        if last > 127:
            return None
        found |= {chr(c).lower() for c in range(first, last + 1)}
    return found if len(found) <= FOLLOWED // 4 else None


def postings(docs: DataFrame, key: str, text: str, vocabulary: Sequence[str] | None = None) -> DataFrame:
    """The inverted index ``(trigram, key, n)``: rows with ``key`` whose lower-cased text has
    the trigram. ``key`` must follow from the text; ``n`` counts rows of one text.

    With a ``vocabulary`` only its trigrams are looked for, each by one search of
    the text; without, every trigram of every text is posted.
    """
    lowered = docs.select(F.col(key).alias("key"), F.lower(F.col(text)).alias("_lowered"))
    if vocabulary is None:
        there = F.array_distinct(F.regexp_extract_all("_lowered", F.lit("(?s)(?=(...))"), F.lit(1)))
    else:
        held = [F.when(F.contains("_lowered", F.lit(t)), F.lit(t)) for t in vocabulary]
        there = F.array_compact(F.array(*held)) if held else F.array().cast("array<string>")
    posted = lowered.select(F.explode(there).alias("trigram"), "key")
    return posted.groupBy("trigram", "key").agg(F.count(F.lit(1)).alias("n")).sortWithinPartitions("trigram", "key")


def vocabulary_of(queries: Iterable[Query]) -> list[str]:
    return sorted({t for q in queries for alternative in q for t in alternative})


def candidates(index: DataFrame, queries: Sequence[Query]) -> DataFrame:
    """``(key, share, hits)``: bit ``i`` of ``hits`` tells if the postings of a key meet query ``i``.

    Postings of the trigrams asked for are brought together by key, as bits of a few
    masks, so all intersections are one aggregate and no list of a frequent
    trigram is ever in one task. Queries that ask for nothing have no bit.
    """
    asked = vocabulary_of(queries)
    places = {t: divmod(i, WORD) for i, t in enumerate(asked)}
    masks = []
    for word in range(-(-len(asked) // WORD)):
        bit = F.lit(0).cast("bigint")
        for t in asked[word * WORD : (word + 1) * WORD]:
            bit = F.when(F.col("trigram") == t, F.lit(1 << places[t][1]).cast("bigint")).otherwise(bit)
        masks.append(F.bit_or(bit).alias(f"_m{word}"))
    found = index.where(F.col("trigram").isin(asked)).groupBy("key").agg(F.max("n").alias("share"), *masks)

    def all_of(alternative: frozenset[str]) -> Column:
        met = F.lit(True)
        for word in {places[t][0] for t in alternative}:
            wanted = F.lit(sum(1 << places[t][1] for t in alternative if places[t][0] == word)).cast("bigint")
            met = met & (F.col(f"_m{word}").bitwiseAND(wanted) == wanted)
        return met

    hits = F.lit(0).cast("bigint")
    for i, q in enumerate(queries):
        if q == ANYTHING:
            continue
        met = F.lit(False)
        for alternative in q:
            met = met | all_of(alternative)
        hits = hits.bitwiseOR(F.when(met, F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint"))
    return found.select("key", "share", hits.alias("hits")).where("hits <> 0")

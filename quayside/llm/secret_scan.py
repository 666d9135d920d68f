"""Secrets in texts, found by regular expressions over a trigram inverted index.

Every rule's expression gives a Boolean trigram query (``trigrams.py``). The index
posts the trigrams of each text, intersected postings give the candidates of a rule,
and only candidates are matched. A rule without mandatory trigrams matches every
text. All of it is built-in functions; texts are never handed to Python.

Matches of a rule are leftmost and do not overlap; different rules may overlap. A
match counts if the rule's group has at least ``least`` characters. Places are code
points from 0, ends exclusive. Null texts are empty and have no spans. Equal texts
share their postings and have equal spans; a text with a third of all rows is
joined by broadcast. Ids may be null or repeat, other columns do not matter.

Texts are keyed by a 64-bit hash in the index; texts that share one are only
candidates more often than they need to be.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm import trigrams
from quayside.llm.spread import join_unique
from quayside.sources.relations import written


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Expressions keep to what Java, Python and RE2 read alike."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# Words before a secret that is assigned to them.
_WORDS = "|".join([*map(either_case, ("password", "passwd", "secret", "token")), f"{either_case('api')}_?{either_case('key')}"])

#: Kinds every scan has to find. A run of hexadecimal digits, or of capitals and digits
#: from AKIA on, has no match within it, so its least length can stand in the pattern.
BASE = (
    Rule("assign", rf"""({_WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Public formats of further credentials.
FURTHER = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("login", r"://[^\x00-\x20:/@]+:[^\x00-\x20:/@]+@"),
)
RULES = BASE + FURTHER
#: Running totals are made in blocks, since appending to an array copies it.
TOGETHER = 256


def _totals(steps: Column, start: Column | int = 0) -> Column:
    """Running totals of a short array."""
    begin = F.lit(start) if isinstance(start, int) else start
    none = F.struct(begin.cast("int").alias("sum"), F.array().cast("array<int>").alias("all"))
    add = lambda held, x: F.struct((held["sum"] + x).alias("sum"), F.array_append(held["all"], held["sum"] + x).alias("all"))
    return F.aggregate(steps, none, add, lambda held: held["all"])


def running(steps: Column) -> Column:
    """Running totals of an array of whole numbers, in time linear but for its blocks."""
    number = F.ceil(F.size(steps) / TOGETHER).cast("int")
    starts = F.transform(F.sequence(F.lit(0), number - 1), lambda i: i * TOGETHER + 1)
    blocks = F.transform(starts, lambda at: F.slice(steps, at, TOGETHER))
    sums = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x))
    before = F.slice(F.concat(F.array(F.lit(0)), _totals(sums)), F.lit(1), number)
    many = F.flatten(F.zip_with(blocks, before, lambda b, start: _totals(b, start)))
    return F.when(F.size(steps) <= TOGETHER, _totals(steps)).otherwise(many)


def matches(text: Column, rule: Rule, rank: int) -> Column:
    """``array<struct<start, rank, kind, end>>`` of the matches that count.

    The parts of the text between matches and the matches themselves give the places.
    """
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    named = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    sizes = F.transform(found, F.char_length)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.char_length)
    earlier = F.concat(F.array(F.lit(0)), F.slice(sizes, F.lit(1), F.greatest(F.size(found) - 1, F.lit(0))))
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), earlier, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))
    at = F.arrays_zip(running(steps).alias("start"), sizes.alias("size"), named.alias("named"))
    counted = F.filter(at, lambda m: F.char_length(m["named"]) >= rule.least)
    return F.transform(
        counted,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), (m["start"] + m["size"]).alias("end")
        ),
    )


SPANS = "array<struct<start: int, rank: int, kind: string, end: int>>"


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Columns ``keep`` of every row with ``spans``, by start and then in the order of the rules."""
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(*keep, content.alias("_text"), F.xxhash64(content).alias("_key"))
    queries = [trigrams.query(rule.pattern) for rule in rules]
    index = written(trigrams.postings(rows, "_key", "_text", trigrams.vocabulary_of(queries)), "postings")
    facts = written(trigrams.candidates(index, queries), "candidates").withColumnRenamed("key", "_key")
    marked = join_unique(rows, facts, "_key", "share")
    none = F.array().cast(SPANS)
    found = []
    for i, (rule, query) in enumerate(zip(rules, queries)):
        full = query == trigrams.ANYTHING
        candidate = F.rlike("_text", F.lit(rule.pattern)) if full else F.coalesce(F.col("hits"), F.lit(0)).bitwiseAND(1 << i) != 0
        found.append(F.when(candidate, matches(F.col("_text"), rule, i).cast(SPANS)).otherwise(none))
    return marked.select(*keep, F.array_sort(F.concat(*found)).alias("spans"))


def count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def listed(spans: Column | str) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

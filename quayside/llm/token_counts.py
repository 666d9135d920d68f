"""Tokens of whole documents attributed to their sections.

A document is encoded once, as a whole, so counts are those of training and add
up. Token byte offsets become character spans; they are joined with the sections'
character intervals, both in order, by bisection. A token that crosses a boundary
goes to one section by an explicit rule:

- ``start``: the section of its first character,
- ``end``: the section of its last character,
- ``largest``: the section with most of its characters, the first of equals.

A token whose place lies in no section is counted in section -1, so the sum over
sections is the document's count. A token that is part of a character lies at that
character. Null and empty texts have one section, 0, from 0 to 0 without tokens,
and so have documents with no sections besides any tokens outside. A token crosses if it
is neither within one section nor outside of all. Sections out of order or overlapping fail.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.bpe import load_ranks

RULES = ("start", "end", "largest")
OUTSIDE = -1
COLUMNS = "section bigint, start_char bigint, end_char bigint, n_tokens bigint, n_crossing bigint"


@lru_cache(maxsize=2)
def encoding(path: str, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding, and the length in bytes of each id."""
    ranks = load_ranks(path)
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    lengths[list(ranks.values())] = [len(token) for token in ranks]
    return tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


def spans(text: str, ids: list[int], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last character of each token."""
    sizes = lengths[ids]
    ends = np.cumsum(sizes)
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    character = np.cumsum((data & 0xC0) != 0x80) - 1
    return character[ends - sizes], character[ends - 1]


def lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of lines; a line holds the line feed that ends it."""
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    ends = np.flatnonzero(codes == 10) + 1
    if not len(ends) or ends[-1] < len(codes):
        ends = np.append(ends, len(codes))
    return np.append(0, ends[:-1]), ends


def allocated(
    first: np.ndarray, last: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token, or ``OUTSIDE``, and whether it crosses a boundary.

    Sections are in order and do not overlap.
    """

    def section(place: np.ndarray) -> np.ndarray:
        at = np.searchsorted(starts, place, side="right") - 1
        return np.where((at >= 0) & (place < ends[np.maximum(at, 0)]), at, OUTSIDE) if len(starts) else np.full(len(place), OUTSIDE)

    head, tail = section(first), section(last)
    # A token with both ends outside may still have whole sections within it.
    filled = starts[ends > starts]
    within = np.searchsorted(filled, last, side="right") > np.searchsorted(filled, first, side="left")
    crosses = (head != tail) | ((head == OUTSIDE) & within)
    if rule == "start":
        return head, crosses
    if rule == "end":
        return tail, crosses
    chosen = head.copy()
    for i in np.flatnonzero(last > first):
        low = max(0, int(np.searchsorted(ends, first[i], side="right")))
        high = int(np.searchsorted(starts, last[i], side="right"))
        shared = np.minimum(ends[low:high], last[i] + 1) - np.maximum(starts[low:high], first[i])
        outside = last[i] + 1 - first[i] - shared.sum()
        if len(shared) and shared.max() >= outside:
            chosen[i] = low + int(shared.argmax())
            crosses[i] = shared.max() < last[i] + 1 - first[i]
        else:
            chosen[i] = OUTSIDE
            crosses[i] = shared.sum() > 0
    return chosen, crosses


def counts(text: str, starts: np.ndarray, ends: np.ndarray, known: tuple, rule: str = "start") -> np.ndarray:
    """Rows of section, start, end, tokens and crossing tokens."""
    if (starts > ends).any() or (starts[1:] < ends[:-1]).any():
        raise ValueError("sections must be in order and must not overlap")
    encoder, lengths = known
    first, last = spans(text, encoder.encode_ordinary(text), lengths) if text else (np.zeros(0, int),) * 2
    at, crosses = allocated(first, last, starts, ends, rule)
    n = len(starts)
    tokens = np.bincount(at + 1, minlength=n + 1)
    crossing = np.bincount(at + 1, weights=crosses, minlength=n + 1).astype(np.int64)
    rows = np.column_stack((np.arange(n), starts, ends, tokens[1:], crossing[1:]))
    if tokens[0]:
        rows = np.vstack((rows, [OUTSIDE, 0, 0, tokens[0], crossing[0]]))
    return rows if len(rows) else np.array([[0, 0, 0, 0, 0]])


def by_section(
    docs: DataFrame, path: str, pattern: str, sections: str | None = None, rule: str = "start",
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(doc_id, section, start_char, end_char, n_tokens, n_crossing)``.

    ``sections`` names a column ``array<struct<start, end>>`` of character
    intervals in order; without it, sections are lines. Null sections are none.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {', '.join(RULES)}")
    kind = "array<struct<start: bigint, end: bigint>>"
    given = F.lit(None).cast(kind) if sections is None else F.col(sections).cast(kind)
    by_line = sections is None
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), given.alias("given"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoding(path, pattern)
        for batch in batches:
            found = []
            for t, s in zip(batch.column(1), batch.column(2)):
                t = t.as_py() or ""
                if by_line:
                    starts, ends = lines(t)
                else:
                    given = s.as_py() or []
                    starts, ends = (np.array([x[k] for x in given], dtype=np.int64) for k in ("start", "end"))
                found.append(counts(t, starts, ends, known, rule))
            sizes = [len(x) for x in found]
            table = np.concatenate(found) if found else np.zeros((0, 5), dtype=np.int64)
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(len(found)), sizes)))
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(np.ascontiguousarray(c), pa.int64()) for c in table.T)],
                names=["doc_id", "section", "start_char", "end_char", "n_tokens", "n_crossing"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(counted, f"doc_id {id_type}, {COLUMNS}")


def field_text(*fields: str, separator: str = "\n") -> tuple:
    """Text and sections of a document made of several columns, null as empty.

    A section is a field with the separator after it.
    """
    values = [F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields]
    width = len(separator)
    ends = [sum((F.char_length(v) + width for v in values[: i + 1]), F.lit(0)) - (width if i == len(values) - 1 else 0) for i in range(len(values))]
    starts = [F.lit(0), *ends[:-1]]
    made = [F.struct(a.cast("bigint").alias("start"), b.cast("bigint").alias("end")) for a, b in zip(starts, ends)]
    return F.concat_ws(separator, *values), F.array(*made)

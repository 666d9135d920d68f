from __future__ import annotations

import os

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from quayside.llm import bpe, queries, token_counts

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def test_sections_add_up_to_whole_documents(spark):
    path, pattern = queries.BPE
    whole = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    found = {}
    for r in queries.queries()["op10_token_counts"](spark, SF_DIR).collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + r.n_tokens
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert found == {r.doc_id: len(whole.encode_ordinary(r.text or "")) for r in docs}


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections_of_odd_rows(spark, rule):
    rows = [(1, None, 7), (2, "", 8), (3, "one\ntwo é\U0001f600\n\nthree", 9), (3, "one\ntwo é\U0001f600\n\nthree", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, section int")
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    found = token_counts.by_section(docs, path, pattern, rule=rule).collect()
    assert [(r.section, r.start_char, r.end_char, r.n_tokens) for r in found if r.doc_id in (1, 2)] == [(0, 0, 0, 0)] * 2
    whole = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    assert sum(r.n_tokens for r in found if r.doc_id == 3) == 2 * len(whole.encode_ordinary(rows[2][1]))
    assert token_counts.by_section(docs.where("false"), path, pattern, rule=rule).count() == 0


def brute(text, sections, rule, encoder):
    """Section of every character, then of every token, one by one."""
    of = [-1] * len(text)
    for i, (a, b) in enumerate(sections):
        of[a:b] = [i] * (b - a)
    tokens, crossing, at = {}, {}, 0
    place = [c for c, ch in enumerate(text) for _ in ch.encode()]
    for token in encoder.encode_ordinary(text):
        size = len(encoder.decode_single_token_bytes(token))
        chars = sorted(set(place[at : at + size]))
        at += size
        held = [of[c] for c in chars]
        if rule == "largest":
            share = {s: held.count(s) for s in held}
            best = max(share[s] for s in share if s >= 0) if any(s >= 0 for s in share) else 0
            chosen = min(s for s in share if s >= 0 and share[s] == best) if best and best >= share.get(-1, 0) else -1
        else:
            chosen = held[0] if rule == "start" else held[-1]
        tokens[chosen] = tokens.get(chosen, 0) + 1
        crossing[chosen] = crossing.get(chosen, 0) + (len(set(held)) > 1)
    return tokens, crossing


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_allocation_against_brute_force(rule):
    """Sections with gaps, empty ones, and some within a token."""
    import random

    path, pattern = queries.BPE
    known = token_counts.encoding(path, pattern)
    chosen = random.Random(8)
    for _ in range(600):
        text = "".join(chosen.choices(["the ", "  ", "information", "é", "\U0001f600", "x", "\n", " international", "ab"], k=chosen.randrange(1, 12)))
        cuts = sorted(chosen.choices(range(len(text) + 1), k=2 * chosen.randrange(0, 6)))
        sections = list(zip(cuts[::2], cuts[1::2]))
        starts, ends = (np.array([x[k] for x in sections], dtype=np.int64) for k in (0, 1))
        rows = token_counts.counts(text, starts, ends, known, rule)
        tokens, crossing = brute(text, sections, rule, known[0])
        assert {int(r[0]): int(r[3]) for r in rows if r[3]} == tokens, (text, sections)
        assert {int(r[0]): int(r[4]) for r in rows if r[3]} == crossing, (text, sections)


def test_sections_out_of_order_are_refused():
    known = token_counts.encoding(*queries.BPE)
    for starts, ends in (([0, 2], [3, 4]), ([3, 0], [4, 2]), ([2], [1])):
        with pytest.raises(ValueError, match="in order"):
            token_counts.counts("abcdef", np.array(starts), np.array(ends), known)


def test_sections_of_fields(spark):
    """Fields of a row as sections of its text; null fields are empty."""
    docs = spark.createDataFrame([(1, "title é", "the body", "x"), (2, None, "b", None), (3, None, None, None)], "doc_id int, a string, b string, text string")
    text, sections = token_counts.field_text("a", "b")
    made = docs.select("doc_id", text.alias("text"), sections.alias("parts"))
    found = token_counts.by_section(made, *queries.BPE, sections="parts").orderBy("doc_id", "section").collect()
    assert [(r.doc_id, r.section, r.start_char, r.end_char) for r in found] == [
        (1, 0, 0, 8), (1, 1, 8, 16), (2, 0, 0, 1), (2, 1, 1, 2), (3, 0, 0, 1), (3, 1, 1, 1),
    ]

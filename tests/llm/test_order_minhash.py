from __future__ import annotations

from hashlib import sha256

import numpy as np
import pytest

from quayside.llm import order_minhash

DOCS = "doc_id bigint, text string, part int, head string, fp int"


def test_fingerprints_follow_order():
    words = [f"word{n}" for n in np.random.default_rng(5).permutation(400)]
    text = " ".join(words)
    moved = " ".join(words[200:] + words[:200])
    shuffled = " ".join(sorted(words))
    own = order_minhash.fingerprint(text)
    assert order_minhash.likeness(own, order_minhash.fingerprint(text)) == 1
    near, far = (order_minhash.likeness(own, order_minhash.fingerprint(t)) for t in (moved, shuffled))
    assert 1 > near > far  # the same k-mers but for some edges, in another order
    assert order_minhash.likeness(own, order_minhash.fingerprint(text + " end")) > 0.8


def test_kmers_are_numbered_by_occurrence():
    kmers = order_minhash.numbered_kmers("ab" * 20, 2)
    assert len(set(kmers.tolist())) == len(kmers) == 39
    again = order_minhash.numbered_kmers("ab" * 10, 2)
    assert again.tolist() == kmers[:19].tolist()
    assert len(order_minhash.numbered_kmers("abc", 8)) == 1 and len(order_minhash.numbered_kmers("")) == 0


def brute(rows):
    rows = sorted((i, t or "") for i, t in rows)
    out = []
    for n, (doc_id, text) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, other, after = map(order_minhash.fingerprint, (text, edited, following))
        out.append((
            doc_id, len(text), sha256(edited.encode()).digest(), own.tobytes(), other.tobytes(),
            order_minhash.likeness(own, other), order_minhash.likeness(own, after),
        ))
    return out


def check(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], DOCS)
    found = order_minhash.edited_by_next(docs).collect()
    assert sorted(tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in found) == sorted(brute(rows))


def test_edited_by_the_next_document(spark):
    texts = ["", None, "é" * 31, "short", "a b c " * 500, "\U0001f600 wide " * 9]
    check(spark, [(n * 3, texts[n % len(texts)]) for n in range(60)] + [(9, "repeated id"), (9, "repeated id")])


def test_one_document_is_its_own_next(spark):
    check(spark, [(7, "alone in the world")])
    assert order_minhash.edited_by_next(spark.createDataFrame([], DOCS)).count() == 0


def slow_fingerprint(text):
    """Every function's least occurrence-numbered k-mers, by sorting all of them."""
    kmers = [int(x) for x in order_minhash.numbered_kmers(text)]
    full, out = 2**64, []
    mix = lambda x: int(order_minhash._mix(np.array([x % full], dtype=np.uint64))[0])
    for odd, flip in zip(order_minhash._ODD.tolist(), order_minhash._FLIP.tolist()):
        order = sorted(range(len(kmers)), key=lambda i: ((((kmers[i] >> 32) ^ flip) * odd) % 2**32, i))
        element = 0
        for i in sorted(order[: order_minhash.KEPT]):
            element = mix(element * int(order_minhash._BASE) + kmers[i])
        out.append(element >> 48)
    return out


@pytest.mark.parametrize("text", ["a", "short", "abcabcabcabcabc", "the cat sat on the mat " * 40, "é🙂" * 30, "ab" * 3_000])
def test_fingerprint_against_brute_force(text):
    assert order_minhash.fingerprint(text).tolist() == slow_fingerprint(text)
    # Numbered k-mers are equal where the k-mer and its occurrence are.
    k = min(order_minhash.K, len(text))
    seen, named = {}, []
    for i in range(len(text) - k + 1):
        kmer = text[i : i + k]
        seen[kmer] = seen.get(kmer, 0) + 1
        named.append((kmer, seen[kmer]))
    found = order_minhash.numbered_kmers(text).tolist()
    assert len(set(zip(named, found))) == len(set(named)) == len(set(found))


def test_very_long_texts_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "x" * 300_000), (None, None), (5, "y z " * 100_000)], "doc_id bigint, text string")
    found = order_minhash.edited_by_next(docs).collect()
    assert len(found) == 3 and sorted(r.n_chars for r in found) == [0, 300_000, 400_000]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)

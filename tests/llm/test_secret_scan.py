from __future__ import annotations

import random
import re
from hashlib import sha256

import duckdb
import pytest

from quayside.llm import queries, secret_scan, trigrams
from tools import plan_text

SF_DIR = "/root/testdata/sf0.01"
DDL = "doc_id bigint, text string, spans string, hits int, share string"
# The base kinds as the contract words them: pattern, group, least length.
BASE = {
    "assign": (r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}


def brute(text):
    found = []
    further = {r.kind: (r.pattern, r.group, r.least) for r in secret_scan.FURTHER}
    for rank, (kind, (pattern, group, least)) in enumerate((BASE | further).items()):
        for m in re.finditer(pattern, text or ""):
            if len(m.group(group)) >= least:
                found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}", kind))
    found.sort()
    base = [s for _, _, s, kind in found if kind in BASE]
    counts = [sum(s.startswith(kind + ":") for s in base) for kind in BASE]
    return (*counts, sha256(",".join(base).encode()).hexdigest(), ",".join(s for _, _, s, _ in found))


def through(spark, tmp_path, rows):
    spark.createDataFrame(rows, DDL).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    return queries.queries()["op13_secret_scan"](spark, str(tmp_path))


def bag(rows):
    return sorted((tuple(row) for row in rows), key=repr)


PIECES = [
    "password", "PassWD", "secret", "Token", "api_key", "APIKEY", "ſecret", "toKen", "=", ":", " ", "  ", '"', "'", "\n",
    "abcdefghijkl", "Ab1+/_.=-", "AKIA", "ABCDEFGHIJKLMN", "Z0", "0123456789abcdef", "deadbeef", "é", "🙂", "漢", "x",
    "ghp_" + "a1" * 20, "xoxb-1234567890", "AIza" + "b" * 35, "eyJhbGciOiJI.eyJzdWIiOiIx.abc", "://user:pw@", "-----BEGIN RSA PRIVATE KEY-----",
]


def test_against_brute_force(spark, tmp_path):
    chosen = random.Random(4)
    texts = ["".join(chosen.choices(PIECES, k=chosen.randrange(25))) for _ in range(1_500)]
    texts += [None, "", None, "token: secret = abcdefghijkl", "AKIAAKIA" + "B" * 12, "AKIA" + "B" * 13 + " AKIA" + "C" * 14]
    texts += ["password=" + "a" * 50_000, ("secret: abcdefghijklm🙂 " * 3_000), "plain words " * 20_000]
    texts += ["token=hot_value_of_many"] * 900
    rows = [(i if i % 50 else None, t, "own", 1, "s") for i, t in enumerate(texts)]
    found = through(spark, tmp_path, rows)
    assert found.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    assert bag(found.collect()) == bag([(i, *brute(t)) for i, t, *_ in rows])


def test_no_documents_and_no_candidates(spark, tmp_path):
    assert through(spark, tmp_path / "a", []).collect() == []
    found = through(spark, tmp_path / "b", [(1, "plain", None, None, None), (1, "plain", None, None, None)])
    assert bag(found.collect()) == bag([(1, *brute("plain"))] * 2)


def test_as_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"create view documents as from '{SF_DIR}/documents.parquet'")
    expected = duck.execute(queries.oracle_sql()["op13_secret_scan"])
    columns = [c[0] for c in expected.description]
    found = queries.queries()["op13_secret_scan"](spark, SF_DIR)
    rows = bag(found.select(*columns).collect())
    assert rows == bag(expected.fetchall())
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert bag(found.collect()) == bag([(r.doc_id, *brute(r.text)) for r in docs])


def test_no_python_on_the_way(spark):
    plan = plan_text(queries.queries()["op13_secret_scan"](spark, SF_DIR))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def texts_of(q):
    return {frozenset(a) for a in q}


def grams(*texts):
    return {frozenset(t[i : i + 3] for i in range(len(t) - 2)) for t in texts}


@pytest.mark.parametrize(
    "pattern, expected",
    [
        ("Hello", grams("hello")),
        ("[Aa][Bb]C|xyz", grams("abc", "xyz")),
        ("abc.*defg", {frozenset(["abc", "def", "efg"])}),
        ("(abcd)?efg", grams("efg")),
        ("ab", {frozenset()}),
        ("[0-9a-f]{16,}", {frozenset()}),
        ("abc|[a-z]+", {frozenset()}),
        ("(abc)+x", grams("abc")),
        ("(ab){2,}", grams("abab")),
        ("(abc){2}d", grams("abcabcd")),
        ("^foo$|bar+", {frozenset(["foo"]), frozenset(["bar"])}),
        ("(abc|def.+)ghi", {frozenset(["abc", "ghi"]), frozenset(["def", "ghi"])}),
        ("é+abc", grams("abc")),
        ("(?:password)", grams("password")),
    ],
)
def test_trigram_queries(pattern, expected):
    assert texts_of(trigrams.query(pattern)) == expected


def test_rules_with_and_without_mandatory_trigrams():
    full = [r.kind for r in secret_scan.RULES if trigrams.query(r.pattern) == trigrams.ANYTHING]
    assert full == ["hex"]
    assert grams("passwd") < texts_of(trigrams.query(secret_scan.BASE[0].pattern))


def test_queries_are_necessary(spark):
    """Whatever a rule matches is a candidate, with the rules' trigrams or with all."""
    chosen = random.Random(6)
    texts = ["".join(chosen.choices(PIECES, k=8)) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "key bigint, text string")
    asked = [trigrams.query(r.pattern) for r in secret_scan.RULES]
    small = trigrams.postings(docs, "key", "text", trigrams.vocabulary_of(asked))
    whole = trigrams.postings(docs, "key", "text")
    hits = {r.key: r.hits for r in trigrams.candidates(small, asked).collect()}
    assert hits == {r.key: r.hits for r in trigrams.candidates(whole, asked).collect()}
    for key, text in enumerate(texts):
        for i, rule in enumerate(secret_scan.RULES):
            if asked[i] != trigrams.ANYTHING and re.search(rule.pattern, text):
                assert hits.get(key, 0) >> i & 1, (rule.kind, text)
    posted = {(r.trigram, r.key) for r in whole.collect()}
    python = {(t.lower()[i : i + 3], k) for k, t in enumerate(texts) for i in range(len(t.lower()) - 2)}
    assert {p for p in python if p[0].isascii()} <= posted


def test_running_totals(spark):
    for n in (0, 1, 255, 256, 257, 1_000):
        values = list(range(n))
        got = spark.createDataFrame([(values,)], "v array<int>").select(secret_scan.running(secret_scan.F.col("v"))).first()[0]
        assert got == [sum(values[: i + 1]) for i in range(n)]

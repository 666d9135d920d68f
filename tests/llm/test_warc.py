from __future__ import annotations

import os
from hashlib import sha256

from quayside.llm import queries, warc
from quayside.sources.relations import shared_folder

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def expected(pages):
    """By page id: length, digest, record type and the page referred to."""
    payloads = {page_id: (html or "").encode() for page_id, html in pages}
    first = {}
    for page_id in sorted(payloads):
        first.setdefault(payloads[page_id], page_id)
    out = {}
    for page_id, payload in payloads.items():
        other = first[payload]
        revisit = len(payload) >= 100 and other != page_id
        out[page_id] = (len(payload), sha256(payload).hexdigest(), "revisit" if revisit else "response", other if revisit else None)
    return out


def test_archives_give_back_all_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "html").collect()
    found = queries.queries()["op7_warc_index"](spark, SF_DIR).collect()
    assert len(found) == len(pages)
    assert {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found} == expected(pages)


def urls_of(spark, urls):
    return spark.createDataFrame([(u,) for u in urls], "url string")


def test_blocks_that_can_hold_a_key():
    """As by looking through all blocks of a sorted list."""
    import random

    chosen = random.Random(2)
    for _ in range(500):
        keys = sorted(chosen.choices("abcdef", k=chosen.randrange(1, 30)))
        size = chosen.randrange(1, 6)
        blocks = [keys[i : i + size] for i in range(0, len(keys), size)]
        for key in "`abcdefg":
            hold = {i for i, block in enumerate(blocks) if key in block}
            found = set(warc.blocks_of(key, [block[0] for block in blocks]))
            assert hold <= found and len(found - hold) <= 1


def through(spark, rows):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, offset int")
    archives, index = shared_folder(spark, "warc"), shared_folder(spark, "captures")
    warc.write(pages, archives)
    warc.index(spark, archives, index, lines=3)
    return warc.records(warc.lookup(spark, index, pages.select("url"))).collect()


def test_odd_urls(spark):
    odd = ["http://a.example/x [1", "http://a.example/ [\"b", "http://[::1", " [", "a\tb", "c\rd\ne", "http://a.example:x/", "é [ü]", "\x1f", ""]
    rows = [(i, u, f"own {i}", 1) for i, u in enumerate(odd)]
    found = through(spark, rows)
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in found) == [(i, f"own {i}") for i in range(len(odd))]


def test_one_id_with_several_payloads(spark):
    """Each row is judged by its own payload; none is lost."""
    same, other = "same " * 40, "other " * 40
    rows = [(1, "http://a.example/", same, 1), (2, "http://b.example/", same, 1), (2, "http://b.example/", other, 1), (2, "http://b.example/", same, 1)]
    found = through(spark, rows)
    kinds = [(r.page_id, r.record_type, r.refers_to, bytes(r.payload or b"").decode()) for r in found]
    assert sorted(kinds, key=str) == sorted([(1, "response", None, same), (2, "revisit", 1, ""), (2, "response", None, other), (2, "revisit", 1, "")], key=str)


def test_no_pages_and_long_ones(spark):
    assert through(spark, []) == []
    long = "x" * 5_000_000
    (found,) = through(spark, [(1, "http://a.example/" + "p" * 10_000, long, 1)])
    assert bytes(found.payload).decode() == long


def test_lookup_by_url(spark):
    rows = [(n, f"http://host{n % 7}.example.org/p/{n // 2}", "same " * 40 if n % 3 else f"own {n}\r\n\r\nWARC/1.1", 1) for n in range(200)]
    rows += [(300, None, None, 1), (301, "http://host1.example.org/é?q=1", "é" * 99, 1)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, offset int")
    archives, index = shared_folder(spark, "warc"), shared_folder(spark, "captures")
    warc.write(pages, archives)
    warc.index(spark, archives, index, lines=8)
    for url in (rows[0][1], rows[57][1], rows[199][1], rows[201][1]):
        ids = {r.page_id for r in warc.lookup(spark, index, urls_of(spark, [url])).collect() if r.url == url}
        assert ids == {r[0] for r in rows if r[1] == url}
    assert warc.lookup(spark, index, urls_of(spark, ["http://nowhere.example/"])).count() == 0
    some = sorted({r[1] for r in rows if r[1]})[::3] + [rows[57][1], "http://zzz.example/", "", None]
    found = warc.lookup(spark, index, urls_of(spark, some)).collect()
    assert sorted(r.page_id for r in found) == sorted(r[0] for r in rows if r[1] in some)
    html = {r[0]: r[2] or "" for r in rows}
    found = warc.records(warc.indexed(spark, index)).collect()
    assert len(found) == len(rows)
    assert all(bytes(r.payload).decode() == html[r.page_id] for r in found if r.record_type == "response")

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quayside.functions.values import all_string
from quayside.sources import landing, pages
from quayside.sources.relations import relation
from tools import values

COLUMNS = ["id", "name", "tags"]


def page(data, status="SUCCESS", errors=None, next_page=None):
    return {
        "responseStatus": status,
        "responseDetails": {"next_page": next_page},
        "errors": errors,
        "data": data,
    }


def write(folder, *found):
    folder.mkdir(parents=True, exist_ok=True)
    for number, item in enumerate(found):
        (folder / f"page-{number:05d}.json").write_text(json.dumps(item, indent=1))
    return str(folder)


def test_rows_by_name_in_page_order(spark, tmp_path):
    folder = write(
        tmp_path / "pages",
        page([{"id": 1, "name": "a", "tags": "x"}, {"name": "b", "id": 2}], next_page="/2"),
        page([{"tags": {"x": [1, 2]}, "name": True, "id": "3", "extra": 9}]),
    )
    found = pages.read(spark, folder, COLUMNS)
    assert pages.summary(found).first().row_count == 3
    rows = pages.to_rows(found)
    assert rows.columns == COLUMNS
    one, two, three = values(rows)
    assert (one, two) == (("1", "a", "x"), ("2", "b", None))
    assert three[:2] == ("3", "true") and json.loads(three[2]) == {"x": [1, 2]}
    ordered = pages.to_rows(found, with_order=True).orderBy("page", "position")
    assert [row.id for row in ordered.collect()] == ["1", "2", "3"]


def test_one_page_per_line(spark, tmp_path):
    lines = [page([{"id": n, "name": str(n)}]) for n in range(5)]
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, lines)))
    found = pages.read(spark, str(tmp_path), COLUMNS, one_per_line=True)
    assert sorted(row.id for row in pages.to_rows(found).collect()) == list("01234")


@pytest.mark.parametrize("status", ["FAILURE", "EXCEPTION"])
def test_failed_page(spark, tmp_path, status):
    folder = write(
        tmp_path / "pages", page([{"id": 1}]), page(None, status=status, errors="no session")
    )
    found = pages.read(spark, folder, COLUMNS)
    assert pages.summary(found).first().failed_pages == 1
    with pytest.raises(Exception, match="response page .* failed: no session"):
        pages.to_rows(pages.checked(found)).collect()


def test_broken_page_fails(spark, tmp_path):
    (tmp_path / "page.json").write_text('{"responseStatus": "SUCCESS", "data": [{')
    with pytest.raises(Exception, match="MALFORMED|Malformed|FAILED_READ"):
        pages.to_rows(pages.checked(pages.read(spark, str(tmp_path), COLUMNS))).collect()


def test_empty_pull_keeps_the_old_one(spark, tmp_path):
    target = str(tmp_path / "pull")
    full = pages.read(spark, write(tmp_path / "full", page([{"id": 1}])), COLUMNS)
    empty = pages.read(spark, write(tmp_path / "empty", page([])), COLUMNS)
    assert landing.write_pull(all_string(pages.to_rows(full), COLUMNS), target)
    assert pages.summary(empty).first().row_count == 0
    assert not landing.write_pull(all_string(pages.to_rows(empty), COLUMNS), target)
    assert values(spark.read.parquet(target)) == [("1", None, None)]


def chain(spark, links):
    rows = [{"response": r, "name": n, "next": t} for r, n, t in links]
    found = relation(spark, rows, "response string, name string, next string")
    return pages.ordered(found, name=F.col("name"), follows=F.col("next"), response=F.col("response"))


@pytest.mark.parametrize("length", [1, 2, 3, 7, 8, 9, 100])
def test_place_along_the_links(spark, length):
    links = [(r, f"{r}{(n * 7) % 101}", f"{r}{((n + 1) * 7) % 101}" if n + 1 < length else None) for r in "ab" for n in range(length)]
    found = chain(spark, links[::-1])
    assert values(found, "response", "name", "place") == sorted(
        ((r, f"{r}{(n * 7) % 101}", n) for r in "ab" for n in range(length)), key=repr
    )


@pytest.mark.parametrize(
    "links, message",
    [
        ([("a", "1", "2"), ("a", "3", None)], "page 2 after 1 of response 'a' is missing"),
        ([("a", "1", None), ("a", "1", None)], "two pages are named 1"),
        ([("a", "1", "3"), ("a", "2", "3"), ("a", "3", None)], "several pages lead to page 3"),
        ([("a", "1", None), ("a", "2", None)], "response 'a' has 2 first pages, one is 1"),
        ([("a", "1", "2"), ("a", "2", "1")], "leads back to itself"),
        ([("a", "0", None), ("a", "1", "2"), ("a", "2", "3"), ("a", "3", "1")], "leads back to itself"),
        ([("a", "1", "2"), ("b", "2", None)], "page 2 after 1 of response 'a' is missing"),
        ([("a", "1", "1")], "leads back to itself"),
    ],
)
def test_responses_that_are_not_whole(spark, links, message):
    with pytest.raises(ValueError, match=message):
        chain(spark, links)


def test_links_between_files(spark, tmp_path):
    """By default a link ends in the name of the next page's file."""
    made = [page([{"id": n}], next_page=f"https://host/api/page-{n + 1:05d}/" if n < 11 else None) for n in range(12)]
    folder = write(tmp_path / "pages", *made)
    found = pages.ordered(pages.read(spark, folder, COLUMNS))
    assert values(found.select("place", F.col("data")[0]["id"].cast("int"))) == sorted([(n, n) for n in range(12)], key=repr)
    (tmp_path / "pages" / "page-00004.json").unlink()
    with pytest.raises(ValueError, match="page page-00004 after page-00003 of response '' is missing"):
        pages.ordered(pages.read(spark, folder, COLUMNS))


def test_no_pages(spark):
    assert chain(spark, []).count() == 0

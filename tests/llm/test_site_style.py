from __future__ import annotations

import math
import random

import pytest

from quayside.llm import site_style

PAGE = """<html><head><title>t</title><script>var x = "<p>no</p>";</script></head><body>
<div class="qa"><a href="/a">Alpha</a> <a href="/b">Beta</a></div>
<div class="qb"><h1>Title {n}</h1><p>Own   words &amp; text\n number {n}.</p><p>More of &eacute; {n}</p></div>
<div class="qc">The same line on every page</div></body></html>"""


def extracted(spark, rows):
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, main_text int")
    found = site_style.extract(pages)
    return [(r.page_id, r.main_text) for r in found.collect()]


def test_branches_alike_on_all_pages_go(spark):
    rows = [(n, f"http://site.example/{n}", PAGE.replace("{n}", str(n * 7919)), 1) for n in range(40)]
    found = dict(extracted(spark, rows))
    assert len(found) == 40
    for n, text in found.items():
        assert text == f"Title {n * 7919}\nOwn words & text number {n * 7919}.\nMore of é {n * 7919}"


def test_odd_rows(spark):
    long = "<p>" + "word " * 200_000 + "end</p>"
    rows = [(1, None, None, 1), (2, "http://a.example/", "", 1), (3, "no url", "<p>a</p><p>b<br>c", 1), (3, "no url", "<p>a</p><p>b<br>c", 1)]
    rows += [(4, "http://a.example/x", long, 1), (None, "http://a.example/y", "<p>null id</p>", 1)]
    rows += [(5, "http://a.example/z", "<nav>menu</nav><article><p>kept</p></article><footer>f</footer><script>s</script>", 1)]
    found = extracted(spark, rows)
    assert len(found) == len(rows)
    by_id = dict(found)
    assert (by_id[1], by_id[2]) == ("", "") and by_id[None] == "null id" and by_id[5] == "kept"
    assert by_id[3].startswith("a\nb") and by_id[4] == "word " * 200_000 + "end"
    assert extracted(spark, []) == []


def brute_importance(pages, gamma=site_style.GAMMA, prior=site_style.PRIOR):
    """Importance of every place of one host's different pages, by plain loops over the definitions."""
    places = {}
    for html in set(pages):
        for place, (contents, shapes) in site_style.features(html).items():
            places.setdefault(place, []).append((contents, shapes))
    out = {}
    for place, seen in places.items():
        m = len(seen)
        if m == 1:
            out[place] = 1.0
            continue
        features = set().union(*[c for c, _ in seen])
        entropies = []
        for f in features:
            n = sum(f in c for c, _ in seen)
            entropies.append(-sum(1 / n * math.log(1 / n, m) for _ in range(n)))
        content = 1 - (sum(entropies) / len(entropies) if entropies else 0)
        shapes = [s for _, found in seen for s in found]
        counts = [shapes.count(s) / len(shapes) for s in set(shapes)]
        shape = min(1, -sum(p * math.log(p, m) for p in counts))
        weight = gamma ** len(features)
        composite = (1 - weight) * content + weight * (content + shape) / 2
        out[place] = (m * composite + prior) / (m + prior)
    return out


def test_importance_against_brute_force(spark):
    chosen = random.Random(3)

    def made(n):
        menu = "".join(f"<li><a href='/{k}'>Item {k}</a></li>" for k in range(chosen.randrange(3, 5)))
        body = "".join(f"<p>{chosen.choice(['same', f'own {n}', 'other'])} {chosen.randrange(4)}</p>" for _ in range(chosen.randrange(4)))
        return f"<body><div class='m{n}'><ul>{menu}</ul></div><div><b>t</b><section>{body}</section></div><div>end</div></body>"

    pages = [made(n % 20) for n in range(30)] + [PAGE.replace("{n}", str(n)) for n in range(9)]
    rows = [(n, "http://a.example/", html, 1) for n, html in enumerate(pages)]
    nodes = site_style.style_nodes(spark.createDataFrame(rows, "page_id bigint, url string, html string, x int")).cache()
    places = {r.node: r.place for r in nodes.select("node", "place").distinct().collect()}
    found = {places[r.node]: r.importance for r in site_style.importance(nodes).collect()}
    expected = brute_importance(pages)
    assert set(found) == set(expected) and len(found) > 8
    assert all(found[place] == pytest.approx(expected[place]) for place in found)


def one(spark, html, n=1):
    rows = [(i, "http://s.example/x", html.replace("{n}", str(i * 7919)), 1) for i in range(n)]
    return dict(extracted(spark, rows))[0]


def test_parts_of_an_article_stay(spark):
    """On a host of any size: headings that every article has, its own header, and class
    words that also name parts of articles."""
    page = (
        "<article><header class='entry-header'><h1>Title {n}</h1></header><h2>Ingredients</h2><p>Words {n} of this.</p>"
        "<div class='notice'>Note {n}</div><div class='social-science'>Field {n}</div><div class='form-factor-review'>Size {n}</div>"
        "<ul class='search-results'><li>Found {n}</li></ul><div class='comments'><p>Me too {n}</p></div><aside>See also</aside></article>"
    )
    expected = "Title 0\nIngredients\nWords 0 of this.\nNote 0\nField 0\nSize 0\nFound 0"
    assert {one(spark, page, n) for n in (1, 9, 12, 40)} == {expected}


def test_a_doubtful_part_goes_if_the_tree_agrees(spark):
    page = "<article><p>Words {n} that fill the page with text of its own.</p><div class='notice'>Sign up</div></article>"
    assert one(spark, page, 3).endswith("\nSign up")
    assert one(spark, page, 40) == "Words 0 that fill the page with text of its own."


def test_copies_are_no_evidence(spark):
    page = "<body><div class='t'>Story copied whole.</div><div class='u'>And the longer half of the same story.</div></body>"
    assert one(spark, page, 12) == "Story copied whole.\nAnd the longer half of the same story."


def test_a_teaser_is_not_the_page(spark):
    page = "<body><div class='s'><h1>Story {n}</h1><p>All of the story is told here, at length, in its {n} words.</p></div><article class='card'>Next</article></body>"
    assert one(spark, page).startswith("Story 0\nAll of the story")

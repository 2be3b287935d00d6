"""Search and page text against plain versions and the registered SQL."""

import math

import pytest
from odd_rows import SMALL

import __spark_entry__ as driver
from verification.check import differences, duck, duck_rows, spark_rows
from waterline.llm import html, search


@pytest.mark.parametrize("name", ["op3_mixing", "op9_search"])
def test_against_sql(spark, name):
    got = spark_rows(driver.queries()[name](spark, SMALL))
    assert differences(got, duck_rows(duck(SMALL), driver.oracle_sql()[name])) == []


def test_search_on_odd_vectors(spark):
    import random

    draw = random.Random(5)
    vectors = [(i, [draw.choice([-1.0, 0.5, 0.25, 1e3]) for _ in range(13)]) for i in range(0, 300)]
    vectors += [(100, [1.0] * 13), (200, None), (400, [float("nan")] * 13), (500, [None] * 13), (600, [math.inf] * 13), (None, [2.0] * 13), (700, []), (701, []), (800, [1.0, 2.0])]
    rows = spark.createDataFrame([(i, v, 1) for i, v in vectors], "vec_id long, embedding array<double>, rid int").repartition(5)
    got = search.top_k(rows).collect()
    usable = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for at, (i, q) in enumerate(usable):
        if i is not None and i % 100 == 0:
            scores = [(-sum(a * b for a, b in zip(q, v, strict=True)), j is None, j) for k, (j, v) in enumerate(usable) if k != at and len(v) == len(q)]
            want += [(i, rank + 1, j, -s) for rank, (s, _, j) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:10])]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert search.top_k(rows.limit(0)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>About</a></ul></nav><div class="cookie-notice">We use cookies</div>
<div id=ad-1 class="ad">Buy</div><%s><h1>Title &amp; more</h1><p>First   long paragraph, with <b>bold</b> and <a href=x>a link</a> in it,
over two lines.<p>Short.<br><blockquote>Quoted&nbsp;text of some length stands here</blockquote><form><label>Name</label><input></form>
<ul><li>one item of the list<li>another item of it</ul><p>End.</p></%s><aside>More</aside><section class="comments"><article><p>I say no, at great
length and with many words so that it looks like text.</p></article></section><footer>&copy; 2020 <p>Foot</p></footer></body>"""
TEXT = "Title & more\nFirst long paragraph, with bold and a link in it, over two lines.\nShort.\nQuoted text of some length stands here\none item of the list\nanother item of it\nEnd."


@pytest.mark.parametrize("element", ["article", "main", "div"])
def test_page_text(element):
    assert html.main_text(PAGE % (element, element)) == TEXT


def test_odd_pages(spark):
    pages = [(1, "u", None), (2, None, ""), (None, "u", "plain text"), (4, "u", "<p>a"), (4, "u", "<p>a"), (5, "u", "<" * 2000 + "<!-- x"), (6, "u", "<div>" * 3000 + "deep" + "</p>"), (7, "u", "<p>" + "long word " * 50_000)]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, text int")
    got = html.extract_pages(df).collect()
    assert len(got) == len(pages) and all(r.n_chars == len(r.text) for r in got)
    by_id = {r.page_id: r.text for r in got}
    assert by_id[1] == by_id[2] == "" and by_id[None] == "plain text" and by_id[4] == "a" and by_id[6] == "deep"
    assert by_id[7] == ("long word " * 50_000).strip()
    assert html.extract_pages(df.limit(0)).count() == 0

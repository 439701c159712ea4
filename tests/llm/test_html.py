"""Main-text extraction."""

import html
import re

import pytest
from pyspark.sql import functions as F

from tallyrisk.llm import html_extract as H

PAGES = "page_id long, url string, html string"
LONG = "A long sentence about rivers, which goes on and on. " * 5


@pytest.fixture(scope="module")
def model(spark):
    return H.fit(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"), 60)


def text_of(model, source):
    page = H.Page(source)
    return page.text(H.decode(page, model.probability(H.features(page))))


def test_template_pages_exactly(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in H.extract(pages.withColumn("text", F.lit("clash"))).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*)</article>", r.html, re.S).group(1)
        body = re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", re.sub(r"</?(p|h1)>", "\n", body)))
        lines = (" ".join(html.unescape(x).split()) for x in body.split("\n"))
        want = "\n".join(x for x in lines if x)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def test_unseen_layouts(model):
    article = f"<h1>Title</h1><p>{LONG}</p><p>Short.</p><ul><li>one &amp; two</li></ul>"
    want = f"Title\n{LONG.strip()}\nShort.\none & two"
    for source in (
            f'<body><div class="content">{article}</div><div class="comments"><p>{LONG}</p></div></body>',
            f'<body><div id="cookie-bar">{LONG}</div><main>{article}<aside class="related">{LONG}</aside></main>'
            f'<aside class="sidebar"><p>{LONG}</p></aside><form><p>Join</p><input></form></body>',
            f'<div id="nav"><a href=1>a</a></div><article>{article}<div class="share">Tweet</div></article>'):
        assert text_of(model, source) == want


def test_decoding_has_no_contradictions(model):
    page = H.Page(f'<body><nav><p>{LONG}</p></nav><article><p>{LONG}<b>bold</b></article></body>')
    kept = H.decode(page, model.probability(H.features(page)))
    assert all(kept[page.parent[i]] for i in range(1, len(kept)) if kept[i])
    # brute force over all consistent labellings of a small tree
    import itertools
    import numpy as np
    p = np.array([0.9, 0.4, 0.95, 0.2, 0.7, 0.6, 0.55])
    small = H.Page("<div><p>a<b>x</b></p><div><i>b</i></div></div>")
    n = len(small.tag)
    score = lambda z: sum(np.log(p[i]) if z[i] else np.log1p(-p[i]) for i in range(n))
    fits = [z for z in itertools.product((True, False), repeat=n)
            if z[0] and all(z[small.parent[i]] or not z[i] for i in range(1, n))]
    assert tuple(H.decode(small, p[:n])) == max(fits, key=score)


@pytest.mark.parametrize("source, want", [
    ("", ""), ("plain text 1 < 2 &lt; 3", "plain text 1 < 2 < 3"), ("<!-- only -->", ""),
    ("<p>a\t\n b<br>c<p>d", "a b c\nd"), ("<script>var a='<p>x</p>'</script>", "")])
def test_blocks(source, want):
    page = H.Page(source)
    assert page.text([t not in H.UNSEEN for t in page.tag]) == want


def test_edge_rows(spark):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    rows = [(1, None, None), (2, "u", ""), (None, "u", f"<article><p>{LONG}</article>"), (3, "u", deep),
            (4, "u", '<a href="x>broken <p>' + LONG), (2, "u", ""), (5, "u", f"<article>{'<p>' + LONG}" * 2000)]
    got = H.extract(spark.createDataFrame(rows, PAGES), 10).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert by[1].text == "" and by[1].n_chars == 0 and by[2].text == ""
    assert by[None].text == LONG.strip()
    assert by[5].text.count("\n") == 1999
    assert H.extract(spark.createDataFrame([], PAGES), 10).count() == 0

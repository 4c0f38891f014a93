import html as entities
import random
import re

import pytest
from pyspark.sql import functions as F

from curvelake.llm import markup, template

FOLDER = "/root/testdata/sf0.01"


def extracted(spark, rows):
    table = spark.createDataFrame([(*r, "h", 5, "t") for r in rows], "page_id long, url string, html string, host string, tokens int, text string").repartition(4)
    return {r.page_id: r for r in template.main_text(table).collect()}


def test_articles_of_the_given_pages(spark):
    """Against an independent cut of the article and its blocks."""
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    found = {r.page_id: r for r in template.main_text(pages).collect()}
    rows = pages.collect()
    assert len(found) == len(rows)
    for r in rows:
        article = r.html.split("<article>", 1)[1].split("</article>")[0]
        pieces = [re.sub("<[^>]*>", "", p.replace("<br>", " ")) for p in re.split("</?(?:p|h1)>", article)]
        want = "\n\n".join(t for p in pieces if (t := " ".join(entities.unescape(p).split())))
        assert (found[r.page_id].text, found[r.page_id].n_chars, found[r.page_id].url) == (want, len(want), r.url)


@pytest.mark.parametrize(("html", "want"), [
    (None, []), ("", []), ("plain &lt;text&gt; 1 < 2", ["plain <text> 1 < 2"]),
    ("<p>a<p>b <b>c</b>d<br>e</p>", ["a", "b cd e"]),
    ("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>1<td>2<tr><td>3</table>", ["a", "b", "c", "1", "2", "3"]),
    ("<nav>menu</nav><header>h</header><p>x</p><aside>s</aside><form>f<input></form><footer>g</footer>", ["x"]),
    ("<div class='cookie-notice'>n</div><div class='with-sidebar'><p>x</p></div><div id=adSlot>y</div><section class='reader comments'><p>z</p></section>", ["x"]),
    ("<article><header><h1>T</h1></header>b<section class=comments><p>c</p></section><footer>f</footer>d</article><p>out</p>", ["T", "b", "d"]),
    ("<main><p>text of the main element</p><article class=teaser>t</article></main>", ["text of the main element"]),
    ("<script>if (a<b) { '</p>' }</script><style>p>b{}</style><noscript>n</noscript><!-- c --><p>q<!-- open", ["q"]),
    ("<nav>never closed<article>x</article>", ["x"]), ("<aside><article>x</article></aside>y", ["y"]),
    ("<p title='a>b'>x</p><p title=\"open>y", ["x", "y"]), ("<SCRIPT>x</Script >y<TITLE>t</title>z", ["yz"]),
    ("&copy; A&amp;B &eacute;&#233;&#xe9; &nbsp; &am &unknown;", ["\xa9 A&B \xe9\xe9\xe9 &am &unknown;"]),
    ("<p>\n a \t b\r\n</p><p> </p>", ["a b"]), ("<div hidden>h</div><p aria-hidden=true>i</p>j", ["j"]),
])
def test_blocks_of_a_page(html, want):
    assert markup.read(html).kept() == want


@pytest.mark.parametrize("piece", ['<a href="x', "<div>", "<p>x", "</b><b>", "<", "<!--x", "<script>", "<b><div></b>", "&amp", "<nav><article>"])
def test_long_pages_in_linear_time(piece):
    markup.read(piece * 40_000)


def site(rng, pages, host="s.example", extra=lambda i: ""):
    """Pages without telling element or class names: only what they share tells their template."""
    words = [f"w{i}" for i in range(400)]
    sentence = lambda: " ".join(rng.choice(words) for _ in range(9))
    made = []
    for i in range(pages):
        own = [sentence() for _ in range(rng.randrange(1, 6))]
        body = "".join(f"<p>{t}</p>" for t in own)
        made.append((f"http://{host}/{i}", f"<html><body><div class=a><span>My site</span><b>home</b><b>about</b></div><div class=b>{body}{extra(i)}</div>"
                                           f"<div class=c>All rights kept</div></body></html>", own))
    return made


def test_template_text_of_a_host_goes(spark):
    rng = random.Random(1)
    notice = lambda i: "<div class=x><i>Read our</i><i>other letter</i></div>" if i % 3 else ""
    first = site(rng, 30, extra=notice)
    small = site(rng, 4, host="small.example")
    rows = [(i, u, h) for i, (u, h, _) in enumerate(first + small)]
    found = extracted(spark, rows)
    for i, (_, _, own) in enumerate(first):
        assert found[i].text == "\n\n".join(own)
    for i, (_, _, own) in enumerate(small, len(first)):
        assert found[i].text == "\n\n".join(["My sitehomeabout", *own, "All rights kept"])


def test_shared_passages_and_copies_stay(spark):
    """A passage that many pages have, in the same kind of element as their own text, is no template; copies of one page make none."""
    rng = random.Random(2)
    shared = site(rng, 24, extra=lambda i: "<p>a passage that half of the pages have</p>" if i % 2 else "")
    copies = [("http://copies.example/1", "<body><p>one page</p><p>again and again</p></body>", ["one page", "again and again"])] * 20
    found = extracted(spark, [(i, u, h) for i, (u, h, _) in enumerate(shared + copies)])
    for i, (_, _, own) in enumerate(shared):
        assert found[i].text == "\n\n".join(own + ["a passage that half of the pages have"] * (i % 2))
    for i, (_, _, own) in enumerate(copies, len(shared)):
        assert found[i].text == "\n\n".join(own)


def test_large_templates_meet_pages_in_parts(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, u, h) for i, (u, h, _) in enumerate(site(rng, 60) + site(rng, 9, host="t.example"))]
    want = {k: r.text for k, r in extracted(spark, rows).items()}
    monkeypatch.setattr(template, "BROADCAST", 0)
    monkeypatch.setattr(template, "LARGE", 7)
    assert {k: r.text for k, r in extracted(spark, rows).items()} == want


def test_odd_rows(spark):
    rows = [(1, None, "<p>a</p>"), (1, "no url", "<p>b</p>"), (None, "http://h.example", None), (2, "http://h.example", ""), (3, "//H.example:80/x", "<p>c</p>"), (3, "//H.example:80/x", "<p>c</p>")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((tuple(r) for r in template.main_text(table).collect()), key=str)
    assert got == sorted([(1, None, "a", 1), (1, "no url", "b", 1), (None, "http://h.example", "", 0), (2, "http://h.example", "", 0), (3, "//H.example:80/x", "c", 1),
                          (3, "//H.example:80/x", "c", 1)], key=str)
    assert template.main_text(table.limit(0)).collect() == []


def test_hosts(spark):
    urls = {"http://Www.Ex.org:80/a?b": "www.ex.org", "https://u:p@h.net#x": "h.net", "//x.y": "x.y", "mailto:a": "", "": "", "http:///p": "", "a//b": "", "ftp://h": "h"}
    table = spark.createDataFrame([(u,) for u in urls], "u string").select("u", template.host_of(F.col("u")).alias("h"))
    assert {r.u: r.h for r in table.collect()} == urls


def test_classes_are_ordered_and_nested():
    root = {1, 9}
    assert template.rounds([1, 5, 6, 5, 6, 9], {5, 6}, root) == ([5, 6], 1)
    assert template.rounds([1, 5, 6, 6, 5, 9], {5, 6}, root) == (None, None)
    assert template.rounds([5, 6, 1, 5, 6, 9], {5, 6}, root) == ([5, 6], None)
    assert template.rounds([1, 5, 9, 6], {5, 6}, root) == ([5, 6], None)


def test_text_of_a_component():
    start = markup.kind(1000, markup.START)
    text, end = markup.kind(77, markup.TEXT), markup.end_of(start)
    assert template.own_text([start, text, end], False) == [text]
    assert template.own_text([text, start, end], False) == [] and template.own_text([text, start, end], True) == [text]

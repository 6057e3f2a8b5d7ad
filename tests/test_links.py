from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vintara.operators import links as w

HTML = """<html><!-- <a href="no.pdf">x</a> --><script>var s = '<a href="js.pdf">j</a>';</script>
<h2>PERM stuff</h2><ul><li>See <a href='FY2024_x.pdf'>A &amp; B</a> h2a</li>
<li><a href="b.XLSX?x=1">b</a><a href="../c.XLSX">c</a></li></ul>
<h3>Annual LCA</h3><p> hello <a class="k" data-href="q.pdf" href=/d.csv>D <b> dd</b></a></p>
<strong>H-2B  x</strong><div>zz<p>q</p><a href="e.doc">e</a></div><a>no href</a><a href="">empty</a>
<table><tr><td> PERM </td><td><a href="t1_2020.xlsx">t</a></td></tr>
<tr><td>only <a href="u.xlsx">u</a></td></tr>
<tr><td>x<i> y</i></td><td><a href="PERM annual report.pdf">r</a><a href="lca_FY19.zip">z</a></td></tr></table>
<p><a href="e.doc">again</a> <a href="//cdn.org/o.pdf">o</a></p></html>"""


@pytest.fixture
def pages(frame):
    return frame([(1, "https://ex.org/a/b/page.html?q=1", HTML)], "page_id long, url string, html string")


def test_anchors(pages):
    got = [(r["href"], r["text"]) for r in w.links(pages).orderBy("pos").collect()]
    assert got[:4] == [("FY2024_x.pdf", "A & B"), ("b.XLSX?x=1", "b"), ("../c.XLSX", "c"), ("/d.csv", "D  dd")]
    hrefs = [h for h, _ in got]
    assert "no.pdf" not in hrefs and "js.pdf" not in hrefs and "q.pdf" not in hrefs and "" in hrefs


def test_extension_test_of_each_kind(pages):
    def hrefs(kind):
        return {r["href"] for r in w.file_links(pages, kind).collect()}

    assert "b.XLSX?x=1" in hrefs("yearbook") and "b.XLSX?x=1" not in hrefs("disclosure")
    assert "e.doc" in hrefs("disclosure") and "e.doc" not in hrefs("monthly")
    assert "../c.XLSX" in hrefs("annual")


def test_first_links(pages):
    urls = [r["url"] for r in w.first_links(w.file_links(pages)).collect()]
    assert len(urls) == len(set(urls)) and urls.count("https://ex.org/a/b/e.doc") == 1


def test_table_rows(pages):
    got = [(r["row"], r["filename"], r["program"], r["year"]) for r in w.table_links(pages).orderBy("row").collect()]
    # one-cell rows are skipped, deprecated reports too
    assert got == [(0, "t1_2020.xlsx", "PERM Program", "2020"), (2, "lca_FY19.zip", "LCA Program", "2019")]


def test_context(pages):
    got = {r["href"]: (r["block"], r["heading"]) for r in w.link_context(pages).where("href <> 'e.doc'").collect()}
    assert got["FY2024_x.pdf"] == ("H-2A Program", "PERM Program")
    assert got["../c.XLSX"] == (None, "PERM Program")
    assert got["/d.csv"] == (None, "PERM Program")  # a heading of annual reports announces nothing
    assert got["u.xlsx"] == (None, "H-2B Program")
    first = w.link_context(pages).where("href = 'e.doc'").orderBy("pos").collect()[0]
    assert (first["block"], first["heading"]) == (None, "H-2B Program")


def test_discovery(pages):
    got = {(r["filename"], r["program"], r["found_in"]) for r in w.discover_files(pages).collect()}
    assert got == {
        ("t1_2020.xlsx", "PERM Program", "table"), ("lca_FY19.zip", "LCA Program", "table"),
        ("FY2024_x.pdf", "H-2A Program", "page"), ("c.XLSX", "PERM Program", "page"), ("d.csv", "PERM Program", "page"),
        ("e.doc", "H-2B Program", "page"), ("u.xlsx", "H-2B Program", "page"), ("o.pdf", "H-2B Program", "page"),
    }


def test_nested_headings_and_blocks(frame):
    html = ('<div>PERM <div>inner <a href="1.pdf">x</a></div><a href="2.pdf">y</a></div>'
            '<h3>Annual <strong>LCA</strong></h3><a href="3.pdf">z</a>')
    pages = frame([(1, "http://h/", html)], "page_id long, url string, html string")
    got = {r["href"]: (r["block"], r["heading"]) for r in w.link_context(pages).collect()}
    assert got == {"1.pdf": (None, None), "2.pdf": ("PERM Program", None), "3.pdf": (None, "LCA Program")}


def test_a_closing_tag_ends_what_is_open_inside(frame):
    html = ('<ul><li>PERM <p>x</li></ul><h3>H-2A data</h3><a href="c.pdf">c</a></div></p>'
            '<div>LCA <p>one <p>two <a href="d.pdf">d</a></div><a href="e.pdf">e</a>')
    pages = frame([(1, "http://h/", html)], "page_id long, url string, html string")
    got = {r["href"]: (r["block"], r["heading"]) for r in w.link_context(pages).collect()}
    assert got == {"c.pdf": (None, "H-2A Program"), "d.pdf": (None, "H-2A Program"), "e.pdf": (None, "H-2A Program")}


def test_nested_tables_lose_no_row(frame):
    html = ('<table><tr><td>PERM</td><td><table><tr><td>LCA</td><td><a href="in.pdf">i</a></td></tr></table>'
            '<a href="out.pdf">o</a></td></tr><tr><td>H-2A</td><td><a href="after.pdf">a</a></td></tr></table>'
            '<tr><td>CW-1</td><td><a href="loose.pdf">l</a></td></tr>')
    pages = frame([(1, "http://h/", html)], "page_id long, url string, html string")
    got = {(r["filename"], r["row"], r["program"]) for r in w.table_links(pages).collect()}
    assert got == {("in.pdf", 1, "LCA Program"), ("out.pdf", 0, "PERM Program"), ("after.pdf", 2, "H-2A Program")}
    found = {r["filename"]: r["found_in"] for r in w.discover_files(pages).collect()}
    assert found == {"in.pdf": "table", "out.pdf": "table", "after.pdf": "table", "loose.pdf": "page"}


def test_character_references(frame):
    html = ('<p>H&#45;2A &Eacute;t&#xe9; &amp;lt; &#0;&#xD800; &nosuch; A&B;</p>'
            '<a href="x&#x2e;pdf">H&#45;2A &lt;&nbsp;</a><a href="a&#x2F;b&#46;pd&#102;">b</a><a href="q&period;csv?x=1&amp;y">c</a>')
    pages = frame([(1, "http://h/", html)], "page_id long, url string, html string")
    for found in (w.file_links(pages), w.link_context(pages)):
        assert [r["href"] for r in found.orderBy("pos").collect()] == ["x.pdf", "a/b.pdf"]
    links = w.links(pages).orderBy("pos").collect()
    assert (links[0]["text"], links[2]["href"]) == ("H-2A <\u00a0", "q.csv?x=1&y")
    text = pages.select(w.unescape(F.col("html")).alias("t")).first()["t"]
    assert text.startswith("<p>H-2A \u00c9t\u00e9 &lt; \ufffd\ufffd &nosuch; A&B;</p>")


def test_pages_of_any_size_and_none(frame):
    many = "".join(f'<p>PERM {i} <a href="f{i}.pdf">{i}</a></p>' for i in range(3000))
    pages = frame([(1, "http://h/", many), (2, "http://h/", None), (3, "http://h/", "")],
                  "page_id long, url string, html string")
    assert w.links(pages).count() == 3000
    assert w.link_context(pages).where("block = 'PERM Program'").count() == 3000


def test_markup_that_is_long_or_odd(frame):
    rows = [
        # unquoted text, very many attributes and long blanks must not recurse or take quadratic time
        (1, "http://h/", "text <a " + "b c " * 40_000 + ' href="x.pdf">t</a>'),
        (2, "http://h/", "<a " + "t='a' " * 30_000 + 'href="y.pdf">t</a>'),
        (3, "http://h/", "<a title=\"href=no.pdf\" data-href=q.pdf HREF = 'z.pdf' x>T" + " " * 100_000 + "</a>"),
        (4, "http://h/", '<a title="a>b" href=k.pdf>T</a><a href="u.pdf'),
        (5, "http://h/", '<a href="m.pdf"title="x">T</a> a < b <'),
    ]
    pages = frame(rows, "page_id long, url string, html string")
    want = [(1, "x.pdf"), (2, "y.pdf"), (3, "z.pdf"), (4, "k.pdf"), (5, "m.pdf")]
    for found in (w.links(pages), w.links(pages, squeeze=True), w.link_context(pages)):
        assert sorted((r["page_id"], r["href"]) for r in found.select("page_id", "href").collect()) == want
    squeezed = w.links(pages, squeeze=True).where("page_id = 3").collect()
    assert squeezed[0]["text"] == "T"


def test_year_pages_and_yearbooks(frame):
    html = ('<a href="/r1">Report of the Visa Office 2019</a><a href="/r-2020">Report of the Visa Office</a>'
            '<a href="/r1">Report of the Visa Office 2019</a><a href="/none">Report of the Visa Office</a>'
            '<a href="/yearbook/2018">x</a><a href="/b/yearbook/2018-2019/">y</a><a href="/t1">Yearbook 2018</a>'
            '<a href="/t2">Yearbook 2017 to 2018</a><a href="/t3">yearbook 2017</a>'
            '<a href="/t4">Yearbook <b>2011</b></a><a href="/t5">Yearbook\n 2010 <i>x</i></a>')
    pages = frame([(1, "http://h/", html)], "page_id long, url string, html string")
    assert [(r["year"], r["url"]) for r in w.year_pages(pages).collect()] == [
        ("2020", "http://h/r-2020"), ("2019", "http://h/r1")]
    assert [tuple(r) for r in w.yearbooks(pages).collect()] == [
        ("2018", "http://h/b/yearbook/2018-2019/"), ("2017", "http://h/t2"), ("2010", "http://h/t5")]
    assert w.anchor_by_text(pages, "YEARBOOK 2017").collect()[0]["url"] == "http://h/t2"


def test_monthly_pages(frame):
    html = ('<a>Monthly Immigrant Visa (IV) Issuances</a><a href="/n">see monthly nonimmigrant visa (NIV) issuances</a>'
            '<a href="/i">Monthly Immigrant <b>Visa (IV)</b> Issuances</a><a href="/j">Monthly Immigrant Visa (IV) Issuances</a>')
    pages = frame([(1, "http://h/", html)], "page_id long, url string, html string")
    assert sorted((r["program"], r["url"]) for r in w.monthly_pages(pages).collect()) == [
        ("IV", "http://h/i"), ("NIV", "http://h/n")]


def test_extraction_does_not_shuffle_and_uses_no_python(pages):
    for df in (w.links(pages), w.file_links(pages)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan

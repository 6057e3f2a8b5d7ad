"""Links in their place, by expressions, against a walk over the tags with a stack."""

from __future__ import annotations

import random
import time

import pagewalk
import pytest
from pyspark.sql import functions as F

from vintara.catalog import webpages
from vintara.functions import names
from vintara.operators import links as w
from vintara.operators import pagetree

ENDINGS = tuple(f".{e}" for e in pagetree.EXTENSIONS["disclosure"])
NAMES = ["td", "tr", "table", "p", "li", "div", "h2", "strong", "b", "i", "ul", "section", "br", "a"]
TEXTS = ["PERM", "lca ", "h-", "1b", "pw", "annual", "Annual performance ", "report", "fy 20", "16 report", " x ", "record", " layout",
         "", "\n", "cw", "1", "prevail", "ing", "a < b", "&amp;", "h&#45;2a", "long text " * 9, "é"]
HREFS = ['href="f.pdf"', "href='lca.xlsx'", "href=fy.pdf", 'href="x.html"', 'class="q"', 'href=""', 'title="a>b" href="k.csv"',
         'href="a/fy 2016.pdf"']


def _page(draw: random.Random) -> str:
    out = []
    for _ in range(draw.randint(0, 60)):
        kind, name = draw.random(), draw.choice(NAMES)
        if kind < 0.35:
            out.append(f"<{name}>" if name != "a" else f"<a {draw.choice(HREFS)}>")
        elif kind < 0.55:
            out.append(f"</{name}>")
        elif kind < 0.6:
            out.append(draw.choice(["<!-- c <b> -->", "<script>var x = '<td>'</script>", "<br/>", "<p/>", "</ x>", "<!DOCTYPE html>", "<TD class='z'>"]))
        else:
            out.append(draw.choice(TEXTS))
    return "".join(out)


def _want(html: str) -> list[tuple]:
    return [(x["href"], x["block"], x["heading"], x["row"], x["nth"], x["cell"])
            for x in pagewalk.page_links(html, lambda h: h.lower().endswith(ENDINGS))]


def _rules(spark, rows: list[tuple]) -> list[tuple]:
    """What the rules make of a cell and a file name."""
    frame = spark.createDataFrame([(i, r[0].rsplit("/", 1)[-1], r[5]) for i, r in enumerate(rows)], "i int, name string, cell string")
    found = {r[0]: tuple(r)[1:] for r in frame.select(
        "i", names.is_deprecated("name", "cell"), names.program_of_row("cell", "name")).collect()}
    return [(*r[:5], *(found[i] if r[5] is not None else (None, None))) for i, r in enumerate(rows)]


def _compare(spark, pages: list[str]) -> None:
    frame = spark.createDataFrame(list(enumerate(pages)), "page_id int, html string").withColumn("url", F.lit("http://h/"))
    got: dict = {i: [] for i in range(len(pages))}
    for r in pagetree.placed_links(frame).orderBy("page_id", "pos").collect():
        got[r["page_id"]].append((r["href"], r["block"], r["heading"], r["row"], r["nth"], r["cell"]))
    want = {i: _want(p) for i, p in enumerate(pages)}
    for i, page in enumerate(pages):
        assert [x[:5] for x in got[i]] == [x[:5] for x in want[i]], page
    ours, theirs = ([x for i in sorted(of) for x in of[i]] for of in (got, want))
    assert _rules(spark, ours) == _rules(spark, theirs)


def test_random_pages(spark):
    draw = random.Random(7)
    _compare(spark, [_page(draw) for _ in range(800)])


def test_deep_pages(spark, monkeypatch):
    monkeypatch.setattr(pagetree, "_DEPTH", 4)  # most open elements are put aside
    pagetree._links_in.cache_clear()
    draw = random.Random(8)
    _compare(spark, [_page(draw) for _ in range(300)])
    pagetree._links_in.cache_clear()


def test_phrases_over_many_elements(spark):
    link = '<a href="f.pdf">f</a>'
    _compare(spark, [
        f"<div>p<b>e<i>r</i>m</b>{link}</div>", f"<div>p<p>e<p>r{link}m</div>{link}", f"<li>h<b>-2<li>a{link}</li>{link}",
        f"<table><tr><td>{'x ' * 40}l<i>c</i>a</td><td>{link}</td></tr><tr><td>fy 2016<b> report</b></td><td>{link}</td></tr></table>",
        f"<table><tr><td>{'<i></i>' * 200}2016 report</td><td><a href='fy.pdf'>f</a></td></tr></table>",
        f"<table><tr><td>{'<b>y' * 150}</td><td>{link}</td></tr></table>{link}", f"l<b>ca {'<b>l<i>ca' * 90}{link}",
    ])


def _seconds(spark, html: str, links: int) -> float:
    frame = spark.createDataFrame([(1, "http://h/", html)], "page_id int, url string, html string")
    best = 1e9
    for _ in range(3):
        begin = time.perf_counter()
        assert pagetree.placed_links(frame).count() == links
        best = min(best, time.perf_counter() - begin)
    return best


@pytest.mark.parametrize("closed, unclosed", [
    ("<tr><td>PERM {0}</td><td><a href='f{0}.pdf'>f</a></td></tr>", "<tr><td>PERM {0}<td><a href='f{0}.pdf'>f</a>"),
    ("<li>text <a href='f{0}.pdf'>{0}</a></li>", "<li>text <a href='f{0}.pdf'>{0}</a>"),
])
def test_unclosed_elements_take_no_longer(spark, closed, unclosed):
    n = 8000
    times = [_seconds(spark, "<table>" + "".join(row.format(i) for i in range(n)), n) for row in (closed, unclosed)]
    assert times[1] < 2 * times[0] + 0.5, times


def test_no_python_and_no_shuffle(spark):
    frame = spark.createDataFrame([(1, "http://h/", "<a href='x.pdf'>x</a>")], "page_id int, url string, html string")
    for df in (w.table_links(frame), w.link_context(frame), w.classified_links(frame)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_a_file_of_one_row_group_is_read_by_many_tasks(spark, tmp_path):
    rows = [(i, f"http://h/{i}", f"<a href='f{i}.pdf'>f</a>") for i in range(300)] + [(None, None, None)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    frame.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    pages = webpages.placed_pages(spark, str(tmp_path))
    held = pages.groupBy(F.spark_partition_id()).count().collect()
    assert len(held) >= 4 * spark.sparkContext.defaultParallelism and sum(r["count"] for r in held) == 301
    assert pages.exceptAll(webpages.derive(frame, webpages.PLACED)).count() == 0

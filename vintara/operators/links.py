"""Links of stored web pages: extraction, first-seen order and classification.

``pages(page_id, url, html)`` holds one page per row. Anchors are found with array functions inside
the row. What encloses a link (table row, block) and the headings before it take a stack of open
elements: ``pagetree`` reads those pages. Neither needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintara.config.sites import EXTENSIONS, MONTHLY_TEXTS, NO_PROGRAM, YEAR_PAGE_TEXT
from vintara.functions import names, urls
from vintara.functions.text import col, strip
from vintara.operators.dedup import keep_first
from vintara.operators.markup import href_of, unescape
from vintara.operators.pagetree import placed_links

#: Comments, scripts and styles hold no links.
_HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
#: An opening tag up to its end, quoted values whole. Possessive, so that it runs without recursion.
_TAG = r"""(?s)^(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
#: Length that takes the rest of any array.
_REST = 2_000_000_000

def visible(html: Column | str) -> Column:
    return F.regexp_replace(col(html), _HIDDEN, "")


def plain_text(html: Column, squeeze: bool = True) -> Column:
    """Text of a fragment; ``squeeze`` strips every piece between tags before joining."""
    if not squeeze:
        return unescape(F.regexp_replace(html, "<[^>]*>", ""))
    return F.array_join(F.transform(F.split(html, "<[^>]*>"), lambda p: strip(unescape(p))), "")


def anchors_of(html: Column, squeeze: bool = False, only: Callable[[Column], Column] | None = None) -> Column:
    """Array of the anchors (pos, href, text) of a fragment, in document order.

    ``only`` tells by their address which are wanted; the texts of others are not put together.
    """
    pieces = F.slice(F.split(html, r"(?i)<a\s+"), 2, _REST)
    # what follows "<a": its attributes, and the markup inside the element
    tagged = F.transform(pieces, lambda piece: F.struct(
        F.regexp_extract(piece, _TAG, 0).alias("tag"), piece.alias("piece")))
    raw = F.transform(tagged, lambda t: F.struct(
        href_of(t["tag"]).alias("href"),
        F.regexp_extract(
            F.substring(t["piece"], F.length(t["tag"]) + 1, F.length(t["piece"])), r"(?is)^>?(.*?)(?:</a\s*>|\z)", 1
        ).alias("inner"),
    ))
    found = F.transform(F.filter(raw, lambda a: a["href"].isNotNull()), lambda a, i: F.struct(
        i.alias("pos"), a["href"].alias("href"), a["inner"].alias("inner")))
    wanted = found if only is None else F.filter(found, lambda a: only(a["href"]))
    return F.transform(wanted, lambda a: F.struct(
        a["pos"].alias("pos"), a["href"].alias("href"), plain_text(a["inner"], squeeze).alias("text")))


def links(pages: DataFrame, squeeze: bool = False, keep: Sequence[str] = (),
          only: Callable[[Column], Column] | None = None) -> DataFrame:
    """One row per anchor with an href: (page_id, base, pos, href, text) and kept page columns.

    ``squeeze`` strips every piece of the text between tags before they are joined; ``only`` tells
    by their address which anchors are wanted.
    """
    # outer: a plain explode would have the markup parsed again to infer a non-empty filter
    return pages.select(
        "page_id", F.col("url").alias("base"), *keep,
        F.explode_outer(anchors_of(visible("html"), squeeze, only)).alias("a"),
    ).where("a IS NOT NULL").select("page_id", "base", *keep, "a.pos", "a.href", "a.text")


def file_links(pages: DataFrame, kind: str = "disclosure", keep: Sequence[str] = ()) -> DataFrame:
    """Links to files of the extensions a kind of page offers, with their absolute url.

    The test is on the href as written, for ``annual`` pages on the absolute url, for
    ``yearbook`` pages on the path, so a query does not hide the extension.
    """
    extensions = EXTENSIONS[kind]
    # pages that hold no such extension, written out or by references, are not taken apart
    some = pages.where(F.col("html").rlike(r"(?i)\.(" + "|".join(extensions) + r")|&#|&period;"))
    # what can be no such file by its address alone goes first; a query alone takes the page's own path
    named = r"(?i)\.(" + "|".join(extensions) + r")|^\s*[?#]"
    found = links(some, keep=keep, only=lambda href: href.rlike(named)).where("href <> ''")
    if kind == "yearbook":
        found = found.withColumn("href", strip("href"))
    found = found.withColumn("url", urls.resolve_url("base", "href"))
    tested = {"annual": F.col("url"), "yearbook": urls.url_path("href")}.get(kind, F.col("href"))
    return found.where(urls.has_extension(tested, extensions))


def first_links(found: DataFrame, by: Sequence[str] = ("url",)) -> DataFrame:
    """First link of each url over all pages."""
    return keep_first(found, list(by), ["page_id", "pos"])


def anchor_by_text(pages: DataFrame, text: str) -> DataFrame:
    """First anchor of each page whose text contains ``text``, ignoring case."""
    hit = F.lower(F.col("text")).contains(text.lower()) & (F.col("href") != "")
    return (
        keep_first(links(pages).where(hit), ["page_id"], ["pos"])
        .select("page_id", "pos", urls.resolve_url("base", "href").alias("url"))
    )


def monthly_pages(pages: DataFrame) -> DataFrame:
    """(page_id, program, url) of the first link to each program's page of monthly files."""
    text = F.lower("text")
    program = F.coalesce(*[
        F.when(text.contains(announced.lower()), name) for name, announced in MONTHLY_TEXTS.items()
    ])
    found = links(pages).where("href <> ''").withColumn("program", program).where("program IS NOT NULL")
    return keep_first(found, ["page_id", "program"], ["pos"]).select(
        "page_id", "program", urls.resolve_url("base", "href").alias("url"))


def first_candidates(found: DataFrame) -> DataFrame:
    """The first link of each page."""
    return keep_first(found, ["page_id"], ["pos"])


def year_pages(pages: DataFrame, text: str = YEAR_PAGE_TEXT) -> DataFrame:
    """Distinct (year, url) of the links to yearly report pages, newest first."""
    found = links(pages).where((F.col("href") != "") & F.col("text").contains(text)).select(
        "page_id", "pos",
        names.year_of_link("text", "href").alias("year"),
        urls.resolve_url("base", "href").alias("url"),
    )
    first = keep_first(found.where(F.col("year").isNotNull()), ["year", "url"], ["page_id", "pos"])
    return first.orderBy(F.desc("year"), "page_id", "pos")


def yearbooks(pages: DataFrame) -> DataFrame:
    """Year -> yearbook url. The last link with the year in its path wins, else the first
    that names the year in its text. Aggregates only."""
    found = links(pages, squeeze=True)
    href = strip("href")
    by_path = F.regexp_extract(href, r"/yearbook/(\d{4})(?:-\d{4})?/?$", 1)
    by_text = F.regexp_extract("text", r"(?i)Yearbook\s+(\d{4})(?:\s+to\s+\d{4})?", 1)
    at = F.struct("page_id", "pos")
    dated = found.select(
        F.when(by_path != "", by_path).when(by_text != "", by_text).alias("year"),
        (by_path != "").alias("in_path"), at.alias("at"), urls.resolve_url("base", href).alias("url"),
    ).where(F.col("year").isNotNull())
    return (
        dated.groupBy("year")
        .agg(F.coalesce(
            F.max_by("url", F.when(F.col("in_path"), F.col("at"))),
            F.min_by("url", F.when(~F.col("in_path"), F.col("at"))),
        ).alias("url"))
        .orderBy(F.desc("year"))
    )


# ---- links in their place on the page ----


def table_links(pages: DataFrame, kind: str = "disclosure") -> DataFrame:
    """File links in the second and later cells of table rows, classified by the first cell.

    In nested tables a link belongs to the innermost such row.
    """
    return _of_rows(placed_links(pages, kind)).select("page_id", "row", "nth", "filename", "program", "url", "year")


def _of_rows(placed: DataFrame) -> DataFrame:
    filename = urls.last_segment("href")
    return (
        placed.where("row IS NOT NULL")
        .withColumn("filename", filename)
        .where(~names.is_deprecated("filename", "cell"))
        .withColumn("program", names.program_of_row("cell", "filename"))
        .withColumn("url", urls.normalise_url(urls.resolve_url("base", "href")))
        .withColumn("year", names.year_of_file("filename"))
    )


def link_context(pages: DataFrame, kind: str = "disclosure") -> DataFrame:
    """File links with the program that their nearest enclosing block names and the program of the
    nearest preceding heading that announces one: (page_id, base, pos, href, block, heading)."""
    return placed_links(pages, kind).select("page_id", "base", "pos", "href", "block", "heading")


def classified_links(pages: DataFrame, kind: str = "disclosure") -> DataFrame:
    """File links anywhere on a page, with their program by file name, block or heading."""
    return _of_pages(placed_links(pages, kind)).select("page_id", "pos", "filename", "program", "url", "year")


def _of_pages(placed: DataFrame) -> DataFrame:
    filename = urls.last_segment("href")
    return (
        placed.withColumn("filename", filename)
        .where(~names.is_deprecated("filename"))
        .withColumn("program", F.coalesce(names.program_of("filename"), "block", "heading", F.lit(NO_PROGRAM)))
        .withColumn("url", urls.normalise_url(urls.resolve_url("base", "href")))
        .withColumn("year", names.year_of_file("filename"))
    )


def all_links(pages: DataFrame, kind: str = "disclosure") -> DataFrame:
    """Links in table rows and file links anywhere, classified by their place: (page_id, source,
    pos, program, year, url, filename), ``source`` 0 for tables. A link in a table is both.

    Pages are read once; each link gives its rows where it is found.
    """
    filename = urls.last_segment("href")
    placed = placed_links(pages, kind).withColumn("filename", filename).withColumns({
        "url": urls.normalise_url(urls.resolve_url("base", "href")), "year": names.year_of_file("filename")})
    in_row = F.when(F.col("row").isNotNull() & ~names.is_deprecated("filename", "cell"), F.struct(
        F.lit(0).alias("source"), F.lit(0).alias("pos"), names.program_of_row("cell", "filename").alias("program")))
    anywhere = F.when(~names.is_deprecated("filename"), F.struct(
        F.lit(1).alias("source"), F.col("pos"),
        F.coalesce(names.program_of("filename"), "block", "heading", F.lit(NO_PROGRAM)).alias("program")))
    found = placed.select("page_id", "year", "url", "filename", F.explode_outer(F.array(in_row, anywhere)).alias("as")).where("as IS NOT NULL")
    return found.select("page_id", "as.source", "as.pos", "as.program", "year", "url", "filename")


def discover_files(pages: DataFrame, kind: str = "disclosure") -> DataFrame:
    """All file links of each page: those in tables, then each further url once.

    Both kinds are ranked together per (page, url), a group no larger than a page's links.
    """
    rank = F.row_number().over(Window.partitionBy("page_id", "url").orderBy("source", "pos"))
    return (
        all_links(pages, kind).withColumn("_rank", rank)
        .where((F.col("source") == 0) | (F.col("_rank") == 1))
        .select("page_id", "program", "year", "url", "filename", F.when(F.col("source") == 0, "table").otherwise("page").alias("found_in"))
    )

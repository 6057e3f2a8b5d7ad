"""Queries over stored pages and over names found on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vintara.catalog import ORACLES, cases, derive, derive_sql, query, quote, strip_sql, table
from vintara.config.sites import (
    DEPRECATED_TEXTS,
    EXTENSIONS,
    FOLDERS,
    LAYOUT_TEXTS,
    MONTHS,
    NO_PROGRAM,
    PROGRAM_KEYS,
    SOURCES,
)
from vintara.functions import names, urls
from vintara.operators import links as w
from vintara.plans.acquire import candidates, labelled_candidates

# ---- pages, each followed by links of the kinds that data sites have ----

_N = "cast(page_id as string)"
_HREFS = [
    "/files/FY2024_perm.XLSX", "../x/h2a_2019.csv", "pw.pdf", "//cdn.example.org/lca_FY19.zip",
    "HTTPS://Files.Example.org/A//b.xls", "./a/../b.doc", "?q=1.pdf", "#f.csv", "r.pdf?dl=1&amp;x=2",
]
_HEADINGS = ["PERM program data", "Annual LCA report", "H-2B <i> files </i>", "News", "cw-1"]
_CONTEXT = ["Released in May 2021:", "h2a <b>data</b>", "prevailing &amp; more"]
HTML = (
    "html || '<h3>' || " + cases("page_id % 6", _HEADINGS, "'Other'") + " || '</h3><ul class=\"x\"><li>' || "
    + cases("page_id % 4", _CONTEXT, "'see'") + " || ' <a class=\"k\" href=\"' || " + cases("page_id % 10", _HREFS, f"'f' || {_N} || '.xlsx'")
    + " || '\"> File <b>' || " + _N + " || '</b></a></li><li>next <a href=''/n/' || " + cases("page_id % 5", ["lca", "annual-report", "x_FY2016", "fy 2016 report"], _N)
    + " || '.pdf''>Report of the Visa Office ' || cast(2000 + page_id % 30 as string) || '</a></li></ul>"
    "<p>The <a href=/yearbook/' || cast(2000 + page_id % 20 as string) || '>Yearbook ' || cast(1990 + page_id % 50 as string) || '</a> and "
    "<a href=\"/topics/' || " + _N + " || '\">Yearbook ' || cast(1995 + page_id % 60 as string) || ' to 2050</a></p>"
    "<!-- <a href=\"/hidden.pdf\">no</a> --><table><tr><td> ' || " + cases("page_id % 7", ["PERM", "Other", "LCA <i>x</i>", "annual report"], "'H-2A'")
    + " || ' </td><td><a href=\"t' || " + _N + " || '_2020.xlsx\">t</a></td><td><a href=\"' || " + cases("page_id % 3", ["cw1", "fy23"], "'z'")
    + " || '.pdf\">u</a><a href=\"none.html\">v</a></td></tr><tr><td>only <a href=\"only.csv\">o</a></td></tr></table>"
    "<strong>H-2B last</strong><div>in <p>p</p><a href=\"t' || " + _N + " || '_2020.xlsx\">again</a><a href=\"e.doc\">e</a></div>'"
)
PAGES = {"page_id": "page_id", "url": "url", "html": HTML}


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(table(spark, sf_dir, "pages"), PAGES)


PAGES_SQL = derive_sql("pages", PAGES)
_ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": chr(160), "&#160;": chr(160), "&amp;": "&"}


def unescape_sql(value: str) -> str:
    for reference, char in _ENTITIES.items():
        value = f"replace({value}, {quote(reference)}, {quote(char)})"
    return value


_VISIBLE = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_HREF = r"""(?is)^(?:(?:[^>"']|"[^"]*"|'[^']*')*?[\s"'])?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
_INNER = r"(?is)^[^>]*>(.*?)(?:</a\s*>|\z)"


def visible_sql(html: str) -> str:
    return f"regexp_replace({html}, {quote(_VISIBLE)}, '', 'g')"


def anchor_list_sql(html: str) -> str:
    found = (
        f"list_filter(list_transform(string_split_regex({html}, '(?i)<a\\s+')[2:], lambda p: "
        f"{{'v': regexp_extract(p, {quote(_HREF)}, 1), 'i': regexp_extract(p, {quote(_INNER)}, 1)}}), lambda a: a.v <> '')"
    )
    href = unescape_sql("regexp_replace(a.v, '^[\"'']|[\"'']$', '', 'g')")
    text = unescape_sql("regexp_replace(a.i, '<[^>]*>', '', 'g')")
    return f"list_transform({found}, lambda a: {{'href': {href}, 'text': {text}}})"


def anchors_sql(source: str) -> str:
    return f"""(SELECT page_id, base, pos, a.href AS href, a.text AS text FROM (
  SELECT page_id, base, unnest(l) AS a, cast(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos
  FROM (SELECT page_id, url AS base, {anchor_list_sql(visible_sql('html'))} AS l FROM {source})))"""


_HOST = "regexp_extract(base, '^([a-z]+:)(//[^/?#]*)', 1) || regexp_extract(base, '^([a-z]+:)(//[^/?#]*)', 2)"
_SCHEME = "regexp_extract(base, '^([a-z]+:)', 1)"
_PATH = "regexp_extract(base, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
_FOLDER = f"regexp_replace('/' || {_PATH}, '^//', '/')"
_FOLDER = f"regexp_replace({_FOLDER}, '[^/]*$', '')"
#: Resolution of exactly the kinds of hrefs the pages have.
RESOLVED_SQL = f"""CASE WHEN lower(split_part(href, ':', 1)) || ':' = {_SCHEME} THEN {_SCHEME} || substr(href, length({_SCHEME}) + 1)
WHEN regexp_matches(href, '^[A-Za-z]+:') THEN href
WHEN href LIKE '//%' THEN {_SCHEME} || href WHEN href LIKE '/%' THEN {_HOST} || href
WHEN href LIKE '?%' THEN {_HOST} || {_PATH} || href
WHEN href LIKE '#%' THEN regexp_replace(base, '#.*$', '') || href
WHEN href LIKE '../%' THEN {_HOST} || regexp_replace({_FOLDER}, '[^/]+/$', '') || substr(href, 4)
WHEN href LIKE './a/../%' THEN {_HOST} || {_FOLDER} || substr(href, 8)
ELSE {_HOST} || {_FOLDER} || href END"""


def normal_sql(url: str) -> str:
    return (
        f"lower(regexp_extract({url}, '^([A-Za-z]+://[^/?#]*)', 1)) || "
        f"regexp_replace(regexp_extract({url}, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') || "
        f"regexp_extract({url}, '^[^?#]*(.*)$', 1)"
    )


def extension_sql(value: str, kind: str) -> str:
    return f"regexp_matches({value}, '(?i)\\.({'|'.join(EXTENSIONS[kind])})\\z')"


@query(f"SELECT page_id, base, pos, href, text FROM {anchors_sql('pages')}")
def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All anchors of the stored pages."""
    return w.links(table(spark, sf_dir, "pages"))


@query(f"SELECT page_id, pos, href, {RESOLVED_SQL} AS url FROM {anchors_sql(PAGES_SQL)}")
def links_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absolute urls of all anchors."""
    found = w.links(pages(spark, sf_dir))
    return found.select("page_id", "pos", "href", urls.resolve_url("base", "href").alias("url"))


RAW_URLS = {
    "page_id": "page_id",
    "url": "' ' || " + cases("page_id % 3", ["HTTP://Www.Example.ORG/Path/To//", "https://A.B/?Q=1#F"], "upper(substr(url, 1, 12)) || substr(url, 13) || ' '"),
}


@query(f"SELECT page_id, {normal_sql('u')} AS url FROM (SELECT page_id, trim(url) AS u FROM {derive_sql('pages', RAW_URLS)})")
def urls_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised urls."""
    return derive(table(spark, sf_dir, "pages"), RAW_URLS).select("page_id", urls.normalise_url("url").alias("url"))


_FOUND_SQL = f"(SELECT *, {RESOLVED_SQL} AS url FROM {anchors_sql(PAGES_SQL)})"
_TESTED = {"disclosure": "href", "annual": "url", "yearbook": "regexp_extract(href, '^(?:[A-Za-z]+:)?(?://[^/?#]*)?([^?#]*)', 1)"}


def _file_links_sql(kind: str) -> str:
    return f"SELECT page_id, base, pos, href, text, url FROM {_FOUND_SQL} WHERE {extension_sql(_TESTED[kind], kind)}"


@query(" UNION ALL ".join(f"SELECT *, '{k}' AS kind FROM ({_file_links_sql(k)})" for k in _TESTED))
def file_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links to files, by the extension test of three kinds of pages."""
    some = pages(spark, sf_dir)
    frames = [w.file_links(some, k).withColumn("kind", F.lit(k)) for k in _TESTED]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(f"""SELECT page_id, base, pos, href, text, url FROM ({_file_links_sql('disclosure')})
QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id, pos) = 1""")
def links_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First link of each url over all pages."""
    return w.first_links(w.file_links(pages(spark, sf_dir)))


@query(f"""SELECT page_id, pos, {RESOLVED_SQL} AS url FROM {anchors_sql(PAGES_SQL)}
WHERE contains(lower(text), 'yearbook 20') QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY pos) = 1""")
def anchor_by_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First anchor of each page with a text."""
    return w.anchor_by_text(pages(spark, sf_dir), "Yearbook 20")


@query(f"""SELECT page_id, base, pos, href, text, url FROM ({_file_links_sql('disclosure')})
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY pos) = 1""")
def first_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first file each page offers."""
    return w.first_candidates(w.file_links(pages(spark, sf_dir)))


def year_sql(value: str) -> str:
    return f"nullif(regexp_extract({value}, '(?:^|[^\\pL\\pN_])(20\\d{{2}})(?:[^\\pL\\pN_]|\\z)', 1), '')"


@query(f"""SELECT page_id, pos, "year", url FROM (
  SELECT *, coalesce({year_sql('text')}, {year_sql('href')}) AS "year" FROM {_FOUND_SQL}
  WHERE contains(text, 'Report of the Visa Office')) WHERE "year" IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY "year", url ORDER BY page_id, pos) = 1""")
def year_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly report pages, newest first."""
    return w.year_pages(pages(spark, sf_dir))


@query(f"""
WITH y AS (SELECT *, regexp_extract(trim(href), '/yearbook/(\\d{{4}})(?:-\\d{{4}})?/?$', 1) AS p,
                  regexp_extract(trim(text), '(?i)Yearbook\\s+(\\d{{4}})', 1) AS t FROM {_FOUND_SQL}),
k AS (SELECT page_id, pos, url, p <> '' AS in_path, CASE WHEN p <> '' THEN p ELSE nullif(t, '') END AS "year" FROM y)
SELECT "year", url FROM k WHERE "year" IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY "year" ORDER BY in_path DESC,
  CASE WHEN in_path THEN -page_id ELSE page_id END, CASE WHEN in_path THEN -pos ELSE pos END) = 1""")
def yearbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearbook of each year."""
    return w.yearbooks(pages(spark, sf_dir))


# ---- classification ----


def program_sql(*values: str) -> str:
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains(lower({v}), {quote(k)})" for v in values) + f" THEN {quote(p)}"
        for k, p in PROGRAM_KEYS.items())
    return f"CASE {whens} END"


def deprecated_sql(name: str, context: str = "''") -> str:
    both = f"lower({name} || ' ' || {context})"
    layout = " OR ".join(f"contains({both}, {quote(t)})" for t in LAYOUT_TEXTS)
    dated = " OR ".join(f"contains({both}, {quote(t)})" for t in DEPRECATED_TEXTS)
    return (f"(NOT ({layout}) AND ({dated} OR (contains({both}, 'annual') AND contains({both}, 'report') "
            f"AND lower({name}) LIKE '%.pdf')))")


def file_year_sql(name: str, fallback: str) -> str:
    fy = f"regexp_extract({name}, '(?i)fy\\s*(\\d{{2,4}})', 1)"
    return f"CASE WHEN length({fy}) = 2 THEN '20' || {fy} WHEN {fy} <> '' THEN {fy} ELSE {fallback} END"


def any_year_sql(name: str) -> str:
    return file_year_sql(name, f"coalesce(nullif(regexp_extract({name}, '(19|20)\\d{{2}}', 0), ''), 'unknown_year')")


FILES = {
    "doc_id": "doc_id",
    "filename": cases("doc_id % 16", [
        "PERM_Record_Layout_FY2016.pdf", "FY 2016 Report.pdf", "Annual_Report_2019.pdf", "annual report.xlsx",
        "H-1B_fy24.xlsx", "lca FY 123 x.csv", "pwd_1999.xls", "cw-1 (2021).zip", "h2b_20201.csv", "x.2018.csv",
        "Annual performance report 2008.doc"], "source || '_' || lang || '_' || cast(1990 + doc_id % 40 as string) || '.csv'"),
    "context": "text",
}
_FILES_SQL = derive_sql("documents", FILES)


@query(f"""SELECT doc_id, filename, {any_year_sql('filename')} AS year_any, {file_year_sql('filename', year_sql('filename'))} AS year_hub,
coalesce({year_sql('context')}, {year_sql('filename')}) AS year_link,
'h1b/' || coalesce({file_year_sql('filename', year_sql('filename'))}, 'misc') AS period FROM {_FILES_SQL}""")
def file_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years in file names and texts, and the period made of them."""
    return derive(table(spark, sf_dir, "documents"), FILES).select(
        "doc_id", "filename", names.year_of_file("filename").alias("year_any"),
        names.year_of_hub_file("filename").alias("year_hub"),
        names.year_of_link("context", "filename").alias("year_link"),
        names.hub_period(F.lit("h1b"), "filename").alias("period"))


@query(f"""SELECT doc_id, {program_sql('filename')} AS by_name, {program_sql('context')} AS by_context,
coalesce({program_sql('context', 'filename')}, '{NO_PROGRAM}') AS by_row,
CASE WHEN NOT contains(lower(context), 'annual') THEN {program_sql('context')} END AS by_heading FROM {_FILES_SQL}""")
def programs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Programs named by file names and texts."""
    return derive(table(spark, sf_dir, "documents"), FILES).select(
        "doc_id", names.program_of("filename").alias("by_name"), names.program_of("context").alias("by_context"),
        names.program_of_row("context", "filename").alias("by_row"),
        names.heading_program("context").alias("by_heading"))


@query(f"""SELECT doc_id, filename FROM {_FILES_SQL} WHERE NOT {deprecated_sql('filename', 'context')}""")
def skip_deprecated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are not deprecated annual reports."""
    rows = derive(table(spark, sf_dir, "documents"), FILES)
    return rows.where(~names.is_deprecated("filename", "context")).select("doc_id", "filename")


ISSUES = {
    "doc_id": "doc_id",
    "text": cases("doc_id % 14", [
        " January  2024", "FY 2023 May", "FY2022", "2021 report", "Sept 2020", "nothing", "10/2019 data", "2018-07 x",
        "Dec. and Nov 2017", "FY 21 March", "april2020"], "''") + " || ' ' || text",
    "href": cases("doc_id % 5", ["/a/FY2019-june.pdf", "/x/oct/2016.csv", "/x_2015_jul.pdf"], "'/y.pdf'"),
}


def _word_sql(word: str) -> str:
    return f"regexp_matches(both_texts, '(?i)(?:^|[^\\pL\\pN_]){word}(?:[^\\pL\\pN_]|\\z)')"


_SQUEEZED = ("regexp_replace(" + strip_sql("text") + r", '[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
             r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g')")
_MONTH = "CASE " + " ".join(f"WHEN {_word_sql(k)} THEN {v}" for k, v in MONTHS.items()) + " END"
_SLASH, _DASH = r"(?:^|\D)(\d{1,2})/(20\d{2})(?:\D|$)", r"(?:^|\D)(20\d{2})-(\d{2})(?:\D|$)"


def period_sql(source: str, key: str) -> str:
    """Period of each row of ``source`` with a text and an href."""
    return f"""
SELECT {key}, CASE WHEN y IS NULL THEN 'misc' WHEN mm IS NULL THEN 'FY' || y
  ELSE 'FY' || y || '-' || lpad(cast(mm as string), 2, '0') END AS period
FROM (SELECT {key}, coalesce(month, num) AS mm, coalesce(
    nullif(regexp_extract(both_texts, '(?i)(?:^|[^\\pL\\pN_])fy\\s*(20\\d{{2}})(?:[^\\pL\\pN_]|\\z)', 1), ''),
    CASE WHEN num IS NOT NULL THEN coalesce(nullif(regexp_extract(t, '{_SLASH}', 2), ''), nullif(regexp_extract(t, '{_DASH}', 1), '')) END,
    {year_sql('both_texts')}) AS y
  FROM (SELECT *, CASE WHEN month IS NULL AND n BETWEEN 1 AND 12 THEN n END AS num FROM (
    SELECT *, {_MONTH} AS month, cast(coalesce(nullif(regexp_extract(t, '{_SLASH}', 1), ''), nullif(regexp_extract(t, '{_DASH}', 2), '')) AS INTEGER) AS n
    FROM (SELECT *, t || ' ' || href AS both_texts FROM (SELECT {key}, href, {_SQUEEZED} AS t FROM {source})))))
"""


@query(period_sql(derive_sql("documents", ISSUES), "doc_id"))
def month_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periods of monthly files from link texts and addresses."""
    return derive(table(spark, sf_dir, "documents"), ISSUES).select(
        "doc_id", names.month_period("text", "href").alias("period"))


PLACES = {
    "doc_id": "doc_id",
    "file_type": cases("doc_id % 5", ["monthly", "annual", "dol", "yearbook"], "'uscis'"),
    "program": "' ' || " + cases("doc_id % 4", ["IV", "PERM: <new>", "a/b|c*d?"], "chr(92) || source || ' \"'") + " || text || '\" '",
    "period": cases("doc_id % 3", ["FY2024-10", "misc"], "cast(2000 + doc_id % 25 as string)"),
    "url": "'https://h/p/' || " + cases("doc_id % 6", ["a.b.xlsx?x=1", "dir/", "?q", "name", "N.PDF"], "source || '.zip'"),
    "version": "cast(doc_id % 4 + 1 as int)",
}
_PLACES_SQL = derive_sql("documents", PLACES)
_SAFE = f"regexp_replace({strip_sql('program')}, '[\\\\/*?:\"<>|]', '_', 'g')"


@query(f"""SELECT doc_id, substr({_SAFE}, 1, 80) AS safe_program, CASE file_type
WHEN 'monthly' THEN '/data/{FOLDERS['monthly']}/' || program || '/' || CASE WHEN period LIKE 'FY____%' THEN substr(period, 1, 6) || '/' ELSE '' END || period
WHEN 'annual' THEN '/data/{FOLDERS['annual']}/' || period
WHEN 'dol' THEN '/data/{FOLDERS['dol']}/' || {_SAFE} || '/' || period
WHEN 'yearbook' THEN '/data/{FOLDERS['yearbook']}/' || period
ELSE '/data/{FOLDERS['uscis']}/' || program || '/' || period END AS folder FROM {_PLACES_SQL}""")
def storage_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder names and where files are stored."""
    return derive(table(spark, sf_dir, "documents"), PLACES).select(
        "doc_id", names.safe_name("program").alias("safe_program"),
        names.storage_folder("file_type", "program", "period").alias("folder"))


_LAST = "regexp_extract(regexp_replace(split_part(url, '?', 1), '/+$', ''), '[^/]*$', 0)"
_NAME = f"CASE WHEN {_LAST} <> '' THEN {_LAST} ELSE period || '.bin' END"


@query(f"""SELECT doc_id, name, CASE WHEN contains(name, '.') THEN split_part(name, '.', 1) || '.v' || cast(version as string) || substr(name, length(split_part(name, '.', 1)) + 1)
  ELSE name || '.v' || cast(version as string) END AS versioned, hub, lower(CASE WHEN url LIKE '%?q' THEN {_LAST} ELSE hub END) AS yearbook FROM (
  SELECT *, {_NAME} AS name, CASE WHEN url LIKE '%?q' AND {_LAST} = '' THEN 'file_' || substr(md5(url), 1, 8) || '.csv' ELSE {_LAST} END AS hub FROM {_PLACES_SQL})""")
def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names downloads are stored under."""
    return derive(table(spark, sf_dir, "documents"), PLACES).select(
        "doc_id", urls.file_name("url", "period").alias("name"),
        urls.versioned_name(urls.file_name("url", "period"), F.col("version")).alias("versioned"),
        urls.hub_file_name("url").alias("hub"), urls.yearbook_file_name("url").alias("yearbook"))


# ---- table rows and context ----


# Pages that begin with a part whose elements are known: unclosed items and paragraphs, nested tables,
# references. What is expected of each link follows from how the part is put together.

_TITLE = cases("page_id % 6", _HEADINGS, "'Other'")
_TITLE_PROGRAM = cases("page_id % 6", ["PERM Program", "", "H-2B Program", "", "CW-1 Program"], "''")
_ITEM = cases("page_id % 4", _CONTEXT, "'see'")
_ITEM_TEXT = cases("page_id % 4", ["Released in May 2021:", "h2adata", "prevailing & more"], "'see'")
_FIRST = cases("page_id % 10", _HREFS, f"'f' || {_N} || '.xlsx'")
_SECOND = "'/n/' || " + cases("page_id % 5", ["lca", "annual-report", "x_FY2016", "fy 2016 report"], _N) + " || '.pdf'"
_ROW = cases("page_id % 7", ["PERM", "Other", "LCA <i>x</i>", "annual report"], "'H-2A'")
_ROW_TEXT = cases("page_id % 7", ["PERM", "Other", "LCAx", "annual report"], "'H-2A'")
_THIRD, _FOURTH = f"'t' || {_N} || '_2020.xlsx'", cases("page_id % 3", ["cw1", "fy23"], "'z'") + " || '.pdf'"
PLACED = {"page_id": "page_id", "url": "url", "html": " || ".join([
    "'<html><body><h3>'", _TITLE, "'</h3><ul class=\"x\"><li>'", _ITEM, "' <a class=\"k\" href=\"'", _FIRST, "'\"> File <b>'", _N,
    "'</b></a></li><li>next <a href=\"'", _SECOND, "'\">Report</a></ul><p>never closed <table><tr><td> '", _ROW,
    "' </td><td><a href=\"'", _THIRD, "'\">t</a></td><td><a href=\"'", _FOURTH, "'\">u</a><a href=\"none.html\">v</a></td></tr>'",
    "'<tr><td>only <a href=\"only.csv\">o</a></td></tr><tr><td>LCA</td><td><table><tr><td>PERM</td><td><a href=\"in'", _N,
    "'&#46;pdf\">i</a></td></tr></table><a href=\"out'", _N, "'.pd&#102;\">x</a></td></tr><tr><td>H&#45;2A</td><td><a href=\"after'", _N,
    "'&period;csv\">a</a></td></tr></table><strong>H&#x2d;2B last</strong><div>in <p>p<a href=\"'", _THIRD,
    "'\">again</a><a href=\"e.doc\">e</a></div></body></html>'", "html"])}


def placed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages dealt evenly over the tasks: reading what encloses a link takes some 10 ms of a page, and
    a file gives no more tasks than it has row groups."""
    read = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    tasks = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return derive(read.repartition(tasks), PLACED)


def _place(pos: int, href: str, block: str = "''", heading: str | None = None, row: int | None = None,
           nth: int | None = None, cell: str = "NULL") -> str:
    """What is expected of a link: its block by the block's text, its row by number."""
    said = heading or f"nullif({_TITLE_PROGRAM}, '')"
    number = lambda n: "NULL" if n is None else str(n)
    return (f"{{'pos': {pos}, 'href': {href}, 'block': {program_sql(block)}, 'heading': {said}, "
            f"'row': {number(row)}::INTEGER, 'nth': {number(nth)}::INTEGER, 'cell': {cell}::VARCHAR}}")


_PLACES_OF_LINKS = ", ".join([
    _place(1, f"replace({_FIRST}, '&amp;', '&')", f"({_ITEM_TEXT} || 'File' || {_N})"),
    _place(2, _SECOND, "'nextReport'"),
    _place(3, _THIRD, "'t'", row=0, nth=0, cell=_ROW_TEXT),
    _place(4, _FOURTH, "'uv'", row=0, nth=1, cell=_ROW_TEXT),
    _place(5, "'only.csv'", "'onlyo'"),
    _place(6, f"'in' || {_N} || '.pdf'", "'i'", row=3, nth=0, cell="'PERM'"),
    _place(7, f"'out' || {_N} || '.pdf'", "'PERMix'", row=2, nth=0, cell="'LCA'"),
    _place(8, f"'after' || {_N} || '.csv'", "'a'", row=4, nth=0, cell="'H-2A'"),
    _place(9, _THIRD, "'pagaine'", "'H-2B Program'"),
    _place(10, "'e.doc'", "'pagaine'", "'H-2B Program'"),
])
_PLACED_SQL = f"""(SELECT * FROM (SELECT page_id, base, unnest(x) FROM (
  SELECT page_id, url AS base, unnest([{_PLACES_OF_LINKS}]) AS x FROM pages)) WHERE {extension_sql('href', 'disclosure')})"""

_TABLE_SQL = f"""(SELECT page_id, "row", nth, filename, coalesce({program_sql('cell', 'filename')}, '{NO_PROGRAM}') AS program,
  {normal_sql('full_url')} AS url, {any_year_sql('filename')} AS "year"
FROM (SELECT *, {RESOLVED_SQL} AS full_url, regexp_extract(href, '[^/]*$', 0) AS filename FROM {_PLACED_SQL} WHERE "row" IS NOT NULL)
WHERE NOT {deprecated_sql('filename', 'cell')})"""


_MONTHLY = {"page_id": "page_id", "url": "url", "html": " || ".join([
    "'<a>Monthly Immigrant Visa (IV) Issuances</a><a href=\"/first/'", _N, "'\">see monthly <b>nonimmigrant</b> visa (NIV) issuances</a>'",
    "CASE WHEN page_id % 3 = 0 THEN '<p>Monthly Immigrant Visa (IV) Issuances</p>' ELSE '<a href=\"iv&#x2F;' || " + _N
    + " || '\">Monthly Immigrant Visa &#40;IV&#41; Issuances</a>' END", "'<a href=\"/later\">Monthly Nonimmigrant Visa (NIV) Issuances</a>'", "html"])}


@query(f"""SELECT page_id, program, {RESOLVED_SQL} AS url FROM (
  SELECT page_id, url AS base, 'NIV' AS program, '/first/' || {_N} AS href FROM pages
  UNION ALL SELECT page_id, url, 'IV', 'iv/' || {_N} FROM pages WHERE page_id % 3 <> 0)""")
def monthly_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first link to each program's page of monthly files."""
    return w.monthly_pages(derive(table(spark, sf_dir, "pages"), _MONTHLY))


@query(f"SELECT * FROM {_TABLE_SQL}")
def table_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File links in table rows, classified by the row's first cell."""
    return w.table_links(placed_pages(spark, sf_dir))


_CONTEXT_SQL = f"SELECT page_id, base, pos, href, block, heading FROM {_PLACED_SQL}"


@query(f"""SELECT page_id, base, href, block, heading, cast(row_number() OVER (PARTITION BY page_id ORDER BY pos) AS INTEGER) AS nth
FROM ({_CONTEXT_SQL})""")
def link_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File links with the program of their block and of the heading above."""
    order = Window.partitionBy("page_id").orderBy("pos")
    found = w.link_context(placed_pages(spark, sf_dir))
    return found.withColumn("nth", F.row_number().over(order)).drop("pos")


_CLASSIFIED_SQL = f"""(SELECT page_id, pos, filename, coalesce({program_sql('filename')}, block, heading, '{NO_PROGRAM}') AS program,
  {normal_sql('full_url')} AS url, {any_year_sql('filename')} AS "year"
FROM (SELECT *, {RESOLVED_SQL} AS full_url, regexp_extract(href, '[^/]*$', 0) AS filename FROM ({_CONTEXT_SQL}))
WHERE NOT {deprecated_sql('filename')})"""


@query(f"""
WITH tab AS (SELECT * FROM {_TABLE_SQL})
SELECT page_id, program, "year", url, filename, 'table' AS found_in FROM tab
UNION ALL SELECT page_id, program, "year", url, filename, 'page' FROM (
  SELECT * FROM {_CLASSIFIED_SQL} c WHERE NOT EXISTS (SELECT 1 FROM tab WHERE tab.page_id = c.page_id AND tab.url = c.url)
  QUALIFY row_number() OVER (PARTITION BY page_id, url ORDER BY pos) = 1)""")
def discover_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files each page offers, with program and year."""
    return w.discover_files(placed_pages(spark, sf_dir))


_DISCOVERED_SQL = f"""
SELECT page_id, program, "year", url, filename FROM {_TABLE_SQL}
UNION ALL SELECT page_id, program, "year", url, filename FROM {_CLASSIFIED_SQL}"""


@query(f"""SELECT program, count(DISTINCT url) AS urls, count(*) AS links, min("year") AS first_year, max("year") AS last_year
FROM ({_DISCOVERED_SQL}) GROUP BY program""")
def links_by_program(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the pages offer by program, in tables and elsewhere."""
    return w.all_links(placed_pages(spark, sf_dir)).groupBy("program").agg(
        F.countDistinct("url").alias("urls"), F.count("*").alias("links"), F.min("year").alias("first_year"),
        F.max("year").alias("last_year"))


@query(f"""
SELECT program || '/' || "year" AS period, url, program, "year", 'dolstats' AS source_id, 'dol' AS file_type,
  '/data/performance_data/' || program || '/' || "year" AS folder, filename,
  '/data/performance_data/' || program || '/' || "year" || '/' || filename AS saved_path
FROM ({ORACLES['discover_files']})
QUALIFY row_number() OVER (PARTITION BY program, "year", url ORDER BY page_id, found_in DESC, filename) = 1""")
def run_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One candidate per (period, url) over all pages, with its folder."""
    return candidates(placed_pages(spark, sf_dir)).select(
        "period", "url", "program", "year", "source_id", "file_type", "folder", "filename", "saved_path")


_PROGRAM_LABEL = "CASE WHEN page_id % 2 = 0 THEN 'IV' ELSE 'NIV' END"
_YEAR_LABEL = "cast(2000 + page_id % 25 as string)"
LABELS = {"monthly": _PROGRAM_LABEL, "employer": _PROGRAM_LABEL, "annual": _YEAR_LABEL, "yearbook": _YEAR_LABEL}


def _labelled_sql(kind: str) -> str:
    tested = {"annual": "url", "yearbook": _TESTED["yearbook"]}.get(kind, "href")
    found = (f"(SELECT page_id, pos, href, text, url, {LABELS[kind]} AS label FROM {_FOUND_SQL} "
             f"WHERE href <> '' AND {extension_sql(tested, kind)} "
             "QUALIFY row_number() OVER (PARTITION BY page_id, url ORDER BY pos) = 1)")
    cut = "split_part(split_part(url, '?', 1), '#', 1)" if kind == "employer" else "split_part(url, '?', 1)"
    path = f"regexp_extract(regexp_replace({cut}, '/+$', ''), '[^/]*$', 0)"
    if kind == "monthly":
        texts = f"(SELECT page_id, pos, CASE WHEN text <> '' THEN text ELSE href END AS text, url AS href FROM {found})"
        rows = f"""SELECT f.page_id, f.pos, label AS program, CAST(NULL AS VARCHAR) AS "year", p.period, url, {path} AS filename,
  'visa_stats/monthly/' || label || '/' || CASE WHEN p.period LIKE 'FY____%' THEN substr(p.period, 1, 6) || '/' ELSE '' END || p.period AS folder
FROM {found} f JOIN ({period_sql(texts, 'page_id, pos')}) p ON p.page_id = f.page_id AND p.pos = f.pos"""
    elif kind == "employer":
        year = file_year_sql("filename", year_sql("filename"))
        rows = f"""SELECT page_id, pos, label AS program, {year} AS "year", label || '/' || coalesce({year}, 'misc') AS period, url, filename,
  'uscis_data/' || label || '/' || coalesce({year}, 'misc') AS folder FROM (SELECT *, {path} AS filename FROM {found})"""
    else:
        name = "lower(regexp_extract(split_part(split_part(href, '?', 1), '#', 1), '[^/]*$', 0))" if kind == "yearbook" else path
        folder = "immigration_yearbook/" if kind == "yearbook" else "visa_stats/annual/"
        rows = f"""SELECT page_id, pos, CAST(NULL AS VARCHAR) AS program, label AS "year", label AS period, url, {name} AS filename,
  '{folder}' || label AS folder FROM {found}"""
    file_type = {"employer": "uscis"}.get(kind, kind)
    return f"""SELECT program, "year", period, url, filename, '{SOURCES[file_type]}' AS source_id, '{file_type}' AS file_type,
  '/data/' || folder AS folder, '/data/' || folder || '/' || filename AS saved_path FROM ({rows})
  QUALIFY row_number() OVER (PARTITION BY period, url ORDER BY page_id, pos) = 1"""


@query(" UNION ALL ".join(f"SELECT * FROM ({_labelled_sql(kind)})" for kind in LABELS))
def labelled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of the monthly, employer, annual and yearbook pages."""
    frames = [
        labelled_candidates(derive(table(spark, sf_dir, "pages"), {**PAGES, "label": label}), kind)
        for kind, label in LABELS.items()
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])

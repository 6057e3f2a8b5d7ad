"""Queries over releases with drifting headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.catalog import cases, derive, derive_sql, query, quote, strip_sql, table
from vintara.catalog.cleaning import DATE_SQL, number_sql, upper_code_sql
from vintara.config.lca import LCA, LCA_COLUMNS
from vintara.config.perm import PERM, PERM_LITERAL
from vintara.config.values import LCA_STATUS
from vintara.config.wages import IGNORED_HEADERS, WAGE_RENAMES
from vintara.functions import names, text, typed
from vintara.operators import harmonise as h
from vintara.operators.dedup import keep_first
from vintara.plans.releases import release_of
from vintara.sources.listing import main_files, release_files, with_vintage
from vintara.sources.tables import mapping_dict, mapping_table

# ---- orders as yearly releases in three header styles ----

YEAR = "cast(year(o_orderdate) as string)"
ISO = "cast(cast(o_orderdate as date) as string)"
CASE_NO = "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE ' i-' || cast(o_orderkey - o_orderkey % 3 as string) || chr(160) END"
STATUS = cases("o_orderkey % 6", [" certified ", "CERTIFIED-WITHDRAWN", "Denied", "nan", ""], "'Pending-' || o_orderstatus")
DATE = (
    "CASE o_orderkey % 5 WHEN 0 THEN " + ISO + " || ' 00:00:00' WHEN 1 THEN cast(month(o_orderdate) as string) || '/' "
    "|| cast(day(o_orderdate) as string) || '/' || cast(year(o_orderdate) as string) WHEN 2 THEN 'soon' ELSE " + ISO + " END"
)
EMPLOYER = "chr(160) || 'Employer ' || cast(o_custkey as string) || chr(9)"
WAGE = "CASE WHEN o_orderkey % 11 = 0 THEN '$3' ELSE cast(cast(o_totalprice as decimal(12,2)) as string) END"

POSITION = {"release": YEAR, "row_no": "o_orderkey"}
EARLY = {
    **POSITION, "CASE NO": CASE_NO, " Approval-Status ": STATUS, "Submitted Date": DATE, "NAME": EMPLOYER,
    "Wage_Rate_1": WAGE, "Wage_Rate_2": "'x'", "Unnamed: 7": "'junk'",
}
MIDDLE = {
    **POSITION, "LCA_CASE_NUMBER": CASE_NO, "STATUS": STATUS, "LCA_CASE_SUBMIT": DATE,
    "LCA_CASE_EMPLOYER_NAME": EMPLOYER, "LCA_CASE_WAGE_RATE_FROM": WAGE,
}
# the plain wage column is empty in the release of 1999 and filled (differently) after it
LATE = {
    **POSITION, "CASE_NUMBER": CASE_NO, "CASE_STATUS": STATUS, "RECEIVED_DATE": DATE, "EMPLOYER_NAME": EMPLOYER,
    "WAGE_RATE_OF_PAY_FROM": "CASE WHEN year(o_orderdate) > 1999 THEN '7' || cast(o_orderkey as string) END",
    "WAGE_RATE_OF_PAY_FROM_1": WAGE, "WAGE_RATE_OF_PAY_FROM_2": "'x'",
}
SPLIT = {"early": "year(o_orderdate) <= 1996", "middle": "year(o_orderdate) IN (1997, 1998)", "late": "year(o_orderdate) >= 1999"}


def releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders on the canonical layout, with release and row position."""
    orders = table(spark, sf_dir, "orders")
    styles = {"early": EARLY, "middle": MIDDLE, "late": LATE}
    return h.union_all([
        h.harmonise(
            derive(orders.where(SPLIT[name]), columns), LCA, {"year": F.col("release")},
            keep=list(POSITION), file="release")
        for name, columns in styles.items()
    ])


RELEASES_SQL = f"""(
SELECT {YEAR} AS release, o_orderkey AS row_no, {CASE_NO} AS case_number, {STATUS} AS case_status,
       {DATE} AS received_date, {EMPLOYER} AS employer_name,
       CASE WHEN year(o_orderdate) > 1999 THEN '7' || cast(o_orderkey as string) ELSE {WAGE} END AS wage_rate_of_pay_from,
       {YEAR} AS "year"
FROM orders)"""

FILLED = ["case_number", "case_status", "received_date", "employer_name", "wage_rate_of_pay_from", "year"]
_ALL = ", ".join(f'"{c}"' if c in FILLED else f'CAST(NULL AS VARCHAR) AS "{c}"' for c in LCA_COLUMNS)


@query(f"SELECT {_ALL}, release, row_no FROM {RELEASES_SQL}")
def harmonise_vintages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header rules, aliases, empty columns, full canonical schema, lineage and union."""
    return releases(spark, sf_dir)


_KEY = f"coalesce(upper({strip_sql('case_number')}), 'NAN')"
_CLEAN_SQL = f"""
SELECT "year", {upper_code_sql('case_status', LCA_STATUS)} AS status, {DATE_SQL.format(c='received_date')} AS received,
       {number_sql('wage_rate_of_pay_from')} AS wage, nullif({strip_sql('employer_name')}, '') AS employer,
       upper({strip_sql('case_number')}) AS case_number
FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY release, row_no) AS rn FROM {RELEASES_SQL}) WHERE rn = 1
"""


def clean_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases -> first row of each case -> cleaned values."""
    # project before the shuffle: the canonical layout is wide, the report is not
    rows = releases(spark, sf_dir).select(*FILLED, "release", "row_no")
    first = keep_first(rows, [text.case_key("case_number", null_as="NAN")], ["release", "row_no"])
    return first.select(
        "year",
        text.upper_code(text.na_to_null("case_status"), LCA_STATUS).alias("status"),
        typed.parse_date("received_date").alias("received"),
        typed.parse_number("wage_rate_of_pay_from").alias("wage"),
        text.clean_text("employer_name").alias("employer"),
        text.case_key("case_number").alias("case_number"),
    )


@query(_CLEAN_SQL)
def cases_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Harmonise, keep the first row of each case, clean."""
    return clean_cases(spark, sf_dir)


@query(f"""
SELECT "year", status, count(*) AS "rows", min(received) AS first_received, max(received) AS last_received
FROM ({_CLEAN_SQL}) WHERE status IS NOT NULL GROUP BY "year", status""")
def status_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status breakdown per fiscal year of the de-duplicated cases."""
    return (
        clean_cases(spark, sf_dir).where("status IS NOT NULL").groupBy("year", "status")
        .agg(F.count("*").alias("rows"), F.min("received").alias("first_received"),
             F.max("received").alias("last_received"))
        .orderBy("year", F.desc("rows"), "status")
    )


# ---- two forms of one program: both alias policies ----

FORM = {
    "release": YEAR, "row_no": "o_orderkey",
    "CASE_NUMBER": "'g-' || cast(o_orderkey as string)",
    "EMP_BUSINESS_NAME": "CASE WHEN o_orderkey % 2 = 0 THEN 'Biz ' || cast(o_custkey as string) END",
    "EMP_POC_EMAIL": "'u' || cast(o_custkey as string) || '@example.org'",
    "PW_TRACK_NUMBER": "CASE WHEN o_orderkey % 3 = 0 THEN 'P-' || cast(o_orderkey as string) END",
    "JOB_OPP_PWD_NUMBER": "CASE WHEN o_orderkey % 4 <> 0 THEN 'J-' || cast(o_orderkey as string) END",
    "Wage Offer From": WAGE,
    "CLASS_OF_ADMISSION": "o_orderpriority",
}
_FORM_OUT = ["case_number", "emp_business_name", "emp_poc_email", "pw_track_number", "job_opp_pwd_number",
             "wage_offer_from", "class_of_admission", "year", "form_type", "row_no"]
_FORM_TYPE = f"CASE WHEN cast({YEAR} as int) <= 2023 THEN 'old' ELSE 'new' END"


def _form_sql(policy: str, kept: dict[str, str]) -> str:
    listed = ", ".join(
        f"{kept.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in _FORM_OUT[:7])
    return (f"SELECT {listed}, {YEAR} AS \"year\", {_FORM_TYPE} AS form_type, o_orderkey AS row_no, "
            f"'{policy}' AS policy FROM orders")


_PW, _JOB = FORM["PW_TRACK_NUMBER"], FORM["JOB_OPP_PWD_NUMBER"]


@query(
    _form_sql("intended", {
        "case_number": FORM["CASE_NUMBER"], "emp_business_name": FORM["EMP_BUSINESS_NAME"],
        "emp_poc_email": FORM["EMP_POC_EMAIL"], "pw_track_number": f"coalesce({_PW}, {_JOB})",
        "job_opp_pwd_number": _JOB, "wage_offer_from": WAGE, "class_of_admission": "o_orderpriority"})
    + " UNION ALL "
    + _form_sql("copy_drop", {
        "case_number": FORM["CASE_NUMBER"], "pw_track_number": _JOB, "class_of_admission": "o_orderpriority"})
)
def harmonise_copy_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alias table as meant (names map to canonical ones) and replayed literally."""
    rows = derive(table(spark, sf_dir, "orders"), FORM)

    def one(layout: h.Layout, policy: str) -> DataFrame:
        lineage = {"year": F.col("release"), "form_type": names.form_type(F.lit("release.xlsx"), "release")}
        df = h.harmonise(rows, layout, lineage, ["release", "row_no"], file="release")
        return df.select(*_FORM_OUT, F.lit(policy).alias("policy"))

    return one(PERM, "intended").unionByName(one(PERM_LITERAL, "copy_drop"))


@query(f"""
SELECT release, row_no, coalesce(a, b) AS value FROM (
  SELECT {YEAR} AS release, o_orderkey AS row_no,
         CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END AS a, {STATUS} AS b FROM orders)""")
def harmonise_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several columns of one target combined row by row."""
    rows = derive(table(spark, sf_dir, "orders"), {
        **POSITION, "First": "CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END", "Second": STATUS})
    layout = h.Layout(columns=["value"], aliases={"first": "value", "second": "value"}, policy="coalesce")
    return h.harmonise(rows, layout, keep=list(POSITION))


# ---- headers as data ----

_RAW_HEADERS = [
    " Case Status ", "CASE-NUMBER", "Unnamed: 12", "unnamed", "H-1B_DEPENDENT", "Wage Rate 2", "SOC  CODE",
]
HEADER_TEXT = cases("doc_id % 9", _RAW_HEADERS, "source || ' Col-' || cast(doc_id as string) || chr(160)")


@query(f"""
SELECT doc_id, regexp_replace(translate(lower({strip_sql('header')}), ' -', '__'), '^unnamed.*', '') AS name
FROM {derive_sql('documents', {'doc_id': 'doc_id', 'header': HEADER_TEXT})}""")
def header_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header texts as column names."""
    rows = derive(table(spark, sf_dir, "documents"), {"doc_id": "doc_id", "header": HEADER_TEXT})
    return rows.select("doc_id", text.normalise_header("header").alias("name"))


_NAMES = [
    "CASE_STATUS", "STATUS", "TRADE_NAME", "TRADE_NAME_DBA", "VOIDED_DATE", "TYPE_DBA_SCA", "EIN",
    "SUBMIT_DATE", "case_status", "PW_SOC_TITLE",
]
HEADERS = {
    "year": "cast(2012 + doc_id % 7 as int)", "pos": "cast(doc_id as int)",
    "name": cases("doc_id % 13", _NAMES, "'COLUMN_' || cast(doc_id % 40 as string)"),
}
_TARGETS = ["CASE_STATUS", "TRADE_NAME_DBA", "EMPLOYER_FEIN", "RECEIVED_DATE", "COLUMN_1", "COLUMN_2"]
# the mapping file as lines of text, each twice: the later line of an original wins
_LINES = [(o, "SUPERSEDED") for o in ("STATUS", "EIN")] + list(WAGE_RENAMES.items()) + [
    ("CASE_STATUS", "CASE_STATUS"), ("TRADE_NAME_DBA", " TRADE_NAME_DBA "), (" COLUMN_1", "COLUMN_1")]
_IGNORED = [(y, n) for y, ns in IGNORED_HEADERS.items() for n in ns]


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(quote(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


_MAPPING_SQL = f"""(
  SELECT trim(original) AS original, trim(max_by(final, ord)) AS final
  FROM (VALUES {_values([(o, f, i) for i, (o, f) in enumerate(_LINES)])}) AS t(original, final, ord)
  GROUP BY trim(original))"""
_RESOLVED_SQL = f"""
  SELECT x.*, CASE WHEN target IS NULL THEN 'unmapped' WHEN NOT known THEN 'no_target'
              WHEN row_number() OVER (PARTITION BY "year", target ORDER BY pos) = 1 THEN 'mapped'
              ELSE 'duplicate' END AS outcome
  FROM (SELECT h."year", h.pos, h.name, m.final AS target,
               m.final IN ({', '.join(quote(t) for t in _TARGETS)}) AS known
        FROM {derive_sql('documents', HEADERS)} h LEFT JOIN {_MAPPING_SQL} m ON m.original = h.name
        WHERE NOT EXISTS (SELECT 1 FROM (VALUES {_values(_IGNORED)}) AS i(y, n) WHERE i.y = h."year" AND i.n = h.name)) x
"""


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.createDataFrame(
        [(o, f, i) for i, (o, f) in enumerate(_LINES)], "original string, final string, ord int")
    return h.resolve_headers(
        derive(table(spark, sf_dir, "documents"), HEADERS),
        mapping_dict(mapping_table(lines, "original", "final", "ord")), _TARGETS, IGNORED_HEADERS,
    )


@query(f'SELECT "year", pos, name, target, outcome FROM ({_RESOLVED_SQL})')
def header_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers joined with mapping, targets and ignore list."""
    return _resolved(spark, sf_dir)


@query(f"""
SELECT name AS column_name, string_agg(cast("year" as string), ', ' ORDER BY "year") AS years_appeared
FROM (SELECT DISTINCT name, "year" FROM ({_RESOLVED_SQL}) WHERE outcome IN ('unmapped', 'no_target'))
GROUP BY name""")
def unmapped_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns without a place in the target schema, and their years."""
    return h.unmapped_report(_resolved(spark, sf_dir))


# ---- choice of files ----

FORM_FILES = {
    "doc_id": "doc_id",
    "path": "'/data/PERM Program/' || " + cases("doc_id % 9", ["unknown_year", "2023", "2024"], "cast(2019 + doc_id % 8 as string)")
    + " || '/PERM_' || source || " + cases("doc_id % 4", ["_Old_Form.xlsx", "_new_form.xlsx"], "'.xlsx'"),
}


@query(f"""
SELECT doc_id, folder AS vintage, CASE WHEN lower(name) LIKE '%old\\_form%' ESCAPE '\\' THEN 'old'
  WHEN try_cast(folder AS INTEGER) <= 2023 THEN 'old' WHEN try_cast(folder AS INTEGER) > 2023 THEN 'new' END AS form_type
FROM (SELECT doc_id, split_part(path, '/', 4) AS folder, split_part(path, '/', 5) AS name
      FROM {derive_sql('documents', FORM_FILES)})""")
def form_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form of a release from its name and folder."""
    files = with_vintage(derive(table(spark, sf_dir, "documents"), FORM_FILES))
    return files.select("doc_id", "vintage", names.form_type("filename", "vintage").alias("form_type"))


MAIN_FILES = {
    "vintage": "cast(doc_id - doc_id % 4 as string)",
    "filename": "'f' || cast(doc_id * 7 % 101 as string) || "
    + cases("doc_id * 13 % 17 % 6", ["_Disclosure_Data.xlsx", "_Disclosure_Data_New_Form.parquet",
                                     "_Disclosure_Data.parquet", ".parquet", "_Disclosure_Data_Revised_Form.xlsx"], "'.xlsx'"),
}


@query(f"""
WITH f AS (SELECT *, split_part(filename, '.', 2) AS ext, contains(filename, 'Disclosure_Data') AS disc,
                  regexp_matches(lower(filename), 'new_form|revised_form') AS revised
           FROM {derive_sql('documents', MAIN_FILES)}),
c AS (SELECT *, count(*) OVER w AS n, count(*) FILTER (disc) OVER w AS d FROM f WINDOW w AS (PARTITION BY vintage, ext)),
r AS (SELECT *, CASE WHEN n = 1 THEN 1 WHEN disc AND d = 1 THEN 2 WHEN disc AND revised THEN 3 WHEN disc THEN 4 END AS rule FROM c)
SELECT vintage, filename, cast(rule as integer) AS rule FROM r WHERE rule IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY vintage ORDER BY ext, rule, filename) = 1""")
def main_file_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main data file of each folder."""
    return main_files(derive(table(spark, sf_dir, "documents"), MAIN_FILES))


COMPANIONS = {
    "path": "'/data/LCA Program/' || lang || '/' || source || '_' || cast(doc_id as string) || "
    + cases("doc_id % 7", ["_Appendix_A.xlsx", "_WORKSITES.xlsx", ".csv", ".XLSX"], "'.xlsx'"),
}


@query(f"""
SELECT path, split_part(path, '/', 4) AS vintage, split_part(path, '/', 5) AS filename
FROM {derive_sql('documents', COMPANIONS)}
WHERE path LIKE '%.xlsx' AND NOT regexp_matches(lower(split_part(path, '/', 5)), 'appendix|worksite')""")
def companion_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbooks of the yearly folders without appendices and worksite lists."""
    return release_files(derive(table(spark, sf_dir, "documents"), COMPANIONS))


EMPTY = {
    "file": "event_type",
    "a": "CASE WHEN event_type <> 'click' THEN value END",
    "b": "CASE WHEN event_type IN ('view', 'error') THEN props END",
    "c": "props",
    "d": "CASE WHEN value < 0 THEN user_id END",
}


@query(" UNION ALL ".join(
    f"SELECT file, '{c}' AS column_name FROM {derive_sql('events', EMPTY)} GROUP BY file HAVING count({c}) = 0"
    for c in "abcd"))
def all_null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns without any value, per file."""
    return h.empty_columns(derive(table(spark, sf_dir, "events"), EMPTY), "file")


# ---- paths of release files ----

_ID = "cast(doc_id as string)"
_RELEASE_PATHS = {
    "doc_id": "doc_id",
    "path": "'s3://b/lca.parquet.d/' || cast(2000 + doc_id % 25 as string) || '/' || " + cases("doc_id % 6", [
        "a.parquet", "a.parquet.v2.parquet", "a.parquet.v2.parquet/part-00007-x.snappy.parquet", "a.parquet/state=CA/year=1/part-0.parquet",
        "book.xlsx"], f"source || '-' || {_ID} || '.parquet/part-' || {_ID} || '-c000.parquet'"),
}


@query(f"""SELECT doc_id, 's3://b/lca.parquet.d/' || vintage || '/' || filename AS release, vintage, filename, filename LIKE '%.parquet' AS read FROM (
  SELECT doc_id, cast(2000 + doc_id % 25 as string) AS vintage, {cases("doc_id % 6", [
      "a.parquet", "a.parquet.v2.parquet", "a.parquet.v2.parquet", "a.parquet", "book.xlsx"], f"source || '-' || {_ID} || '.parquet'")} AS filename
  FROM documents)""")
def release_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The release each data file belongs to, and whether it is read or reported."""
    paths = derive(table(spark, sf_dir, "documents"), _RELEASE_PATHS).withColumn("release", release_of("path"))
    return with_vintage(paths, "release").select(
        "doc_id", "release", "vintage", "filename", F.col("release").endswith(".parquet").alias("read"))

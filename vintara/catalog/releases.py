"""Queries over whole trees of release files, written from the tables to the shared folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.catalog import derive, query, strip_sql, table
from vintara.catalog.cleaning import DATE_SQL, number_sql, upper_code_sql
from vintara.catalog.harmonising import DATE, EARLY, FILLED, FORM, LATE, MIDDLE, RELEASES_SQL, YEAR
from vintara.config.lca import LCA_COLUMNS
from vintara.config.values import LCA_STATUS, NA_TOKENS
from vintara.operators.joins import lookup_join
from vintara.plans.incremental import CaseStore
from vintara.plans.lca import clean_lca, compile_lca, write_clean
from vintara.plans.perm import clean_perm, compile_perm
from vintara.plans.releases import count_rows, find_releases, read_headers
from vintara.plans.wages import amalgamate, main_releases
from vintara.session import new_folder
from vintara.sources.footers import profile_files
from vintara.sources.tables import read_csv, write_csv


def once_per_session(build: Callable[[SparkSession, str], str]) -> Callable[[SparkSession, str], str]:
    """Write a tree of input files once for a session and tables, then reuse it."""
    written: dict[tuple[str, str], str] = {}

    @wraps(build)
    def path(spark: SparkSession, sf_dir: str) -> str:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in written:
            written[key] = build(spark, sf_dir)
        return written[key]

    return path


def write_release(df: DataFrame, path: str, order: str) -> None:
    """A release whose row order is ``order``: range-partitioned, so no task holds it all."""
    df.repartitionByRange(F.col(order)).sortWithinPartitions(order).drop(order).write.parquet(path)


@once_per_session
def yearly_tree(spark: SparkSession, sf_dir: str) -> str:
    """Orders as one release per year, each in the header style of its time."""
    root = new_folder(spark)
    orders = table(spark, sf_dir, "orders")
    years = [r[0] for r in orders.select(F.year("o_orderdate")).distinct().collect()]  # a handful of years
    for year in years:
        own = orders.where(F.year("o_orderdate") == year)
        style = EARLY if year <= 1996 else MIDDLE if year <= 1998 else LATE
        columns = {name: text for name, text in style.items() if name != "release"}
        write_release(derive(own, columns), f"{root}/{year}/release_{year}.parquet", "row_no")
    return root


_KEY = f"upper({strip_sql('case_number')})"


def _na(c: str) -> str:
    return f"CASE WHEN {c} NOT IN ({', '.join(repr(t) for t in NA_TOKENS)}) THEN {c} END"


_FIRST_SQL = f"""(SELECT * FROM {RELEASES_SQL}
QUALIFY row_number() OVER (PARTITION BY coalesce({_KEY}, 'NAN') ORDER BY release, row_no) = 1)"""


@query(f"""
SELECT DISTINCT {_KEY} AS case_number, {upper_code_sql(_na('case_status'), LCA_STATUS)} AS case_status,
  {DATE_SQL.format(c='received_date')} AS received_date, nullif({strip_sql('employer_name')}, '') AS employer_name,
  {number_sql('wage_rate_of_pay_from')} AS wage_rate_of_pay_from, "year" FROM {_FIRST_SQL}""")
def lca_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Release files -> one table, first row of each case, cleaned and distinct."""
    clean = clean_lca(compile_lca(spark, yearly_tree(spark, sf_dir)))
    return clean.select("case_number", "case_status", "received_date", "employer_name", "wage_rate_of_pay_from", "year")


_PROFILED = {"CASE_STATUS": "o_orderstatus", "EMPLOYER_FEIN": "CASE WHEN o_custkey % 3 <> 0 THEN cast(o_custkey as string) END",
             "NEVER": "CASE WHEN o_custkey < 0 THEN o_orderstatus END", "WORKERS": "cast(o_custkey % 100 as int)",
             "DECIDED": "cast(o_orderdate as date)", "PWD_WAGE": "o_totalprice"}


@once_per_session
def typed_tree(spark: SparkSession, sf_dir: str) -> str:
    """Orders as one typed release."""
    path = f"{new_folder(spark)}/release.parquet"
    derive(table(spark, sf_dir, "orders"), _PROFILED).write.parquet(path)
    return path


@query(" UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count(*) AS "rows", count(*) - count(x) AS null_rows,
  round(100.0::DOUBLE * (count(*) - count(x)) / count(*), 4) AS null_percent,
  {'cast(min(x) as string)' if c in ('WORKERS', 'DECIDED', 'CASE_STATUS') else 'CAST(NULL AS VARCHAR)'} AS first_value,
  {'cast(max(x) as string)' if c in ('WORKERS', 'DECIDED', 'CASE_STATUS') else 'CAST(NULL AS VARCHAR)'} AS last_value
FROM (SELECT {e} AS x FROM orders)""" for c, e in _PROFILED.items()))
def release_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, nulls and ranges of a release from its footers; of texts the one column is read."""
    return profile_files(spark, [typed_tree(spark, sf_dir)], ranges=["WORKERS", "DECIDED", "CASE_STATUS"])


_BLOCK = 1000


_COMPILED = ", ".join(f"{_KEY} AS case_number" if c == "case_number" else f'"{c}"' if c in FILLED else f'CAST(NULL AS VARCHAR) AS "{c}"'
                      for c in LCA_COLUMNS)


@query(f"""
WITH placed AS (SELECT *, coalesce({_KEY}, 'NAN') AS k, row_number() OVER (ORDER BY release, row_no) - 1 AS p FROM {RELEASES_SQL})
SELECT {_COMPILED} FROM placed
QUALIFY min(p // {_BLOCK}) OVER (PARTITION BY k) = p // {_BLOCK}""")
def lca_releases_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Release files -> one table, every row of the block where a case first appears, all columns."""
    return compile_lca(spark, yearly_tree(spark, sf_dir), mode="blocks", block_rows=_BLOCK)


@query(f"""SELECT {_KEY} AS case_number, case_status, "year", wage_rate_of_pay_from FROM {_FIRST_SQL}""")
def lca_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases added in three steps, the earliest last -> the same table as compiled at once."""
    store, releases = CaseStore(new_folder(spark)), find_releases(spark, yearly_tree(spark, sf_dir))
    for some in (releases[1:-1], releases[-1:], releases[:1]):
        store.add(spark, some)
    return store.read(spark).select("case_number", "case_status", "year", "wage_rate_of_pay_from")


@query(f"""
SELECT count(*) AS rows_in, (SELECT count(*) FROM ({{clean}})) AS rows_out, 107 AS columns_in, 36 AS columns_out FROM {_FIRST_SQL}""".replace(
    "{clean}", "SELECT DISTINCT * FROM (" + f"SELECT {_KEY} AS k FROM {_FIRST_SQL}" + ")"))
def lca_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns before and after cleaning, counted by the job that writes the table."""
    done = write_clean(compile_lca(spark, yearly_tree(spark, sf_dir)), f"{new_folder(spark)}/clean")
    return spark.createDataFrame([(done.rows_in, done.rows_out, done.columns_in, done.columns_out)],
                                 "rows_in long, rows_out long, columns_in int, columns_out int")


_FORM_YEAR = "cast(year(o_orderdate) + 25 as string)"


@once_per_session
def form_tree(spark: SparkSession, sf_dir: str) -> str:
    """Orders as releases of two forms: per year an old-form and a new-form file."""
    root = new_folder(spark)
    orders = table(spark, sf_dir, "orders")
    years = [r[0] for r in orders.select(F.year("o_orderdate")).distinct().collect()]
    for year in years:
        own = orders.where(F.year("o_orderdate") == year)
        old = {**FORM, "EMPLOYER_NAME": FORM["EMP_BUSINESS_NAME"]}
        del old["EMP_BUSINESS_NAME"], old["JOB_OPP_PWD_NUMBER"], old["release"]
        new = {name: text for name, text in FORM.items() if name != "release"}
        for name, columns, rows in (("Old_Form", old, own.where("o_orderkey % 2 = 0")), ("New_Form", new, own.where("o_orderkey % 2 = 1"))):
            columns = {**columns, "CASE_NUMBER": "'g-' || cast(o_orderkey - o_orderkey % 4 as string)", "CASE_STATUS": "o_orderstatus || '-x'", "DECISION_DATE": DATE}
            write_release(derive(rows, columns), f"{root}/{year + 25}/PERM_{name}.parquet", "row_no")
    return root


_FORMS_SQL = f"""(
SELECT 'G-' || cast(o_orderkey - o_orderkey % 4 as string) AS case_number, upper(o_orderstatus || '-x') AS case_status,
  {_FORM_YEAR} AS "year", {DATE} AS decided, o_orderkey % 2 AS new_form, o_orderkey, {FORM['EMP_BUSINESS_NAME']} AS emp_business_name,
  CASE WHEN o_orderkey % 2 = 1 THEN coalesce({FORM['PW_TRACK_NUMBER']}, {FORM['JOB_OPP_PWD_NUMBER']}) ELSE {FORM['PW_TRACK_NUMBER']} END AS pw_track_number,
  CASE WHEN o_orderkey % 2 = 0 OR {_FORM_YEAR} <= '2023' THEN 'OLD' ELSE 'NEW' END AS form_type, upper(o_orderpriority) AS class_of_admission
FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderkey - o_orderkey % 4 ORDER BY {_FORM_YEAR}, o_orderkey % 2 DESC, o_orderkey) = 1)"""


@query(f"SELECT case_number, emp_business_name, pw_track_number, \"year\", lower(form_type) AS form_type FROM {_FORMS_SQL}")
def perm_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Release files of two forms -> one table, first row of each case."""
    return compile_perm(spark, form_tree(spark, sf_dir)).select(
        "case_number", "emp_business_name", "pw_track_number", "year", "form_type")


@query(f"""SELECT DISTINCT case_number, case_status, {DATE_SQL.format(c='decided')} AS decision_date, "year", form_type, class_of_admission
FROM {_FORMS_SQL}""")
def perm_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Release files of two forms -> cleaned table."""
    return clean_perm(compile_perm(spark, form_tree(spark, sf_dir)))


# the newest year has the target header; the years before it drift
_WAGE = "cast(cast(o_totalprice as decimal(12,2)) as string)"
_STYLES = [
    {"STATUS": "o_orderstatus", "EIN": "cast(o_custkey as string)", "PW_WAGE": _WAGE, "VOIDED_DATE": "'v'"},
    {"CASE_STATUS": "o_orderstatus", "EMPLOYER_FEIN": "cast(o_custkey as string)", "PWD_WAGE": _WAGE},
]


@once_per_session
def wage_tree(spark: SparkSession, sf_dir: str) -> str:
    root = new_folder(spark)
    orders = table(spark, sf_dir, "orders")
    years = sorted(r[0] for r in orders.select(F.year("o_orderdate")).distinct().collect())
    for year in years:
        columns = {**_STYLES[year == years[-1]], "row_no": "o_orderkey"}
        own = derive(orders.where(F.year("o_orderdate") == year), columns)
        write_release(own, f"{root}/{year}/PW_Disclosure_Data.parquet", "row_no")
        write_release(own, f"{root}/{year}/Appendix.parquet", "row_no")
    return root


def _amalgamated(spark: SparkSession, sf_dir: str):
    last = table(spark, sf_dir, "orders").agg(F.max(F.year("o_orderdate"))).collect()[0][0]
    return amalgamate(spark, wage_tree(spark, sf_dir), target_year=last)


def _damage(spark: SparkSession, release: str) -> None:
    """Overwrite bytes in the middle of a release's largest file; its footer stays as it is."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(release)
    system = folder.getFileSystem(conf)
    largest = max((s for s in system.listStatus(folder) if s.getPath().getName().endswith(".parquet")), key=lambda s: s.getLen())
    middle, garbage = largest.getLen() // 2, bytearray(b"\xff" * 512)
    source, copy = system.open(largest.getPath()), jvm.org.apache.hadoop.fs.Path(release, "_copy")
    target = system.create(copy)
    copied = jvm.org.apache.commons.io.IOUtils.copyLarge
    copied(source, target, 0, middle)
    target.write(garbage)
    copied(source, target, len(garbage), largest.getLen())
    target.close()
    source.close()
    system.delete(largest.getPath(), False)
    system.rename(copy, largest.getPath())


@once_per_session
def damaged_tree(spark: SparkSession, sf_dir: str) -> str:
    """A release per year, the one of the second year damaged."""
    root = new_folder(spark)
    orders = table(spark, sf_dir, "orders")
    years = sorted(r[0] for r in orders.select(F.year("o_orderdate")).distinct().collect())
    for year in years:
        own = derive(orders.where(F.year("o_orderdate") == year), {**_STYLES[1], "row_no": "o_orderkey"})
        write_release(own, f"{root}/{year}/PW_Disclosure_Data.parquet", "row_no")
    _damage(spark, f"{root}/{years[1]}/PW_Disclosure_Data.parquet")
    return root


_SECOND = "(SELECT min(year(o_orderdate)) + 1 FROM orders)"


@query(f"""
SELECT cast(year(o_orderdate) AS INTEGER) AS "year", count(*) AS on_disk,
  count(*) FILTER (WHERE year(o_orderdate) <> {_SECOND}) AS kept, count(*) FILTER (WHERE year(o_orderdate) = {_SECOND}) AS reported
FROM orders GROUP BY ALL""")
def release_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each year's release: on disk, kept, and lost with a release that is reported."""
    last = table(spark, sf_dir, "orders").agg(F.max(F.year("o_orderdate"))).collect()[0][0]
    root = damaged_tree(spark, sf_dir)
    done = amalgamate(spark, root, target_year=last)
    kept = done.rows.groupBy(F.col("SOURCE_YEAR").alias("year")).agg(F.count("*").alias("kept"))
    headers, _ = read_headers(spark, main_releases(spark, root))
    there = count_rows(spark, headers, lambda names: []).groupBy(
        F.regexp_extract("release", r"/(\d+)/[^/]+$", 1).cast("int").alias("year")).agg(F.sum("on_disk").alias("on_disk"))
    lost = F.col("year").isin([int(r.vintage) for r in done.errors])
    return lookup_join(there, kept, ["year"]).select(
        "year", "on_disk", F.coalesce("kept", F.lit(0)).alias("kept"), F.when(lost, F.col("on_disk")).otherwise(0).alias("reported"))


_LAST = "(SELECT max(year(o_orderdate)) FROM orders)"


@query(f"""
SELECT o_orderstatus AS "CASE_STATUS", cast(o_custkey as string) AS "EMPLOYER_FEIN",
  CASE WHEN year(o_orderdate) = {_LAST} THEN {_WAGE} END AS "PWD_WAGE", cast(year(o_orderdate) AS INTEGER) AS "SOURCE_YEAR" FROM orders""")
def wage_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main files of all years under the newest header."""
    return _amalgamated(spark, sf_dir).rows


@query(f"""
SELECT name AS column_name, string_agg(DISTINCT {YEAR}, ', ' ORDER BY {YEAR}) AS years_appeared
FROM orders, (VALUES ('PW_WAGE'), ('VOIDED_DATE')) AS n(name) WHERE year(o_orderdate) < {_LAST} GROUP BY name""")
def wage_unmapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers of the yearly files without a place under the newest header."""
    return _amalgamated(spark, sf_dir).unmapped


@query(f"""
SELECT doc_id, {_na('source')} AS source, {_na('text')} AS body, {_na('mark')} AS mark
FROM (SELECT cast(doc_id as string) AS doc_id, source, text, CASE WHEN doc_id % 5 = 0 THEN 'NULL' ELSE lang END AS mark FROM documents)""")
def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts written as CSV and read back as text, only the wanted columns."""
    path = new_folder(spark)
    write_csv(derive(table(spark, sf_dir, "documents"), {
        "doc_id": "cast(doc_id as string)", "lang": "lang", "source": "source", "body": "text",
        "mark": "CASE WHEN doc_id % 5 = 0 THEN 'NULL' ELSE lang END"}), path)
    return read_csv(spark, path, columns=["doc_id", "source", "body", "mark"])

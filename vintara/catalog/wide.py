"""Release files that fill all columns the cleaned table keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.catalog import cases, derive, query, quote, recode_sql, strip_sql, table
from vintara.catalog.cleaning import DATE_SQL, number_sql
from vintara.catalog.harmonising import CASE_NO, DATE, STATUS, WAGE, YEAR
from vintara.catalog.releases import once_per_session, write_release
from vintara.config.lca import LCA_LABELS
from vintara.config.values import BLANKS, LCA_STATUS, NA_TOKENS
from vintara.plans.lca import DATES, FLAGS, NUMBERS, RECODED, TEXTS, clean_lca, compile_lca
from vintara.session import new_folder

KEPT = list(LCA_LABELS)


def _cell(name: str) -> str:
    """Values of a column in its file, clean and dirty ones."""
    at = f"(o_orderkey + {KEPT.index(name)})"
    if name == "case_number":
        return CASE_NO
    if name == "case_status":
        return STATUS
    if name in DATES:
        return DATE
    if name in NUMBERS:
        return cases(f"{at} % 8", ["1,000", " 12.5 ", "-3", "nan", "NULL"], WAGE)
    if name in FLAGS:
        return cases(f"{at} % 9", ["1", " 0", "2.0", "0.5", "x", "", "N/A"], "cast(o_custkey as string)")
    if name in RECODED:
        return cases(f"{at} % 13", [f" {k} " for k in list(RECODED[name])[:10]] + ["other", "nan"], "'NAN'")
    return "chr(160) || " + cases(f"{at} % 7", ["nan", "NAN", "", "NULL"], f"'{name} ' || cast(o_custkey as string)") + " || ' '"


CELLS = {c: _cell(c) for c in KEPT if c != "year"}
#: As the file has them; a second header that normalises to one before it does not count.
COLUMNS = {("Case Status" if c == "case_status" else c.upper()): e for c, e in CELLS.items()} | {"CASE_STATUS": "'repeated'", "row_no": "o_orderkey"}


@once_per_session
def wide_tree(spark: SparkSession, sf_dir: str) -> str:
    root = new_folder(spark)
    orders = table(spark, sf_dir, "orders")
    years = [r[0] for r in orders.select(F.year("o_orderdate")).distinct().collect()]  # a handful of years
    for year in years:
        write_release(derive(orders.where(F.year("o_orderdate") == year), COLUMNS), f"{root}/{year}/release_{year}.parquet", "row_no")
    return root


_TOKENS = ", ".join(quote(t) for t in NA_TOKENS)
_KEY = f"upper({strip_sql('case_number')})"


def _rule(c: str) -> str:
    if c in ("year", "case_number"):
        return f"{_known(_KEY, ())} AS case_number" if c == "case_number" else '"year"'
    value = f"CASE WHEN {c} NOT IN ({_TOKENS}) THEN {c} END"
    text = strip_sql(f"({value})")
    if c in DATES:
        return f"{DATE_SQL.format(c=text)} AS {c}"
    if c in NUMBERS:
        return f"{number_sql(f'({value})')} AS {c}"
    if c in FLAGS:
        number = number_sql(f"({value})")
        return f"CASE WHEN {number} = floor({number}) THEN cast({number} AS BIGINT) END AS {c}"
    if c in RECODED or c in TEXTS:
        text = f"upper({text})" if c == "case_status" else text
        mapping = LCA_STATUS if c == "case_status" else RECODED.get(c)
        return f"{_known(text, BLANKS, mapping)} AS {c}"
    return f"{value} AS {c}"


def _known(text: str, blanks, mapping=None) -> str:
    shown = recode_sql(text, mapping) if mapping else text
    return f"CASE WHEN {text} NOT IN ({', '.join(quote(b) for b in blanks) or quote('nan')}) THEN {shown} END"


@query(f"""SELECT DISTINCT {', '.join(_rule(c) for c in KEPT)} FROM (SELECT * FROM (
  SELECT {', '.join(f'{e} AS {c}' for c, e in CELLS.items())}, {YEAR} AS "year", o_orderkey AS row_no FROM orders)
QUALIFY row_number() OVER (PARTITION BY coalesce({_KEY}, 'NAN') ORDER BY "year", row_no) = 1)""")
def lca_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Release files -> one table, first row of each case, all columns that the cleaned table keeps."""
    return clean_lca(compile_lca(spark, wide_tree(spark, sf_dir))).select(KEPT)

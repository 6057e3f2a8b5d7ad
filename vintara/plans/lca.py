"""LCA releases: files -> one table -> cleaned table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.config.lca import LCA, LCA_LABELS
from vintara.config.values import BLANKS, LCA_STATUS, PAY_UNIT, VISA_CLASS, YES_NO
from vintara.functions import text, typed
from vintara.operators.dedup import distinct_rows, keep_first_block_by_position, keep_first_by_position
from vintara.plans.convert import convert_workbooks
from vintara.plans.releases import (
    ORDER, Release, find_damaged, find_releases, find_unread, harmonise_releases, read_headers, report, used_columns,
)
from vintara.sources.tables import counted

DATES = ["received_date", "decision_date", "begin_date", "end_date"]
NUMBERS = ["wage_rate_of_pay_from", "wage_rate_of_pay_to", "prevailing_wage"]
UNITS = ["wage_unit_of_pay", "pw_unit_of_pay"]
ANSWERS = ["full_time_position", "h_1b_dependent", "willful_violator", "withdrawn"]
FLAGS = ["new_employment", "continued_employment", "change_previous_employment",
         "new_concurrent_employment", "change_employer", "amended_petition"]
TEXTS = ["job_title", "soc_code", "soc_title", "employer_name", "employer_city", "employer_state",
         "employer_postal_code", "worksite_city", "worksite_state", "worksite_postal_code",
         "pw_wage_level", "naics_code", "case_number"]


def compile_lca(
    spark: SparkSession, root: str, mode: str = "first", block_rows: int = 200_000, convert: bool = False,
    errors: dict[Release, str] | None = None,
) -> DataFrame:
    """All releases below ``root/<year>/`` on the canonical layout, one row per case number.

    ``mode="first"`` keeps the first row of a case over all releases, ``mode="blocks"``
    every row of the first block of ``block_rows`` that has the case. ``convert`` first turns
    workbooks without a readable Parquet release into one. Every data file that is not read is
    logged, and put into ``errors`` with the reason.

    With ``errors`` or ``convert``, releases whose rows cannot all be read are found beforehand, in
    one pass over the columns that are used, and left out like those without a sound footer; without,
    such a release stops the job that reads it.
    """
    def readable() -> tuple[list[Release], dict, dict[Release, str]]:
        releases = find_releases(spark, root)
        headers, failed = read_headers(spark, releases)
        if errors is not None or convert:
            failed |= find_damaged(spark, headers, used_columns(LCA))
        return releases, {r: s for r, s in headers.items() if r not in failed}, failed

    releases, headers, failed = readable()
    if convert:
        convert_workbooks(spark, root, skip_existing=True, redo=[r.path for r in failed])
        releases, headers, failed = readable()
    unread = find_unread(spark, root, releases)
    report(unread)
    if errors is not None:
        errors.update(failed | unread)
    rows = harmonise_releases(spark, headers, LCA, lambda: {"year": F.col("_vintage")})
    rows = rows.withColumn("case_number", text.case_key("case_number"))
    if mode == "first":
        kept = keep_first_by_position(rows, [text.case_key("case_number", null_as="NAN")], ORDER)
    else:
        kept = keep_first_block_by_position(rows, "case_number", "_vintage", ORDER, block_rows)
    return kept.select(*LCA.columns)


RECODED = {
    "case_status": LCA_STATUS,
    "visa_class": VISA_CLASS,
    **dict.fromkeys(UNITS, PAY_UNIT),
    **dict.fromkeys(ANSWERS, YES_NO),
}


def clean_lca(
    compiled: DataFrame, labels: bool = False, date_formats: Sequence[str] = typed.DATE_FORMATS
) -> DataFrame:
    """The kept columns that are present, cleaned and typed, without duplicate rows.

    ``date_formats`` narrows the layouts in which dates are read.
    """
    have = [c for c in compiled.columns if c in LCA_LABELS]
    typing = dict.fromkeys(DATES, partial(typed.parse_date, formats=date_formats)) | dict.fromkeys(NUMBERS, typed.parse_number) \
        | dict.fromkeys(FLAGS, typed.parse_flag)

    # one projection per step: a step that uses its input several times then finds it computed
    def stripped(c: str) -> Column:
        value = text.na_to_null(c)
        if c == "case_status":
            return F.upper(text.strip(value))
        return text.strip(value) if c in TEXTS or c in RECODED or c in typing else value

    def blanked(c: str) -> Column:
        return text.null_if_in(c, BLANKS) if c in TEXTS or c in RECODED else F.col(c)

    def final(c: str) -> Column:
        if c in RECODED:
            return text.recode(c, RECODED[c])
        return typing[c](c, trim=False) if c in typing else F.col(c)

    cleaned = compiled
    for step in (stripped, blanked, final):
        cleaned = cleaned.select(*[step(c).alias(c) for c in have])
    distinct = distinct_rows(cleaned)
    return distinct.withColumnsRenamed(LCA_LABELS) if labels else distinct


@dataclass(frozen=True)
class Cleaned:
    """Counts of a written table: what was printed beside each step, from the pass that wrote it."""

    rows_in: int
    rows_out: int
    columns_in: int
    columns_out: int
    flags_rejected: dict[str, int]

    @property
    def duplicates(self) -> int:
        return self.rows_in - self.rows_out


def write_clean(compiled: DataFrame, path: str, labels: bool = False) -> Cleaned:
    """Write the cleaned table; its counts come from the same pass over the rows."""
    flags = [c for c in FLAGS if c in compiled.columns]
    rejected = {c: F.count_if(typed.flag_rejected(text.strip(text.na_to_null(c)))) for c in flags}
    rows, read = counted(compiled, **rejected)
    clean, kept = counted(clean_lca(rows, labels))
    clean.write.mode("overwrite").parquet(path)
    return Cleaned(read.get["rows"], kept.get["rows"], len(compiled.columns), len(clean.columns), {c: read.get[c] for c in flags})

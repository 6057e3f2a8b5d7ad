"""PERM releases: files -> one table -> cleaned table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.config.perm import PERM, PERM_LABELS
from vintara.config.values import PERM_STATUS
from vintara.functions import names, text, typed
from vintara.operators.dedup import distinct_rows, keep_first_by_position
from vintara.operators.harmonise import Layout
from vintara.plans.releases import (
    ORDER, Release, find_damaged, find_releases, find_unread, harmonise_releases, read_headers, report, used_columns,
)


def compile_perm(
    spark: SparkSession, root: str, layout: Layout = PERM, null_key: str | None = None,
    errors: dict[Release, str] | None = None,
) -> DataFrame:
    """All releases below ``root/<year>/`` on the canonical layout, first row of each case.

    Rows without a case number are one case; ``null_key`` is the text to show for it.
    A damaged release stops the job, with ``errors`` before any row is compiled; workbooks without a
    Parquet release are logged, and put into ``errors``.
    """
    releases = find_releases(spark, root, companions=True)
    headers, failed = read_headers(spark, releases)
    if errors is not None:
        failed |= find_damaged(spark, headers, used_columns(layout))
    if failed:
        raise ValueError(f"unreadable releases: {', '.join(r.path for r in failed)}")
    unread = find_unread(spark, root, releases, companions=True)
    report(unread)
    if errors is not None:
        errors.update(unread)
    rows = harmonise_releases(spark, headers, layout, lambda: {
        "year": F.col("_vintage"), "form_type": names.form_type("_release_name", "_vintage")})
    rows = rows.withColumn("case_number", text.case_key("case_number", trim=False))
    key = text.case_key("case_number", trim=False, null_as="NAN")
    first = keep_first_by_position(rows, [key], ORDER).select(*layout.columns)
    return first if null_key is None else first.fillna(null_key, ["case_number"])


def clean_perm(compiled: DataFrame, labels: bool = False) -> DataFrame:
    """The kept columns that are present, cleaned and typed, without duplicate rows."""
    rules = {
        "case_status": lambda c: text.upper_code(c, PERM_STATUS),
        "decision_date": typed.parse_date,
        "form_type": text.upper_code,
        "class_of_admission": text.upper_code,
    }
    have = [c for c in PERM_LABELS if c in compiled.columns]
    cleaned = compiled.select(*[
        rules.get(c, lambda value: value)(text.na_to_null(c)).alias(c) for c in have
    ])
    distinct = distinct_rows(cleaned)
    return distinct.withColumnsRenamed(PERM_LABELS) if labels else distinct

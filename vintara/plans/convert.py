"""Workbooks of a release tree -> Parquet releases beside them."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.plans.releases import release_of
from vintara.session import settle
from vintara.sources.listing import list_files, read_files
from vintara.sources.workbooks import missing_outputs, workbook_headers, workbook_rows, workbook_table


def convert_workbooks(
    spark: SparkSession, root: str, skip_existing: bool = False, redo: Collection[str] = ()
) -> DataFrame:
    """Write ``<name>.parquet`` beside every ``<name>.xlsx`` below ``root``.

    The workbooks are parsed once, one task per file, into a table in the shared folder; each
    release is then a projection of its rows. ``skip_existing`` leaves out workbooks that have
    an output, except those named in ``redo``. Returns (path, ok, error) per workbook.
    """
    files = read_files(spark, root, ["xlsx"])
    if skip_existing:
        outputs = list_files(spark, root, ["parquet"]).select(release_of("path").alias("path"))
        files = missing_outputs(files, outputs.where(~F.col("path").isin(list(redo))))
    rows = settle(workbook_rows(files))
    for header in workbook_headers(rows).collect():  # one row per workbook
        own = rows.where(F.col("path") == header["path"])
        table = workbook_table(own, [text or "" for text in header["cells"]])
        # a sheet has at most 2^20 rows and was read by one task: one file, in sheet order
        (
            table.coalesce(1).sortWithinPartitions("row").drop("path", "row")
            .write.mode("overwrite").parquet(header["path"].removesuffix(".xlsx") + ".parquet")
        )
    return rows.groupBy("path").agg(F.every("ok").alias("ok"), F.max("error").alias("error"))

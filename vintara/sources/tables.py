"""Text tables in and out: CSV, Parquet, mapping files, headers of releases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintara.functions.text import na_to_null, quoted, strip
from vintara.sources.csvblocks import csv_records, parsed


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
             header: Sequence[str] | None = None, multi_line: bool = True) -> DataFrame:
    """CSV as text, missing-value tokens null, only ``columns`` (in file order).

    ``header`` gives the file's columns; without it they are read from its first line. Values may
    hold line breaks, and large files are read by many tasks nevertheless (``csvblocks``); for files
    known to hold none Spark's own reader does without the pass that finds out where values end.
    """
    options = {"header": "true", "multiLine": str(multi_line).lower(), "escape": '"', "quote": '"', "nullValue": ""}
    if header is None:
        header = spark.read.options(**options).csv(path).schema.names
    if multi_line:
        df = parsed(csv_records(spark, path), header, options)
        return df.select(*[na_to_null(F.col(quoted(c))).alias(c) for c in header if columns is None or c in set(columns)])
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    df = spark.read.options(**options, enforceSchema="true").schema(schema).csv(path)
    wanted = [c for c in header if columns is None or c in set(columns)]
    return df.select(*[na_to_null(F.col(quoted(c))).alias(c) for c in wanted])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header in each part file and nulls empty."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').option("nullValue", "").csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def counted(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """The same rows, and their number with other aggregates of them (``rows``, ``metrics``), which
    the job that reads them gathers along the way; there is no scan of their own."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in metrics.items()]), seen


def size_in_mb(listing: DataFrame) -> DataFrame:
    """Total size of listed files."""
    return listing.agg(F.round(F.sum("length") / (1024 * 1024), 2).alias("size_mb"))


def read_release(spark: SparkSession, *paths: str) -> DataFrame:
    """Releases with one header (Parquet files, or folders of part files) with the file and row
    position of each row in ``_file_path`` and ``_row_index``."""
    return spark.read.parquet(*paths).select(
        "*", F.col("_metadata.file_path").alias("_file_path"), F.col("_metadata.row_index").alias("_row_index"))


def schema_of(spark: SparkSession, path: str) -> T.StructType:
    """Schema from the footer; no row is read."""
    return spark.read.parquet(path).schema


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names from the footer."""
    return schema_of(spark, path).names


def mapping_table(rows: DataFrame, original: str, final: str, order: str) -> DataFrame:
    """Trimmed (original, final) pairs; of duplicates the last by ``order`` wins."""
    return (
        rows.select(strip(original).alias("original"), strip(final).alias("final"), F.col(order).alias("_order"))
        .groupBy("original").agg(F.max_by("final", "_order").alias("final"))
    )


def mapping_of(targets: Sequence[str], renames: Mapping[str, str]) -> dict[str, str]:
    """Every target under its own name, and the renames."""
    return {**{t: t for t in targets}, **renames}


def mapping_dict(mapping: DataFrame) -> dict[str, str]:
    """A mapping table (a few hundred rows) as a dictionary."""
    return {row["original"]: row["final"] for row in mapping.select("original", "final").collect()}

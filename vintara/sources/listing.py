"""File listings and the choice of files to read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.config.sites import LISTED_EXTENSIONS
from vintara.functions.names import is_companion
from vintara.operators.joins import lookup_join


def list_files(spark: SparkSession, root: str, extensions: Sequence[str] = LISTED_EXTENSIONS) -> DataFrame:
    """(path, length) of the files below ``root``, partial downloads left out.

    The content column is not selected, so no file is read.
    """
    pattern = "*.{" + ",".join(extensions) + "}"
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(root)
    )
    return files.select("path", "length").where(~F.col("path").contains(".tmp"))


def read_files(spark: SparkSession, root: str, extensions: Sequence[str]) -> DataFrame:
    """(path, length, content) of the files below ``root``."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{" + ",".join(extensions) + "}")
        .load(root)
        .where(~F.col("path").contains(".tmp"))
        .select("path", "length", "content")
    )


def list_versions(spark: SparkSession, root: str, extensions: Sequence[str] = LISTED_EXTENSIONS) -> DataFrame:
    """(path, length, modified) of the files below ``root``; no file is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.{" + ",".join(extensions) + "}").load(root)
    return files.select("path", "length", F.col("modificationTime").alias("modified")).where(~F.col("path").contains(".tmp"))


def fingerprinted(
    spark: SparkSession, root: str, before: DataFrame | None = None, extensions: Sequence[str] = LISTED_EXTENSIONS
) -> DataFrame:
    """(path, length, modified, sha256) of the files below ``root``.

    A file that has its length and time from ``before``, an earlier result, keeps the fingerprint it
    has there and is not opened; only the others are read.
    """
    now = list_versions(spark, root, extensions)
    if before is None:
        known, fresh = None, now
    else:
        keys = ["path", "length", "modified"]
        known = lookup_join(now, before.select(*keys, "sha256").dropDuplicates(keys), keys, "inner")
        fresh = lookup_join(now, before.select(*keys).distinct(), keys, "left_anti")
    paths = [r["path"] for r in fresh.select("path").collect()]  # names of the files that are to be read
    if not paths:
        return known if known is not None else now.withColumn("sha256", F.lit(None).cast("string"))
    read = spark.read.format("binaryFile").load(paths).select(
        "path", "length", F.col("modificationTime").alias("modified"), fingerprint("content").alias("sha256"))
    return read if known is None else known.unionByName(read)


def fingerprint(content: Column | str) -> Column:
    """SHA-256 of bytes."""
    content = F.col(content) if isinstance(content, str) else content
    return F.sha2(content.cast("binary"), 256)


def with_vintage(listing: DataFrame, path: str = "path") -> DataFrame:
    """Add the folder a file lies in (``vintage``) and its name (``filename``)."""
    return listing.withColumns({
        "vintage": F.regexp_extract(path, r"([^/]+)/[^/]+$", 1),
        "filename": F.substring_index(path, "/", -1),
    })


def release_files(listing: DataFrame, extensions: Sequence[str] = ("xlsx",), companions: bool = False) -> DataFrame:
    """Files of the yearly folders in reading order; companion files only on request."""
    found = with_vintage(listing).where(F.col("filename").rlike(r"\.(" + "|".join(extensions) + ")$"))
    if not companions:
        found = found.where(~is_companion("filename"))
    return found.orderBy("vintage", "filename")


def main_files(listing: DataFrame, extensions: Sequence[str] = ("parquet", "xlsx")) -> DataFrame:
    """The main data file of each folder of ``listing(vintage, filename)``.

    By extension in the given order: the only file; else the only disclosure file; else the
    first new- or revised-form disclosure file; else the first disclosure file.
    """
    name = F.col("filename")
    disclosure = name.contains("Disclosure_Data")
    revised = F.lower(name).rlike("new_form|revised_form")
    file = F.struct("filename", *[c for c in listing.columns if c not in ("vintage", "filename")])
    # a folder of any size: only counts and the first name of each kind leave a task
    kinds = (
        listing.withColumn("extension", F.regexp_extract("filename", r"\.([^./]+)$", 1))
        .where(F.col("extension").isin(list(extensions)))
        .groupBy("vintage", "extension")
        .agg(
            F.count("*").alias("files"), F.count_if(disclosure).alias("disclosures"),
            F.min(file).alias("any"), F.min(F.when(disclosure, file)).alias("first"),
            F.min(F.when(disclosure & revised, file)).alias("first_revised"),
        )
    )
    picked = kinds.select(
        "vintage",
        F.array_position(F.array(*[F.lit(e) for e in extensions]), F.col("extension")).alias("preference"),
        F.when(F.col("files") == 1, F.struct(F.lit(1).alias("rule"), F.col("any").alias("file")))
        .when(F.col("disclosures") == 1, F.struct(F.lit(2).alias("rule"), F.col("first").alias("file")))
        .when(F.col("first_revised").isNotNull(),
              F.struct(F.lit(3).alias("rule"), F.col("first_revised").alias("file")))
        .when(F.col("first").isNotNull(), F.struct(F.lit(4).alias("rule"), F.col("first").alias("file")))
        .alias("pick"),
    ).where("pick IS NOT NULL")
    best = picked.groupBy("vintage").agg(F.min_by("pick", "preference").alias("pick"))
    return best.select("vintage", "pick.file.*", "pick.rule").select(*listing.columns, "rule")

"""The manifest as a table in buckets of its paths, so that runs over it move only the listing.

Every run compares the whole manifest with what storage holds. Bucketed by path, its rows are where
the join wants them. A path may have a large share of all rows, so a path's rows are dealt over
``PARTS`` buckets by their id, and the listing, which has one slim row for a path, is given to all of
them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.operators.manifest import MANIFEST

PARTS = 8
#: Rows that a bucket has room for, some 100 MB; a table that grows has more buckets.
BUCKET_ROWS = 250_000


def _part(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_part", F.pmod(F.xxhash64("id"), F.lit(PARTS)).cast("int"))


def save(manifest: DataFrame, table: str, buckets: int = 200) -> None:
    """Write a snapshot as the table, replacing the one before.

    It has ``buckets`` buckets at least, and one for every ``BUCKET_ROWS`` rows.
    """
    buckets = max(buckets, -(-manifest.count() // BUCKET_ROWS))
    rows = _part(manifest.select([f.name for f in MANIFEST]))
    rows.repartition(buckets, "saved_path", "_part").write.mode("overwrite").bucketBy(buckets, "saved_path", "_part").sortBy(
        "saved_path", "_part").saveAsTable(table)


def _listed(listing: DataFrame) -> DataFrame:
    """Each path once for every part."""
    return listing.select(F.col("path").alias("saved_path")).distinct().select(
        "saved_path", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("_part"), F.lit(True).alias("_found"))


def reconcile(spark: SparkSession, table: str, listing: DataFrame, run_at: Column) -> DataFrame:
    """``operators.manifest.reconcile`` on the table: active files that storage lost become ``missing``."""
    joined = spark.table(table).join(_listed(listing), ["saved_path", "_part"], "left")
    lost = (F.col("status") == "active") & F.col("_found").isNull()
    changed = joined.withColumns({
        "status": F.when(lost, "missing").otherwise(F.col("status")),
        "updated_at": F.when(lost, run_at).otherwise(F.col("updated_at"))})
    return changed.select([f.name for f in MANIFEST])


def untracked(spark: SparkSession, table: str, listing: DataFrame) -> DataFrame:
    """Paths found that no active entry refers to: held by none of the parts."""
    active = spark.table(table).where("status = 'active'").select("saved_path", "_part", F.lit(True).alias("_held"))
    held = _listed(listing).join(active, ["saved_path", "_part"], "left")
    return held.groupBy("saved_path").agg(F.max("_held").alias("_held")).where("_held IS NULL").select(F.col("saved_path").alias("path"))

"""The manifest kept in buckets of its entries: a run rewrites only the buckets it touches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintara.operators import manifest as m
from vintara.operators.joins import lookup_join
from vintara.session import settle


@dataclass(frozen=True)
class ManifestStore:
    """A manifest below ``root``, a folder per bucket of (period, url).

    ``buckets`` has to stay what it was when the store was made. An entry's versions share a bucket;
    its rows are dealt over ``parts`` files, so that an entry with very many versions is no task's own.
    """

    root: str
    buckets: int = 256
    parts: int = 4

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*m.ENTRY), F.lit(self.buckets)).cast("int").alias("bucket")

    def _write(self, rows: DataFrame) -> None:
        dealt = rows.select("*", self._bucket()).repartition("bucket", F.pmod(F.xxhash64("id"), F.lit(self.parts)))
        # only the buckets among the rows are replaced, when all of them are written
        dealt.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("bucket").parquet(self.root)

    def create(self, manifest: DataFrame) -> None:
        self._write(manifest.select([f.name for f in m.MANIFEST]))

    def _read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(T.StructType([*m.MANIFEST.fields, T.StructField("bucket", T.IntegerType())])).parquet(self.root)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._read(spark).drop("bucket")

    def put(self, rows: DataFrame) -> None:
        """Replace all rows of the entries among ``rows`` by these."""
        rows = settle(rows.select([f.name for f in m.MANIFEST]))
        touched = [r["bucket"] for r in rows.select(self._bucket()).distinct().collect()]  # at most ``buckets``
        if not touched:
            return
        spark = rows.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            self._write(rows)
            return
        held = self._read(spark).where(F.col("bucket").isin(touched)).drop("bucket")
        self._write(lookup_join(held, rows.select(*m.ENTRY).distinct(), m.ENTRY, "left_anti").unionByName(rows))

    def apply(self, outcomes: DataFrame, run_at: Column) -> list[int]:
        """Put a run's new entries in and replace what they supersede; the buckets rewritten.

        Entries are recognised by their id, so applying a run again, after it broke off or not,
        changes nothing more.
        """
        entries = settle(m.new_entries(outcomes, run_at))
        touched = sorted(r["bucket"] for r in entries.select(self._bucket()).distinct().collect())  # at most ``buckets``
        if touched:
            held = self._read(outcomes.sparkSession).where(F.col("bucket").isin(touched)).drop("bucket")
            others = lookup_join(held, entries.select("id"), ["id"], "left_anti")
            self._write(m.apply_entries(others, entries, run_at))
        return touched

"""LCA releases added one after the other to a table that is kept.

What is kept of earlier releases is an index: the position of the first row of every case. A new
release meets the index, not the releases before it, which need not exist any more. Positions order
releases, so the table is the same whatever order they are added in, and equal to a full compile.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.config.lca import LCA
from vintara.functions import text
from vintara.operators.dedup import keep_first_by_position, without_positions
from vintara.operators.joins import lookup_join
from vintara.plans.releases import ORDER, Release, find_damaged, harmonise_releases, read_headers, used_columns


@dataclass(frozen=True)
class CaseStore:
    """Compiled cases below ``root``: rows, an index of first positions, and the positions that lost.

    Every call of ``add`` is a batch with a number of its own. It counts once its last folder, the
    mark, is written; a batch that broke off is written anew by the next call.
    """

    root: str

    def _batches(self, spark: SparkSession) -> list[int]:
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/done")
        system = at.getFileSystem(spark._jsc.hadoopConfiguration())
        if not system.exists(at):
            return []
        done = [s.getPath() for s in system.listStatus(at)]
        return sorted(int(p.getName()) for p in done if system.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def _part(self, spark: SparkSession, name: str) -> DataFrame | None:
        """A table of all batches that count."""
        frames = [spark.read.parquet(f"{self.root}/{name}/{n}") for n in self._batches(spark)]
        return reduce(DataFrame.unionByName, frames) if frames else None

    def add(self, spark: SparkSession, releases: Sequence[Release], errors: dict[Release, str] | None = None) -> None:
        """Compile the releases into the table; those that cannot be read go to ``errors``."""
        headers, failed = read_headers(spark, releases)
        failed |= find_damaged(spark, headers, used_columns(LCA))
        if errors is not None:
            errors.update(failed)
        headers = {r: s for r, s in headers.items() if r not in failed}
        if not headers:
            return
        number = len(self._batches(spark))
        rows = harmonise_releases(spark, headers, LCA, lambda: {"year": F.col("_vintage")})
        rows = rows.withColumn("case_number", text.case_key("case_number"))
        key = text.case_key("case_number", null_as="NAN")
        first = keep_first_by_position(rows, [key], ORDER).select(*LCA.columns, key.alias("_key"), F.struct(*ORDER).alias("_at"))
        written = f"{self.root}/rows/{number}"
        first.write.mode("overwrite").parquet(written)
        new = spark.read.parquet(written).select("_key", "_at")
        index = self._part(spark, "index")
        if index is None:
            known = new.withColumn("_held", F.lit(None).cast(new.schema["_at"].dataType))
        else:
            known = lookup_join(new, index.groupBy("_key").agg(F.min("_at").alias("_held")).hint("merge"), ["_key"], "left")
        loses = F.coalesce(F.col("_held") < F.col("_at"), F.lit(False))
        lost = known.where("_held IS NOT NULL").select(F.when(loses, F.col("_at")).otherwise(F.col("_held")).alias("_at"))
        lost.write.mode("overwrite").parquet(f"{self.root}/lost/{number}")
        known.where(~loses).select("_key", "_at").write.mode("overwrite").parquet(f"{self.root}/index/{number}")
        spark.range(1).write.mode("overwrite").parquet(f"{self.root}/done/{number}")

    def read(self, spark: SparkSession) -> DataFrame:
        """One row per case, the first over all releases added."""
        rows = self._part(spark, "rows")
        if rows is None:
            raise ValueError(f"nothing was added to {self.root}")
        lost = self._part(spark, "lost").select("_at.*")
        return without_positions(rows.select("*", "_at.*"), lost, ORDER).select(*LCA.columns)

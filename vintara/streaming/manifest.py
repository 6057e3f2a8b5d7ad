"""Fetch results arriving as a stream, applied to the manifest batch by batch.

Rows are planned fetches with their result: the candidate's columns, ``decision``, the
response's ``sha256``, ``bytes``, ``etag``, ``last_modified`` and ``http_304``, and ``run_at``.
Each micro-batch writes the next snapshot to its own folder (``snapshot=<n>``), named after
the batch, so a batch repeated after a failure overwrites its own output and nothing else. The
last two snapshots stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from vintara.operators import manifest as m
from vintara.operators.dedup import keep_first


def snapshot_path(root: str, number: int) -> str:
    return f"{root}/snapshot={number:010d}"


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def apply_batches(root: str, first: DataFrame, mode: str = "safe") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function.

    Batch ``n`` reads snapshot ``n`` (``first`` before there is one) and writes ``n + 1``.
    """

    def apply(results: DataFrame, batch: int) -> None:
        spark: SparkSession = results.sparkSession
        held = first if batch == 0 else spark.read.schema(m.MANIFEST).parquet(snapshot_path(root, batch))
        # one result per entry and batch: the last one, of ties always the same
        one = keep_first(results, m.ENTRY, [F.desc("run_at"), F.desc("sha256"), F.desc("bytes"), F.desc("etag")])
        states = m.entry_states(held).select(
            *m.ENTRY, F.col("held.sha256").alias("held_sha256"), "top_version")
        plan = one.join(states, m.ENTRY, "left").withColumn(
            "next_version", (F.coalesce("top_version", F.lit(0)) + 1).cast("int"))
        fetched = plan.select(*m.ENTRY, "http_304", "sha256", "bytes", "etag", "last_modified")
        planned = plan.drop("http_304", "sha256", "bytes", "etag", "last_modified")
        entries = m.new_entries(m.fetch_outcomes(planned, fetched, mode), F.col("run_at"))
        run_at = entries.agg(F.max("created_at")).scalar()
        m.apply_entries(held, entries, run_at).write.mode("overwrite").parquet(snapshot_path(root, batch + 1))
        if batch > 0:  # a repeated batch reads the snapshot before it, never an older one
            _delete(spark, snapshot_path(root, batch - 1))

    return apply


def manifest_stream(
    results: DataFrame, first: DataFrame, root: str, checkpoint: str, mode: str = "safe"
) -> DataStreamWriter:
    """Writer that keeps the manifest up to date with a stream of fetch results."""
    return (
        results.writeStream.foreachBatch(apply_batches(root, first, mode))
        .option("checkpointLocation", checkpoint)
    )

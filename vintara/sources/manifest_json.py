"""The unversioned manifest as a document: one JSON object whose keys are urls."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = ("program", "filename", "year", "saved_path", "sha256", "timestamp", "etag", "last_modified")


def _document(spark: SparkSession, path: str) -> DataFrame:
    """(pos, url, raw) of each member; no rows if there is no file or it is no JSON object."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], "pos int, url string, raw string")
    # values that are objects arrive as their text
    members = spark.read.text(path, wholetext=True).select(F.map_entries(F.from_json("value", "map<string,string>")).alias("m"))
    return members.select(F.posexplode("m").alias("pos", "e")).select("pos", F.col("e.key").alias("url"), F.col("e.value").alias("raw"))


def read_manifest_json(spark: SparkSession, path: str, fields: Sequence[str] = FIELDS) -> tuple[DataFrame, DataFrame]:
    """Entries (url and the fields, as text), and damaged members (url, raw).

    A document that cannot be parsed gives way to the copy beside it (``<path>.bak``), and that to
    an empty manifest. Of a url that occurs again the last member counts.
    """
    members = _document(spark, path)
    if members.isEmpty():
        members = _document(spark, f"{path}.bak")
    last = members.groupBy("url").agg(F.max_by("raw", "pos").alias("raw"))
    parsed = F.from_json("raw", ", ".join(f"{f} string" for f in fields) + ", _damaged string", {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_damaged"})
    rows = last.select("url", "raw", parsed.alias("e"))
    damaged = F.coalesce(F.col("e._damaged").isNotNull() | ~F.ltrim("raw").startswith("{"), F.lit(True))
    return rows.where(~damaged).select("url", *[f"e.{f}" for f in fields]), rows.where(damaged).select("url", "raw")


def write_manifest_json(entries: DataFrame, path: str, fields: Sequence[str] = FIELDS) -> None:
    """Write the entries (one per url) as one document in order of url; the document before it is
    kept as ``<path>.bak``, and the new one appears whole.

    A document is one value, so one task puts it together: the format is for manifests of moderate size.
    """
    spark = entries.sparkSession
    member = F.struct("url", F.struct(*[F.col(f).cast("string").alias(f) for f in fields]).alias("entry"))
    whole = entries.agg(F.array_sort(F.collect_list(member)).alias("m")).select(
        F.to_json(F.map_from_entries("m"), {"ignoreNullFields": "false", "pretty": "true"}).alias("value"))
    jvm = spark._jvm.org.apache.hadoop.fs
    target, draft = jvm.Path(path), jvm.Path(f"{path}.draft")
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    whole.coalesce(1).write.mode("overwrite").text(f"{path}.draft")
    part = next(s.getPath() for s in system.listStatus(draft) if s.getPath().getName().startswith("part-"))
    if system.exists(target):
        backup = jvm.Path(f"{path}.bak")
        system.delete(backup, False)
        system.rename(target, backup)
    system.rename(part, target)
    system.delete(draft, True)

"""Session settings the operators are planned for."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed side even where that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Python workers get pages in batches of bounded size
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
    # the canonical layouts are wider than the default limit for generated code
    "spark.sql.codegen.maxFields": "300",
    # the JVM never compiles methods above 8000 bytes; Spark's split projections beat one that large
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build(name: str = "vintara", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A local session without one uses its warehouse, which tables go to anyway.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return spark.conf.get("spark.sql.warehouse.dir")


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def new_folder(spark: SparkSession) -> str:
    """A folder of its own in the shared one, deleted when the session ends."""
    path = f"{shared_folder(spark).rstrip('/')}/vintara-{uuid.uuid4().hex}"
    system, at = _file_system(spark, path)
    system.deleteOnExit(at)
    return path


def settle(df: DataFrame) -> DataFrame:
    """The same rows read back from a table in the shared folder: what leads up to them is
    computed once and survives the loss of executors. The table goes when the session ends,
    or when ``release`` is called."""
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._settled_at = path
    return back


def release(df: DataFrame) -> None:
    """Delete the table of a frame that ``settle`` gave and that nothing reads any more."""
    system, at = _file_system(df.sparkSession, df._settled_at)
    system.delete(at, True)


def tidy(spark: SparkSession) -> None:
    """Let the shuffle files of finished jobs go now: Spark deletes them once the driver's JVM has
    collected their plans, which it puts off while its heap has room. Those of the last job may stay."""
    spark._jvm.java.lang.System.gc()

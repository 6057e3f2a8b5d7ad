"""What Parquet footers say about files, without reading a column.

Spark answers counts of rows and values, and the least and greatest numbers and dates, from the
footers alone if the files are read by its second-generation reader; each footer is read by a task.
Texts and timestamps have no usable bounds there.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.functions.text import quoted

#: Types whose bounds in the footers are exact.
BOUNDED = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date")
_READERS = "spark.sql.sources.useV1SourceList"
_ANSWERED = "spark.sql.parquet.aggregatePushdown"


def footers_of(spark: SparkSession, *paths: str) -> DataFrame:
    """The files, by the reader that answers aggregates from footers."""
    spark.conf.set(_ANSWERED, "true")
    first_generation = spark.conf.get(_READERS)
    spark.conf.set(_READERS, ",".join(s for s in first_generation.split(",") if s.strip() != "parquet"))
    try:
        return spark.read.parquet(*paths)
    finally:
        spark.conf.set(_READERS, first_generation)


def _count(c: str, name: str) -> Column:
    return F.count(F.col(quoted(c))).alias(name)


def profile_files(spark: SparkSession, paths: Sequence[str], ranges: Sequence[str] = ()) -> DataFrame:
    """(column_name, rows, null_rows, null_percent, first_value, last_value) of the files' columns.

    ``ranges`` names the columns whose least and greatest value are wanted, given as text. Only
    those of types that footers have no bounds for are read, and nothing else.
    """
    files = footers_of(spark, *paths)
    kinds = dict(files.dtypes)
    own = [c for c in ranges if kinds[c] in BOUNDED]
    names = {c: f"_{i}" for i, c in enumerate(files.columns)}
    counted = files.agg(
        F.count("*").alias("rows"), *[_count(c, n) for c, n in names.items()],
        *[f(F.col(quoted(c))).alias(f"{names[c]}_{e}") for c in own for e, f in (("low", F.min), ("high", F.max))])
    text = lambda c, e: F.col(f"{names[c]}_{e}").cast("string") if c in own else F.lit(None).cast("string")
    each = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(n).alias("filled"), text(c, "low").alias("first_value"),
                              text(c, "high").alias("last_value")) for c, n in names.items()])
    found = counted.select("rows", F.explode(each).alias("c")).select("rows", "c.*")
    others = [c for c in ranges if c not in own]
    if others:
        rows = spark.read.parquet(*paths).agg(*[f(F.col(quoted(c))).cast("string").alias(f"{names[c]}_{e}")
                                                for c in others for e, f in (("low", F.min), ("high", F.max))])
        bounds = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{names[c]}_low").alias("first_value"),
                                                          F.col(f"{names[c]}_high").alias("last_value")) for c in others])).alias("c"))
        nothing = F.lit(None).cast("long")
        found = found.unionByName(bounds.select(nothing.alias("rows"), nothing.alias("filled"), "c.*"))
        found = found.groupBy("column_name").agg(*[F.max(c).alias(c) for c in ("rows", "filled", "first_value", "last_value")])
    nulls = F.col("rows") - F.col("filled")
    share = F.round(100.0 * nulls / F.nullif(F.col("rows"), F.lit(0)), 4)
    return found.select("column_name", "rows", nulls.alias("null_rows"), share.alias("null_percent"), "first_value", "last_value")


def count_values(spark: SparkSession, columns: Mapping[str, Sequence[str]]) -> dict[str, dict[str, int]]:
    """Values of the named columns of each path, all paths in one job over their footers.

    Files whose writers left out the counts are read instead.
    """
    def counted(read) -> dict[str, dict[str, int]]:
        frames = []
        for path, names in columns.items():
            counts = read(path).agg(*[_count(c, f"_{i}") for i, c in enumerate(names)])
            frames.append(counts.select(F.lit(path).alias("path"), F.array(*[F.col(f"_{i}") for i in range(len(names))]).alias("n")))
        union = frames[0]
        for frame in frames[1:]:
            union = union.unionByName(frame)
        return {r["path"]: dict(zip(columns[r["path"]], r["n"])) for r in union.collect()}  # a row per path

    if not columns:
        return {}
    try:
        return counted(lambda path: footers_of(spark, path))
    except Exception:  # no counts in some footer
        return counted(spark.read.parquet)

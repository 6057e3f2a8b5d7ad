"""What the operators share: session settings, shipped functions, words, tables."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Python workers get texts in batches of bounded size, however long the texts are.
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}

#: A word: a run of anything but ASCII white space (fixed by the contracts).
WORD = r"[^\x20\x09-\x0D]+"
#: The characters between words.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def by_value(module: str) -> None:
    """Let the module's task functions travel whole: executors need not have this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def tuned(df: DataFrame) -> DataFrame:
    """The same frame, with the session's batches bounded."""
    for key, value in SETTINGS.items():
        df.sparkSession.conf.set(key, value)
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tuned(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, also where ``use`` mentions it
    inside lambdas (an alias mentioned once in a lambda would be inlined into its loop)."""
    return F.transform(F.array(value), use)[0]


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def packed(df: DataFrame) -> Column:
    """All columns as one, ``_row``: whatever they are called, they clash with no other."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")


def unpacked(rows: DataFrame, like: DataFrame, changed: dict[str, Column] | None = None) -> DataFrame:
    """The columns that ``packed`` took from ``like``, some of them changed."""
    return rows.select(*[(changed or {}).get(c, F.col("_row")[c]).alias(c) for c in like.columns])

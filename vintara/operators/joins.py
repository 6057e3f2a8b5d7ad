"""Joins against a side with at most one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join rows with the one row ``right`` has for their key (``left``, ``inner``, ``left_semi``, ``left_anti``).

    A key may hold a large share of the left rows. The adaptive skew join splits such a key
    when both sides reach the join straight from a shuffle, so the join is on a computed key:
    a right side that is already partitioned by the plain columns (an aggregate, another
    join) is shuffled once more instead of being used in place, which would rule the split
    out. A right side that turns out small is broadcast at run time by its measured size.
    """
    on = list(on)
    keyed = right.withColumn("_right_key", F.struct(*on)).drop(*on)
    rows = left.withColumn("_left_key", F.struct(*on))
    return rows.join(keyed, F.col("_left_key") == F.col("_right_key"), how).drop("_left_key", "_right_key")

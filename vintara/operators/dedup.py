"""Duplicate removal with a defined "first wins" order.

A key may hold a large share of all rows, so no operator brings a key's rows together:
``row_number() = 1`` is pruned to one row per key in every input task before the shuffle
(window group limit), and the others are aggregates with map-side combine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vintara.functions.text import quoted
from vintara.operators.joins import lookup_join
from vintara.session import settle


def keep_first(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: Sequence[str | Column],
    null_keys: str = "collapse",
) -> DataFrame:
    """The first row of each key by ``order``.

    Null keys are one key (``collapse``) or all stay (``keep``).
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    by = list(keys)
    if null_keys == "keep":
        # a null key makes the row's own position part of its key
        absent = [k.isNull() for k in keys]
        some_null = absent[0]
        for a in absent[1:]:
            some_null = some_null | a
        by.append(F.when(some_null, F.struct(*order)))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


#: Bits of a row number that choose a row among those that one bitmap stands for: 2^15 rows, 4 KB.
_CHUNK = 15
#: Bitmaps that are sent to the tasks, 64 MB for half a billion rows; where they are more, rows meet them by a shuffle.
BITMAPS = 1 << 14


def _place(position: Sequence[str]) -> tuple[Column, Column]:
    """Which bitmap a row has its bit in, and which bit that is."""
    *file, row = position
    number = F.col(row).cast("long")
    own = F.coalesce(number.bitwiseAND(F.lit((1 << _CHUNK) - 1)), F.lit(0).cast("long"))
    return F.struct(*[F.col(f) for f in file], F.shiftright(number, _CHUNK).alias("chunk")), own


def without_positions(df: DataFrame, lost: DataFrame, position: Sequence[str]) -> DataFrame:
    """The rows of ``df`` but those at the positions of ``lost``, which has the same columns.

    A position is a file and a row number in it, the last of its columns. Each bitmap tells of the
    rows of a file by a bit, so however many are lost, what the wide rows meet is an eighth of a
    byte a row, and they are neither moved nor sorted.
    """
    chunk, bit = _place(position)
    places = lost.select(chunk.alias("_chunk"), bit.alias("_bit")).repartition("_chunk")  # no task holds all bitmaps
    marks = settle(places.groupBy("_chunk").agg(F.expr("bitmap_construct_agg(_bit)").alias("_bits")))
    marks = F.broadcast(marks) if marks.count() <= BITMAPS else marks.hint("merge")
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright("_own_bit", 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_lost = F.bit_get(byte, F.col("_own_bit").bitwiseAND(F.lit(7)).cast("int")) == 1
    rows = df.withColumns({"_own_chunk": chunk, "_own_bit": bit})
    return rows.join(marks, (F.col("_own_chunk") == F.col("_chunk")) & is_lost, "left_anti").drop("_own_chunk", "_own_bit")


def keep_first_by_position(
    df: DataFrame, keys: Sequence[str | Column], position: Sequence[str]
) -> DataFrame:
    """``keep_first`` for wide rows that their position identifies (file and row number).

    Keys and positions alone are aggregated and joined, by a shuffle: how large they are in memory
    cannot be told from the size of their files. The wide rows only meet the positions that lose.
    """
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    names = [f"_key_{i}" for i in range(len(keys))]
    slim = df.select(*[k.alias(n) for k, n in zip(keys, names)], F.struct(*position).alias("_at"))
    several = slim.groupBy(*names).agg(F.min("_at").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    losers = lookup_join(slim, several.hint("merge"), names, "inner").where("_at != _first")
    return without_positions(df, losers.select("_at.*"), position)


def keep_first_block_by_position(
    df: DataFrame, key: str, group: str, position: Sequence[str], block_rows: int = 200_000, null_as: str = "NAN"
) -> DataFrame:
    """``keep_first_block`` over the ``global_positions`` of wide rows that their position, file and
    row number, identifies: keys and positions alone are placed, aggregated and joined."""
    slim = df.select(F.coalesce(F.col(quoted(key)), F.lit(null_as)).alias("_key"), group, *position)
    placed = global_positions(slim, group, *position, name="_position")
    blocks = placed.select("_key", F.floor(F.col("_position") / F.lit(block_rows)).cast("bigint").alias("_block"), *position)
    first = blocks.groupBy("_key").agg(F.min("_block").alias("_first"))
    losers = lookup_join(blocks, first.hint("merge"), ["_key"], "inner").where("_block != _first")
    return without_positions(df, losers.select(*position), position)


def keep_first_block(
    df: DataFrame, key: str, position: str, block_rows: int = 200_000, null_as: str = "NAN"
) -> DataFrame:
    """Rows in the block of ``block_rows`` positions where their key first appears.

    Duplicates inside that first block survive, later blocks lose the key. The rows of a
    key meet its first block in a semi join on (key, block), so one task gets at most a
    block of a hot key.
    """
    keyed = df.withColumn("_key", F.coalesce(F.col(quoted(key)), F.lit(null_as))).withColumn(
        "_block", F.floor(F.col(position) / F.lit(block_rows)).cast("bigint")
    )
    first = keyed.groupBy("_key").agg(F.min("_block").alias("_block"))
    return keyed.join(first, ["_key", "_block"], "left_semi").drop("_key", "_block")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows, nulls equal."""
    return df.dropDuplicates()


def global_positions(
    df: DataFrame, group: str, file: str, row: str, name: str = "position"
) -> DataFrame:
    """Position of each row over all files, in order of (group, file, row).

    Row counts per file are added up inside each group and group totals across groups; the
    two running sums see one row per file and one row per group, never the data. A null group
    or file is one like any other, before the rest.
    """
    sizes = df.groupBy(F.col(group).alias("_group"), F.col(file).alias("_file")).agg(
        F.count("*").alias("_rows")
    )
    within = Window.partitionBy("_group").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    totals = sizes.groupBy("_group").agg(F.sum("_rows").alias("_total"))
    # one row per group (release year)
    across = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_group", F.coalesce(F.sum("_total").over(across), F.lit(0)).alias("_before"))
    placed = sizes.withColumn("_start", F.coalesce(F.sum("_rows").over(within), F.lit(0)))
    starts = lookup_join(placed, totals, ["_group"], "inner").select(
        "_group", "_file", (F.col("_start") + F.col("_before")).alias("_start"))
    starts = starts.withColumnsRenamed({"_group": group, "_file": file})
    return lookup_join(df, starts, [group, file]).withColumn(name, F.col("_start") + F.col(row)).drop("_start")

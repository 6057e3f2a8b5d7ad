"""One large CSV over many tasks, values with line breaks kept whole.

Where a line stands, outside or inside a quoted value, depends on all lines before it. But what a
line does is known by itself: for either state in which it may begin, the state in which it ends.
Such functions compose, so every split of a file gives one, from a first pass over the lines; the
splits in order then give the state in which each begins. In the second pass a task puts its lines
together to records as they stream by. What is left of a record at the edges of splits, two pieces
for a split, is joined afterwards. No line is moved but those pieces.

Quotes follow RFC 4180; a quote inside an unquoted value is a character, and what follows a closing
quote belongs to the value up to the next comma, as for Spark's own reader. Lines end with ``\\n`` or
``\\r\\n``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vintara.functions.text import quoted

# the tasks' functions travel whole: executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_QUOTED = r'"(?:[^"]++|"")*+'
_VALUES = rf'(?:(?:{_QUOTED}"[^,]*+|[^",][^,]*+|),)*+'
#: A line that begins outside a value and ends inside one; the same for one that begins inside.
_LEFT_OPEN = rf"(?s)^{_VALUES}{_QUOTED}\z"
_STAYS_OPEN = rf'(?s)^(?:[^"]++|"")*+(?:\z|"[^,]*+,{_VALUES}{_QUOTED}\z)'
_RECORDS = "file string, block long, seq long, place int, record string"
_WHOLE, _HEAD, _TAIL, _INNER = range(4)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of each split in order, with the states in which they end: bit 0 is set if a line that
    begins outside a value ends inside one, bit 1 if one does that begins inside."""
    line = F.col("value")
    some = line.contains('"')
    ends = F.when(some & line.rlike(_LEFT_OPEN), 1).otherwise(0) + F.when(~some | line.rlike(_STAYS_OPEN), 2).otherwise(0)
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        ends.cast("byte").alias("ends"), line.alias("line"))


def _states(ends: np.ndarray, state: int) -> np.ndarray:
    """State before each line, and after the last, from the state before the first.

    After a line that ends alike from both states everything is known; lines between two such
    either keep the state or change it, so it follows from the number of changes.
    """
    fixed, swap = (ends == 0) | (ends == 3), ends == 1
    changes = np.concatenate([[0], np.cumsum(swap)])
    last = np.maximum.accumulate(np.concatenate([[0], np.where(fixed, np.arange(1, len(ends) + 1), 0)]))
    known = np.concatenate([[state], (ends == 3).astype(np.int64)])
    return (known[last] + changes - changes[last]) % 2


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """Parts of a batch that lie in one split."""
    block = batch.column("block").to_numpy()
    file = batch.column("file").dictionary_encode().indices.to_numpy()
    cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(file) != 0)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(block)]):
        if b > a:
            yield batch.column("file")[a].as_py(), int(block[a]), batch.slice(a, b - a)


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the lines of each split do together."""
    found: dict[tuple[str, int], list[int]] = {}
    for batch in batches:
        for file, block, part in _runs(batch):
            ends = part.column("ends").to_numpy()
            found[file, block] = [int(_states(ends, s)[-1]) for s in found.get((file, block), [0, 1])]
    rows = [{"file": f, "block": b, "ends": a + 2 * c} for (f, b), (a, c) in found.items()]
    yield pa.RecordBatch.from_pylist(rows, pa.schema([("file", pa.string()), ("block", pa.int64()), ("ends", pa.int8())]))


def begins_inside(lines: DataFrame) -> DataFrame:
    """(file, block, inside) of each split: whether it begins inside a value."""
    blocks = lines.select("file", "block", "ends").mapInArrow(_functions, "file string, block long, ends byte")
    here = Window.partitionBy("file").orderBy("block")  # a row per split
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    counted = blocks.withColumn("swaps", F.sum((F.col("ends") == 1).cast("int")).over(here))
    fixed = F.when(F.col("ends").isin(0, 3), F.struct("block", (F.col("ends") == 3).cast("int").alias("state"), "swaps"))
    return counted.withColumns({"last": F.max(fixed).over(before), "changes": F.coalesce(F.lag("swaps").over(here), F.lit(0))}).select(
        "file", "block", ((F.coalesce("last.state", F.lit(0)) + F.col("changes") - F.coalesce("last.swaps", F.lit(0))) % 2 == 1).alias("inside"))


def _put_together(inside: set[tuple[str, int]]):
    """Records of each split: whole ones, and the pieces at its edges."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _RECORDS.split(", ")]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
        at: tuple[str, int] | None = None
        seq = state = 0
        begun: list[str] = []  # lines of the record that goes on
        first = False  # whether it has begun in a split before

        def out(file: str, block: int, records: list, places: list, start: int) -> pa.RecordBatch:
            n = len(records)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(
                ([file] * n, [block] * n, range(start, start + n), places, records), kinds)], names)

        def rest() -> Iterator[pa.RecordBatch]:
            if begun:
                yield out(*at, ["\n".join(begun)], [_INNER if first else _TAIL], seq)

        for batch in batches:
            for file, block, part in _runs(batch):
                if (file, block) != at:
                    yield from rest()
                    at, seq, begun = (file, block), 0, []
                    state = int(at in inside)
                    first = state == 1
                states = _states(part.column("ends").to_numpy(), state)
                state = int(states[-1])
                if not states.any() and not begun:  # nothing but lines that are records
                    lines = part.column("line")
                    n = len(lines)
                    yield pa.RecordBatch.from_arrays([
                        pa.repeat(file, n), pa.repeat(pa.scalar(block, pa.int64()), n), pa.array(np.arange(seq, seq + n)),
                        pa.repeat(pa.scalar(_WHOLE, pa.int32()), n), lines.cast(pa.string())], names)
                    seq += n
                    continue
                records, places, start = [], [], seq
                for line, then in zip(part.column("line").to_pylist(), states[1:].tolist()):
                    begun.append(line)
                    if not then:
                        records.append("\n".join(begun))
                        places.append(_HEAD if first else _WHOLE)
                        begun, first, seq = [], False, seq + 1
                if records:
                    yield out(file, block, records, places, start)
        yield from rest()

    return read


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of CSV files as text, with the place of each: (file, block, seq, record)."""
    lines = _lines(spark, path)
    # one pair for each split that begins inside a value, of some hundred bytes; a split has 128 MB by default
    inside = {(r["file"], r["block"]) for r in begins_inside(lines).where("inside").collect()}
    found = lines.mapInArrow(_put_together(inside), _RECORDS)
    whole = found.where(F.col("place") == _WHOLE).select("file", "block", "seq", "record")
    if not inside:
        return found.select("file", "block", "seq", "record")  # also a record that the end of a file leaves open
    pieces = found.where(F.col("place") != _WHOLE)
    by = Window.partitionBy("file").orderBy("block", "seq")
    numbered = pieces.withColumn("nth", F.sum((F.col("place") == _TAIL).cast("int")).over(by))
    joined = numbered.groupBy("file", "nth").agg(
        F.min(F.struct("block", "seq")).alias("at"), F.array_sort(F.collect_list(F.struct("block", "seq", "record"))).alias("parts"))
    return whole.unionByName(joined.select(
        "file", "at.block", "at.seq", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record")))


def parsed(records: DataFrame, header: Sequence[str], options: dict[str, str]) -> DataFrame:
    """Columns of the records as text; the first record of a file is its header, blank ones go."""
    schema = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(header))])
    record = F.regexp_replace("record", r"\r\z", "")
    rows = records.where((F.col("block") != 0) | (F.col("seq") != 0)).where(~record.rlike(r"\A\s*\z"))
    fields = F.from_csv(record, schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ").replace(",", ", "), options)
    return rows.select(fields.alias("r")).select(*[_field(i).alias(c) for i, c in enumerate(header)])


def _field(i: int) -> Column:
    return F.col(f"r.{quoted(f'_{i}')}")

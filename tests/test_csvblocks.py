"""CSV over many tasks, against Spark's reader that takes a file whole."""

from __future__ import annotations

import random

import numpy as np
import pytest

from vintara.sources import csvblocks
from vintara.sources.tables import read_csv

OPTIONS = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"', "nullValue": ""}


def _value(draw: random.Random) -> str:
    text = "".join(draw.choices(["a", "bc", ",", "\n", '"', '""', " ", "é", "\n\n", "x" * 30], k=draw.randint(0, 8)))
    kind = draw.random()
    if kind < 0.55:
        return '"' + text.replace('"', '""') + '"'
    plain = "".join(c for c in text if c not in ',\n"')
    return plain if kind < 0.9 else plain + 'q"' + plain  # a quote inside an unquoted value


def _rows(frame) -> list:
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_many_splits_of_many_files(spark, tmp_path, small_splits, ending):
    draw = random.Random(3)
    for i in range(4):
        rows = [",".join(_value(draw) for _ in range(3)) for _ in range(250)]
        (tmp_path / f"f{i}.csv").write_bytes(ending.join(["one,two,three", *rows, ""]).encode())
    whole = spark.read.options(**OPTIONS).csv(str(tmp_path))
    found = csvblocks.parsed(csvblocks.csv_records(spark, str(tmp_path)), ["one", "two", "three"], OPTIONS)
    assert csvblocks._lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    assert _rows(found) == _rows(whole) and found.columns == whole.columns


def test_values_larger_than_splits(spark, tmp_path, small_splits):
    rows = [f'{i},"{"line of a value" * 3}\n' + "more\n" * 400 + f'end {i}",z' for i in range(5)]
    (tmp_path / "f.csv").write_text("\n".join(["a,b,c", *rows, 'x,"left open\nto the end', "of file"]))
    got = _rows(csvblocks.parsed(csvblocks.csv_records(spark, str(tmp_path)), ["a", "b", "c"], OPTIONS))
    assert got[:5] == _rows(spark.read.options(**OPTIONS).csv(str(tmp_path)))[:5] and len(got) == 6
    assert [len(r[1]) for r in got[:5]] == [len(rows[0].split('"')[1])] * 5


def test_places_are_those_of_the_file(spark, tmp_path, small_splits):
    rows = [f'{i},"{"x" * (i % 40)}\n{i}"' for i in range(200)]
    (tmp_path / "f.csv").write_text("\n".join(["a,b", *rows]) + "\n")
    found = csvblocks.csv_records(spark, str(tmp_path)).orderBy("file", "block", "seq").collect()
    assert [r["record"] for r in found] == ["a,b", *rows]


@pytest.mark.parametrize("text, want", [
    ("", []), ("a,b", []), ("a,b\n", []), ("a,b\n1,2", [("1", "2")]), ('a,b\n"x\ny",2\n', [("x\ny", "2")]), ("a,b\n\n1,\n", [("1", None)]),
])
def test_small_files(spark, tmp_path, text, want):
    (tmp_path / "f.csv").write_text(text)
    assert _rows(csvblocks.parsed(csvblocks.csv_records(spark, str(tmp_path)), ["a", "b"], OPTIONS)) == want


def test_only_wanted_columns(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a,b,a.c\n1,"x\n""y""",NULL\n')
    assert [tuple(r) for r in read_csv(spark, str(tmp_path), columns=["b", "a.c"]).collect()] == [('x\n"y"', None)]


def test_states_of_lines_compose():
    draw = np.random.default_rng(2)
    for _ in range(300):
        ends = draw.integers(0, 4, draw.integers(0, 12)).astype(np.int8)
        for begin in (0, 1):
            want = [begin]
            for e in ends.tolist():
                want.append(e >> want[-1] & 1)
            assert csvblocks._states(ends, begin).tolist() == want

from __future__ import annotations

from vintara.operators import profile

DATA = [("a", 1, None), ("b", 1, None), ("a", None, None), (None, 2, None)]
SCHEMA = "x string, y int, z string"


def test_frequencies(frame):
    df = frame(DATA, SCHEMA)
    assert [tuple(r) for r in profile.frequencies(df, ["x", "y"]).collect()] == [
        ("x", "a", 2), ("x", "b", 1), ("y", "1", 2), ("y", "2", 1)]
    assert [tuple(r) for r in profile.frequency(df, "x", top=1).collect()] == [("a", 2)]
    assert [tuple(r) for r in profile.frequency(df, "y", by_value=True).collect()] == [(1, 2), (2, 1)]


def test_null_shares(frame):
    got = [tuple(r) for r in profile.null_shares(frame(DATA, SCHEMA)).collect()]
    assert got == [("z", 4, 100.0), ("x", 1, 25.0), ("y", 1, 25.0)]
    assert [r["null_percent"] for r in profile.null_shares(frame([], SCHEMA)).collect()] == [None] * 3


def test_steps_ranges_and_counts(frame):
    df = frame(DATA, SCHEMA)
    assert [tuple(r) for r in profile.step_counts({"in": df, "out": df.limit(1).select("x")}).collect()] == [
        (0, "in", 4, 3), (1, "out", 1, 1)]
    assert tuple(profile.value_range(df, "y").collect()[0]) == (1, 2)
    assert tuple(profile.conditional_counts(df, "x", ["a", "q"]).collect()[0]) == (2, 0)

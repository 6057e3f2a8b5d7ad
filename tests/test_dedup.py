from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from vintara.operators import dedup


def rows(n=400, keys=40, seed=3):
    random.seed(seed)
    # one key holds a third of the rows, some keys are null
    return [
        (i, "hot" if random.random() < 0.33 else None if random.random() < 0.1 else f"k{random.randrange(keys)}")
        for i in range(n)
    ]


def brute_first(data, keep_nulls):
    seen, out = set(), []
    for i, key in data:
        if (key is None and keep_nulls) or key not in seen:
            out.append(i)
        seen.add(key)
    return out


@pytest.mark.parametrize("nulls", ["collapse", "keep"])
def test_keep_first(spark, nulls):
    data = rows()
    df = spark.createDataFrame(data, "i int, key string").repartition(7)
    got = sorted(r["i"] for r in dedup.keep_first(df, ["key"], ["i"], nulls).collect())
    assert got == brute_first(data, nulls == "keep")


def test_keep_first_by_position(spark):
    data = rows()
    df = spark.createDataFrame([(i // 100, i % 100, key) for i, key in data], "f int, r int, key string").repartition(7)
    got = sorted(r["f"] * 100 + r["r"] for r in dedup.keep_first_by_position(df, ["key"], ["f", "r"]).collect())
    assert got == brute_first(data, False)


@pytest.mark.parametrize("block", [1, 7, 50, 400, 1000])
def test_keep_first_block(spark, block):
    data = rows()
    seen, want = set(), []
    for start in range(0, len(data), block):
        chunk = [(i, key) for i, key in data[start:start + block] if key not in seen]
        seen |= {key for _, key in chunk}
        want += [i for i, _ in chunk]
    df = spark.createDataFrame(data, "i int, key string").repartition(5)
    got = sorted(r["i"] for r in dedup.keep_first_block(df, "key", "i", block).collect())
    assert got == want
    if block == 1:
        assert got == brute_first(data, False)
    if block >= len(data):
        assert len(got) == len(data)


def test_rows_of_a_key_are_pruned_before_the_shuffle(spark):
    df = spark.createDataFrame(rows(), "i int, key string")
    plan = dedup.keep_first(df, ["key"], ["i"])._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange"):]
    assert "row_number(), 1, Partial" in before


def test_distinct_rows_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "i int, v string")
    assert dedup.distinct_rows(df).count() == 2


def test_positions_follow_group_file_and_row(spark):
    data = [(g, f, r) for g, f, n in [("2020", "b", 3), ("2019", "z", 2), ("2020", "a", 4), (None, "n", 2)] for r in range(n)]
    df = spark.createDataFrame(data, "g string, f string, r long").repartition(3)
    got = {(r["g"], r["f"], r["r"]): r["position"] for r in dedup.global_positions(df, "g", "f", "r").collect()}
    assert got == {key: i for i, key in enumerate(sorted(data, key=lambda x: (x[0] or "", x[1:])))}


def test_wide_rows_are_not_sorted_where_losers_are_few(spark):
    df = spark.range(1000).selectExpr("id AS p", "if(id < 4, 0, id) AS k", "repeat('x', 100) AS wide").repartition(4)
    kept = dedup.keep_first_by_position(df, ["k"], ["p"])
    assert sorted(r["p"] for r in kept.collect()) == [0, *range(4, 1000)]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    above = final[:final.index("BroadcastQueryStage")]
    assert "BroadcastHashJoin" in above and "LeftAnti" in above and "Sort " not in above


def _wide(spark, data):
    return spark.createDataFrame([("g", f"f{i // 50_000}", i % 50_000 * 3, key, "x" * 50) for i, key in data],
                                 "g string, f string, r long, key string, wide string").repartition(7)


def test_rows_at_lost_positions_go_by_bitmaps(spark, monkeypatch):
    df = spark.range(200_000).selectExpr("concat('f', id % 3) AS f", "id AS r", "id AS i")
    df = df.union(spark.createDataFrame([(None, 5, -1), ("f0", None, -2), ("f1", None, -3)], "f string, r long, i long"))
    lost = df.where("i % 7 = 0 OR i IN (-1, -2)").select("f", "r")
    want = [-3] + [i for i in range(200_000) if i % 7]
    for most in (dedup.BITMAPS, 0):  # sent to the tasks, met by a shuffle
        monkeypatch.setattr(dedup, "BITMAPS", most)
        assert sorted(r["i"] for r in dedup.without_positions(df, lost.union(lost), ["f", "r"]).collect()) == want


def test_wide_rows_are_not_moved_where_most_lose(spark, tmp_path):
    """Files are small where positions repeat their paths; what is sent to the tasks must not be sized by them."""
    spark.range(60_000).selectExpr("concat('/a/long/path/', id % 2) AS f", "id AS r", "id % 3 AS key", "'w' AS wide").write.parquet(str(tmp_path / "t"))
    kept = dedup.keep_first_by_position(spark.read.parquet(str(tmp_path / "t")), ["key"], ["f", "r"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "_bits" in plan and "_lost" not in plan and "Sort " not in plan
    assert sorted(r["r"] for r in kept.collect()) == [0, 2, 4]  # of even ones, which come first


@pytest.mark.parametrize("block", [1, 7, 50, 400])
def test_first_block_by_position(spark, block):
    data = rows()
    df = _wide(spark, data).withColumn("place", F.col("r"))
    seen, want = set(), []
    for start in range(0, len(data), block):
        chunk = [(i, key) for i, key in data[start:start + block] if key not in seen]
        seen |= {key for _, key in chunk}
        want += [i for i, _ in chunk]
    # row numbers in a file are gapless
    kept = dedup.keep_first_block_by_position(df.withColumn("r", F.expr("r div 3")), "key", "g", ["f", "r"], block)
    assert sorted(r["place"] // 3 for r in kept.collect()) == want
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "_bits" in plan and "Sort " not in plan

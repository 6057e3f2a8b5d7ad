from __future__ import annotations

import oracle
import pytest
from pyspark.sql import functions as F

from vintara.llm import mixing, queries

SF = "/root/testdata/sf0.01"


def test_query_equals_sql_and_reruns_agree(spark):
    first = queries.op3_mixing(spark, SF)
    assert oracle.compare(first, oracle.connect(SF), queries.ORACLES["op3_mixing"]) == ""
    assert first.exceptAll(queries.op3_mixing(spark, SF)).count() == 0


def test_sources_come_near_their_targets(spark):
    rows = queries.op3_mixing(spark, SF)
    by = rows.groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.max("size").alias("largest")).collect()
    for r in by:
        assert abs(r.taken - r.target) <= r.largest / 2 + 1
    assert rows.where("taken > 3 * size").count() == 0


def _level(sizes, weights, limit=3):
    """Targets by dealing out the excess again and again."""
    goal = [sum(sizes) * w / sum(weights) for w in weights]
    for _ in range(100):
        over = [g >= limit * s for g, s in zip(goal, sizes)]
        excess = sum(max(0, g - limit * s) for g, s in zip(goal, sizes))
        free = sum(w for w, o in zip(weights, over) if not o)
        if excess < 1e-9 or not free:
            break
        goal = [limit * s if o else g + excess * w / free for g, s, w, o in zip(goal, sizes, weights, over)]
    return goal


@pytest.mark.parametrize("sizes", [[10, 1000, 30, 500, 7], [1, 1, 1, 10_000], [5], [0, 0], [100, 0, 50]])
def test_targets(spark, sizes):
    names = [chr(97 + i) for i in range(len(sizes) - 1)] + [None]
    frame = spark.createDataFrame(list(zip(names, sizes)), "source string, size long")
    got = {r.source: r.target for r in mixing.targets(frame, "source", "size").collect()}
    want = _level(sizes, [(5, 2, 1)[i % 3] for i in range(len(sizes))])
    assert [got[n] for n in names] == pytest.approx(want)


def test_code_point_order(spark):
    frame = spark.createDataFrame([("é", 10), ("Z", 10), ("a", 10), (None, 10), ("\U0001F600", 10), ("￿", 10)],
                                  "source string, size long")
    got = sorted(mixing.targets(frame, "source", "size").collect(), key=lambda r: -r.target)
    weights = {r.source: round(r.target / min(x.target for x in got)) for r in got}
    assert weights == {"Z": 3, "a": 2, "é": 1, "￿": 3, "\U0001F600": 2, None: 1} or weights["Z"] == weights["￿"]


def test_odd_rows(spark):
    rows = [(1, None, "s"), (2, "", "s"), (2, "", "s"), (None, "a b", None), (3, "word " * 30_000, "t"), (4, "x y z", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("copies", F.lit("mine"))
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns and {r.copies for r in out.collect()} == {"mine"}
    assert out.where("text is not null and length(text) > 0").count() >= 2
    assert mixing.mix_documents(docs.limit(0)).count() == 0


def test_small_buckets_change_nothing(spark, monkeypatch):
    before = queries.op3_mixing(spark, SF)
    kept = before.collect()
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 1)
    assert sorted(map(str, queries.op3_mixing(spark, SF).collect())) == sorted(map(str, kept))


def test_heavier_weights_are_taken_more_often(spark):
    frame = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("size"),
                                       F.when(F.col("id") % 2 == 0, 1.0).otherwise(0.25).alias("w"))
    frame = frame.withColumn("key", mixing.key(F.col("w"), F.col("doc_id")))
    by = mixing.plan(frame, "source", "size", "key", "doc_id", share=0.2)
    taken = mixing.mix(frame, by, "source", "size", "key", "doc_id").where("copies > 0")
    heavy, light = taken.where("w = 1").count(), taken.where("w < 1").count()
    assert abs(heavy + light - 4000) <= 1 and heavy > 3 * light


def test_light_documents_crowd_no_bucket(spark, monkeypatch):
    """The rest ends among the large keys of light documents: few of them are put in order, and the cut is right."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    left, narrowed = [], mixing._narrowed

    def seen(near, edge):
        out = narrowed(near, edge)
        left.append((near.count(), out[0].groupBy("_source").count().agg(F.max("count")).first()[0]))
        return out

    monkeypatch.setattr(mixing, "_narrowed", seen)
    frame = spark.range(4000).select(F.greatest("id", F.lit(300)).alias("doc_id"), F.when(F.col("id") % 7 > 0, "s").alias("source"))
    frame = frame.withColumn("size", F.col("doc_id") % 9)
    frame = frame.withColumn("key", mixing.key(F.lit(0.1), F.col("doc_id")))
    for share in (0.9, 0.95, 0.999):
        by = mixing.plan(frame, "source", "size", "key", "doc_id", weights=(6, 1), share=share)
        got = {(r.source, r.doc_id): (r.copies, r.target, r.source_size) for r in mixing.mix(frame, by, "source", "size", "key", "doc_id").collect()}
        rows = [tuple(r) for r in frame.select("source", "key", "doc_id", "size").collect()]
        for name in ("s", None):
            total, want, cut = 0, {}, None
            mine = sorted(r[1:] for r in rows if r[0] == name)
            _, target, size = got[name, mine[0][1]]
            epochs = target // size
            for k, i, n in mine:
                want.setdefault(i, epochs + (total + n / 2 <= target - epochs * size))
                total += n
            assert {i: c for (s, i), (c, _, _) in got.items() if s == name} == want
    assert all(before > 50 >= after for before, after in left)

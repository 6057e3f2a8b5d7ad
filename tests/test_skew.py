"""A key with a third of all rows must not end up in one task."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vintara.operators import manifest as m
from vintara.operators.joins import lookup_join

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10kb",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def small_partitions(spark):
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skewed(spark, n=60_000):
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000)
    return spark.range(0, n, 1, 16).select(
        key.cast("string").alias("period"), F.lit("u").alias("url"), F.sha2(F.col("id").cast("string"), 256).alias("v"))


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left", "left_semi", "left_anti", "inner"])
def test_lookup_join_splits_a_hot_key(spark, small_partitions, how):
    left = skewed(spark)
    # an aggregate: already partitioned by the key
    right = left.where("period < '3'").groupBy("period", "url").agg(F.count("*").alias("n"))
    df = lookup_join(left, right, ["period", "url"], how)
    plan = final_plan(df)
    assert "skew=true" in plan
    plain = left.join(right, ["period", "url"], how)
    assert df.count() == plain.count()


def test_superseding_splits_an_entry_with_very_many_versions(spark, small_partitions):
    rows = skewed(spark).withColumn("version", F.monotonically_increasing_id().cast("int"))
    held = rows.select(*[
        (F.col(f.name) if f.name in ("period", "url", "version") else F.lit("active") if f.name == "status" else
         F.col("v") if f.name in ("sha256", "saved_path") else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in m.MANIFEST])
    entries = held.groupBy("period", "url").agg(F.max("version").alias("version")).select(*[
        (F.col(f.name) if f.name in ("period", "url", "version") else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in m.MANIFEST])
    out = m.apply_entries(held, entries, F.current_timestamp()).select("period", "status", "sha256")
    assert "skew=true" in final_plan(out)

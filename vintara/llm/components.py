"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintara.operators.joins import lookup_join
from vintara.session import release, settle


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node that has an edge.

    A round links every node's larger neighbours, then its smaller ones, to its smallest
    neighbour; only pairs of a node and one other are ever moved, so a node with very many
    neighbours is an aggregate and a join that skew handling splits, not a group. Rounds grow
    with the logarithm of the longest chain. Each is written to the shared folder and the one
    before it deleted. Self-links and links with a null end are left out.
    """
    now = settle(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                 .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct())
    state = _state(now)
    while state[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = lookup_join(both.where("b > a"), least, ["a"], "inner").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = lookup_join(large, least, ["a"], "inner")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").union(
            least.select("a", F.col("m").alias("b"))).distinct()
        after = settle(small)
        release(now)
        now, before, state = after, state, _state(after)
        if state == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())

"""Mixing sources to target weights by weighted sampling without replacement.

Every document gets an exponential key divided by its quality weight (Efraimidis and Spirakis):
in key order a source's documents are a weighted sample of any size. A source whose target is
e times its size and a rest is taken e times as a whole; the rest is the documents of smallest
keys whose sizes sum up to it.

No source is sorted: keys are counted into buckets, which are summed up per source, and only the
one bucket in which a source's rest ends is put in order. Light documents have large keys, which
crowd the last bucket: while the one where a rest ends has more than ``BUCKET_ROWS`` rows, its keys
are counted into finer parts, of which again one is left. Rows alike are one row there, so what is
put in order is bounded, also where one source has most rows; sums are pre-aggregated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vintara.llm.common import WORD, packed, unpacked
from vintara.operators.joins import lookup_join
from vintara.session import settle

#: Rows of all sources that fall into one bucket number on average.
BUCKET_ROWS = 20_000
#: Parts into which a bucket with more is cut.
PARTS = 1024


def words(text: Column) -> Column:
    """Number of words; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def quality(text: Column) -> Column:
    """A weight from 0.1 to 1 that falls with the share of symbol characters."""
    share = 1 - F.try_divide(F.length(F.translate(text, "#*$%&|<>!", "")), F.length(text))
    return F.coalesce(F.greatest(F.lit(0.1), 1 - 4 * share), F.lit(0.1))


def key(weight: Column, *identity: Column, seed: str = "mix") -> Column:
    """The same exponential key for the same values on every run."""
    named = F.concat_ws(":", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("")) for c in identity])
    drawn = F.conv(F.substring(F.md5(named), 1, 12), 16, 10).cast("double")
    return -F.ln((drawn + 0.5) / F.lit(2.0 ** 48)) / weight


def targets(rows: DataFrame, source: str, size: str, weights: Sequence[float] = (5, 2, 1),
            share: float = 1.0, limit: float = 3.0) -> DataFrame:
    """``source_size`` and ``target`` of each source, null being one of them.

    The weights repeat over the sources in code point order, null last. A target stops at
    ``limit`` times the source's size; what is above is dealt to the others by weight until
    none is above: every target is the lesser of its limit and one common level times its
    weight, and the level follows from the running sums in the order of limit by weight. There
    is one row per source here, few enough for one task.
    """
    every, last = W.orderBy(F.lit(0)), W.orderBy(F.col(source).asc_nulls_last())
    by = rows.groupBy(source).agg(F.sum(size).alias("source_size"))
    by = by.withColumn("_rank", F.row_number().over(last)).withColumns({
        "_weight": F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                ((F.col("_rank") - 1) % len(weights) + 1).cast("int")),
        "_limit": F.col("source_size") * F.lit(float(limit)),
        "_total": F.sum("source_size").over(every.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
        * F.lit(float(share))})
    order = W.orderBy(F.col("_limit") / F.col("_weight"), "_rank")
    by = by.withColumns({
        "_below": F.coalesce(F.sum("_limit").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)),
        "_open": F.sum("_weight").over(order.rowsBetween(0, W.unboundedFollowing))})
    by = by.withColumn("_level", (F.col("_total") - F.col("_below")) / F.col("_open"))
    by = by.withColumn("_level", F.first(
        F.when(F.col("_level") * F.col("_weight") <= F.col("_limit"), F.col("_level")), ignorenulls=True)
        .over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    least = F.least("_limit", F.col("_level") * F.col("_weight"))
    return by.select(source, "source_size", F.coalesce(least, F.col("_limit")).alias("target"))


def _order() -> Column:
    return F.struct("_key", "_id", "_size")


def _narrowed(near: DataFrame, edge: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows where the rest of each source ends, ``BUCKET_ROWS`` at most, and per source what is
    before them: ``_before``, the sum of sizes, and ``_low``, the last row of the bucket if there is one.

    ``near`` has a row, with its ``_times``, for all rows of a bucket that are alike.
    """
    edge = edge.select("_source", "_before", "_rest", F.lit(None).cast(near.select(_order().alias("o")).schema["o"].dataType).alias("_low"))
    while True:
        spans = settle(near.groupBy("_source").agg(F.count("*").alias("_rows"), F.min("_key").alias("_lo"), F.max("_key").alias("_hi")))
        large = (F.col("_rows") > BUCKET_ROWS) & (F.col("_lo") < F.col("_hi"))
        if spans.where(large).isEmpty():
            return near, edge
        part = F.least(F.floor((F.col("_key") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * PARTS), F.lit(PARTS - 1))
        rows = lookup_join(near, spans, ["_source"], "inner").withColumn("_part", F.when(large, part).otherwise(F.lit(0)))
        sums = rows.groupBy("_source", "_part").agg(F.sum(F.col("_size") * F.col("_times")).alias("_sum"), F.max(_order()).alias("_top"))
        earlier = W.partitionBy("_source").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
        ends = lookup_join(sums.withColumns({"_sums": F.coalesce(F.sum("_sum").over(earlier), F.lit(0)), "_tops": F.max("_top").over(earlier)}),
                           edge, ["_source"], "inner")
        ends = ends.select("_source", "_part", (F.col("_before") + F.col("_sums")).alias("_before"), "_rest", F.coalesce("_tops", "_low").alias("_low"))
        ends = settle(ends.where("_before <= _rest").groupBy("_source").agg(
            F.max_by(F.struct("_part", "_before", "_rest", "_low"), "_part").alias("_end")).select("_source", "_end.*"))
        near = settle(lookup_join(rows, ends.select("_source", "_part"), ["_source", "_part"], "left_semi").select(near.columns))
        edge = ends.drop("_part")


def plan(rows: DataFrame, source: str, size: str, key: str, doc_id: str, **options) -> DataFrame:
    """Per source: ``source_size``, ``target``, ``epochs`` and ``cut``, the last document of the
    rest in (key, id, size) order; null where the rest has none.

    The document at the end of the rest is taken if that brings the sum nearer to the target.
    """
    goals = targets(rows, source, size, **options).withColumns({
        "epochs": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))})
    goals = goals.withColumn("_rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    buckets = max(64, rows.count() // BUCKET_ROWS)
    slim = rows.select(F.struct(F.col(source)).alias("_source"), F.col(size).alias("_size"), F.col(key).alias("_key"),
                       F.coalesce(F.col(doc_id).cast("long"), F.lit(-2**63)).alias("_id"),
                       F.floor((1 - F.exp(-F.col(key))) * buckets).alias("_bucket"))
    goals = goals.withColumn("_source", F.struct(source))
    sums = slim.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_sum"))
    before = F.sum("_sum").over(W.partitionBy("_source").orderBy("_bucket")) - F.col("_sum")
    ends = lookup_join(sums.withColumn("_before", before), goals.select("_source", "_rest"), ["_source"], "inner")
    ends = ends.where("_before <= _rest").groupBy("_source").agg(
        F.max(F.struct("_bucket", "_before", "_rest")).alias("_end"))
    edge = settle(ends.select("_source", "_end.*"))
    near = lookup_join(slim, edge.select("_source", "_bucket"), ["_source", "_bucket"], "inner")
    near, last = _narrowed(settle(near.groupBy("_source", "_key", "_id", "_size").agg(F.count("*").alias("_times"))), edge)
    # of rows alike, the first one decides
    running = F.sum(F.col("_size") * F.col("_times")).over(W.partitionBy("_source").orderBy("_key", "_id", "_size")
                                                           .rowsBetween(W.unboundedPreceding, 0))
    found = lookup_join(near.withColumn("_run", running - F.col("_size") * F.col("_times")), last, ["_source"])
    chosen = F.col("_before") + F.col("_run") + F.col("_size") / 2 <= F.col("_rest")
    cuts = found.groupBy("_source").agg(F.coalesce(F.max(F.when(chosen, _order())), F.max("_low")).alias("cut"))
    return (goals.join(edge.select("_source", F.col("_bucket").alias("_last")), "_source", "left")
            .join(cuts, "_source", "left")
            .select("_source", "source_size", "target", "epochs", "cut", "_last", F.lit(buckets).alias("_buckets")))


def mix(rows: DataFrame, by: DataFrame, source: str, size: str, key: str, doc_id: str) -> DataFrame:
    """The rows with ``source_size``, ``target`` and ``copies``: how often the mix takes each.

    ``by`` is what ``plan`` gives. A document is in the rest if its bucket comes before the one
    where the rest ends, or up to the cut. Rows alike in key, id and size are taken alike; a
    null id is smaller than any other; empty documents count as any others.
    """
    found = lookup_join(rows.withColumn("_source", F.struct(source)), by, ["_source"], "left")
    here = F.floor((1 - F.exp(-F.col(key))) * F.col("_buckets"))
    mine = F.struct(F.col(key).alias("_key"), F.coalesce(F.col(doc_id).cast("long"), F.lit(-2**63)).alias("_id"),
                    F.col(size).alias("_size"))
    rest = (here < F.col("_last")) | (F.col("cut").isNotNull() & (here == F.col("_last")) & (mine <= F.col("cut")))
    return found.withColumn("copies", (F.col("epochs") + F.when(rest, 1).otherwise(0)).cast("int")).drop(
        "_source", "epochs", "cut", "_last", "_buckets")


def mix_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                  **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their own columns only."""
    sized = docs.select(packed(docs), F.col(doc_id).cast("long").alias("id"), F.col(source).alias("source"),
                        words(F.col(text)).alias("size"), key(quality(F.col(text)), F.col(doc_id), F.col(text)).alias("key"))
    by = settle(plan(settle(sized.drop("_row")), "source", "size", "key", "id", **options))
    taken = mix(sized, by, "source", "size", "key", "id").where("copies > 0")
    return unpacked(taken.select("_row", F.explode(F.sequence(F.lit(1), "copies"))), docs)


#: The mix in DuckDB's SQL, with whole sources in order.
ORACLE = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    -ln((('0x' || substr(md5(concat_ws(':', 'mix', coalesce(doc_id::VARCHAR, ''), coalesce(text, ''))), 1, 12))::BIGINT
         + 0.5::DOUBLE) / 281474976710656::DOUBLE)
      / coalesce(greatest(0.1::DOUBLE, 1 - 4 * (1 - length(translate(text, '#*$%&|<>!', ''))::DOUBLE / nullif(length(text), 0))),
                 0.1::DOUBLE) AS key
  FROM documents),
by0 AS (SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sized GROUP BY source),
by1 AS (SELECT *, [5, 2, 1][(rank - 1) % 3 + 1]::DOUBLE AS weight, source_size * 3.0::DOUBLE AS lim,
    (sum(source_size) OVER ())::BIGINT::DOUBLE AS total FROM by0),
by2 AS (SELECT *, (total - coalesce(sum(lim) OVER (ORDER BY lim / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY lim / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM by1),
by3 AS (SELECT source, source_size, least(lim, weight * (SELECT arg_min(lev, (lim / weight, rank)) FROM by2
    WHERE lev * weight <= lim)) AS target FROM by2),
by4 AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM by3),
ranked AS (SELECT s.*, b.source_size, b.target, b.epochs, target - epochs * source_size AS rest,
    sum(size) OVER (PARTITION BY s.source ORDER BY key, s.doc_id NULLS FIRST, size
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::DOUBLE - size / 2.0::DOUBLE AS until,
    dense_rank() OVER (PARTITION BY s.source ORDER BY key, s.doc_id NULLS FIRST, size) AS place
  FROM sized s JOIN by4 b ON s.source IS NOT DISTINCT FROM b.source),
cut AS (SELECT *, max(CASE WHEN until <= rest THEN place END) OVER (PARTITION BY source) AS last FROM ranked)
SELECT doc_id, size, source_size, target,
  ((epochs + CASE WHEN place <= last THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM cut
"""

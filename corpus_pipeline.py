"""The pipeline over documents: language ID, line dedup, SimHash near-dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a frame; its rows are written and read again as
the next one's documents. All but the last return the columns of the documents. Every stage works
on all rows the one before has kept.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vintara.llm import bpe, language, lines, mixing, simhash
from vintara.llm.common import packed, table, tuned, unpacked
from vintara.operators.joins import lookup_join
from vintara.session import release, settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _keyed(docs: DataFrame) -> DataFrame:
    """``_row`` beside what a decision is joined by: rows alike in id and text are decided alike."""
    return docs.select(packed(docs), F.struct(F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
                       .alias("_key"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was identified, with that as ``lang``."""
    model = language.fit(docs)
    rows = docs.withColumn("_h", F.xxhash64(F.coalesce("text", F.lit(""))))
    found = language.identify(rows, model, declared="lang", host="source", keep=("doc_id", "_h"))
    lost = found.where("NOT kept").select(F.struct(F.col("doc_id").alias("id"), F.col("_h").alias("h")).alias("_key")).distinct()
    return unpacked(lookup_join(_keyed(docs), lost, ["_key"], "left_anti"), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier one has or nearly has; those left empty go."""
    out = lines.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHashes are linked: the one with the smallest id."""
    stays = simhash.first_of_groups(docs, shingle=4, distance=4).select(F.struct(F.col("doc_id").alias("id"), "h").alias("_key"))
    kept = lookup_join(_keyed(docs), stays, ["_key"], "left_semi")
    return unpacked(kept.groupBy("_key").agg(F.min("_row").alias("_row")), docs)  # of repeated rows one


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids, sources and texts with their token ids, and whether these decode to the text."""
    vocabulary = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    out = bpe.encode_table(tuned(docs).select("doc_id", "source", "text"), vocabulary, ids="ids", decoded="_back")
    return out.select("doc_id", "source", "text", F.size("ids").cast("long").alias("n_tokens"), "ids",
                      (F.col("_back") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
        if before is not None:
            release(before)  # nothing reads the stage before any more
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)


#: Expectation over trigrams, fingerprints and token ids has no SQL form; the stages are tested
#: against brute-force versions.
ORACLE_SQL = None

"""The operators over their whole tables, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from vintara.llm import bpe, chat, embeddings, importance, language, licenses, lines, mixing, packing, quality, repair, simhash, warc
from vintara.llm.common import table
from vintara.session import settle

Build = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def query(build: Build) -> Build:
    """Register a query under its function name."""
    QUERIES[build.__name__] = build
    return build


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode_table(docs, vocabulary, decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.pages_round_trip(table(spark, sf_dir, "pages"))


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, text = table(spark, sf_dir, "documents"), F.col("text")
    sized = settle(docs.select("doc_id", "source", mixing.words(text).alias("size"),
                               mixing.key(mixing.quality(text), F.col("doc_id"), text).alias("key")))
    by = settle(mixing.plan(sized, "source", "size", "key", "doc_id"))
    return mixing.mix(sized, by, "source", "size", "key", "doc_id").select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLES["op3_mixing"] = mixing.ORACLE


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.removed_by_row(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


@query
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents (declared language, source as host) and all pages (markup, address)."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = language.fit(docs)
    none = F.lit(None)
    rows = docs.select("doc_id", none.cast("long").alias("page_id"), "text", F.col("lang").alias("declared"),
                       F.col("source").alias("host"), none.cast("string").alias("suffix"))
    html, host = F.col("html"), language.host(F.col("url"))
    rows = rows.unionByName(pages.select(
        none.cast("long").alias("doc_id"), "page_id", language.visible(html).alias("text"),
        language.declared_in(html).alias("declared"), host.alias("host"), language.suffix(host).alias("suffix")))
    return language.identify(rows, model, declared="declared", suffix="suffix", host="host",
                             keep=("doc_id", "page_id", "declared", "host"))


@query
def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(F.lit(-1).cast("long"), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"),
                                 F.lit(said))
    return chat.digests(chat.format_turns(turns.union(more)))


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability")


@query
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", licenses.scan(F.col("text")).alias("found"))
    return found.select("doc_id", *[f"found.{c}" for c in (
        "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")])


@query
def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.95)


@query
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damaged(table(spark, sf_dir, "conversations")), copies="copies")


@query
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
                         "window", "step_group")


@query
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance.resample(docs, target, percent=5, min_words=20, seed=42).select(
        "doc_id", "n_features", "weight", "score", "rank", "n_words")


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)

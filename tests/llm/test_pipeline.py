"""The pipeline's stages against plain versions of what they decide."""

from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_lines import _want as removed_lines
from test_simhash import _print, _roots
from tokenizers import Tokenizer

import corpus_pipeline as p
from vintara.llm import language, mixing, queries

SF = "/root/testdata/sf0.001"
DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returns, applied to what the one before has kept."""
    from vintara.session import settle

    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in p.STAGES:
        docs = settle(stage(spark, docs, SF))
        out[name] = docs
    return out


def _rows(frame, *columns):
    return [tuple(r) for r in frame.select(*columns).collect()]


def test_columns(stages):
    for name, _ in p.STAGES[:-1]:
        assert stages[name].columns == DOCUMENTS


def test_language_keeps_what_is_identified(spark, stages):
    docs = stages["documents"]
    found = language.identify(docs, language.fit(docs), declared="lang", host="source", keep=("doc_id",))
    kept = {r.doc_id for r in found.where("kept").collect()}
    assert {k for k, in _rows(stages["language_id"], "doc_id")} == kept and len(kept) >= 0.99 * docs.count()


def test_lines(stages):
    before = _rows(stages["language_id"], "doc_id", "text")
    gone = removed_lines(before)
    want = []
    for key, text in before:
        lines = (text or "").split("\n")
        left = [x for i, x in enumerate(lines) if i not in gone.get((key, text), [])]
        if any(x.strip(" \t\n\x0b\x0c\r") for x in left) or not gone.get((key, text)):
            want.append((key, "\n".join(left)))
    assert Counter(_rows(stages["line_dedup"], "doc_id", "text")) == Counter(want)
    assert all(len(t) == n for t, n in _rows(stages["line_dedup"], "text", "n_chars"))


def test_one_document_of_each_group_stays(stages):
    before = sorted(_rows(stages["line_dedup"], "doc_id", "text"))
    roots = _roots([(k, _print(t)) for k, t in before], lambda a, b: (a ^ b).bit_count() <= 4)
    assert sorted(_rows(stages["near_dedup"], "doc_id", "text")) == [b for b, r in zip(before, roots) if b[0] == r]


def test_mix(spark, stages):
    docs = stages["near_dedup"]
    counted = Counter(k for k, in _rows(stages["mix_sources"], "doc_id"))
    sized = docs.select("doc_id", "source", mixing.words(F.col("text")).alias("size"),
                        mixing.key(mixing.quality(F.col("text")), F.col("doc_id"), F.col("text")).alias("key"))
    by = mixing.plan(sized, "source", "size", "key", "doc_id")
    copies = {r.doc_id: r.copies for r in mixing.mix(sized, by, "source", "size", "key", "doc_id").collect()}
    assert counted == Counter({k: n for k, n in copies.items() if n}) and max(counted.values()) <= 4


def test_encoding(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text, ids, n, same in _rows(stages["encode"], "text", "ids", "n_tokens", "round_trip"):
        assert ids == library.encode(text, add_special_tokens=False).ids and n == len(ids) and same


def test_run_equals_the_stages(spark, stages):
    columns = ["doc_id", "n_tokens"]
    assert Counter(_rows(queries.pipeline(spark, SF), *columns)) == Counter(_rows(stages["encode"], *columns))


def test_rows_without_ids_and_repeated_ones(spark):
    text = "the house by the river was old and the door of it was never open to the people of the town"
    other = "le chat de la maison est sur la table et il regarde les oiseaux dans le jardin de la ville"
    rows = [(None, text), (None, other), (5, "un " + other), (5, "der hund und die katze sind in dem haus mit dem garten an der see"), (7, text), (7, text)]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(_rows(p.near_dedup(spark, docs, SF), "doc_id", "text"), key=str)
    assert [k for k, _ in kept].count(7) == 1 and (7, text) in kept and (None, text) not in kept
    assert len({t for _, t in kept}) == len(kept) >= 3

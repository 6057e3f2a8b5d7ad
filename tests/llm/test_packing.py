from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vintara.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, encoding="utf-8") as file:
        return packing.Encoder(file.read(), 2)


def _texts(encoder, texts):
    ids, ends = encoder.texts(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip([0, *ends.tolist()], ends.tolist())]


ODD = ["", None, " ", "\n\t ", "Hello  World\nIt's  ", "  lead", "a b c\x1cd\x85e", "é ́x ́", "IİΣ Σ",
       "<|endoftext|> x<|startoftext|>y < |endoftext|>", "日本語 テキスト", "1234 5.6,7", "don't we'll '", "가 ᆨ",
       "x" * 3000, "word " * 5000, "\x00\x01 \x7f", "🙂🙂 👩‍👩", "a\r\nb\x0bc\x0cd", "ÀÉÎÞß×÷ÿ ÉTÉ. été", "J̌ ǰ J̌", "<|ENDOFTEXT|> <|x", "it's IT'S 'tis ('the rock'n'roll",
       "é́ Á", "a1b2.c3'd'", "Ã\u0080 É…. Ö—ö", "I'm'll''s"]


def test_texts_are_encoded_as_by_the_library(encoder, library):
    assert _texts(encoder, ODD) == [library(t) for t in ODD]
    assert _texts(encoder, ODD[::-1]) == [library(t) for t in ODD[::-1]]  # from the cache
    assert _texts(encoder, []) == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t.'stxSTJ<|>́̈̌AéÉÞ×1-"))), max_size=6))
def test_any_text_is_encoded_as_by_the_library(texts):
    tokenizer = Tokenizer.from_file(PATH) if not hasattr(test_any_text_is_encoded_as_by_the_library, "own") else None
    if tokenizer:
        with open(PATH, encoding="utf-8") as file:
            test_any_text_is_encoded_as_by_the_library.own = tokenizer, packing.Encoder(file.read(), 2)
    tokenizer, encoder = test_any_text_is_encoded_as_by_the_library.own
    assert _texts(encoder, texts) == [tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts]


def test_cache_that_starts_anew(encoder, library, monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 3)
    monkeypatch.setattr(packing, "GROUP", 5)
    texts = [f"number {i % 7} of many" for i in range(40)]
    assert _texts(encoder, texts) == [library(t) for t in texts]


def _check(pieces: list, docs: dict, tiers, step: int) -> int:
    """Whole documents, gapless sequences within a window, full step groups; the tokens of padding."""
    by_doc, by_sequence, groups = defaultdict(list), defaultdict(list), defaultdict(dict)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
        groups[p["step_group"]][p["sequence_id"]] = p["window"]
    assert by_doc.keys() == docs.keys()
    for doc, parts in by_doc.items():
        parts.sort(key=lambda p: p["start"])
        assert [p["start"] for p in parts] == [sum(q["length"] for q in parts[:i]) for i in range(len(parts))]
        assert b"".join(p["ids"] for p in parts) == np.array(docs[doc], "<u4").tobytes()
        assert {p["doc_tokens"] for p in parts} == {len(docs[doc])}
    padding = 0
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in parts] == [sum(q["length"] for q in parts[:i]) for i in range(len(parts))]
        size = sum(p["length"] for p in parts)
        assert 0 < size <= max(tiers) and len({p["window"] for p in parts}) == len({p["step_group"] for p in parts}) == 1
        assert size == parts[0]["window"]
        padding += 0 if size & (size - 1) == 0 else max(tiers) - size
    return padding


def _packed(docs: dict, tiers=packing.TIERS, step=packing.STEP, pool=1 << 15) -> list[dict]:
    packer = packing.Packer(3, tiers, step)
    out = []
    for doc, ids in docs.items():
        packer.add(doc, np.array(ids, "<u4"))
        if packer.fresh >= pool:
            packer.pack()
            out += packer.batch().to_pylist()
    packer.finish()
    return out + packer.batch().to_pylist()


@pytest.mark.parametrize("tiers, step", [(packing.TIERS, packing.STEP), ((8, 64), 128), ((16,), 16), ((4096,), 4096)])
@pytest.mark.parametrize("kind", ["mixed", "short", "long", "equal", "one", "none"])
def test_windows(tiers, step, kind):
    draw = np.random.default_rng(5)
    sizes = {"mixed": draw.lognormal(5, 1.5, 700).astype(int) + 1, "short": draw.integers(1, 9, 900), "long": [70_001, 4096, 8192],
             "equal": [3000] * 60, "one": [1], "none": []}[kind]
    docs = {i: draw.integers(0, 49_408, n).tolist() for i, n in enumerate(sizes)}
    pieces = _packed(docs, tiers, step)
    assert _check(pieces, docs, tiers, step) == 0
    groups: dict = defaultdict(dict)
    for p in pieces:
        groups[p["step_group"]][p["sequence_id"]] = p["window"]
    sums = [sum(g.values()) for _, g in sorted(groups.items())]
    assert all(s == step for s in sums[:-1]) and all(s <= step for s in sums)
    if kind == "mixed" and tiers == packing.TIERS:
        assert {p["window"] for p in pieces} >= {256, 512, 1024, 4096} and len(pieces) < 2.2 * len(docs)


def test_groups_have_similar_cost():
    draw = np.random.default_rng(6)
    pieces = _packed({i: [1] * int(n) for i, n in enumerate(draw.lognormal(6, 1.2, 3000))}, pool=packing.POOL)
    cost, group = defaultdict(int), {}
    for p in pieces:
        cost[p["sequence_id"]] += p["length"] ** 2
        group[p["sequence_id"]] = p["window"], p["step_group"]
    spread = defaultdict(list)
    for s, c in cost.items():
        spread[group[s]].append(c)
    top = [np.std(c) for (w, _), c in spread.items() if w == 4096 and len(c) == 16]
    assert np.mean(top) < 0.5 * np.std([c for (w, _), cs in spread.items() if w == 4096 for c in cs])


def test_query(spark, library):
    sf_dir = "/root/testdata/sf0.01"
    docs = {r.doc_id: library(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    found = [r.asDict() for r in queries.op12_packing(spark, sf_dir).collect()]
    for p in found:
        p["ids"] = np.array(docs[p["doc_id"]][p["start"]:p["start"] + p["length"]], "<u4").tobytes()
        assert zlib.crc32(p["ids"]) == p["ids_crc32"]
    assert _check(found, docs, packing.TIERS, packing.STEP) == 0


def test_odd_rows(frame, library):
    rows = [(1, "one two"), (1, "one two"), (None, "no id"), (None, None), (2, ""), (3, "long text " * 60_000), (4, None)]
    docs = frame(rows, "doc_id long, text string").selectExpr("*", "1 AS start", "2 AS ids", "3 AS window", "4 AS sequence_id")
    found = packing.pack(docs, PATH).repartition(1).collect()
    assert sum(p.length for p in found) == sum(len(library(t)) for _, t in rows)
    assert sorted(str(p.doc_id) for p in found if p.start == 0) == sorted(str(i) for i, _ in rows)
    assert b"".join(p.ids for p in sorted((p for p in found if p.doc_id == 3), key=lambda p: p.start)) == np.array(
        library(rows[5][1]), "<u4").tobytes()
    assert packing.pack(docs.limit(0), PATH).count() == 0

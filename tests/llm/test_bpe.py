from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vintara.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load(PATH)


def _ids(vocabulary, texts):
    return [np.frombuffer(i, "<i4").tolist() for i in vocabulary.encode_batch(texts)]


def test_random_texts_equal_the_library(library, vocabulary):
    pick = random.Random(5)
    parts = [" ", "  ", "\n", "\t", " ", "a", "b", "the", "ing", "é", "ß", "1", "23", "'s", "'", "don't", ".", "...",
             "<|endoftext|>", "<|endof", "中文", "🙂", "\x1c", " ", "\r\n", "x" * 70, "ab" * 60]
    texts = ["".join(pick.choices(parts, k=pick.randint(0, 40))) for _ in range(4000)]
    got = _ids(vocabulary, texts)
    for text, ids in zip(texts, got):
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert vocabulary.decode(np.array(ids, dtype=int)).decode() == library.decode(
            ids, skip_special_tokens=False) == text


def test_every_code_point(library, vocabulary):
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 2000):
        text = "".join(f"a{c}b 1{c}2 .{c}. {c} " for c in points[at:at + 2000])
        want = library.pre_tokenizer.pre_tokenize_str(text)
        assert vocabulary.pieces(text) == [text[s:e] for _, (s, e) in want], at


def test_long_piece(library, vocabulary):
    text = "a" * 50_000 + "".join(random.Random(1).choices("abcde", k=20_000))
    assert _ids(vocabulary, [text])[0] == library.encode(text, add_special_tokens=False).ids


def test_forest_equals_tree(vocabulary):
    pick = random.Random(2)
    pieces = [bytes(pick.choices(b"abcdeinrst \xc3\xa9", k=pick.randint(1, bpe.LONG))) for _ in range(500)]
    for piece, ids in zip(pieces, vocabulary.merge_many(pieces)):
        assert np.frombuffer(ids, "<i4").tolist() == vocabulary.merge_long(piece)


def test_small_cache(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 10)
    small = bpe.load(PATH)
    texts = [f"word{i} other{i % 7}\n" * 5 for i in range(60)]
    assert _ids(small, texts) == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_odd_rows(spark, vocabulary):
    rows = [(1, None, "x"), (2, "", "y"), (2, "", "y"), (None, "hello  world", None), (3, "<|endoftext|>", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.encode_table(docs, vocabulary, decoded="back").collect()
    assert sorted((r.doc_id or 0, r.text, len(r.ids), r.back) for r in out if r.text is not None) == [
        (0, "hello  world", 3, "hello  world"), (2, "", 0, ""), (2, "", 0, ""), (3, "<|endoftext|>", 1, "<|endoftext|>")]
    assert [(len(r.ids), r.back) for r in out if r.text is None] == [(0, "")]
    assert bpe.encode_table(docs.limit(0), vocabulary).count() == 0


def test_query(spark, library):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op1_bpe(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for row in got:
        ids = library.encode(texts[row.doc_id], add_special_tokens=False).ids
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_a_vocabulary_that_was_sent_is_the_same():
    import pickle

    own = bpe.load(public_tokenizers.path("byte_bpe_50k.json"))
    sent = pickle.loads(pickle.dumps(own))
    assert sent.tokens.tolist() == own.tokens.tolist() and sent.merges == own.merges and sent.special == own.special
    texts = ["plain words", "x" * 500 + " <|endoftext|> é🙂", ""]
    assert sent.encode_batch(texts) == own.encode_batch(texts)

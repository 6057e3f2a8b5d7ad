from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from vintara.llm import quality, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _base(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    windows: dict[tuple, list[int]] = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    repeated = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated),
            n < 20 or 100 * len(repeated) > 30 * n)


def _row(r) -> tuple:
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op8_quality(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert _row(r) == _base(texts[r.doc_id]), r.doc_id
        assert not (r.base_failed and r.kept)


def test_verdict_agrees_with_the_labels(spark):
    """Labels are not used in fitting."""
    sf_dir = "/root/testdata/sf0.01"
    got = queries.op8_quality(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("NOT base_failed")
    good, bad = got.where("quality = 1"), got.where("quality = 0")
    assert good.where("kept").count() >= 0.995 * good.count()
    assert bad.where("NOT kept").count() >= 0.9 * bad.count()


def test_random_texts(spark):
    pick = random.Random(6)
    parts = ["a", "b", "a b a b a b a b", "é🙂", "#", "|", "\n", "\n\n", "\t", " ", "\x0b", "\x85", "x y"]
    texts = [" ".join(pick.choices(parts, k=pick.randint(0, 40))) for _ in range(400)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.judged(frame).collect():
        assert _row(r) == _base(texts[r.doc_id]), repr(texts[r.doc_id])


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (2, ""), (None, "x " * 30), (3, long), (4, f"{long} {long}")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("x")).withColumn("kept", F.lit(1))
    got = sorted(((r.doc_id or 0, *_row(r)) for r in quality.judged(frame).collect()))
    assert got == sorted((k or 0, *_base(t)) for k, t in rows)
    assert quality.judged(frame.limit(0)).count() == 0


def test_em_finds_the_accuracies():
    pick = random.Random(1)
    chances = {f"r{i}": ((0.02, 0.97, 0.01), (0.5, 0.49, 0.01)) for i in range(5)} | {"p": ((0.01, 0.1, 0.89), (0.02, 0.9, 0.08))}
    patterns: dict[tuple, int] = {}
    for _ in range(20_000):
        good = pick.random() < 0.7
        votes = tuple(pick.choices((0, -1, 1), by[0 if good else 1])[0] for by in chances.values())
        patterns[votes] = patterns.get(votes, 0) + 1
    model = quality.fit([dict(zip(chances, v)) | {"n": n} for v, n in patterns.items()], list(chances))
    assert model.good == pytest.approx(0.7, abs=0.05)
    assert model.rules["r0"][False][0] == pytest.approx(0.5, abs=0.05)
    assert model.rules["r0"][True][0] == pytest.approx(0.02, abs=0.02)


def test_posterior_column_equals_log_odds(spark):
    model = quality.fit([{n: (i + j) % 3 - 1 for j, n in enumerate(quality.votes())} | {"n": 5 + i} for i in range(6)], list(quality.votes()))
    rows = [{n: (i * j) % 3 - 1 for j, n in enumerate(quality.votes())} for i in range(4)]
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{n} int" for n in rows[0]))
    import math
    got = [r.p for r in frame.select(model.posterior().alias("p")).collect()]
    assert got == pytest.approx([1 / (1 + math.exp(-model.log_odds(r))) for r in rows])


def test_main_path_is_native(spark):
    plan = queries.op8_quality(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

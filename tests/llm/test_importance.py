from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from vintara.llm import importance, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _buckets(text: str | None) -> tuple[list[int], int]:
    words = WORD.findall((text or "").translate(LOWER))
    runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return [zlib.crc32(r.encode()) % 10000 for r in runs], len(words)


def _want(docs: list[tuple], target: list[str | None], percent: int = 5, least: int = 20) -> list[tuple]:
    found = [(i, *_buckets(t)) for i, t in docs]
    s, t = Counter(b for _, bs, _ in found for b in bs), Counter(b for x in target for b in _buckets(x)[0])
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in s}
    rows = []
    for i, bs, n in found:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in bs)
        rows.append((i, n, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], -2**63 if r[0] is None else r[0]))
    rank: dict = {}
    for place, r in enumerate(fit[:percent * len(fit) // 100], 1):
        rank.setdefault(r, []).append(place)
    return [(r[0], *r[2:], rank[r].pop() if rank.get(r) else None) for r in rows]


def _got(frame) -> list[tuple]:
    return [tuple(r) for r in frame.select("doc_id", "n_features", "weight", "score", "rank").collect()]


def _sorted(rows: list[tuple]) -> list[tuple]:
    return sorted(rows, key=str)


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text").collect()]
    got = _got(queries.op13_importance(spark, sf_dir))
    assert _sorted(got) == _sorted(_want(docs, target))
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 1 + 5 * sum(_buckets(t)[1] >= 20 for _, t in docs) // 100))


@pytest.mark.parametrize("slice_bytes", [16, 100, 1 << 22])
def test_features_of_odd_texts(monkeypatch, slice_bytes):
    monkeypatch.setattr(importance, "SLICE", slice_bytes)
    texts = ["", None, "One", "one two", "ONE Two three", "ß-é é  Ünïcode 日本語 x", "a" * 70 + " b " + "c" * 5000 + " d", "  . !",
             "x" * 64, "y" * 65 + "Y", "end", "start of a text that goes on and on over several slices " * 9, "\x00a\x7fb`c{d/e:f"]
    rows = [Counter() for _ in texts]
    for bucket, row, _ in importance.features(pa.array(texts)):
        for b, r in zip(bucket.tolist(), row.tolist()):
            rows[r][b] += 1
    assert rows == [Counter(_buckets(t)[0]) for t in texts]
    assert list(importance.features(pa.array([], pa.string()))) == []


def test_registers_shift_by_any_length():
    crc = importance.Crc()
    sizes = np.array([0, 1, 3, 63, 64, 65, 66, 1000, 70_001])
    data = [b"q" * int(n) for n in sizes]
    flat, at = np.frombuffer(b"".join(data), np.uint8), np.cumsum(sizes) - sizes
    assert crc.finished(crc.words(flat, at, sizes), sizes).tolist() == [zlib.crc32(d) for d in data]


def test_ties_nulls_and_repeated_rows(spark, frame):
    long = "alpha beta gamma delta " * 6
    rows = [(i % 40, long) for i in range(200)] + [(None, long), (7, None), (8, ""), (9, "few words"), (10, "Z " * 400_000)]
    docs = frame(rows, "doc_id long, text string").selectExpr("*", "1 AS _id", "2 AS rank", "3 AS score", "4 AS bucket")
    target = frame([("alpha beta",), (None,)], "text string")
    for percent in (0, 5, 37, 100):
        assert _sorted(_got(importance.resample(docs, target, percent=percent))) == _sorted(
            _want(rows, ["alpha beta", None], percent))
    assert _got(importance.resample(docs.limit(0), target)) == []
    assert len(_got(importance.resample(docs, target.limit(0)))) == len(rows)


def test_cutoff_over_the_whole_range_of_numbers(frame):
    scores = [-2**62, -5, 0, 0, 0, 3, 2**62, 2**62]
    rows = [(s, i) for s, i in zip(scores, [4, 2**63 - 1, -2**63, 7, 2**63 - 1, 1, -9, -9])]
    scored = frame(rows, "score long, _id long")
    order = sorted(rows, key=lambda r: (-r[0], r[1]))
    assert [importance.cutoff(scored, n) for n in range(1, 9)] == order

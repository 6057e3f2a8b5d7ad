from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from vintara.llm import queries, simhash
from vintara.llm.components import components


def _print(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in joined]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def _roots(items: list[tuple[int, int]], near) -> list[int]:
    """Smallest id reachable, by comparing all with all."""
    up = list(range(len(items)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(items)):
        for j in range(i):
            if near(items[i][1], items[j][1]):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    least: dict[int, int] = {}
    for i, (key, _) in enumerate(items):
        least[top(i)] = min(least.get(top(i), key), key)
    return [least[top(i)] for i in range(len(items))]


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = [(d.doc_id, _print(d.text)) for d in docs]
    roots = _roots(items, lambda a, b: (a ^ b).bit_count() <= 4)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op4_simhash(spark, sf_dir).collect()}
    assert got == {k: (f"{v:016x}", r) for (k, v), r in zip(items, roots)}


@pytest.mark.parametrize("cell,hot", [(8, 100), (8, 0), (4096, 100)])
def test_links_connect_what_brute_force_connects(spark, cell, hot, monkeypatch):
    monkeypatch.setattr(simhash, "HOT", hot)
    monkeypatch.setattr(simhash.dealt, "__defaults__", (cell,))
    pick = random.Random(3)
    values = {0, 2**64 - 1}
    for _ in range(25):
        seed = pick.getrandbits(64)
        values.add(seed)
        for _ in range(12):
            values.add(seed ^ sum(1 << b for b in pick.sample(range(64), pick.randint(1, 7))))
    items = [(v - 2**64 if v >= 2**63 else v, v) for v in sorted(values)]
    roots = _roots(items, lambda a, b: (a ^ b).bit_count() <= 4)
    frame = spark.createDataFrame([(k,) for k, _ in items], "fp long")
    got = {r.node: r.root for r in components(simhash.links(frame)).collect()}
    assert {k: got.get(k, k) for k, _ in items} == {k: r for (k, _), r in zip(items, roots)}


def test_every_near_pair_shares_an_anchor():
    """The covering: a value's home in some run is among the anchors of every value near it."""
    pick = random.Random(4)
    tables = [(first, width, *simhash.flips(width, 4, 2)) for first, width in simhash.runs(3)]

    def at(v, table):
        first, width, rows, by = table
        value = v >> first & ((1 << width) - 1)
        s = sum(((value & r).bit_count() & 1) << j for j, r in enumerate(rows))
        return [value ^ m for m in by[s]]

    for _ in range(2000):
        v = pick.getrandbits(64)
        w = v ^ sum(1 << b for b in pick.sample(range(64), 4))
        assert any(at(v, t)[0] in at(w, t) for t in tables)


def test_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(100)]
    star = [(1000, 1001 + i) for i in range(500)]
    frame = spark.createDataFrame(chain + star + [(5, 5), (None, 3), (7, 6)], "a long, b long")
    got = {r.node: r.root for r in components(frame).collect()}
    assert got == {i: 0 for i in range(101)} | {i: 1000 for i in range(1000, 1501)}
    assert components(frame.limit(0)).count() == 0


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, " \t"), (5, "One two"), (6, "one TWO"), (7, "x " * 50_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x")).withColumn("root", F.lit(1))
    got = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(frame).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (2, 1), (2, 1), (None, 1), (5, 5), (6, 5), (7, 7)], key=str)
    assert simhash.near_duplicates(frame.limit(0)).count() == 0


def test_forest_in_small_steps(monkeypatch):
    monkeypatch.setattr(simhash, "_PAIRS", 3)
    label = simhash.cell_forest(np.array([0, 0, 3]), np.array([3, 3, 2]), np.array([0, 1, 4]), lambda i, j: i != j)
    assert label.tolist() == [0, 0, 0, 3, 3]

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintara.llm import embeddings, queries, simhash

SCHEMA = "vec_id long, embedding array<float>"


def _want(rows: list[tuple], threshold: float = 0.95) -> list[tuple]:
    good = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    links = [0] * len(rows)
    unit = {i: np.array(rows[i][1], float) / np.linalg.norm(np.array(rows[i][1], float)) for i in good}
    for a in good:
        for b in good:
            if a != b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links[a] += 1
                up[max(top(a), top(b))] = min(top(a), top(b))
    least: dict = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[top(i)] = min(least.get(top(i), key), key)
    return sorted([(k, links[i], least.get(top(i)), k == least.get(top(i))) for i, (k, _) in enumerate(rows)], key=str)


def _got(frame) -> list[tuple]:
    return sorted([(r.vec_id, r.n_links, r.component_id, r.kept) for r in frame.collect()], key=str)


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    assert _got(queries.op10_embeddings(spark, sf_dir)) == _want(rows)


def _cluster(d: int, groups: int, size: int, noise: float) -> list[tuple]:
    draw = np.random.default_rng(5)
    rows = []
    for _ in range(groups):
        centre = draw.standard_normal(d)
        rows += [centre + noise * draw.standard_normal(d) for _ in range(size)]
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


@pytest.mark.parametrize("d,cell", [(64, 4096), (64, 40), (3, 4096)])
def test_groups_at_the_threshold(spark, d, cell, monkeypatch):
    """Noise puts most pairs of a group around the threshold; the ones above are all found."""
    monkeypatch.setattr(simhash.dealt, "__defaults__", (cell,))
    rows = _cluster(d, 12, 40, 0.19)
    rows += [(1000 + i, rows[0][1]) for i in range(30)]
    random.Random(1).shuffle(rows)
    assert _got(embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA), miss=1e-7)) == _want(rows)


def test_recall_of_the_default(spark):
    rows = _cluster(64, 60, 20, 0.2)
    got = _got(embeddings.near_duplicates(spark.createDataFrame(rows, SCHEMA)))
    want = _want(rows)
    assert sum(r[1] for r in got) >= 0.999 * sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(sorted(got), sorted(want)))


def test_odd_rows(spark):
    v = [0.5] * 8
    rows = [(1, v), (2, v), (2, v), (None, v), (3, None), (4, []), (5, [0.0] * 8), (6, [None] + v[1:]), (7, [math.nan] + v[1:]),
            (8, [math.inf] + v[1:]), (9, [-0.5] * 8), (10, [1e30] * 8), (11, [1e-30] * 8), (12, v[:4]), (None, [0.0]), (None, [1.0, -1.0])]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("n", F.lit("x")).withColumn("id", F.lit(1))
    got = _got(embeddings.near_duplicates(frame))
    want = [(k, n, c, k == c) for k, n, c, _ in _want(rows)]
    assert got == sorted(want, key=str)
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    draw = np.random.default_rng(1)
    o, q = draw.standard_normal((2, 64))
    o, q = o / np.linalg.norm(o), q / np.linalg.norm(q)
    guesses, bounds = [], []
    for seed in range(1500):
        turn = embeddings.rotation(64, seed)
        bits, factor = embeddings.codes(o[None], turn)
        signs = np.unpackbits(bits, axis=1).astype(float)[0] * 2 - 1
        guesses.append(signs @ (turn @ q) / 8 / factor[0])
        bounds.append(embeddings.error(factor, 64, 3.0)[0])
    off = np.array(guesses) - o @ q
    assert abs(off.mean()) < 4 * off.std() / math.sqrt(len(off))
    assert (np.abs(off) > np.array(bounds)).mean() < 0.01

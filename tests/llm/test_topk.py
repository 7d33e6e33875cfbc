"""Exact top-k against brute force."""

import math
import random

import numpy as np
import pytest

from fleetzone.llm import topk

SCHEMA = "label int, embedding array<float>, vec_id long, score string"


def brute(rows, k, every, scale=1024):
    fine = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for _, v, i, _ in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in fine:
        if q % every:
            continue
        s = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in fine if i != q and len(b) == len(a)))[:k]
        out |= {(q, n + 1, i, -x) for n, (x, i) in enumerate(s)}
    return out


def rows_of(n, dims, seed, values=None):
    rnd = random.Random(seed)
    pick = (lambda: rnd.choice(values)) if values else (lambda: rnd.gauss(0, 0.2))
    return [(0, [pick() for _ in range(dims)], i, "x") for i in range(n)]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "GROUP_ROWS", 150)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 40)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 9)
    for rows in (rows_of(400, 16, 1), rows_of(300, 4, 2, [0.0, 0.5, -0.5]), rows_of(120, 3, 3, [0.25])):
        df = spark.createDataFrame(rows, SCHEMA)
        got = {tuple(r) for r in topk.top_k(df, k=5, every=10).collect()}
        assert got == brute(rows, 5, 10)


def test_bad_vectors_few_rows_and_repeats(spark):
    rows = [(0, [1.0, 2.0], 0, "a"), (0, [1.0, None], 1, "a"), (0, None, 2, "a"), (0, [float("nan"), 1.0], 3, "a"),
            (0, [float("inf"), 1.0], 10, "a"), (0, [], 4, "a"), (0, [0.5, 0.5], 5, "a"), (0, [0.5, 0.5], 6, "a"),
            (0, [1.0], 20, "a"), (0, [1.0, 1.0], None, "a")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in topk.top_k(df, k=10, every=10).collect())
    assert got == [(0, 1, 5, 1024 * 512 + 2048 * 512), (0, 2, 6, 1024 * 512 + 2048 * 512)]
    assert topk.top_k(df.limit(0)).collect() == []
    twice = spark.createDataFrame([(0, [1.0], 0, "a"), (0, [1.0], 7, "a"), (0, [1.0], 7, "a")], SCHEMA)
    assert sorted(tuple(r)[:3] for r in topk.top_k(twice, k=10, every=10).collect()) == [(0, 1, 7), (0, 2, 7)]


def test_reading_stops_early_and_keeps_every_tie():
    rng = np.random.RandomState(4)
    c = np.floor(rng.standard_normal((2000, 8)) * 200)
    q = np.floor(rng.standard_normal((5, 8)) * 200)
    i, j = topk.search_block(q, c, 10, np.full(5, -np.inf))
    scores = q @ c.T
    for a in range(5):
        kth = np.sort(scores[a])[-10]
        assert set(np.flatnonzero(scores[a] >= kth)) <= set(j[i == a])
    assert len(i) < 5 * 2000


def test_large_values_are_exact(spark, monkeypatch):
    """Scores far beyond what a float holds, with differences in their last digits."""
    monkeypatch.setattr(topk, "GROUP_ROWS", 100)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 32)
    for size, seed in ((1e4, 5), (1e6, 6), (5e5, 7), (1e8, 8)):
        rnd = random.Random(seed)
        near = [size + rnd.randint(-3, 3) / 1024 for _ in range(6)]
        rows = [(0, [rnd.choice(near) if n % 3 else rnd.gauss(0, size / 8) for _ in range(3 if size > 1e7 else 7)], n, "x") for n in range(180)]
        rows = [(a, [float(x) for x in v], i, t) for a, v, i, t in rows]
        df = spark.createDataFrame(rows, "label int, embedding array<double>, vec_id long, score string")
        want, fine = set(), [(i, [math.floor(1024 * x) for x in v]) for _, v, i, _ in rows]
        for q, a in fine[::10]:
            s = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in fine if i != q))[:5]
            want |= {(q, n + 1, i, -x) for n, (x, i) in enumerate(s)}
        if max(x for *_, x in want) < 2 ** 63:
            assert {tuple(r) for r in topk.top_k(df, k=5, every=10).collect()} == want
        else:
            assert size == 1e8


def test_scores_beyond_a_long_are_an_error(spark):
    df = spark.createDataFrame([(0, [1e300, 1.0], i, "x") for i in range(4)], "label int, embedding array<double>, vec_id long, score string")
    with pytest.raises(Exception, match="64-bit"):
        topk.top_k(df, k=2, every=2).collect()

"""Exact top-k search against brute force."""

import math
import random

import numpy as np

from odflux.llm import exact_topk as topk

SCHEMA = "vec_id long, embedding array<float>, rank int, score long"


def brute(rows, k):
    kept = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            q = [math.floor(64 * float(np.float32(x))) for x in v]
            kept[i] = max(kept.get(i, q), q)
    out = set()
    for i, q in kept.items():
        if i % 20:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(q, w)), j) for j, w in kept.items() if j != i))[:k]
        out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)}
    return out


def answer(spark, rows, k):
    frame = spark.createDataFrame(rows, SCHEMA)
    return {tuple(r) for r in topk.exact_topk(frame, "vec_id % 20 = 0", k).collect()}


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "RING_ROWS", 60)
    draw = random.Random(1)
    rows = [(i, [draw.gauss(0, 1) * (1 + i % 3) for _ in range(8)], 1, None) for i in range(400)]
    rows += [(1_000 + i, [0.5] * 8, None, 5) for i in range(200)]  # a third of all rows is one vector
    rows += [(2_000, None, 0, 0), (2_020, [1.0, None] * 4, 0, 0), (2_040, [float("nan")] * 8, 0, 0), (2_060, [float("inf")] * 8, 0, 0),
             (None, [1.0] * 8, 0, 0), (2_080, [], 0, 0), (2_100, [1.0, 2.0], 0, 0), (20, rows[20][1], 0, 0), (40, [0.25] * 8, 0, 0)]
    assert answer(spark, rows, 5) == brute(rows, 5)


def test_few_rows(spark):
    one = [(0, [1.0, 2.0], 0, 0)]
    assert answer(spark, one, 20) == set()
    three = one + [(1, [1.0, 0.0], 0, 0), (2, [1.0, 0.0], 0, 0)]
    assert answer(spark, three, 20) == {(0, 1, 1, 4096), (0, 2, 2, 4096)}
    assert answer(spark, [(0, [0.0], 0, 0), (1, [0.0], 0, 0)], 3) == {(0, 1, 1, 0)}
    assert topk.exact_topk(spark.createDataFrame([], SCHEMA), "vec_id % 20 = 0").count() == 0
    assert topk.exact_topk(spark.createDataFrame([(0, None, 0, 0)], SCHEMA), "vec_id % 20 = 0").count() == 0

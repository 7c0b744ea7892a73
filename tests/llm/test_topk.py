"""Top-k inner products against brute force."""

import math
import random

import numpy as np
import pytest
from conftest import SF

from tabspark.llm import topk


def brute(rows, asked, k=5):
    sound = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and sound(v)]
    out = []
    for q, v in whole:
        if asked(q):
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q and len(w) == len(v))
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def run(spark, rows, divisor=3, k=5):
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "1 AS dim", "2 AS block", "3 AS score")
    return sorted(tuple(r) for r in topk.top_k(frame, frame.filter(f"vec_id % {divisor} = 0"), k=k).collect())


@pytest.mark.parametrize("shape", ["lengths", "directions", "ties", "one long"])
def test_against_brute_force(spark, monkeypatch, shape):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERIES", 8)
    rng = random.Random(shape)
    rows = []
    for i in range(150):
        v = [rng.gauss(0, 1) for _ in range(24)]
        if shape == "lengths":
            v = [x * 10 ** rng.uniform(-3, 2) for x in v]
        if shape == "directions":
            v = [abs(x) * (j < 4) + 0.01 * x for j, x in enumerate(v)]
        if shape == "ties":
            v = [float(rng.choice((-1, 0, 1))) for _ in range(3)]
        if shape == "one long" and i == 7:
            v = [1000 * x for x in v]
        rows.append((i, v))
    assert run(spark, rows) == brute(rows, lambda q: q % 3 == 0)


def test_odd_inputs(spark):
    rows = [(0, [1.0, 2.0]), (3, [1.0, None]), (6, None), (9, [float("nan"), 1.0]), (12, [float("inf"), 1.0]), (15, []), (18, []), (None, [1.0, 1.0]), (1, [0.0, 0.0]), (2, [-1.0, -2.0]), (4, [1.0, 2.0, 3.0]),
            (21, [0.0, 0.0]), (24, [1e6, -3e6]), (27, [1e6, 1e6])]
    assert run(spark, rows) == brute(rows, lambda q: q % 3 == 0)
    assert run(spark, rows[:1]) == [] and run(spark, []) == []
    assert run(spark, [(0, [1.0]), (0, [2.0]), (1, [3.0])], k=1) == [(0, 1, 1, 196608), (0, 1, 1, 393216)]


def test_products_beyond_doubles():
    q, v = np.array([[2.0 ** 30, 1.0]]), np.array([[2.0 ** 32, 1.0], [2.0 ** 32, 0.0]])
    assert topk.products(q, v).tolist() == [[2 ** 62 + 1, 2 ** 62]]
    assert topk.products(q * 8, v).tolist() == [[2 ** 63 - 1, 2 ** 63 - 1]]


def test_pruning_keeps_the_best():
    rng = np.random.default_rng(5)
    v, q = np.floor(rng.normal(size=(300, 32)) * 50), np.floor(rng.normal(size=(20, 32)) * 50)
    v[:5] = q[:5] * 2
    scores = q @ v.T
    floor = np.sort(scores, axis=1)[:, -3]
    found = topk.search_block(q, np.arange(20) + 1000, floor, v, np.arange(300), 3)
    for r in range(20):
        assert sorted(s for row, s, _ in found if row == r) == sorted(scores[r])[-3:]


def test_documented_query_set(spark):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in topk.op6_exact_top_k(spark, spark.read.parquet(f"{SF}/embeddings.parquet")).collect())
    assert got == brute(rows, lambda q: q % 50 == 0)

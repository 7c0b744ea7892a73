"""Updates against a plain loop; held-out order of scores; odd inputs."""

import math

import numpy as np
import pytest
from conftest import SF

from tabspark.llm import quality
from tabspark.llm.quality import Features, FollowTheRegularisedLeader


def test_updates_match_the_published_rule():
    rng = np.random.default_rng(3)
    model, z, n = FollowTheRegularisedLeader(6), [0.0] * 6, [0.0] * 6
    for _ in range(40):
        at, y = np.sort(rng.choice(6, 3, replace=False)), int(rng.integers(0, 2))
        x = rng.random(3)
        w = [0.0 if abs(z[i]) <= model.l1 else -(z[i] - math.copysign(model.l1, z[i])) / ((model.beta + math.sqrt(n[i])) / model.rate + model.l2) for i in at]
        p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, x))))
        for k, i in enumerate(at):
            g = (p - y) * x[k]
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / model.rate * w[k]
            n[i] += g * g
        model.see(at, x, y)
    assert model.z == pytest.approx(z) and model.n == pytest.approx(n)


def test_features_are_words_and_pairs():
    at, x = Features().of("a b a b !!")
    assert len(at) == 3 + 3 + 1 and at[-1] == 1 << quality.BITS and (x[:-1] ** 2).sum() == pytest.approx(1)
    assert Features().of(None)[0].tolist() == [1 << quality.BITS] == Features().of("")[0].tolist()


def test_held_out_scores(spark):
    docs, labels = (spark.read.parquet(f"{SF.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    rows = {r["doc_id"]: r for r in quality.op10_quality(spark, docs, labels).collect()}
    assert len(rows) == docs.count()
    truth = [(rows[r["doc_id"]]["score"], r["quality"]) for r in labels.collect() if rows[r["doc_id"]]["held_out"]]
    good, bad = [s for s, y in truth if y], [s for s, y in truth if not y]
    area = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad)
    assert area > 0.9
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows.values())


def test_odd_inputs(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "good text here"), (4, "bad $$$ bad"), (4, "bad $$$ bad"), (None, "x"), (5, "w " * 300_000)], "doc_id int, text string").selectExpr("*", "1 AS score", "2 AS key")
    labels = spark.createDataFrame([(3, 1), (3, None), (4, 0), (4, 0), (99, 1), (None, 1)], "doc_id int, quality int")
    got = quality.score(docs, quality.learn(docs, labels)).collect()
    assert len(got) == 7 and got[0]["score"] == got[1]["score"] and got[3] == got[4]
    assert got[2]["score"] > got[3]["score"] and all(0 <= r["score"] <= 1 for r in got)
    none = quality.learn(docs, labels.limit(0))
    assert {r["score"] for r in quality.score(docs, none).collect()} == {0.5}
    assert quality.score(docs.limit(0), none).collect() == []

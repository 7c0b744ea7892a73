"""The forward algorithm against a sum over all segmentations; learning on held-out documents; odd inputs."""

import itertools
import math

import numpy as np
import pytest
from conftest import SF

from tabspark.llm import langid
from tabspark.llm.langid import START, LanguageModel


def brute(word: str, p: dict[str, float]) -> float:
    marked, total = START + word, 0.0
    for cuts in itertools.product((0, 1), repeat=len(marked) - 1):
        parts, last = [], 0
        for i, cut in enumerate(cuts, 1):
            if cut:
                parts.append(marked[last:i])
                last = i
        parts.append(marked[last:])
        total += math.prod(p.get(x, langid.UNKNOWN if len(x) == 1 else 0.0) for x in parts)
    return total


@pytest.fixture(scope="module")
def small():
    pieces = sorted(["a", "b", "ab", "ba", START, START + "a", START + "ab", "aba", "é"])
    rng = np.random.default_rng(1)
    p = rng.random((len(pieces), 2))
    return LanguageModel(["x", "y"], pieces, p / p.sum(0))


def test_forward_sums_all_segmentations(small):
    words = ["a", "ab", "aba", "abab", "bé", "zab", "abaabab"]
    got = small.log_likelihood(words)
    for i, w in enumerate(words):
        for k in range(2):
            assert got[i, k] == pytest.approx(math.log(brute(w, dict(zip(small.pieces, small.probability[:, k])))), rel=1e-9)


def test_expected_uses_are_derivatives(small):
    words, counts = ["abab", "aba", "bab"], np.array([[2.0, 1.0], [0.0, 3.0], [1.0, 1.0]])
    got = small.expected(words, counts)
    for i, piece in enumerate(small.pieces):
        for k in range(2):
            p = dict(zip(small.pieces, small.probability[:, k]))
            more = p | {piece: p[piece] * (1 + 1e-6)}
            slope = sum(n * (math.log(brute(w, more)) - math.log(brute(w, p))) for w, n in zip(words, counts[:, k])) / 1e-6
            assert got[i, k] == pytest.approx(slope, abs=1e-4)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in langid.op1_language_id(spark, docs).collect()}
    truth = [(r["doc_id"], r["lang"]) for r in docs.select("doc_id", "lang").collect()]
    held = [(rows[d]["lang_pred"], lang) for d, lang in truth if rows[d]["held_out"]]
    assert len(rows) == len(truth) and len(held) > 20
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows.values())


def test_odd_inputs(spark):
    learned = [(i, t, lang) for i in range(30) for t, lang in (("the house and the tree", "en"), ("das haus und der baum", "de"))]
    model = langid.learn(spark.createDataFrame(learned, "doc_id int, text string, lang string"))
    long = "the tree " * 50_000 + "x" * 5_000
    docs = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, "12 !? _", "a"), (4, long, None), (5, "der baum", "k"), (5, "der baum", "k"), (None, "the house", "z"), (7, "日本 語", "j")],
                                 "doc_id int, text string, key string").selectExpr("*", "'no' AS lang_pred", "0.5 AS score")
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(docs, model).collect()]
    assert [g[1] for g in got[:4]] == ["und", "und", "und", "en"] and [g[2] for g in got[:3]] == [0.0] * 3
    assert got[4] == got[5] and got[4][1] == "de" and got[6][:2] == (None, "en")
    kept = langid.accepted(docs, model)
    assert kept.columns == docs.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 4, 5, 5]


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id int, text string, lang string")
    model = langid.learn(empty)
    assert langid.identify(empty, model).collect() == []
    one = spark.createDataFrame([(1, "some words")], "doc_id int, text string")
    assert langid.identify(one, model).first()["lang_pred"] == "und"

"""The stages against brute force, each on its own input, and the whole."""

import re

import numpy as np
import pytest
from conftest import SF
from tokenizers import Tokenizer

import corpus_pipeline
from tabspark.llm import langid, neardup
from tabspark.llm.common import vocabulary_file
from test_decontam import brute as leaked
from test_neardup import around_a_base, brute as near, rows_on_the_way
from test_secrets import brute as secret


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.settled(stage(spark, docs, SF), name)
        out.append((name, docs.toPandas().sort_values("doc_id"), after.toPandas()))
        docs = after
    return out


def test_columns_and_order(stages):
    assert [n for n, *_ in stages] == ["language", "near_duplicates", "decontamination", "secrets", "packing"]
    for _, before, after in stages[:-1]:
        assert list(after.columns) == list(before.columns) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language(spark, stages):
    _, before, after = stages[0]
    assert {i for i, t in zip(before.doc_id, before.text) if langid.words_of(t)} == set(after.doc_id)
    docs = spark.createDataFrame([(1, "the of and", "en"), (2, None, "en"), (3, "12 !", None), (4, "日本語 日本", None)], "doc_id bigint, text string, lang string")
    assert [r["doc_id"] for r in corpus_pipeline.language(spark, docs, SF).collect()] == [1]


def test_near_duplicates(stages):
    _, before, after = stages[1]
    assert sorted(after.doc_id) == [r[0] for r in near(list(zip(before.doc_id, before.text)), 5, 80, 100) if r[3]]
    assert len(after) < len(before)


def test_near_duplicates_of_a_dense_group(spark, monkeypatch):
    made = rows_on_the_way(monkeypatch)
    rows = list(enumerate(around_a_base(3, (20, 4, 4), (480, 9, 9))))
    after = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), SF)
    assert sorted(r["doc_id"] for r in after.collect()) == [r[0] for r in near(rows, 5, 80, 100) if r[3]]
    assert max(made) <= len(rows) * neardup.TREES * (neardup.REACH + 2)


def test_decontamination(spark, stages):
    _, before, after = stages[2]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert set(after.doc_id) == set(before.doc_id) - {d for d, _ in leaked(list(zip(before.doc_id, before.text)), items)}
    assert len(after) < len(before)


def test_secrets(stages):
    _, before, after = stages[3]
    new = dict(zip(after.doc_id, zip(after.text, after.n_chars)))
    assert set(new) == set(before.doc_id)
    for i, text in zip(before.doc_id, before.text):
        at, out = 0, ""
        for start, _, end in secret(text):
            out += text[at:start] + "[SECRET]" if start >= at else ""
            at = max(at, end)
        assert new[i] == (out + text[at:], len(out + text[at:]))


def test_packing(stages):
    _, before, after = stages[4]
    plain = Tokenizer.from_file(vocabulary_file("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    for i, text in zip(before.doc_id, before.text):
        got = after[after.doc_id == i].sort_values("start")
        assert np.frombuffer(b"".join(map(bytes, got.ids)), "<u4").tolist() == [*plain.encode(text, add_special_tokens=False).ids, 1]
    rows = sorted(zip(after.sequence_id * 2048 + after.offset, after.length))
    assert all(a + n == b for (a, n), (b, _) in zip(rows, rows[1:])) and rows[0][0] == 0


def test_run(spark, stages):
    rows = corpus_pipeline.run(spark, SF).collect()
    want = stages[-1][2]
    assert sorted((r["doc_id"], r["start"], r["length"], bytes(r["ids"])) for r in rows) == sorted((a, b, c, bytes(d)) for a, b, c, d in zip(want.doc_id, want.start, want.length, want.ids))


def test_odd_inputs(spark):
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint, gone int, spans string, bad int"
    rows = [(1, None, None, None, None, 1, "s", 1), (2, "", "en", "", 0, 1, "s", 1), (3, "the tree and the house of the day and more", "en", "x", 41, 1, "s", 1), (3, "the tree and the house of the day and more", "en", "x", 41, 1, "s", 1),
            (None, "the token = abcdef123456 and the other one", "en", "x", 1, 1, "s", 1), (5, "the " * 100_000, "en", "x", 1, 1, "s", 1)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, kind)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = corpus_pipeline.settled(stage(spark, docs, SF), name)
            assert after.columns == docs.columns
            docs = after
        left = sorted(str(r["doc_id"]) for r in docs.collect())
        assert left == (["3", "5", "None"] if data else [])
        assert corpus_pipeline.packed(spark, docs, SF).count() == (0 if not data else corpus_pipeline.packed(spark, docs, SF).count())
        if data:
            assert re.search(r"the \[SECRET\] and", next(r["text"] for r in docs.collect() if r["doc_id"] is None))

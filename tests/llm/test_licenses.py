"""License phrases against a plain scan; templates at their places."""

import re
import string

import pytest
from conftest import SF

from tabspark.llm import licenses

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def base(text):
    w = words(text)
    return sorted((i, label) for p, label in licenses.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split())


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        found = base(texts[r["doc_id"]])
        at = [i for i, _ in found]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"]) == (len(words(texts[r["doc_id"]])), len(found), min(at, default=None), max(at, default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in found}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        assert r["labels"] == ",".join(sorted(set(r["labels"].split(",")))) and (r["score"] > 0) == (r["labels"] != "")


def test_documents(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    rows = licenses.op5_licenses(spark, docs).collect()
    check(rows, texts)
    labels = {r["doc_id"]: r["labels"].split(",") for r in rows}
    for i, t in texts.items():  # the notices in the data
        assert ("mit" in labels[i]) == ("mit license" in t.lower())
        assert ("apache-2.0" in labels[i]) == ("Apache License, Version 2.0" in t)
        assert ("cc-by-nc" in labels[i]) == ("CC BY-NC" in t)
        assert ("gpl-3.0" in labels[i]) == ("GNU General Public License, version 3" in t)


def test_every_template(spark):
    texts = [f"Intro of 3 words. {text.upper()}! More, text." for _, text, _ in licenses.TEMPLATES]
    shuffled = [" ".join(reversed(text.split())) for _, text, _ in licenses.TEMPLATES]
    without = [text.replace(phrases[0], "something else") for _, text, phrases in licenses.TEMPLATES]
    plain = ["some words of no licence at all"] * 60
    docs = spark.createDataFrame(list(enumerate(texts + shuffled + without + plain)), "doc_id int, text string")
    rows = {r["doc_id"]: r["labels"].split(",") for r in licenses.op5_licenses(spark, docs).collect()}
    n = len(texts)
    for i, (label, *_) in enumerate(licenses.TEMPLATES):
        assert label in rows[i] and label not in rows[n + i] and label not in rows[2 * n + i], label
    assert all(rows[i] == [""] for i in range(3 * n, 3 * n + 60))


def test_many_notices_in_a_file(spark):
    every = ". ".join(text for _, text, _ in licenses.TEMPLATES)
    pairs = [(a, b) for i, a in enumerate(licenses.TEMPLATES) for b in licenses.TEMPLATES[i + 1:]]
    scattered = "following person conditions granted charge copy software documentation files "  # licence words, no notice
    texts = [every] + [f"{a[1]}; {b[1]}" for a, b in pairs] + [scattered * 2000 + licenses.TEMPLATES[2][1] + " " + scattered * 2000, scattered * 50]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(10_000 + i, "some words of no licence at all") for i in range(60)], "doc_id int, text string")
    rows = {r["doc_id"]: r for r in licenses.op5_licenses(spark, docs).collect()}
    labels = {i: set(r["labels"].split(",")) for i, r in rows.items()}
    assert {label for label, *_ in licenses.TEMPLATES} <= labels[0]
    for i, (a, b) in enumerate(pairs, 1):
        assert {a[0], b[0]} <= labels[i], (a[0], b[0])
    assert "bsd" in labels[len(texts) - 2] and labels[len(texts) - 1] == {""}
    assert abs(rows[0]["score"] - 1) < 1e-9


def test_odd_inputs(spark):
    texts = [None, "", "CC-BY", "cc by cc by", "All\nRights--Reserved. all rights", "ÀLL rights reserved", "cc éby", "general public general public license", "x " * 200_000 + "cc by", "İcc by", "\x7fcc\x00by", "by", "cc"]
    docs = spark.createDataFrame([*enumerate(texts), (2, "CC-BY"), (None, "cc by")], "doc_id int, text string").selectExpr("*", "1 AS row", "2 AS key", "3 AS words", "4 AS hits")
    rows = licenses.op5_licenses(spark, docs).collect()
    check(rows, _Texts(texts))
    assert len(rows) == len(texts) + 2
    assert licenses.op5_licenses(spark, docs.limit(0)).collect() == []


class _Texts(dict):
    """Texts by id, with one id twice and one null."""

    def __init__(self, texts):
        super().__init__(enumerate(texts))
        self[None] = "cc by"

    def __len__(self):
        return super().__len__() + 1

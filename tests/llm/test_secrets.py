"""Secret spans against a plain scan; the models on random strings and identifiers; redaction."""

import base64
import hashlib
import random
import re

import pytest
from conftest import SF

from tabspark.llm import secret_scan

PLAIN = {"assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6), "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20), "hex": (re.compile("[0-9a-f]+"), 0, 24)}


def brute(text):
    found = [(m.start(), k, m.end()) for k, (kind, (p, group, least)) in enumerate(PLAIN.items()) for m in p.finditer(text or "") if len(m.group(group)) >= least]
    return sorted(found)


@pytest.fixture(scope="module")
def model(spark):
    return secret_scan.learn(spark.read.parquet(f"{SF}/documents.parquet"))


def check(rows, texts):
    for r in rows:
        want = brute(texts[r["doc_id"]])
        out = ",".join(f"{list(PLAIN)[k]}:{a}:{b}" for a, k, b in want)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == j for _, k, _ in want) for j in range(3)]
        assert r["base_sha256"] == hashlib.sha256(out.encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        assert [s for s in spans if not s.startswith("markov")] == (out.split(",") if out else [])


def test_documents(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    rows = secret_scan.op9_secrets(spark, docs).collect()
    assert len(rows) == docs.count()
    check(rows, {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()})


def test_odd_texts(spark):
    texts = ["password: token: abcdef", 'API_KEY="abc" Secret=\'a.b-c_d=\'', "é😀 token=xyz123 " + "0" * 24 + "AKIA" + "A" * 15, "AKIAXAKIA" + "B" * 20, "ſecret=abcdef passwd = 12345 passwd=123456", None, "",
             "0123456789abcdef01234567g" * 3, "token=" * 50, "a" * 23 + " " + "f" * 100_000, "ApiKey:\n=x apikey:  '" + "z" * 9]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, "token=abcdefg")], "doc_id int, text string").selectExpr("*", "1 AS base", "2 AS spans")
    rows = secret_scan.op9_secrets(spark, docs).collect()
    check([r for r in rows if r["doc_id"] is not None], dict(enumerate(texts)))
    assert len(rows) == len(texts) + 1
    assert secret_scan.op9_secrets(spark, docs.limit(0)).collect() == []


def test_models_tell_random_strings_from_identifiers(spark, model):
    rng = random.Random(8)
    random_ = [base64.b64encode(rng.randbytes(30)).decode() for _ in range(200)]
    random_ = [t for t in random_ if any(c.isdigit() for c in t)]
    plain = ["thentionandstheredating2", "nation_of_the_statement_1", "ingtheandoftionerin_v2_the", "2the-and-thing-ration-and", "/the/on/and/station/ing/1"]
    docs = spark.createDataFrame([(i, f"x {t} y") for i, t in enumerate(random_ + plain)], "doc_id int, text string")
    found = {r["doc_id"]: [s for s in r["spans"] if s["kind"] == 3] for r in secret_scan.scan(docs, model).collect()}
    hits = [found[i] for i in range(len(random_))]
    assert sum(bool(h) for h in hits) >= 0.97 * len(hits)
    assert all(h[0]["start"] == 2 and h[0]["end"] >= 2 + 38 for h in hits if h)
    assert not any(found[i] for i in range(len(random_), len(random_) + len(plain)))


def test_redaction(spark, model):
    texts = ['é a token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" b AKIA' + "A" * 16 + ".", "nothing", None, ""]
    docs = spark.createDataFrame([(i, t, -1) for i, t in enumerate(texts)], "doc_id int, text string, n_chars int").selectExpr("*", "5 AS spans", "6 AS clean", "7 AS base")
    rows = sorted(secret_scan.without_secrets(docs, model, size="n_chars").collect(), key=lambda r: r["doc_id"])
    assert [r["text"] for r in rows] == ['é a [SECRET]" b [SECRET].', "nothing", None, ""]
    assert rows[0]["n_chars"] == len(rows[0]["text"]) and rows[0]["spans"] == 5 and rows[2]["n_chars"] is None
    assert list(rows[0].asDict()) == docs.columns

"""Encoding, packing and attribution against the tokenizer itself."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from conftest import SF
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tabspark.llm import attribution, packing
from tabspark.llm.common import vocabulary_file
from tabspark.llm.encoder import Encoder

PATH = vocabulary_file(packing.TOKENIZER)
ODD = [None, "", " ", "a  b", " x", "x ", "a\n\n b", "<|endoftext|> y", "é" * 3000, "日本語 🤗🤗 x", "a" * 50_000, "don't  we'll\t\tgo", "ñ ç\x1c b"]


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def quick():
    with open(PATH, encoding="utf-8") as f:
        return Encoder(f.read())


def same(plain, quick, texts):
    want = [plain.encode(t or "", add_special_tokens=False) for t in texts]
    assert [np.frombuffer(b, quick.dtype).tolist() for b in quick.ids(texts)] == [e.ids for e in want]
    assert [list(zip(a.tolist(), b.tolist())) for a, b in quick.located(texts)] == [e.offsets for e in want]


def test_odd_texts(plain, quick):
    assert quick.byte_level
    same(plain, quick, ODD)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(plain, quick, text):
    same(plain, quick, [text])


def test_other_tokenizers_encode_by_themselves():
    with open(vocabulary_file("word_bpe_49k.json"), encoding="utf-8") as f:
        spec = f.read()
    other, whole = Encoder(spec), Tokenizer.from_str(spec)
    assert not other.byte_level
    same(whole, other, ["Some words here", "", "x"])


def check(rows, docs, plain):
    texts, pieces, places = defaultdict(list), defaultdict(list), []
    for r in docs.select("doc_id", "text").collect():
        texts[r["doc_id"]].append([*plain.encode(r["text"] or "", add_special_tokens=False).ids, 1])
    for r in rows:
        pieces[r["doc_id"]].append(r)
        places.append((r["sequence_id"], r["offset"], r["length"]))
    end = 0
    for seq, offset, length in sorted(places):  # gapless
        assert seq * 2048 + offset == end and 0 < length <= 2048 - offset
        end += length
    assert end == sum(len(ids) for every in texts.values() for ids in every)
    for key, every in texts.items():
        got = sorted((p["start"], p["length"], p["ids_crc32"], p["doc_tokens"]) for p in pieces[key])
        for ids in every:
            at = 0
            while at < len(ids):
                mine = next(g for g in got if g[0] == at and g[3] == len(ids) and zlib.crc32(np.array(ids[at:at + g[1]], "<u4").tobytes()) == g[2])
                got.remove(mine)
                at += mine[1]
        assert got == []


def test_packing_on_documents(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    check(packing.op4_packing(spark, docs).collect(), docs, plain)


def test_packing_odd_inputs(spark, plain):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)] + [(3, "a  b"), (None, "null id")], "doc_id int, text string").selectExpr("*", "1 AS start", "2 AS ids", "3 AS key")
    check(packing.op4_packing(spark, docs).collect(), docs, plain)
    assert packing.op4_packing(spark, docs.limit(0)).collect() == []


def test_boundary_records(spark):
    docs = spark.createDataFrame([(i, "word " * 900) for i in range(5)], "doc_id int, text string").coalesce(1)
    rows = packing.pack(docs, window=1000).orderBy("sequence_id", "offset").collect()
    assert any(r["continued"] for r in rows)
    for r in rows:
        assert r["continued"] == (r["start"] > 0) and r["continues"] == (r["start"] + r["length"] < r["doc_tokens"])


def brute(spans, sections, rule):
    out = defaultdict(lambda: [0, 0])
    for a, b in spans:
        shares = [max(0, min(b, e) - max(a, s)) for s, e in sections]
        if rule == "first":
            home = next((i for i, (s, e) in enumerate(sections) if s <= a < e), -1)
        else:
            home = shares.index(max(shares)) if shares and max(shares) > 0 else -1
        out[home][0] += 1
        out[home][1] += home < 0 or shares[home] < b - a
    return out


@pytest.mark.parametrize("rule", ["first", "most"])
def test_attribution_to_given_sections(spark, plain, rule):
    texts = ["hello wonderful world of tokens", "naïve café déjà vu", "ab", "", None, "日本語 🤗🤗 text"]
    cuts = [[(0, 8), (8, 20), (25, 31)], [(2, 3), (3, 4), (4, 11)], [(0, 1), (1, 2)], [], None, [(0, 2), (4, 5), (5, 6), (6, 11)]]
    docs = spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate(zip(texts, cuts))], "doc_id int, text string, parts array<struct<start:int,end:int>>")
    got = defaultdict(dict)
    for r in attribution.attribute(docs, "parts", rule=rule).collect():
        got[r["doc_id"]][r["section"]] = [r["n_tokens"], r["n_crossing"]]
    for i, (t, c) in enumerate(zip(texts, cuts)):
        want = brute(plain.encode(t or "", add_special_tokens=False).offsets, c or [], rule)
        assert got[i] == {k: want[k] for k in [*range(len(c or []))] + [-1] * (want[-1][0] > 0)}, (i, t)


def test_attribution_to_lines(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet").union(spark.createDataFrame([(-1, None, "", "", 0), (-2, "a\n\nb\n", "", "", 0), (-3, "\n\n\nx", "", "", 0)], "doc_id bigint, text string, lang string, source string, n_chars bigint"))
    got = defaultdict(dict)
    for r in attribution.op3_token_counts(spark, docs).collect():
        got[r["doc_id"]][r["section"]] = [r["n_tokens"], r["n_crossing"], r["start"], r["end"]]
    for r in docs.collect():
        text, at, sections = r["text"] or "", 0, []
        for line in text.splitlines(keepends=True) if "\r" not in text else []:
            sections.append((at, at + len(line)))
            at += len(line)
        sections = sections or [(0, 0)]
        want = brute(plain.encode(text, add_special_tokens=False).offsets, sections, "most")
        assert got[r["doc_id"]] == {k: [*want[k], s, e] for k, (s, e) in enumerate(sections)}
    assert attribution.attribute(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        attribution.attribute(docs, rule="last")

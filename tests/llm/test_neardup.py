"""Near duplicates and components against brute force."""

import itertools
import random
import re
import string

import numpy as np
import pytest
from conftest import SF

from tabspark.llm import neardup
from tabspark.llm.components import components

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingle_set(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())


def brute(rows, words, over, under):
    sets = [(i, shingle_set(t, words)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if i is not None and j is not None and a and b and min(len(a), len(b)) * under >= over * max(len(a), len(b)) and under * len(a & b) >= over * len(a | b):
            x, y = sorted((find(i), find(j)))
            parent[y] = x
    return sorted(((i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in sets), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def run(spark, rows, words=3, threshold=(85, 100)):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS id", "2 AS kept", "3 AS gone", "4 AS a")
    got = [tuple(r) for r in neardup.near_duplicates(docs, words=words, threshold=threshold).collect()]
    return sorted(got, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def copies(rng, n, size, edits):
    base = [rng.choice(string.ascii_lowercase) + str(rng.randrange(300)) for _ in range(size)]
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(size)] = "new" + str(rng.randrange(10 ** 6))
        yield " ".join(w)


@pytest.mark.parametrize("words,threshold", [(3, (85, 100)), (5, (80, 100))])
def test_documents(spark, words, threshold):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert run(spark, rows, words, threshold) == brute(rows, words, *threshold)


def test_dense_group_and_pairs_near_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(neardup, "REGION", 4)
    rng, texts = random.Random(11), []
    texts += copies(rng, 120, 60, 4)
    for _ in range(40):
        texts += copies(rng, 2, 80, 4)
    texts += [texts[3]] * 50
    rows = list(enumerate(texts))
    assert run(spark, rows) == brute(rows, 3, 85, 100)


@pytest.mark.parametrize("rows_,block,side", [(200_000, 8192, 1024), (500, 100, 40)])
def test_dense_group_of_sparse_links(spark, monkeypatch, rows_, block, side):
    """A base and many edited copies, most of them near to the base only; the second case cuts partitions, cells and blocks small."""
    for name, value in (("ROWS", rows_), ("BLOCK", block), ("SIDE", side)):
        monkeypatch.setattr(neardup, name, value, raising=False)
    rng = random.Random(5)
    base = [f"{rng.choice(string.ascii_lowercase)}{k}" for k in range(500)]
    texts = [" ".join(base)]
    for _ in range(700):
        w = list(base)
        for k in rng.sample(range(500), 13):
            w[k] = "new" + str(rng.randrange(10 ** 6))
        texts.append(" ".join(w))
    rows = list(enumerate(texts))
    assert run(spark, rows) == brute(rows, 3, 85, 100)


def rows_on_the_way(monkeypatch):
    """The row counts of what `neardup` writes or checkpoints from now on."""
    made = []
    for name in ("settled", "checkpoint"):
        def counted(df, *more, whole=getattr(neardup, name)):
            out = whole(df, *more)
            made.append(out.count())
            return out
        monkeypatch.setattr(neardup, name, counted)
    return made


def around_a_base(seed, *kinds):
    """Copies of a base that is not there; kinds: how many, least and most edits."""
    rng = random.Random(seed)
    base = [f"{rng.choice(string.ascii_lowercase)}{k}" for k in range(500)]
    for n, least, most in kinds:
        for _ in range(n):
            w = list(base)
            for k in rng.sample(range(500), rng.randint(least, most)):
                w[k] = "new" + str(rng.randrange(10 ** 6))
            yield " ".join(w)


@pytest.mark.parametrize("block,side_bytes", [(8192, 16_000_000), (64, 16_000_000), (8192, 200_000)])
def test_dense_group_makes_no_pairs(spark, monkeypatch, block, side_bytes):
    """Most of a group are not quite alike: what is written on the way grows with the group, not with its square."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "SIDE_BYTES", side_bytes)
    made = rows_on_the_way(monkeypatch)
    rows = list(enumerate(around_a_base(8, (100, 5, 6), (300, 11, 12))))
    want = brute(rows, 3, 85, 100)
    assert 250 < len({r[2] for r in want}) < 350
    assert run(spark, rows) == want
    assert max(made) <= len(rows) * neardup.TREES * (neardup.REACH + 2)


def test_many_range_partitions(spark, monkeypatch):
    monkeypatch.setattr(neardup, "ROWS", 60)
    rng = random.Random(2)
    rows = list(enumerate(t for _ in range(30) for t in copies(rng, 3, 60, 2)))
    assert run(spark, rows) == brute(rows, 3, 85, 100)


def test_odd_inputs(spark):
    rows = [(5, "A b C"), (3, "a B c"), (4, None), (6, ""), (7, " \t\n"), (8, "one two"), (9, "ONE two"), (10, "one two three"), (None, "a b c"), (11, "É b c"), (12, "é b c"), (3, "a B c"), (13, "w " * 200_000), (14, "w " * 199_999),
            (15, "x y z w"), (2, "\x1c\x1dq r")]
    assert run(spark, rows) == brute(rows, 3, 85, 100)
    assert run(spark, []) == [] and run(spark, [(1, None)]) == [(1, 0, 1, True)]


def test_first_of_each(spark):
    rows = [(5, "a b c d e f g"), (3, "a b c d e f g"), (3, "a b c d e f g"), (4, None), (None, "a b c d e f g"), (9, "something else of a few words")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "7 AS gone", "8 AS kept")
    kept = neardup.first_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 3, 4, 9]


def test_adaptive_depth():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 3, (400, neardup.DEPTH)).astype("u2")
    keys[:200, :6] = 1
    keys = keys[np.lexsort(keys.T[::-1])]
    i, j = neardup.neighbours(np.zeros(400, "i4"), keys, region=8, least=5)
    found = set(zip(i.tolist(), j.tolist()))
    prefix = lambda a, d: tuple(keys[a, :d])
    for a in range(400):
        dense = sum(prefix(a, 5) == prefix(b, 5) for b in range(400)) > 8
        depth = next((d for d in range(5, neardup.DEPTH) if sum(prefix(a, d) == prefix(b, d) for b in range(400)) <= 8), neardup.DEPTH)
        for b in range(a + 1, min(400, a + 9)):
            near = b - a <= neardup.REACH or not dense
            assert ((a, b) in found) == (near and (prefix(a, depth) == prefix(b, depth) or (b == a + 1 and prefix(a, 5) == prefix(b, 5))))


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(1000, 1000 + i) for i in range(1, 80)] + [(rng.randrange(3000, 3100), rng.randrange(3000, 3100)) for _ in range(60)] + [(7, 7)]
    parent = {x: x for link in links for x in link if link[0] != link[1]}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = sorted(tuple(r) for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert got == sorted((x, find(x)) for x in parent)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []

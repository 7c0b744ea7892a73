"""The prefix trie against a plain loop, with bands and chunks so small that most nodes have to be recombined."""

import hashlib
import random
import re
from collections import defaultdict
from zlib import crc32

import pytest
from conftest import SF

from tabspark.llm import prefix_trie
from tabspark.llm.common import table


def in_order(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}


def remade(convs):
    out = {}
    for c, own in convs.items():
        h = crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    nodes = defaultdict(list)
    for c, s in convs.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(c)
    words = {k: len(re.findall(r"[^ \t-\r]+", k[-1][1])) if k else 0 for k in nodes}
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for k in nodes:
        if k:
            kids[k[:-1]] += 1
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in kids
            saved[k[:d]] += (len(members) - 1) * words[k]
    return sorted((min(m), len(k), min(nodes[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(k)).encode()).hexdigest()) for k, m in nodes.items())


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS conv", "'x' AS words", "2 AS depth", "3 AS band")


def branching(seed, n=150):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        length = 40 if c == 3 else rng.choice([0, 1, 1, 2, 3, 4, 5, 9])
        rows += [(c, i, "u", " ".join("w" * rng.randint(1, 2) for _ in range(rng.randint(1, 2))) if rng.random() < 0.3 else "same text") for i in range(length)]
    return rows


@pytest.mark.parametrize("width, most", [(16, 50_000), (2, 7)])
def test_small_bands_and_chunks(spark, width, most):
    rows = branching(1)
    placed = prefix_trie.numbered(frame(spark, rows))
    assert rows_of(prefix_trie.trie(placed, placed.select("conv").distinct(), width, most)) == sorted(brute(in_order(rows)), key=repr)


ODD = [(None, 0, "u", "lost"), (0, None, None, None), (0, 1, "u", "x"), (0, 1, "u", "x"), (0, 1, "b", "z"), (20, 0, "u", ""), (20, 5, "u", "a b\tc\nd"), (-21, 0, "u", "q"), (-21, 1, "u", "r"), (41, 0, "u", "x"), (7, 0, "u", "x"), (7, 9, "u", "x"),
       (1, 0, "u", "y " * 300_000), (1, 1, None, "é"), (2, 3, "u", None), (2, 2, "u", "x"), (2, 1, "u", "x"), (2, 0, "u", "x"), (2, 9, "", ""), (22, 0, "ux", ""), (23, 0, "u", "x")]


def test_odd_rows(spark):
    assert rows_of(prefix_trie.op12_prefix_trie(spark, frame(spark, ODD))) == sorted(brute(remade(in_order(ODD))), key=repr)
    assert rows_of(prefix_trie.op12_prefix_trie(spark, frame(spark, []))) == []


def test_one_long_conversation_lies_in_many_partitions(spark):
    rows = [(5, i, "u", f"t{i % 7}") for i in range(200)] + [(c, 0, "u", "t0") for c in range(10, 60)]
    placed = prefix_trie.numbered(frame(spark, rows))
    assert sorted(r["depth"] for r in placed.filter("conv = 5").collect()) == list(range(1, 201))
    assert rows_of(prefix_trie.trie(placed, placed.select("conv").distinct())) == sorted(brute(in_order(rows)), key=repr)


def test_real_conversations(spark):
    turns = table(spark, SF, "conversations")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(prefix_trie.op12_prefix_trie(spark, turns)) == sorted(brute(remade(in_order(rows))), key=repr)
    assert rows_of(prefix_trie.prefix_trie(turns)) == sorted(brute(in_order(rows)), key=repr)

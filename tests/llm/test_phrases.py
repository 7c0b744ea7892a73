"""Collocations against a plain loop, with budgets low enough that prefixes are extended."""

import re
from collections import Counter, defaultdict

import pytest
from conftest import SF

from tabspark.llm import phrases
from tabspark.llm.common import table


def brute(rows, least=10, best=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", folded):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        inner = {s for g, a in candidates.items() if len(g) == 3 for s in (g[:2], g[1:]) if 100 * a >= 50 * candidates[s]}
        scored = []
        for g, a in candidates.items():
            if g not in inner:
                score, _, l, r = min((1000000 * a * a // (counts[g[:k]] * counts[g[k:]]), k, counts[g[:k]], counts[g[k:]]) for k in range(1, len(g)))
                scored.append((-score, -a, " ".join(g).encode(), l, r))
        for i, (score, a, phrase, l, r) in enumerate(sorted(scored)[:best], 1):
            out.append((lang, i, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("budget, bits", [(1_000_000, 1 << 24), (1500, 64)])
def test_real_texts(spark, budget, bits):
    docs = table(spark, SF, "documents").select("doc_id", "lang", "text")
    want = brute([(r["lang"], r["text"]) for r in docs.collect()])
    assert len(want) > 100
    assert rows_of(phrases.collocations(docs, budget=budget, most_bits=bits)) == want


ODD = [("en", None), ("en", ""), (None, "New York. new york, NEW YORK\n" * 9), ("", "a b c\ta b c; " * 20), ("x\ny", "É\x00q É\x00q " * 30), ("en", " \t.,;:!?\n\v\f\r"),
       ("en", "the " * 50_000), ("en", "of the " * 500 + "of the rest"), ("en", "of the " * 500 + "of the rest"), ("de", " a b c " * 12), ("en", "y" * 1_000_000 + " z")]


@pytest.mark.parametrize("budget", [1_000_000, 5000])
def test_odd_rows(spark, budget):
    docs = spark.createDataFrame(ODD, "lang string, text string").selectExpr("*", "1 AS f", "'q' AS w1", "'z' AS grp", "2 AS word")
    assert rows_of(phrases.collocations(docs, budget=budget)) == brute(ODD)
    assert rows_of(phrases.op13_phrases(spark, docs.filter("false"))) == []


def test_no_group_holds_more_than_its_prefixes(spark):
    docs = table(spark, SF, "documents")
    words = phrases.word_counts(docs)
    budget = 1200
    leaves, groups, _ = phrases.suffixes(docs, words, budget=budget)
    hot = {(r["lang"], r["word"]) for r in words.filter(f"f > {budget}").collect()}
    assert hot and len(hot) < groups
    prefixes = defaultdict(int)
    for r in leaves.collect():
        w = [bytes(x).decode() if x is not None else None for x in (r["w1"], r["w2"], r["w3"])]
        depth = 1 if (r["lang"], w[0]) not in hot else 2 if (r["lang"], w[1]) not in hot else 3
        prefixes[(r["grp"], r["lang"], *w[:depth])] += r["f"] if depth < 3 else 1
    assert max(prefixes.values()) <= budget
    assert len({k[1:] for k in prefixes}) == len(prefixes)

"""License scan by a positional index of license templates.

Texts are lower-cased A-Z and cut into words of letters and digits (and any character outside ASCII). The index holds, for every word of the
TEMPLATES that is no function word, the templates and positions it stands at. A template's mandatory phrases must stand in the file at matching places
(word place in the file less place in the template). In files that have them, all licence words are looked up, whatever their number: where enough
agree on template and relative position, the template is found. Its score is the share of its words that agree, weighted by inverse document frequency.
Besides, the fixed PHRASES are found wherever their words stand consecutively.

Defined results: a null text is empty and has no words; repeated rows are scanned one by one; texts are read whole; a template met several times counts
once; other columns are ignored; empty tables give no row. DataFrame functions only. What reaches the driver is a count per word of the templates;
what is broadcast is the index, whose size is fixed by the templates.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tabspark.llm.common import settled

#: Phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Label, words of a public licence notice, and the phrases in it that must be there.
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license", "version 2 0"]),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ["except in compliance", "obtain a copy"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
     ["source and binary forms", "conditions are met"]),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", ["creative commons attribution"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc0", "dedicated to the public domain under cc0 1 0 universal", ["public domain", "cc0"]),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
     ["gnu general public license", "free software foundation"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["with or without fee", "hereby granted"]),
    ("lgpl", "licensed under the gnu lesser general public license", ["gnu lesser general public license"]),
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
     ["permission is hereby granted", "free of charge"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("proprietary", "proprietary and confidential unauthorized copying of this file is strictly prohibited", ["strictly prohibited"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["unencumbered software", "public domain"]),
]
FUNCTION_WORDS = set("a and any are as at by can for in into is it may not of or that the this to use with you 0 1 2 3 4 v".split())
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a template that must agree on a place (all, where a template has fewer).
AGREE = 2
#: Score of a file in which only the fixed phrases are found.
PHRASE_SCORE = 0.5


def _vocabulary() -> list[str]:
    words = {w for _, text, _ in TEMPLATES for w in text.split()} - FUNCTION_WORDS
    phrases = {w for p in PHRASES for w in p.split()} | {w for *_, needed in TEMPLATES for p in needed for w in p.split()}
    return sorted(words | phrases)


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase), F.lit(WORD), F.lit(0))


def places(hits: Column, phrase: str) -> Column:
    """Where the phrase's words stand consecutively; `hits` are (at, word) in order and hold all words of the phrase."""
    parts = phrase.split()

    def starts(h: Column, i: Column) -> Column:
        ok = h["word"] == parts[0]
        for k, w in enumerate(parts[1:], 1):
            later = F.get(hits, i + k)
            ok = ok & F.coalesce((later["word"] == w) & (later["at"] == h["at"] + k), F.lit(False))
        return ok

    return F.transform(F.filter(hits, starts), lambda h: h["at"])


def found_words(docs: DataFrame, key: str, text: str) -> DataFrame:
    """row, key, n_words, hits (place and word of every licence word), base (label and place of the fixed phrases)."""
    known = ", ".join(f"'{w}'" for w in _vocabulary())
    hits = F.expr(f"filter(transform(words, (w, i) -> IF(w IN ({known}), named_struct('at', i, 'word', w), NULL)), h -> h IS NOT NULL)")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), words(F.col(text)).alias("words"))
    rows = rows.select("row", "key", F.size("words").cast("bigint").alias("n_words"), hits.alias("hits"))
    base = [F.transform(places(F.col("hits"), p), _labelled(label)) for p, label in PHRASES.items()]
    return rows.withColumn("base", F.flatten(F.array(*base)))


def _labelled(label: str):
    return lambda at: F.struct(F.lit(label).alias("label"), at.alias("at"))


def _index(spark: SparkSession, weights: dict[str, float]) -> DataFrame:
    """word, weight, template, place: the postings, fixed by the templates."""
    rows = [(w, weights[w], t, k) for t, (_, text, _) in enumerate(TEMPLATES) for k, w in enumerate(text.split()) if w not in FUNCTION_WORDS]
    return spark.createDataFrame(rows, "word string, weight double, template int, place int")


def templates_found(found: DataFrame) -> DataFrame:
    """row, template, score: templates whose words and mandatory phrases stand at matching places of the file."""
    spark = found.sparkSession
    n = max(found.count(), 1)
    seen = found.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["word"]))).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()
    counts = {r["word"]: r["n"] for r in seen}
    weights = {w: math.log((n + 1) / (counts.get(w, 0) + 1)) + 1e-9 for w in _vocabulary()}
    index = _index(spark, weights)
    sizes = [len([w for w in text.split() if w not in FUNCTION_WORDS]) for _, text, _ in TEMPLATES]
    totals = [sum(weights[w] for w in text.split() if w not in FUNCTION_WORDS) for _, text, _ in TEMPLATES]
    # mandatory phrases, at the place they have in the template
    needed = []
    for t, (_, text, phrases) in enumerate(TEMPLATES):
        for k, p in enumerate(phrases):
            place = f" {text} ".index(f" {p} ")
            needed.append(F.transform(places(F.col("hits"), p), _needed(t, k, len(text[:place].split()))))
    phrases = found.filter(F.size("hits") > 0).select("row", F.explode(F.flatten(F.array(*needed))).alias("p")).select("row", "p.*")
    phrases = phrases.groupBy("row", "template", "shift").agg(F.countDistinct("phrase").alias("phrases"))
    asked = F.get(F.array(*[F.lit(len(p)) for *_, p in TEMPLATES]), F.col("template"))
    phrases = phrases.filter(F.col("phrases") >= asked)
    # all licence words of the files that have the phrases of a template
    hits = found.select("row", F.explode("hits").alias("h")).select("row", "h.at", "h.word").join(phrases.select("row").distinct(), "row", "left_semi")
    met = hits.join(F.broadcast(index), "word").select("row", "template", (F.col("at") - F.col("place")).alias("shift"), "place", "weight")
    aligned = met.join(phrases, ["row", "template", "shift"]).groupBy("row", "template", "shift").agg(
        F.countDistinct("place").alias("agree"), F.sum("weight").alias("weight"))
    enough = F.get(F.array(*[F.lit(min(AGREE, s)) for s in sizes]), F.col("template"))
    share = F.least(F.col("weight") / F.get(F.array(*[F.lit(x) for x in totals]), F.col("template")), F.lit(1.0))
    return aligned.filter(F.col("agree") >= enough).groupBy("row", "template").agg(F.max(share).alias("score"))


def _needed(template: int, phrase: int, place: int):
    return lambda at: F.struct(F.lit(template).alias("template"), F.lit(phrase).alias("phrase"), (at - place).alias("shift"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_words, base (label and place of every fixed phrase), templates (label and score), of every row.

    The licence words are written once; their counts, the look-up and the result are read from there.
    """
    found = settled(found_words(docs, key, text), "licence")
    labels = F.get(F.array(*[F.lit(label) for label, *_ in TEMPLATES]), F.col("template"))
    more = templates_found(found).groupBy("row").agg(F.collect_list(F.struct(labels.alias("label"), "score")).alias("templates"))
    empty = F.array().cast("array<struct<label:string,score:double>>")
    return found.select("row", "key", "n_words", "base").join(more, "row", "left").select(F.col("key").alias(key), "n_words", "base", F.coalesce("templates", empty).alias("templates"))


def op5_licenses(spark: SparkSession, docs: DataFrame) -> DataFrame:
    base, templates = F.transform("base", lambda b: b["label"]), F.transform("templates", lambda t: t["label"])
    at = F.transform("base", lambda b: b["at"].cast("bigint"))
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    score = F.greatest(F.coalesce(F.array_max(F.transform("templates", lambda t: t["score"])), F.lit(0.0)), F.when(F.size("base") > 0, PHRASE_SCORE).otherwise(0.0))
    return scan(docs).select("doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"), F.array_min(at).alias("first_word"), F.array_max(at).alias("last_word"),
                             joined(base).alias("base_labels"), joined(F.concat(base, templates)).alias("labels"), score.alias("score"))

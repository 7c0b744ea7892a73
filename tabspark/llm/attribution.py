"""Offset-mapped token counts: whole documents are encoded once, and their tokens are dealt to sections by character spans.

Tokens and sections of a document are both intervals of characters; the interval join of the two decides where each token counts.
A token that crosses a boundary goes, by the rule `first`, to the section that holds its first character, and by the rule
`most`, to the section that holds most of its characters, the earlier one if equal.

Sections are given as array<struct<start, end>> (sorted, not overlapping), or are the lines of the text, each with its line feed.
Tokens outside all sections are counted in a row of section -1, which is there only if it has any.

Defined results: a null or empty text has one empty section without tokens if none are given; repeated rows give repeated results;
other columns are ignored. Positions are code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabspark.llm.common import ship, slices, vocabulary_file
from tabspark.llm.encoder import encoder
from tabspark.llm.packing import TOKENIZER


def lines(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the lines, which cover the text."""
    sizes = [len(x) + 1 for x in (text or "").split("\n")]
    sizes[-1] -= 1
    if sizes[-1] == 0 and len(sizes) > 1:
        sizes.pop()
    ends = np.cumsum(sizes)
    return ends - sizes, ends


def allot(first: np.ndarray, end: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """The section of each token (-1: none), and whether the token also has characters outside of it."""
    if not len(starts):
        return np.full(len(first), -1), np.ones(len(first), bool)
    reach = lambda at: np.maximum(np.minimum(end, ends[at]) - np.maximum(first, starts[at]), 0)
    at = np.searchsorted(starts, first, "right") - 1
    home = np.where((at >= 0) & (first < ends[np.maximum(at, 0)]), at, -1)
    if rule == "most":
        last = np.searchsorted(starts, end, "left") - 1
        most = np.where(home >= 0, reach(np.maximum(home, 0)), 0)
        for step in range(1, int((last - at).max(initial=0)) + 1):
            other = np.minimum(np.maximum(at, -1) + step, len(starts) - 1)
            size = np.where(at + step <= last, reach(other), 0)
            home, most = np.where(size > most, other, home), np.maximum(size, most)
    return home, np.where(home >= 0, reach(np.maximum(home, 0)) < end - first, True)


def attribute(docs: DataFrame, sections: str | None = None, key: str = "doc_id", text: str = "text", rule: str = "most",
              tokenizer: str = vocabulary_file(TOKENIZER)) -> DataFrame:
    """key, section (from 0), start, end, n_tokens, n_crossing (of these, tokens that cross its boundary); one row per section. No shuffle."""
    if rule not in ("first", "most"):
        raise ValueError(f"no such rule: {rule}")
    ship(docs.sparkSession)
    with open(tokenizer, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    names = ["key", "section", "start", "end", "n_tokens", "n_crossing"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(spec.value)
        for rows in batches:
            for some in slices(rows, "text"):
                texts, owner, found = some.column("text").to_pylist(), [], []
                given = some.column("sections").to_pylist() if sections else [None] * len(texts)
                for i, (t, (first, end), cuts) in enumerate(zip(texts, encode.located(texts), given)):
                    if sections:
                        cuts = [(c["start"], c["end"]) for c in cuts or [] if c]
                        starts, ends = np.array([c[0] for c in cuts], "i8"), np.array([c[1] for c in cuts], "i8")
                    else:
                        starts, ends = lines(t)
                    home, over = allot(first, end, starts, ends, rule)
                    n = np.bincount(home + 1, minlength=len(starts) + 1)
                    crossing = np.bincount((home + 1)[over], minlength=len(starts) + 1)
                    skip = 0 if n[0] else 1
                    table = np.stack([np.arange(-1, len(starts)), np.append(-1, starts), np.append(-1, ends), n, crossing])[:, skip:]
                    owner.append(np.full(table.shape[1], i))
                    found.append(table)
                table = np.concatenate(found, axis=1)
                yield pa.RecordBatch.from_arrays([some.column("key").take(pa.array(np.concatenate(owner))), pa.array(table[0].astype("i4")), *(pa.array(c) for c in table[1:])], names)

    kind = docs.schema[key].dataType.simpleString()
    columns = [F.col(key).alias("key"), F.col(text).alias("text")] + ([F.col(sections).alias("sections")] if sections else [])
    return docs.select(*columns).mapInArrow(work, f"key {kind}, section int, start bigint, end bigint, n_tokens bigint, n_crossing bigint").withColumnRenamed("key", key)


def op3_token_counts(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return attribute(docs)

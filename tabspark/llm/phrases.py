"""Collocations from vertically partitioned suffix trees.

The suffixes of all pieces, cut off after `LONGEST` words, form one tree per language. It is partitioned by prefixes so that no
part holds more suffixes than a budget: a word's frequency is the number of suffixes below it, so a first count of words
tells which prefixes fit. Suffixes whose first word fits go to that word's group. Those of a word beyond the budget are
parted by their second word if that one fits (no more suffixes begin with the pair than the second word has occurrences), and
else by the whole suffix, which is a single leaf. Groups gather prefixes up to the budget, and each builds its subtree alone: leaves are summed
and sorted, change masks mark the nodes, and inner counts are sums over leaves. Only pairs of two words beyond the budget
have leaves in several groups; their partial counts are added.

Tasks fold equal suffixes before they send them. A phrase that holds a word rarer than the least count cannot be a candidate, so
such words end a suffix; they are known by a bitmap of hashes that never takes more than `BITS` (where it is too small, rare
words stay, and nothing else changes).

Defined results: null and empty texts have no words; a null language is `und`; repeated rows count each; an empty table gives no
row; other columns are ignored. Case is folded for A-Z only. Words are compared by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tabspark.llm.common import settled, ship, slices

LEAST, LONGEST, INSIDE, BEST = 10, 3, 50, 2000
BUDGET, BITS, FOLD_BYTES, PARTITIONS = 400_000, 1 << 24, 4_000_000, 10_000
#: What ends a piece, and the letters that are folded. `.` ends pieces, so no word holds it.
PIECE_ENDS = b".,;:!?\n\v\f\r"
FOLD = bytes.maketrans(PIECE_ENDS + b"\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"." * len(PIECE_ENDS) + b" abcdefghijklmnopqrstuvwxyz")
GAP = b"."


def words_by_language(rows: pa.RecordBatch) -> Iterator[tuple[str, pa.Array, np.ndarray]]:
    """language, its distinct words, and all words in order as places in them; -1 between pieces and texts."""
    texts: dict[str, list[bytes]] = {}
    for lang, text in zip(rows.column("lang").to_pylist(), rows.column("text").to_pylist()):
        texts.setdefault(lang, []).append(text)
    for lang, parts in texts.items():
        whole = pa.array([GAP.join(parts).translate(FOLD).replace(GAP, b" . ")], pa.large_binary())
        tokens = pc.split_pattern(whole, pattern=" ").flatten()
        coded = tokens.filter(pc.greater(pc.binary_length(tokens), 0)).cast(pa.binary()).dictionary_encode()
        codes, distinct = coded.indices.to_numpy().astype("i8"), coded.dictionary
        gap = pc.index(distinct, pa.scalar(GAP, pa.binary())).as_py()
        if gap >= 0:
            codes[codes == gap] = -1
        yield lang, distinct, codes


def read(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text")).filter("octet_length(text) > 0")


def folded(rows: list[pa.RecordBatch], keys: list[str]) -> pa.Table:
    return pa.Table.from_batches(rows).group_by(keys).aggregate([("f", "sum")]).rename_columns([*keys, "f"])


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, word, f: every word's occurrences."""
    ship(docs.sparkSession)
    names, most = ["lang", "word", "f"], 400_000

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for rows in (some for whole in batches for some in slices(whole, "text", FOLD_BYTES)):
            for language, distinct, codes in words_by_language(rows):
                counts = np.bincount(codes[codes >= 0], minlength=len(distinct))
                some = np.flatnonzero(counts)
                held.append(pa.RecordBatch.from_arrays([pa.array([language] * len(some), pa.string()), distinct.take(pa.array(some)), pa.array(counts[some], pa.int64())], names))
                size += len(some)
            if size > most:
                whole = folded(held, names[:2])
                held, size = whole.combine_chunks().to_batches(), whole.num_rows
                if size > most // 2:
                    yield from held
                    held, size = [], 0
        yield from held

    partial = read(docs, text, lang).mapInArrow(work, "lang string, word binary, f bigint")
    return settled(partial.groupBy("lang", F.col("word").cast("string").alias("word")).agg(F.sum("f").alias("f")), "words")


def spot(lang: Column, word: Column, bits: int) -> Column:
    return F.crc32(F.concat(lang.cast("binary"), F.lit(b"\n"), word.cast("binary"))) % bits


class Marks:
    """Which words have at least some count: a bitmap of their hashes, eight bits a word or more until `most_bits`. Other words may share a place."""

    def __init__(self, words: DataFrame, least: int, most_bits: int):
        often = words.filter(F.col("f") >= least)
        n, self.bits = often.count(), min(most_bits, 1 << 16)
        while self.bits < min(most_bits, 8 * n):
            self.bits *= 2
        place = F.crc32(F.concat(F.col("lang").cast("binary"), F.lit(b"\n"), F.col("word").cast("binary"))) % self.bits
        blocks = often.select(place.alias("h")).groupBy(F.expr("h div 32").alias("block")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(h % 32 AS INT))")).alias("mask"))
        found = np.array([tuple(r) for r in blocks.collect()], "i8").reshape(-1, 2)  # at most bits / 32 rows
        self.masks = np.zeros(self.bits // 32, "<u4")
        self.masks[found[:, 0]] = found[:, 1]

    def __getitem__(self, hashes: np.ndarray) -> np.ndarray:
        spots = hashes % np.uint64(self.bits)
        return (self.masks[spots >> np.uint64(5)] >> (spots & np.uint64(31)).astype("u4")) & 1 == 1


def hashed(lang: str, words: pa.Array) -> np.ndarray:
    start = crc32(lang.encode() + b"\n")
    return np.fromiter((crc32(w, start) for w in words.to_pylist()), "u8", len(words))


def suffixes(docs: DataFrame, words: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, budget: int = BUDGET, most_bits: int = BITS) -> tuple[DataFrame, int, Marks]:
    """grp, lang, w1, w2, ... (null past a piece's end or at a rare word), f: suffixes of two words or more, cut off at `longest`, folded within tasks;
    the number of groups; and the marks of words beyond the budget."""
    spark = docs.sparkSession
    total = words.filter(F.col("f") >= least).agg(F.sum("f")).first()[0] or 0
    groups = int(total // budget) + 1
    known = spark.sparkContext.broadcast((Marks(words, least, most_bits), Marks(words, budget + 1, most_bits)))
    names = ["grp", "lang", *(f"w{i}" for i in range(1, longest + 1)), "f"]

    def group_of(hashes: np.ndarray, warm: np.ndarray, grams: np.ndarray) -> np.ndarray:
        """The group by the first word; by more words as long as those before are beyond the budget."""
        mixed = hashes[grams[:, 0]].astype("u8")
        deeper = warm[grams[:, 0]]
        for j in range(1, longest):
            there = deeper & (grams[:, j] >= 0)
            mixed[there] = mixed[there] * np.uint64(0x9E3779B97F4A7C15) + hashes[grams[there, j]] + np.uint64(1)
            deeper = there & warm[grams[:, j]]
        return ((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(groups)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, hot = known.value
        for rows in (some for whole in batches for some in slices(whole, "text", FOLD_BYTES)):
            for language, distinct, codes in words_by_language(rows):
                hashes = hashed(language, distinct)
                alive, warm = often[hashes], hot[hashes]
                codes = np.append(np.where((codes >= 0) & alive[codes], codes, -1), [-1] * longest)
                columns = [codes[:len(codes) - longest]]
                for j in range(1, longest):
                    columns.append(np.where(columns[-1] >= 0, codes[j:len(codes) - longest + j], -1))
                kept = columns[1] >= 0  # single words are counted already
                width = np.int64(len(distinct) + 1)
                key = columns[0][kept]
                if float(width) ** longest < 2 ** 62:
                    for c in columns[1:]:
                        key = key * width + c[kept] + 1
                    key, counts = np.unique(key, return_counts=True)
                    grams = []
                    for _ in columns[1:]:
                        grams.append(key % width - 1)
                        key = key // width
                    grams = np.stack([key, *grams[::-1]], 1)
                else:
                    grams, counts = np.unique(np.stack([c[kept] for c in columns], 1), axis=0, return_counts=True)
                if not len(grams):
                    continue
                group = group_of(hashes, warm, grams)
                for a in range(0, len(grams), 50_000):
                    some = grams[a:a + 50_000]
                    taken = [distinct.take(pa.array(some[:, j], mask=some[:, j] < 0)) for j in range(longest)]
                    yield pa.RecordBatch.from_arrays([pa.array(group[a:a + 50_000].astype("i4")), pa.array([language] * len(some), pa.string()), *taken, pa.array(counts[a:a + 50_000], pa.int64())], names)

    schema = "grp int, lang string, " + ", ".join(f"w{i} binary" for i in range(1, longest + 1)) + ", f bigint"
    return read(docs, text, lang).mapInArrow(work, schema), groups, known.value[1]


def hot_words(langs: pa.Array, words: pa.Array, places: np.ndarray, hot: Marks) -> np.ndarray:
    """Whether each (language, word), given by places in the two arrays, is marked as beyond the budget."""
    marks = np.array([np.append(hot[hashed(lang, words)], False) for lang in langs.to_pylist()])
    return marks[places[0], places[1]]


def subtree(rows: pa.Table, longest: int, least: int, hot: Marks) -> Iterator[tuple[int, list[pa.Array], np.ndarray]]:
    """depth, words and counts of the inner nodes and leaves of one group, from depth 2 on: those with the least count, and all of the
    inner nodes whose words are beyond the budget, as other groups hold leaves of theirs."""
    coded = [rows.column(c).combine_chunks() for c in ["lang", *(f"w{i}" for i in range(1, longest + 1))]]
    coded = [c.dictionary_encode() for c in coded]
    matrix = np.stack([c.indices.fill_null(-1).to_numpy().astype("i8") for c in coded])
    order = np.lexsort(matrix[::-1])
    matrix, counts = matrix[:, order], rows.column("f").to_numpy()[order]
    change, warm = np.zeros(len(order), bool), np.zeros(len(order), bool)
    change[0] = True
    for depth, column in enumerate(matrix):
        change[1:] |= column[1:] != column[:-1]
        if depth == 1:
            warm[:] = hot_words(coded[0].dictionary, coded[1].dictionary, matrix[:2], hot)
        if depth < 2:
            continue
        if depth < longest:
            warm &= hot_words(coded[0].dictionary, coded[depth].dictionary, matrix[[0, depth]], hot)
        starts = np.flatnonzero(change)
        sums, there = np.add.reduceat(counts, starts), column[starts] >= 0
        there &= sums >= least if depth == longest else (sums >= least) | warm[starts]
        starts, sums = starts[there], sums[there]
        yield depth, [c.dictionary.take(pa.array(m[starts])) for c, m in zip(coded[:depth + 1], matrix)], sums


def phrase_counts(docs: DataFrame, words: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, budget: int = BUDGET, most_bits: int = BITS) -> DataFrame:
    """lang, w1, w2, ..., f of every phrase of two words or more that occurs at least `least` times."""
    leaves, groups, hot = suffixes(docs, words, text, lang, least, longest, budget, most_bits)
    names, known = ["lang", *(f"w{i}" for i in range(1, longest + 1)), "f"], docs.sparkSession.sparkContext.broadcast(hot)

    def nodes(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(rows)
        for depth, taken, sums in subtree(whole, longest, least, known.value):
            nothing = [pa.nulls(len(sums), pa.binary())] * (longest - depth)
            yield from pa.Table.from_arrays([*taken, *nothing, pa.array(sums, pa.int64())], names).to_batches(max_chunksize=50_000)
        pa.default_memory_pool().release_unused()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group = [], None
        for rows in batches:
            marks = rows.column("grp").to_numpy()
            cuts = np.flatnonzero(np.diff(marks)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(marks)]):
                if held and marks[a] != group:
                    yield from nodes(held)
                    held = []
                group = marks[a]
                held.append(rows.slice(a, b - a))
        if held:
            yield from nodes(held)

    schema = "lang string, " + ", ".join(f"w{i} binary" for i in range(1, longest + 1)) + ", f bigint"
    partial = leaves.repartition(min(groups, PARTITIONS), "grp").sortWithinPartitions("grp").mapInArrow(work, schema)
    # pairs of two words beyond the budget have parts in several groups; every other count is whole and at most waits for one sum
    text_words = [F.col(f"w{i}").cast("string").alias(f"w{i}") for i in range(1, longest + 1)]
    return settled(partial.groupBy("lang", *text_words).agg(F.sum("f").alias("f")).filter(F.col("f") >= least), "phrases")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, inside: int = INSIDE, best: int | None = BEST,
                 budget: int = BUDGET, most_bits: int = BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: phrases of 2 or 3 words, by the score of their weakest cut; those within a longer
    candidate that has at least `inside` percent of their occurrences are left out. `best` None keeps all."""
    words = word_counts(docs, text, lang)
    phrases = phrase_counts(docs, words, text, lang, least, 3, budget, most_bits)
    pairs, triples = phrases.filter("w3 IS NULL").select("lang", "w1", "w2", F.col("f").alias("a")), phrases.filter("w3 IS NOT NULL").withColumnRenamed("f", "a")

    def counted(df: DataFrame, known: DataFrame, spots: list[str], name: str) -> DataFrame:
        """With the count of the words at `spots`."""
        at = known.toDF("lang_", *(f"k{i}" for i in range(len(spots))), name)
        on = [F.col("lang") == F.col("lang_"), *(F.col(w) == F.col(f"k{i}") for i, w in enumerate(spots))]
        return df.join(at, on).drop(*at.columns[:-1])

    often = words.filter(F.col("f") >= least)
    held = triples.selectExpr("lang", "a AS longer", "inline(array(struct(w1 AS w1, w2 AS w2), struct(w2 AS w1, w3 AS w2)))").groupBy("lang", "w1", "w2").agg(F.max("longer").alias("longer"))
    two = counted(counted(pairs.join(held, ["lang", "w1", "w2"], "left").filter(f"longer IS NULL OR 100 * CAST(longer AS DECIMAL(20, 0)) < {int(inside)} * CAST(a AS DECIMAL(20, 0))"),
                          often, ["w1"], "l1"), often, ["w2"], "r1").selectExpr("lang", "concat_ws(' ', w1, w2) AS phrase", "a", "l1", "r1", "l1 AS l2", "r1 AS r2")
    three = counted(counted(counted(counted(triples, often, ["w1"], "l1"), pairs, ["w2", "w3"], "r1"), pairs, ["w1", "w2"], "l2"), often, ["w3"], "r2")
    three = three.selectExpr("lang", "concat_ws(' ', w1, w2, w3) AS phrase", "a", "l1", "r1", "l2", "r2")
    wide = "CAST({} AS DECIMAL(19, 0))".format
    score = f"({wide('a')} * {wide('a')} * 1000000BD) div ({wide('{l}')} * {wide('{r}')})"
    scored = two.unionByName(three).selectExpr("*", f"{score.format(l='l1', r='r1')} AS s1", f"{score.format(l='l2', r='r2')} AS s2")
    scored = scored.selectExpr("lang", "phrase", "a", "if(s2 < s1, l2, l1) AS l", "if(s2 < s1, r2, r1) AS r", "least(s1, s2) AS score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("bigint"))
    if best is not None:
        ranked = ranked.filter(F.col("rank") <= best)
    sizes = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark: SparkSession, documents: DataFrame) -> DataFrame:
    return collocations(documents)

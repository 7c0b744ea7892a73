"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's likelihood is the sum, over all
ways to cut it into pieces, of the product of piece probabilities; the forward algorithm gives it in one sweep. The
probabilities are learned by expectation-maximisation (forward-backward) over the words of labelled documents.

Defined results: null texts and texts without a letter are `und` with score 0; a tie goes to the first language in
alphabetical order; without any labelled text everything is `und`; repeated rows are scored one by one; other columns
of the input are ignored. Texts are read whole. Runs of more than RUN letters (scripts without spaces, junk) are cut every
RUN letters, and the parts are scored on their own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabspark.llm.common import batch, remainder, settled, share, ship, slices, sweep, tidied, vocabulary_file, written_so_far

PIECES = "piece_bpe_32k.model"
#: Longest piece used, in characters, and longest run of letters that is scored in one go.
LONGEST, RUN = 8, 32
#: Probability of a character that is no piece of the vocabulary, alike in every language.
UNKNOWN = 1e-7
#: Words whose scores a worker keeps at hand; the cache starts anew when full.
REMEMBERED = 150_000
#: Bits a letter beyond which a text is taken to be in none of the learned languages.
FOREIGN_BITS = 14.0
WORD = re.compile(r"[^\W\d_]+")
START = "▁"
STEP = np.uint64(0x9E3779B97F4A7C15)


def vocabulary(path: str = vocabulary_file(PIECES)) -> list[str]:
    """The lower-case letter pieces of the public vocabulary, of up to LONGEST characters, with or without the mark of a word's start."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    fits = (p for p in pieces if len(p) <= LONGEST and p == p.lower() and (WORD.fullmatch(p.removeprefix(START)) or p == START))
    return sorted(set(fits))


def words_of(text: str | None) -> list[str]:
    """Lower-case runs of letters, long ones in parts; empty if there is no letter."""
    found = WORD.findall(text.lower()) if text else []
    if not any(map(str.isalpha, found)):
        return []
    if max(map(len, found)) > RUN:
        found = [w[i:i + RUN] for w in found for i in range(0, len(w), RUN)]
    return found


def _keys(codes: np.ndarray) -> np.ndarray:
    """One 64-bit key per row of character codes."""
    key = np.zeros(len(codes), "u8")
    for c in codes.T:
        key = (key + c + np.uint64(1)) * STEP
        key ^= key >> np.uint64(29)
    return key


def _codes(words: list[str], length: int) -> np.ndarray:
    return np.array(words, f"<U{length}").view("u4").reshape(len(words), length).astype("u8")


class Lattice:
    """All pieces of words of one length, as rows of the probability table."""

    def __init__(self, pieces: list[str]):
        keys = np.concatenate([_keys(_codes([p for p in pieces if len(p) == n], n)) for n in sorted({len(p) for p in pieces})] or [np.zeros(0, "u8")])
        rows = np.concatenate([[i for i, p in enumerate(pieces) if len(p) == n] for n in sorted({len(p) for p in pieces})] or [np.zeros(0)]).astype("i8")
        order = np.argsort(keys)
        self.keys, self.rows, self.size = keys[order], rows[order], len(pieces)

    def of(self, words: list[str], length: int) -> dict[tuple[int, int], np.ndarray]:
        """(start, end) -> row of the table per word; `size` for no piece, `size` + 1 for a character without one."""
        codes, out = _codes(words, length), {}
        for i in range(length):
            key = np.zeros(len(words), "u8")
            for j in range(i, min(length, i + LONGEST)):
                key = (key + codes[:, j] + np.uint64(1)) * STEP
                key ^= key >> np.uint64(29)
                at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
                hit = self.keys[at] == key if len(self.keys) else np.zeros(len(words), bool)
                out[i, j + 1] = np.where(hit, self.rows[at] if len(self.keys) else 0, self.size + (j == i))
        return out


def by_length(words: list[str]) -> Iterator[tuple[int, list[int], list[str]]]:
    """Words, marked at their start, by length, at most 4096 at a time."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w) + 1, []).append(i)
    for length, every in sorted(groups.items()):
        for k in range(0, len(every), 4096):
            some = every[k:k + 4096]
            yield length, some, [START + words[i] for i in some]


def _forward(cells, table, n, length):
    ahead = np.zeros((length + 1, n, table.shape[1]))
    ahead[0] = 1
    for j in range(1, length + 1):
        for i in range(max(0, j - LONGEST), j):
            ahead[j] += ahead[i] * table[cells[i, j]]
    return ahead


@dataclass
class LanguageModel:
    """Learned languages, the vocabulary, and one row of piece probabilities per piece (vocabulary x languages, bounded by both)."""

    languages: list[str]
    pieces: list[str]
    probability: np.ndarray

    def table(self) -> np.ndarray:
        wide = np.zeros((len(self.pieces) + 2, len(self.languages)))
        wide[:-2], wide[-1] = self.probability, UNKNOWN
        return wide

    def log_likelihood(self, words: list[str], lattice: Lattice | None = None, table: np.ndarray | None = None) -> np.ndarray:
        """Log of the sum over all segmentations, a row per word and a column per language."""
        lattice, table = lattice or Lattice(self.pieces), self.table() if table is None else table
        out = np.zeros((len(words), len(self.languages)))
        for length, where, marked in by_length(words):
            out[where] = np.log(_forward(lattice.of(marked, length), table, len(marked), length)[length])
        return out

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece by language, over words seen `counts` (words x languages) times."""
        lattice, table = Lattice(self.pieces), self.table()
        total = np.zeros_like(table)
        for length, where, marked in by_length(words):
            cells = lattice.of(marked, length)
            ahead = _forward(cells, table, len(marked), length)
            back = np.zeros_like(ahead)
            back[length] = counts[where] / ahead[length]
            for i in range(length - 1, -1, -1):
                for j in range(i + 1, min(length, i + LONGEST) + 1):
                    step = table[cells[i, j]] * back[j]
                    back[i] += step
                    for k in range(len(self.languages)):
                        total[:, k] += np.bincount(cells[i, j], ahead[i][:, k] * step[:, k], len(table))
        return total[:-2]


def _word_counts(languages: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word", pa.string()), ("lang", pa.int32()), ("n", pa.int64())])
        seen: Counter = Counter()

        def out():
            return batch(schema, word=[w for w, _ in seen], lang=[k for _, k in seen], n=list(seen.values()))

        for rows in batches:
            for text, lang in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                k = languages.index(lang)
                seen.update((w, k) for w in words_of(text))
                if len(seen) > 200_000:
                    yield out()
                    seen.clear()
        yield out()

    return work


def _expectation(model: LanguageModel):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("piece", pa.int32()), ("uses", pa.list_(pa.float64()))])
        total = np.zeros_like(model.probability)
        for rows in batches:
            counts = np.zeros((len(rows), len(model.languages)))
            for k in range(len(model.languages)):
                counts[:, k] = rows.column(k + 1).to_numpy(zero_copy_only=False)
            total += model.expected(rows.column(0).to_pylist(), counts)
        used = np.flatnonzero(total.sum(1))
        yield batch(schema, piece=used, uses=[list(total[i]) for i in used])

    return work


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", pieces: list[str] | None = None,
          per_language: int = 2000, rounds: int = 2, smoothing: float = 200.0) -> LanguageModel:
    """Piece probabilities of every language in `docs`.

    Fits on a sample of about `per_language` documents of each language, drawn by a hash of the key; whole texts are used. What reaches
    the driver is one row per piece of the vocabulary.
    """
    ship(docs.sparkSession)
    pieces = vocabulary() if pieces is None else pieces
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    flat = np.full((len(pieces), max(len(languages), 1)), 1 / max(len(pieces), 1))
    model = LanguageModel(languages, pieces, flat[:, :len(languages)])
    if not languages:
        return model
    chosen = F.lit(0.0)
    for name, n in sizes.items():
        chosen = F.when(F.col("lang") == name, F.lit(per_language / n)).otherwise(chosen)
    sample = docs.filter(share("key", 71) < chosen).select("text", "lang")
    counted = sample.mapInArrow(_word_counts(languages), "word string, lang int, n bigint").groupBy("word").agg(
        *[F.sum(F.when(F.col("lang") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(len(languages))])
    since = written_so_far()
    counted = settled(counted, "words")
    for _ in range(rounds):
        uses = counted.repartition(docs.sparkSession.sparkContext.defaultParallelism).mapInArrow(_expectation(model), "piece int, uses array<double>")
        sums = uses.groupBy("piece").agg(*[F.sum(F.col("uses")[k]).alias(f"u{k}") for k in range(len(languages))]).collect()
        count = np.zeros_like(model.probability)
        for r in sums:
            count[r["piece"]] = r[1:]
        pooled = 0.9 * count.sum(1) / max(count.sum(), 1) + 0.1 / max(len(pieces), 1)
        model = LanguageModel(languages, pieces, (count + smoothing * pooled[:, None]) / (count.sum(0) + smoothing * pooled.sum()))
    sweep(docs.sparkSession, since)
    return model


class Scorer:
    """Scores texts one after another with a bounded memory of words."""

    def __init__(self, model: LanguageModel):
        self.model, self.lattice, self.table = model, Lattice(model.pieces), model.table()
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)))

    def texts(self, texts: list[str | None]) -> list[tuple[str, float, float | None]]:
        """Language, posterior and bits a letter of each text."""
        every = [words_of(t) for t in texts]
        new = list(dict.fromkeys(w for words in every for w in words if w not in self.known))
        if len(self.known) + len(new) > REMEMBERED:
            self.known, self.scores = {}, self.scores[:0]
            new = list(dict.fromkeys(w for words in every for w in words))
        self.scores = np.concatenate([self.scores, self.model.log_likelihood(new, self.lattice, self.table)])
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        out = []
        for words in every:
            if not words or not self.model.languages:
                out.append(("und", 0.0, None))
                continue
            total = self.scores[np.fromiter(map(self.known.__getitem__, words), "i8", len(words))].sum(0)
            best = int(total.argmax())
            bits = -total[best] / np.log(2) / sum(map(len, words))
            out.append((self.model.languages[best], float(1 / np.exp(total - total[best]).sum()), float(bits)))
        return out


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, lang_pred, score (posterior under equal priors) and bits (per letter, null for `und`) of every row. One pass, no shuffle."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for rows in batches:
            for part in slices(rows, "text"):
                got = scorer.texts(part.column("text").to_pylist())
                columns = [part.column("key"), pa.array([g[0] for g in got]), pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "lang_pred", "score", "bits"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(
        tidied(work), f"key {kind}, lang_pred string, score double, bits double").withColumnRenamed("key", key)


def accepted(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text is in one of the learned languages: not `und`, at most FOREIGN_BITS bits a letter."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for rows in batches:
            for part in slices(rows, text):
                got = scorer.texts(part.column(text).to_pylist())
                yield part.filter(pa.array([g[2] is not None and g[2] <= FOREIGN_BITS for g in got], pa.bool_()))

    return docs.mapInArrow(tidied(work), docs.schema)


def held_out(key: str = "doc_id"):
    """Documents never learned from: crc32 of the id as text is a multiple of 5 (or the id is null)."""
    return F.coalesce(remainder(key, 5) == 0, F.lit(True))


def op1_language_id(spark: SparkSession, docs: DataFrame) -> DataFrame:
    model = learn(docs.filter(~held_out()))
    return identify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits")

"""Secrets in texts: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Two first-order Markov models over the characters of ALPHABET are trained from labelled samples: random strings (values that the
patterns find in a sample of documents, and GENERATED digests written as hex and base64) and ordinary identifiers (words of a sample of
documents outside of such values). A long token with a digit, outside of the patterns' spans, is a secret if its log-likelihood ratio
is above CUT nats a character. DataFrame functions only; one pass over the texts, no shuffle but for the models' counts.

Defined results: a null text is empty; positions are code points, ends exclusive; matches of a kind are leftmost and do not overlap; spans are ordered by
start, kind, end; repeated rows are scanned one by one; texts are read whole; without any sample the models rest on the generated strings; other columns
are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabspark.llm.common import bound, scanned, share

#: Kinds of secrets in their order, each with its pattern, the group that must be long enough, and the least length.
PATTERNS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
#: Patterns that give the same matches as those above after short ones are dropped, without visiting each short run.
QUICK = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
KINDS = [*PATTERNS, "markov"]
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN, SHORTEST = "[A-Za-z0-9+/_=-]", 20
#: Nats a character that a token must be likelier as a random string.
CUT = 0.5
GENERATED, SMOOTHING = 2000, 1.0
#: Characters of a block of a text, from which the pieces between secrets are cut.
BLOCK = 16_384
SPAN = "array<struct<start:int,kind:int,end:int>>"


def matches(text: Column, pattern: str) -> Column:
    """Spans (start, end, token) of all matches, from the lengths of what lies between them."""
    pairs = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1), lambda f, gap: F.struct(F.length(gap).alias("gap"), f.alias("token")))

    def step(at: Column, pair: Column) -> tuple[Column, Column]:
        start = at + pair["gap"]
        end = start + F.length(pair["token"])
        return end, F.struct(start.alias("start"), end.alias("end"), pair["token"].alias("token"))

    return scanned(F.filter(pairs, lambda p: p["token"].isNotNull()), F.lit(0), step, "struct<start:int,end:int,token:string>")


def _of_kind(text: Column, kind: str) -> Column:
    pattern, group, least = PATTERNS[kind]
    quick, spans = QUICK.get(kind, pattern), matches(text, QUICK.get(kind, pattern))
    if kind not in QUICK:
        sized = F.zip_with(spans, F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda s, value: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.length(value).alias("size")))
        spans = F.filter(sized, lambda s: s["size"] >= least)
    spans = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")))
    return F.when(text.rlike(quick), spans).otherwise(F.array().cast(SPAN))


def _patterned(text: Column) -> Column:
    """Spans of the fixed patterns, each with the number of its kind."""
    return F.array_sort(F.concat(*[_of_kind(text, kind) for kind in PATTERNS]))


def _long_tokens(text: Column) -> Column:
    pattern = f"{TOKEN}{{{SHORTEST},}}"
    return F.when(text.rlike(pattern), F.filter(matches(text, pattern), lambda t: t["token"].rlike("[0-9]"))).otherwise(F.array().cast("array<struct<start:int,end:int,token:string>>"))


def _apart(tokens: Column, spans: Column) -> Column:
    """The tokens that overlap none of the spans, by one sweep from either end."""
    mark = lambda x, own, token: F.struct(x["start"].alias("start"), F.lit(own).alias("own"), x["end"].alias("end"), token.alias("token"), F.lit(True).alias("clear"))
    marks = F.array_sort(F.concat(F.transform(spans, lambda s: mark(s, 0, F.lit(""))), F.transform(tokens, lambda t: mark(t, 1, t["token"]))))
    kind = "struct<start:int,own:int,end:int,token:string,clear:boolean>"

    def seen(m: Column, clear: Column) -> Column:
        return F.struct(m["start"].alias("start"), m["own"].alias("own"), m["end"].alias("end"), m["token"].alias("token"), (m["clear"] & clear).alias("clear"))

    ended = scanned(marks, F.lit(0), lambda last, m: (F.when(m["own"] == 0, F.greatest(last, m["end"])).otherwise(last), seen(m, last <= m["start"])), kind)
    begun = scanned(F.reverse(ended), F.lit((1 << 31) - 1), lambda next_, m: (F.when(m["own"] == 0, m["start"]).otherwise(next_), seen(m, next_ >= m["end"])), kind)
    return F.filter(begun, lambda m: (m["own"] == 1) & m["clear"])


def _pairs(tokens: DataFrame) -> DataFrame:
    """How often each pair of neighbouring characters stands in the distinct `token`s."""
    letters = tokens.distinct().filter(F.length("token") >= 2).select(F.split("token", "").alias("letters"))
    pairs = F.zip_with(F.slice("letters", F.lit(1), F.size("letters") - 1), F.slice("letters", F.lit(2), F.size("letters") - 1), lambda a, b: F.concat(a, b))
    return letters.select(F.explode(pairs).alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", rows: int = 20_000, ordinary_rows: int = 1_000) -> list[float]:
    """Log ratio of the two models for every pair of characters, row by row of ALPHABET.

    Random strings come from about `rows` documents, ordinary identifiers from about `ordinary_rows`, both drawn by a hash of the
    key. What reaches the driver is one number per pair of characters and model.
    """
    spark = docs.sparkSession
    n = max(docs.select(key).count(), 1)
    docs = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"), share(key, 29).alias("share"))
    found = docs.filter(F.col("share") < rows / n).select("text", F.explode(_patterned(F.col("text"))).alias("s"))
    value = F.regexp_extract(F.expr("substring(text, s.start + 1, s.end - s.start)"), f"({TOKEN}+)$", 1)
    digests = spark.range(GENERATED).select(F.sha2(F.col("id").cast("string"), 256).alias("hex"))
    random = found.select(value.alias("token")).union(digests.select(F.substring("hex", 1, 40))).union(digests.select(F.base64(F.unhex("hex")).substr(1, 43)))
    anything = "|".join(f"(?:{QUICK.get(k, p[0])})" for k, p in PATTERNS.items())
    plain = docs.filter(F.col("share") < ordinary_rows / n).select(F.regexp_replace("text", anything, " ").alias("text"))
    ordinary = plain.select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-z][A-Za-z0-9_-]{3,}"), F.lit(0))).alias("token"))
    logs = []
    for tokens in (random, ordinary):
        counts = {r["pair"]: r["n"] for r in _pairs(tokens).collect()}
        table = [[counts.get(a + b, 0) + SMOOTHING for b in ALPHABET] for a in ALPHABET]
        logs.append([math.log(c / sum(row)) for row in table for c in row])
    return [a - b for a, b in zip(*logs)]


def _ratio(token: Column, table: Column) -> Column:
    """Mean log ratio a step from character to character."""
    def add(done: Column, letter: Column) -> Column:
        place = F.instr(F.lit(ALPHABET), letter)
        ratio = F.when(done["last"] > 0, F.get(table, (done["last"] - 1) * len(ALPHABET) + place - 1)).otherwise(0.0)
        return F.struct(place.alias("last"), (done["sum"] + ratio).alias("sum"))

    zero = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(F.split(token, ""), zero, add)["sum"] / (F.length(token) - 1)


def scan(docs: DataFrame, model: list[float], text: str = "text") -> DataFrame:
    """The rows with `base` and `spans`: arrays of (start, kind as its number in KINDS, end), of the patterns and of all."""
    table = F.array(*[F.lit(x) for x in model])
    found = docs.withColumns({"base": _patterned(F.coalesce(F.col(text), F.lit(""))), "long": _long_tokens(F.coalesce(F.col(text), F.lit("")))})
    random = F.filter(_apart(F.col("long"), F.col("base")), lambda t: _ratio(t["token"], table) > CUT)
    added = F.transform(random, lambda t: F.struct(t["start"].alias("start"), F.lit(KINDS.index("markov")).alias("kind"), t["end"].alias("end")))
    return found.withColumn("spans", F.when(F.size("long") == 0, F.col("base")).otherwise(F.array_sort(F.concat("base", added)))).drop("long")


def written_out(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by the mark. Pieces are cut from blocks of the text, not from its beginning."""
    def step(at: Column, s: Column) -> tuple[Column, Column]:
        return F.greatest(at, s["end"]), F.struct(at.alias("from"), s["start"].alias("to"), s["end"].alias("end"))

    def piece(blocks: Column, start: Column, end: Column) -> Column:
        first, last = F.floor(start / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")
        return F.substring(F.array_join(F.slice(blocks, first + 1, last - first + 1), ""), start - first * BLOCK + 1, end - start)

    def joined(blocks: Column) -> Column:
        gaps = F.filter(scanned(spans, F.lit(0), step, "struct<from:int,to:int,end:int>"), lambda g: g["to"] >= g["from"])
        return F.array_join(F.transform(gaps, lambda g: F.concat(piece(blocks, g["from"], g["to"]), F.lit(mark))), "")

    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / BLOCK).cast("int")), lambda b: F.substring(text, b * BLOCK + 1, F.lit(BLOCK)))
    end = F.array_max(F.transform(spans, lambda s: s["end"]))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(bound(blocks, joined), F.substring(text, end + 1, F.length(text))))


def without_secrets(docs: DataFrame, model: list[float], text: str = "text", size: str | None = None) -> DataFrame:
    """The rows with all their columns, secrets replaced by a mark; `size` names a column that holds the text's length and follows it."""
    found = scan(docs.select(F.struct("*").alias("row"), F.col(text).alias("text")), model)
    found = found.withColumn("clean", redacted(F.col("text"), F.col("spans")))
    length = lambda: F.length("clean").cast(docs.schema[size].dataType)
    return found.select(*[(F.col("clean") if c == text else length() if c == size else F.col("row")[c]).alias(c) for c in docs.columns])


def op9_secrets(spark: SparkSession, docs: DataFrame) -> DataFrame:
    found = scan(docs.select("doc_id", "text"), learn(docs))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{KINDS[k]}")
    return found.select("doc_id", count(0), count(1), count(2), F.sha2(written_out(F.col("base")), 256).alias("base_sha256"), written_out(F.col("spans")).alias("spans"))

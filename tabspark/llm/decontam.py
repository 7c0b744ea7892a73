"""Benchmark decontamination on templates.

Texts become words in a canonical form: numbers, units after numbers, and names (capitalised words inside a sentence) become the typed
placeholders # % and @, other words are lower-cased, punctuation and layout go. Windows of WINDOW template words of the benchmark
items are hash-joined with those of the documents, and beside them windows of the plain lower-cased words. Windows that agree on item and
relative position form an alignment. Enough plain windows in a row make it a verbatim leak, whatever stands elsewhere: tables of numbers, copies in
other case, copies with a value altered. (So every fifth plain window of a document will do to find the documents to look into; those are looked into whole.) Otherwise its stretches of equal template words are judged one by one: one counts if its slots are
consistent, that is, each value of the item always stands for the same value in the document; enough windows in such stretches are a leak, most often a
re-parameterised question (a verbatim one if all values are equal).

Defined results: null and empty texts match nothing; an item shorter than a window is matched as a whole, if it has at least WINDOW / 2 literal words;
template windows with fewer literal words are not used; repeated rows and items are matched one by one and folded by their ids; rows with
a null id on either side take no part; other columns are ignored; empty tables give no row. Texts are read whole. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabspark.llm.common import fresh, settled

WINDOW = 8
#: Windows an alignment needs (all, where an item has fewer): 5 are 12 words in a row.
ENOUGH = 5
#: Window hashes of the benchmark, and ids of documents that share one, are broadcast up to these many; beyond, they are joined by a shuffle.
BROADCAST_WINDOWS, BROADCAST_IDS = 2_000_000, 1_000_000
UNITS = ("mm cm m km in ft yd mi mg g kg t lb oz ml l s sec min h hr hrs ms hz khz mhz ghz w kw v a kb mb gb tb usd eur gbp dollars euros pounds cents percent "
         "metres meters miles hours minutes seconds days weeks months years degrees litres liters grams").split()
#: White space that is not one blank between words, where a name begins, and words; none needs a stack that grows with the text.
LAYOUT = r"\s{2,}+|[\t\n\x0B\f\r]"
NAME = r"(?<=[\p{Ll},;] )(?=\p{Lu}\p{Ll})"
TOKEN = r"\p{N}++(?:[.,]\p{N}++)*+|[\p{L}\p{M}@]++"


def raw_words(text: Column) -> Column:
    """Lower-case words and numbers; names begin with @."""
    flat = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), "@", " "), LAYOUT, " ")  # a name is one in any layout
    return F.regexp_extract_all(F.lower(F.regexp_replace(flat, NAME, "@")), F.lit(TOKEN), F.lit(0))


def plain(words: str) -> Column:
    """The raw words without marks."""
    return F.expr(f"transform({words}, w -> ltrim('@', w))")


def template(words: str) -> Column:
    """The canonical word for every raw word of the array column."""
    units = ", ".join(f"'{u}'" for u in UNITS)
    return F.expr(f"transform({words}, (w, i) -> CASE WHEN w < ':' THEN '#' WHEN w < 'A' THEN '@' WHEN w IN ({units}) AND i > 0 AND {words}[greatest(i, 1) - 1] < ':' THEN '%' ELSE w END)")


def windows(words: str, width: str, step: int = 1) -> Column:
    """Hashes of all windows of `width` words, in order, or of every `step`-th."""
    return F.expr(f"IF(size({words}) >= {width}, transform(sequence(0, size({words}) - {width}, {step}), i -> xxhash64(slice({words}, i + 1, {width}))), CAST(array() AS array<bigint>))")


def _items(benchmark: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """item, form, raw, words, width, and per window its kind (template or plain), place and hash.

    Form 1 has the first word as a name, which it is taken for where the item stands inside of a sentence; its other windows are those of form 0.
    """
    rows = benchmark.filter(F.col(key).isNotNull()).select(F.col(key).alias("item"), raw_words(F.col(text)).alias("raw"))
    named = rows.filter("size(raw) > 0 AND raw[0] >= 'A'").withColumn("raw", F.expr("concat(array(concat('@', raw[0])), slice(raw, 2, size(raw)))"))
    rows = rows.withColumn("form", F.lit(0)).unionByName(named.withColumn("form", F.lit(1)))
    rows = rows.withColumn("words", template("raw")).withColumn("plain", plain("raw")).filter(F.size("words") > 0).withColumn("width", F.least(F.lit(window), F.size("words")))
    literal = F.expr(f"size(filter(slice(words, w.pos + 1, width), x -> x NOT IN ('#', '%', '@'))) >= {window // 2}")
    placed = rows.withColumn("w", F.explode(F.concat(*[
        F.expr(f"transform(sequence(0, size(words) - width), i -> named_struct('plain', {kind == 'plain'}, 'pos', i, 'hash', xxhash64(slice({kind}, i + 1, width))))") for kind in ("words", "plain")])))
    used = placed.filter(literal | (F.col("w.plain") & (F.col("width") == window))).filter("form = 0 OR w.pos = 0 AND NOT w.plain")
    return used.select("item", "form", "raw", "words", "width", "w.plain", F.col("w.pos").alias("pos"), F.col("w.hash").alias("hash"))


#: Whether that many of the sorted places follow one another.
_IN_A_ROW = "size(same) >= {need} AND exists(sequence(0, greatest(size(same) - {need}, 0)), i -> get(same, i + {need} - 1) = get(same, i) + {need} - 1)"
#: Windows of an alignment, in order, that begin or end a stretch of words with equal templates; then the stretches and their slots.
_DIFFER = "exists(sequence({}, {} - 1), q -> item_words[q] <> words[q + shift])"
_FIRSTS = f"filter(sequence(0, size(at) - 1), i -> i = 0 OR (at[i] > at[greatest(i, 1) - 1] + width AND {_DIFFER.format('at[i - 1] + width', 'at[i]')}))"
_LASTS = f"filter(sequence(0, size(at) - 1), i -> i = size(at) - 1 OR (at[least(i, size(at) - 2) + 1] > at[i] + width AND {_DIFFER.format('at[i] + width', 'at[i + 1]')}))"
_STRETCHES = """transform(firsts, (f, j) -> named_struct('first', at[f], 'n', lasts[j] - f + 1, 'slots', transform(
    filter(sequence(at[f], at[lasts[j]] + width - 1), p -> item_words[p] IN ('#', '%', '@')), p -> named_struct('asked', item_raw[p], 'given', raw[p + shift]))))"""
_CONSISTENT = "filter(stretches, r -> size(array_distinct(transform(r.slots, s -> concat(s.asked, ' ', s.given)))) = size(array_distinct(r.slots.asked)))"


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
          window: int = WINDOW, enough: int = ENOUGH) -> DataFrame:
    """key, item_key, n_windows (of the best alignment), coverage (of the item's windows), start (word of the document), verbatim; one row per document and
    item that it leaks."""
    items = settled(_items(benchmark, item_key, item_text, window), "items")
    hashes = items.select("hash", "width").distinct()
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # at most `window` of them
    n_hashes = hashes.count()
    known = F.broadcast(hashes.select("hash").distinct()) if n_hashes <= BROADCAST_WINDOWS else hashes.select("hash").distinct()

    docs = docs.filter(F.col(key).isNotNull()).select(F.col(key).alias("doc"), F.col(text).alias("text"))
    split = docs.withColumn("raw", raw_words(F.col("text"))).select("doc", template("raw").alias("words"), plain("raw").alias("plain"))
    # a verbatim leak has as many plain windows in a row as `step`: one of them is at a multiple of it
    need = items.filter(F.col("plain") & (F.col("width") == window)).groupBy("item").agg(F.countDistinct("pos").alias("n")).agg(F.min("n")).first()[0]
    step = max(min(enough, need or enough), 1)
    either = [F.concat(windows("words", str(w)), windows("plain", str(w), step if w == window else 1)) for w in widths]
    hashed = split.select("doc", F.explode(F.concat(*either) if widths else F.array().cast("array<bigint>")).alias("hash"))
    touched = settled(hashed.join(known, "hash", "left_semi").select("doc").distinct(), "touched")
    ids = F.broadcast(touched) if touched.count() <= BROADCAST_IDS else touched

    # the few documents that share a window: places, alignments, slots
    near = docs.join(ids, "doc", "left_semi").withColumn("raw", raw_words(F.col("text"))).select("doc", "raw", template("raw").alias("words"), plain("raw").alias("plain"))
    near = settled(near.withColumn("copy", F.monotonically_increasing_id()), "near")
    every = [F.transform(windows(kind, str(w)), _placed(w, kind == "plain")) for w in widths for kind in ("words", "plain")] or [F.array().cast("array<struct<width:int,plain:boolean,at:int,hash:bigint>>")]
    placed = near.select("copy", F.explode(F.flatten(F.array(*every))).alias("w")).select("copy", "w.*")
    met = placed.join(items.select("item", "pos", "width", "plain", "hash"), ["width", "plain", "hash"])
    aligned = met.groupBy("copy", "item", (F.col("at") - F.col("pos")).alias("shift")).agg(
        F.sort_array(F.collect_set(F.when(~F.col("plain"), F.col("pos")))).alias("at"), F.sort_array(F.collect_set(F.when(F.col("plain"), F.col("pos")))).alias("same"), F.max("width").alias("width"))
    totals = items.groupBy("item").agg(F.countDistinct(F.when(~F.col("plain"), F.col("pos"))).alias("total"), F.countDistinct(F.when(F.col("plain"), F.col("pos"))).alias("total_same"),
                                       F.min_by("raw", "form").alias("item_raw"), F.min_by("words", "form").alias("item_words"))
    held = aligned.join(totals, "item").withColumn("copied", F.expr(_IN_A_ROW.format(need=f"least({enough}, total_same)")))
    held = held.filter(F.expr(f"copied OR (size(at) > 0 AND size(at) >= least({enough}, total))")).join(near.select("copy", "doc", "raw", "words"), "copy")
    verbatim = held.filter("copied").select("doc", "item", "shift", F.size("same").alias("n"), F.col("same")[0].alias("first"), F.lit(True).alias("verbatim"), F.col("total_same").alias("total"))
    judged = held.filter("NOT copied").withColumn("firsts", F.expr(_FIRSTS)).withColumn("lasts", F.expr(_LASTS)).withColumn("stretches", F.expr(_STRETCHES)).withColumn("good", F.expr(_CONSISTENT))
    other = judged.select("doc", "item", "shift", F.expr("aggregate(good, 0, (n, r) -> n + r.n)").alias("n"), F.expr("array_min(good.first)").alias("first"),
                          F.expr("forall(good, r -> forall(r.slots, s -> s.asked = s.given))").alias("verbatim"), "total").filter(F.expr(f"n > 0 AND n >= least({enough}, total)"))
    good = verbatim.unionByName(other).select("doc", "item", F.struct(F.col("n").cast("bigint").alias("n_windows"), (-(F.col("shift") + F.col("first"))).cast("bigint").alias("before"), "verbatim", "total").alias("best"))
    best = good.groupBy("doc", "item").agg(F.max("best").alias("b"))
    return best.select(F.col("doc").alias(key), F.col("item").alias(item_key), "b.n_windows", (F.col("b.n_windows") / F.col("b.total")).alias("coverage"),
                       (-F.col("b.before")).alias("start"), "b.verbatim")


def _placed(width: int, plain: bool):
    return lambda h, i: F.struct(F.lit(width).alias("width"), F.lit(plain).alias("plain"), i.alias("at"), h.alias("hash"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows, with all their columns, of documents that leak no item; rows with a null id stay."""
    name = fresh(docs, "bad")
    bad = settled(leaks(docs, benchmark, key, **options).select(F.col(key).alias(name)).distinct(), "leaks")
    return docs.join(F.broadcast(bad) if bad.count() <= BROADCAST_IDS else bad, F.col(key) == F.col(name), "left_anti")


def op8_decontamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return leaks(docs, benchmark)

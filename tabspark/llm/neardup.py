"""Near duplicates by an LSH forest.

Every text is a set of distinct word shingles; equal sets are folded first. A set's signature is TREES x DEPTH minima of hash functions. For
each tree the sets are sorted by their stretch of the signature. Neighbours in that order with a long common prefix are candidates, and
the prefix asked for adapts to the region: it starts at LEAST values and grows while more than REGION sets share it, so small regions are compared in
full and dense ones only with their closest, in chains that hold a group together. Candidates whose signatures
agree too little for the threshold (by SIGMAS standard deviations) go; the others are confirmed on their full sets. Best candidates are
confirmed first, and a candidate whose two sides are already connected needs no check, as it cannot change a class. Then all pairs of a
dense region whose sets are still in different classes are compared by signature, in cells of bounded size, and those that agree enough are
confirmed in the same cell, so that no pair but the links leaves it.

A tree's order is cut into range partitions of bounded size that also break ties by id, so a huge group is spread; rows at the cuts are compared
across them. Sets leave the tasks that made them only for documents with candidates.

Defined results: texts are lower-cased A-Z and split at ASCII white space; with fewer words than a shingle the whole sequence is one; null, empty and
blank texts have an empty set and are linked with nothing; repeated rows are copies; a row with a null id is linked with nothing, its component is
null and it is kept; empty tables give no row; other columns are ignored. Texts are read whole. A shingle counts as its 64-bit hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabspark.functions.lineage import checkpoint
from tabspark.llm.common import AT_END, fresh, settled, ship, tidied
from tabspark.llm.components import components

TREES, DEPTH, LEAST, REGION, REACH = 16, 12, 5, 16, 2
SIGMAS = 4.0
#: Dense regions: sets, and bytes of them, on either side of a cell.
BLOCK, SIDE_BYTES = 8192, 16_000_000
#: Rows of a tree's order in one range partition, and word hashes a worker keeps at hand.
ROWS, REMEMBERED = 200_000, 150_000
#: Ids of documents with candidates are broadcast up to this many (8 bytes each); beyond, they are joined by a shuffle.
BROADCAST_IDS = 1_000_000
MIX, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_known: dict[bytes, int] = {}
AT_END.append(_known.clear)


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a UTF-8 text."""
    found = text.lower().split() if text else []
    if not found:
        return np.zeros(0, "u8")
    if len(found) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found))], "u8")
    if len(_known) > REMEMBERED:
        _known.clear()
    for w in set(found).difference(_known):
        _known[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(_known.__getitem__, found), "u8", len(found))
    n = len(h) - words + 1
    key = np.zeros(n, "u8")
    for k in range(words):
        key = (key ^ h[k:k + n]) * (MIX if k % 2 else MIX2)
        key ^= key >> np.uint64(31)
    return np.unique(key)


def _functions(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240607)
    return rng.integers(0, 1 << 32, n, dtype="u4") | np.uint32(1), rng.integers(0, 1 << 32, n, dtype="u4")


def signature(keys: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """16 bits of the minimum under every hash function."""
    a, b = functions
    least = np.full(len(a), 0xFFFFFFFF, "u4")
    short = (keys >> np.uint64(32)).astype("u4") ^ keys.astype("u4")
    for k in range(0, len(short), 2048):
        v = (short[k:k + 2048, None] ^ b) * a
        np.minimum(least, v.min(axis=0), out=least)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(">u2")


def sets(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """id, size, print (of the whole set) and signature of every row; an empty set has no print."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = _functions(TREES * DEPTH)
        for rows in batches:
            n, prints, signs = [], [], []
            for t, i in zip(rows.column("text").cast(pa.binary()), rows.column("id")):
                keys = shingles(t.as_py(), words)
                n.append(len(keys))
                live = len(keys) > 0 and i.is_valid
                prints.append(xxhash.xxh3_128_digest(keys.tobytes()) if live else None)
                signs.append(signature(keys, functions).tobytes() if live else None)
            yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(signs, pa.binary())], ["id", "n", "print", "sign"])

    return docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")).mapInArrow(tidied(work), "id bigint, n bigint, print binary, sign binary")


def neighbours(tree: np.ndarray, keys: np.ndarray, region: int = REGION, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i, j), i < j, of candidates in one sorted stretch; keys: rows x DEPTH values.

    A row's depth is the smallest, from `least`, at which at most `region` rows share its prefix (the full depth if none). Rows that share
    their prefix to that depth are candidates, and so are direct neighbours from `least` values on. Where more than `region` rows share
    `least` values, a row only meets the next REACH in the order: they hold a dense region together without all its pairs.
    """
    n, depth = keys.shape
    if n < 2:
        return np.zeros(0, "i8"), np.zeros(0, "i8")
    same = keys[1:] == keys[:-1]
    shared = np.where(tree[1:] == tree[:-1], np.cumprod(same, axis=1).sum(1), 0)
    first = np.concatenate([[0], np.cumsum(shared < least)])
    dense = np.bincount(first)[first] > region
    own = np.full(n, depth)
    open_ = np.ones(n, bool)
    for d in range(least, depth):
        run = np.concatenate([[0], np.cumsum(shared < d)])
        fits = open_ & (np.bincount(run)[run] <= region)
        own[fits], open_ = d, open_ & ~fits
    left, right, reach = [], [], np.full(n, depth + 1)
    for step in range(1, min(region, n - 1) + 1):
        reach = np.minimum(reach[:n - step] if step > 1 else reach[:n - 1], shared[step - 1:])
        ok = (reach >= (least if step == 1 else own[:n - step])) & ((step <= REACH) | ~dense[:n - step])
        if not (reach >= least).any():
            break
        at = np.flatnonzero(ok)
        left.append(at)
        right.append(at + step)
    return np.concatenate(left or [np.zeros(0, "i8")]), np.concatenate(right or [np.zeros(0, "i8")])


def candidates(folded: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of ids, a < b, that are close in some tree and of fitting sizes; and the rows (id, n, tree, stretch) of dense regions.
    `folded`: id, n, sign."""
    width = 2 * DEPTH
    rows = folded.select("id", "n", "sign", F.explode(F.array(*[F.lit(t) for t in range(TREES)])).alias("tree")).select(
        "id", "n", "tree", F.expr(f"substring(sign, tree * {width} + 1, {width})").alias("stretch"))
    order = ["tree", "stretch", "id"]
    parts = max(1, math.ceil(folded.count() * TREES / ROWS))
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    fields = ["kind", "a", "b", "part", "place", "n", "tree", "stretch"]

    def pairs_of(ids, sizes, i, j):
        ok = (np.minimum(sizes[i], sizes[j]) >= threshold * np.maximum(sizes[i], sizes[j]) - 1e-9) & (ids[i] != ids[j])
        return np.minimum(ids[i], ids[j])[ok], np.maximum(ids[i], ids[j])[ok]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if len(b)]
        if not held:
            return
        table = pa.Table.from_batches(held)
        ids, sizes, tree = (table.column(c).to_numpy() for c in ("id", "n", "tree"))
        stretches = table.column("stretch").to_pylist()
        keys = np.frombuffer(b"".join(stretches), ">u2").reshape(len(ids), DEPTH).astype("u2")
        a, b = pairs_of(ids, sizes, *neighbours(tree, keys))
        m, part = len(a), TaskContext.get().partitionId()
        edge = sorted({*range(min(REGION, len(ids))), *range(max(0, len(ids) - REGION), len(ids))})
        none = lambda k, kind: pa.nulls(k, kind)
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(m, "i4")), pa.array(a), pa.array(b), *(none(m, k) for k in (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))], fields)
        run = np.concatenate([[0], np.cumsum((tree[1:] != tree[:-1]) | (keys[1:, :LEAST] != keys[:-1, :LEAST]).any(1))])
        # at the cuts a region may go on elsewhere
        dense = np.flatnonzero((np.bincount(run)[run] > REGION) | (run == 0) | (run == run[-1]))
        for kind, e in ((1, np.array(edge, "i8")), (2, dense)):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(e), kind, "i4")), pa.array(ids[e]), pa.array(e - len(ids)), pa.array(np.full(len(e), part, "i4")), pa.array(e),
                                              pa.array(sizes[e]), pa.array(tree[e]), pa.array([stretches[i] for i in e], pa.binary())], fields)

    made = settled(placed.mapInArrow(tidied(work), "kind int, a bigint, b bigint, part int, place bigint, n bigint, tree int, stretch binary"), "forest")
    inside = made.filter("kind = 0").select("a", "b")
    dense = made.filter("kind = 2").select(F.col("a").alias("id"), "n", "tree", "stretch")
    # rows at the cuts: the last of a partition meet the first of the next that has any; b is the place counted from the end
    cuts = made.filter("kind = 1")
    filled = sorted(r["part"] for r in cuts.select("part").distinct().collect())
    if len(filled) < 2:
        return inside.distinct(), dense
    follows = F.create_map(*[F.lit(x) for p, q in zip(filled, filled[1:]) for x in (q, p)])
    ends = cuts.filter(F.col("b") >= -REGION).select("part", F.col("b").alias("at"), "a", "n", "tree", "stretch")
    heads = cuts.filter(F.col("place") < REGION).select(follows[F.col("part")].alias("part"), F.col("place").alias("at"), "a", "n", "tree", "stretch").filter("part IS NOT NULL")

    def across(pdf):
        pdf = pdf.sort_values("at")
        ids, sizes, tree, at = (pdf[c].to_numpy() for c in ("a", "n", "tree", "at"))
        keys = np.frombuffer(b"".join(pdf["stretch"]), ">u2").reshape(len(ids), DEPTH)
        i, j = np.nonzero((at[:, None] < 0) & (at[None, :] >= 0) & (at[None, :] - at[:, None] <= REGION) & (tree[:, None] == tree[None, :]))
        close = (keys[i, :LEAST] == keys[j, :LEAST]).all(1)
        a, b = pairs_of(ids, sizes, i[close], j[close])
        return pdf.__class__({"a": a, "b": b})

    return inside.union(ends.union(heads).groupBy("part").applyInPandas(across, "a bigint, b bigint")).distinct(), dense


def linked(dense: DataFrame, folded: DataFrame, contents: DataFrame, classes: DataFrame | None, threshold: tuple[int, int]) -> DataFrame:
    """Links (a, b) of dense regions: enough pairs of sets in different classes that reach the threshold to connect all classes that such pairs connect.

    A region's sets outside of its largest class are compared with all its others by signature, in cells of bounded size, and those that agree enough on their full
    sets, in the same place: only links leave a cell, at most one for each class in it. The likelier ones of a set come first, and a pair whose classes are connected
    by others needs no check. A pair is compared in the first of the trees that bring it together.
    """
    over, under = threshold
    level, region = over / under, ["tree", "prefix"]
    floor = _floor(level)
    rows = dense.select("id", "n", "tree", F.expr(f"substring(stretch, 1, {2 * LEAST})").alias("prefix"))
    rows = rows.withColumn("class", F.col("id")) if classes is None else rows.join(
        classes.select(F.col("node").alias("id"), F.col("component").alias("class")), "id", "left").withColumn("class", F.coalesce("class", "id"))
    rows = settled(rows, "dense")
    regions = rows.groupBy(*region, "class").agg(F.count("*").alias("k"), F.sum("n").alias("s")).groupBy(*region).agg(
        F.sum("k").alias("size"), F.sum("s").alias("shingles"), F.max(F.struct("k", "class", "s")).alias("top")).filter("size > top.k")
    cells = lambda sets_, shingles_: f"greatest(ceil(({sets_}) / {BLOCK}), ceil(8 * ({shingles_}) / {SIDE_BYTES}))"
    regions = settled(regions.selectExpr(*region, "top.class AS largest", f"{cells('size - top.k', 'shingles - top.s')} AS owns", f"{cells('size', 'shingles')} AS others"), "regions")
    mixed = rows.join(F.broadcast(regions) if regions.count() <= BROADCAST_IDS else regions, region).withColumn("outside", F.expr("class <> largest"))
    mixed = mixed.join(folded.select("id", "sign").join(contents, "id"), "id").selectExpr("*", "pmod(xxhash64(id), owns) AS p", "pmod(xxhash64(id), others) AS q")
    placed = mixed.selectExpr(*region, "id", "class", "outside", "sign", "keys", "p", "q", """explode(array_union(
        transform(sequence(0L, owns - 1), x -> struct(x AS x, q AS y)), if(outside, transform(sequence(0L, others - 1), y -> struct(p AS x, y AS y)), array()))) AS cell""")
    placed = placed.selectExpr(*region, "cell.x", "cell.y", "id", "class", "outside", "outside AND p = cell.x AS own", "q = cell.y AS other", "sign", "keys")

    def work(cell: pa.Table) -> pa.Table:
        ids, outside, own, other = (cell.column(c).to_numpy() for c in ("id", "outside", "own", "other"))
        group, tree, others = cell.column("class").to_numpy().copy(), cell.column("tree")[0].as_py(), np.flatnonzero(other)
        signs = np.frombuffer(b"".join(cell.column("sign").to_pylist()), "u2").reshape(len(ids), TREES * DEPTH)
        starts = signs.reshape(len(ids), TREES, DEPTH)[:, :, :LEAST]
        sizes = pc.binary_length(cell.column("keys")).to_numpy() // 8
        values, codes = np.unique(np.frombuffer(b"".join(cell.column("keys").to_pylist()), "u8"), return_inverse=True)
        at, seen, links = np.concatenate([[0], np.cumsum(sizes, dtype="i8")]), np.zeros(len(values), bool), []
        for i in np.flatnonzero(own).tolist():
            j = others[(group[others] != group[i]) & (np.minimum(sizes[others], sizes[i]) >= level * np.maximum(sizes[others], sizes[i]) - 1e-9)]
            j = j[~outside[j] | (ids[j] > ids[i])]  # pairs with both sets outside of the largest class are met twice
            agree = _agreement(signs[j], signs[i])
            fits = (agree >= floor) & ~(starts[j, :tree] == starts[i, :tree]).all(2).any(1)
            mine = codes[at[i]:at[i + 1]]
            seen[mine] = True
            for k in j[fits][np.argsort(-agree[fits], kind="stable")].tolist():
                if group[k] == group[i]:
                    continue
                common = int(np.count_nonzero(seen[codes[at[k]:at[k + 1]]]))
                if under * common >= over * int(sizes[i] + sizes[k] - common):
                    group[group == group[k]] = group[i]
                    links.append((min(ids[i], ids[k]), max(ids[i], ids[k])))
            seen[mine] = False
        a, b = np.array(links, "i8").reshape(-1, 2).T
        return pa.table([pa.array(a), pa.array(b)], ["a", "b"])

    return placed.groupBy(*region, "x", "y").applyInArrow(work, "a bigint, b bigint").distinct()


def _agreement(many: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Share of equal values of each row with `one`: truth values are added eight at a time, which the widths fit."""
    folded = np.ascontiguousarray(many == one).view("u8").sum(1, dtype="u8")
    return ((folded * np.uint64(0x0101010101010101)) >> np.uint64(56)) / (TREES * DEPTH)


def _floor(threshold: float) -> float:
    return threshold - SIGMAS * math.sqrt(threshold * (1 - threshold) / (TREES * DEPTH))


def likely(pairs: DataFrame, folded: DataFrame, threshold: float) -> DataFrame:
    """a, b and the share of agreeing signature values, without pairs that agree too little for the threshold."""
    floor = _floor(threshold)
    signs = folded.select("id", "sign")
    both = pairs.join(signs.select(F.col("id").alias("a"), F.col("sign").alias("x")), "a").join(signs.select(F.col("id").alias("b"), F.col("sign").alias("y")), "b")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            read = lambda c: np.frombuffer(b"".join(rows.column(c).to_pylist()), "u2").reshape(len(rows), TREES * DEPTH)
            agree = (read("x") == read("y")).mean(1) if len(rows) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([rows.column("a"), rows.column("b"), pa.array(agree)], ["a", "b", "agree"]).filter(pa.array(agree >= floor))

    return both.select("a", "b", "x", "y").mapInArrow(work, "a bigint, b bigint, agree double")


def confirmed(pairs: DataFrame, contents: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Links (a, b): pairs whose full sets reach the threshold. `contents`: id, keys (sorted 64-bit hashes)."""
    over, under = threshold
    both = pairs.select("a", "b").join(contents.select(F.col("id").alias("a"), F.col("keys").alias("x")), "a").join(contents.select(F.col("id").alias("b"), F.col("keys").alias("y")), "b")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            keep = []
            for x, y in zip(rows.column("x"), rows.column("y")):
                x, y = np.frombuffer(x.as_buffer(), "u8"), np.frombuffer(y.as_buffer(), "u8")
                at = np.searchsorted(x, y)
                common = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                keep.append(under * common >= over * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([rows.column("a"), rows.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "x", "y").mapInArrow(work, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """key, n_shingles, component_id (smallest id reachable over links) and kept (it is the component's id) of every row.

    Linked are texts of which the shared shingles are at least threshold[0] / threshold[1] of all their shingles.
    """
    ship(docs.sparkSession)
    level = threshold[0] / threshold[1]
    every = settled(sets(docs, key, text, words), "sets")
    folded = settled(every.filter("print IS NOT NULL").groupBy("print").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sign").alias("sign")), "folded")
    pairs, dense = candidates(folded, level)
    pending = settled(likely(pairs, folded, level), "pairs")
    wanted = settled(pending.select("a").union(pending.select("b")).union(dense.select("id")).distinct().withColumnRenamed("a", "id"), "wanted")
    ids = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [shingles(t.as_py(), words).tobytes() for t in rows.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array(found, pa.binary())], ["id", "keys"])

    texts = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text")).join(ids, "id", "left_semi")
    contents = settled(texts.mapInArrow(tidied(keys), "id bigint, keys binary").filter("octet_length(keys) > 0").groupBy("id").agg(F.first("keys").alias("keys")), "contents")
    links, classes = None, None
    for last in (False, False, True):
        if pending.isEmpty():
            break
        chosen = pending
        if not last:  # the best candidate of every document first
            best = lambda side: pending.groupBy(side).agg(F.max(F.struct("agree", "a", "b")).alias("m")).select("m.a", "m.b")
            chosen = best("a").union(best("b")).distinct()
        found = checkpoint(confirmed(chosen, contents, threshold))
        links = found if links is None else links.union(found)
        classes = components(links)
        if not last:
            left = pending.join(chosen, ["a", "b"], "left_anti")
            side = lambda c: classes.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
            left = left.join(side("a"), "a", "left").join(side("b"), "b", "left").filter("of_a IS NULL OR of_b IS NULL OR of_a <> of_b")
            pending = settled(left.select("a", "b", "agree"), "pairs")
    # dense regions: all pairs that are left
    found = checkpoint(linked(dense, folded, contents, classes, threshold))
    if not found.isEmpty():
        links = found if links is None else links.union(found)
        classes = components(links)
    prints = folded.select("print", "id")
    if classes is not None:
        prints = prints.join(classes.withColumnRenamed("node", "id"), "id", "left").select("print", F.coalesce("component", "id").alias("component_id"))
    else:
        prints = prints.withColumnRenamed("id", "component_id")
    out = every.select("id", "n", "print").join(prints, "print", "left").select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """The rows, with all their columns, of the smallest id in each component; of rows with equal ids one stays (any, if they differ)."""
    found = near_duplicates(docs, key, text, words, threshold)
    name = fresh(docs, "gone")
    gone = settled(found.filter(~F.col("kept")).select(F.col(key).alias(name)).distinct(), "gone")
    repeated = settled(found.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(name)).agg(F.count("*").alias("n")).filter("n > 1").select(name), "repeated")
    small = lambda ids: F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    again = F.col(key).cast("bigint") == F.col(name)
    kept = docs.join(small(gone), again, "left_anti")
    if repeated.isEmpty():
        return kept
    return kept.join(small(repeated), again, "left_anti").unionByName(kept.join(small(repeated), again, "left_semi").dropDuplicates([key]))


def op7_near_duplicates(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, words=3, threshold=(85, 100))

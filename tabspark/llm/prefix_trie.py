"""The prefix trie of conversations, from padded matrices of turn ids.

A turn's id is 128 bits of its role and text, mixed with its depth; a node's key is its depth and the exclusive or of the
ids on its path (that any two of n different paths agree has a chance of about n * n / 2^129). Conversations are cut into bands of
`WIDTH` turns, so that no matrix is wider, whatever the longest conversation. Equal rows of a band are folded, rows are
range-partitioned and sorted, and chunks of a bounded number of rows become matrices: lexsort orders them, change masks
accumulated from column to column mark where nodes start, and reduceat sums up every depth. Nodes that hold a chunk's first or last row,
or lie where two bands meet, are recombined by key; all others are whole.

Sums over subtrees need no walk from node to node, since they are sums over a node's conversations. With a member's words from the node on
added up over members, and every node's words taken off once, what is left is what sharing saves. A node counts once by belonging to its smallest
member: a conversation owns the nodes from some depth on, and a leaf belongs to one conversation. So a first pass over the matrices gives
members and children, and a second one the sums of what conversations own.

Defined results: rows without a conversation id take no part; null roles and texts are empty; turns follow the order column (null
first), then role, text; repeated rows are turns of their own; an empty table gives no node; other columns are ignored.
Conversation ids are whole numbers. Texts are never gathered. A node's list of ends is digested as a stream by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tabspark.llm.common import settled, ship

WIDTH, ROWS = 16, 50_000
NO_ENDS = hashlib.sha256().hexdigest()
KEY = ["depth", "k1", "k2"]


def numbered(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, depth (from 1), a, b (the turn's id), words: every turn in its place. Long conversations are dealt over partitions; each
    partition counts its own, and what the ones before it hold of its first conversation is added."""
    ship(turns.sparkSession)
    plain = turns.filter(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("conv"), F.col(order).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    plain = plain.select("*", F.xxhash64(F.lit(1), "role", "text").alias("a"), F.xxhash64(F.lit(2), "role", "text").alias("b"),
                         F.expr(r"CAST(regexp_count(text, '[^\\x20\\x09-\\x0D]+') AS BIGINT)").alias("words"), F.monotonically_increasing_id().alias("row"))
    by = [F.col("conv"), F.asc_nulls_first("turn"), F.col("role"), F.col("text"), F.col("row")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, count = TaskContext.get().partitionId(), None, 0
        for rows in batches:
            convs = rows.column("conv").to_numpy()
            if not len(convs):
                continue
            starts = np.append(True, convs[1:] != convs[:-1])
            at = np.flatnonzero(starts)
            place = np.arange(1, len(convs) + 1) - np.repeat(at, np.diff(np.append(at, len(convs))))
            if last == convs[0]:
                place[:at[1] if len(at) > 1 else None] += count
            last, count = convs[-1], place[-1]
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(convs), pa.int32()), rows.column("conv"), pa.array(place, pa.int64()), *(rows.column(c) for c in ("a", "b", "words"))],
                                             ["part", "conv", "place", "a", "b", "words"])

    placed = settled(plain.repartitionByRange(*by).sortWithinPartitions(*by).select("conv", "a", "b", "words").mapInArrow(work, "part int, conv bigint, place bigint, a bigint, b bigint, words bigint"), "turns")
    carried, before = [], None
    for r in sorted(placed.groupBy("part").agg(F.min("conv").alias("first"), F.max(F.struct("conv", "place")).alias("last")).collect()):  # one row a partition
        more = before[1] if before and before[0] == r["first"] else 0
        if more:
            carried.append((r["part"], r["first"], more))
        before = (r["last"]["conv"], r["last"]["place"] + (more if r["last"]["conv"] == r["first"] else 0))
    carried = turns.sparkSession.createDataFrame(carried, "part int, conv bigint, more bigint")
    return placed.join(F.broadcast(carried), ["part", "conv"], "left").select("conv", (F.col("place") + F.coalesce("more", F.lit(0))).alias("depth"), "a", "b", "words")


def banded(turns: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """conv, band, p1, p2 (key of the node the band starts from), e1, e2 (of the one it ends at), ids, words, after (words in later bands)."""
    cells = turns.select("conv", "depth", ((F.col("depth") - 1) / width).cast("bigint").alias("band"), F.xxhash64("a", "b", "depth").alias("v1"), F.xxhash64(F.lit(3), "b", "a", "depth").alias("v2"), "words")
    rows = cells.groupBy("conv", "band").agg(F.sort_array(F.collect_list(F.struct("depth", "v1", "v2", "words"))).alias("cells"), F.bit_xor("v1").alias("x1"), F.bit_xor("v2").alias("x2"), F.sum("words").alias("total"))
    rows = rows.selectExpr("conv", "band", "transform(cells, c -> struct(c.v1 AS v1, c.v2 AS v2)) AS ids", "cells.words AS words", "x1", "x2", "total")
    silent = members.join(turns.select("conv").distinct(), "conv", "left_anti").selectExpr("conv", "0L AS band", "CAST(array() AS array<struct<v1: bigint, v2: bigint>>) AS ids", "CAST(array() AS array<bigint>) AS words", "0L AS x1", "0L AS x2", "0L AS total")
    one = Window.partitionBy("conv")
    up = one.orderBy("band").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.unionByName(silent).select("*", F.bit_xor("x1").over(up).alias("e1"), F.bit_xor("x2").over(up).alias("e2"), (F.sum("total").over(one) - F.sum("total").over(up)).alias("after"))
    return settled(rows.select("conv", "band", "ids", "words", F.expr("e1 ^ x1").alias("p1"), F.expr("e2 ^ x2").alias("p2"), "e1", "e2", "after"), "bands")


class Matrix:
    """A chunk of sorted band rows: where nodes start at every depth of the band, and their keys."""

    def __init__(self, rows: pa.Table):
        band, p1, p2 = (rows.column(c).to_numpy() for c in ("band", "p1", "p2"))
        ids, words = rows.column("ids").combine_chunks(), rows.column("words").combine_chunks()
        self.size = pc.list_value_length(ids).to_numpy()
        self.n, self.width = len(band), int(self.size.max(initial=0))
        present = np.arange(self.width) < self.size[:, None]
        v1, v2, self.words = (np.zeros(present.shape, "i8") for _ in range(3))
        flat = ids.flatten()
        for target, values in ((v1, flat.field("v1")), (v2, flat.field("v2")), (self.words, words.flatten())):
            target[present] = values.to_numpy()
        order = [band, p1, p2]
        for j in range(self.width):
            order += [present[:, j], v1[:, j], v2[:, j]]
        self.order = np.lexsort(order[::-1])
        band, p1, p2, v1, v2, present, self.words, self.size = (x[self.order] for x in (band, p1, p2, v1, v2, present, self.words, self.size))
        self.band = band
        change = np.ones(self.n, bool)
        change[1:] = (band[1:] != band[:-1]) | (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])
        keys, there = (p1, p2), np.ones(self.n, bool)
        self.starts, self.there, self.keys = [np.flatnonzero(change)], [there], [keys]
        for j in range(self.width):
            here = present[:, j]
            change[1:] |= (here[1:] != here[:-1]) | (v1[1:, j] != v1[:-1, j]) | (v2[1:, j] != v2[:-1, j])
            keys = keys[0] ^ v1[:, j], keys[1] ^ v2[:, j]  # empty cells are 0
            self.starts.append(np.flatnonzero(change))
            self.there.append(here)
            self.keys.append(keys)

    def suffix_sums(self, words: np.ndarray) -> np.ndarray:
        """Row by row, the sum from a column on; column 0 stands for the node that the band starts from."""
        sums = np.zeros((self.n, self.width + 1), "i8")
        sums[:, 1:] = np.cumsum(words[:, ::-1], axis=1)[:, ::-1]
        if self.width:
            sums[:, 0] = sums[:, 1]
        return sums

    def split(self, j: int) -> np.ndarray:
        """Of the starts at depth j, those whose node holds the first or the last row: other chunks may hold more of it."""
        return (self.starts[j] == 0) | (np.append(self.starts[j][1:], self.n) == self.n)


def chunked(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Matrix | tuple]:
    held, size = [], 0
    for rows in batches:
        for a in range(0, rows.num_rows, most):
            some = rows.slice(a, most)
            if size and size + some.num_rows > most:
                yield pa.Table.from_batches(held)
                held, size = [], 0
            held.append(some)
            size += some.num_rows
    if size:
        yield pa.Table.from_batches(held)


def sharded(rows: DataFrame) -> DataFrame:
    by = ["band", "p1", "p2", "ids"]
    return rows.repartitionByRange(*by).sortWithinPartitions(*by)


def members_by_node(bands: DataFrame, width: int, most: int) -> DataFrame:
    """depth, k1, k2, pk1, pk2 (the parent's), n, low (smallest member), children, full (words of all members from here on), parent (its low,
    null where it has to be looked up), and whether the node is split over chunks or open to the next band."""
    rows = bands.groupBy("band", "p1", "p2", "e1", "e2", F.size("ids").alias("size")).agg(F.first("ids").alias("ids"), F.first("words").alias("words"), F.count("*").alias("n"), F.min("conv").alias("low"), F.sum("after").alias("after"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunked(batches, most):
            m = Matrix(rows)
            n, low, after = (rows.column(c).to_numpy()[m.order] for c in ("n", "low", "after"))
            full = n[:, None] * m.suffix_sums(m.words) + after[:, None]
            above = None
            for j, starts in enumerate(m.starts):
                split, there = m.split(j), m.there[j][starts]
                children = np.zeros(len(starts), "i8")
                if j < m.width:
                    whole = np.zeros(m.n, "i8")
                    whole[m.starts[j + 1]] = m.there[j + 1][m.starts[j + 1]] & ~m.split(j + 1)
                    children = np.add.reduceat(whole, starts)
                lowest = np.minimum.reduceat(low, starts)
                later = (m.band[starts] > 0) & (j == 0)  # the last band's node: only children are known here
                if j == 0:
                    parent, known = np.zeros(len(starts), "i8"), np.zeros(len(starts), bool)
                else:
                    place = np.searchsorted(m.starts[j - 1], starts, "right") - 1
                    parent, known = above[0][place], above[1][place]
                above = (lowest, ~split & (j > 0))
                k1, k2 = m.keys[j]
                q1, q2 = m.keys[max(j - 1, 0)]
                out = [pa.array(m.band[starts] * width + j), pa.array(k1[starts]), pa.array(k2[starts]), pa.array(q1[starts], mask=np.full(len(starts), j == 0)), pa.array(q2[starts], mask=np.full(len(starts), j == 0)),
                       pa.array(np.where(later, 0, np.add.reduceat(n, starts))), pa.array(lowest, mask=later), pa.array(children), pa.array(np.where(later, 0, np.add.reduceat(full[:, j], starts))),
                       pa.array(parent, mask=~known), pa.array(split & ~later), pa.array(split | later | (j == width))]
                yield pa.RecordBatch.from_arrays(out, ["depth", "k1", "k2", "pk1", "pk2", "n", "low", "children", "full", "parent", "split", "open"]).filter(pa.array(there))

    found = settled(sharded(rows).mapInArrow(work, "depth bigint, k1 bigint, k2 bigint, pk1 bigint, pk2 bigint, n bigint, low bigint, children bigint, full bigint, parent bigint, split boolean, open boolean"), "nodes")
    merged = found.filter("open").groupBy(KEY).agg(F.max("pk1").alias("pk1"), F.max("pk2").alias("pk2"), F.sum("n").alias("n"), F.min("low").alias("low"), F.sum("children").alias("children"),
                                                   F.sum("full").alias("full"), F.max("parent").alias("parent"), F.bool_or("split").alias("split"))
    merged = settled(merged, "merged")
    kids = merged.filter("split AND depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pk1").alias("k1"), F.col("pk2").alias("k2")).agg(F.count("*").alias("kids"))
    merged_nodes = merged.join(kids, KEY, "left").withColumn("children", F.col("children") + F.coalesce("kids", F.lit(0))).drop("kids", "split")
    nodes = found.filter("NOT open").drop("split", "open").unionByName(merged_nodes)
    above = merged.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("pk1"), F.col("k2").alias("pk2"), F.col("low").alias("looked_up"))
    return settled(nodes.join(above, ["depth", "pk1", "pk2"], "left").withColumn("parent", F.coalesce("parent", "looked_up")).drop("looked_up", "pk1", "pk2"), "nodes")


def owned_by_node(bands: DataFrame, nodes: DataFrame, width: int, most: int) -> DataFrame:
    """depth, k1, k2, own (words of the nodes below and itself, each once), leaves."""
    chains = nodes.groupBy(F.col("low").alias("conv")).agg(F.min("depth").alias("start"), F.max((F.col("children") == 0).cast("bigint")).alias("leaf"))
    one = Window.partitionBy("conv")
    up = one.orderBy("band").rowsBetween(Window.unboundedPreceding, 0)
    rows = bands.join(chains, "conv", "left").withColumn("own", F.expr(f"CASE WHEN start IS NULL THEN 0L ELSE aggregate(slice(words, CAST(greatest(start - band * {width}, 1) AS INT), {width}), 0L, (s, w) -> s + w) END"))
    rows = rows.withColumn("later", F.sum("own").over(one) - F.sum("own").over(up))
    rows = rows.groupBy("band", "p1", "p2", "e1", "e2", F.size("ids").alias("size")).agg(F.first("ids").alias("ids"), F.first("words").alias("words"), F.min(F.struct("conv", "start")).alias("low"),
                                                                                      F.sum("later").alias("later"), F.sum(F.coalesce("leaf", F.lit(0))).alias("leaf"))
    rows = rows.select("band", "p1", "p2", "ids", "words", F.coalesce(F.col("low.start") - F.col("band") * width, F.lit(width + 1)).alias("start"), "later", "leaf")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunked(batches, most):
            m = Matrix(rows)
            start, later, leaf = (rows.column(c).to_numpy()[m.order] for c in ("start", "later", "leaf"))
            own = m.suffix_sums(np.where(np.arange(1, m.width + 1) >= start[:, None], m.words, 0)) + later[:, None]
            for j, starts in enumerate(m.starts):
                there = m.there[j][starts] & ((m.band[starts] == 0) | (j > 0))
                k1, k2 = m.keys[j]
                out = [m.band[starts] * width + j, k1[starts], k2[starts], np.add.reduceat(own[:, j], starts), np.add.reduceat(leaf, starts), m.split(j)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], [*KEY, "own", "leaves", "split"]).filter(pa.array(there))

    found = settled(sharded(rows).mapInArrow(work, "depth bigint, k1 bigint, k2 bigint, own bigint, leaves bigint, split boolean"), "owned")
    merged = found.filter("split").groupBy(KEY).agg(F.sum("own").alias("own"), F.sum("leaves").alias("leaves"))
    return found.filter("NOT split").drop("split").unionByName(merged)


def ends_by_node(bands: DataFrame, width: int) -> DataFrame:
    """depth, k1, k2, ends_sha256: the ids of the conversations that end at a node, ascending and joined by commas, digested as they come."""
    last = bands.groupBy("conv").agg(F.max(F.struct("band", F.size("ids").alias("size"), "e1", "e2")).alias("z")).select((F.col("z.band") * width + F.col("z.size")).alias("depth"), F.col("z.e1").alias("k1"), F.col("z.e2").alias("k2"), "conv")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(key, digest):
            return pa.RecordBatch.from_arrays([*(pa.array([v], pa.int64()) for v in key), pa.array([digest.hexdigest()])], [*KEY, "ends_sha256"])

        key, digest = None, None
        for rows in batches:
            columns = [rows.column(c).to_numpy() for c in KEY]
            if not rows.num_rows:
                continue
            change = np.zeros(rows.num_rows, bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            cuts, texts = [0, *np.flatnonzero(change), rows.num_rows], rows.column("conv").cast(pa.string()).to_pylist()
            for a, b in zip(cuts, cuts[1:]):
                here = tuple(c[a] for c in columns)
                if here != key:
                    if key is not None:
                        yield told(key, digest)
                    key, digest = here, hashlib.sha256(",".join(texts[a:b]).encode())
                else:
                    digest.update(("," + ",".join(texts[a:b])).encode())
        if key is not None:
            yield told(key, digest)

    return last.repartition(*KEY).sortWithinPartitions(*KEY, "conv").mapInArrow(work, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


def trie(turns: DataFrame, members: DataFrame, width: int = WIDTH, most: int = ROWS) -> DataFrame:
    """One row per node, of conversations given as (conv, depth, a, b, words) and all their ids as (conv): conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    ship(turns.sparkSession)
    bands = banded(turns, members, width)
    nodes = members_by_node(bands, width, most)
    whole = nodes.join(owned_by_node(bands, nodes, width, most), KEY).join(ends_by_node(bands, width), KEY, "left")
    return whole.select(F.col("low").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
                        (F.col("full") - F.col("own")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def prefix_trie(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of a table of conversations as they are."""
    placed = numbered(turns, key, order, role, text)
    return trie(placed, placed.select("conv").distinct())


def rebuilt(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that share beginnings: the first h turns of conversation c - c % every, then one's own after the first h; h = crc32(c) % most."""
    sizes = turns.groupBy("conv").agg(F.max("depth").alias("size"))
    plan = sizes.select("conv", "size", (F.crc32(F.col("conv").cast("string")) % most).alias("h"), (F.col("conv") - F.col("conv") % every).alias("base"))
    plan = plan.join(sizes.select(F.col("conv").alias("base"), F.col("size").alias("there")), "base", "left")
    plan = settled(plan.select("conv", "base", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken")), "rebuilt")
    own = turns.join(plan, "conv").filter("depth > h").select("conv", (F.col("depth") - F.col("h") + F.col("taken")).alias("depth"), "a", "b", "words")
    heads = turns.filter(f"depth < {most} AND conv % {every} = 0").select(F.col("conv").alias("base"), "depth", "a", "b", "words")
    return own.unionByName(plan.join(heads, "base").filter("depth <= taken").select("conv", "depth", "a", "b", "words")), plan.select("conv")


def op12_prefix_trie(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    turns, members = rebuilt(numbered(conversations))
    return trie(settled(turns, "turns"), members)

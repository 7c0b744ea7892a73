"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are cut into blocks of similar length (norm), queries into blocks of similar need. A query's threshold, its k-th best score so far,
starts from the vectors of the longest block; divided by the query's length and a block's greatest length it is the cosine that a vector of
the block must reach. If that exceeds 1 the whole block is passed over. Below that the block prunes by what is cheaper at this cosine: where
it is high, by coordinates (the first ones exactly, the rest bounded by the lengths of what remains), else by length alone. Products of
what is left are computed in full, so the result is exact.

Blocks are rows of a bounded size, and meet in a join on (block of vectors, block of queries), so memory does not grow with the table; only
one score per query, kept in the blocks themselves, is passed along. Ties go to the smaller id.

Defined results: null vectors and vectors with a null, NaN or infinite component take no part; vectors meet queries of the same dimension
only; rows with the same id are all candidates, but never for a query with that id; a query id that repeats gives the result of each of its
rows; a null id takes no part; empty tables give no row. Products are exact (past 2^53 in Python's integers); beyond 64 bits they
are the nearest such number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tabspark.llm.common import settled, ship

BLOCK, QUERIES = 4096, 512
#: Coordinates computed first, and the least cosine at which that pays.
HEAD, PAYS = 16, 0.6
#: Vectors whose products give the first thresholds.
SEED = 512
BLOCK_TYPE = "block bigint, dim int, least double, longest double, ids array<bigint>, raw binary"


def integers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, as whole doubles."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double"))


def sound(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), F.lit(False))


def _blocks(rows: DataFrame, size: int, order: Column, what: str) -> DataFrame:
    """Rows (id, v, norm), ordered, as blocks of at most `size` rows of one dimension: range partitions, each cut by a stream over its sorted rows."""
    n = rows.count()
    parts = max(1, math.ceil(n / (4 * size)))
    placed = rows.select(F.size("v").alias("dim"), order.alias("by"), "id", "v", "norm").repartitionByRange(parts, "dim", "by", "id").sortWithinPartitions("dim", "by", "id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        number = TaskContext.get().partitionId() << 32

        def out():
            norms = [r[2] for r in held]
            raw = np.concatenate([r[1] for r in held]).astype("<f8").tobytes()
            row = [[number], [held[0][3]], [min(norms)], [max(norms)], [[r[0] for r in held]], [raw]]
            kinds = [pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds)], ["block", "dim", "least", "longest", "ids", "raw"])

        for rows in batches:
            vectors = rows.column("v")
            flat, cuts = vectors.flatten().to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()
            for i, (key, norm, dim) in enumerate(zip(*(rows.column(c).to_pylist() for c in ("id", "norm", "dim")))):
                if held and (len(held) == size or held[0][3] != dim):
                    yield out()
                    held, number = [], number + 1
                held.append((key, flat[cuts[i] - cuts[0]:cuts[i + 1] - cuts[0]], norm, dim))
        if held:
            yield out()

    return settled(placed.mapInArrow(work, BLOCK_TYPE), what)


def _matrix(raw: bytes, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<f8").reshape(n, dim)


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: in doubles while no sum can pass 2^53, else in Python's integers."""
    most = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * max(queries.shape[1], 1)
    if most < 2.0 ** 53:
        return (queries @ vectors.T).astype("i8")
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    exact = whole(queries) @ whole(vectors).T
    return np.array([[max(-1 << 63, min((1 << 63) - 1, x)) for x in row] for row in exact], "i8").reshape(exact.shape)


def _best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """The k highest (score, id) of one query, ties to smaller ids, without its own id."""
    open_ = ids != own
    scores, ids = scores[open_], ids[open_]
    if len(ids) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = scores >= kth
        scores, ids = scores[near], ids[near]
    order = np.lexsort((ids, -scores))[:k]
    return list(zip(scores[order].tolist(), ids[order].tolist()))


def search_block(q: np.ndarray, q_ids: np.ndarray, floor: np.ndarray, v: np.ndarray, v_ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query row, score, vector id): the best of one block for queries whose k-th best so far is `floor` (-inf: none)."""
    q_norm, v_norm = np.sqrt((q * q).sum(1)), np.sqrt((v * v).sum(1))
    longest, out, slack = v_norm.max(initial=0), [], 1e-6
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(q_norm * longest > 0, floor / (q_norm * longest), np.where(floor > 0, np.inf, -np.inf))  # the local cosine threshold
    coordinate = need >= PAYS
    plain = np.flatnonzero(~coordinate)
    for at in range(0, len(plain), 64):
        rows = plain[at:at + 64]
        reach = q_norm[rows].max(initial=0) * v_norm * (1 + slack) >= floor[rows].min(initial=np.inf)
        if not reach.any():
            continue
        for r, scores in zip(rows, products(q[rows], v[reach])):
            out += [(int(r), s, i) for s, i in _best(scores, v_ids[reach], q_ids[r], k)]
    v_rest = np.sqrt((v[:, HEAD:] ** 2).sum(1))
    for r in np.flatnonzero(coordinate & (need <= 1 + slack)):
        bound = v[:, :HEAD] @ q[r, :HEAD] + np.sqrt((q[r, HEAD:] ** 2).sum()) * v_rest
        left = bound + slack * (1 + np.abs(bound)) >= floor[r]
        if left.any():
            scores = products(q[r:r + 1], v[left])[0]
            out += [(int(r), s, i) for s, i in _best(scores, v_ids[left], q_ids[r], k)]
    return out


def top_k(vectors: DataFrame, queries: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the `k` vectors of largest integer inner product for every row of `queries` (all, if there are fewer)."""
    def clean(df):
        rows = df.filter(sound(F.col(vector)) & F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("id"), integers(F.col(vector), scale).alias("v"))
        return rows.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))

    ship(vectors.sparkSession)
    blocks = _blocks(clean(vectors), BLOCK, -F.col("norm"), "vectors")
    asked = _blocks(clean(queries), QUERIES, -F.col("norm"), "queries")

    small = ["block", "dim", "least", "longest"]
    heads = blocks.groupBy("dim").agg(F.max_by(F.struct("block"), F.struct("longest", "block")).alias("m")).select("dim", F.col("m.block").alias("block"))
    n_dims, n_asked = heads.count(), asked.count()

    def settle(df: DataFrame, bounded: bool) -> DataFrame:
        return F.broadcast(df) if bounded else df

    # thresholds from SEED vectors of the longest block of each dimension: at most 16 x SEED vectors are broadcast
    first = settle(blocks.join(settle(heads, n_dims <= 4096), ["dim", "block"]), n_dims <= 16)
    seeded = asked.join(first.select("dim", F.slice("ids", 1, SEED).alias("v_ids"), F.expr(f"substring(raw, 1, {8 * SEED} * dim)").alias("v_raw")), "dim")

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for r in rows.to_pylist():
                q_ids, v_ids = np.array(r["ids"], "i8"), np.array(r["v_ids"], "i8")
                q, v = _matrix(r["raw"], r["dim"], len(q_ids)), _matrix(r["v_raw"], r["dim"], len(v_ids))
                scores: list[list[int]] = [[] for _ in q_ids]
                for row, score, _ in search_block(q, q_ids, np.full(len(q), -np.inf), v, v_ids, k):
                    scores[row].append(score)
                floor = np.array([min(x) if len(x) == k else -np.inf for x in scores])
                norm = np.sqrt((q * q).sum(1))
                need = np.divide(floor, norm, out=np.where(floor > 0, np.inf, -np.inf), where=norm > 0).min()
                columns = [pa.array([r["block"]], pa.int64()), pa.array([floor.astype("<f8").tobytes()], pa.binary()), pa.array([need], pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, ["block", "floor", "need"])

    ready = settled(asked.join(seeded.mapInArrow(seed, "block bigint, floor binary, need double"), "block"), "asked")
    # which block meets which is settled on 40 bytes a block; a block too short for every query of another never travels there
    meets = blocks.select(*[F.col(c).alias(f"v_{c}") for c in small], F.col("dim")).join(
        settle(ready.select("dim", "block", "need"), n_asked <= 1_000_000), "dim").filter(F.col("v_longest") * (1 + 1e-6) >= F.col("need")).select("v_block", "block")
    sent = meets.join(blocks.select(F.col("block").alias("v_block"), F.col("ids").alias("v_ids"), F.col("raw").alias("v_raw")), "v_block")
    pairs = ready.drop("least", "longest", "need").join(sent, "block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for i in range(len(rows)):
                r = rows.slice(i, 1).to_pylist()[0]
                q_ids, v_ids = np.array(r["ids"], "i8"), np.array(r["v_ids"], "i8")
                q, v = _matrix(r["raw"], r["dim"], len(q_ids)), _matrix(r["v_raw"], r["dim"], len(v_ids))
                found = search_block(q, q_ids, np.frombuffer(r["floor"], "<f8"), v, v_ids, k)
                columns = [pa.array([r["block"]] * len(found), pa.int64()), pa.array([f[0] for f in found], pa.int32()), pa.array([int(q_ids[f[0]]) for f in found], pa.int64()),
                           pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["block", "row", "query_id", "score", "vec_id"])

    found = pairs.mapInArrow(search, "block bigint, row int, query_id bigint, score bigint, vec_id bigint")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("block", "row").orderBy(F.desc("score"), "vec_id"))).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op6_exact_top_k(spark: SparkSession, vectors: DataFrame) -> DataFrame:
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"))

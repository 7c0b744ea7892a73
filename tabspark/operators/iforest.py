"""Isolation forest (kernel K8): trees grown in parallel on small samples, scored over all rows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabspark.operators.sampling import bounded_sample

TREES, SAMPLE = 100, 256
EULER = 0.5772156649015329
NODES = "tree int, node int, feature int, threshold double, left int, right int, size int, depth int"


def _path_norm(n) -> np.ndarray:
    """Average path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype="float64")
    safe = np.maximum(n, 2.0)
    c = 2.0 * (np.log(safe - 1.0) + EULER) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, c))


def _grow(columns: int, seed: int):
    """One isolation tree per group of at most SAMPLE rows."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        x = pdf[[f"x{i}" for i in range(columns)]].to_numpy(dtype="float64")
        x = x[np.lexsort(x.T)]
        rng = np.random.default_rng([seed, tree])
        limit = math.ceil(math.log2(max(len(x), 2)))
        nodes, stack = [], [(0, np.arange(len(x)), 0)]
        slots = 1
        while stack:
            node, idx, depth = stack.pop()
            lo, hi = x[idx].min(axis=0), x[idx].max(axis=0)
            open_cols = np.nonzero(hi > lo)[0]
            if depth >= limit or len(idx) <= 1 or len(open_cols) == 0:
                nodes.append((tree, node, -1, 0.0, -1, -1, len(idx), depth))
                continue
            f = int(rng.choice(open_cols))
            cut = float(rng.uniform(lo[f], hi[f]))
            goes_left = x[idx, f] <= cut
            left, right, slots = slots, slots + 1, slots + 2
            nodes.append((tree, node, f, cut, left, right, len(idx), depth))
            stack += [(left, idx[goes_left], depth + 1), (right, idx[~goes_left], depth + 1)]
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "left", "right", "size", "depth"])
    return build


class IsolationForest:
    """Scores in (0, 1]; larger is more isolated. The model is at most TREES x (2*SAMPLE-1) nodes."""

    def __init__(self, trees: int = TREES, sample: int = SAMPLE, seed: int = 42):
        self.trees, self.sample, self.seed = trees, sample, seed

    def fit(self, df: DataFrame, columns: dict[str, Column], key: str) -> "IsolationForest":
        """``columns`` must not be null (fill them first); ``key`` orders the sample."""
        self.columns = list(columns)
        data = df.select(F.col(key).alias("_key"), *[c.cast("double").alias(f"x{i}") for i, c in enumerate(columns.values())])
        rows = data.count()
        self.psi = min(self.sample, rows)
        # a pool of at most trees x sample rows; from it every tree takes the sample with the smallest hashes of (key, tree)
        pool = bounded_sample(data, self.trees * self.sample, "_key", self.seed)
        each = pool.select("*", F.explode(F.sequence(F.lit(0), F.lit(self.trees - 1))).alias("tree"))
        roll = Window.partitionBy("tree").orderBy(F.xxhash64("_key", "tree", F.lit(self.seed)), "_key")
        drawn = each.withColumn("_r", F.row_number().over(roll)).filter(F.col("_r") <= self.psi).drop("_r")
        nodes = drawn.groupBy("tree").applyInPandas(_grow(len(self.columns), self.seed), NODES).collect()
        self.model = self._pack(nodes)
        return self

    @staticmethod
    def _pack(nodes) -> list[dict]:
        by_tree: dict[int, list] = {}
        for r in nodes:
            by_tree.setdefault(r["tree"], []).append(r)
        packed = []
        for t in sorted(by_tree):
            rows = sorted(by_tree[t], key=lambda r: r["node"])
            size = np.array([r["size"] for r in rows])
            packed.append({
                "feature": np.array([r["feature"] for r in rows]), "threshold": np.array([r["threshold"] for r in rows]),
                "left": np.array([r["left"] for r in rows]), "right": np.array([r["right"] for r in rows]),
                "length": np.array([r["depth"] for r in rows]) + _path_norm(size)})
        return packed

    def scores(self, df: DataFrame, columns: dict[str, Column], name: str = "score") -> DataFrame:
        """``df`` with one more column; vectorised over Arrow batches, the model is broadcast once."""
        model = df.sparkSession.sparkContext.broadcast(self.model)
        norm = max(float(_path_norm(self.psi)), 1e-12)

        @F.pandas_udf("double")
        def score(*cols: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype="float64") for c in cols])
            rows = np.arange(len(x))
            total = np.zeros(len(x))
            for t in model.value:
                at = np.zeros(len(x), dtype="int64")
                while True:
                    f = t["feature"][at]
                    go = f >= 0
                    if not go.any():
                        break
                    i = rows[go]
                    here = at[go]
                    left = x[i, f[go]] <= t["threshold"][here]
                    at[go] = np.where(left, t["left"][here], t["right"][here])
                total += t["length"][at]
            return pd.Series(np.power(2.0, -total / (len(model.value) * norm)))

        return df.withColumn(name, score(*[c.cast("double") for c in columns.values()]))

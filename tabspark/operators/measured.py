"""Moments and order statistics of numeric columns, taken once for all operators that ask for them."""

from __future__ import annotations

import math
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from tabspark.functions.types import dbl
from tabspark.operators.columnwise import STACK
from tabspark.operators.facts import Ranked
from tabspark.operators.quantiles import order_statistics, positions, proposed_cuts

# What a column's values are summed up in: how many there are and how many of them are NaN, the mean, sums of powers 2 to 4 about it, the ends.
NOTHING = (0.0, 0.0, 0.0, 0.0, 0.0, 0.0, math.nan, -math.inf)


def _summing():
    """Two functions of tasks, made here so that they travel by value: executors need not have this package."""
    def parts(x):
        """Of ascending values, NaN last."""
        if not len(x):
            return NOTHING
        with np.errstate(all="ignore"):
            mean = x[0] if x[0] == x[-1] else x.mean()  # rounding must not spread a constant
            d = x - mean
            d2 = d * d
            return len(x), np.isnan(x).sum(), mean, d2.sum(), d2 @ d, d2 @ d2, x[0], x[-1]

    def joined(a, b):
        """The parts (rows) of two sets of values of every column."""
        with np.errstate(all="ignore"):
            n = a[0] + b[0]
            (u, v), d = (x[0] / np.maximum(n, 1.0) for x in (a, b)), b[2] - a[2]
            out = np.array([
                n, a[1] + b[1],
                np.where(np.isfinite(d), a[2] + d * v, a[2] * u + b[2] * v),
                a[3] + b[3] + d**2 * n * u * v,
                a[4] + b[4] + d**3 * n * u * v * (u - v) + 3 * d * (u * b[3] - v * a[3]),
                a[5] + b[5] + d**4 * n * u * v * (u * u - u * v + v * v) + 6 * d**2 * (u * u * b[3] + v * v * a[3]) + 4 * d * (u * b[4] - v * a[4]),
                np.fmin(a[6], b[6]), np.maximum(a[7], b[7])])
        return np.where(a[0] == 0, b, np.where(b[0] == 0, a, out))

    return parts, joined


def _stats(rows: int, parts: np.ndarray) -> dict:
    """rows, n, nan, mean, std (sample), lo, hi, and the population skewness g1 and kurtosis g2; None where there is none."""
    n, nan, mean, m2, m3, m4, lo, hi = (float(x) for x in parts)
    out = {"rows": rows, "n": int(n), "nan": int(nan), **dict.fromkeys(("mean", "std", "lo", "hi", "g1", "g2"))}
    if n:
        out |= {"mean": mean, "lo": lo, "hi": hi, "std": math.sqrt(m2 / (n - 1)) if n > 1 else None}
        if m2:
            with np.errstate(all="ignore"):
                out |= {"g1": float(np.sqrt(n) * m3 / np.float64(m2) ** 1.5), "g2": float(n * m4 / np.float64(m2) ** 2 - 3)}
    return out


def scan(df: DataFrame, columns: dict[str, Column], cuts: dict[str, np.ndarray] | None = None) -> tuple[dict[str, dict], dict[str, np.ndarray]]:
    """name -> `_stats` over values that are not null (NaN is one, as in Spark's own aggregates), and name -> rows between the cut points.

    A batch of rows is summed up in arrays; a task leaves one row per column.
    """
    names = list(columns)
    edges = [(cuts or {}).get(c) for c in names]
    parts_of, joined = _summing()

    def measure(batches):
        rows, total, hist = 0, np.array([NOTHING] * len(names)).T, [np.zeros(0 if e is None else len(e) + 1, dtype="int64") for e in edges]
        for batch in batches:
            rows += batch.num_rows
            found = []
            for i, e in enumerate(edges):
                x = np.sort(batch.column(i).drop_null().to_numpy(zero_copy_only=False))
                found.append(parts_of(x))
                if e is not None:
                    present = len(x) - int(found[-1][1])
                    hist[i] += np.diff(np.searchsorted(x[:present], e, side="right"), prepend=0, append=present)
            total = joined(total, np.array(found, dtype="float64").T)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(names)), pa.int32()), pa.array([rows] * len(names), pa.int64()),
                                          pa.array([t.tobytes() for t in total.T], pa.binary()), pa.array([h.tobytes() for h in hist], pa.binary())],
                                         ["f", "rows", "parts", "hist"])

    def add(key, pdf):
        total = np.array(NOTHING)
        for p in pdf["parts"]:
            total = joined(total, np.frombuffer(p))
        hist = sum(np.frombuffer(h, dtype="int64") for h in pdf["hist"])
        return pd.DataFrame({"f": [key[0]], "rows": [pdf["rows"].sum()], "parts": [total.tobytes()], "hist": [hist.tobytes()]})

    schema = "f int, rows bigint, parts binary, hist binary"
    data = df.select(*[c.cast("double").alias(f"x{i}") for i, c in enumerate(columns.values())])
    got = {r["f"]: r for r in data.mapInArrow(measure, schema).groupBy("f").applyInPandas(add, schema).collect()}  # one row per column
    stats = {c: _stats(got[i]["rows"], np.frombuffer(got[i]["parts"])) if i in got else _stats(0, np.array(NOTHING)) for i, c in enumerate(names)}
    return stats, {c: np.frombuffer(got[i]["hist"], dtype="int64") for i, c in enumerate(names) if i in got}


class Measured:
    """One scan for the moments of all columns, and one selection for their quantiles that shares it, each when first asked for.

    ``probs`` are the quantiles wanted of the present values, ``filled`` those wanted after nulls take the median. The median is always there.
    """

    def __init__(self, df: DataFrame, columns: list[str], probs=(), filled=(), **limits):
        self.df, self.columns, self.probs, self.filled, self.limits = df, list(dict.fromkeys(columns)), sorted({0.5, *probs}), sorted(filled), limits

    @cached_property
    def _scanned(self) -> tuple[dict[str, dict], dict[str, tuple[np.ndarray, np.ndarray]]]:
        columns, rows = {c: dbl(c) for c in self.columns}, self.df.count()
        cuts = proposed_cuts(self.df, columns, rows, len(self._ranks(rows, 0)), **self.limits)
        stats: dict[str, dict] = {}
        hist: dict[str, np.ndarray] = {}
        for part in (self.columns[i:i + STACK] for i in range(0, len(self.columns), STACK)):
            found = scan(self.df, {c: columns[c] for c in part}, cuts)
            stats, hist = stats | found[0], hist | found[1]
        return stats, {c: (cuts[c], hist[c]) for c in cuts}

    @property
    def stats(self) -> dict[str, dict]:
        return self._scanned[0]

    def _ranks(self, n: int, nulls: int) -> set[int]:
        """Ranks of n values that the wanted quantiles need."""
        if not n:
            return set()
        return {r for p in self.probs for r in positions(n, p)[:2]} | set(Ranked.ranks(n, nulls, self.filled))

    def _nulls(self, c: str) -> int:
        return self.stats[c]["rows"] - self.stats[c]["n"]

    @cached_property
    def _values(self) -> dict[str, tuple[int, dict[int, float]]]:
        stats, counted = self._scanned
        counts = {c: s["n"] - s["nan"] for c, s in stats.items()}
        return order_statistics(self.df, {c: dbl(c) for c in self.columns}, lambda c, n: self._ranks(n, self._nulls(c)), counts=counts,
                                counted=counted, **self.limits)

    def quantile(self, c: str, p: float) -> float | None:
        """Linear-interpolated, of the values that are neither null nor NaN; None if there is none."""
        n, values = self._values[c]
        if n == 0:
            return None
        lo, hi, frac = positions(n, p)
        return float(values[lo] + (values[hi] - values[lo]) * frac)

    def median(self, c: str) -> float | None:
        return self.quantile(c, 0.5)

    def filled_quantiles(self, c: str) -> list[float]:
        """The quantiles ``filled`` of a column that has a median, with its nulls replaced by that."""
        n, values = self._values[c]
        ranked = Ranked(n, self._nulls(c), self.median(c), values, {})
        return [ranked.quantile(p) for p in self.filled]

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabspark.functions.types import dbl, numeric_columns, q
from tabspark.operators.aggregate import collect_aggregates
from tabspark.operators.stages.base import Stage


def _states(gaps: list[int], models: list[np.ndarray]):
    """Self-contained, so that it travels to the executors by value: standardised rows with NaN for nulls to their filled states."""
    def states(x):
        missing = np.isnan(x)
        state = last = np.where(missing, 0.0, x)
        for m in models:
            last, state = state, state.copy()
            state[:, gaps] = np.where(missing[:, gaps], m[:, 0] + last @ m[:, 1:].T, last[:, gaps])
        return missing, last, state
    return states


class IterativeImputer(Stage):
    """Fills nulls of several numeric columns from one another.

    Nulls start at the column's mean. In every round each column with nulls is regressed on all other columns, over the rows that have it and
    with the others filled as the round before left them; then all nulls are filled anew. A round is one scan: tasks replay the earlier
    rounds on their rows (a few products of small matrices), and send one matrix of cross products per column with nulls, so what is
    shuffled and collected depends on the number of columns only. Rounds end when no filled value moves by more than
    ``tolerance`` standard deviations, or after ``rounds``. ``ridge`` is the penalty per row on standardised slopes; collinear columns share
    their weight. A column without values is 0, and one without nulls in training takes its mean where a later frame has nulls.
    """

    def __init__(self, features: list[str] | None = None, rounds: int = 10, ridge: float = 0.0, tolerance: float = 1e-3):
        self.chosen, self.rounds, self.ridge, self.tolerance = features, rounds, ridge, tolerance

    def _learn(self, df: DataFrame) -> None:
        self.columns_ = [c for c in self.feature_names_in_ if c in self.chosen] if self.chosen else numeric_columns(df.select([q(c) for c in self.feature_names_in_]))
        got = collect_aggregates(df, {"rows": F.count(F.lit(1)), **{(c, s): f for c in self.columns_ for s, f in
                                                                   (("n", F.count(q(c))), ("mean", F.avg(dbl(c))), ("s", F.stddev_pop(dbl(c))))}})
        self.mean_ = np.array([got[c, "mean"] or 0.0 for c in self.columns_])
        self.scale_ = np.array([got[c, "s"] or 1.0 for c in self.columns_])
        self.gaps_ = [i for i, c in enumerate(self.columns_) if 0 < got[c, "n"] < got["rows"]]
        self.models_: list[np.ndarray] = []
        self.moved_ = None
        while self.gaps_ and len(self.models_) < self.rounds:
            products, moved = self._cross_products(df)
            if self.models_:
                self.moved_ = moved
                if moved <= self.tolerance:
                    break
            self.models_.append(np.stack([self._solve(i, p) for i, p in zip(self.gaps_, products)]))

    def _cross_products(self, df: DataFrame) -> tuple[list[np.ndarray], float]:
        """Per column with nulls, the cross products of (1, all filled columns) over the rows that have it; and the last round's largest move."""
        gaps, mean, scale, width = self.gaps_, self.mean_, self.scale_, len(self.columns_) + 1
        states = _states(gaps, self.models_)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, moved = np.zeros((len(gaps), width, width)), 0.0
            for rows in batches:
                if not rows.num_rows:
                    continue
                x = np.column_stack([c.to_numpy(zero_copy_only=False).astype("f8") for c in rows.columns])
                missing, last, state = states((x - mean) / scale)
                moved = max(moved, float(np.abs(state - last).max(initial=0.0)))
                z = np.column_stack([np.ones(len(x)), state])
                for k, i in enumerate(gaps):
                    seen = z[~missing[:, i]]
                    sums[k] += seen.T @ seen
            values = np.append(sums.ravel(), moved)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], ["cell", "value"])

        cells = df.select([dbl(c).alias(f"x{i}") for i, c in enumerate(self.columns_)]).mapInArrow(work, "cell bigint, value double")
        found = cells.groupBy("cell").agg(F.sum("value").alias("total"), F.max("value").alias("most")).collect()  # columns with nulls x columns^2
        size = len(gaps) * width * width
        sums = np.zeros(size)
        for r in found:
            if r["cell"] < size:
                sums[r["cell"]] = r["total"]
        return list(sums.reshape(len(gaps), width, width)), max((r["most"] for r in found if r["cell"] == size), default=0.0)

    def _solve(self, i: int, products: np.ndarray) -> np.ndarray:
        """Intercept and slopes (that of the column itself is 0)."""
        others = [0] + [j + 1 for j in range(len(self.columns_)) if j != i]
        penalty = np.diag([0.0] + [self.ridge * products[0, 0]] * (len(others) - 1))
        weights = np.zeros(len(self.columns_) + 1)
        weights[others] = np.linalg.lstsq(products[np.ix_(others, others)] + penalty, products[others, i + 1], rcond=None)[0]
        return weights

    def _apply(self, df: DataFrame) -> DataFrame:
        mean, scale, states = self.mean_, self.scale_, _states(self.gaps_, self.models_)

        def fill(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype="float64") for c in columns])
            return pd.Series(list(states((x - mean) / scale)[2] * scale + mean))

        # the udf runs as a function of named columns, whose annotations Spark reads
        filled = F.pandas_udf(fill, "array<double>")
        name = "_filled"
        while name in df.columns:
            name += "_"
        present = df.withColumn(name, filled(*[dbl(c) for c in self.columns_]))
        place = {c: i for i, c in enumerate(self.columns_)}
        return present.select([F.coalesce(dbl(c), F.col(name)[place[c]]).alias(c) if c in place else q(c) for c in df.columns])

    def get_reports(self) -> dict:
        return {"missing_values": {self.columns_[i]: {"strategy": "iterative", "rounds": len(self.models_)} for i in self.gaps_}}

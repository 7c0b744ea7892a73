from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabspark.functions.scalars import clip_sql, within
from tabspark.functions.types import dbl, numeric_columns
from tabspark.operators import facts
from tabspark.operators.columnwise import numeric_stats, outside_counts
from tabspark.operators.iforest import IsolationForest
from tabspark.operators.quantiles import medians, quantiles
from tabspark.operators.stages.base import Stage

METHODS = ("iqr", "z_score", "winsorize", "isolation_forest")


class OutlierTransformer(Stage):
    """Learns limits per column; clips to them, or removes training rows outside them (never on transform)."""

    def __init__(self, strategy: str = "clip", method: str = "iqr", threshold: float = 1.5, lower_quantile: float = 0.01,
                 upper_quantile: float = 0.99, contamination: float = 0.05, random_state: int = 42,
                 columns: list[str] | None = None, skip_binary: bool = False):
        self.strategy, self.method, self.threshold = strategy, method, threshold
        self.lower_quantile, self.upper_quantile = lower_quantile, upper_quantile
        self.contamination, self.random_state = contamination, random_state
        self.columns, self.skip_binary = columns, skip_binary

    def _learn(self, df: DataFrame) -> None:
        if self.method not in METHODS:
            raise ValueError(f"unknown outlier detection method: {self.method}")
        numeric = set(numeric_columns(df))
        wanted = self.feature_names_in_ if self.columns is None else self.columns
        cols = [c for c in self.feature_names_in_ if c in wanted and (c in numeric or self.columns is not None)]
        if self.skip_binary and cols:
            got = self._stats(df, cols)
            cols = [c for c in cols if got[c]["odd"]]
        self.limits_, self.outlier_counts_, self.forest_ = {}, {}, None
        if not cols:
            return
        if self.method == "isolation_forest":
            self._learn_forest(df, cols)
            return
        if self.method == "z_score":
            got = self._stats(df, cols)
            for c in cols:
                m, s = got[c]["mean"], got[c]["std"]
                if m is None:
                    continue
                # One value only: no deviation, so no limits (the limits would be undefined).
                self.limits_[c] = (m - self.threshold * s, m + self.threshold * s) if s is not None else (float("nan"), float("nan"))
        else:
            probs = [0.25, 0.75] if self.method == "iqr" else [self.lower_quantile, self.upper_quantile]
            got = {c: [facts.quantile(self.facts[c], p) for p in probs] for c in cols if c in self.facts}
            got.update({c: [self.ranked[c].quantile(p) for p in probs] for c in cols if c in self.ranked and c not in got})
            scanned = {c: dbl(c) for c in cols if c not in got}
            got.update(quantiles(df, scanned, probs) if scanned else {})
            for c, (a, b) in ((c, got[c]) for c in cols):
                if a is None:
                    continue
                reach = self.threshold * (b - a) if self.method == "iqr" else 0.0
                self.limits_[c] = (a - reach, b + reach)
        known = {c: (dbl(c), lo, hi) for c, (lo, hi) in self.limits_.items() if lo == lo and c not in self.facts}
        counts = outside_counts(df, known) if known else {}
        counts.update({c: facts.outside(self.facts[c], lo, hi) for c, (lo, hi) in self.limits_.items() if lo == lo and c in self.facts})
        self.outlier_counts_ = {c: counts.get(c, 0) for c in self.limits_}

    def _stats(self, df: DataFrame, cols: list[str]) -> dict[str, dict]:
        scanned = {c: dbl(c) for c in cols if c not in self.facts}
        return {**{c: facts.stats(self.facts[c]) for c in cols if c in self.facts}, **(numeric_stats(df, scanned) if scanned else {})}

    def facts_out(self) -> dict:
        if self.changes_rows or self.strategy != "clip":
            return {} if self.changes_rows else self.facts
        clean = {c: (lo, hi) for c, (lo, hi) in self.limits_.items() if lo == lo}
        return {c: facts.clipped(f, *clean[c]) if c in clean else f for c, f in self.facts.items()}

    def ranked_out(self) -> dict:
        if self.changes_rows or self.strategy != "clip":
            return {} if self.changes_rows else self.ranked
        clean = {c: (lo, hi) for c, (lo, hi) in self.limits_.items() if lo == lo}
        return {c: v.clipped(*clean[c]) if c in clean else v for c, v in self.ranked.items()}

    def quantiles_wanted(self) -> tuple[float, ...]:
        return {"iqr": (0.25, 0.75), "winsorize": (self.lower_quantile, self.upper_quantile)}.get(self.method, ())

    def _filled(self, columns: list[str]) -> dict[str, Column]:
        return {c: F.coalesce(dbl(c), F.lit(self.isolation_fill_values_[c])) for c in columns}

    def _learn_forest(self, df: DataFrame, cols: list[str]) -> None:
        if self.key is None:
            raise ValueError("isolation_forest needs a key column to draw its samples")
        self.isolation_columns_ = cols
        mid = medians(df, {c: dbl(c) for c in cols})
        self.isolation_fill_values_ = {c: 0.0 if mid[c] is None else mid[c] for c in cols}
        self.forest_ = IsolationForest(seed=self.random_state).fit(df, self._filled(cols), self.key)
        scored = self._scored(df).persist()
        # Scores are negated so that the contamination share lies at the low end.
        self.cut_ = quantiles(scored, {"s": -F.col("_score")}, [self.contamination])["s"][0]
        inliers = scored.filter(~self._isolated())
        self.outlier_counts_["__rows__"] = scored.count() - inliers.count()
        got = quantiles(inliers, self._filled(cols), [self.lower_quantile, self.upper_quantile])
        self.limits_ = {c: (v[0], v[1]) for c, v in got.items() if v[0] is not None}
        scored.unpersist()

    def _scored(self, df: DataFrame) -> DataFrame:
        return self.forest_.scores(df, self._filled(self.isolation_columns_), "_score")

    def _isolated(self) -> Column:
        return -F.col("_score") < F.lit(self.cut_)

    def _apply(self, df: DataFrame) -> DataFrame:
        if self.strategy != "clip":
            return df
        nullable = {f.name: f.nullable for f in df.schema.fields}
        return self.replace(df, {c: clip_sql(c, lo, hi, nullable[c]) for c, (lo, hi) in self.limits_.items() if c in nullable})

    def fit_transform(self, df: DataFrame, target: str | None = None, key: str | None = None) -> DataFrame:
        self.fit(df, target, key)
        if self.strategy != "remove":
            return self.transform(df)
        self.changes_rows = True
        if self.forest_ is not None:
            return self._scored(df).filter(~self._isolated()).drop("_score")
        keep = F.lit(True)
        for c, (lo, hi) in self.limits_.items():
            keep = keep & within(dbl(c), lo, hi)
        return df.filter(keep)

    def get_reports(self) -> dict:
        return {"outliers": {"method": self.method, "strategy": self.strategy,
                             "limits": {c: list(v) for c, v in self.limits_.items()},
                             "outlier_counts": dict(self.outlier_counts_)}}

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tabspark.functions.types import dbl, name_sql, number_sql, numeric_columns
from tabspark.operators import facts
from tabspark.operators.columnwise import numeric_stats
from tabspark.operators.quantiles import quantiles
from tabspark.operators.stages.base import Stage

STRATEGIES = ("standard", "minmax", "robust", "quantile", "quantile_normal", "none")
MAX_QUANTILES = 1000


def quantile_position(c: Column, grid: list[float], nullable: bool = True) -> Column:
    """Position in [0, 1] by linear interpolation over a quantile grid, averaged from both sides on ties."""
    knots = np.asarray(grid, dtype="float64")

    @F.pandas_udf("double")
    def position(x: pd.Series) -> pd.Series:
        v = x.to_numpy(dtype="float64")
        refs = np.linspace(0.0, 1.0, len(knots))
        up = np.interp(v, knots, refs)
        down = np.interp(-v, -knots[::-1], -refs[::-1])
        out = 0.5 * (up - down)
        out[v == knots[0]] = 0.0
        out[v == knots[-1]] = 1.0
        out = np.where(np.isnan(v), np.nan, np.clip(out, 0.0, 1.0))
        return pd.Series(out)

    return F.when(c.isNotNull(), position(c)) if nullable else position(c)


#: Positions nearer to 0 or 1 than this become the score of this one (5.2 standard deviations), so that no score is infinite.
NORMAL_EDGE = 1e-7
#: Coefficients of the rational forms of the inverse normal function, highest power first, inside and in the tails.
CENTRE = ([-39.69683028665376, 220.9460984245205, -275.9285104469687, 138.3577518672690, -30.66479806614716, 2.506628277459239],
          [-54.47609879822406, 161.5858368580409, -155.6989798598866, 66.80131188771972, -13.28068155288572, 1.0])
TAIL = ([-0.007784894002430293, -0.3223964580411365, -2.400758277161838, -2.549732539343734, 4.374664141464968, 2.938163982698783],
        [0.007784695709041462, 0.3224671290700398, 2.445134137142996, 3.754408661907416, 1.0])
TAIL_FROM = 0.02425


def _polynomial(x: Column, coefficients: list[float]) -> Column:
    value = F.lit(coefficients[0])
    for c in coefficients[1:]:
        value = value * x + F.lit(c)
    return value


def normal_score(position: Column) -> Column:
    """The standard normal value below which a share `position` lies, to a relative error of 1.2e-9; null for null."""
    p = F.greatest(F.lit(NORMAL_EDGE), F.least(position, F.lit(1 - NORMAL_EDGE)))
    near = F.least(p, 1 - p)
    r = F.sqrt(-2 * F.log(near))
    tail = _polynomial(r, TAIL[0]) / _polynomial(r, TAIL[1])
    d = p - 0.5
    centre = _polynomial(d * d, CENTRE[0]) * d / _polynomial(d * d, CENTRE[1])
    return F.when(position.isNull(), None).when(near >= TAIL_FROM, centre).when(p < 0.5, tail).otherwise(-tail)


class FeatureScaler(Stage):
    """standard (ddof 0), minmax, robust, quantile (uniform on [0, 1]), quantile_normal (the normal score of that position) or none per
    column; 0/1 columns are left alone."""

    def __init__(self, default_strategy: str = "standard", column_strategies: dict | None = None,
                 exclude_cols: list[str] | None = None, n_quantiles: int = MAX_QUANTILES):
        self.default_strategy, self.column_strategies = default_strategy, column_strategies or {}
        self.exclude_cols, self.n_quantiles = list(exclude_cols or []), n_quantiles

    def _learn(self, df: DataFrame) -> None:
        cols = [c for c in numeric_columns(df) if c in self.feature_names_in_ and c not in self.exclude_cols]
        self.scalers_: dict[str, tuple] = {}
        if not cols:
            return
        strategy = {c: self.column_strategies.get(c, self.default_strategy) for c in cols}
        got = {c: facts.stats(self.facts[c]) for c in cols if c in self.facts}
        for c in (c for c in cols if c in self.ranked and c not in got and strategy[c] == "robust"):  # quartiles are enough
            odd = self.ranked[c].has_odd()
            if odd is not None:
                got[c] = {"n": self.ranked[c].n + self.ranked[c].k, "odd": int(odd)}
        scanned = {c: dbl(c) for c in cols if c not in got}
        got.update(numeric_stats(df, scanned) if scanned else {})
        cols = [c for c in cols if got[c]["n"] and got[c]["odd"]]
        for c in cols:
            if strategy[c] not in STRATEGIES:
                raise ValueError(f"unknown scaling strategy: {strategy[c]}")
        robust = [c for c in cols if strategy[c] == "robust"]
        counts = {c: got[c]["n"] for c in cols}
        spread = self._quantiles(df, robust, [0.25, 0.5, 0.75], counts)
        ranked = [c for c in cols if strategy[c].startswith("quantile")]
        k = max(1, min(self.n_quantiles, df.count())) if ranked else 1
        probs = [i / (k - 1) for i in range(k)] if k > 1 else [0.0]
        grids = self._quantiles(df, ranked, probs, counts)
        for c in cols:
            s = got[c]
            if strategy[c] == "standard":
                self.scalers_[c] = ("standard", s["mean"], s["std_pop"] or 1.0)
            elif strategy[c] == "minmax":
                self.scalers_[c] = ("minmax", s["lo"], (s["hi"] - s["lo"]) or 1.0)
            elif strategy[c] == "robust":
                q1, mid, q3 = spread[c]
                self.scalers_[c] = ("robust", mid, (q3 - q1) or 1.0)
            elif strategy[c].startswith("quantile"):
                self.scalers_[c] = (strategy[c], list(np.maximum.accumulate(grids[c])), None)

    def _quantiles(self, df: DataFrame, cols: list[str], probs: list[float], counts: dict[str, int]) -> dict:
        got = {c: [facts.quantile(self.facts[c], p) for p in probs] for c in cols if c in self.facts}
        if set(probs) <= set(self.quantiles_wanted()):
            got.update({c: [self.ranked[c].quantile(p) for p in probs] for c in cols if c in self.ranked and c not in got})
        scanned = {c: dbl(c) for c in cols if c not in got}
        return {**got, **(quantiles(df, scanned, probs, counts={c: counts[c] for c in scanned}) if scanned else {})}

    def quantiles_wanted(self) -> tuple[float, ...]:
        return (0.25, 0.5, 0.75) if "robust" in (self.default_strategy, *self.column_strategies.values()) else ()

    def _apply(self, df: DataFrame) -> DataFrame:
        new, nullable = {}, {f.name: f.nullable for f in df.schema.fields}
        # positions come first, once each: the score reads them many times
        normal, taken = [c for c, (kind, *_) in self.scalers_.items() if kind == "quantile_normal" and c in nullable], {c.lower() for c in nullable}
        places = {}
        for i, c in enumerate(normal):
            places[c] = f"_place{i}"
            while places[c] in taken:
                places[c] += "_"
        df = df.withColumns({places[c]: quantile_position(dbl(c), self.scalers_[c][1], nullable[c]) for c in normal}) if normal else df
        for c, (kind, a, b) in self.scalers_.items():
            if c in nullable and kind == "quantile_normal":
                new[c] = normal_score(F.col(places[c]))
            elif c in nullable:
                new[c] = quantile_position(dbl(c), a, nullable[c]) if kind == "quantile" else \
                    f"(CAST({name_sql(c)} AS DOUBLE) - ({number_sql(a)})) / ({number_sql(b)})"
        return self.replace(df, new).drop(*places.values())

    def get_reports(self) -> dict:
        def finite(v):
            return None if v is None or (isinstance(v, float) and math.isnan(v)) else v
        return {"scaling": {c: {"strategy": s[0], **({} if s[0].startswith("quantile") else {"center": finite(s[1]), "scale": finite(s[2])})}
                            for c, s in self.scalers_.items()}}

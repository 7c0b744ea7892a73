from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabspark.functions.types import dbl, family_of, name_sql, number_sql, q, text_sql
from tabspark.operators.aggregate import collect_aggregates, value_counts
from tabspark.operators.columnwise import numeric_stats
from tabspark.operators.facts import Ranked, of_flag
from tabspark.operators.quantiles import order_statistics, positions
from tabspark.operators.stages.base import Stage

NUMERIC_STRATEGIES = ("median", "mean", "constant", "knn", "iterative")
CATEGORICAL_STRATEGIES = ("most_frequent", "mode", "constant")
SUFFIX = "_isnull"


class MissingValueTransformer(Stage):
    """Fills nulls per column and appends 0/1 indicators for columns with nulls in training.

    'knn' and 'iterative' look at one column at a time, where neighbours and regressions have nothing to
    use, so both equal the column mean.
    """

    def __init__(self, num_strategy: str = "median", num_fill_value=None, cat_strategy: str = "constant",
                 cat_fill_value: str = "Unknown", add_indicators: bool = True, column_strategies: dict | None = None,
                 knn_neighbors: int = 5):
        self.num_strategy, self.num_fill_value = num_strategy, num_fill_value
        self.cat_strategy, self.cat_fill_value = cat_strategy, cat_fill_value
        self.add_indicators, self.column_strategies = add_indicators, column_strategies or {}
        self.knn_neighbors = knn_neighbors

    def _learn(self, df: DataFrame) -> None:
        cols = self.feature_names_in_
        family = {c: family_of(df.schema[c].dataType) for c in cols}
        plan: dict[str, tuple[str, object]] = {}
        for c in cols:
            if family[c] in ("datetime", "other"):
                continue
            numeric = family[c] in ("numeric", "boolean")
            own = self.column_strategies.get(c, {})
            strategy = own.get("strategy", self.num_strategy if numeric else self.cat_strategy)
            if strategy not in (NUMERIC_STRATEGIES if numeric else CATEGORICAL_STRATEGIES):
                raise ValueError(f"unknown {'numerical' if numeric else 'categorical'} imputation strategy: {strategy}")
            plan[c] = (strategy, own.get("fill_value", self.num_fill_value if numeric else self.cat_fill_value))
        numbers = {c for c in plan if family[c] in ("numeric", "boolean")}
        values, known = self.seen.get("values", {}), self.seen.get("stats", {})
        new = {("n", c): F.expr(f"count_if({name_sql(c)} IS NULL)") for c in cols if c not in values}
        if new or self.rows_known is None:
            new["rows"] = F.count(F.lit(1))
        got = collect_aggregates(df, new)
        self.rows_ = got.get("rows", self.rows_known)
        nulls = {c: got["n", c] if ("n", c) in got else self.rows_ - values[c]["n"] for c in cols}
        stats = {c: known[c] for c in cols if c in numbers and c in known}
        rest = {c: dbl(c) for c in cols if c in numbers and c not in stats}
        stats.update(numeric_stats(df, rest) if rest else {})
        mid = [c for c in numbers if plan[c][0] == "median"]
        medians_, ordered = self._order(df, mid, numbers, stats, self.rows_)
        modes = self._modes(df, [c for c in plan if c not in numbers and plan[c][0] in ("most_frequent", "mode")])
        self.fill_, self.report_ = {}, {}
        for c, (strategy, given) in plan.items():
            if c not in numbers:
                value = str(modes.get(c, given) if strategy in ("most_frequent", "mode") else given)
                shown = "most_frequent" if strategy == "mode" else strategy
                self.fill_[c], self.report_[c] = value, {"strategy": shown, "value": value}
                continue
            if strategy == "median":
                value = medians_[c]
            elif strategy == "constant":
                value = given
            else:
                value = stats[c]["mean"]
            self.fill_[c] = 0.0 if value is None else float(value)
            self.report_[c] = {"strategy": strategy} if strategy in ("knn", "iterative") else \
                {"strategy": strategy, "value": self.fill_[c]}
        self.missing_indicator_cols_ = [c + SUFFIX for c in cols if nulls[c]] if self.add_indicators else []
        self.numeric_, self.nulls_ = numbers, nulls
        self.ranked_ = {c: Ranked(n, self.rows_ - n, self.fill_[c], values, stats[c]) for c, (n, values) in ordered.items() if n}
        self.feature_names_out_ = [c for c in cols if c in plan or family[c] in ("datetime", "other")] + self.missing_indicator_cols_

    def _order(self, df: DataFrame, mid: list[str], numbers: set[str], stats: dict, rows: int) -> tuple[dict, dict]:
        """Medians, and in the same pass the ranks that later stages need of the filled columns."""
        cols = [c for c in self.feature_names_in_ if c in (numbers if self.asked else set(mid))]
        if not cols:
            return {}, {}

        def ranks(c: str, n: int) -> list[int]:
            own = [r for r in positions(n, 0.5)[:2]] if c in mid and n else []
            return own + (Ranked.ranks(n, rows - n, self.asked) if n else [])

        got = order_statistics(df, {c: dbl(c) for c in cols}, ranks, counts={c: stats[c]["n"] for c in cols})
        middle = {}
        for c in mid:
            n, values = got[c]
            lo, hi, part = positions(n, 0.5) if n else (0, 0, 0.0)
            middle[c] = float(values[lo] + (values[hi] - values[lo]) * part) if n else None
        return middle, got if self.asked else {}

    @staticmethod
    def _modes(df: DataFrame, columns: list[str]) -> dict[str, str]:
        """Most frequent value per column, the smallest on ties; one histogram shuffle for all columns."""
        if not columns:
            return {}
        best = (value_counts(df, columns).groupBy("feature")
                .agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("value").alias("v"))).alias("top")))
        return {r["feature"]: r["top"]["v"] for r in best.collect()}

    def _apply(self, df: DataFrame) -> DataFrame:
        present = set(df.columns)
        out = []
        for c in df.columns:
            n = name_sql(c)
            if c not in self.fill_:
                out.append(n)
            elif c in self.numeric_:
                out.append(f"coalesce(CAST({n} AS DOUBLE), {number_sql(self.fill_[c])}) AS {n}")
            else:
                out.append(f"coalesce(CAST({n} AS STRING), {text_sql(self.fill_[c])}) AS {n}")
        for name in self.missing_indicator_cols_:
            source = name[: -len(SUFFIX)]
            out.append(f"{f'CAST({name_sql(source)} IS NULL AS INT)' if source in present else '0'} AS {name_sql(name)}")
        return df.selectExpr(*out)

    def facts_out(self) -> dict:
        return {name: of_flag(self.rows_, self.nulls_[name[: -len(SUFFIX)]]) for name in self.missing_indicator_cols_}

    def ranked_out(self) -> dict:
        return self.ranked_

    def get_reports(self) -> dict:
        return {"missing_values": self.report_}

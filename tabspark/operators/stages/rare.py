from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tabspark.functions.types import categorical_columns, name_sql, q
from tabspark.operators.aggregate import value_counts
from tabspark.operators.mapping import build_maps, with_lookups
from tabspark.operators.stages.base import Stage


class RareCategoryTransformer(Stage):
    """Replaces infrequent and unseen levels by one fill value; nulls stay null.

    Rule precedence: top_k, then threshold_count, then threshold_pct (share of all rows).
    """

    def __init__(self, threshold_pct: float = 0.01, threshold_count: int | None = None, top_k: int | None = None,
                 fill_value: str = "OTHER", exclude_cols: list[str] | None = None):
        self.threshold_pct, self.threshold_count, self.top_k = threshold_pct, threshold_count, top_k
        self.fill_value, self.exclude_cols = fill_value, list(exclude_cols or [])

    def _learn(self, df: DataFrame) -> None:
        cols = [c for c in categorical_columns(df) if c in self.feature_names_in_ and c not in self.exclude_cols]
        self.columns_, self.maps_ = cols, {}
        if not cols:
            return
        counts = value_counts(df, cols)
        if self.top_k is not None:
            order = Window.partitionBy("feature").orderBy(F.desc("n"), "value")
            kept = counts.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= self.top_k)
        elif self.threshold_count is not None:
            kept = counts.filter(F.col("n") >= self.threshold_count)
        else:
            rows = df.count() if self.rows_known is None else self.rows_known
            kept = counts.filter(F.col("n") / F.lit(max(rows, 1)) >= self.threshold_pct)
        kept = kept.select("feature", "value", F.lit(True).alias("result"), "n")
        self.maps_ = build_maps(kept, cols, "boolean")

    def facts_out(self) -> dict:
        return {c: f for c, f in self.facts.items() if c not in self.columns_}

    def ranked_out(self) -> dict:
        return {c: v for c, v in self.ranked.items() if c not in self.columns_}

    @property
    def frequent_categories_(self) -> dict[str, list[str]]:
        return {c: sorted(m.entries) for c, m in self.maps_.items() if m.entries is not None}

    def _apply(self, df: DataFrame) -> DataFrame:
        cols = [c for c in self.columns_ if c in df.columns]
        few = [c for c in cols if self.maps_[c].entries is not None and len(self.maps_[c].entries) <= 200]
        kept = {c: q(c).isin(sorted(self.maps_[c].entries)) for c in few}
        joined, found = with_lookups(df, [(c, self.maps_[c], q(c)) for c in cols if c not in few])
        kept.update({c: e.isNotNull() for c, e in zip([c for c in cols if c not in few], found)})
        new = {c: F.when(q(c).isNull() | kept[c], q(c)).otherwise(F.lit(self.fill_value)) for c in cols}
        return joined.select([new[c].alias(c) if c in new else name_sql(c) for c in df.columns])

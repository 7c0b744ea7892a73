"""The stage contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabspark.functions.scalars import without_nan
from tabspark.functions.types import name_sql
from tabspark.operators.facts import Fact, Ranked


class Stage:
    """Learns from a training frame, then maps any frame of the same features.

    ``target`` and ``key`` name columns that travel with the rows but are not features: the target is the
    label, the key identifies and orders rows (there is no implicit row index). Both are optional on
    `transform`. ``changes_rows`` is set by fit_transform when training rows were dropped.
    """

    target: str | None = None
    key: str | None = None
    changes_rows = False
    # What earlier stages of a run know of the frame to fit: values and counts of flag columns, order statistics of filled columns,
    # the quantiles that later stages will ask for, and the number of rows.
    facts: dict[str, Fact] = {}
    ranked: dict[str, Ranked] = {}
    asked: tuple[float, ...] = ()
    rows_known: int | None = None
    nan_free = False
    seen: dict[str, dict] = {}  # value profiles ("values") and numeric statistics ("stats") of the frame to fit
    _fitted = False

    def fit(self, df: DataFrame, target: str | None = None, key: str | None = None) -> "Stage":
        df = df if self.nan_free else without_nan(df)
        self.target, self.key = target, key
        self.feature_names_in_ = self.features(df)
        self.feature_names_out_ = list(self.feature_names_in_)
        self._learn(df)
        self._fitted = True
        return self

    def _learn(self, df: DataFrame) -> None:
        raise NotImplementedError

    def _apply(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def transform(self, df: DataFrame) -> DataFrame:
        if not self._fitted:
            raise ValueError(f"{type(self).__name__} is not fitted yet; call fit or fit_transform first")
        return self._apply(df if self.nan_free else without_nan(df))

    def fit_transform(self, df: DataFrame, target: str | None = None, key: str | None = None) -> DataFrame:
        return self.fit(df, target, key).transform(df)

    def facts_out(self) -> dict[str, Fact]:
        """What is known of the transformed training frame; by default nothing survives a change of columns."""
        return {}

    def ranked_out(self) -> dict[str, Ranked]:
        return {}

    def seen_out(self) -> dict[str, dict]:
        return {}

    def quantiles_wanted(self) -> tuple[float, ...]:
        """Quantiles of numeric columns that the fit will look for."""
        return ()

    def get_feature_names_out(self) -> list[str]:
        return list(self.feature_names_out_)

    def get_reports(self) -> dict:
        return {}

    def features(self, df: DataFrame) -> list[str]:
        return [c for c in df.columns if c not in (self.target, self.key)]

    def replace(self, df: DataFrame, new: dict) -> DataFrame:
        """One projection that swaps the given columns (expressions, or SQL text) in place."""
        if all(isinstance(e, str) for e in new.values()):
            return df.selectExpr(*[f"{new[c]} AS {name_sql(c)}" if c in new else name_sql(c) for c in df.columns])
        made = {c: F.expr(e) if isinstance(e, str) else e for c, e in new.items()}
        return df.select([made[c].alias(c) if c in made else name_sql(c) for c in df.columns])

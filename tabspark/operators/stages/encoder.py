from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabspark.functions.types import categorical_columns, name_sql, q, text_sql
from tabspark.operators.aggregate import value_counts
from tabspark.operators.facts import of_flag
from tabspark.operators.mapping import build_maps, with_lookups
from tabspark.operators.oof import (NULL_LEVEL, fold_of, fold_priors, order_of, ordered_means, out_of_fold_means,
                                    smoothed_means)
from tabspark.operators.ordering import running_totals
from tabspark.operators.stages.base import Stage

STRATEGIES = ("one_hot", "ordinal", "frequency", "target", "catboost")
ONE_HOT_WIDTH = 2000


class EncodingTransformer(Stage):
    """Categorical columns to numbers: one_hot, ordinal, frequency, target, catboost.

    On training data, target and catboost are out-of-fold: each row gets the statistic of the folds it is
    not in. Folds come from a hash of the key, or from ``fold`` (0..k-1, SQL text or Column) if given; the
    catboost order from another hash, or from ``order``. A one-hot column of more than ONE_HOT_WIDTH levels
    becomes one column, a map that holds its learned level with 1.0, and nothing for other levels; `one_hot_rows` has any in long form.
    """

    def __init__(self, default_strategy: str = "one_hot", column_strategies: dict | None = None, target_cv_folds: int = 5,
                 target_smoothing: float = 10.0, catboost_prior: float = 10.0, random_state: int = 42,
                 handle_unknown: str = "ignore", fold: str | Column | None = None, order: str | Column | None = None):
        if handle_unknown != "ignore":
            raise ValueError("handle_unknown supports 'ignore' only")
        self.default_strategy, self.column_strategies = default_strategy, column_strategies or {}
        self.target_cv_folds, self.target_smoothing = target_cv_folds, target_smoothing
        self.catboost_prior, self.random_state = catboost_prior, random_state
        self.fold = F.expr(fold) if isinstance(fold, str) else fold
        self.order = F.expr(order) if isinstance(order, str) else order

    def _of(self, *names: str) -> list[str]:
        return [c for c, s in self.strategy_.items() if s in names]

    def _learn(self, df: DataFrame) -> None:
        cols = [c for c in categorical_columns(df) if c in self.feature_names_in_]
        self.strategy_ = {c: self.column_strategies.get(c, self.default_strategy) for c in cols}
        for s in self.strategy_.values():
            if s not in STRATEGIES:
                raise ValueError(f"unknown encoding strategy: {s}")
        self.maps_, self.default_, self.levels_ = {}, {}, {}
        hot, freq = self._of("one_hot"), self._of("frequency")
        target_like = self._of("target", "catboost") if self.target is not None else []
        ordinal = self._of("ordinal") + ([] if self.target is not None else self._of("target", "catboost"))
        if hot:
            self._learn_levels(df, hot)
        if freq:
            counts = value_counts(df, freq)
            totals = {r["feature"]: r["t"] for r in counts.groupBy("feature").agg(F.sum("n").alias("t")).collect()}
            share = F.lit(None).cast("double")
            for c in freq:
                share = F.when(F.col("feature") == c, F.col("n") / F.lit(totals.get(c, 1))).otherwise(share)
            self.maps_.update(build_maps(counts.select("feature", "value", share.alias("result"), "n"), freq))
            self.default_.update({c: 0.0 for c in freq})
        if ordinal:
            self.maps_.update(build_maps(self._first_seen(df, ordinal), ordinal))
            self.default_.update({c: -1.0 if self.strategy_[c] == "ordinal" else 0.0 for c in ordinal})
        if target_like:
            folds = self.target_cv_folds
            self.prior_, self.fold_priors_, self.rows_ = fold_priors(df, self.target, self._fold(), folds)
            for name, m in (("target", self.target_smoothing), ("catboost", self.catboost_prior)):
                mine = self._of(name)
                if mine:
                    self.maps_.update(build_maps(smoothed_means(df, mine, self.target, m, self.prior_), mine))
                    self.default_.update({c: self.prior_ for c in mine})
        self.feature_names_out_ = [n for c in self.feature_names_in_ for n in self._outputs(c)]

    def _learn_levels(self, df: DataFrame, hot: list[str]) -> None:
        counts = (value_counts(df, hot, drop_null=False).groupBy("feature", F.coalesce("value", F.lit(NULL_LEVEL)).alias("value"))
                  .agg(F.sum("n").alias("n")))
        sums = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("t")).collect()
        sizes, totals = {r["feature"]: r["k"] for r in sums}, {r["feature"]: r["t"] for r in sums}
        self.wide_ = [c for c in hot if sizes.get(c, 0) > ONE_HOT_WIDTH]
        if self.wide_:
            ones = counts.filter(F.col("feature").isin(self.wide_)).select("feature", "value", F.lit(1.0).alias("result"), F.lit(1).cast("bigint").alias("n"))
            self.wide_maps_ = build_maps(ones, self.wide_)
        narrow = [c for c in hot if c not in self.wide_]
        self.levels_, self.hot_ = {c: [] for c in narrow}, {}
        for r in counts.filter(F.col("feature").isin(narrow)).collect():  # at most ONE_HOT_WIDTH rows per feature
            self.levels_[r["feature"]].append(r["value"])
            self.hot_[f"{r['feature']}_{r['value']}"] = of_flag(totals[r["feature"]], r["n"])
        self.levels_ = {c: sorted(v) for c, v in self.levels_.items()}

    def facts_out(self) -> dict:
        kept = {c: f for c, f in self.facts.items() if c not in self.strategy_}
        made = getattr(self, "hot_", {})
        names = self.feature_names_out_  # a level may make a name that another column has
        return {c: f for c, f in {**kept, **made}.items() if names.count(c) == 1}

    def ranked_out(self) -> dict:
        return {c: v for c, v in self.ranked.items() if c not in self.strategy_ and self.feature_names_out_.count(c) == 1}

    def _first_seen(self, df: DataFrame, cols: list[str]) -> DataFrame:
        """Codes 0, 1, ... by first appearance in key order."""
        if self.key is None:
            raise ValueError("ordinal encoding by first appearance needs a key column that orders the rows")
        firsts = value_counts(df, cols, {"first": F.min("_by_0")}, by=[self.key])
        coded = running_totals(firsts, "feature", ["first", "value"], F.lit(1).cast("long"))
        return coded.select("feature", "value", F.col("before").cast("double").alias("result"), "n")

    def _fold(self) -> Column:
        if self.fold is not None:
            return self.fold.cast("int")
        if self.key is None:
            raise ValueError("out-of-fold encoding needs a key column (or an explicit fold)")
        return fold_of(q(self.key), self.target_cv_folds, self.random_state)

    def _outputs(self, c: str) -> list[str]:
        return [f"{c}_{v}" for v in self.levels_[c]] if c in self.levels_ else [c]

    def _one_hot(self, c: str) -> list[str]:
        level = f"coalesce(CAST({name_sql(c)} AS STRING), {text_sql(NULL_LEVEL)})"
        return [f"CAST({level} = {text_sql(v)} AS DOUBLE) AS {name_sql(f'{c}_{v}')}" for v in self.levels_[c]]

    def _wide(self, df: DataFrame) -> tuple[list[str], list]:
        """One-hot columns that become maps, and how their levels are looked up."""
        wide = [c for c in getattr(self, "wide_", []) if c in df.columns]
        return wide, [(c, self.wide_maps_[c], self._level(c)) for c in wide]

    @staticmethod
    def _level(c: str) -> Column:
        return F.coalesce(q(c).cast("string"), F.lit(NULL_LEVEL))

    def _map(self, c: str, found: Column) -> Column:
        return F.when(found.isNotNull(), F.create_map(self._level(c), F.lit(1.0))).otherwise(F.create_map().cast("map<string,double>"))

    def _project(self, df: DataFrame, encoded: dict[str, Column], source: DataFrame) -> DataFrame:
        out: list = []
        for c in df.columns:
            if c in self.levels_:
                out += self._one_hot(c)
            else:
                out.append(encoded[c].alias(c) if c in encoded else name_sql(c))
        if not encoded:
            return source.selectExpr(*out)
        return source.select([F.expr(e) if isinstance(e, str) else e for e in out])

    def _apply(self, df: DataFrame) -> DataFrame:
        cols = [c for c in df.columns if c in self.maps_]
        wide, levels = self._wide(df)
        joined, found = with_lookups(df, [(c, self.maps_[c], q(c).cast("string")) for c in cols] + levels)
        encoded = {c: F.coalesce(e, F.lit(self.default_[c])) for c, e in zip(cols, found)}
        encoded.update({c: self._map(c, e) for c, e in zip(wide, found[len(cols):])})
        return self._project(df, encoded, joined)

    def fit_transform(self, df: DataFrame, target: str | None = None, key: str | None = None) -> DataFrame:
        self.fit(df, target, key)
        held = [c for c in self._of("target", "catboost") if c in df.columns]
        if target is None or not held:
            return self.transform(df)
        folds, fold = self.target_cv_folds, self._fold()
        oof = {}
        means, ordered = self._of("target"), self._of("catboost")
        if means:
            oof.update(build_maps(out_of_fold_means(df, means, target, fold, folds, self.target_smoothing,
                                                    self.fold_priors_), means, "array<double>"))
        if ordered:
            order = self.order if self.order is not None else order_of(q(key), self.random_state)
            tie = q(key) if key is not None else F.lit(0)
            span = None if self.order is not None else (0.0, float(1 << 52))
            oof.update(build_maps(ordered_means(df, ordered, target, fold, folds, self.catboost_prior, self.fold_priors_,
                                                order, tie, self.rows_, span), ordered, "array<double>"))
        plain = [c for c in df.columns if c in self.maps_ and c not in held]
        keys = {c: (F.coalesce(q(c).cast("string"), F.lit(NULL_LEVEL)) if self.strategy_[c] == "catboost" else q(c).cast("string"))
                for c in held}
        wanted = [(c, oof[c], keys[c]) for c in held] + [(c, self.maps_[c], q(c).cast("string")) for c in plain]
        wide, levels = self._wide(df)
        joined, found = with_lookups(df, wanted + levels)
        priors = F.array(*[F.lit(p).cast("double") for p in self.fold_priors_])
        encoded = {}
        for c, e in zip(held + plain, found):
            encoded[c] = F.get(F.coalesce(e, priors), fold) if c in held else F.coalesce(e, F.lit(self.default_[c]))
        encoded.update({c: self._map(c, e) for c, e in zip(wide, found[len(wanted):])})
        return self._project(df, encoded, joined)

    def one_hot_rows(self, df: DataFrame, key: str) -> DataFrame:
        """(key, column, value=1.0): the one-hot cells that are not zero, for any number of levels; levels that were not learned have none."""
        cells = []
        wide, levels = self._wide(df)
        df, found = with_lookups(df, levels) if wide else (df, [])
        for c in self._of("one_hot"):
            known = found[wide.index(c)].isNotNull() if c in wide else self._level(c).isin(self.levels_[c])
            cells.append(F.when(known, F.concat(F.lit(c + "_"), self._level(c))))
        if not cells:
            return df.select(q(key).alias(key), F.lit(None).cast("string").alias("column"), F.lit(1.0).alias("value")).limit(0)
        return df.select(q(key).alias(key), F.explode(F.array_compact(F.array(*cells))).alias("column"), F.lit(1.0).alias("value"))

    def get_reports(self) -> dict:
        shown = {}
        for c, s in self.strategy_.items():
            fallback = self.target is None and s in ("target", "catboost")
            shown[c] = {"strategy": s + "_fallback" if fallback else s, "output_columns": self._outputs(c)}
        return {"encodings": shown}

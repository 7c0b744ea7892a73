"""Exploratory statistics: target, univariate, against the target, correlation, outliers, missingness, PCA."""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabspark.functions.scalars import without_nan
from tabspark.functions.statistics import adjusted_kurtosis, adjusted_skew, ratio
from tabspark.functions.types import categorical_columns, dbl, numeric_columns, q
from tabspark.operators.aggregate import class_cells, collect_aggregates, long_values, per_feature, small_frame, value_counts
from tabspark.operators.mapping import ValueMap, with_lookups
from tabspark.operators.moments import correlation_pairs, dense_correlation, symmetric
from tabspark.operators.measured import Measured
from tabspark.operators.mutual_info import EDGES, categorical_information, numeric_information
from tabspark.operators.ordering import average_ranks, running_totals
from tabspark.operators.quantiles import medians, quantiles


# ---- target -----------------------------------------------------------------------------------

def target_eda(df: DataFrame, target: str) -> DataFrame:
    """(target_value, n, pct, is_majority, baseline_accuracy, precision, recall, f1) per non-null class.

    pct is of all rows; the majority baseline never predicts the minority, hence the fixed zeros.
    Ties for the majority go to the smallest label.
    """
    counts = df.groupBy(q(target).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    top = counts.agg(F.sum("n").alias("total"), F.min(F.when(F.col("y").isNotNull(), F.struct((-F.col("n")).alias("n"), "y"))).alias("top")).collect()[0]
    total, best = top["total"] or 0, top["top"]
    share = ratio(F.col("n") * 100.0, F.lit(total))
    base = -100.0 * best["n"] / total if best else 0.0
    return counts.filter(F.col("y").isNotNull()).select(
        F.col("y").alias("target_value"), "n", share.alias("pct"), (F.col("y") == F.lit(best["y"] if best else None)).alias("is_majority"),
        F.lit(base).alias("baseline_accuracy"), *[F.lit(0.0).alias(c) for c in ("precision", "recall", "f1")])


# ---- univariate -------------------------------------------------------------------------------

def numeric_univariate(df: DataFrame, columns: list[str] | None = None, measured: Measured | None = None) -> DataFrame:
    """(feature, n, mean, median, std, min, max, skew, kurtosis) over non-null values; ``measured`` saves the scans."""
    columns = numeric_columns(df) if columns is None else columns
    if not columns:
        raise ValueError("no features given")
    measured = measured or Measured(df, columns)
    rows = [(c, s["n"], s["mean"], measured.median(c), s["std"], s["lo"], s["hi"], s["g1"], s["g2"]) for c in columns for s in [measured.stats[c]]]
    raw = small_frame(df.sparkSession, rows, "feature string, n bigint, mean double, median double, std double, min double, max double, g1 double, g2 double")
    flat = F.col("min") == F.col("max")
    return raw.select("feature", "n", "mean", "median", "std", "min", "max",
                      adjusted_skew(F.col("n"), F.col("g1"), flat).alias("skew"),
                      adjusted_kurtosis(F.col("n"), F.col("g2"), flat).alias("kurtosis"))


def category_shares(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(feature, value, n, pct): every category with its share of all rows."""
    columns = categorical_columns(df) if columns is None else columns
    rows = df.count()
    return value_counts(df, columns).select("feature", "value", "n", ratio(F.col("n") * 100.0, F.lit(rows)).alias("pct"))


def top_categories(df: DataFrame, columns: list[str] | None = None, top_n: int = 10) -> DataFrame:
    """(feature, value, n, pct, position): the top_n most frequent values per feature, ties by value.

    A window with a rank limit keeps only top_n rows per task before the shuffle.
    """
    order = Window.partitionBy("feature").orderBy(F.desc("n"), "value")
    return (category_shares(df, columns).withColumn("position", F.row_number().over(order))
            .filter(F.col("position") <= top_n))


def rare_categories(df: DataFrame, columns: list[str] | None = None, rare_threshold: float = 1.0) -> DataFrame:
    """(feature, value, n, pct): values with a share of all rows strictly below the threshold (percent)."""
    return category_shares(df, columns).filter(F.col("pct") < rare_threshold)


def categorical_univariate(df: DataFrame, columns: list[str] | None = None, rare_threshold: float = 1.0) -> DataFrame:
    """(feature, cardinality, top_value, top_n, rare_count)."""
    columns = categorical_columns(df) if columns is None else columns
    counts = category_shares(df, columns)
    out = counts.groupBy("feature").agg(
        F.count(F.lit(1)).alias("cardinality"),
        F.min(F.struct((-F.col("n")).alias("n"), F.col("value").alias("v"))).alias("_top"),
        F.count_if(F.col("pct") < rare_threshold).alias("rare_count"))
    names = small_frame(df.sparkSession, [(c,) for c in columns], "feature string")
    return (names.join(F.broadcast(out), "feature", "left")
            .select("feature", F.coalesce("cardinality", F.lit(0)).cast("long").alias("cardinality"),
                    F.col("_top.v").alias("top_value"), (-F.col("_top.n")).alias("top_n"),
                    F.coalesce("rare_count", F.lit(0)).cast("long").alias("rare_count")))


# ---- against the target -----------------------------------------------------------------------

def numeric_bivariate(df: DataFrame, target: str, columns: list[str] | None = None) -> DataFrame:
    """(feature, mean_diff, median_diff, cohen_d), class 1 minus class 0; features with an empty class are left out."""
    columns = numeric_columns(df, [target]) if columns is None else columns
    one, zero = q(target) == 1, q(target) == 0
    sides = {f"{k}|{c}": F.when(cond, dbl(c)) for c in columns for k, cond in (("1", one), ("0", zero))}
    mid = medians(df, sides)
    raw = per_feature(df, columns, lambda c: {
        "n1": F.count(F.when(one, q(c))), "n0": F.count(F.when(zero, q(c))),
        "m1": F.avg(F.when(one, dbl(c))), "m0": F.avg(F.when(zero, dbl(c))),
        "v1": F.var_pop(F.when(one, dbl(c))), "v0": F.var_pop(F.when(zero, dbl(c))),
        "d": F.max(F.lit(None if mid[f"1|{c}"] is None or mid[f"0|{c}"] is None
                         else mid[f"1|{c}"] - mid[f"0|{c}"]).cast("double"))})
    # (n-1) times the sample variance is n times the population one, which is defined for n = 1 too.
    pooled = F.sqrt(ratio(F.col("n1") * F.col("v1") + F.col("n0") * F.col("v0"), F.col("n1") + F.col("n0") - 2))
    diff = F.col("m1") - F.col("m0")
    solid = (F.col("n1") > 1) & (F.col("n0") > 1)
    cohen = F.when(solid & (pooled == 0), F.lit(0.0)).when(solid, ratio(diff, pooled))
    return (raw.filter((F.col("n1") > 0) & (F.col("n0") > 0))
            .select("feature", diff.alias("mean_diff"), F.col("d").alias("median_diff"), cohen.alias("cohen_d")))


def target_rates(df: DataFrame, target: str, columns: list[str] | None = None) -> DataFrame:
    """(feature, value, n, target_rate) per category, rows with a null on either side left out."""
    columns = categorical_columns(df, [target]) if columns is None else columns
    known = df.filter(q(target).isNotNull())
    return (value_counts(known, columns, {"target_rate": F.avg(F.col("_by_0").cast("double"))}, by=[target])
            .select("feature", "value", "n", "target_rate"))


def label_chi2(df: DataFrame, target: str, columns: list[str] | None = None) -> DataFrame:
    """(feature, chi2_score): sum (O-E)^2/E with the label code (rank of the sorted text) used as a frequency."""
    columns = categorical_columns(df, [target]) if columns is None else columns
    cells = class_cells(df, {c: q(c) for c in columns}, target)
    codes = running_totals(cells.groupBy("feature", "value").agg(F.sum("n").alias("all")), "feature", ["value"], F.lit(1).cast("long")).select("feature", "value", "before")
    seen = (cells.join(codes, ["feature", "value"]).groupBy("feature", "y")
            .agg(F.sum((F.col("before") * F.col("n")).cast("double")).alias("o"), F.sum("n").alias("c")))
    whole = seen.groupBy("feature").agg(F.sum("o").alias("s"), F.sum("c").alias("n"))
    expected = ratio(F.col("c"), F.col("n")) * F.col("s")
    gap = F.col("o") - expected
    return (seen.join(whole, "feature").groupBy("feature")
            .agg(F.sum(F.coalesce(ratio(gap * gap, expected), F.lit(0.0))).alias("chi2_score")))


def contingency_chi2(df: DataFrame, target: str, columns: list[str] | None = None) -> DataFrame:
    """(feature, chi2): the usual contingency-table statistic, for comparison with `label_chi2`."""
    columns = categorical_columns(df, [target]) if columns is None else columns
    cells = class_cells(df, {c: q(c) for c in columns}, target)
    levels = cells.groupBy("feature", "value").agg(F.sum("n").alias("row"))
    classes = cells.groupBy("feature", "y").agg(F.sum("n").alias("column"))
    # chi2 = n * (sum o^2 / (row * column) - 1): only pairs that occur add to it.
    share = ratio(ratio(F.col("n").cast("double") * F.col("n"), F.col("row")), F.col("column"))
    return (cells.join(levels, ["feature", "value"]).join(classes, ["feature", "y"]).groupBy("feature")
            .agg((F.sum("n") * (F.sum(share) - 1.0)).alias("chi2")))


def target_relationships(df: DataFrame, target: str, numeric: list[str], categorical: list[str]) -> DataFrame:
    """(feature, type, mean_diff, cohen_d, mutual_info, chi2_score): numeric and categorical rows together."""
    parts = []
    if numeric:
        mi = numeric_information(df, numeric, target).select("feature", "mutual_info")
        parts.append(numeric_bivariate(df, target, numeric).join(F.broadcast(mi), "feature", "left")
                     .select("feature", F.lit("numeric").alias("type"), "mean_diff", "cohen_d", "mutual_info"))
    if categorical:
        mi = categorical_information(df, categorical, target).select("feature", "mutual_info")
        parts.append(label_chi2(df, target, categorical).join(F.broadcast(mi), "feature", "left")
                     .select("feature", F.lit("categorical").alias("type"), "chi2_score", "mutual_info"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    for c in ("mean_diff", "cohen_d", "chi2_score"):
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("double"))
    return out.select("feature", "type", "mean_diff", "cohen_d", "mutual_info", "chi2_score")


def feature_insights(df: DataFrame, columns: list[str], measured: Measured | None = None) -> DataFrame:
    return numeric_univariate(df, columns, measured).select("feature", "mean", "skew", "kurtosis")


def importance(df: DataFrame, target: str, top_n: int | None = None, measured: Measured | None = None) -> DataFrame:
    """(feature, mutual_info) of all columns: numeric nulls take the median, a categorical null is a level.

    ``measured`` has the filled quantiles `EDGES` of the rows with a target.
    """
    numeric, categorical = numeric_columns(df, [target]), categorical_columns(df, [target])
    known = df.filter(q(target).isNotNull())
    parts = []
    if numeric:
        measured = measured or Measured(known, numeric, filled=EDGES)
        mid = {c: measured.median(c) for c in numeric}
        present = [c for c in numeric if mid[c] is not None]
        if present:
            parts.append(numeric_information(known, present, target, fill=mid, edges={c: sorted(set(measured.filled_quantiles(c))) for c in present}))
    if categorical:
        parts.append(categorical_information(known, categorical, target, null_as_level=True))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.select("feature", "mutual_info")
    return out if top_n is None else out.orderBy(F.desc("mutual_info"), "feature").limit(top_n)


# ---- correlation ------------------------------------------------------------------------------

def pearson(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(feature_i, feature_j, corr) for i < j, pairwise-complete."""
    columns = numeric_columns(df) if columns is None else columns
    return correlation_pairs(df, {c: dbl(c) for c in columns})


def correlation_matrix(df: DataFrame, columns: list[str] | None = None, method: str = "pearson") -> DataFrame:
    """The full matrix in long form; the diagonal is 1, or null for a column without variance."""
    columns = numeric_columns(df) if columns is None else columns
    pairs = pearson(df, columns) if method == "pearson" else spearman(df, columns)
    spread = collect_aggregates(df, {c: F.min(dbl(c)) < F.max(dbl(c)) for c in columns})
    return symmetric(pairs, columns, {c: 1.0 if spread[c] else None for c in columns})


def spearman(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature_i, feature_j, corr) of average ranks, re-ranked over the complete rows of each pair.

    Columns without nulls share one ranking. Ranks live per distinct value and are looked up per row.
    """
    df = without_nan(df)
    nulls = collect_aggregates(df, {c: F.count_if(q(c).isNull()) for c in columns})
    full = [c for c in columns if nulls[c] == 0]
    parts = []
    if len(full) > 1:
        parts.append(_rank_correlation(df, full))
    for a in range(len(columns)):
        for b in range(a + 1, len(columns)):
            pair = [columns[a], columns[b]]
            if not (pair[0] in full and pair[1] in full):
                parts.append(_rank_correlation(df.filter(q(pair[0]).isNotNull() & q(pair[1]).isNotNull()), pair))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _rank_correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    narrow = df.select(*[(dbl(c) + F.lit(0.0)).alias(c) for c in columns])  # -0.0 and 0.0 are one value, also as text
    counts = (long_values(narrow, {c: q(c) for c in columns}, "double").groupBy("feature", "value")
              .agg(F.count(F.lit(1)).alias("n")).persist())
    sizes = {r["feature"]: r for r in counts.groupBy("feature").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("t")).collect()}
    ranks = (average_ranks(counts, sum(r["k"] for r in sizes.values()))
             .select("feature", F.col("value").cast("string").alias("value"), F.col("rank").alias("result"), "n"))
    wanted = [(c, ValueMap(c, frame=ranks.filter(F.col("feature") == c).drop("feature"), total=sizes[c]["t"] if c in sizes else 0,
                           info={"size": sizes[c]["k"] if c in sizes else 0}), q(c).cast("string")) for c in columns]
    joined, ranked = with_lookups(narrow, wanted)
    return correlation_pairs(joined, dict(zip(columns, ranked)))


def vif(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(feature, vif) over complete rows: the diagonal of the inverse correlation matrix; infinite if singular."""
    columns = numeric_columns(df) if columns is None else columns
    r = dense_correlation(df.na.drop("any", subset=columns), columns)
    out: dict[str, float | None] = {c: None for c in columns}
    live = [i for i in range(len(columns)) if not np.isnan(np.delete(r[i], i)).all() or len(columns) == 1]
    sub = r[np.ix_(live, live)]
    if live and not np.isnan(sub).any():
        singular = np.linalg.cond(sub) > 1e12
        diag = np.full(len(live), np.inf) if singular else np.diag(np.linalg.inv(sub))
        if singular:
            diag = _singular_vif(sub)
        out.update({columns[i]: float(v) for i, v in zip(live, diag)})
    return small_frame(df.sparkSession, list(out.items()), "feature string, vif double")


def _singular_vif(r: np.ndarray) -> np.ndarray:
    """VIF per column when some columns are linearly dependent: 1/(1 - R^2), infinite where R^2 reaches 1."""
    out = []
    for i in range(len(r)):
        rest = [j for j in range(len(r)) if j != i]
        x = r[np.ix_(rest, rest)]
        r2 = float(r[i, rest] @ np.linalg.pinv(x, rcond=1e-10) @ r[rest, i])
        out.append(np.inf if r2 > 1 - 1e-9 else 1.0 / (1.0 - r2))
    return np.array(out)


def strongest_features(pairs: DataFrame, columns: list[str], top_n: int) -> DataFrame:
    """(feature, mean_abs_corr): the top_n features by mean |corr|, the self-correlation included."""
    both = pairs.select(F.col("feature_i").alias("feature"), "corr").unionByName(
        pairs.select(F.col("feature_j").alias("feature"), "corr"))
    both = both.unionByName(small_frame(pairs.sparkSession, [(c, 1.0) for c in columns], "feature string, corr double"))
    return (both.groupBy("feature").agg(F.avg(F.abs("corr")).alias("mean_abs_corr"))
            .orderBy(F.desc("mean_abs_corr"), "feature").limit(top_n))


def heatmap(df: DataFrame, columns: list[str] | None = None, top_n: int = 20) -> DataFrame:
    """(feature_i, feature_j, corr) for i < j of the top_n features; pairs need no second computation."""
    columns = numeric_columns(df) if columns is None else columns
    pairs = pearson(df, columns).persist()
    if len(columns) <= top_n:
        return pairs
    top = [r["feature"] for r in strongest_features(pairs, columns, top_n).collect()]
    return pairs.filter(F.col("feature_i").isin(top) & F.col("feature_j").isin(top))


# ---- outliers ---------------------------------------------------------------------------------

def outlier_limits(df: DataFrame, columns: list[str]) -> dict[str, dict]:
    """Per column: IQR fences, mean and sample deviation."""
    quart = quantiles(df, {c: dbl(c) for c in columns}, [0.25, 0.75])
    got = collect_aggregates(df, {(c, s): f for c in columns for s, f in
                                  (("m", F.avg(dbl(c))), ("s", F.when(F.count(q(c)) > 1, F.stddev_samp(dbl(c)))))})
    out = {}
    for c in columns:
        q1, q3 = quart[c]
        out[c] = {"low": None if q1 is None else q1 - 1.5 * (q3 - q1), "high": None if q1 is None else q3 + 1.5 * (q3 - q1),
                  "mean": got[(c, "m")], "std": got[(c, "s")]}
    return out


def _flags(c: str, lim: dict, z_threshold: float) -> tuple[Column, Column]:
    if lim["low"] is None:
        return F.lit(False), F.lit(False)
    iqr = (dbl(c) < F.lit(lim["low"])) | (dbl(c) > F.lit(lim["high"]))
    z = F.lit(False)
    if lim["std"]:
        z = F.abs((dbl(c) - F.lit(lim["mean"])) / F.lit(lim["std"])) > z_threshold
    return F.coalesce(iqr, F.lit(False)), F.coalesce(z, F.lit(False))


def outlier_profile(df: DataFrame, columns: list[str] | None = None, z_threshold: float = 3.0) -> DataFrame:
    """(feature, iqr_outliers, z_outliers) over non-null values, both rules strict."""
    columns = numeric_columns(df) if columns is None else columns
    lim = outlier_limits(df, columns)

    def counts(c: str) -> dict[str, Column]:
        iqr, z = _flags(c, lim[c], z_threshold)
        return {"iqr_outliers": F.count_if(iqr), "z_outliers": F.count_if(z)}

    return per_feature(df, columns, counts)


def outlier_rows(df: DataFrame, key: str, columns: list[str] | None = None, z_threshold: float = 3.0) -> DataFrame:
    """(feature, key, value): every row outside by either rule, as a DataFrame (no shuffle, never collected)."""
    columns = numeric_columns(df, [key]) if columns is None else columns
    lim = outlier_limits(df, columns)
    hits = []
    for c in columns:
        iqr, z = _flags(c, lim[c], z_threshold)
        hits.append(F.when(iqr | z, F.struct(F.lit(c).alias("feature"), dbl(c).alias("value"))))
    return (df.select(q(key).alias(key), F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull())).alias("_h"))
            .select(F.col("_h.feature").alias("feature"), key, F.col("_h.value").alias("value")))


# ---- missingness ------------------------------------------------------------------------------

def missing_correlations(df: DataFrame) -> DataFrame:
    """(feature_i, feature_j, corr) between null indicators of columns with some but not all nulls."""
    counts = collect_aggregates(df, {"__rows__": F.count(F.lit(1)), **{c: F.count_if(q(c).isNull()) for c in df.columns}})
    rows = counts.pop("__rows__")
    some = [c for c in df.columns if 0 < counts[c] < rows]
    return correlation_pairs(df, {c: q(c).isNull().cast("int").cast("double") for c in some})


def missing_vs_target(df: DataFrame, target: str) -> DataFrame:
    """(feature, target_mean_missing, target_mean_present, diff), largest difference first."""
    rows = per_feature(df, [c for c in df.columns if c != target], lambda c: {
        "missing": F.count_if(q(c).isNull()), "present": F.count(q(c)),
        "target_mean_missing": F.avg(F.when(q(c).isNull(), dbl(target))),
        "target_mean_present": F.avg(F.when(q(c).isNotNull(), dbl(target)))})
    diff = F.col("target_mean_missing") - F.col("target_mean_present")
    return (rows.filter((F.col("missing") > 0) & (F.col("present") > 0))
            .select("feature", "target_mean_missing", "target_mean_present", diff.alias("diff"))
            .orderBy(F.desc("diff"), "feature"))


# ---- PCA --------------------------------------------------------------------------------------

def filled_numeric(df: DataFrame, columns: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Numeric columns as doubles, all-null columns dropped, nulls replaced by the median."""
    columns = numeric_columns(df) if columns is None else columns
    mid = medians(df, {c: dbl(c) for c in columns})
    return df.select(*[q(c) for c in (keep or [])],
                     *[F.coalesce(dbl(c), F.lit(mid[c])).alias(c) for c in columns if mid[c] is not None])


class PCAModel:
    """Standardised principal components: the fit ships c x c numbers, the projection is a linear expression."""

    def __init__(self, n_components: int = 2):
        self.n_components = n_components

    def fit(self, df: DataFrame, columns: list[str] | None = None) -> "PCAModel":
        columns = numeric_columns(df) if columns is None else columns
        mid = medians(df, {c: dbl(c) for c in columns})
        self.columns = [c for c in columns if mid[c] is not None]
        self.fill = {c: mid[c] for c in self.columns}
        x = {c: F.coalesce(dbl(c), F.lit(self.fill[c])) for c in self.columns}
        stats = collect_aggregates(df, {(c, s): f for c, e in x.items()
                                        for s, f in (("m", F.avg(e)), ("s", F.stddev_pop(e)))} | {"n": F.count(F.lit(1))})
        n = stats["n"]
        self.mean = {c: stats[(c, "m")] for c in self.columns}
        self.scale = {c: stats[(c, "s")] or 1.0 for c in self.columns}
        filled = df.select(*[e.alias(c) for c, e in x.items()])
        corr = dense_correlation(filled, self.columns)
        flat = [i for i, c in enumerate(self.columns) if not stats[(c, "s")]]
        corr[flat, :] = corr[:, flat] = 0.0
        values, vectors = np.linalg.eigh(np.nan_to_num(corr) * (n / max(1, n - 1)))
        top = np.argsort(-values)[: self.n_components]
        vectors = vectors[:, top]
        signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
        self.components = (vectors * signs).T
        self.explained_variance = values[top]
        self.explained_variance_ratio = values[top] / values.sum()
        return self

    def transform(self, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """(keep..., pc1..pck); all-native, no Python per row."""
        z = [(F.coalesce(dbl(c), F.lit(self.fill[c])) - F.lit(self.mean[c])) / F.lit(self.scale[c]) for c in self.columns]
        pcs = [sum((F.lit(float(w)) * e for w, e in zip(row, z)), F.lit(0.0)).alias(f"pc{k + 1}")
               for k, row in enumerate(self.components)]
        return df.select(*[q(c) for c in (keep or [])], *pcs)

    def loadings(self, spark) -> DataFrame:
        """(component, feature, loading, explained_variance, explained_variance_ratio)."""
        rows = [(f"pc{k + 1}", c, float(self.components[k, j]), float(self.explained_variance[k]),
                 float(self.explained_variance_ratio[k]))
                for k in range(len(self.components)) for j, c in enumerate(self.columns)]
        return small_frame(spark, rows, "component string, feature string, loading double, "
                                        "explained_variance double, explained_variance_ratio double")


# ---- the whole exploration --------------------------------------------------------------------

def summary_report(df: DataFrame, target: str, mi: DataFrame) -> DataFrame:
    """(section, key, value): baseline accuracy (2 places), class counts, and the information ranking."""
    classes = target_eda(df, target)
    base = classes.agg(F.round(F.max("baseline_accuracy"), 2).alias("value")).select(
        F.lit("target").alias("section"), F.lit("baseline_accuracy").alias("key"), "value")
    counts = classes.select(F.lit("counts").alias("section"), F.col("target_value").cast("string").alias("key"),
                            F.col("n").cast("double").alias("value"))
    ranking = mi.select(F.lit("mutual_info").alias("section"), F.col("feature").alias("key"), F.col("mutual_info").alias("value"))
    return base.unionByName(counts).unionByName(ranking)


class EDAOrchestrator:
    """Runs every exploration section and returns the named result DataFrames.

    All columns take part; the limits are for callers who want figures of the first few only.
    """

    def __init__(self, target_column: str, max_numeric: int | None = None, max_categorical: int | None = None,
                 max_heatmap: int | None = None):
        self.target, self.max_numeric, self.max_categorical = target_column, max_numeric, max_categorical
        self.max_heatmap = max_heatmap

    def run(self, df: DataFrame, num_features: list[str] | None = None, cat_features: list[str] | None = None,
            sections: tuple[str, ...] | None = None) -> dict[str, DataFrame]:
        from tabspark.operators import plotdata

        num = numeric_columns(df, [self.target]) if num_features is None else num_features
        cat = categorical_columns(df, [self.target]) if cat_features is None else cat_features
        first_num, first_cat = num[: self.max_numeric], cat[: self.max_categorical]

        def projection() -> DataFrame:
            complete = df.na.drop("any", subset=num)
            return PCAModel(2).fit(complete, num).transform(complete, [self.target])

        ranking: dict[str, DataFrame] = {}

        def mi() -> DataFrame:
            if "mi" not in ranking:
                ranking["mi"] = importance(df, self.target, measured=shared() if ranked() else None)
            return ranking["mi"]

        @cache
        def ranked() -> bool:
            """Whether the ranking is asked for and over all rows, as the other sections are."""
            return bool({"importance", "summary"} & set(chosen)) and df.filter(q(self.target).isNull()).isEmpty()

        @cache
        def shared() -> Measured:
            """The numeric columns and quantiles of the chosen sections together."""
            columns = first_num if {"box", "feature_insights"} & set(chosen) else []
            return Measured(df, columns + (numeric_columns(df, [self.target]) if ranked() else []),
                            plotdata.QUARTILES if "box" in chosen else (), EDGES if ranked() else ())

        makers = {
            "target": lambda: target_eda(df, self.target),
            "target_distribution": lambda: plotdata.target_distribution(df, self.target),
            "box": lambda: plotdata.box_stats(df, first_num, measured=shared()),
            "box_by_target": lambda: plotdata.box_stats(df, first_num, self.target),
            "histogram": lambda: plotdata.histogram(df, first_num),
            "density": lambda: plotdata.kde(df, first_num),
            "density_by_target": lambda: plotdata.kde(df, first_num, self.target),
            "categories": lambda: plotdata.category_counts(df, first_cat),
            "numeric_bivariate": lambda: numeric_bivariate(df, self.target, first_num),
            "target_rates": lambda: target_rates(df, self.target, first_cat),
            "category_vs_target": lambda: plotdata.category_vs_target(df, self.target, first_cat),
            "correlation": lambda: pearson(df),
            "heatmap": lambda: heatmap(df, num[: self.max_heatmap]),
            "importance": mi,
            "projection": projection,
            "summary": lambda: summary_report(df, self.target, mi()),
            "target_relationships": lambda: target_relationships(df, self.target, first_num, first_cat),
            "feature_insights": lambda: feature_insights(df, first_num, shared()),
        }
        needs_num = {"box", "box_by_target", "histogram", "density", "density_by_target", "numeric_bivariate", "heatmap", "projection", "feature_insights"}
        needs_cat = {"categories", "target_rates", "category_vs_target"}
        chosen = sections or tuple(makers)
        return {s: makers[s]() for s in chosen
                if not (s in needs_num and not num) and not (s in needs_cat and not cat)}

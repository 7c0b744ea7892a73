"""The aggregated data behind each figure: small results, computed over all rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabspark.functions.scalars import keep_null, nan_to_null
from tabspark.functions.types import categorical_columns, dbl, q
from tabspark.operators.aggregate import class_cells, collect_aggregates, long_values, small_frame, value_counts
from tabspark.operators.columnwise import inside_spans
from tabspark.operators.eda import PCAModel, outlier_limits, target_eda, top_categories, _flags
from tabspark.operators.measured import Measured
from tabspark.operators.ordering import running_totals
from tabspark.operators.profiling import missing_profile
from tabspark.operators.quantiles import quantiles
from tabspark.operators.sampling import bounded_sample

QUARTILES = (0.25, 0.5, 0.75)
KDE_POINTS = 200
# Bins of a density are this part of its bandwidth wide; only filled bins are kept.
KDE_FINE = 8


def missing_top(df: DataFrame, top_n: int = 20) -> DataFrame:
    return (missing_profile(df).select("feature", "missing_pct")
            .orderBy(F.desc("missing_pct"), "feature").limit(top_n))


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """(target_value, n, label): bar heights and their percentage labels (one decimal)."""
    return target_eda(df, target).select("target_value", "n", F.round("pct", 1).alias("pct_label"))


def _bins(n: int, lo: float, hi: float, q1: float, q3: float) -> int:
    """Freedman-Diaconis or Sturges, whichever is finer, as plotting libraries choose."""
    if n == 0 or hi <= lo:
        return 1
    sturges = (hi - lo) / (math.log2(n) + 1.0)
    fd = 2.0 * (q3 - q1) / n ** (1.0 / 3.0)
    width = min(fd, sturges) if fd > 0 else sturges
    return max(1, min(1 << 53, math.ceil((hi - lo) / width)))


def histogram(df: DataFrame, features: list[str], bins: int | None = None) -> DataFrame:
    """(feature, bin, low, high, n): equal-width bins over [min, max]; empty bins are left out."""
    got = collect_aggregates(df, {(c, s): f for c in features for s, f in
                                  (("n", F.count(q(c))), ("lo", F.min(dbl(c))), ("hi", F.max(dbl(c))))})
    quart = quantiles(df, {c: dbl(c) for c in features}, [0.25, 0.75]) if bins is None else {}
    plan, assigned = [], {}
    for c in features:
        lo, hi = got[(c, "lo")], got[(c, "hi")]
        if lo is None:
            continue
        k = bins if bins is not None else _bins(got[(c, "n")], lo, hi, *quart[c])
        width = (hi - lo) / k if hi > lo else 1.0
        plan.append((c, lo, width))
        assigned[c] = keep_null(q(c), F.least(F.floor((dbl(c) - F.lit(lo)) / F.lit(width)), F.lit(k - 1)).cast("bigint"))
    schema = "feature string, origin double, width double"
    if not plan:
        return small_frame(df.sparkSession, [], "feature string, bin bigint, low double, high double, n bigint")
    counts = (long_values(df, assigned, "bigint").filter(F.col("value").isNotNull())
              .groupBy("feature", F.col("value").alias("bin")).agg(F.count(F.lit(1)).alias("n")))
    return (counts.join(F.broadcast(small_frame(df.sparkSession, plan, schema)), "feature")
            .select("feature", "bin", (F.col("origin") + F.col("bin") * F.col("width")).alias("low"),
                    (F.col("origin") + (F.col("bin") + 1) * F.col("width")).alias("high"), "n"))


def box_stats(df: DataFrame, features: list[str], target: str | None = None, measured: Measured | None = None) -> DataFrame:
    """(feature[, target_value], q1, median, q3, whisker_low, whisker_high, fliers): box plot numbers; ``measured`` (without a target) saves scans."""
    fields = ["q1", "median", "q3", "whisker_low", "whisker_high", "fliers"]
    if target is not None:
        return _box_by_class(df, features, target).select("feature", "target_value", *fields)
    if not features:
        raise ValueError("no features given")
    measured = measured or Measured(df, features, QUARTILES)
    quart = {c: tuple(measured.quantile(c, p) for p in QUARTILES) for c in features}
    fences = {c: (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)) for c, (q1, _, q3) in quart.items() if q1 is not None}
    spans = {c: {"least": None, "greatest": None, "outside": 0} for c in features}
    crossed = {}
    for c, (low, high) in fences.items():
        s = measured.stats[c]
        if not s["nan"] and low <= s["lo"] and s["hi"] <= high:  # no value is outside: the whiskers are the ends
            spans[c] = {"least": s["lo"], "greatest": s["hi"], "outside": 0}
        else:
            crossed[c] = (dbl(c), low, high)
    spans |= inside_spans(df, crossed) if crossed else {}
    rows = [(c, *quart[c], *spans[c].values()) for c in features]
    return small_frame(df.sparkSession, rows, "feature string, q1 double, median double, q3 double, whisker_low double, whisker_high double, fliers bigint")


def _box_by_class(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Box numbers of every feature and class in long form: running totals over distinct values give the ranks, so the plan is the same
    for any number of classes, and a class that holds most rows is range-partitioned like the others."""
    cells = class_cells(df, {c: dbl(c) for c in features}, target, "double").select(F.struct("feature", "y").alias("g"), "value", "n")
    placed = running_totals(cells, "g", ["value"], F.col("n"))
    placed = placed.join(placed.groupBy("g").agg(F.sum("n").alias("all")), "g")

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("before") <= rank) & (rank < F.col("before") + F.col("n")), F.col("value")))

    spots = {name: (F.col("all") - 1) * part for name, part in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))}
    ends = placed.groupBy("g").agg(F.max("all").alias("all"), *[at(f(p)).alias(f"{name}_{i}") for name, p in spots.items() for i, f in enumerate((F.floor, F.ceil))])
    quart = ends.select("g", *[(F.col(f"{name}_0") + (F.col(f"{name}_1") - F.col(f"{name}_0")) * (p - F.floor(p))).alias(name) for name, p in spots.items()])
    span = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("value").between(F.col("q1") - span, F.col("q3") + span)
    boxes = cells.join(quart, "g").groupBy("g").agg(*[F.max(c).alias(c) for c in spots], F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
                                                    F.max(F.when(inside, F.col("value"))).alias("whisker_high"), F.sum(F.when(~inside, F.col("n")).otherwise(0)).alias("fliers"))
    classes = df.filter(q(target).isNotNull()).select(q(target).alias("y")).distinct()
    every = classes.select(F.explode(F.array(*[F.lit(c) for c in features])).alias("feature"), "y")
    boxes = boxes.select(F.col("g.feature").alias("feature"), F.col("g.y").alias("y"), *[c for c in boxes.columns if c != "g"])
    return (every.join(boxes, ["feature", "y"], "left").withColumn("fliers", F.coalesce("fliers", F.lit(0)))
            .withColumn("target_value", F.col("y").cast("string")))


def kde(df: DataFrame, features: list[str], target: str | None = None) -> DataFrame:
    """(feature[, target_value], x, density): Gaussian density (Scott's rule) of all rows at KDE_POINTS places.

    Rows are folded into bins of an eighth of the bandwidth, so far values do not coarsen them; of these only
    the filled ones exist, and each adds its share to the places on the executors. Bandwidths are rows, joined by feature and
    class, so any number of classes will do.
    """
    group = ["feature", "y"]
    rows = long_values(df, {c: nan_to_null(dbl(c)) for c in features}, "double", [(F.lit(0) if target is None else q(target)).alias("y")])
    rows = rows.filter(F.col("value").isNotNull() & F.col("y").isNotNull())
    stats = rows.groupBy(group).agg(F.count(F.lit(1)).alias("size"), F.min("value").alias("origin"), F.max("value").alias("last"), F.stddev_samp("value").alias("s"))
    stats = stats.filter("size > 1 AND s > 0").withColumn("h", F.col("s") * F.pow(F.col("size").cast("double"), F.lit(-0.2))).drop("s")
    filled = (rows.join(stats, group).groupBy(*group, F.floor((F.col("value") - F.col("origin")) / (F.col("h") / F.lit(float(KDE_FINE)))).alias("bin"))
              .agg(F.count(F.lit(1)).alias("m")))
    low = F.col("origin") - 3 * F.col("h")
    step = (F.col("last") + 3 * F.col("h") - low) / F.lit(KDE_POINTS - 1)
    each = filled.join(stats, group).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(KDE_POINTS - 1))))
    away = (low + F.col("i") * step - F.col("origin") - (F.col("bin") + 0.5) * F.col("h") / F.lit(float(KDE_FINE))) / F.col("h")
    sums = each.groupBy(*group, "i").agg(F.sum(F.col("m") * F.exp(-0.5 * away * away)).alias("t"))
    out = sums.join(stats, group).select(
        "feature", F.col("y").cast("string").alias("target_value"), (low + F.col("i") * step).alias("x"),
        (F.col("t") / (F.col("size") * F.col("h") * F.lit(math.sqrt(2 * math.pi)))).alias("density"))
    out = out.orderBy("feature", "target_value", "x")
    return out if target else out.drop("target_value")


def category_counts(df: DataFrame, features: list[str] | None = None, top_n: int = 20) -> DataFrame:
    return top_categories(df, features, top_n).select("feature", "value", "n", "position")


def category_vs_target(df: DataFrame, target: str, features: list[str] | None = None, top_n: int = 15) -> DataFrame:
    """(feature, value, n, n_negative, n_positive, target_rate, global_rate) of the top_n categories."""
    features = categorical_columns(df, [target]) if features is None else features
    extra = {"n_negative": F.count_if(F.col("_by_0") == 0), "n_positive": F.count_if(F.col("_by_0") == 1),
             "target_rate": F.avg(F.col("_by_0").cast("double"))}
    order = Window.partitionBy("feature").orderBy(F.desc("n"), "value")
    overall = collect_aggregates(df, {"rate": F.avg(dbl(target))})["rate"]
    return (value_counts(df, features, extra, by=[target]).withColumn("_r", F.row_number().over(order))
            .filter(F.col("_r") <= top_n).drop("_r")
            .select("feature", "value", "n", "n_negative", "n_positive", "target_rate",
                    F.lit(overall).cast("double").alias("global_rate")))


def projection_points(df: DataFrame, target: str, key: str, columns: list[str], points: int | None = None, seed: int = 42) -> DataFrame:
    """(key, target, pc1, pc2) of all complete rows; ``points`` asks for a sample of so many."""
    complete = df.na.drop("any", subset=columns)
    model = PCAModel(2).fit(complete, columns)
    return model.transform(complete if points is None else bounded_sample(complete, points, key, seed), [key, target])


def outlier_points(df: DataFrame, feature: str, key: str, target: str | None = None, inliers: int | None = None,
                   seed: int = 42, order: Column | None = None) -> DataFrame:
    """(key, value[, target], outlier) of all rows; ``inliers`` asks for a sample of so many of the rows that are none."""
    lim = outlier_limits(df, [feature])[feature]
    iqr, z = _flags(feature, lim, 3.0)
    rows = df.filter(q(feature).isNotNull()).select(
        q(key).alias(key), dbl(feature).alias("value"), *([q(target).alias(target)] if target else []), (iqr | z).alias("outlier"))
    if inliers is None:
        return rows
    calm = bounded_sample(rows.filter(~F.col("outlier")), inliers, key, seed, order)
    return rows.filter("outlier").unionByName(calm)

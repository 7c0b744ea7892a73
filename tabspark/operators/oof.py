"""Out-of-fold target statistics: smoothed means (K5) and ordered statistics (K6).

Every function returns (feature, value, result, n) rows, ready for `mapping.build_maps`;
a fold-wise result is an array indexed by fold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabspark.functions.scalars import digamma
from tabspark.functions.statistics import ratio
from tabspark.functions.types import q
from tabspark.operators.aggregate import long_values

NULL_LEVEL = "nan"
ROWS_PER_RUN = 200_000


def fold_of(key: Column, folds: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(folds)).cast("int")


def order_of(key: Column, seed: int) -> Column:
    """A pseudo-random order key in [0, 2^52), exact as a double."""
    return F.pmod(F.xxhash64(key, F.lit(seed), F.lit("order")), F.lit(1 << 52))


def fold_priors(df: DataFrame, target: str, fold: Column, folds: int) -> tuple[float, list[float | None], int]:
    """The mean of the target over all rows, the mean over all folds but each, and the number of rows."""
    rows = (df.select(q(target).cast("double").alias("y"), fold.alias("f")).groupBy("f")
            .agg(F.count("y").alias("n"), F.sum("y").alias("s"), F.count(F.lit(1)).alias("rows")).collect())
    n, s = sum(r["n"] for r in rows), sum(r["s"] or 0.0 for r in rows)
    own = {r["f"]: (r["n"], r["s"] or 0.0) for r in rows}
    def mean(a, b):
        return a / b if b else None
    return mean(s, n), [mean(s - own.get(f, (0, 0.0))[1], n - own.get(f, (0, 0.0))[0]) for f in range(folds)], sum(r["rows"] for r in rows)


def smoothed_means(df: DataFrame, features: list[str], target: str, m: float, prior: float) -> DataFrame:
    """Global smoothed mean per level: (sum + m*prior) / (count + m)."""
    stacked = long_values(df, {c: q(c) for c in features}, "string", [q(target).cast("double").alias("y")])
    cells = (stacked.filter(F.col("value").isNotNull()).groupBy("feature", "value")
             .agg(F.count("y").alias("k"), F.sum("y").alias("s"), F.count(F.lit(1)).alias("n")))
    result = ratio(F.coalesce("s", F.lit(0.0)) + F.lit(m * prior), F.col("k") + F.lit(m))
    return cells.select("feature", "value", F.coalesce(result, F.lit(prior)).alias("result"), "n")


def out_of_fold_means(df: DataFrame, features: list[str], target: str, fold: Column, folds: int, m: float,
                      priors: list[float | None]) -> DataFrame:
    """Per level, the smoothed mean seen by each held-out fold: totals minus the fold's own part, in one scan."""
    stacked = long_values(df, {c: q(c) for c in features}, "string",
                          [q(target).cast("double").alias("y"), fold.alias("f")])
    per_fold = []
    for f in range(folds):
        mine = F.col("f") == F.lit(f)
        per_fold += [F.count(F.when(mine, F.col("y"))).alias(f"k{f}"), F.sum(F.when(mine, F.col("y"))).alias(f"s{f}")]
    cells = (stacked.filter(F.col("value").isNotNull()).groupBy("feature", "value")
             .agg(F.count("y").alias("k"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("s"),
                  F.count(F.lit(1)).alias("n"), *per_fold))
    results = []
    for f in range(folds):
        prior = F.lit(priors[f]).cast("double")
        rest_n = F.col("k") - F.col(f"k{f}")
        rest_s = F.col("s") - F.coalesce(F.col(f"s{f}"), F.lit(0.0))
        results.append(F.when(rest_n > 0, ratio(rest_s + F.lit(m) * prior, rest_n + F.lit(m))).otherwise(prior))
    return cells.select("feature", "value", F.array(*results).alias("result"), "n")


def ordered_means(df: DataFrame, features: list[str], target: str, fold: Column, folds: int, p: float,
                  priors: list[float | None], order: Column, tie: Column, total_rows: int,
                  order_span: tuple[float, float] | None = None,
                  rows_per_run: int = ROWS_PER_RUN) -> DataFrame:
    """Per level and held-out fold: the mean over its training rows of the ordered target statistic.

    A training row at 0-based rank t of its level contributes (S_t + p*prior)/(t+p), S_t being the target
    sum before it. Summed over the level this needs no running sum: row j adds y_j * h(t_j + 1), and the
    prior part is p*prior*h(0), with h(a) = psi(n+p) - psi(a+p). Only ranks are needed, and the rank among
    "all folds but f" is the rank in the level minus the rows of fold f before it. Levels are cut along
    the order key into runs of bounded size, so a level holding a third of the rows is many small windows.
    """
    cols = {c: F.coalesce(q(c).cast("string"), F.lit(NULL_LEVEL)) for c in features}
    rows = long_values(df, cols, "string", [F.coalesce(q(target).cast("double"), F.lit(0.0)).alias("y"),
                                            fold.alias("f"), order.cast("double").alias("o"), tie.alias("tie")])
    levels = (rows.groupBy("feature", "value")
              .agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("f") == F.lit(g)).alias(f"n{g}") for g in range(folds)]))
    runs = max(1, math.ceil(total_rows / rows_per_run))  # no level has more rows than the table
    if runs > 1:
        if order_span is None:
            span = df.agg(F.min(order.cast("double")), F.max(order.cast("double"))).first()
            order_span = (float(span[0]), float(span[1]))
        width = max((order_span[1] - order_span[0]) / runs, 1e-300)
        rows = rows.withColumn("run", F.least(F.floor((F.col("o") - F.lit(order_span[0])) / F.lit(width)), F.lit(runs - 1)))
    else:
        rows = rows.withColumn("run", F.lit(0))
    group = ["feature", "value"]
    inside = Window.partitionBy(*group, "run").orderBy("o", "tie").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum((F.col("f") == F.lit(g)).cast("long")).over(inside), F.lit(0)).alias(f"b{g}")
              for g in range(folds)]
    placed = rows.select(*group, "run", "f", "y", *before).filter(F.col("y") != 0)
    if runs > 1:
        cells = rows.groupBy(*group, "run").agg(*[F.count_if(F.col("f") == F.lit(g)).alias(f"c{g}") for g in range(folds)])
        earlier = Window.partitionBy(*group).orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
        offsets = cells.select(*group, "run", *[F.coalesce(F.sum(f"c{g}").over(earlier), F.lit(0)).alias(f"e{g}")
                                                for g in range(folds)])
        placed = (placed.join(offsets, [*group, "run"])
                  .select(*group, "f", "y", *[(F.col(f"b{g}") + F.col(f"e{g}")).alias(f"b{g}") for g in range(folds)]))
    # One scan of the ranked rows gives, for each held-out fold g, sum(y) and sum(y * psi(t + 1 + p)).
    ahead = " + ".join(f"b{g}" for g in range(folds))
    aggs = []
    for g in range(folds):
        psi = digamma(f"(CAST({ahead} - b{g} AS DOUBLE) + {1.0 + p!r}D)")
        aggs += [F.expr(f"sum(CASE WHEN f <> {g} THEN y END) AS y{g}"),
                 F.expr(f"sum(CASE WHEN f <> {g} THEN y * {psi} END) AS w{g}")]
    joined = levels.join(placed.groupBy(*group).agg(*aggs), group, "left")
    results = []
    for g in range(folds):
        prior = "CAST(NULL AS DOUBLE)" if priors[g] is None else f"{float(priors[g])!r}D"
        top_psi = digamma(f"(CAST(n - n{g} AS DOUBLE) + {float(p)!r}D)")
        low_psi = digamma(f"{float(p)!r}D")
        total = (f"coalesce(y{g}, 0D) * {top_psi} - coalesce(w{g}, 0D) + {float(p)!r}D * {prior} * ({top_psi} - {low_psi})")
        results.append(f"CASE WHEN n > n{g} THEN ({total}) / (n - n{g}) ELSE {prior} END")
    return joined.select(*group, F.expr(f"array({', '.join(results)}) AS result"), "n")

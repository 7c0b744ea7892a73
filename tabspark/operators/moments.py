"""Pairwise-complete second moments of many columns in one scan (kernel K3)."""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tabspark.functions.statistics import ratio, safe_corr
from tabspark.functions.types import dbl
from tabspark.operators.aggregate import collect_aggregates, per_feature, small_frame

# Up to this many columns the pairs are plain Spark aggregates; beyond, one Arrow pass.
NATIVE_COLUMNS = 12


def moment_table(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """(i, j, n, sx, sy, sxx, syy, sxy) for i <= j over rows where both are present, shifted by rough means.

    Each task keeps one c x c block and emits it once; Spark adds the blocks up per pair.
    """
    names = list(columns)
    data = df.select(*[F.nanvl(c.cast("double"), F.lit(None).cast("double")).alias(f"x{i}")
                       for i, c in enumerate(columns.values())])
    means = collect_aggregates(data, {i: F.avg(f"x{i}") for i in range(len(names))})
    shift = np.array([means[i] if means[i] is not None else 0.0 for i in range(len(names))])
    upper = np.triu_indices(len(names))

    def blocks(batches):
        c = len(names)
        n, sx, sxx, sxy = (np.zeros((c, c)) for _ in range(4))
        for pdf in batches:
            x = pdf.to_numpy(dtype="float64") - shift
            m = (~np.isnan(x)).astype("float64")
            x = np.where(m > 0, x, 0.0)
            n += m.T @ m
            sx += x.T @ m
            sxx += (x * x).T @ m
            sxy += x.T @ x
        i, j = upper
        yield pd.DataFrame({"i": i.astype("int32"), "j": j.astype("int32"), "n": n[i, j], "sx": sx[i, j],
                            "sy": sx[j, i], "sxx": sxx[i, j], "syy": sxx[j, i], "sxy": sxy[i, j]})

    fields = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    parts = data.mapInPandas(blocks, "i int, j int, " + ", ".join(f"{f} double" for f in fields))
    return parts.groupBy("i", "j").agg(*[F.sum(f).alias(f) for f in fields])


def correlation_pairs(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """(feature_i, feature_j, corr) for i < j in column order, pairwise-complete; null for zero variance."""
    names = list(columns)
    spark = df.sparkSession
    if len(names) < 2:
        return small_frame(spark, [], "feature_i string, feature_j string, corr double")
    if len(names) <= NATIVE_COLUMNS:
        narrow = df.select(*[F.nanvl(c.cast("double"), F.lit(None).cast("double")).alias(f"x{i}") for i, c in enumerate(columns.values())])
        pairs = {f"{i}:{j}": (i, j) for i, j in itertools.combinations(range(len(names)), 2)}
        rows = per_feature(narrow, list(pairs), lambda p: {
            "corr": safe_corr(F.col(f"x{pairs[p][0]}"), F.col(f"x{pairs[p][1]}"))})
        lookup = small_frame(spark, [(k, names[i], names[j]) for k, (i, j) in pairs.items()],
                             "feature string, feature_i string, feature_j string")
        return rows.join(F.broadcast(lookup), "feature").select("feature_i", "feature_j", "corr")
    m = moment_table(df, columns).filter("i < j")
    cov = F.col("sxy") - ratio(F.col("sx") * F.col("sy"), F.col("n"))
    vx = F.col("sxx") - ratio(F.col("sx") * F.col("sx"), F.col("n"))
    vy = F.col("syy") - ratio(F.col("sy") * F.col("sy"), F.col("n"))
    # Differences of sums leave rounding dust where the variance is zero.
    solid = (vx > 1e-12 * F.col("sxx")) & (vy > 1e-12 * F.col("syy"))
    label = F.array(*[F.lit(n) for n in names])
    return m.select(F.get(label, F.col("i")).alias("feature_i"), F.get(label, F.col("j")).alias("feature_j"),
                    F.when(solid, ratio(cov, F.sqrt(vx * vy))).alias("corr"))


def symmetric(pairs: DataFrame, features: list[str], diagonal: dict[str, float | None]) -> DataFrame:
    """The full matrix in long form from its upper triangle and a diagonal."""
    spark = pairs.sparkSession
    flipped = pairs.select(F.col("feature_j").alias("feature_i"), F.col("feature_i").alias("feature_j"), "corr")
    diag = small_frame(spark, [(f, f, diagonal.get(f)) for f in features],
                       "feature_i string, feature_j string, corr double")
    return pairs.unionByName(flipped).unionByName(diag)


def dense_correlation(df: DataFrame, columns: list[str]) -> np.ndarray:
    """c x c correlation matrix on the driver (columns only, never rows); NaN for zero variance."""
    pos = {c: i for i, c in enumerate(columns)}
    out = np.eye(len(columns))
    for r in correlation_pairs(df, {c: dbl(c) for c in columns}).collect():
        v = np.nan if r["corr"] is None else r["corr"]
        out[pos[r["feature_i"]], pos[r["feature_j"]]] = out[pos[r["feature_j"]], pos[r["feature_i"]]] = v
    return out

"""Bounded, repeatable samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabspark.functions.types import q
from tabspark.operators.quantiles import order_statistics


def bounded_sample(df: DataFrame, n: int, key: str, seed: int = 42, order: Column | None = None) -> DataFrame:
    """Exactly min(n, rows) rows: the first n in a pseudo-random order of the key.

    The n-th order value is found first, so the final sort sees about n rows, not the table.
    """
    order = F.pmod(F.xxhash64(q(key), F.lit(seed)), F.lit(1 << 52)) if order is None else order
    total, found = order_statistics(df, {"o": order}, lambda _, k: [min(n, k) - 1])["o"]
    ranked = df.withColumn("_o", order.cast("double"))
    if total > n:
        ranked = ranked.filter(F.col("_o") <= F.lit(found[n - 1]))
    return ranked.orderBy("_o", key).limit(n).drop("_o")


def fraction_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """An approximate share of the rows, without any ordering."""
    return df.sample(fraction=fraction, seed=seed)

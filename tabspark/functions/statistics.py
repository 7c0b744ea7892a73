"""Statistics built from aggregates that survive degenerate columns (ANSI mode raises on division by zero)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def safe_corr(a: Column, b: Column) -> Column:
    """Pearson correlation over rows where both are present; null for zero variance."""
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a.cast("double")), F.when(both, b.cast("double"))
    return ratio(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def adjusted_skew(n: Column, g1: Column, constant: Column) -> Column:
    """Bias-adjusted skewness from the population one; 0 for a constant column with 3 rows or more."""
    n = n.cast("double")
    return (F.when(n < 3, F.lit(None).cast("double"))
            .when(constant, F.lit(0.0))
            .otherwise(ratio(g1 * F.sqrt(n * (n - 1)), n - 2)))


def adjusted_kurtosis(n: Column, g2: Column, constant: Column) -> Column:
    n = n.cast("double")
    return (F.when(n < 4, F.lit(None).cast("double"))
            .when(constant, F.lit(0.0))
            .otherwise(ratio((n - 1) * ((n + 1) * g2 + 6.0), (n - 2) * (n - 3))))


def xlnx(c: Column) -> Column:
    """c*ln(c) with 0 at 0, the building block of entropies over counts."""
    d = c.cast("double")
    return F.when(d > 0, d * F.ln(d)).otherwise(F.lit(0.0))

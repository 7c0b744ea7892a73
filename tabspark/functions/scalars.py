"""Row-wise expressions. Null input stays null in all of them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabspark.functions.types import name_sql, number_sql, q

# The floors that keep logarithms and powers defined.
POSITIVE_FLOOR = 1e-9
LOG1P_FLOOR = -1.0 + 1e-9


def missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a float column."""
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return q(name).isNull() | F.isnan(q(name))
    return q(name).isNull()


def without_nan(df: DataFrame) -> DataFrame:
    """NaN of float columns as null, so that all operators see one kind of missing value; one projection."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    if not floats:
        return df
    names = {c: name_sql(c) for c in df.columns}
    return df.selectExpr(*[f"nanvl({n}, NULL) AS {n}" if c in floats else n for c, n in names.items()])


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def keep_null(c: Column, result: Column, nullable: bool = True) -> Column:
    """`greatest`/`least` skip nulls, so every clamp of a nullable column needs this guard."""
    return F.when(c.isNotNull(), result) if nullable else result


def log_floor(c: Column, nullable: bool = True) -> Column:
    return keep_null(c, F.ln(F.greatest(c, F.lit(POSITIVE_FLOOR))), nullable)


def log1p_floor(c: Column, nullable: bool = True) -> Column:
    return keep_null(c, F.log1p(F.greatest(c, F.lit(LOG1P_FLOOR))), nullable)


def sqrt_floor(c: Column, nullable: bool = True) -> Column:
    return keep_null(c, F.sqrt(F.greatest(c, F.lit(0.0))), nullable)


def box_cox(c: Column, lam: float) -> Column:
    x = F.greatest(c, F.lit(POSITIVE_FLOOR))
    if abs(lam) < 1e-12:
        return keep_null(c, F.ln(x))
    return keep_null(c, (F.pow(x, F.lit(lam)) - 1.0) / F.lit(lam))


def yeo_johnson(c: Column, lam: float) -> Column:
    up = F.greatest(c, F.lit(0.0))
    down = F.least(c, F.lit(0.0))
    if abs(lam) < 1e-12:
        positive = F.log1p(up)
    else:
        positive = (F.pow(up + 1.0, F.lit(lam)) - 1.0) / F.lit(lam)
    if abs(lam - 2.0) < 1e-12:
        negative = -F.log1p(-down)
    else:
        negative = -(F.pow(1.0 - down, F.lit(2.0 - lam)) - 1.0) / F.lit(2.0 - lam)
    return F.when(c >= 0, positive).when(c < 0, negative)


def clip(c: Column, low: float | None, high: float | None, nullable: bool = True) -> Column:
    """Clip to inclusive limits; a missing limit is no limit."""
    out = c.cast("double")
    if high is not None and not math.isnan(high):
        out = F.least(out, F.lit(float(high)))
    if low is not None and not math.isnan(low):
        out = F.greatest(out, F.lit(float(low)))
    return keep_null(c, out, nullable)


def clip_sql(name: str, low: float | None, high: float | None, nullable: bool = True) -> str:
    """`clip` of a column as SQL text."""
    out = value = f"CAST({name_sql(name)} AS DOUBLE)"
    if high is not None and not math.isnan(high):
        out = f"least({out}, {number_sql(high)})"
    if low is not None and not math.isnan(low):
        out = f"greatest({out}, {number_sql(low)})"
    return f"CASE WHEN {name_sql(name)} IS NOT NULL THEN {out} END" if nullable and out != value else out


def within(c: Column, low: float, high: float) -> Column:
    """True for null and for values inside the inclusive limits."""
    return c.isNull() | c.between(F.lit(low), F.lit(high))


def missing_flag(c: Column) -> Column:
    return c.isNull().cast("int")


def to_timestamp_or_null(c: Column) -> Column:
    return F.try_to_timestamp(c.cast("string"))


def digamma(x: str) -> str:
    """SQL text of psi(x) for x > 0: shift the argument up by 6, then the asymptotic series."""
    z = f"({x} + 6D)"
    shift = " + ".join(f"1D / ({x} + {k}D)" for k in range(6))
    series = (f"ln{z} - 0.5D / {z} - 1D / (12D * pow({z}, 2)) + 1D / (120D * pow({z}, 4))"
              f" - 1D / (252D * pow({z}, 6)) + 1D / (240D * pow({z}, 8))")
    return f"({series} - ({shift}))"

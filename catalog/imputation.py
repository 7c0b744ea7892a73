"""Imputation of several columns from one another."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import KEY, query, r, sql, train, validation
from tabspark.functions.types import q
from tabspark.operators.stages import IterativeImputer


def shown(filled: str, column: str) -> str:
    """Filled values to two places; those that were there as they are."""
    return r(f"CASE WHEN {column} IS NULL THEN round({filled}, 2) ELSE {column} END", column)


def imputed(spark, sf, columns):
    past = train(spark, sf).select(KEY, *columns)
    held = validation(spark, sf).select(KEY, *columns, *[q(c).isNull().alias(f"{c}_was") for c in columns])
    out = IterativeImputer(rounds=2, tolerance=0.0).fit(past, key=KEY).transform(held)
    return out.select(KEY, *[F.when(q(f"{c}_was"), F.round(c, 2)).otherwise(q(c)).alias(c) for c in columns])


def plane(y: str, a: str, b: str, source: str) -> str:
    """Least squares of y on a and b over the rows that have y, in closed form."""
    v = {n: f"covar_pop({p}, {q})" for n, p, q in (("aa", a, a), ("bb", b, b), ("ab", a, b), ("ay", a, y), ("by", b, y))}
    return f"""SELECT ({v['ay']} * {v['bb']} - {v['by']} * {v['ab']}) / ({v['aa']} * {v['bb']} - {v['ab']} ^ 2) AS ba,
      ({v['by']} * {v['aa']} - {v['ay']} * {v['ab']}) / ({v['aa']} * {v['bb']} - {v['ab']} ^ 2) AS bb, avg({y}) AS my, avg({a}) AS ma, avg({b}) AS mb
      FROM {source} WHERE {y} IS NOT NULL"""


def rounds(source: str, name: str) -> dict[str, str]:
    """The states of a relation after two rounds of three columns."""
    parts = {f"{name}0": f"SELECT *, coalesce(income, (SELECT avg(income) FROM train)) AS fi, coalesce(annuity, (SELECT avg(annuity) FROM train)) AS fa FROM {source}"}
    for i in (1, 2):
        def guess(m: str, a: str) -> str:
            return f"(SELECT my + ba * (s.{a} - ma) + bb * (s.credit - mb) FROM {m}{i})"
        parts[f"{name}{i}"] = f"SELECT * EXCLUDE (fi, fa), coalesce(income, {guess('mi', 'fa')}) AS fi, coalesce(annuity, {guess('ma_', 'fi')}) AS fa FROM {name}{i - 1} s"
    return parts


_T, _V = rounds("train", "t"), rounds("val", "v")
_THREE = {"t0": _T["t0"]}
for _i in (1, 2):
    _THREE |= {f"mi{_i}": plane("income", "fa", "credit", f"t{_i - 1}"), f"ma_{_i}": plane("annuity", "fi", "credit", f"t{_i - 1}"), f"t{_i}": _T[f"t{_i}"]}


@query("i9_impute_iterative_three_columns", sql(f"SELECT app_id, {shown('fi', 'income')}, credit, {shown('fa', 'annuity')} FROM v2", **_THREE, **_V))
def i9_three(spark, sf):
    return imputed(spark, sf, ["income", "credit", "annuity"])


def line(y: str, x: str, source: str) -> str:
    return f"SELECT regr_slope({y}, {x}) AS b, regr_intercept({y}, {x}) AS c FROM {source} WHERE {y} IS NOT NULL"


def pair(source: str, name: str) -> dict[str, str]:
    parts = {f"{name}0": f"SELECT *, coalesce(income, (SELECT avg(income) FROM train)) AS fi, coalesce(car_age, (SELECT avg(car_age) FROM train)) AS fa FROM {source}"}
    for i in (1, 2):
        parts[f"{name}{i}"] = (f"SELECT * EXCLUDE (fi, fa), coalesce(income, (SELECT c + b * s.fa FROM mi{i})) AS fi, "
                               f"coalesce(car_age, (SELECT c + b * s.fi FROM mc{i})) AS fa FROM {name}{i - 1} s")
    return parts


_T2, _V2 = pair("train", "t"), pair("val", "v")
_TWO = {"t0": _T2["t0"]}
for _i in (1, 2):
    _TWO |= {f"mi{_i}": line("income", "fa", f"t{_i - 1}"), f"mc{_i}": line("car_age", "fi", f"t{_i - 1}"), f"t{_i}": _T2[f"t{_i}"]}


@query("i9_impute_iterative_two_columns", sql(f"SELECT app_id, {shown('fi', 'income')}, {shown('fa', 'car_age')} FROM v2", **_TWO, **_V2))
def i9_two(spark, sf):
    return imputed(spark, sf, ["income", "car_age"])

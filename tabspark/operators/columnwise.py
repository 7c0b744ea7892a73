"""The same statistics for every column of a wide table, in one scan.

One aggregate per column makes plans of many hundred expressions, which Spark stops compiling. Here the
columns are stacked into (column number, value) rows inside the scan and aggregated by column number:
the plan stays small for any width, and partial aggregation leaves one row per column and task to shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabspark.functions.statistics import ratio
from tabspark.functions.types import name_sql, number_sql, q
from tabspark.operators.aggregate import collect_aggregates

# Columns stacked in one scan; more are done in several scans, each reading only its own columns.
STACK = 80
SKETCH_LG = 12  # 2^12 registers: a standard error of 1.6 percent


def in_parts(columns, work) -> dict:
    """The merged results of ``work`` on at most STACK columns (a dict or a list) at a time."""
    names, out = list(columns), {}
    for i in range(0, len(names), STACK):
        part = names[i:i + STACK]
        out.update(work({c: columns[c] for c in part} if isinstance(columns, dict) else part))
    return out


def _stack(df: DataFrame, exprs: list[Column], keep: dict[str, Column] | None = None) -> DataFrame:
    """(keep..., f, v): non-null values with their column number."""
    keep = keep or {}
    data = df.select(*[c.alias(n) for n, c in keep.items()], *[e.alias(f"x{i}") for i, e in enumerate(exprs)])
    cells = ", ".join(f"struct({i} AS f, x{i} AS v)" for i in range(len(exprs)))
    return data.select(*keep, F.expr(f"inline(array({cells}))")).filter("v IS NOT NULL")


def _by_column(rows: DataFrame, names: list, aggs: dict[str, Column], empty: dict) -> dict:
    got = rows.groupBy("f").agg(*[c.alias(n) for n, c in aggs.items()]).collect()  # one row per column
    out = {n: dict(empty) for n in names}
    for r in got:
        out[names[r["f"]]] = {k: r[k] for k in aggs}
    return out


def numeric_stats(df: DataFrame, columns: dict[str, Column], target: Column | None = None) -> dict[str, dict]:
    """name -> n, lo, hi, mean, std_pop, std (sample), odd (values other than 0 and 1), and corr with a target.

    NaN counts as missing; corr is pairwise-complete and None without variance on either side.
    """
    if len(columns) > STACK:
        return in_parts(columns, lambda part: numeric_stats(df, part, target))
    exprs = [F.nanvl(c.cast("double"), F.lit(None).cast("double")) for c in columns.values()]
    v = F.col("v")
    aggs = {"n": F.count(v), "lo": F.min(v), "hi": F.max(v), "mean": F.avg(v), "std_pop": F.stddev_pop(v),
            "std": F.when(F.count(v) > 1, F.stddev_samp(v)), "odd": F.count_if((v != 0) & (v != 1))}
    keep = {}
    if target is not None:
        keep = {"y": target.cast("double")}
        x = F.when(F.col("y").isNotNull(), v)
        aggs["corr"] = ratio(F.covar_pop(x, F.col("y")), F.stddev_pop(x) * F.stddev_pop("y"))
    empty = {k: 0 if k in ("n", "odd") else None for k in aggs}
    return _by_column(_stack(df, exprs, keep), list(columns), aggs, empty)


def inside_spans(df: DataFrame, limits: dict[str, tuple[Column, float, float]]) -> dict[str, dict]:
    """name -> least and greatest value within the inclusive limits, and the number of values that are not (NaN never is)."""
    if len(limits) > STACK:
        return in_parts(limits, lambda part: inside_spans(df, part))
    low, high = ("array(" + ", ".join(number_sql(x[k]) for x in limits.values()) + ")" for k in (1, 2))
    rows = _stack(df, [c.cast("double") for c, _, _ in limits.values()])
    inside = F.expr(f"v BETWEEN get({low}, f) AND get({high}, f)")
    aggs = {"least": F.min(F.when(inside, F.col("v"))), "greatest": F.max(F.when(inside, F.col("v"))), "outside": F.count_if(~inside)}
    return _by_column(rows, list(limits), aggs, {"least": None, "greatest": None, "outside": 0})


def present_counts(df: DataFrame, columns: dict[str, Column]) -> dict[str, int]:
    """name -> values that are neither null nor NaN."""
    if len(columns) > STACK:
        return in_parts(columns, lambda part: present_counts(df, part))
    exprs = [F.nanvl(c.cast("double"), F.lit(None).cast("double")) for c in columns.values()]
    got = _by_column(_stack(df, exprs), list(columns), {"n": F.count("v")}, {"n": 0})
    return {c: s["n"] for c, s in got.items()}


def outside_counts(df: DataFrame, limits: dict[str, tuple[Column, float, float]]) -> dict[str, int]:
    """name -> values strictly outside (low, high)."""
    if len(limits) > STACK:
        return in_parts(limits, lambda part: outside_counts(df, part))
    low, high = ("array(" + ", ".join(f"{x[k]!r}D" for x in limits.values()) + ")" for k in (1, 2))
    rows = _stack(df, [c.cast("double") for c, _, _ in limits.values()])
    hit = F.expr(f"v < get({low}, f) OR v > get({high}, f)")
    return {c: s["k"] for c, s in _by_column(rows, list(limits), {"k": F.count_if(hit)}, {"k": 0}).items()}


def equal_counts(df: DataFrame, values: dict[str, tuple[Column, float]]) -> dict[str, int]:
    """name -> values equal to the given one."""
    if len(values) > STACK:
        return in_parts(values, lambda part: equal_counts(df, part))
    wanted = "array(" + ", ".join(f"{x!r}D" for _, x in values.values()) + ")"
    rows = _stack(df, [c.cast("double") for c, _ in values.values()])
    return {c: s["k"] for c, s in _by_column(rows, list(values), {"k": F.count_if(F.expr(f"v = get({wanted}, f)"))}, {"k": 0}).items()}


def value_profile(df: DataFrame, columns: list[str], distinct: bool = True) -> dict[str, dict]:
    """column -> n (non-null), xor, lo, hi of a 64-bit value hash, and a sketched distinct count.

    Equal columns have equal hashes whatever the row order, and a column whose hashes all agree is a
    candidate for a constant; both are prefilters, confirmed on the values themselves.
    """
    if not columns:
        return {}
    if len(columns) > STACK:
        return in_parts(columns, lambda part: value_profile(df, part, distinct))
    h = F.col("v")
    aggs = {"n": F.count(h), "xor": F.bit_xor(h), "lo": F.min(h), "hi": F.max(h)}
    if distinct:
        aggs["distinct"] = F.hll_sketch_estimate(F.hll_sketch_agg(h, F.lit(SKETCH_LG)))
    hashes = [F.expr(f"CASE WHEN {name_sql(c)} IS NOT NULL THEN xxhash64({name_sql(c)}) END") for c in columns]
    return _by_column(_stack(df, hashes), columns, aggs, {k: 0 if k in ("n", "distinct") else None for k in aggs})


def constant_columns(df: DataFrame, profile: dict[str, dict]) -> list[str]:
    """Columns with at most one distinct value: no value, or one hash and, checked, one value."""
    alike = [c for c, p in profile.items() if p["n"] and p["lo"] == p["hi"]]
    checked = {}
    if alike:
        checked = collect_aggregates(df, {c: F.min(q(c)) == F.max(q(c)) for c in alike})
    return [c for c, p in profile.items() if p["n"] == 0 or checked.get(c)]

"""Wide aggregation helpers: many features, one scan, small results."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabspark.functions.types import q

# Aggregate expressions per scan; beyond this the generated code stops being compiled.
EXPRESSIONS_PER_SCAN = 240


def chunked(items: list, size: int) -> Iterable[list]:
    for i in range(0, len(items), size):
        yield items[i:i + size]


def collect_aggregates(df: DataFrame, exprs: dict[str, Column]) -> dict:
    """Evaluate named aggregates and return their single row as a dict, a few hundred per scan."""
    out: dict = {}
    for names in chunked(list(exprs), EXPRESSIONS_PER_SCAN):
        row = df.agg(*[exprs[n].alias(f"a{i}") for i, n in enumerate(names)]).collect()[0]
        out.update({n: row[i] for i, n in enumerate(names)})
    return out


def per_feature(df: DataFrame, features: list[str], make: Callable[[str], dict[str, Column]]) -> DataFrame:
    """(feature, *fields): one row per feature from one scan per chunk of features.

    ``make`` returns the same field names and types for every feature.
    """
    if not features:
        raise ValueError("no features given")
    fields = list(make(features[0]))
    parts = []
    for group in chunked(features, max(1, EXPRESSIONS_PER_SCAN // len(fields))):
        aggs, structs = [], []
        for i, feature in enumerate(group):
            made = make(feature)
            aggs += [made[f].alias(f"a{i}_{j}") for j, f in enumerate(fields)]
            structs.append(F.struct(F.lit(feature).alias("feature"),
                                    *[F.col(f"a{i}_{j}").alias(f) for j, f in enumerate(fields)]))
        parts.append(df.agg(*aggs).select(F.inline(F.array(*structs))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def small_frame(spark, rows: list, schema: str | T.StructType) -> DataFrame:
    """A driver-side report (bounded by columns, classes or config) as a DataFrame, also when empty."""
    return spark.createDataFrame(rows, schema)


def long_values(df: DataFrame, columns: dict[str, Column], value_type: str, keep: list[Column] | None = None) -> DataFrame:
    """(keep..., feature, value): the given expressions stacked into rows, without a shuffle."""
    structs = [F.struct(F.lit(name).alias("feature"), c.cast(value_type).alias("value")) for name, c in columns.items()]
    keep = keep or []
    stacked = df.select(*keep, F.explode(F.array(*structs)).alias("_kv"))
    kept = [F.col(c) for c in stacked.columns if c != "_kv"]
    return stacked.select(*kept, F.col("_kv.feature").alias("feature"), F.col("_kv.value").alias("value"))


def value_counts(df: DataFrame, features: list[str], extra: dict[str, Column] | None = None,
                 drop_null: bool = True, by: list[str] | None = None) -> DataFrame:
    """(feature, value, n, extras): histogram of every categorical feature in one scan.

    ``extra`` holds more aggregates over columns named in ``by`` (kept through the stacking).
    Partial aggregation runs before the shuffle, so a value that fills a third of the rows
    still reaches its reducer as one small row per task.
    """
    keep = [q(c).alias(f"_by_{i}") for i, c in enumerate(by or [])]
    stacked = long_values(df, {c: q(c) for c in features}, "string", keep)
    if drop_null:
        stacked = stacked.filter(F.col("value").isNotNull())
    aggs = [F.count(F.lit(1)).alias("n")] + [c.alias(n) for n, c in (extra or {}).items()]
    return stacked.groupBy("feature", "value").agg(*aggs)


def class_cells(df: DataFrame, columns: dict[str, Column], target: str, value_type: str = "string") -> DataFrame:
    """(feature, value, y, n): how often a value meets a class, nulls of either left out. Only pairs that occur are kept, so any number of
    classes will do; marginals are sums over these rows."""
    stacked = long_values(df, columns, value_type, [q(target).alias("y")])
    return stacked.filter(F.col("value").isNotNull() & F.col("y").isNotNull()).groupBy("feature", "value", "y").agg(F.count(F.lit(1)).alias("n"))

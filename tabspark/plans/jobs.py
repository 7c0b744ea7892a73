"""Split the raw table once, then run every model-specific preparation on it."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabspark.functions.types import q
from tabspark.operators.aggregate import collect_aggregates
from tabspark.operators.ordering import running_totals
from tabspark.operators.quantiles import order_statistics
from tabspark.plans.preprocessing import PreprocessingPipeline, load_config
from tabspark.sources.writers import write_frame


# Classes whose cuts are looked for side by side.
CLASSES = 1000


def _split_by_rank(df: DataFrame, order: Column, target: str, key: str, test_size: float) -> DataFrame:
    rows = df.select(q(target).alias("class"), order.alias("o"), q(key).alias("k")).filter("class IS NOT NULL AND o IS NOT NULL")
    ranked = running_totals(rows, "class", ["o", "k"], F.lit(1).cast("long"))
    wanted = rows.groupBy("class").agg(F.floor(F.count(F.lit(1)) * F.lit(test_size) + 0.5).alias("wanted"))
    last = ranked.join(wanted, "class").filter("before = wanted - 1").select(F.col("class").alias("_class"), F.col("o").alias("_o"), F.col("k").alias("_k"))
    upto = (order < F.col("_o")) | ((order == F.col("_o")) & (q(key) <= F.col("_k")))
    return df.join(last, q(target) == F.col("_class"), "left").withColumn("is_validation", F.coalesce(upto, F.lit(False))).drop("_class", "_o", "_k")


def split_flag(df: DataFrame, target: str, key: str, test_size: float = 0.2, seed: int = 42,
               order: Column | None = None) -> DataFrame:
    """``df`` plus boolean ``is_validation``: per class, the first round(test_size * n) rows in hash order.

    The cut is found per class by rank selection, so no class (one of them usually holds most rows) is
    ever sorted or sent to one task. (With more than CLASSES classes a cut each would be too many: all rows' class, order and key are
    then ranked by running totals, and the last row taken of each class is joined to the rows.) It falls on a number that grows with the order (its double value; one
    number for all rows if the order is no number); rows with the number of the cut are ranked by
    (order, key) as they are, so any type and size of either will do.
    """
    exact = F.pmod(F.xxhash64(q(key), F.lit(seed)), F.lit(1 << 52)) if order is None else order
    kind = df.select(exact.alias("o")).schema["o"].dataType
    order = exact.cast("double") if isinstance(kind, T.NumericType) else F.when(exact.isNotNull(), F.lit(0.0))
    sizes = df.filter(q(target).isNotNull()).groupBy(q(target).alias("class")).agg(F.count(F.lit(1)).alias("size"))
    classes = [r["class"] for r in sizes.limit(CLASSES + 1).collect()]
    if len(classes) > CLASSES:
        return _split_by_rank(df, exact, target, key, test_size)
    want: dict[str, int] = {}

    def cut(name: str, n: int) -> list[int]:
        want[name] = int(test_size * n + 0.5)
        return [want[name] - 1]

    of = {str(i): q(target) == F.lit(k) for i, k in enumerate(classes)}
    got = order_statistics(df, {i: F.when(c, order) for i, c in of.items()}, cut)
    edge = {i: got[i][1].get(want[i] - 1) for i in of}
    live = [i for i in of if edge[i] is not None]
    below = collect_aggregates(df, {i: F.count_if(of[i] & (order < F.lit(edge[i]))) for i in live})
    if not live:
        return df.withColumn("is_validation", F.lit(False))
    at_edge = F.lit(None).cast("string")
    for i in live:
        at_edge = F.when(of[i] & (order == F.lit(edge[i])), F.lit(i)).otherwise(at_edge)
    tied = df.select(at_edge.alias("class"), exact.alias("o"), q(key).alias("k")).filter("class IS NOT NULL")
    ranked = running_totals(tied, "class", ["o", "k"], F.lit(1).cast("long"))
    last_of = F.create_map(*[F.lit(x) for i in live for x in (i, want[i] - below[i] - 1)])
    last = {r["class"]: r for r in ranked.filter(F.col("before") == last_of[F.col("class")]).collect()}  # one row per class
    flag = F.lit(False)
    for i in live:
        upto = (exact < F.lit(last[i]["o"])) | ((exact == F.lit(last[i]["o"])) & (q(key) <= F.lit(last[i]["k"])))
        flag = F.when(of[i], (order < F.lit(edge[i])) | ((order == F.lit(edge[i])) & upto)).otherwise(flag)
    return df.withColumn("is_validation", flag)


def stratified_split(df: DataFrame, target: str, key: str, test_size: float = 0.2, seed: int = 42,
                     order: Column | None = None) -> tuple[DataFrame, DataFrame]:
    flagged = split_flag(df, target, key, test_size, seed, order)
    return (flagged.filter(~F.col("is_validation")).drop("is_validation"),
            flagged.filter(F.col("is_validation")).drop("is_validation"))


def run_spec(name: str, config: dict, train: DataFrame, validation: DataFrame, target: str, key: str | None = None,
             output_dir: str | None = None, reports_dir: str | None = None, fmt: str = "csv"):
    """Fit on train, transform both, optionally write ``{name}_train`` and ``{name}_val``; returns (plan, train, val)."""
    plan = PreprocessingPipeline(config, os.path.join(reports_dir, name) if reports_dir else None, target, key_column=key)
    fitted = plan.ordered(plan.fit_transform(train))
    held = plan.ordered(plan.transform(validation))
    if output_dir:
        write_frame(fitted, os.path.join(output_dir, f"{name}_train"), fmt)
        write_frame(held, os.path.join(output_dir, f"{name}_val"), fmt)
    return plan, fitted, held


def run_all(df: DataFrame, specs: dict[str, dict | str], target: str, key: str, output_dir: str, reports_dir: str,
            test_size: float = 0.2, seed: int = 42, fmt: str = "csv") -> dict[str, PreprocessingPipeline]:
    """``specs`` maps a name to a configuration or to the path of its YAML file."""
    train, validation = stratified_split(df, target, key, test_size, seed)
    out = {}
    for name, spec in specs.items():
        config = load_config(spec) if isinstance(spec, str) else spec
        out[name] = run_spec(name, config, train, validation, target, key, output_dir, reports_dir, fmt)[0]
    return out

"""Headline work on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

The inputs are written once (not timed) as a partitioned Parquet table: the applications view, and a wide
variant of it with the shape of the published runs (122 columns: 106 numeric, 16 categorical, half with nulls).
Each query runs twice; `queries` holds the second time, `cold` the first.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, functions as F  # noqa: E402

from catalog.base import CAT, KEY, NUM, TARGET, applications  # noqa: E402
from catalog.runs import config  # noqa: E402
from tabspark.operators import eda, profiling  # noqa: E402
from tabspark.operators.mutual_info import numeric_information  # noqa: E402
from tabspark.plans.jobs import stratified_split  # noqa: E402
from tabspark.plans.preprocessing import PreprocessingPipeline  # noqa: E402
from tabspark.session import build_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def widened(app: DataFrame) -> DataFrame:
    """122 columns: the view plus arithmetic variants of its columns."""
    extra = []
    for i in range(40):
        extra.append(F.expr(f"CAST((app_id * {7 + i} + cust_id * {3 * i + 1}) % {20 + 13 * i} AS BIGINT) AS n{i}"))
    for i in range(57):
        hole = f"(app_id * {i + 3}) % 10 < {i % 7}"
        extra.append(F.expr(f"CASE WHEN {hole} THEN NULL ELSE credit * {1 + i % 9} / (1 + (cust_id * {i + 1}) % {5 + i}) END AS d{i}"))
    for i in range(12):
        hole = f"(app_id * {i + 5}) % 10 < {i % 5}"
        extra.append(F.expr(f"CASE WHEN {hole} THEN NULL ELSE concat('level', (cust_id * {i + 1}) % {3 + 4 * i}) END AS s{i}"))
    return app.select("*", *extra)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def prepare(train: DataFrame, held: DataFrame, model: str) -> None:
    plan = PreprocessingPipeline(config(model), target_column=TARGET, key_column=KEY)
    run(plan.fit_transform(train))
    run(plan.transform(held))


def main() -> None:
    memory = os.environ.get("BENCH_MEMORY", "16g")
    spark = build_session("bench", f"local[{CPUS}]", CPUS, **{"spark.driver.memory": memory})
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.mkdtemp(prefix="/tmp/run-")
    app = applications(spark, SF_DIR)
    app.repartition(CPUS).write.parquet(f"{folder}/app")
    widened(app).repartition(CPUS).write.parquet(f"{folder}/wide")
    app, wide = spark.read.parquet(f"{folder}/app"), spark.read.parquet(f"{folder}/wide")
    train, held = app.filter("app_id % 5 <> 0"), app.filter("app_id % 5 = 0")
    wide_train, wide_held = wide.filter("app_id % 5 <> 0"), wide.filter("app_id % 5 = 0")
    queries = {
        "profile": lambda: run(profiling.DataProfiler.long(profiling.DataProfiler(TARGET).run(app))),
        "numeric_univariate": lambda: run(eda.numeric_univariate(app, NUM)),
        "numeric_bivariate": lambda: run(eda.numeric_bivariate(app, TARGET, NUM)),
        "categories": lambda: run(eda.target_rates(app, TARGET, CAT)),
        "mutual_information": lambda: run(numeric_information(app, NUM, TARGET)),
        "pearson": lambda: run(eda.pearson(app, NUM)),
        "outlier_profile": lambda: run(eda.outlier_profile(app, NUM)),
        "split": lambda: [run(x) for x in stratified_split(app, TARGET, KEY)],
        "tree_based": lambda: prepare(train, held, "tree_based"),
        "linear": lambda: prepare(train, held, "linear"),
        "neural_network": lambda: prepare(train, held, "neural_network"),
        "wide_profile": lambda: run(profiling.DataProfiler.long(profiling.DataProfiler(TARGET).run(wide))),
        "wide_pearson": lambda: run(eda.pearson(wide)),
        "wide_tree_based": lambda: prepare(wide_train, wide_held, "tree_based"),
        "wide_linear": lambda: prepare(wide_train, wide_held, "linear"),
        "wide_neural_network": lambda: prepare(wide_train, wide_held, "neural_network"),
    }
    only = sys.argv[1:]
    cold, warm = {}, {}
    for name, work in queries.items():
        if only and name not in only:
            continue
        for times in (cold, warm):
            started = time.time()
            work()
            times[name] = round(time.time() - started, 3)
        print(f"{name}: {cold[name]} {warm[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(warm.values()), 3), "unit": "sec", "queries": warm, "cold": cold,
                      "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""), "cpus": CPUS, "rows": app.count(),
                      "wide_columns": len(wide.columns)}))
    spark.stop()


if __name__ == "__main__":
    main()

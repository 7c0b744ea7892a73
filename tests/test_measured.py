"""One measurement of numeric columns against Spark's own aggregates, numpy and the ways of the single operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.operators import eda, mutual_info, plotdata
from tabspark.operators.aggregate import class_cells
from tabspark.operators.columnwise import STACK
from tabspark.operators.measured import Measured, scan
from test_kernels import FORCED, skewed

PROBS = [0.0, 0.25, 0.5, 0.75, 1.0]


def close(a, b, scale=1e-9):
    return a == b or (a is not None and b is not None and ((a != a and b != b) or abs(a - b) <= scale * max(1.0, abs(b))))


def odd(spark):
    """Skewed columns and: a large constant that cannot be averaged exactly, a NaN, infinities, one value, one null, only NaN."""
    return skewed(spark).withColumn("i", F.monotonically_increasing_id()).selectExpr(
        "*", "1e15D + 0.3D AS large", "CASE WHEN i = 5 THEN double('NaN') ELSE i % 10 END AS one_nan",
        "CASE WHEN i = 5 THEN double('Infinity') WHEN i % 7 = 1 THEN double('-Infinity') ELSE i % 10 END AS far",
        "CASE WHEN i = 5 THEN 2.5D END AS one", "CASE WHEN i <> 5 THEN (i * 31 % 1000) / 8D END AS one_null", "double('NaN') AS nans").drop("i")


def test_moments_are_those_of_spark(spark):
    df = odd(spark)
    got, _ = scan(df, {c: F.col(c) for c in df.columns})
    aggs = {"rows": F.count(F.lit(1)), "n": F.count, "mean": F.avg, "lo": F.min, "hi": F.max, "std": F.stddev_samp, "g1": F.skewness, "g2": F.kurtosis}
    row = df.agg(*[(f(c) if callable(f) else f).alias(f"{c} {k}") for c in df.columns for k, f in aggs.items()]).first()
    for c in df.columns:
        for k in aggs:
            if k in ("g1", "g2") and (c in ("flat", "large", "empty", "one", "nans") or got[c]["mean"] != got[c]["mean"]):
                continue  # without variance these are set by the operators
            if (c, k) != ("one", "std") and not (c == "far" and k in ("std", "g1", "g2")):
                assert close(got[c][k], row[f"{c} {k}"]), (c, k, got[c][k], row[f"{c} {k}"])
    assert got["large"]["std"] == 0.0 and got["one"]["std"] is None and got["one_nan"]["nan"] == 1 and got["nans"]["nan"] == got["nans"]["n"]
    assert scan(df.filter("false"), {"hot": F.col("hot")})[0]["hot"] == {**dict.fromkeys(got["hot"]), "rows": 0, "n": 0, "nan": 0}


@pytest.mark.parametrize("limits", [{}, FORCED])
def test_quantiles_and_filled_quantiles(spark, limits):
    df = odd(spark).drop("far")
    m, pdf = Measured(df, df.columns, PROBS, mutual_info.EDGES, **limits), df.toPandas()
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    for c in df.columns:
        x = pdf[c].dropna().to_numpy()
        if not len(x):
            assert m.median(c) is None
            continue
        np.testing.assert_allclose([m.quantile(c, p) for p in PROBS], np.quantile(x, PROBS), rtol=1e-12)
        filled = np.concatenate([x, np.full(nulls[c], np.median(x))])
        np.testing.assert_allclose(m.filled_quantiles(c), np.quantile(filled, mutual_info.EDGES), rtol=1e-12)


@pytest.mark.parametrize("limits", [{}, FORCED])
def test_infinite_values_and_more_columns_than_a_scan_holds(spark, limits):
    df = odd(spark).selectExpr("far", *[f"one_null + {i} AS c{i}" for i in range(STACK + 3)])
    m, far = Measured(df, df.columns, PROBS, **limits), np.sort(df.toPandas()["far"].to_numpy())
    values = m._values["far"][1]
    assert len(values) >= 8 and all(v == far[r] for r, v in values.items()) and values[0] == -np.inf and values[len(far) - 1] == np.inf
    assert m.median(f"c{STACK + 2}") == m.median("c0") + STACK + 2


def test_boxes(spark):
    df = odd(spark).drop("far")
    got, pdf = {r["feature"]: r for r in plotdata.box_stats(df, df.columns).collect()}, df.toPandas()
    nan = {"holes": df.filter("isnan(holes)").count(), "one_nan": 1}  # NaN is outside of any fence
    for c in df.columns:
        x = np.sort(pdf[c].dropna().to_numpy())
        if not len(x):
            assert tuple(got[c])[1:] == (None, None, None, None, None, 0)
            continue
        q1, q2, q3 = np.quantile(x, [0.25, 0.5, 0.75])
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        assert all(close(a, b) for a, b in zip(tuple(got[c])[1:], (q1, q2, q3, inside[0], inside[-1], len(x) - len(inside) + nan.get(c, 0)))), c
    assert got["hot"]["fliers"] > 0 and got["flag"]["fliers"] == 0


@pytest.mark.parametrize("y", ["id % 3", "concat('class ', id % 1500)", "CASE WHEN id % 3 = 0 THEN -0.0D WHEN id % 3 = 1 THEN 0.0D ELSE double('NaN') END",
                               "CAST(id % 4 AS DECIMAL(20, 2))", "date_add(DATE'2020-01-01', CAST(id % 5 AS INT))", "array(id % 3)"])
def test_cells_of_bins(spark, y):
    edges = {"a": [3.0, 4.0, 90.5], "b": [], "c": [0.0]}
    data = spark.range(0, 20000, 1, 5).selectExpr(f"{y} AS y", "CASE WHEN id % 7 <> 0 THEN (id * 31) % 101 * 1D END AS x0", "CAST(NULL AS DOUBLE) AS x1",
                                                  "CASE WHEN id % 5 = 0 THEN double('NaN') WHEN id % 5 = 1 THEN -0.0D ELSE id % 2 END AS x2")
    plain = class_cells(data, {c: mutual_info.bin_of(f"x{i}", e) for i, (c, e) in enumerate(edges.items())}, "y", "int")
    got = mutual_info.binned_cells(data, edges)
    assert got.schema.simpleString() == plain.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_sections_share_their_scans(spark):
    """Forty numeric columns: all sections together read the rows a few times, and find what each finds alone."""
    rows, read = 3000, spark.sparkContext.accumulator(0)
    source = spark.range(0, rows, 1, 2).selectExpr("CAST(id % 3 = 0 AS INT) AS y", *[f"CASE WHEN (id + {i}) % 9 > 0 THEN pow(id * {2 * i + 7} % 1009, 2) END AS n{i}" for i in range(40)])

    def passed(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    names = [c for c in source.columns if c != "y"]
    found = eda.EDAOrchestrator("y").run(source.mapInArrow(passed, source.schema), sections=("box", "feature_insights", "importance"))
    found = {s: sorted(map(tuple, f.collect())) for s, f in found.items()}
    assert read.value <= 6 * rows  # twelve times when every section measured for itself
    alone = {"box": plotdata.box_stats(source, names), "feature_insights": eda.feature_insights(source, names), "importance": eda.importance(source, "y")}
    for s, f in alone.items():
        assert len(found[s]) == 40 and all(a[0] == b[0] and all(map(close, a[1:], b[1:])) for a, b in zip(found[s], sorted(map(tuple, f.collect())))), s
    x = source.toPandas()["n3"].dropna()
    assert close(dict((r[0], r[2]) for r in found["feature_insights"])["n3"], x.skew()) and close(dict((r[0], r[2]) for r in found["box"])["n3"], x.median())


def test_ranking_leaves_out_rows_without_a_target(spark):
    """The other sections keep them, so nothing is shared with these."""
    df = spark.range(0, 2000, 1, 2).selectExpr("CASE WHEN id % 4 > 0 THEN CAST(id % 3 = 0 AS INT) END AS y", "CASE WHEN id % 5 > 0 THEN id * 37 % 1009 END AS a", "id % 4 AS b")
    found = eda.EDAOrchestrator("y").run(df, sections=("box", "importance"))
    known = {r["feature"]: r["mutual_info"] for r in eda.importance(df.filter("y IS NOT NULL"), "y").collect()}
    got = {r["feature"]: r["mutual_info"] for r in found["importance"].collect()}
    assert set(got) == {"a", "b"} and all(close(got[c], known[c]) for c in got)
    assert {r["feature"]: r["median"] for r in found["box"].collect()}["b"] == 1.5

"""Kernels against numpy/pandas, on their large-data paths too (limits lowered so that small data takes them)."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabspark.functions.lineage import checkpoint
from tabspark.functions.scalars import digamma
from tabspark.operators import mapping
from tabspark.operators.aggregate import value_counts
from tabspark.operators.duplicates import count_duplicate_rows, duplicate_columns, keep_first
from tabspark.operators.iforest import IsolationForest
from tabspark.operators.moments import correlation_pairs, moment_table
from tabspark.operators.oof import fold_priors, ordered_means
from tabspark.operators.ordering import average_ranks, running_totals
from tabspark.operators.power import fit_lambdas
from tabspark.operators.quantiles import order_statistics, quantiles
from tabspark.operators.sampling import bounded_sample

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
FORCED = dict(rows_limit=10, cells_limit=10, resolve_limit=200, bounds=16, sample_rows=300)


def skewed(spark, n=20000):
    """A third of the rows share one value, heavy tails, nulls, NaN, a constant and an empty column."""
    df = spark.range(0, n, 1, 7)
    return df.select(
        F.expr("CASE WHEN id % 3 = 0 THEN 5.0D ELSE exp((id * 7919 % 1000) / 90.0D) END AS hot"),
        F.expr("CASE WHEN id % 11 = 0 THEN NULL WHEN id % 13 = 0 THEN double('NaN') ELSE (id * 104729 % 20011) - 9000.5D END AS holes"),
        F.expr("CAST(id % 2 AS DOUBLE) AS flag"), F.expr("7.25D AS flat"), F.expr("CAST(NULL AS DOUBLE) AS empty"))


@pytest.mark.parametrize("limits", [{}, FORCED])
def test_quantiles_exact(spark, limits):
    df = skewed(spark)
    got = quantiles(df, {c: F.col(c) for c in df.columns}, PROBS, **limits)
    pdf = df.toPandas()
    for c in df.columns:
        x = pdf[c].dropna().to_numpy()
        if len(x) == 0:
            assert got[c] == [None] * len(PROBS)
        else:
            np.testing.assert_allclose(got[c], np.quantile(x, PROBS), rtol=1e-12)


def test_quantile_grid_by_buckets(spark):
    df = skewed(spark)
    probs = [i / 200 for i in range(201)]
    got = quantiles(df, {c: F.col(c) for c in ("hot", "holes")}, probs, **FORCED)
    pdf = df.toPandas()
    for c in got:
        np.testing.assert_allclose(got[c], np.quantile(pdf[c].dropna(), probs), rtol=1e-12)


def test_many_ranks_directly(spark):
    df = skewed(spark, 3000)
    probs = [i / 500 for i in range(501)]
    got = quantiles(df, {"holes": F.col("holes")}, probs)
    np.testing.assert_allclose(got["holes"], np.quantile(df.toPandas()["holes"].dropna(), probs), rtol=1e-12)


def test_quantiles_do_not_depend_on_partitions(spark):
    df = skewed(spark)
    one = quantiles(df.coalesce(1), {"hot": F.col("hot")}, PROBS, **FORCED)
    assert one == quantiles(df.repartition(8), {"hot": F.col("hot")}, PROBS, **FORCED)


def test_single_row_and_no_row(spark):
    df = spark.range(1).select(F.lit(3.5).alias("x"))
    assert quantiles(df, {"x": F.col("x")}, [0.3])["x"] == [3.5]
    assert quantiles(df.filter("false"), {"x": F.col("x")}, [0.3])["x"] == [None]


def test_large_integers_as_ranks(spark):
    df = spark.range(1000).select(F.expr("id * 4398046511104 AS x"))
    assert order_statistics(df, {"x": F.col("x")}, lambda _, n: [0, 999])["x"][1] == {0: 0.0, 999: 999 * 4398046511104.0}


@pytest.mark.parametrize("limit", [10**6, 100])
def test_running_totals(spark, limit):
    df = spark.range(2000).select(F.expr("CASE WHEN id % 3 = 0 THEN 'a' ELSE 'b' END AS g"), F.expr("(id * 7919) % 2003 AS o"), F.expr("id % 5 AS w"))
    got = running_totals(df, "g", ["o"], F.col("w"), rows_per_window=limit).toPandas()
    pdf = got.sort_values(["g", "o"])
    want = pdf.groupby("g")["w"].cumsum() - pdf["w"]
    assert (pdf["before"].to_numpy() == want.to_numpy()).all() and len(got) == 2000


@pytest.mark.parametrize("limit", [10**6, 50])
def test_average_ranks(spark, limit):
    df = spark.range(3000).select(F.expr("CAST(CASE WHEN id % 3 = 0 THEN 7 ELSE id % 211 END AS DOUBLE) AS x"))
    counts = df.groupBy(F.col("x").alias("value")).agg(F.count(F.lit(1)).alias("n")).withColumn("feature", F.lit("x"))
    got = {r["value"]: r["rank"] for r in average_ranks(counts, rows_per_window=limit).collect()}
    x = df.toPandas()["x"]
    assert got == dict(zip(x, x.rank()))


def test_hot_and_tail_lookup(spark, monkeypatch):
    """A map beyond the broadcast limit: hot values broadcast, tail shuffled, unknown and null rows kept."""
    monkeypatch.setattr(mapping, "BROADCAST_ENTRIES", 20)
    df = spark.range(6000).select("id", F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 17 = 0 THEN NULL WHEN id % 19 = 0 THEN 'new' ELSE concat('v', id % 900) END AS c"))
    known = df.filter("c <> 'new'")
    frame = value_counts(known, ["c"]).withColumn("result", F.col("n").cast("double")).select("feature", "value", "result", "n")
    m = mapping.build_maps(frame, ["c"], limit=20)["c"]
    assert m.entries is None
    joined, (found,) = mapping.with_lookups(df, [("c", m, F.col("c"))])
    got = joined.select("id", "c", found.alias("r")).toPandas().set_index("id").sort_index()
    pdf = df.toPandas().set_index("id").sort_index()
    want = pdf["c"].map(pdf[pdf["c"] != "new"]["c"].value_counts())
    pd.testing.assert_series_equal(got["r"], want.astype(float), check_names=False)
    assert len(got) == 6000


def test_moments_match_pandas_with_nulls(spark):
    df = skewed(spark, 4000).withColumn("mix", F.expr("hot * 2 + holes"))
    cols = ["hot", "holes", "mix", "flag", "flat"]
    want = df.toPandas()[cols].corr()
    for many in (cols, cols + [f"k{i}" for i in range(9)]):
        wide = df.select("*", *[F.expr(f"hot * {i} + flag AS k{i}") for i in range(9)])
        for row in correlation_pairs(wide, {c: F.nanvl(F.col(c), F.lit(None)) for c in many}).collect():
            a, b = row["feature_i"], row["feature_j"]
            if a in cols and b in cols:
                w = want.loc[a, b]
                assert (row["corr"] is None) if math.isnan(w) else row["corr"] == pytest.approx(w, abs=1e-9)


def test_moment_table_has_one_row_per_pair(spark):
    df = skewed(spark, 1000)
    assert moment_table(df, {c: F.col(c) for c in ("hot", "flag", "flat")}).count() == 6


def test_digamma(spark):
    got = spark.sql(f"SELECT {digamma('CAST(1 AS DOUBLE)')} a, {digamma('CAST(0.5 AS DOUBLE)')} b, {digamma('CAST(1000 AS DOUBLE)')} c").first()
    assert got["a"] == pytest.approx(-0.5772156649015329, abs=1e-9)
    assert got["b"] == pytest.approx(-1.9635100260214235, abs=1e-9)
    assert got["c"] == pytest.approx(6.907255195648812, abs=1e-9)


@pytest.mark.parametrize("per_run", [10**6, 40])
def test_ordered_means_by_brute_force(spark, per_run):
    """Also with levels cut into short runs; one level holds a third of the rows and nulls are a level."""
    df = spark.range(900).select("id", F.expr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 23 = 0 THEN NULL ELSE concat('v', id % 7) END AS c"),
                                 F.expr("CAST((id * 31) % 10 < 3 AS INT) AS y"), F.expr("CAST((id * 17) % 4 AS INT) AS f"),
                                 F.expr("(id * 7919) % 907 AS o"))
    prior, priors, rows = fold_priors(df, "y", F.col("f"), 4)
    got = ordered_means(df, ["c"], "y", F.col("f"), 4, 3.0, priors, F.col("o"), F.col("id"), rows, rows_per_run=per_run).collect()
    pdf = df.toPandas().fillna({"c": "nan"}).sort_values(["o", "id"])
    for row in got:
        for g in range(4):
            part = pdf[(pdf["c"] == row["value"]) & (pdf["f"] != g)]
            s = part["y"].cumsum() - part["y"]
            t = np.arange(len(part))
            want = ((s + 3.0 * priors[g]) / (t + 3.0)).mean()
            assert row["result"][g] == pytest.approx(want, abs=1e-9)
    assert {r["value"] for r in got} == set(pdf["c"])


def test_duplicates(spark, monkeypatch):
    df = spark.range(300).select(F.expr("CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS a"), F.expr("CASE WHEN id % 3 = 0 THEN NULL ELSE 'x' END AS b"))
    pdf = df.toPandas()
    assert count_duplicate_rows(df) == int(pdf.duplicated().sum())
    assert count_duplicate_rows(spark.range(50).toDF("a")) == 0
    monkeypatch.setattr("tabspark.operators.duplicates.BROADCAST_ENTRIES", 0)
    assert count_duplicate_rows(df) == int(pdf.duplicated().sum())


@pytest.mark.parametrize("limit", [500_000, 0])
def test_keep_first_follows_the_key(spark, monkeypatch, limit):
    monkeypatch.setattr("tabspark.operators.duplicates.BROADCAST_ENTRIES", limit)
    df = spark.range(200).select((199 - F.col("id")).alias("k"), F.expr("id % 50 AS a"), F.expr("CAST(NULL AS STRING) AS b"), F.expr("id AS y"))
    kept, changed = keep_first(df, ["a", "b"], "k")
    got = {r["a"]: (r["k"], r["y"]) for r in kept.collect()}
    assert changed and len(got) == 50
    pdf = df.toPandas().sort_values("k").drop_duplicates("a")
    assert got == {a: (k, y) for k, a, y in zip(pdf["k"], pdf["a"], pdf["y"])}
    with pytest.raises(ValueError):
        keep_first(df, ["a", "b"], None)


def test_duplicate_columns_need_the_same_order_of_values(spark):
    df = spark.range(100).select("id", F.col("id").alias("same"), (99 - F.col("id")).alias("reversed"), F.col("id").cast("int").alias("other_type"),
                                 F.lit(None).cast("bigint").alias("n1"), F.lit(None).cast("bigint").alias("n2"))
    assert duplicate_columns(df, df.columns) == ["same", "n2"]


def test_lambdas(spark):
    rng = np.random.default_rng(5)
    x = np.exp(rng.normal(2.0, 0.6, 3000))
    y = rng.normal(0, 1, 3000) ** 3
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y}))
    got = fit_lambdas(df, {"x": ("box_cox", F.col("x")), "y": ("yeo_johnson", F.col("y"))})

    def box_cox_ll(lam):
        g = x / np.exp(np.log(x).mean())
        t = np.log(g) if abs(lam) < 1e-12 else (g**lam - 1) / lam
        return -0.5 * len(x) * np.log(t.var())

    def yeo_ll(lam):
        t = np.where(y >= 0, (np.power(np.maximum(y, 0) + 1, lam) - 1) / lam, -(np.power(1 - np.minimum(y, 0), 2 - lam) - 1) / (2 - lam))
        return (lam - 1) * (np.sign(y) * np.log1p(np.abs(y))).sum() - 0.5 * len(y) * np.log(t.var())

    grid = np.arange(-1.5, 1.9, 0.0005) + 1e-7
    assert got["x"] == pytest.approx(max(grid, key=box_cox_ll), abs=1e-3)
    assert got["y"] == pytest.approx(max(grid, key=yeo_ll), abs=1e-3)


def test_lambda_beyond_the_first_grid(spark):
    x = np.linspace(1.0, 2.0, 2000) ** (1 / 6.0)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    lam = fit_lambdas(df, {"x": ("box_cox", F.col("x"))})["x"]
    assert lam > 2.0


def test_isolation_forest_finds_far_points(spark):
    df = spark.range(30000).select("id", F.expr("CASE WHEN id % 1000 = 0 THEN 500.0D ELSE (id * 7919 % 1000) / 1000.0D END AS a"),
                                   F.expr("CASE WHEN id % 1000 = 0 THEN -300.0D ELSE (id * 104729 % 997) / 997.0D END AS b"))
    cols = {c: F.col(c) for c in ("a", "b")}
    forest = IsolationForest(seed=1).fit(df, cols, "id")
    scored = forest.scores(df, cols).toPandas()
    odd = scored["id"] % 1000 == 0
    assert scored[odd]["score"].min() > scored[~odd]["score"].max()
    small = IsolationForest(seed=1).fit(df.limit(3000), cols, "id")
    assert len(small.model) == 100


def test_bounded_sample_is_exact_and_repeatable(spark):
    df = spark.range(5000).withColumn("x", F.col("id") * 2)
    one = {r["id"] for r in bounded_sample(df, 700, "id").collect()}
    two = {r["id"] for r in bounded_sample(df.repartition(5), 700, "id").collect()}
    assert one == two and len(one) == 700
    assert bounded_sample(df, 9000, "id").count() == 5000


def test_checkpoint_cuts_the_lineage(spark):
    df = checkpoint(spark.range(10).withColumn("x", F.col("id") + 1))
    assert "ExistingRDD" in df._jdf.queryExecution().toString() and df.count() == 10


def test_wide_tables_in_parts(spark):
    """More columns than one stack holds: statistics and quantiles per column stay right."""
    from tabspark.operators.columnwise import STACK, numeric_stats, outside_counts, value_profile

    names = [f"c{i}" for i in range(STACK + 9)]
    df = spark.range(50).select(*[F.expr(f"CAST((id * {i + 3}) % 37 AS DOUBLE) AS {c}") for i, c in enumerate(names)])
    pdf = df.toPandas()
    cols = {c: F.col(c) for c in names}
    stats, mid = numeric_stats(df, cols), quantiles(df, cols, [0.5])
    out = outside_counts(df, {c: (F.col(c), 5.0, 30.0) for c in names})
    for c in names:
        assert stats[c]["mean"] == pytest.approx(pdf[c].mean()) and stats[c]["n"] == 50
        assert mid[c] == [pdf[c].median()]
        assert out[c] == int(((pdf[c] < 5) | (pdf[c] > 30)).sum())
    assert set(value_profile(df, names)) == set(names)

"""Imputation of several columns from one another against plain numpy."""

import numpy as np
import pytest

from tabspark.operators.stages import IterativeImputer
from tabspark.plans.preprocessing import PreprocessingPipeline


def rows(n=300, seed=3):
    rng = np.random.default_rng(seed)
    a = rng.normal(50, 10, n)
    x = np.column_stack([a, 2 * a + rng.normal(0, 3, n), 0.5 * a - 7 + rng.normal(0, 2, n), rng.normal(0, 1, n)])
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 3] = rng.normal(0, 1, n)
    return x


def frame(spark, x):
    return spark.createDataFrame([(i, *[None if np.isnan(v) else float(v) for v in r], "t") for i, r in enumerate(x)], "id bigint, a double, b double, c double, d double, kind string")


def plain(x, rounds):
    missing = np.isnan(x)
    state = np.where(missing, np.nanmean(x, axis=0), x)
    for _ in range(rounds):
        last, state = state, state.copy()
        for i in range(x.shape[1]):
            seen, others = ~missing[:, i], [j for j in range(x.shape[1]) if j != i]
            z = np.column_stack([np.ones(len(x)), last[:, others]])
            state[~seen, i] = (z @ np.linalg.lstsq(z[seen], last[seen, i], rcond=None)[0])[~seen]
    return state


def values(df):
    return np.array([[r[c] for c in "abcd"] for r in df.orderBy("id").collect()])


@pytest.mark.parametrize("rounds", [1, 2, 5])
def test_rounds_equal_plain_regressions(spark, rounds):
    x = rows()
    stage = IterativeImputer(rounds=rounds, tolerance=0.0)
    got = stage.fit_transform(frame(spark, x).repartition(5), key="id")
    assert got.columns == ["id", "a", "b", "c", "d", "kind"]
    np.testing.assert_allclose(values(got), plain(x, rounds), rtol=1e-8)


def test_rounds_end_when_nothing_moves(spark):
    x = rows()
    stage = IterativeImputer(["a", "c"], rounds=40, tolerance=1e-2).fit(frame(spark, x), key="id")
    assert 3 < len(stage.models_) < 40 and stage.moved_ <= 1e-2
    cut = plain(x[:, [0, 2]], len(stage.models_))
    np.testing.assert_allclose(values(stage.transform(frame(spark, x)).fillna(0.0))[:, [0, 2]], cut, rtol=1e-8)


def test_odd_columns(spark):
    x = rows(60)
    x[:, 1] = 3 * x[:, 0]  # collinear
    x[:, 2] = np.nan  # no value
    stage = IterativeImputer(rounds=3).fit(frame(spark, x), key="id")
    got = values(stage.transform(frame(spark, x)))
    assert np.isfinite(got).all() and (got[:, 2] == 0).all()
    later = x[:5].copy()
    later[:, 3] = np.nan  # nulls that training did not have
    np.testing.assert_allclose(values(stage.transform(frame(spark, later)))[:, 3], np.nanmean(x[:, 3]))
    assert stage.transform(frame(spark, x[:0])).count() == 0
    assert values(IterativeImputer().fit(frame(spark, x[:0]), key="id").transform(frame(spark, x[:2]))).shape == (2, 4)


def test_ridge_and_chosen_columns(spark):
    x = rows()
    weak = IterativeImputer(["a", "b"], rounds=1, ridge=100.0).fit(frame(spark, x), key="id")
    assert weak.columns_ == ["a", "b"] and np.abs(weak.models_[0][:, 1:]).max() < 0.05
    assert np.isnan([r["c"] if r["c"] is not None else np.nan for r in weak.transform(frame(spark, x)).collect()]).any()


def test_as_a_component(spark):
    plan = PreprocessingPipeline({"pipeline": {"steps": [{"component": "iterative_imputer", "params": {"rounds": 2}}]}}, target_column="y", key_column="id")
    out = plan.fit_transform(frame(spark, rows()).selectExpr("*", "id % 2 AS y"))
    assert out.filter("a IS NULL OR b IS NULL OR c IS NULL").count() == 0

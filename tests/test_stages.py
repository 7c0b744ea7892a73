"""Stages and configured runs on a small fixture: the expected behaviour of each component, and its edges."""

from statistics import NormalDist

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabspark.operators.stages import (DataCleaner, EncodingTransformer, FeatureScaler, FeatureTransformer,
                                       MissingValueTransformer, OutlierTransformer, RareCategoryTransformer)
from tabspark.operators.stages.scaler import normal_score
from tabspark.plans.jobs import run_all, split_flag, stratified_split
from tabspark.plans.preprocessing import PreprocessingPipeline, load_config
from tabspark.plans.presets import MODEL_SPECS
from tabspark.functions.scalars import without_nan
from tabspark.sources.readers import DatasetLoader
from tabspark.streaming.scoring import transform_stream, write_stream


def test_cleaner_drops_copies_and_duplicate_columns(people):
    extra = people.filter("ID = 0").withColumn("ID", F.lit(1000).cast("bigint")).withColumn("target", F.lit(0))
    df = people.unionByName(extra).withColumn("income_duplicate", F.col("income"))
    out = DataCleaner().fit_transform(df, "target", "id")
    # Rows that differ only in id repeat as well here, so compare with pandas.
    pdf = df.toPandas()
    keep = ~pdf.sort_values("id").duplicated(["income", "age", "gender", "occupation", "income_duplicate"])
    assert out.count() == int(keep.sum())
    assert "income_duplicate" not in out.columns and "income" in out.columns
    assert out.filter("id = 1000").count() == 0


def test_cleaner_leaves_rows_alone_on_transform(people):
    stage = DataCleaner()
    stage.fit_transform(people, "target", "id")
    doubled = people.unionByName(people)
    assert stage.transform(doubled).count() == 200


def test_missing_fills_and_flags(people):
    stage = MissingValueTransformer(cat_fill_value="MissingOcc")
    out = stage.fit_transform(people, "target", "id").toPandas()
    assert not out[["income", "age", "gender"]].isna().any().any()
    assert {"income_isnull", "age_isnull", "gender_isnull"} <= set(out.columns) and "occupation_isnull" not in out.columns
    assert (out["gender"] == "MissingOcc").any()
    pdf = people.toPandas()
    assert stage.get_reports()["missing_values"]["income"]["value"] == pytest.approx(pdf["income"].median())
    assert out["income_isnull"].sum() == pdf["income"].isna().sum()


def test_missing_indicator_of_an_absent_column_is_zero(people):
    stage = MissingValueTransformer().fit(people, "target", "id")
    out = stage.transform(people.drop("age"))
    assert out.agg(F.max("age_isnull")).first()[0] == 0


def test_missing_suffix_inside_a_name(spark):
    df = spark.sql("SELECT * FROM VALUES (1, CAST(NULL AS DOUBLE)), (2, 4.0D) t(id, a_isnull_b)")
    out = MissingValueTransformer().fit_transform(df, key="id")
    assert out.columns == ["id", "a_isnull_b", "a_isnull_b_isnull"]
    assert [r[2] for r in out.orderBy("id").collect()] == [1, 0]


def test_missing_empty_columns(spark):
    df = spark.sql("SELECT id, CAST(NULL AS DOUBLE) AS x, CAST(NULL AS STRING) AS s FROM range(4)")
    for strategy in ("median", "mean", "knn"):
        out = MissingValueTransformer(strategy, cat_strategy="mode").fit_transform(df, key="id").first()
        assert out["x"] == 0.0 and out["s"] == "Unknown"


@pytest.mark.parametrize("bad", [{"num_strategy": "guess"}, {"cat_strategy": "guess"}])
def test_missing_unknown_strategy(people, bad):
    with pytest.raises(ValueError):
        MissingValueTransformer(**bad).fit(people, "target", "id")


def test_rare_levels(people):
    out = RareCategoryTransformer(threshold_pct=0.05, fill_value="RARE").fit_transform(people, "target", "id").toPandas()
    assert "Astronaut" not in set(out["occupation"]) and (out["occupation"] == "RARE").sum() == 2
    assert out["gender"].isna().sum() == people.toPandas()["gender"].isna().sum()


def test_rare_levels_beyond_a_literal_list(spark):
    df = spark.range(3000).select("id", F.concat(F.lit("v"), F.col("id") % 900).alias("c"))
    stage = RareCategoryTransformer(threshold_count=4).fit(df, key="id")
    out = stage.transform(df).toPandas()
    assert (out["c"] == "OTHER").sum() == 3 * 600 and stage.transform(df).columns == ["id", "c"]


def test_encoding_target_and_one_hot(people):
    filled = people.fillna({"gender": "Unknown"})
    stage = EncodingTransformer("target", {"occupation": "one_hot"}, target_cv_folds=3)
    out = stage.fit_transform(filled, "target", "id")
    assert {"occupation_Engineer", "occupation_Teacher"} <= set(out.columns)
    assert dict(out.dtypes)["gender"] == "double"
    assert stage.transform(filled).columns == out.columns


def test_encoding_catboost(people):
    cats = people.select("id", "gender", "occupation", "target")
    stage = EncodingTransformer("catboost", target_cv_folds=3, catboost_prior=5.0)
    out = stage.fit_transform(cats, "target", "id")
    assert out.columns == cats.columns and dict(out.dtypes)["occupation"] == "double"
    assert stage.get_reports()["encodings"]["gender"]["strategy"] == "catboost"


def test_out_of_fold_differs_from_the_global_map_and_stays_in_range(people):
    stage = EncodingTransformer("target")
    out = stage.fit_transform(people, "target", "id").toPandas()
    whole = stage.transform(people).toPandas()
    assert (out["occupation"] != whole["occupation"]).any() and out["occupation"].between(0, 1).all()


def test_one_hot_of_many_levels_is_a_map(spark):
    df = spark.range(3000).select("id", F.concat(F.lit("v"), F.col("id")).alias("c"), F.lit("x").alias("few"))
    held = spark.createDataFrame([(1, "v7", "x"), (2, "new", "new"), (3, None, None)], "id bigint, c string, few string")
    stage = EncodingTransformer().fit(df, key="id")
    got = [tuple(r) for r in stage.transform(held).orderBy("id").collect()]
    assert got == [(1, {"v7": 1.0}, 1.0), (2, {}, 0.0), (3, {}, 0.0)]
    assert stage.fit_transform(df, key="id").filter("map_contains_key(c, concat('v', id))").count() == 3000
    assert stage.one_hot_rows(df, "id").count() == 6000
    assert [tuple(r) for r in stage.one_hot_rows(held, "id").orderBy("column").collect()] == [(1, "c_v7", 1.0), (1, "few_x", 1.0)]


def test_cleaner_on_a_stream_with_text_for_numbers(spark, tmp_path):
    stage = DataCleaner().fit(spark.createDataFrame([(1, 2.5, 3)], "id int, x double, n bigint"), key="id")
    spark.createDataFrame([(1, "1.5", "7"), (2, "bad", "x"), (3, None, "9")], "id int, x string, n string").write.parquet(str(tmp_path / "in"))
    stream = stage.transform(spark.readStream.schema("id int, x string, n string").parquet(str(tmp_path / "in")))
    assert stream.isStreaming and dict(stream.dtypes)["x"] == "double"
    query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"))
    assert query.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == [(1, 1.5, 7), (2, None, None), (3, None, 9)]


def test_split_of_a_class_on_equal_orders(spark):
    df = spark.range(100).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("k"), (F.col("id") % 2).alias("y"))
    flagged = split_flag(df, "y", "k", order=F.lit("same"))
    assert {r["k"] for r in flagged.filter("is_validation").collect()} == {f"k{i:03d}" for i in range(20)}
    assert split_flag(df, "y", "k").filter("is_validation").groupBy("y").count().filter("count = 10").count() == 2


def test_encoder_rejects_unknown_settings(people):
    with pytest.raises(ValueError):
        EncodingTransformer("hash").fit(people, "target", "id")
    with pytest.raises(ValueError):
        EncodingTransformer(handle_unknown="error")
    with pytest.raises(ValueError):
        EncodingTransformer("ordinal").fit(people.drop("id"), "target")


def test_outliers_clip(people):
    df = people.select("id", "income", "target")
    filled = MissingValueTransformer(add_indicators=False).fit_transform(df, "target", "id")
    stage = OutlierTransformer()
    out = stage.fit_transform(filled, "target", "id")
    top = out.agg(F.max("income")).first()[0]
    assert top < 5_000_000 and top == pytest.approx(stage.limits_["income"][1])
    assert stage.outlier_counts_["income"] >= 1


def test_outliers_remove_only_in_training(people):
    stage = OutlierTransformer("remove", "winsorize", lower_quantile=0.05, upper_quantile=0.95, columns=["income"])
    out = stage.fit_transform(people, "target", "id")
    assert out.count() < 100 and stage.transform(people).count() == 100
    assert out.filter("income IS NULL").count() == people.filter("income IS NULL").count()


def test_outliers_z_score_of_a_constant(spark):
    df = spark.range(5).select("id", F.lit(2.0).alias("x"))
    assert OutlierTransformer(method="z_score").fit(df, key="id").limits_["x"] == (2.0, 2.0)


def test_outliers_by_isolation_forest(app):
    df = app.select("app_id", "credit", "annuity", "age_days", "target")
    for strategy in ("remove", "clip"):
        stage = OutlierTransformer(strategy, "isolation_forest", contamination=0.1)
        out = stage.fit_transform(df, "target", "app_id")
        total = df.count()
        flagged = stage.outlier_counts_["__rows__"]
        assert 0.05 * total < flagged <= 0.1 * total + 1
        assert out.count() == (total - flagged if strategy == "remove" else total)
        assert set(stage.limits_) == {"credit", "annuity", "age_days"}


def test_scaler_standard(people):
    filled = MissingValueTransformer(add_indicators=False).fit_transform(people.select("id", "income", "age", "target"), "target", "id")
    out = FeatureScaler().fit_transform(filled, "target", "id").toPandas()
    for c in ("income", "age"):
        assert abs(out[c].mean()) < 1e-7 and abs(out[c].std() - 1) < 0.1


def test_scaler_skips_flags_and_rejects_unknown(spark):
    df = spark.range(6).select("id", (F.col("id") % 2).alias("flag"), F.lit(3.0).alias("flat"), F.lit(None).cast("double").alias("none"))
    out = FeatureScaler().fit_transform(df, key="id").toPandas()
    assert set(out["flag"]) == {0, 1} and set(out["flat"]) == {0.0} and out["none"].isna().all()
    with pytest.raises(ValueError):
        FeatureScaler("sigmoid").fit(df.withColumn("x", F.col("id") * 1.5), key="id")


def _interpolated(x, knots):
    refs = np.linspace(0, 1, len(knots))
    up = np.interp(x, knots, refs)
    down = np.interp(-x, -knots[::-1], -refs[::-1])
    out = 0.5 * (up - down)
    out[x == knots[0]], out[x == knots[-1]] = 0.0, 1.0
    return out


def test_normal_scores_equal_the_inverse_distribution_function(spark):
    shares = [0.0, 1e-12, 1e-7, 1e-4, 0.02, 0.02425, 0.0243, 0.3, 0.5, 0.7, 0.97575, 0.98, 0.9999, 1.0]
    df = spark.createDataFrame([(p,) for p in [*shares, None]], "p double")
    got = [r[0] for r in df.select(normal_score(F.col("p"))).collect()]
    assert got[-1] is None
    np.testing.assert_allclose(got[:-1], [NormalDist().inv_cdf(min(max(p, 1e-7), 1 - 1e-7)) for p in shares], rtol=3e-9, atol=1e-9)


def test_scaler_to_a_normal_keeps_nulls_order_and_other_columns(spark):
    df = spark.range(999).selectExpr("id", "IF(id % 10 = 0, NULL, exp(id / 200.0D)) AS x", "id * 1.0D AS _place0", "'t' AS kind")
    stage = FeatureScaler("quantile_normal", {"_place0": "none"}).fit(df, key="id")
    out = stage.transform(df)
    assert out.columns == df.columns and stage.get_reports()["scaling"]["x"] == {"strategy": "quantile_normal"}
    got = out.orderBy("id").toPandas()
    known = got["x"].dropna()
    assert got["x"].isna().sum() == 100 and known.is_monotonic_increasing and (got["_place0"] == got["id"]).all()
    inner = known[1:-1]
    assert abs(inner.mean()) < 0.01 and abs(inner.std() - 1) < 0.02


def test_scaler_quantile_with_ties_and_nulls(spark):
    df = spark.range(2500).select("id", F.expr("CASE WHEN id % 4 = 0 THEN 10.0D WHEN id % 7 = 0 THEN NULL ELSE (id * 31) % 500 * 1.0D END AS x"))
    out = FeatureScaler("quantile").fit_transform(df, key="id").toPandas().sort_values("id")["x"]
    x = df.toPandas().sort_values("id")["x"]
    known = x.dropna().to_numpy()
    want = _interpolated(known, np.quantile(known, np.linspace(0, 1, 1000)))
    np.testing.assert_allclose(out[x.notna().to_numpy()], want, atol=1e-12)
    assert out.isna().sum() == x.isna().sum()


def test_transform_before_fit():
    with pytest.raises(ValueError):
        FeatureScaler().transform(None)


def test_power_transform_report(people):
    stage = FeatureTransformer({"income": "box_cox", "age": "yeo_johnson", "absent": "log"}).fit(people, "target", "id")
    report = stage.get_reports()["transformations"]
    assert report["income"]["operation"] == "box_cox" and set(report) == {"income", "age"}
    with pytest.raises(ValueError):
        FeatureTransformer({"income": "cube"}).fit(people, "target", "id")


# ---- configured runs --------------------------------------------------------------------------

ALL_SEVEN = {"pipeline": {"metadata": {"version": "2.0"}, "steps": [
    "cleaner",
    {"component": "imputation", "params": {"cat_fill_value": "Missing"}},
    {"type": "rare_categories", "params": {"threshold_pct": 0.05}},
    {"component": "encoder", "params": {"default_strategy": "catboost", "column_strategies": {"occupation": "one_hot"}, "target_cv_folds": 3}},
    {"component": "outliers", "params": {"strategy": "clip"}},
    {"component": "transformations", "params": {"transformations": {"income": "log1p"}}},
    {"component": "scaler", "name": "final_scaling", "params": {"default_strategy": "standard"}},
    {"component": "scaler", "enabled": False}]}}


def test_all_components_and_their_reports(spark, people, tmp_path):
    plan = PreprocessingPipeline(ALL_SEVEN, str(tmp_path / "reports"), "target", key_column="id")
    out = plan.fit_transform(people)
    again = plan.transform(people)
    assert set(out.columns) == set(again.columns) and again.count() == 100
    assert sorted(p.name for p in (tmp_path / "reports").iterdir()) == sorted(
        f"{n}.json" for n in ("preprocessing_report", "missing_value_report", "outlier_report", "encoding_report", "scaling_report",
                              "transformation_report", "feature_metadata"))
    assert [s["step"] for s in plan.tracker.run["steps"]][-1] == "final_scaling"
    assert plan.get_feature_names_out() == [c for c in out.columns if c not in ("id", "target")]
    assert out.select([F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(out.columns)]).first()[0] == 0


def test_strict_schema_check(people):
    plan = PreprocessingPipeline(ALL_SEVEN, target_column="target", key_column="id")
    plan.fit(people)
    with pytest.raises(ValueError, match="income"):
        plan.transform(people.drop("income"))


def test_configuration_errors(people):
    def build(**cfg):
        return PreprocessingPipeline({"pipeline": cfg}, target_column="target")
    with pytest.raises(ValueError):
        build(available_components=["cleaner"], steps=["scaler"])
    with pytest.raises(ValueError):
        build(available_components=["magic"], steps=["magic"])
    with pytest.raises(TypeError):
        build(steps=[3])
    with pytest.raises(ValueError):
        build(steps=[{"params": {}}])
    with pytest.raises(ValueError):
        build(steps=["cleaner"]).transform(people)
    with pytest.raises(ValueError, match="leakage"):
        PreprocessingPipeline({"pipeline": {"leakage_validation": {"fail_on_detection": True}, "steps": ["cleaner"]}}, target_column="target").fit(people)


def test_jobs_write_both_splits(spark, app, tmp_path):
    import yaml

    (tmp_path / "linear.yaml").write_text(yaml.safe_dump(MODEL_SPECS["linear"]()))
    assert load_config(str(tmp_path / "linear.yaml")) == MODEL_SPECS["linear"]()
    plans = run_all(app, {"linear": str(tmp_path / "linear.yaml"), "tree_based": MODEL_SPECS["tree_based"]()}, "target", "app_id",
                    str(tmp_path / "out"), str(tmp_path / "reports"))
    loader = DatasetLoader(spark, str(tmp_path / "out"))
    sizes = {n: (len(d.columns), d.count()) for n in ("linear_train", "linear_val", "tree_based_train", "tree_based_val") for d in [loader.load_csv(n)]}
    assert sizes["linear_train"][0] == sizes["linear_val"][0] == len(plans["linear"].get_feature_names_out()) + 2
    assert sizes["tree_based_train"][1] + sizes["tree_based_val"][1] == app.count()


def test_split_keeps_the_class_shares(app):
    train, held = stratified_split(app, "target", "app_id")
    for k in (0, 1):
        n = app.filter(f"target = {k}").count()
        assert held.filter(f"target = {k}").count() == int(0.2 * n + 0.5)
    assert train.join(held, "app_id").count() == 0


def test_split_with_tied_order_values(app):
    _, held = stratified_split(app, "target", "app_id", order=F.lit(1))
    assert held.count() == sum(int(0.2 * app.filter(f"target = {k}").count() + 0.5) for k in (0, 1))


def test_transform_on_a_stream(spark, app, tmp_path):
    spec = MODEL_SPECS["linear"]()
    plan = PreprocessingPipeline(spec, target_column="target", key_column="app_id")
    plan.fit(app)
    app.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(app.schema).parquet(str(tmp_path / "in"))
    assert transform_stream(plan, stream).isStreaming
    write_stream(plan, stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination(120)
    got, want = spark.read.parquet(str(tmp_path / "out")), plan.transform(app)
    assert got.count() == want.count() and set(got.columns) == set(want.columns)
    a = got.agg(F.sum("credit")).first()[0]
    assert a == pytest.approx(want.agg(F.sum("credit")).first()[0])


def test_nan_becomes_null_once(spark):
    df = spark.sql("SELECT double('NaN') AS x, 1 AS y UNION ALL SELECT 2.0D, 2")
    out = without_nan(df)
    assert out.filter("x IS NULL").count() == 1 and out.columns == ["x", "y"]


def test_empty_and_one_class_input(spark, app):
    from tabspark.operators import eda, profiling

    empty = app.filter("false")
    assert profiling.missing_profile(empty).filter("missing_pct IS NOT NULL").count() == 0
    assert profiling.DataProfiler("target").run(empty)["leakage"].count() == 0
    one = app.filter("target = 0")
    assert eda.numeric_bivariate(one, "target", ["credit"]).count() == 0
    assert profiling.target_profile(one, "target").first()["imbalance_ratio"] == float("inf")
    assert eda.missing_vs_target(one.select("credit", "target"), "target").count() == 0
    with pytest.raises(ValueError):
        profiling.target_profile(app, "absent")


def test_vif_of_dependent_columns_is_infinite(spark):
    from tabspark.operators import eda

    df = spark.range(200).select(F.expr("CAST(id % 7 AS DOUBLE) AS a"), F.expr("CAST(id % 11 AS DOUBLE) AS b"),
                                 F.expr("CAST(id % 7 + id % 11 AS DOUBLE) AS ab"), F.expr("CAST(id % 13 AS DOUBLE) AS c"))
    got = {r["feature"]: r["vif"] for r in eda.vif(df).collect()}
    assert got["a"] == got["b"] == got["ab"] == float("inf") and 1 <= got["c"] < 1.2


def test_pca_matches_numpy(app, app_pd):
    from tabspark.operators.eda import PCAModel

    cols = ["income", "credit", "annuity", "age_days"]
    model = PCAModel(3).fit(app, cols)
    x = app_pd[cols].astype(float)
    z = x.fillna(x.median())
    z = ((z - z.mean()) / z.std(ddof=0)).to_numpy()
    values = np.linalg.svd(z, compute_uv=False) ** 2 / (len(z) - 1)
    np.testing.assert_allclose(model.explained_variance, values[:3], rtol=1e-9)
    np.testing.assert_allclose(model.components @ model.components.T, np.eye(3), atol=1e-9)
    out = model.transform(app, ["app_id"]).toPandas().set_index("app_id").loc[app_pd["app_id"]].to_numpy()
    np.testing.assert_allclose(np.abs(out), np.abs(z @ model.components.T), atol=1e-8)


def test_kde_integrates_to_one(app):
    from tabspark.operators import plotdata

    pdf = plotdata.kde(app, ["credit", "age_days"], "target").toPandas()
    for _, g in pdf.groupby(["feature", "target_value"]):
        assert np.trapezoid(g["density"], g["x"]) == pytest.approx(1.0, abs=0.02)

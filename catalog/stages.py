"""I1-I40: fit/transform stages. Unless a query says otherwise it fits on `train` and shows `val` transformed."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import CAT, KEY, NUM, TARGET, applications, query, r, sql, train, validation
from catalog.rows import _DUPES, FIRST_ROWS, duplicated
from tabspark.functions.types import q
from tabspark.operators.aggregate import long_values, small_frame
from tabspark.operators.stages import (DataCleaner, EncodingTransformer, FeatureScaler, FeatureTransformer,
                                       MissingValueTransformer, OutlierTransformer, RareCategoryTransformer)

_MONEY = ["income", "credit", "annuity", "car_age"]


def fitted(stage, spark, sf, columns):
    """The validation rows after a fit on the training rows, with key and these columns."""
    past = train(spark, sf).select(KEY, *columns, TARGET)
    held = validation(spark, sf).select(KEY, *columns)
    return stage.fit(past, TARGET, KEY).transform(held)


# ---- cleaner ----------------------------------------------------------------------------------

@query("i1_row_dedupe", sql("SELECT row_id, cust_id, status, target FROM firsts WHERE k = 1", dup=_DUPES, firsts=FIRST_ROWS))
def i1(spark, sf):
    stage = DataCleaner(drop_col_duplicates=False)
    return stage.fit_transform(duplicated(spark, sf), TARGET, "row_id").select("row_id", F.col("cust_id"), "status", TARGET)


@query("i2_duplicate_columns", "SELECT unnest(['income_duplicate', 'status_again']) AS \"column\"")
def i2(spark, sf):
    """flag_rare_d holds the same values as flag_rare in another type, so it stays."""
    app = applications(spark, sf).select("*", q("income").alias("income_duplicate"), q("flag_rare").cast("double").alias("flag_rare_d"),
                                         q("status").alias("status_again"))
    stage = DataCleaner(drop_row_duplicates=False).fit(app, TARGET, KEY)
    return small_frame(spark, [(c,) for c in stage.duplicate_features_], "column string")


_TYPES = {**{c: "bigint" for c in ("cust_id", "age_days", "flag_rare", "flag_const")},
          **{c: "double" for c in ("income", "credit", "annuity", "car_age")}, **{c: "string" for c in CAT}, "opened": "timestamp"}


@query("i3_type_standardisation", "SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{t}')" for c, t in _TYPES.items()) + ") t(\"column\", type)")
def i3(spark, sf):
    app = applications(spark, sf).withColumn("opened", F.lit("2020-01-31"))
    out = DataCleaner(datetime_cols=["opened"]).fit_transform(app, TARGET, KEY).drop(KEY, TARGET)
    return small_frame(spark, [(f.name, f.dataType.simpleString()) for f in out.schema.fields], "column string, type string")


# ---- missing values ---------------------------------------------------------------------------

@query("i4_impute_indicators", sql("SELECT app_id, " + ", ".join(
    f"CAST({c} IS NULL AS INT) AS {c}_isnull" for c in ("income", "annuity", "car_age", "segment")) + " FROM val"))
def i4(spark, sf):
    out = fitted(MissingValueTransformer(), spark, sf, NUM + CAT)
    return out.select(KEY, *[c for c in out.columns if c.endswith("_isnull")])


def _impute(name: str, stage, fill, columns=("income", "annuity", "car_age")):
    body = "SELECT app_id, " + ", ".join(r(f"coalesce({c}, {fill(c)})", c) for c in columns) + " FROM val"

    @query(name, sql(body))
    def run(spark, sf):
        return fitted(stage(), spark, sf, list(columns))


def _of_train(f: str):
    return lambda c: f"(SELECT {f.format(c=c)} FROM train)"


_impute("i5_impute_median", lambda: MissingValueTransformer(add_indicators=False), _of_train("quantile_cont({c}, 0.5)"))
_impute("i6_impute_mean", lambda: MissingValueTransformer("mean", add_indicators=False), _of_train("avg({c})"))
_impute("i7_impute_constant", lambda: MissingValueTransformer("constant", num_fill_value=-1, add_indicators=False), lambda c: "-1")
_impute("i8_impute_knn", lambda: MissingValueTransformer("knn", add_indicators=False), _of_train("avg({c})"))
_impute("i9_impute_iterative", lambda: MissingValueTransformer("iterative", add_indicators=False), _of_train("avg({c})"))


@query("i10_impute_mode", sql("""SELECT app_id, coalesce(segment, (SELECT segment FROM train WHERE segment IS NOT NULL GROUP BY segment
  ORDER BY count(*) DESC, segment LIMIT 1)) AS segment FROM val"""))
def i10(spark, sf):
    return fitted(MissingValueTransformer(cat_strategy="most_frequent", add_indicators=False), spark, sf, ["segment"])


@query("i11_impute_constant_text", sql("SELECT app_id, coalesce(segment, 'Unknown') AS segment, occupation FROM val"))
def i11(spark, sf):
    return fitted(MissingValueTransformer(add_indicators=False), spark, sf, ["segment", "occupation"])


@query("i12_impute_overrides", sql(f"""SELECT app_id, {r('coalesce(income, 7)', 'income')}, {r('coalesce(annuity, (SELECT avg(annuity) FROM train))', 'annuity')},
  {r('coalesce(car_age, (SELECT quantile_cont(car_age, 0.5) FROM train))', 'car_age')}, coalesce(segment, 'none') AS segment FROM val"""))
def i12(spark, sf):
    own = {"income": {"strategy": "constant", "fill_value": 7}, "annuity": {"strategy": "mean"}, "segment": {"fill_value": "none"}}
    return fitted(MissingValueTransformer(add_indicators=False, column_strategies=own), spark, sf, ["income", "annuity", "car_age", "segment"])


# ---- rare categories --------------------------------------------------------------------------

def _rare(name: str, stage, kept: str):
    case = ", ".join(f"CASE WHEN {c} IS NULL OR {c} IN (SELECT v FROM kept WHERE feature = '{c}') THEN {c} ELSE 'OTHER' END AS {c}"
                     for c in ("segment", "occupation"))

    @query(name, sql(f"SELECT app_id, {case} FROM val", kept=kept))
    def run(spark, sf):
        return fitted(stage(), spark, sf, ["segment", "occupation"])


_LEVELS = "(SELECT feature, v, count(*) AS n FROM tcat WHERE v IS NOT NULL GROUP BY feature, v)"
_rare("i13_rare_pct", lambda: RareCategoryTransformer(), f"SELECT * FROM {_LEVELS} WHERE n >= 0.01 * (SELECT count(*) FROM train)")
_rare("i14_rare_min_count", lambda: RareCategoryTransformer(threshold_count=500), f"SELECT * FROM {_LEVELS} WHERE n >= 500")
_rare("i15_rare_top_k", lambda: RareCategoryTransformer(top_k=3),
      f"SELECT * FROM {_LEVELS} QUALIFY row_number() OVER (PARTITION BY feature ORDER BY n DESC, v) <= 3")


# ---- encoders ---------------------------------------------------------------------------------

@query("i16_encode_one_hot", sql("""SELECT app_id, feature || '_' || coalesce(v, 'nan') AS "column", 1.0::DOUBLE AS value FROM (
  SELECT app_id, 'segment' AS feature, segment AS v FROM val UNION ALL SELECT app_id, 'occupation', occupation FROM val) s
  WHERE EXISTS (SELECT 1 FROM tcat t WHERE t.feature = s.feature AND coalesce(t.v, 'nan') = coalesce(s.v, 'nan'))"""))
def i16(spark, sf):
    """The cells that are one, named by their output column; unseen levels give none."""
    out = fitted(EncodingTransformer(), spark, sf, ["segment", "occupation"])
    cells = long_values(out, {c: q(c) for c in out.columns if c != KEY}, "double", [q(KEY)])
    return cells.filter("value <> 0").withColumnRenamed("feature", "column")


@query("i16_encode_one_hot_sparse", sql("""SELECT app_id, 'cust_' || cust AS "column", 1.0::DOUBLE AS value
  FROM (SELECT app_id, CAST(cust_id AS VARCHAR) AS cust FROM app)"""))
def i16s(spark, sf):
    app = applications(spark, sf).select(KEY, q("cust_id").cast("string").alias("cust"))
    return EncodingTransformer().fit(app, key=KEY).one_hot_rows(app, KEY)


_FIRST = "SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY min(app_id), v) - 1 AS code FROM tcat WHERE v IS NOT NULL GROUP BY feature, v"


def _coded(default: str) -> str:
    def one(c: str) -> str:
        return f"coalesce((SELECT code FROM codes WHERE feature = '{c}' AND codes.v = val.{c}), {default})"
    return f"SELECT app_id, {r(one('segment'), 'segment')}, {r(one('occupation'), 'occupation')} FROM val"


@query("i17_encode_ordinal", sql(_coded("-1"), codes=_FIRST))
def i17(spark, sf):
    return fitted(EncodingTransformer("ordinal"), spark, sf, ["segment", "occupation"])


@query("i18_encode_frequency", sql(_coded("0"), codes="SELECT feature, v, count(*) / (sum(count(*)) OVER (PARTITION BY feature))::DOUBLE "
                                   "AS code FROM tcat WHERE v IS NOT NULL GROUP BY feature, v"))
def i18(spark, sf):
    return fitted(EncodingTransformer("frequency"), spark, sf, ["segment", "occupation"])


def _smoothed(m: float) -> str:
    return f"SELECT feature, v, (sum(y) + {m} * (SELECT avg(target) FROM train)) / (count(y) + {m}) AS code FROM tcat WHERE v IS NOT NULL GROUP BY feature, v"


_PRIOR = "(SELECT avg(target) FROM train)"


@query("i19_encode_target", sql(_coded(_PRIOR), codes=_smoothed(10.0)))
def i19(spark, sf):
    return fitted(EncodingTransformer("target"), spark, sf, ["segment", "occupation"])


@query("i21_encode_catboost", sql(_coded(_PRIOR), codes=_smoothed(5.0)))
def i21(spark, sf):
    return fitted(EncodingTransformer("catboost", catboost_prior=5.0), spark, sf, ["segment", "occupation"])


_FOLDS = dict(pr="SELECT f, (SELECT avg(target) FROM app WHERE app_id % 5 <> f) AS prior FROM (SELECT unnest([0, 1, 2, 3, 4]) AS f)")


def _oof_output(match) -> str:
    return (f"SELECT a.app_id, {r('coalesce(x.code, pr.prior)', 'segment')}, {r('coalesce(z.code, pr.prior)', 'occupation')} FROM app a "
            f"JOIN pr ON pr.f = a.app_id % 5 "
            f"LEFT JOIN folds x ON x.feature = 'segment' AND x.f = pr.f AND x.v = {match('a.segment')} "
            f"LEFT JOIN folds z ON z.feature = 'occupation' AND z.f = pr.f AND z.v = {match('a.occupation')}")


@query("i20_encode_target_oof", sql(_oof_output(lambda c: c), **_FOLDS, folds="""SELECT feature, v, pr.f,
  (sum(y) + 10.0 * any_value(prior)) / (count(y) + 10.0) AS code FROM cat JOIN pr ON app_id % 5 <> pr.f WHERE v IS NOT NULL GROUP BY feature, v, pr.f"""))
def i20(spark, sf):
    app = applications(spark, sf).select(KEY, "segment", "occupation", TARGET)
    return EncodingTransformer("target", fold="app_id % 5").fit_transform(app, TARGET, KEY).drop(TARGET)


@query("i22_encode_catboost_oof", sql(_oof_output(lambda c: f"coalesce({c}, 'nan')"), **_FOLDS, steps="""SELECT feature, coalesce(v, 'nan') AS v, pr.f, prior,
  coalesce(sum(y) OVER w, 0) AS s, row_number() OVER (PARTITION BY feature, coalesce(v, 'nan'), pr.f ORDER BY (app_id * 7919) % 1000003, app_id) - 1 AS t
  FROM cat JOIN pr ON app_id % 5 <> pr.f WINDOW w AS (PARTITION BY feature, coalesce(v, 'nan'), pr.f
  ORDER BY (app_id * 7919) % 1000003, app_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
                                      folds="SELECT feature, v, f, avg((s + 10.0 * prior) / (t + 10.0)) AS code FROM steps GROUP BY feature, v, f"))
def i22(spark, sf):
    app = applications(spark, sf).select(KEY, "segment", "occupation", TARGET)
    stage = EncodingTransformer("catboost", fold="app_id % 5", order="(app_id * 7919) % 1000003")
    return stage.fit_transform(app, TARGET, KEY).drop(TARGET)


@query("i23_encode_without_target", sql(_coded("0"), codes=_FIRST))
def i23(spark, sf):
    past, held = (f(spark, sf).select(KEY, "segment", "occupation") for f in (train, validation))
    return EncodingTransformer("target", {"occupation": "catboost"}).fit(past, key=KEY).transform(held)


@query("i24_encode_per_column", sql(f"""SELECT app_id, {r("coalesce((SELECT code FROM codes WHERE feature = 'segment' AND codes.v = val.segment), -1)", 'segment')},
  {r("coalesce((SELECT code FROM tgt WHERE feature = 'occupation' AND tgt.v = val.occupation), " + _PRIOR + ")", 'occupation')}, {r('credit', 'credit')} FROM val""",
                                    codes=_FIRST, tgt=_smoothed(10.0)))
def i24(spark, sf):
    return fitted(EncodingTransformer("target", {"segment": "ordinal"}), spark, sf, ["segment", "occupation", "credit"])


# ---- outliers ---------------------------------------------------------------------------------

def limits_frame(spark, stage):
    rows = [(c, lo, hi, stage.outlier_counts_[c]) for c, (lo, hi) in stage.limits_.items()]
    return small_frame(spark, rows, "feature string, low double, high double, outliers bigint")


_LIMITS = {
    "iqr": "SELECT feature, quantile_cont(v, 0.25) - 1.5 * (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) AS lo, "
           "quantile_cont(v, 0.75) + 1.5 * (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) AS hi FROM tnum GROUP BY feature",
    "z_score": "SELECT feature, avg(v) - 2.0 * stddev_samp(v) AS lo, avg(v) + 2.0 * stddev_samp(v) AS hi FROM tnum GROUP BY feature",
    "winsorize": "SELECT feature, quantile_cont(v, 0.01) AS lo, quantile_cont(v, 0.99) AS hi FROM tnum GROUP BY feature",
}


def _limits(name: str, method: str, columns: list[str], **params):
    names = ", ".join(f"'{c}'" for c in columns)

    @query(name, sql(f"""SELECT feature, {r('any_value(lo)', 'low', 4)}, {r('any_value(hi)', 'high', 4)},
      count(*) FILTER (WHERE v < lo OR v > hi) AS outliers FROM tnum JOIN lim USING (feature) WHERE feature IN ({names}) GROUP BY feature""",
                     lim=_LIMITS[method]), digits=4)
    def run(spark, sf):
        stage = OutlierTransformer(method=method, **params)
        return limits_frame(spark, stage.fit(train(spark, sf).select(KEY, *columns, *CAT, TARGET), TARGET, KEY))


_limits("i25_outliers_iqr", "iqr", _MONEY)
_limits("i26_outliers_z_score", "z_score", _MONEY, threshold=2.0)
_limits("i27_outliers_winsorize", "winsorize", _MONEY)
_limits("i31_outliers_column_scope", "iqr", NUM)


@query("i28_outliers_isolation_forest")
def i28(spark, sf):
    """Limits learned on the inliers, and the number of rows called outliers."""
    stage = OutlierTransformer(method="isolation_forest")
    stage.fit(train(spark, sf).select(KEY, *_MONEY, TARGET), TARGET, KEY)
    rows = [(c, lo, hi, stage.outlier_counts_["__rows__"]) for c, (lo, hi) in stage.limits_.items()]
    return small_frame(spark, rows, "feature string, low double, high double, outlier_rows bigint")


def _bound(c: str, side: str) -> str:
    return f"(SELECT {side} FROM lim WHERE feature = '{c}')"


@query("i29_outliers_clip", sql("SELECT app_id, " + ", ".join(
    r(f"CASE WHEN {c} IS NOT NULL THEN greatest(least({c}, {_bound(c, 'hi')}), {_bound(c, 'lo')}) END", c) for c in _MONEY) + " FROM val",
                                lim=_LIMITS["iqr"]))
def i29(spark, sf):
    return fitted(OutlierTransformer(), spark, sf, _MONEY)


@query("i30_outliers_remove", sql("SELECT app_id, target FROM train WHERE " + " AND ".join(
    f"({c} IS NULL OR {c} BETWEEN {_bound(c, 'lo')} AND {_bound(c, 'hi')})" for c in _MONEY), lim=_LIMITS["winsorize"]))
def i30(spark, sf):
    past = train(spark, sf).select(KEY, *_MONEY, TARGET)
    return OutlierTransformer("remove", "winsorize").fit_transform(past, TARGET, KEY).select(KEY, TARGET)


# ---- transformations --------------------------------------------------------------------------

@query("i32_transform_static", sql(f"""SELECT app_id, {r('CASE WHEN income IS NOT NULL THEN ln(greatest(income, 1e-9)) END', 'income')},
  {r('ln(1 + greatest(credit, -1 + 1e-9))', 'credit')}, {r('CASE WHEN annuity IS NOT NULL THEN sqrt(greatest(annuity, 0)) END', 'annuity')} FROM val"""))
def i32(spark, sf):
    return fitted(FeatureTransformer({"income": "log", "credit": "log1p", "annuity": "sqrt"}), spark, sf, ["income", "credit", "annuity"])


def _lambda_search(value: str, derivative: str, column: str) -> dict:
    """Likelihood over a grid of 0.1 on [-2, 2], then three tenfold refinements, as text."""
    parts = {"x": f"SELECT CAST({column} AS DOUBLE) AS x FROM train WHERE {column} IS NOT NULL",
             "m": f"SELECT count(*) AS n, {derivative} AS d FROM x"}
    grid = "SELECT -2.0::DOUBLE + i * 0.1::DOUBLE AS lam FROM range(41) t(i)"
    for level, step in enumerate(("0.1", "0.01", "0.001", "0.0001")):
        parts[f"g{level}"] = grid
        parts[f"s{level}"] = (f"SELECT lam, (lam - 1) * any_value(m.d) - 0.5 * any_value(m.n) * ln(var_pop({value})) AS score "
                              f"FROM g{level}, x, m GROUP BY lam")
        parts[f"b{level}"] = f"SELECT arg_max(lam, score) AS lam FROM s{level}"
        finer = float(step) / 10
        grid = f"SELECT lam - {step} + i * {finer:.5f} AS lam FROM b{level}, range(21) t(i)"
    return parts


_YJ = """CASE WHEN x >= 0 THEN CASE WHEN abs(lam) < 1e-12 THEN ln(1 + x) ELSE (pow(x + 1, lam) - 1) / lam END
  ELSE CASE WHEN abs(lam - 2) < 1e-12 THEN -ln(1 - x) ELSE -(pow(1 - x, 2 - lam) - 1) / (2 - lam) END END"""
_YJ_D = "sum(sign(x) * ln(1 + abs(x)))"
_BC = "CASE WHEN abs(lam) < 1e-12 THEN ln(x / (SELECT exp(avg(ln(x))) FROM x)) ELSE (pow(x / (SELECT exp(avg(ln(x))) FROM x), lam) - 1) / lam END"


def _lambda_frame(spark, stage):
    rows = [(c, p["operation"], p["parameters"].get("lambda")) for c, p in stage.get_reports()["transformations"].items()]
    return small_frame(spark, rows, "feature string, operation string, lambda double")


@query("i33_transform_box_cox", sql(f"SELECT 'credit' AS feature, 'box_cox' AS operation, {r('lam', 'lambda', 3)} FROM b3",
                                    **_lambda_search(_BC, "0.0", "credit")), digits=3)
def i33(spark, sf):
    return _lambda_frame(spark, FeatureTransformer({"credit": "box_cox"}).fit(train(spark, sf), TARGET, KEY))


@query("i33_transform_box_cox_fallback", sql(f"SELECT 'income' AS feature, 'yeo_johnson' AS operation, {r('lam', 'lambda', 3)} FROM b3",
                                             **_lambda_search(_YJ, _YJ_D, "income")), digits=3)
def i33f(spark, sf):
    """income has values <= 0, where Box-Cox is undefined."""
    return _lambda_frame(spark, FeatureTransformer({"income": "box_cox"}).fit(train(spark, sf), TARGET, KEY))


@query("i34_transform_yeo_johnson", sql(f"SELECT 'age_days' AS feature, 'yeo_johnson' AS operation, {r('lam', 'lambda', 3)} FROM b3",
                                        **_lambda_search(_YJ, _YJ_D, "age_days")), digits=3)
def i34(spark, sf):
    return _lambda_frame(spark, FeatureTransformer({"age_days": "yeo_johnson"}).fit(train(spark, sf), TARGET, KEY))


@query("i35_transform_report", "SELECT * FROM (VALUES ('income', 'log', NULL::DOUBLE), ('credit', 'sqrt', NULL)) t(feature, operation, \"lambda\")")
def i35(spark, sf):
    return _lambda_frame(spark, FeatureTransformer({"income": "log", "credit": "sqrt", "absent": "log"}).fit(train(spark, sf), TARGET, KEY))


# ---- scaling ----------------------------------------------------------------------------------

def _scaled(name: str, strategy: str, center: str, scale: str):
    def one(c: str) -> str:
        return r(f"({c} - (SELECT {center.format(c=c)} FROM train)) / (SELECT {scale.format(c=c)} FROM train)", c)

    @query(name, sql("SELECT app_id, " + ", ".join(one(c) for c in _MONEY) + " FROM val"))
    def run(spark, sf):
        return fitted(FeatureScaler(strategy), spark, sf, _MONEY)


_scaled("i36_scale_standard", "standard", "avg({c})", "stddev_pop({c})")
_scaled("i37_scale_minmax", "minmax", "min({c})", "max({c}) - min({c})")
_scaled("i38_scale_robust", "robust", "quantile_cont({c}, 0.5)", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)")

_KNOTS = "SELECT quantile_cont(credit, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]) AS k FROM train"


@query("i39_scale_quantile", sql(f"""SELECT app_id, {r('''CASE WHEN credit <= lo THEN 0 WHEN credit >= hi THEN 1 ELSE
  (i + (credit - a) / (b - a)) / 10 END''', 'credit')} FROM (
    SELECT app_id, credit, k[1] AS lo, k[11] AS hi, i, k[i + 1] AS a, k[i + 2] AS b FROM (
      SELECT app_id, credit, k, least(greatest((SELECT count(*) FROM (SELECT unnest(k) AS e FROM knots) u WHERE u.e <= credit) - 1, 0), 9) AS i
      FROM val, knots))""", knots=_KNOTS))
def i39(spark, sf):
    return fitted(FeatureScaler("quantile", n_quantiles=11), spark, sf, ["credit"])


def _grid_position(c: str) -> str:
    """Position of a column among its 1000 quantiles: between two of them by interpolation, on ties the middle of the equal ones."""
    return f"""CASE WHEN {c} IS NULL THEN NULL WHEN {c} <= {c}_k[1] THEN 0 WHEN {c} >= {c}_k[1000] THEN 1
  WHEN {c}_k[{c}_up] = {c} THEN (({c}_up - 1) + {c}_low) / 2.0 / 999 ELSE ({c}_up - 1 + ({c} - {c}_k[{c}_up]) / ({c}_k[{c}_up + 1] - {c}_k[{c}_up])) / 999 END"""


_GRID_TEXT = "[" + ", ".join(f"{i}::DOUBLE / 999" for i in range(1000)) + "]"
_PLACES = ", ".join(f"len(list_filter({c}_k, lambda x: x <= {c})) AS {c}_up, len(list_filter({c}_k, lambda x: x < {c})) AS {c}_low" for c in _MONEY)


@query("i39_scale_quantile_full", sql(f"SELECT app_id, {', '.join(r(_grid_position(c), c) for c in _MONEY)} FROM places",
                                      grid="SELECT " + ", ".join(f"quantile_cont({c}, {_GRID_TEXT}) AS {c}_k" for c in _MONEY) + " FROM train",
                                      places=f"SELECT *, {_PLACES} FROM val, grid"))
def i39f(spark, sf):
    """1000 quantiles per column, on columns with nulls and ties."""
    return fitted(FeatureScaler("quantile"), spark, sf, _MONEY)


def _density(z: str) -> str:
    return f"exp(-({z}) * ({z}) / 2) / sqrt(2 * pi())"


#: The normal distribution function at steps of 0.001, summed by Simpson's rule.
_NORMAL = f"""SELECT z, sum(({_density('z - 0.001')} + 4 * {_density('z - 0.0005')} + {_density('z')}) / 6000) OVER (ORDER BY z) AS below, {_density('z')} AS density
  FROM (SELECT (i - 8000) / 1000.0::DOUBLE AS z FROM range(16001) t(i))"""


def _score(c: str) -> str:
    """The inverse of the distribution function by its series from the step before."""
    d = f"(({c}_p - {c}_n.below) / {c}_n.density)"
    return f"CASE WHEN {c} IS NOT NULL THEN {c}_n.z + {d} + {c}_n.z * {d} ^ 2 / 2 + (2 * {c}_n.z ^ 2 + 1) * {d} ^ 3 / 6 END"


_SHARES = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN greatest(1e-7, least(1 - 1e-7, {_grid_position(c)})) END AS {c}_p" for c in _MONEY)
_JOINS = " ".join(f"ASOF LEFT JOIN normal {c}_n ON {c}_p >= {c}_n.below" for c in _MONEY)


@query("i39_scale_quantile_normal", sql(f"SELECT app_id, {', '.join(r(_score(c), c, 3) for c in _MONEY)} FROM shares {_JOINS}",
                                        grid="SELECT " + ", ".join(f"quantile_cont({c}, {_GRID_TEXT}) AS {c}_k" for c in _MONEY) + " FROM train",
                                        places=f"SELECT *, {_PLACES} FROM val, grid", shares=f"SELECT app_id, {', '.join(_MONEY)}, {_SHARES} FROM places", normal=_NORMAL), digits=3)
def i39n(spark, sf):
    """Normal scores of the positions among 1000 quantiles, on columns with nulls and ties."""
    return fitted(FeatureScaler("quantile_normal"), spark, sf, _MONEY)


@query("i40_scale_skip_rules", sql(f"""SELECT app_id, {r('income', 'income')},
  {r('(credit - (SELECT min(credit) FROM train)) / (SELECT max(credit) - min(credit) FROM train)', 'credit')},
  {r('(car_age - (SELECT avg(car_age) FROM train)) / (SELECT stddev_pop(car_age) FROM train)', 'car_age')},
  {r('annuity', 'annuity')}, flag_rare, flag_const, status FROM val"""))
def i40(spark, sf):
    """annuity is excluded, income has strategy none, flags are binary, status is text, car_age keeps its nulls."""
    stage = FeatureScaler("standard", {"income": "none", "credit": "minmax"}, exclude_cols=["annuity"])
    return fitted(stage, spark, sf, ["income", "credit", "car_age", "annuity", "flag_rare", "flag_const", "status"])

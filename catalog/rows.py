"""A, B, C, H: sources and samples, projections and predicates, lookups, scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import (CAT, COLUMNS, KEY, NUM, TARGET, applications, query, r, run_folder, sql, stack, table, train,
                          validation)
from tabspark.functions import scalars as S
from tabspark.functions.statistics import safe_corr
from tabspark.functions.types import column_families, dbl, q
from tabspark.operators import profiling as P
from tabspark.operators.aggregate import per_feature
from tabspark.operators.eda import filled_numeric
from tabspark.operators.mapping import build_maps, with_lookups
from tabspark.operators.quantiles import medians, quantiles
from tabspark.operators.sampling import bounded_sample
from tabspark.operators.stages import DataCleaner, FeatureTransformer, RareCategoryTransformer
from tabspark.operators.aggregate import value_counts
from tabspark.sources.readers import DatasetLoader
from tabspark.sources.writers import write_frame

_CENTS = [c for c in COLUMNS if c not in ("income", "credit", "annuity")]
_APP_OUT = ", ".join(_CENTS + [r(c, c) for c in ("income", "credit", "annuity")])


# ---- A: sources and samples -------------------------------------------------------------------

@query("a1_load_csv", sql(f"SELECT {_APP_OUT} FROM app"))
def a1(spark, sf):
    app = applications(spark, sf)
    folder = run_folder(spark)
    write_frame(app, f"{folder}/applications.csv")
    return DatasetLoader(spark, folder).load_csv("applications.csv", schema=app.schema)


@query("a2_raw_csv_scan", sql(f"SELECT status, count(*) AS n, {r('avg(credit)', 'mean_credit', 4)} FROM app WHERE credit > 50000 GROUP BY status"), digits=4)
def a2(spark, sf):
    app = applications(spark, sf)
    folder = run_folder(spark)
    write_frame(app, f"{folder}/raw.csv")
    raw = DatasetLoader(spark, folder).load_csv("raw.csv", schema=app.schema)
    return raw.filter("credit > 50000").groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.avg("credit").alias("mean_credit"))


@query("a9_bounded_sample", sql(f"SELECT app_id, status, {r('credit', 'credit')} FROM app ORDER BY (app_id * 7919) % 1000003, app_id LIMIT 2000"))
def a9(spark, sf):
    return bounded_sample(applications(spark, sf), 2000, KEY, order=F.expr("(app_id * 7919) % 1000003")).select(KEY, "status", "credit")


# ---- B: projections and predicates ------------------------------------------------------------

_FAMILY = {**{c: "numeric" for c in [KEY, *NUM, TARGET]}, **{c: "categorical" for c in CAT}}


@query("b1_column_families", "SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{f}')" for c, f in _FAMILY.items())
       + ", ('opened', 'datetime'), ('big', 'boolean')) t(\"column\", family)")
def b1(spark, sf):
    app = applications(spark, sf)
    return column_families(app.withColumn("opened", F.current_timestamp()).withColumn("big", F.col("credit") > 1))


@query("b5_column_prune", sql(f"SELECT {r('credit', 'credit', 4)}, status, app_id FROM app"), digits=4)
def b5(spark, sf):
    return applications(spark, sf).drop(TARGET).select("credit", "status", KEY)


@query("b6_pairwise_null_drop", sql(f"SELECT feature, count(*) AS n, {r('avg(v)', 'mean', 4)} FROM num WHERE v IS NOT NULL AND y IS NOT NULL GROUP BY feature"), digits=4)
def b6(spark, sf):
    return per_feature(applications(spark, sf), NUM, lambda c: {
        "n": F.count(F.when(q(c).isNotNull() & q(TARGET).isNotNull(), 1)),
        "mean": F.avg(F.when(q(c).isNotNull() & q(TARGET).isNotNull(), dbl(c)))})


@query("b7_complete_cases", sql("SELECT app_id FROM app WHERE income IS NOT NULL AND annuity IS NOT NULL AND car_age IS NOT NULL"))
def b7(spark, sf):
    return applications(spark, sf).na.drop("any", subset=["income", "annuity", "car_age"]).select(KEY)


@query("b8_drop_all_null", sql(f"SELECT app_id, {r('coalesce(income, (SELECT quantile_cont(income, 0.5) FROM app))', 'income', 4)}, "
                               f"{r('credit', 'credit', 4)} FROM app"), digits=4)
def b8(spark, sf):
    app = applications(spark, sf).withColumn("nothing", F.lit(None).cast("double"))
    return filled_numeric(app, ["income", "nothing", "credit"], keep=[KEY])


@query("b9_fill_median", sql("SELECT app_id, " + ", ".join(
    r(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM app))", c) for c in ("income", "annuity", "car_age")) + " FROM app"))
def b9(spark, sf):
    app = applications(spark, sf)
    cols = ["income", "annuity", "car_age"]
    mid = medians(app, {c: dbl(c) for c in cols})
    return app.select(KEY, *[F.coalesce(q(c), F.lit(mid[c])).alias(c) for c in cols])


@query("b10_threshold_filters", sql("""SELECT 'high_missing' AS rule, feature FROM allc GROUP BY feature
  HAVING 100.0 * count(*) FILTER (WHERE v IS NULL) / count(*) > 50
  UNION ALL SELECT 'unique_ratio', feature FROM allc GROUP BY feature HAVING count(DISTINCT v) > 0.95 * count(*)""",
                                    allc=stack("app", COLUMNS, "VARCHAR")))
def b10(spark, sf):
    app = applications(spark, sf)
    high = P.missing_profile(app).filter("missing_pct > 50").select(F.lit("high_missing").alias("rule"), "feature")
    ids = P.leakage_profile(app).select(F.col("reason").alias("rule"), "feature")
    return high.unionByName(ids)


_FREQ = "SELECT occupation AS v FROM train GROUP BY 1 HAVING count(*) >= 0.01 * (SELECT count(*) FROM train)"
_RARE = "SELECT app_id, CASE WHEN occupation IS NULL OR occupation IN (FROM freq) THEN occupation ELSE 'OTHER' END AS occupation FROM val"


@query("b11_membership", sql("SELECT app_id, occupation IS NOT NULL AND occupation NOT IN (FROM freq) AS rare FROM val", freq=_FREQ))
def b11(spark, sf):
    stage = RareCategoryTransformer().fit(train(spark, sf).select(KEY, "occupation"), key=KEY)
    held = validation(spark, sf)
    return held.select(KEY, (q("occupation").isNotNull() & ~q("occupation").isin(stage.frequent_categories_["occupation"])).alias("rare"))


@query("b12_range_predicate", sql("SELECT app_id FROM app WHERE income IS NULL OR income BETWEEN 0 AND 5000"))
def b12(spark, sf):
    return applications(spark, sf).filter(S.within(q("income"), 0, 5000)).select(KEY)


@query("b13_clip", sql(f"""SELECT app_id, {r('CASE WHEN income IS NOT NULL THEN greatest(least(income, 5000), 0) END', 'both', 4)},
  {r('CASE WHEN income IS NOT NULL THEN least(income, 5000) END', 'upper_only', 4)} FROM app"""), digits=4)
def b13(spark, sf):
    return applications(spark, sf).select(KEY, S.clip(q("income"), 0.0, 5000.0).alias("both"),
                                          S.clip(q("income"), float("nan"), 5000.0).alias("upper_only"))


@query("b14_missing_flag", sql("SELECT app_id, CAST(income IS NULL AS INT) AS income_isnull, CAST(segment IS NULL AS INT) AS segment_isnull FROM app"))
def b14(spark, sf):
    return applications(spark, sf).select(KEY, *[S.missing_flag(q(c)).alias(f"{c}_isnull") for c in ("income", "segment")])


# ---- C: what plays the role of joins ----------------------------------------------------------

_DUPES = "SELECT app_id * 2 AS row_id, * EXCLUDE (app_id) FROM app UNION ALL " \
         "SELECT app_id * 2 + 1, * EXCLUDE (app_id) REPLACE (1 - target AS target) FROM app WHERE app_id % 50 = 0"
FEATURES = [*NUM, *CAT]
FIRST_ROWS = f"SELECT *, row_number() OVER (PARTITION BY {', '.join(FEATURES)} ORDER BY row_id) AS k FROM dup"


def duplicated(spark, sf):
    """Rows with copies whose target is flipped; row_id orders them."""
    app = applications(spark, sf).withColumn("row_id", F.expr("app_id * 2"))
    copies = app.filter("app_id % 50 = 0").withColumn("row_id", F.expr("row_id + 1")).withColumn(TARGET, F.expr("1 - target"))
    return app.unionByName(copies).drop(KEY)


@query("c1_target_alignment", sql("SELECT row_id, target FROM firsts WHERE k = 1", dup=_DUPES, firsts=FIRST_ROWS))
def c1(spark, sf):
    return DataCleaner(drop_col_duplicates=False).fit_transform(duplicated(spark, sf), TARGET, "row_id").select("row_id", TARGET)


@query("c2_column_concat", sql(f"SELECT app_id, {r('ln(1 + greatest(credit, -1 + 1e-9))', 'credit', 4)}, status, target FROM app"), digits=4)
def c2(spark, sf):
    app = applications(spark, sf).select(KEY, "credit", "status", TARGET)
    return FeatureTransformer({"credit": "log1p"}).fit_transform(app, TARGET, KEY)


@query("c3_mapping_lookup", sql(f"""SELECT app_id, {r('coalesce(f.share, 0)', 'occupation')}, {r('coalesce(g.share, -1)', 'cust')} FROM val
  LEFT JOIN (SELECT occupation AS k, count(*) / (SELECT count(*) FROM train)::DOUBLE AS share FROM train GROUP BY 1) f ON occupation = f.k
  LEFT JOIN (SELECT cust_id AS k, count(*)::DOUBLE AS share FROM train GROUP BY 1) g ON cust_id = g.k"""))
def c3(spark, sf):
    """One small map (a literal or a broadcast) and one with a key per customer, which grows with the data."""
    past, held = train(spark, sf), validation(spark, sf)
    rows = past.count()
    shares = value_counts(past, ["occupation"]).withColumn("result", F.col("n") / F.lit(rows))
    counts = value_counts(past, ["cust_id"]).withColumn("result", F.col("n").cast("double"))
    small = build_maps(shares.select("feature", "value", "result", "n"), ["occupation"])["occupation"]
    large = build_maps(counts.select("feature", "value", "result", "n"), ["cust_id"], limit=100)["cust_id"]
    joined, (a, b) = with_lookups(held, [("occupation", small, q("occupation")), ("cust_id", large, q("cust_id").cast("string"))])
    return joined.select(KEY, F.coalesce(a, F.lit(0.0)).alias("occupation"), F.coalesce(b, F.lit(-1.0)).alias("cust"))


@query("c4_semi_anti_membership", sql(_RARE, freq=_FREQ))
def c4(spark, sf):
    stage = RareCategoryTransformer().fit(train(spark, sf).select(KEY, "occupation"), key=KEY)
    return stage.transform(validation(spark, sf).select(KEY, "occupation"))


@query("c5_row_mask", sql("""SELECT app_id FROM app WHERE (income IS NULL OR income BETWEEN (SELECT quantile_cont(income, 0.01) FROM app)
  AND (SELECT quantile_cont(income, 0.99) FROM app))"""))
def c5(spark, sf):
    app = applications(spark, sf)
    lo, hi = quantiles(app, {"income": dbl("income")}, [0.01, 0.99])["income"]
    return app.filter(S.within(q("income"), lo, hi)).select(KEY)


# ---- H: scalar functions ----------------------------------------------------------------------

def _scalar(name: str, make, expression: str):
    @query(name, sql(f"SELECT app_id, {r(f'CASE WHEN income IS NOT NULL THEN {expression} END', 'y')} FROM app"))
    def run(spark, sf):
        return applications(spark, sf).select(KEY, make(q("income")).alias("y"))


_scalar("h1_log_clamp", S.log_floor, "ln(greatest(income, 1e-9))")
_scalar("h2_log1p_clamp", S.log1p_floor, "ln(1 + greatest(income, -1 + 1e-9))")
_scalar("h3_sqrt_clamp", S.sqrt_floor, "sqrt(greatest(income, 0))")
_scalar("h4_box_cox", lambda c: S.box_cox(c, 0.3), "(pow(greatest(income, 1e-9), 0.3) - 1) / 0.3")
_scalar("h4_box_cox_zero", lambda c: S.box_cox(c, 0.0), "ln(greatest(income, 1e-9))")
_scalar("h5_yeo_johnson", lambda c: S.yeo_johnson(c, 0.4),
        "CASE WHEN income >= 0 THEN (pow(income + 1, 0.4) - 1) / 0.4 ELSE -(pow(1 - income, 1.6) - 1) / 1.6 END")
_scalar("h5_yeo_johnson_two", lambda c: S.yeo_johnson(c, 2.0),
        "CASE WHEN income >= 0 THEN (pow(income + 1, 2) - 1) / 2 ELSE -ln(1 - income) END")
_scalar("h9_arithmetic", lambda c: F.exp(-F.abs(F.coalesce(c, F.lit(0.0))) / 10000.0) + F.when(c.isNull(), None).otherwise(0.0),
        "exp(-abs(income) / 10000)")


@query("h6_datetime_coercion", "SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate END AS opened FROM orders")
def h6(spark, sf):
    text = table(spark, sf, "orders").select("o_orderkey", F.expr(
        "CASE WHEN o_orderkey % 13 = 0 THEN 'bad' ELSE CAST(o_orderdate AS STRING) END AS opened"))
    return DataCleaner(drop_row_duplicates=False, datetime_cols=["opened"]).fit_transform(text, key="o_orderkey").select(
        "o_orderkey", F.col("opened").cast("timestamp_ntz").alias("opened"))


@query("h7_type_casts", sql("SELECT app_id, CAST(age_days AS BIGINT) AS whole, CAST(cust_id AS BIGINT) AS back, "
                            "CASE WHEN app_id % 13 = 0 THEN 'x' ELSE CAST(cust_id AS VARCHAR) END AS kept FROM app"))
def h7(spark, sf):
    """Fitted on numbers, applied to text: castable text becomes a number, the column with a bad value stays text."""
    app = applications(spark, sf)
    known = app.select(KEY, q("age_days").alias("whole"), q("cust_id").alias("back"), q("cust_id").alias("kept"))
    stage = DataCleaner(drop_row_duplicates=False, drop_col_duplicates=False)
    stage.fit(known, key=KEY)
    text = app.select(KEY, q("age_days").alias("whole"), q("cust_id").cast("string").alias("back"),
                      F.expr("CASE WHEN app_id % 13 = 0 THEN 'x' ELSE CAST(cust_id AS STRING) END AS kept"))
    return stage.transform(text)


@query("h9_safe_correlation", sql(f"SELECT {r('corr(credit, age_days)', 'corr')}, NULL::DOUBLE AS flat FROM app"))
def h9(spark, sf):
    """A column without variance gives null instead of an arithmetic error."""
    return applications(spark, sf).agg(safe_corr(q("credit"), q("age_days")).alias("corr"),
                                       safe_corr(q("credit"), q("flag_const")).alias("flat"))

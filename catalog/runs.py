"""A4, A5, A8, J: validation, configured runs, jobs and their sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import CAT, KEY, NUM, TARGET, applications, query, r, run_folder, sql, stack, train, validation
from catalog.profiling import _ALL, _LEAK, _MISSING, _TARGET
from catalog.stages import _LIMITS
from tabspark.functions.scalars import log1p_floor
from tabspark.functions.types import dbl, q
from tabspark.operators.aggregate import small_frame
from tabspark.operators.profiling import DataProfiler
from tabspark.operators.stages import Stage
from tabspark.plans.jobs import run_spec, split_flag, stratified_split
from tabspark.plans.preprocessing import PreprocessingPipeline
from tabspark.plans.presets import MODEL_SPECS, neural_network
from tabspark.plans.validate import LeakageValidator, SchemaValidator, leakage_report, schema_report
from tabspark.sources.writers import write_frame, write_profile

def _order():
    return F.expr("(app_id * 7919) % 1000003")


@query("j11_stratified_split", sql("SELECT app_id, target, is_validation FROM split"))
def j11(spark, sf):
    return split_flag(applications(spark, sf), TARGET, KEY, order=_order()).select(KEY, TARGET, "is_validation")


# ---- validation -------------------------------------------------------------------------------

@query("j2_schema_validate", sql("""SELECT * FROM (VALUES ('valid', '', 'false'), ('target_check', '', 'Passed'), ('missing_columns', 'income', ''),
  ('extra_columns', 'surplus', ''), ('type_mismatches', 'credit', 'double->string')) t("check", subject, detail)
  UNION ALL SELECT 'key_violations', '', count(*) || ' rows repeat a key of ''app_id''' FROM app WHERE app_id % 50 = 0"""))
def j2(spark, sf):
    """A frame with a missing, an extra, a retyped column and repeated keys against the learned schema."""
    app = applications(spark, sf)
    check = SchemaValidator(TARGET, KEY).fit(app)
    bad = app.unionAll(app.filter("app_id % 50 = 0")).drop("income").withColumn("surplus", F.lit(1)).withColumn("credit", q("credit").cast("string"))
    return schema_report(app, *check.validate(bad, is_train=False))


@query("j2_schema_validate_train", sql("""SELECT * FROM (VALUES ('valid', '', 'false')) t("check", subject, detail)
  UNION ALL SELECT 'target_check', '', count(*) || ' rows have no target' FROM app WHERE app_id % 100 = 0"""))
def j2t(spark, sf):
    app = applications(spark, sf)
    check = SchemaValidator(TARGET, KEY).fit(app)
    holes = app.withColumn(TARGET, F.expr("CASE WHEN app_id % 100 <> 0 THEN target END"))
    return schema_report(app, *check.validate(holes, is_train=True))


@query("j3_leakage_validate", sql(f"""SELECT 'near_constant' AS "check", feature, NULL::DOUBLE AS value FROM allc GROUP BY feature HAVING count(DISTINCT v) <= 1
  UNION ALL SELECT 'id_like', feature, NULL FROM allc WHERE feature NOT IN ('income', 'credit', 'annuity', 'car_age', 'proxy')
    GROUP BY feature HAVING count(DISTINCT v) > 0.95 * count(*)
  UNION ALL SELECT 'highly_correlated', feature, round(corr(v, y), 6) + 0.0 FROM numl WHERE v IS NOT NULL GROUP BY feature
    HAVING stddev_pop(v) > 0 AND abs(covar_pop(v, y) / (stddev_pop(v) * stddev_pop(y))) >= 0.95""",
                                  leaky="SELECT *, target * 2.0 + (app_id % 3) / 100.0 AS proxy FROM app",
                                  allc=stack("leaky", [KEY, *NUM, *CAT, "proxy"], "VARCHAR"), numl=stack("leaky", [KEY, *NUM, "proxy"], "DOUBLE")))
def j3(spark, sf):
    leaky = applications(spark, sf).withColumn("proxy", F.expr("target * 2.0D + (app_id % 3) / 100.0D"))
    return leakage_report(leaky, LeakageValidator(TARGET).analyze(leaky))


# ---- configured runs --------------------------------------------------------------------------

_FOLD = "(app_id div 5) % 5"
_ORDER_TEXT = "(app_id * 7919) % 1000003"
_NULLS = ["income", "annuity", "car_age", "segment"]


def config(model: str) -> dict:
    """The preset, with folds and order from arithmetic on the key so that SQL can repeat them."""
    spec = neural_network(("income", "credit", "annuity")) if model == "neural_network" else MODEL_SPECS[model]()
    for step in spec["pipeline"]["steps"]:
        if isinstance(step, dict) and step["component"] == "encoder" and model != "linear":
            step["params"].update(fold=_FOLD, order=_ORDER_TEXT)
    return spec


def plan_for(model: str) -> PreprocessingPipeline:
    return PreprocessingPipeline(config(model), target_column=TARGET, key_column=KEY)


def _prepared(source: str) -> str:
    """After cleaner, missing and rare_categories: stacked categoricals (feature, v, y, app_id)."""
    def level(c: str) -> str:
        return (f"SELECT '{c}' AS feature, CASE WHEN coalesce({c}, 'Unknown') IN (SELECT v FROM kept WHERE feature = '{c}') "
                f"THEN coalesce({c}, 'Unknown') ELSE 'OTHER' END AS v, target AS y, app_id FROM {source}")
    return " UNION ALL ".join(level(c) for c in CAT)


_KEPT = """SELECT feature, coalesce(v, 'Unknown') AS v FROM tcat GROUP BY ALL HAVING count(*) >= 0.01 * (SELECT count(*) FROM train)"""
_FILLS = {c: f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM train))" for c in NUM}
_FLAGS = ", ".join(f"CAST({c} IS NULL AS INT) AS {c}_isnull" for c in _NULLS)
_PARTS = dict(kept=_KEPT, ptrain=_prepared("train"), pval=_prepared("val"))


def _wide(source: str, encoded: dict[str, str], digits: int = 6) -> str:
    nums = ", ".join(r(_FILLS[c], c, digits) for c in NUM)
    cats = ", ".join(r(e, c, digits) for c, e in encoded.items())
    return f"SELECT s.app_id, {nums}, {cats}, {_FLAGS}, s.target FROM {source} s"


_OOF = dict(_PARTS,
            pr="SELECT f, (SELECT avg(target) FROM train WHERE (app_id // 5) % 5 <> f) AS prior FROM (SELECT unnest([0, 1, 2, 3, 4]) AS f)",
            folds="""SELECT feature, v, pr.f, (sum(y) + 10.0 * any_value(prior)) / (count(y) + 10.0) AS code
              FROM ptrain JOIN pr ON (app_id // 5) % 5 <> pr.f GROUP BY feature, v, pr.f""",
            enc="""SELECT p.app_id, p.feature, coalesce(folds.code, pr.prior) AS code FROM ptrain p JOIN pr ON pr.f = (p.app_id // 5) % 5
              LEFT JOIN folds ON folds.feature = p.feature AND folds.v = p.v AND folds.f = pr.f""",
            flat="SELECT app_id, " + ", ".join(f"max(code) FILTER (WHERE feature = '{c}') AS e_{c}" for c in CAT) + " FROM enc GROUP BY app_id")
_FIT_SQL = sql(_wide("train", {c: f"e_{c}" for c in CAT}) + " JOIN flat ON flat.app_id = s.app_id", **_OOF)


@query("j7_fit_transform", _FIT_SQL)
def j7(spark, sf):
    """The tree_based spec on training data: cleaned, filled, grouped, out-of-fold encoded."""
    plan = plan_for("tree_based")
    return plan.ordered(plan.fit_transform(train(spark, sf)))


_GLOBAL = dict(_PARTS, codes="SELECT feature, v, (sum(y) + 10.0 * (SELECT avg(target) FROM train)) / (count(y) + 10.0) AS code FROM ptrain GROUP BY feature, v",
               enc="SELECT p.app_id, p.feature, coalesce(codes.code, (SELECT avg(target) FROM train)) AS code FROM pval p "
                   "LEFT JOIN codes ON codes.feature = p.feature AND codes.v = p.v",
               flat=_OOF["flat"])


@query("j8_transform", sql(_wide("val", {c: f"e_{c}" for c in CAT}) + " JOIN flat ON flat.app_id = s.app_id", **_GLOBAL))
def j8(spark, sf):
    plan = plan_for("tree_based").fit(train(spark, sf))
    return plan.ordered(plan.transform(validation(spark, sf)))


def _clipped(c: str) -> str:
    return f"greatest(least({_FILLS[c]}, (SELECT hi FROM flim WHERE feature = '{c}')), (SELECT lo FROM flim WHERE feature = '{c}'))"


_FILLED_STACK = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({_FILLS[c]} AS DOUBLE) AS v FROM train" for c in NUM)
_LINEAR = dict(_PARTS, ftrain=_FILLED_STACK, flim=_LIMITS["iqr"].replace("tnum", "ftrain"),
               ctrain=" UNION ALL ".join(f"SELECT '{c}' AS feature, {_clipped(c)} AS v FROM train" for c in NUM),
               sc="SELECT feature, quantile_cont(v, 0.5) AS mid, quantile_cont(v, 0.75) - quantile_cont(v, 0.25) AS iqr, "
                  "count(*) FILTER (WHERE v NOT IN (0, 1)) AS odd FROM ctrain GROUP BY feature")


def _robust(c: str) -> str:
    s = f"(SELECT %s FROM sc WHERE feature = '{c}')"
    return (f"CASE WHEN {s % 'odd'} = 0 THEN {_clipped(c)} ELSE ({_clipped(c)} - {s % 'mid'}) / "
            f"(CASE WHEN {s % 'iqr'} = 0 THEN 1 ELSE {s % 'iqr'} END) END")


@query("j8_transform_linear", sql(f"SELECT app_id, {', '.join(r(_robust(c), c) for c in NUM)}, target FROM val", **_LINEAR))
def j8l(spark, sf):
    """The numeric features of the linear spec: filled, clipped to IQR limits, robust-scaled."""
    plan = plan_for("linear").fit(train(spark, sf))
    return plan.transform(validation(spark, sf)).select(KEY, *NUM, TARGET)


@query("j8_transform_neural_network")
def j8n(spark, sf):
    plan = plan_for("neural_network").fit(train(spark, sf))
    return plan.ordered(plan.transform(validation(spark, sf)))


def sections() -> dict:
    """The tree_based work in the older form with one section per stage."""
    body = {"schema_validation": True, "leakage_validation": True, "drop_duplicates": True, "type_standardization": True,
            "imputation": {"numerical": {"strategy": "median", "add_indicators": True}, "categorical": {"strategy": "constant", "fill_value": "Unknown"}},
            "rare_categories": {"threshold_pct": 0.01}, "encoding": {"strategy": "target", "target_cv_folds": 5, "target_smoothing": 10.0},
            "outliers": {"strategy": "none"}, "scaling": {"strategy": "none"}}
    return {"pipeline": body}


@query("j6_config_forms", sql(_wide("val", {c: f"e_{c}" for c in CAT}) + " JOIN flat ON flat.app_id = s.app_id", **_GLOBAL))
def j6(spark, sf):
    """Built from sections, it must give what the step list gives (j8_transform)."""
    plan = PreprocessingPipeline(sections(), target_column=TARGET, key_column=KEY).fit(train(spark, sf))
    return plan.ordered(plan.transform(validation(spark, sf)))


class LogAmounts(Stage):
    """A user stage: log1p of the columns it is given."""

    def __init__(self, columns):
        self.columns = columns

    def _learn(self, df):
        self.learned_ = {c: "log1p" for c in self.columns}

    def _apply(self, df):
        return self.replace(df, {c: log1p_floor(dbl(c)) for c in self.columns})

    def get_reports(self):
        return {"log_amounts": self.learned_}


@query("l1_user_component", sql(f"SELECT app_id, {r('ln(1 + greatest(credit, -1 + 1e-9))', 'credit')}, target FROM val"))
def l1(spark, sf):
    spec = {"pipeline": {"schema_validation": False, "leakage_validation": False, "steps": [{"component": "log_amounts", "params": {"columns": ["credit"]}}]}}
    plan = PreprocessingPipeline(spec, target_column=TARGET, key_column=KEY, component_registry={"log_amounts": LogAmounts})
    cols = [KEY, "credit", TARGET]
    return plan.fit(train(spark, sf).select(*cols)).transform(validation(spark, sf).select(*cols))


@query("l2_user_reports", sql("""SELECT 'credit' AS feature, 'log1p' AS value, count(*) AS rows FROM train"""))
def l2(spark, sf):
    spec = {"pipeline": {"schema_validation": False, "leakage_validation": False, "steps": [{"component": "log_amounts", "params": {"columns": ["credit"]}}]}}
    plan = PreprocessingPipeline(spec, target_column=TARGET, key_column=KEY, component_registry={"log_amounts": LogAmounts})
    plan.fit(train(spark, sf).select(KEY, "credit", TARGET))
    kept = plan.tracker.run["extra_reports"]["log_amounts"]
    return small_frame(spark, [(c, v, plan.tracker.run["input_shape"][0]) for c, v in kept.items()], "feature string, value string, rows bigint")


@query("j5_run_report", sql("""SELECT 0 AS step, 'cleaner' AS name, 12 AS input_columns, 12 AS output_columns, count(*) AS rows FROM train
  UNION ALL SELECT 1, 'missing', 12, 16, count(*) FROM train UNION ALL SELECT 2, 'rare_categories', 16, 16, count(*) FROM train
  UNION ALL SELECT 3, 'encoder', 16, 16, count(*) FROM train"""))
def j5(spark, sf):
    """The steps of a run with their column counts (their seconds are left out here)."""
    plan = plan_for("tree_based").fit(train(spark, sf))
    rows = [(i, s["step"], s["input_columns"], s["output_columns"], plan.tracker.run["output_shape"][0]) for i, s in enumerate(plan.tracker.run["steps"])]
    return small_frame(spark, rows, "step int, name string, input_columns int, output_columns int, rows bigint")


_LEVELS = "(SELECT count(*) FROM (SELECT DISTINCT feature, v FROM {0}))"


@query("j12_model_jobs", sql(f"""SELECT model, part, CASE WHEN model = 'linear' THEN {2 + len(NUM) + len(_NULLS)} + {_LEVELS.format('ptrain')}
    ELSE {2 + len(NUM) + len(CAT) + len(_NULLS)} END AS columns, rows FROM (SELECT unnest(['tree_based', 'linear', 'neural_network']) AS model)
  CROSS JOIN (SELECT 'train' AS part, count(*) AS rows FROM train UNION ALL SELECT 'val', count(*) FROM val)""",
                             split=("NOT is_validation", "is_validation"), source="split", **_PARTS))
def j12(spark, sf):
    """The three model-specific preparations over one stratified split: written, read back, counted."""
    past, held = stratified_split(applications(spark, sf), TARGET, KEY, order=_order())
    out = None
    for model in MODEL_SPECS:
        folder = run_folder(spark)
        run_spec(model, config(model), past, held, TARGET, KEY, folder, f"{folder}/reports", "parquet")
        for part in ("train", "val"):
            data = spark.read.parquet(f"{folder}/{model}_{part}")
            row = data.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(model).alias("model"), F.lit(part).alias("part"), F.lit(len(data.columns)).cast("bigint").alias("columns"), "rows")
            out = row if out is None else out.unionByName(row)
    return out


# ---- sinks ------------------------------------------------------------------------------------

@query("a4_processed_sinks", _FIT_SQL)
def a4(spark, sf):
    """The prepared training split through its CSV sink and back."""
    plan = plan_for("tree_based")
    out = plan.ordered(plan.fit_transform(train(spark, sf)))
    path = f"{run_folder(spark)}/tree_based_train"
    write_frame(out, path)
    return spark.read.option("header", True).schema(out.schema).csv(path)


@query("a5_profile_report_sink", sql(f"""SELECT 'missing_values' AS file, feature, missing_count AS count, missing_pct AS pct FROM miss
  UNION ALL SELECT 'cardinality', feature, count(DISTINCT v), NULL FROM cat GROUP BY feature
  UNION ALL SELECT 'duplicates', '', 0, NULL
  UNION ALL SELECT 'dataset_summary', '', count(*), NULL FROM app
  UNION ALL SELECT 'leakage', feature, 1, NULL FROM (SELECT DISTINCT feature FROM leak)
  UNION ALL SELECT 'target_analysis', '', positive_count, baseline_accuracy FROM tgt""",
                                     allc=_ALL, numl=stack("app", [KEY, *NUM], "DOUBLE"), miss=_MISSING, leak=_LEAK, tgt=_TARGET))
def a5(spark, sf):
    """Every profile file, read back."""
    folder = run_folder(spark)
    write_profile(DataProfiler(TARGET).run(applications(spark, sf)), folder)
    text = F.lit(None).cast("double").alias("pct")
    def body(name):
        return spark.read.schema("value string").text(f"{folder}/{name}.json")
    def field(f, kind):
        return F.get_json_object("value", f"$.{f}").cast(kind)
    missing = spark.read.option("header", True).schema("feature string, missing_count bigint, missing_pct double").csv(f"{folder}/missing_values.csv")
    card = spark.read.option("header", True).schema("feature string, unique_values bigint").csv(f"{folder}/cardinality.csv")
    return (missing.select(F.lit("missing_values").alias("file"), "feature", F.col("missing_count").alias("count"), F.col("missing_pct").alias("pct"))
            .unionByName(card.select(F.lit("cardinality").alias("file"), "feature", F.col("unique_values").alias("count"), text))
            .unionByName(body("duplicates").select(F.lit("duplicates").alias("file"), F.lit("").alias("feature"), field("duplicate_count", "bigint").alias("count"), text))
            .unionByName(body("dataset_summary").select(F.lit("dataset_summary").alias("file"), F.lit("").alias("feature"), field("rows", "bigint").alias("count"), text))
            .unionByName(body("leakage").select(F.lit("leakage").alias("file"), F.explode(F.from_json(F.get_json_object("value", "$.potential_leakage_columns"), "array<string>")).alias("feature"),
                                                F.lit(1).cast("bigint").alias("count"), text))
            .unionByName(body("target_analysis").select(F.lit("target_analysis").alias("file"), F.lit("").alias("feature"), field("positive_count", "bigint").alias("count"),
                                                        field("baseline_accuracy", "double").alias("pct"))))


@query("a8_run_report_sink", sql("""SELECT file, '2.0' AS version FROM (SELECT unnest(['encoding_report', 'feature_metadata', 'missing_value_report',
  'outlier_report', 'preprocessing_report', 'scaling_report', 'transformation_report']) AS file)"""))
def a8(spark, sf):
    """The seven report files of a run, each with its version."""
    folder = run_folder(spark)
    PreprocessingPipeline(config("linear"), folder, TARGET, key_column=KEY).fit(train(spark, sf))
    files = spark.read.schema("value string").text(f"{folder}/*.json").select("value", "_metadata.file_path")
    return files.select(F.regexp_extract("file_path", r"/([a-z_]+)\.json/", 1).alias("file"), F.get_json_object("value", "$.version").alias("version"))


@query("a8_run_report_long")
def a8l(spark, sf):
    """Every leaf of every report as (report, feature, key, value)."""
    return plan_for("linear").fit(train(spark, sf)).tracker.long(spark)

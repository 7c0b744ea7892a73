"""D10-D39: exploration of the applications view."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import CAT, KEY, NUM, TARGET, applications, query, r, sql, stack
from tabspark.operators import eda as E
from tabspark.operators.mutual_info import categorical_information, numeric_information

BINS = 32

_CLASSES = f"""SELECT target AS target_value, count(*) AS n, {r('100.0 * count(*) / (SELECT count(*) FROM app)', 'pct')},
  row_number() OVER (ORDER BY count(*) DESC, target) = 1 AS is_majority,
  {r('100.0 * max(count(*)) OVER () / (SELECT count(*) FROM app)', 'baseline_accuracy')},
  0.0::DOUBLE AS precision, 0.0::DOUBLE AS recall, 0.0::DOUBLE AS f1 FROM app WHERE target IS NOT NULL GROUP BY target"""


@query("d10_target_eda", sql(_CLASSES))
def d10(spark, sf):
    return E.target_eda(applications(spark, sf), TARGET)


_UNI = f"""SELECT feature, count(v) AS n, {r('avg(v)', 'mean', 4)}, {r('quantile_cont(v, 0.5)', 'median', 4)},
  {r('stddev_samp(v)', 'std', 4)}, {r('min(v)', 'min', 4)}, {r('max(v)', 'max', 4)},
  {r('CASE WHEN min(v) = max(v) THEN 0 ELSE skewness(v) END', 'skew', 4)},
  {r('CASE WHEN min(v) = max(v) THEN 0 ELSE kurtosis(v) END', 'kurtosis', 4)} FROM num GROUP BY feature"""


@query("d11_numeric_univariate", sql(_UNI), digits=4)
def d11(spark, sf):
    return E.numeric_univariate(applications(spark, sf), NUM)


_COUNTS = "SELECT feature, v AS value, count(*) AS n, count(y) AS ny, avg(y) AS rate, count(*) FILTER (WHERE y = 0) AS n0, " \
          "count(*) FILTER (WHERE y = 1) AS n1 FROM cat WHERE v IS NOT NULL GROUP BY feature, v"
_TOP = "SELECT *, row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) AS position FROM counts"
_PCT = r("100.0 * n / (SELECT count(*) FROM app)", "pct")


@query("d12_categorical_univariate", sql("""SELECT feature, count(*) AS cardinality, arg_min(value, position) AS top_value,
  max(n) AS top_n, count(*) FILTER (WHERE 100.0 * n / (SELECT count(*) FROM app) < 1.0) AS rare_count
  FROM top GROUP BY feature""", counts=_COUNTS, top=_TOP))
def d12(spark, sf):
    return E.categorical_univariate(applications(spark, sf), CAT)


@query("d12_top_categories", sql(f"SELECT feature, value, n, {_PCT}, CAST(position AS INT) AS position FROM top WHERE position <= 10",
                                 counts=_COUNTS, top=_TOP))
def d12_top(spark, sf):
    return E.top_categories(applications(spark, sf), CAT)


@query("d12_rare_categories", sql(f"SELECT feature, value, n, {_PCT} FROM counts WHERE 100.0 * n / (SELECT count(*) FROM app) < 1.0",
                                  counts=_COUNTS))
def d12_rare(spark, sf):
    return E.rare_categories(applications(spark, sf), CAT)


_BIV = """SELECT feature, avg(v) FILTER (WHERE y = 1) - avg(v) FILTER (WHERE y = 0) AS md,
  quantile_cont(v, 0.5) FILTER (WHERE y = 1) - quantile_cont(v, 0.5) FILTER (WHERE y = 0) AS qd,
  sqrt(((count(v) FILTER (WHERE y = 1) - 1) * var_samp(v) FILTER (WHERE y = 1)
      + (count(v) FILTER (WHERE y = 0) - 1) * var_samp(v) FILTER (WHERE y = 0)) / (count(v) - 2)) AS sp
  FROM num WHERE v IS NOT NULL AND y IS NOT NULL GROUP BY feature"""
_COHEN = "CASE WHEN sp = 0 THEN 0 ELSE md / sp END"


@query("d13_numeric_bivariate", sql(f"SELECT feature, {r('md', 'mean_diff', 4)}, {r('qd', 'median_diff', 4)}, "
                                    f"{r(_COHEN, 'cohen_d', 4)} FROM biv", biv=_BIV), digits=4)
def d13(spark, sf):
    return E.numeric_bivariate(applications(spark, sf), TARGET, NUM)


@query("d14_target_rates", sql(f"SELECT feature, value, n, {r('rate', 'target_rate')} FROM counts", counts=_COUNTS))
def d14(spark, sf):
    return E.target_rates(applications(spark, sf), TARGET, CAT)


_CODED = "SELECT *, row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS code FROM counts"
_CHI = """SELECT feature, (sum(code * n0) - sum(n0) / sum(n) * sum(code * n)) ^ 2 / nullif(sum(n0) / sum(n) * sum(code * n), 0)
  + (sum(code * n1) - sum(n1) / sum(n) * sum(code * n)) ^ 2 / nullif(sum(n1) / sum(n) * sum(code * n), 0) AS chi
  FROM coded GROUP BY feature"""


@query("d15_label_chi2", sql(f"SELECT feature, {r('chi', 'chi2_score')} FROM chi2", counts=_COUNTS, coded=_CODED, chi2=_CHI))
def d15(spark, sf):
    return E.label_chi2(applications(spark, sf), TARGET, CAT)


@query("d15_contingency_chi2", sql(f"""SELECT feature, {r('sum((o - e) ^ 2 / e)', 'chi2')} FROM (
  SELECT c.feature, c.n * t.cy / t.nn AS e, c.o FROM
   (SELECT feature, n, unnest([n0, n1]) AS o, unnest([0, 1]) AS y FROM counts) c
   JOIN (SELECT feature, unnest([sum(n0), sum(n1)]) AS cy, unnest([0, 1]) AS y, sum(n) AS nn FROM counts GROUP BY feature) t
   ON c.feature = t.feature AND c.y = t.y) GROUP BY feature""", counts=_COUNTS))
def d15b(spark, sf):
    return E.contingency_chi2(applications(spark, sf), TARGET, CAT)


def information(cells: str) -> str:
    """(feature, mi, n) from a relation with (feature, v, y), by the textbook sum over cells."""
    return f"""SELECT feature, greatest(sum(c / t * ln(c * t / (a * b))), 0) AS mi, any_value(t) AS t FROM (
      SELECT feature, c, sum(c) OVER (PARTITION BY feature, v) AS a, sum(c) OVER (PARTITION BY feature, y) AS b,
             sum(c) OVER (PARTITION BY feature) AS t
      FROM (SELECT feature, v, y, CAST(count(*) AS DOUBLE) AS c FROM {cells} WHERE v IS NOT NULL AND y IS NOT NULL GROUP BY ALL)) GROUP BY feature"""


_PROBS = "[" + ", ".join(str(k / BINS) for k in range(1, BINS)) + "]"


def binned(source: str) -> str:
    """(feature, v, y) with v replaced by the number of distinct quantile edges below it."""
    return f"""SELECT s.feature, (SELECT count(*) FROM (SELECT feature, unnest(list_distinct(quantile_cont(v, {_PROBS}))) AS edge
        FROM {source} WHERE v IS NOT NULL AND y IS NOT NULL GROUP BY feature) e WHERE e.feature = s.feature AND e.edge < s.v) AS v, s.y
      FROM {source} s WHERE s.v IS NOT NULL AND s.y IS NOT NULL"""


_MI_OUT = f"SELECT feature, {r('mi', 'mutual_info')}, CAST(t AS BIGINT) AS rows FROM mi"


@query("d16a_mutual_info_discrete", sql(_MI_OUT, mi=information("cat")))
def d16a(spark, sf):
    return categorical_information(applications(spark, sf), CAT, TARGET)


@query("d16b_mutual_info_numeric", sql(_MI_OUT, bins=binned("num"), mi=information("bins")))
def d16b(spark, sf):
    return numeric_information(applications(spark, sf), NUM, TARGET)


@query("d17_feature_insights", sql(f"SELECT feature, mean, skew, kurtosis FROM uni", uni=_UNI), digits=4)
def d17(spark, sf):
    return E.feature_insights(applications(spark, sf), NUM)


_IMPORTANCE = dict(numk=stack("app", [KEY, *NUM], "DOUBLE"),
                   med="SELECT feature, quantile_cont(v, 0.5) AS m FROM numk GROUP BY feature",
                   filled="SELECT s.feature, coalesce(s.v, med.m) AS v, s.y FROM numk s JOIN med ON s.feature = med.feature",
                   bins=binned("filled"), mi1=information("bins"),
                   levels="SELECT feature, coalesce(v, 'nan') AS v, y FROM cat", mi2=information("levels"),
                   ranking="SELECT feature, round(mi, 6) + 0.0 AS mutual_info FROM (SELECT * FROM mi1 UNION ALL SELECT * FROM mi2)")


@query("d18_mi_importance", sql("SELECT feature, mutual_info FROM ranking", **_IMPORTANCE))
def d18(spark, sf):
    return E.importance(applications(spark, sf), TARGET)


_REL_NUM = f"""SELECT b.feature, 'numeric' AS type, {r('md', 'mean_diff', 4)}, {r(_COHEN, 'cohen_d', 4)}, {r('mi', 'mutual_info', 4)}
  FROM biv b JOIN mi ON b.feature = mi.feature"""
_REL_CAT = f"""SELECT c.feature, 'categorical' AS type, {r('chi', 'chi2_score', 4)}, {r('mi', 'mutual_info', 4)}
  FROM chi2 c JOIN mi2 ON c.feature = mi2.feature"""
_REL = dict(biv=_BIV, bins=binned("num"), mi=information("bins"), counts=_COUNTS, coded=_CODED, chi2=_CHI, mi2=information("cat"))


@query("d20_target_relationships_numeric", sql(_REL_NUM, **_REL), digits=4)
def d20(spark, sf):
    return E.target_relationships(applications(spark, sf), TARGET, NUM, []).drop("chi2_score")


@query("d21_target_relationships_categorical", sql(_REL_CAT, **_REL), digits=4)
def d21(spark, sf):
    return E.target_relationships(applications(spark, sf), TARGET, [], CAT).select("feature", "type", "chi2_score", "mutual_info")


# ---- correlation ------------------------------------------------------------------------------

def _pairs(columns: list[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]


def pearson_sql(columns: list[str], source: str = "app", digits: int = 6) -> str:
    """Pairwise-complete correlations; null where a side has no variance."""
    def one(a: str, b: str) -> str:
        x = f"CASE WHEN {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
        y = f"CASE WHEN {a} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
        corr = f"CASE WHEN stddev_pop({x}) > 0 AND stddev_pop({y}) > 0 THEN corr({x}, {y}) END"
        return f"SELECT '{a}' AS feature_i, '{b}' AS feature_j, {r(corr, 'corr', digits)} FROM {source}"
    return " UNION ALL ".join(one(a, b) for a, b in _pairs(columns))


@query("d30_corr_pearson", sql(pearson_sql(NUM)))
def d30(spark, sf):
    return E.pearson(applications(spark, sf), NUM)


_WIDE = [KEY, *NUM, "m2", "m3", "m5", "m7", "sq"]
_WIDE_SQL = "SELECT *, app_id % 2 AS m2, app_id % 3 AS m3, cust_id % 5 AS m5, cust_id % 7 AS m7, income * income / 1000.0 AS sq FROM app"


@query("d30_corr_pearson_wide", sql(pearson_sql(_WIDE, "wide"), wide=_WIDE_SQL))
def d30w(spark, sf):
    """More columns than the native limit: the block-moment path."""
    app = applications(spark, sf).select("*", *[F.expr(e) for e in (
        "app_id % 2 AS m2", "app_id % 3 AS m3", "cust_id % 5 AS m5", "cust_id % 7 AS m7", "income * income / 1000.0D AS sq")])
    return E.pearson(app, _WIDE)


_SP = ["income", "credit", "annuity", "age_days", "cust_id"]


def _spearman_sql(columns: list[str]) -> str:
    def one(a: str, b: str) -> str:
        ranks = ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r{i}" for i, c in enumerate((a, b)))
        return (f"SELECT '{a}' AS feature_i, '{b}' AS feature_j, {r('corr(r0, r1)', 'corr')} FROM "
                f"(SELECT {ranks} FROM app WHERE {a} IS NOT NULL AND {b} IS NOT NULL)")
    return " UNION ALL ".join(one(a, b) for a, b in _pairs(columns))


@query("d31_corr_spearman", sql(_spearman_sql(_SP)))
def d31(spark, sf):
    return E.spearman(applications(spark, sf), _SP)


_V = ["credit", "annuity", "age_days"]
_VIF = dict(c="SELECT CAST(credit AS DOUBLE) a, CAST(annuity AS DOUBLE) b, CAST(age_days AS DOUBLE) d FROM app "
              "WHERE credit IS NOT NULL AND annuity IS NOT NULL AND age_days IS NOT NULL",
            k="SELECT corr(a, b) AS x, corr(a, d) AS y, corr(b, d) AS z FROM c",
            det="SELECT *, 1 + 2 * x * y * z - x * x - y * y - z * z AS t FROM k")


@query("d32_vif", sql(f"SELECT 'credit' AS feature, {r('(1 - z * z) / t', 'vif')} FROM det UNION ALL "
                      f"SELECT 'annuity', {r('(1 - y * y) / t', 'vif')} FROM det UNION ALL "
                      f"SELECT 'age_days', {r('(1 - x * x) / t', 'vif')} FROM det", **_VIF))
def d32(spark, sf):
    return E.vif(applications(spark, sf), _V)


# ---- outliers and missingness -----------------------------------------------------------------

_LIM = """SELECT feature, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3, avg(v) AS m, stddev_samp(v) AS s
  FROM num GROUP BY feature"""
_IQR = "(v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1))"
_Z = "(s > 0 AND abs((v - m) / s) > 3)"


@query("d33_outlier_profile", sql(f"SELECT feature, count(*) FILTER (WHERE {_IQR}) AS iqr_outliers, count(*) FILTER (WHERE {_Z}) "
                                  "AS z_outliers FROM num JOIN lim USING (feature) GROUP BY feature", lim=_LIM))
def d33(spark, sf):
    return E.outlier_profile(applications(spark, sf), NUM)


@query("d34_outlier_rows", sql(f"SELECT feature, app_id, {r('v', 'value')} FROM num JOIN lim USING (feature) WHERE {_IQR} OR {_Z}", lim=_LIM))
def d34(spark, sf):
    return E.outlier_rows(applications(spark, sf), KEY, NUM)


_NULLS = ["income", "annuity", "car_age", "segment"]
_FLAGS = "SELECT " + ", ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS {c}" for c in _NULLS) + " FROM app"


@query("d35_missing_corr", sql(pearson_sql(_NULLS, "flags"), flags=_FLAGS))
def d35(spark, sf):
    return E.missing_correlations(applications(spark, sf))


@query("d36_missing_vs_target", sql(f"""SELECT feature, {r('avg(y) FILTER (WHERE v IS NULL)', 'target_mean_missing')},
  {r('avg(y) FILTER (WHERE v IS NOT NULL)', 'target_mean_present')},
  {r('avg(y) FILTER (WHERE v IS NULL) - avg(y) FILTER (WHERE v IS NOT NULL)', 'diff')} FROM allc
  GROUP BY feature HAVING count(v) BETWEEN 1 AND count(*) - 1""", allc=stack("app", [KEY, *NUM, *CAT], "VARCHAR")))
def d36(spark, sf):
    return E.missing_vs_target(applications(spark, sf), TARGET)


# ---- PCA, heat map, whole run -----------------------------------------------------------------

_PC = ["income", "credit", "annuity", "age_days", "cust_id"]


@query("d37_pca")
def d37(spark, sf):
    app = applications(spark, sf)
    return E.PCAModel(2).fit(app, _PC).transform(app, [KEY])


# Two columns have a closed form: with correlation c, the variances are 1 + |c| and 1 - |c|.
_P2 = """SELECT corr(a, b) AS c, count(*) AS n FROM (SELECT CAST(credit AS DOUBLE) AS a, coalesce(annuity,
  (SELECT quantile_cont(annuity, 0.5) FROM app)) AS b FROM app)"""


@query("d37_pca_variance", sql(f"""SELECT 'pc1' AS component, {r('(1 + abs(c)) * n / (n - 1)', 'explained_variance')},
  {r('(1 + abs(c)) / 2', 'explained_variance_ratio')} FROM p UNION ALL
  SELECT 'pc2', {r('(1 - abs(c)) * n / (n - 1)', 'explained_variance')}, {r('(1 - abs(c)) / 2', 'explained_variance_ratio')} FROM p""", p=_P2))
def d37v(spark, sf):
    model = E.PCAModel(2).fit(applications(spark, sf), ["credit", "annuity"])
    return model.loadings(spark).select("component", "explained_variance", "explained_variance_ratio").distinct()


_TOPN = 5
_HEAT = dict(pairs=pearson_sql(NUM), sides="SELECT feature_i AS f, corr FROM pairs UNION ALL SELECT feature_j, corr FROM pairs "
             "UNION ALL SELECT unnest([" + ", ".join(f"'{c}'" for c in NUM) + "]), 1.0",
             best=f"SELECT f FROM sides GROUP BY f ORDER BY avg(abs(corr)) DESC, f LIMIT {_TOPN}")
HEATMAP_SQL = sql("SELECT * FROM pairs WHERE feature_i IN (FROM best) AND feature_j IN (FROM best)", **_HEAT)


@query("d38_heatmap_top", HEATMAP_SQL)
def d38(spark, sf):
    return E.heatmap(applications(spark, sf), NUM, _TOPN)


def _run_long(results: dict):
    """(section, rows): one line per section of an exploration."""
    out = None
    for name, frame in results.items():
        part = frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("section"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


_SECTIONS = ("target", "box", "categories", "numeric_bivariate", "target_rates", "correlation", "importance", "projection",
             "summary", "target_relationships", "feature_insights")


@query("d39_eda_run", sql(f"""SELECT 'target' AS section, count(DISTINCT target) AS rows FROM app
  UNION ALL SELECT s, {len(NUM) + 1} FROM (SELECT unnest(['box', 'numeric_bivariate', 'feature_insights']) AS s)
  UNION ALL SELECT 'categories', count(*) FROM top WHERE position <= 20
  UNION ALL SELECT 'target_rates', count(*) FROM counts
  UNION ALL SELECT 'correlation', {(len(NUM) + 2) * (len(NUM) + 1) // 2}
  UNION ALL SELECT 'importance', {len(NUM) + 1 + len(CAT)}
  UNION ALL SELECT 'projection', count(*) FROM app WHERE income IS NOT NULL AND annuity IS NOT NULL AND car_age IS NOT NULL
  UNION ALL SELECT 'summary', 1 + count(DISTINCT target) + {len(NUM) + 1 + len(CAT)} FROM app
  UNION ALL SELECT 'target_relationships', {len(NUM) + 1 + len(CAT)}""", counts=_COUNTS, top=_TOP))
def d39(spark, sf):
    return _run_long(E.EDAOrchestrator(TARGET).run(applications(spark, sf), sections=_SECTIONS))


# ---- deliverables -----------------------------------------------------------------------------

_REL_BOTH = f"""SELECT feature, type, mean_diff, cohen_d, mutual_info, NULL::DOUBLE AS chi2_score FROM ({_REL_NUM})
  UNION ALL SELECT feature, type, NULL, NULL, mutual_info, chi2_score FROM ({_REL_CAT})"""


@query("a6_eda_deliverables", sql(_REL_BOTH, **_REL), digits=4)
def a6(spark, sf):
    return E.target_relationships(applications(spark, sf), TARGET, NUM, CAT)


@query("a7_eda_summary", sql(f"""SELECT 'target' AS section, 'baseline_accuracy' AS key, round(max(baseline_accuracy), 2) AS value FROM cls
  UNION ALL SELECT 'counts', CAST(target_value AS VARCHAR), n FROM cls
  UNION ALL SELECT 'mutual_info', feature, mutual_info FROM ranking""", cls=_CLASSES, **_IMPORTANCE))
def a7(spark, sf):
    app = applications(spark, sf)
    return E.summary_report(app, TARGET, E.importance(app, TARGET))

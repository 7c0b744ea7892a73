"""D50-D59: the data behind each figure."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import CAT, COLUMNS, KEY, NUM, TARGET, applications, query, r, sql, stack
from catalog.edges import density_sql
from catalog.exploration import _CLASSES, _COUNTS, _IMPORTANCE, _IQR, _LIM, _TOP, _Z, HEATMAP_SQL
from tabspark.operators import plotdata as D
from tabspark.operators.eda import heatmap, importance

_BOXED = ["income", "credit", "annuity", "age_days"]


@query("d50_plot_missing_top", sql(f"SELECT feature, {r('100.0 * count(*) FILTER (WHERE v IS NULL) / count(*)', 'missing_pct')} FROM allc "
                                   "GROUP BY feature ORDER BY count(*) FILTER (WHERE v IS NULL) DESC, feature LIMIT 5",
                                   allc=stack("app", COLUMNS, "VARCHAR")))
def d50(spark, sf):
    return D.missing_top(applications(spark, sf), 5)


@query("d51_plot_target_distribution", sql("SELECT target_value, n, round(pct, 1) AS pct_label FROM cls", cls=_CLASSES))
def d51(spark, sf):
    return D.target_distribution(applications(spark, sf), TARGET)


_B = 40
_RANGE = "SELECT feature, min(v) AS lo, (max(v) - min(v)) / %d AS w FROM num GROUP BY feature HAVING max(v) > min(v)" % _B


@query("d52_plot_histogram", sql(f"""SELECT feature, bin, {r('lo + bin * w', 'low')}, {r('lo + (bin + 1) * w', 'high')}, n FROM (
  SELECT s.feature, CAST(least(floor((v - lo) / w), {_B - 1}) AS BIGINT) AS bin, any_value(lo) AS lo, any_value(w) AS w, count(*) AS n
  FROM num s JOIN rng ON s.feature = rng.feature WHERE v IS NOT NULL AND s.feature IN ('income', 'credit', 'annuity', 'age_days')
  GROUP BY 1, 2)""", rng=_RANGE))
def d52(spark, sf):
    return D.histogram(applications(spark, sf), _BOXED, _B)


def _box(by: str, group: str, digits: int = 4) -> str:
    return f"""SELECT s.feature{by}, {r('any_value(q1)', 'q1', digits)}, {r('any_value(q2)', 'median', digits)}, {r('any_value(q3)', 'q3', digits)},
  {r('min(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))', 'whisker_low', digits)},
  {r('max(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))', 'whisker_high', digits)},
  count(*) FILTER (WHERE v NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS fliers
  FROM num s JOIN quart USING (feature{group}) WHERE s.feature IN ('income', 'credit', 'annuity', 'age_days') GROUP BY ALL"""


_QUART = "SELECT feature, %s quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3 FROM num GROUP BY ALL"


@query("d52_plot_box", sql(_box("", ""), quart=_QUART % ""), digits=4)
def d52b(spark, sf):
    return D.box_stats(applications(spark, sf), _BOXED)


_BOXES = "SELECT feature, v, y FROM num WHERE feature IN ('income', 'credit', 'annuity', 'age_days')"


@query("d52_plot_kde", sql(density_sql("boxes"), boxes=_BOXES), digits=3)
def d52k(spark, sf):
    return D.kde(applications(spark, sf), _BOXED).withColumn("density", F.col("density") * 1e9)


@query("d53_plot_category_counts", sql("SELECT feature, value, n, CAST(position AS INT) AS position FROM top WHERE position <= 20",
                                       counts=_COUNTS, top=_TOP))
def d53(spark, sf):
    return D.category_counts(applications(spark, sf), CAT)


@query("d54_plot_numeric_vs_target", sql(_box(", CAST(y AS VARCHAR) AS target_value", ", y"), quart=_QUART % "y,"), digits=4)
def d54(spark, sf):
    return D.box_stats(applications(spark, sf), _BOXED, TARGET)


@query("d54_plot_kde_by_target", sql(density_sql("boxes", ", y"), boxes=_BOXES), digits=3)
def d54k(spark, sf):
    return D.kde(applications(spark, sf), _BOXED, TARGET).withColumn("density", F.col("density") * 1e9)


@query("d55_plot_category_vs_target", sql(f"""SELECT feature, value, n, n0 AS n_negative, n1 AS n_positive, {r('rate', 'target_rate')},
  {r('(SELECT avg(target) FROM app)', 'global_rate')} FROM top WHERE position <= 15""", counts=_COUNTS, top=_TOP))
def d55(spark, sf):
    return D.category_vs_target(applications(spark, sf), TARGET, CAT)


@query("d56_plot_corr_heatmap", HEATMAP_SQL)
def d56(spark, sf):
    return heatmap(applications(spark, sf), NUM, 5)


@query("d57_plot_importance", sql("SELECT feature, mutual_info FROM ranking ORDER BY mutual_info DESC, feature LIMIT 3", **_IMPORTANCE))
def d57(spark, sf):
    return importance(applications(spark, sf), TARGET, 3)


_PC = ["income", "credit", "annuity", "age_days"]


@query("d58_plot_projection", sql("""SELECT CAST(count(*) AS BIGINT) AS n, 0.0::DOUBLE AS mean1, 0.0::DOUBLE AS mean2, 0.0::DOUBLE AS cross, CAST(sum(target) AS BIGINT) AS positives, CAST(sum(app_id) AS HUGEINT)::DOUBLE AS keys
  FROM app WHERE income IS NOT NULL AND annuity IS NOT NULL"""), digits=4)
def d58(spark, sf):
    """What holds of any projection on principal axes: centred, uncorrelated, every complete row once."""
    points = D.projection_points(applications(spark, sf), TARGET, KEY, _PC)
    return points.agg(F.count(F.lit(1)).alias("n"), F.avg("pc1").alias("mean1"), F.avg("pc2").alias("mean2"), F.corr("pc1", "pc2").alias("cross"),
                      F.sum(TARGET).cast("bigint").alias("positives"), F.sum(KEY).cast("double").alias("keys"))


@query("d58_plot_projection_points")
def d58_points(spark, sf):
    return D.projection_points(applications(spark, sf), TARGET, KEY, _PC)


_SEEN = f"""SELECT app_id, v AS value, y AS target, {_IQR} OR {_Z} AS outlier FROM num JOIN lim USING (feature)
  WHERE feature = 'annuity' AND v IS NOT NULL"""


@query("d59_plot_outlier_points", sql(f"SELECT app_id, {r('value', 'value')}, target, outlier FROM seen", lim=_LIM, seen=_SEEN))
def d59(spark, sf):
    return D.outlier_points(applications(spark, sf), "annuity", KEY, TARGET)


@query("d59_plot_outlier_sample", sql(f"""SELECT app_id, {r('value', 'value')}, target, outlier FROM (
  SELECT * FROM seen WHERE outlier UNION ALL
  (SELECT * FROM seen WHERE NOT outlier ORDER BY (app_id * 7919) % 1000003, app_id LIMIT 2000))""", lim=_LIM, seen=_SEEN))
def d59_sample(spark, sf):
    return D.outlier_points(applications(spark, sf), "annuity", KEY, TARGET, 2000, order=F.expr("(app_id * 7919) % 1000003"))

"""Class statistics over a target with about 1,500 classes."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import APP, CAT, KEY, NUM, TARGET, applications, query, r, sql
from catalog.edges import _CUT
from catalog.exploration import _CLASSES, _IMPORTANCE, _MI_OUT, binned, information
from catalog.plots import _BOXED, _QUART, _box
from tabspark.functions.types import q
from tabspark.operators import eda as E
from tabspark.operators import plotdata as D
from tabspark.operators.mutual_info import categorical_information, numeric_information
from tabspark.plans.jobs import split_flag

_MANY = f"SELECT * EXCLUDE (target), app_id % 1511 AS target FROM ({APP})"
_CELLS = "SELECT feature, v, y, count(*) AS n, dense_rank() OVER (PARTITION BY feature ORDER BY v) - 1 AS code FROM cat WHERE v IS NOT NULL AND y IS NOT NULL GROUP BY feature, v, y"


def many(spark, sf):
    return applications(spark, sf).withColumn(TARGET, q(KEY) % 1511)


@query("d10_target_eda_many_classes", sql(_CLASSES, app=_MANY))
def d10(spark, sf):
    return E.target_eda(many(spark, sf), TARGET)


@query("d15_label_chi2_many_classes", sql(f"""SELECT feature, {r('sum((o - c / n * s) ^ 2 / nullif(c / n * s, 0))', 'chi2_score', 4)} FROM (
  SELECT feature, y, sum(code * n) AS o, sum(n) AS c, sum(sum(n)) OVER (PARTITION BY feature) AS n, sum(sum(code * n)) OVER (PARTITION BY feature) AS s
  FROM cells GROUP BY feature, y) GROUP BY feature""", app=_MANY, cells=_CELLS), digits=4)
def d15(spark, sf):
    return E.label_chi2(many(spark, sf), TARGET, CAT)


@query("d15_contingency_chi2_many_classes", sql(f"""SELECT feature, {r('sum((coalesce(n, 0) - e) ^ 2 / e)', 'chi2', 4)} FROM (
  SELECT feature, v, y, a * b / t AS e FROM (SELECT feature, v, sum(n) AS a FROM cells GROUP BY ALL) JOIN (SELECT feature, y, sum(n) AS b FROM cells GROUP BY ALL) USING (feature)
  JOIN (SELECT feature, sum(n) AS t FROM cells GROUP BY ALL) USING (feature)) LEFT JOIN cells USING (feature, v, y) GROUP BY feature""", app=_MANY, cells=_CELLS), digits=4)
def d15b(spark, sf):
    return E.contingency_chi2(many(spark, sf), TARGET, CAT)


@query("d16a_mutual_info_many_classes", sql(_MI_OUT, app=_MANY, mi=information("cat")))
def d16a(spark, sf):
    return categorical_information(many(spark, sf), CAT, TARGET)


@query("d16b_mutual_info_numeric_many_classes", sql(_MI_OUT, app=_MANY, bins=binned("num"), mi=information("bins")))
def d16b(spark, sf):
    return numeric_information(many(spark, sf), NUM, TARGET)


@query("d18_mi_importance_many_classes", sql("SELECT feature, mutual_info FROM ranking", app=_MANY, **_IMPORTANCE))
def d18(spark, sf):
    return E.importance(many(spark, sf), TARGET)


@query("d54_plot_numeric_vs_many_classes", sql(_box(", CAST(y AS VARCHAR) AS target_value", ", y", 7), app=_MANY, quart=_QUART % "y,"), digits=7)
def d54(spark, sf):
    return D.box_stats(many(spark, sf), _BOXED, TARGET)


@query("j11_split_many_classes", sql(_CUT, app=_MANY, src="SELECT app_id AS k, target AS y, (app_id * 7919) % 1009 AS o FROM app"))
def j11(spark, sf):
    rows = many(spark, sf).select(q(KEY).alias("k"), q(TARGET).alias("y"), ((q(KEY) * 7919) % 1009).alias("o"))
    return split_flag(rows, "y", "k", order=F.col("o")).select("k", "y", "is_validation")

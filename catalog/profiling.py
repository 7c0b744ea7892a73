"""D1-D8: profile of the applications view."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import CAT, COLUMNS, KEY, NUM, TARGET, applications, query, r, sql, stack
from tabspark.operators import profiling as P

_ALL = stack("app", COLUMNS, "VARCHAR", "app_id")
_MISSING = f"""SELECT feature, count(*) FILTER (WHERE v IS NULL) AS missing_count,
  {r('100.0 * count(*) FILTER (WHERE v IS NULL) / count(*)', 'missing_pct')},
  100.0 * count(*) FILTER (WHERE v IS NULL) / count(*) > 50 AS high_missing FROM allc GROUP BY feature"""


@query("d1_missing_profile", sql(_MISSING, allc=_ALL))
def d1(spark, sf):
    return P.missing_profile(applications(spark, sf))


_BYTES = " + ".join([f"octet_length(encode(coalesce({c}, '')))" for c in CAT]) + f" + 8 * {len(COLUMNS) - len(CAT)}"


@query("d2_dataset_stats", sql(f"SELECT count(*) AS rows, CAST({len(COLUMNS)} AS BIGINT) AS columns, "
                               f"{r(f'sum({_BYTES}) / 1048576.0', 'memory_mb')} FROM app"))
def d2(spark, sf):
    return P.dataset_stats(applications(spark, sf))


def _with_copies(spark, sf):
    app = applications(spark, sf)
    return app.unionAll(app.filter("app_id % 50 = 0")).drop(KEY)


_COPIES = "SELECT * EXCLUDE (app_id) FROM app UNION ALL SELECT * EXCLUDE (app_id) FROM app WHERE app_id % 50 = 0"


@query("d3_duplicate_rows", sql("SELECT CAST((SELECT count(*) FROM dup) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dup)) "
                                "AS BIGINT) AS duplicate_count", dup=_COPIES))
def d3(spark, sf):
    return P.duplicate_rows(_with_copies(spark, sf))


_CONST = f"""SELECT feature, status, {r('share', 'top_share')} FROM (
  SELECT feature, CASE WHEN k <= 1 THEN 'constant' WHEN 100.0 * top / t >= 99 THEN 'near_constant' END AS status,
         100.0 * top / t AS share
  FROM (SELECT feature, count(v) AS k, max(n) FILTER (WHERE v IS NOT NULL) AS top, sum(n) FILTER (WHERE v IS NOT NULL) AS t
        FROM (SELECT feature, v, count(*) AS n FROM allc GROUP BY feature, v) GROUP BY feature)) WHERE status IS NOT NULL"""


@query("d4_constant_features", sql(_CONST, allc=_ALL))
def d4(spark, sf):
    return P.constant_features(applications(spark, sf))


@query("d5_cardinality", sql("SELECT feature, count(DISTINCT v) AS unique_values FROM cat GROUP BY feature"))
def d5(spark, sf):
    return P.cardinality(applications(spark, sf))


@query("d5_cardinality_all", sql("SELECT feature, count(DISTINCT v) AS unique_values FROM allc GROUP BY feature", allc=_ALL))
def d5_all(spark, sf):
    return P.cardinality(applications(spark, sf), categorical_only=False)


# A proxy of the target is added so that the correlation rule has something to find.
_LEAKY = "SELECT *, target * 2.0 + (app_id % 3) / 100.0 AS proxy FROM app"
_LEAK = """SELECT feature, 'unique_ratio' AS reason FROM allc WHERE feature <> 'target'
  GROUP BY feature HAVING count(DISTINCT v) > 0.95 * count(*)
UNION ALL SELECT feature, 'target_correlation' FROM numl WHERE feature <> 'target' AND v IS NOT NULL
  GROUP BY feature HAVING stddev_pop(v) > 0 AND abs(covar_pop(v, y) / (stddev_pop(v) * stddev_pop(y))) > 0.95"""


@query("d6_leakage_profile", sql(_LEAK, leaky=_LEAKY, allc=stack("leaky", COLUMNS + ["proxy"], "VARCHAR"),
                                 numl=stack("leaky", [KEY, *NUM, "proxy"], "DOUBLE")))
def d6(spark, sf):
    leaky = applications(spark, sf).withColumn("proxy", F.expr("target * 2.0D + (app_id % 3) / 100.0D"))
    return P.leakage_profile(leaky, TARGET)


_TARGET = f"""SELECT count(*) FILTER (WHERE target = 1) AS positive_count, count(*) FILTER (WHERE target = 0) AS negative_count,
  {r('1.0 * count(*) FILTER (WHERE target = 0) / count(*) FILTER (WHERE target = 1)', 'imbalance_ratio')},
  {r('100.0 * greatest(count(*) FILTER (WHERE target = 1), count(*) FILTER (WHERE target = 0)) / count(*)', 'baseline_accuracy')}
  FROM app"""


@query("d7_target_profile", sql(_TARGET))
def d7(spark, sf):
    return P.target_profile(applications(spark, sf), TARGET)


_RUN = f"""SELECT section, feature, metric, round(CAST(value AS DOUBLE), 6) + 0.0 AS value FROM (
  SELECT 'dataset_stats' AS section, '' AS feature, unnest(['rows', 'columns', 'memory_mb']) AS metric,
         unnest([CAST(count(*) AS DOUBLE), {len(COLUMNS)}.0, sum({_BYTES}) / 1048576.0]) AS value FROM app
  UNION ALL SELECT 'missing_values', feature, unnest(['missing_count', 'missing_pct', 'high_missing']),
         unnest([CAST(missing_count AS DOUBLE), missing_pct, CAST(high_missing AS DOUBLE)]) FROM miss
  UNION ALL SELECT 'duplicates', '', 'duplicate_count', (SELECT count(*) FROM app) - (SELECT count(*) FROM (SELECT DISTINCT * FROM app))
  UNION ALL SELECT 'constants', feature, status, 1.0 FROM const
  UNION ALL SELECT 'cardinality', feature, 'unique_values', count(DISTINCT v) FROM cat GROUP BY feature
  UNION ALL SELECT DISTINCT 'leakage', feature, 'suspect', 1.0 FROM leak
  UNION ALL SELECT 'target', '', unnest(['positive_count', 'negative_count', 'imbalance_ratio', 'baseline_accuracy']),
         unnest([CAST(positive_count AS DOUBLE), CAST(negative_count AS DOUBLE), imbalance_ratio, baseline_accuracy]) FROM tgt)"""


@query("d8_profile_run", sql(_RUN, allc=_ALL, numl=stack("app", [KEY, *NUM], "DOUBLE"), miss=_MISSING, const=_CONST,
                             leak=_LEAK, tgt=_TARGET))
def d8(spark, sf):
    return P.DataProfiler(TARGET).long(P.DataProfiler(TARGET).run(applications(spark, sf)))

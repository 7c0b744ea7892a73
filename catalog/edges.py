"""Inputs that show what ordinary rows do not: text keys, integers beyond 2^53, signed zeros, NaN, far values, many levels."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.base import KEY, TARGET, applications, query, r, sql, train, validation
from tabspark.functions.lineage import written
from tabspark.functions.types import q
from tabspark.operators import eda as E, plotdata as D, profiling as P
from tabspark.operators.stages import EncodingTransformer
from tabspark.plans.jobs import split_flag

# ---- splits by keys of any type -----------------------------------------------------------------

_CUT = """SELECT k, y, row_number() OVER (PARTITION BY y ORDER BY o, k) <= floor(0.2 * count(*) OVER (PARTITION BY y) + 0.5) AS is_validation FROM src"""


@query("j11_split_text_keys", sql(_CUT, src="SELECT 'key-' || app_id AS k, target AS y, app_id % 7 AS o FROM app"))
def j11_text(spark, sf):
    app = applications(spark, sf).select(F.concat(F.lit("key-"), q(KEY).cast("string")).alias("k"), q(TARGET).alias("y"), (q(KEY) % 7).alias("o"))
    return split_flag(app, "y", "k", order=F.col("o")).select("k", "y", "is_validation")


@query("j11_split_wide_keys", sql(_CUT, src="SELECT 1152921504606846976 + app_id AS k, target AS y, 1152921504606846976 + (app_id * 7919) % 1009 AS o FROM app"))
def j11_wide(spark, sf):
    app = applications(spark, sf).select((F.lit(1 << 60) + q(KEY)).alias("k"), q(TARGET).alias("y"), (F.lit(1 << 60) + (q(KEY) * 7919) % 1009).alias("o"))
    return split_flag(app, "y", "k", order=F.col("o")).select("k", "y", "is_validation")


# ---- constants among wide integers --------------------------------------------------------------

@query("d4_constant_wide_integers", sql(f"""SELECT 'mostly' AS feature, 'near_constant' AS status,
  {r('100.0 * count(*) FILTER (WHERE app_id % 500 <> 0) / count(*)', 'top_share')} FROM app"""))
def d4_wide(spark, sf):
    """Distinct numbers near 2^60 are no constant; one of them in 99.8 percent of the rows is nearly one."""
    app = applications(spark, sf)
    wide = app.select((F.lit(1 << 60) + q(KEY)).alias("distinct"), F.when(q(KEY) % 500 == 0, F.lit(1 << 60) + q(KEY)).otherwise(F.lit((1 << 60) + 1)).alias("mostly"))
    return P.constant_features(wide)


# ---- signed zeros and NaN -----------------------------------------------------------------------

_SIGNED = """SELECT app_id, CASE app_id % 3 WHEN 0 THEN 0.0 WHEN 1 THEN -0.0 ELSE credit END AS a,
  CAST(cust_id AS DOUBLE) AS b FROM app"""


@query("d31_spearman_signed_zeros", sql(f"""SELECT 'a' AS feature_i, 'b' AS feature_j, {r('corr(ra, rb)', 'corr')} FROM (
  SELECT rank() OVER (ORDER BY a + 0.0) + (count(*) OVER (PARTITION BY a + 0.0) - 1) / 2.0 AS ra,
         rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb FROM signed)""", signed=_SIGNED))
def d31_signed(spark, sf):
    a = F.when(q(KEY) % 3 == 0, F.lit(0.0)).when(q(KEY) % 3 == 1, -F.lit(0.0)).otherwise(q("credit"))
    return E.spearman(applications(spark, sf).select(a.alias("a"), q("cust_id").cast("double").alias("b")), ["a", "b"])


def _holes(spark, sf, more: int):
    """credit with NaN and null holes, annuity, and `more` other columns."""
    a = F.when(q(KEY) % 4 == 0, F.lit(float("nan"))).when(q(KEY) % 4 == 1, F.lit(None)).otherwise(q("credit"))
    others = [((q(KEY) * (2 * i + 3)) % 97).cast("double").alias(f"m{i}") for i in range(more)]
    return applications(spark, sf).select(a.cast("double").alias("a"), q("annuity").alias("b"), *others)


_HOLES = "SELECT 'a' AS feature_i, 'b' AS feature_j, " + r("corr(CASE WHEN app_id % 4 >= 2 THEN credit END, annuity)", "corr") + " FROM app"


@query("d30_corr_nan", sql(_HOLES))
def d30_nan(spark, sf):
    return E.pearson(_holes(spark, sf, 0))


@query("d30_corr_nan_wide", sql(_HOLES))
def d30_nan_wide(spark, sf):
    return E.pearson(_holes(spark, sf, 14)).filter("feature_i = 'a' AND feature_j = 'b'")


@query("d1_missing_nan", sql(f"""SELECT 'a' AS feature, count(*) FILTER (WHERE app_id % 4 < 2) AS missing_count,
  {r('100.0 * count(*) FILTER (WHERE app_id % 4 < 2) / count(*)', 'missing_pct')}, count(*) FILTER (WHERE app_id % 4 < 2) * 2 > count(*) AS high_missing FROM app"""))
def d1_nan(spark, sf):
    return P.missing_profile(_holes(spark, sf, 0).select("a"))


# ---- densities ----------------------------------------------------------------------------------

def density_sql(source: str, by: str = "") -> str:
    """Densities times 10^9, of (feature, v) rows, by the same bins of an eighth of the bandwidth."""
    keys = f"feature{by}"
    return f"""SELECT {keys.replace('y', 'CAST(y AS VARCHAR) AS target_value') if by else keys}, {r('x', 'x', 3)},
  {r('1e9 * sum(m * exp(-0.5 * ((x - lo - (b + 0.5) * h / 8) / h) ** 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi()))', 'density', 3)} FROM (
  SELECT {keys}, lo - 3 * h + i * ((hi + 3 * h - (lo - 3 * h)) / 199) AS x, b, m, lo, h, n FROM (
    SELECT {keys}, floor((v - lo) / (h / 8)) AS b, any_value(lo) AS lo, any_value(hi) AS hi, any_value(h) AS h, any_value(n) AS n, count(*) AS m
    FROM {source} JOIN (SELECT {keys}, count(v) AS n, min(v) AS lo, max(v) AS hi, stddev_samp(v) * count(v) ** -0.2 AS h FROM {source} GROUP BY ALL) USING ({keys})
    WHERE v IS NOT NULL GROUP BY {keys}, b), range(200) t(i)) GROUP BY {keys}, x"""


@query("d52_plot_kde_far_value", sql(density_sql("far"), far="SELECT 'v' AS feature, CASE WHEN app_id = (SELECT min(app_id) FROM app) THEN 1e8 ELSE credit END AS v FROM app"), digits=3)
def d52_far(spark, sf):
    app = applications(spark, sf)
    least = app.agg(F.min(KEY)).first()[0]
    far = app.select(F.when(q(KEY) == least, F.lit(1e8)).otherwise(q("credit")).alias("v"))
    return D.kde(far, ["v"]).withColumn("density", F.col("density") * 1e9)


# ---- many levels --------------------------------------------------------------------------------

_WIDE = """SELECT app_id, CASE WHEN EXISTS (SELECT 1 FROM train t WHERE t.app_id % 4000 = val.app_id % 4000) THEN 'level ' || app_id % 4000 END AS level FROM val"""


def _levels(df):
    return df.select(KEY, F.concat(F.lit("level "), (q(KEY) % 4000).cast("string")).alias("level"))


@query("i16_encode_one_hot_wide", sql(_WIDE))
def i16_wide(spark, sf):
    """More levels than columns can hold: a map with the learned level, empty for others."""
    out = EncodingTransformer().fit(_levels(train(spark, sf)), key=KEY).transform(_levels(validation(spark, sf)))
    return out.select(KEY, F.get(F.map_keys("level"), F.lit(0)).alias("level")) if dict(out.dtypes).get("level", "").startswith("map") else _unfolded(out)


def _unfolded(out):
    """Small data has few enough levels for columns."""
    names = [c for c in out.columns if c != KEY]
    hot = F.array_compact(F.array(*[F.when(q(c) == 1, F.lit(c.removeprefix("level_"))) for c in names]))
    return out.select(KEY, F.get(hot, F.lit(0)).alias("level"))


@query("i16_one_hot_rows_unseen", sql("""SELECT app_id, 'occupation_' || coalesce(occupation, 'nan') AS "column", 1.0::DOUBLE AS value FROM val
  WHERE coalesce(occupation, 'nan') IN (SELECT coalesce(occupation, 'nan') FROM train)"""))
def i16_unseen(spark, sf):
    cols = [KEY, "occupation"]
    return EncodingTransformer().fit(train(spark, sf).select(cols), key=KEY).one_hot_rows(validation(spark, sf).select(cols), KEY)


# ---- all columns take part ----------------------------------------------------------------------

@query("d39_eda_every_column", sql("SELECT section, count(DISTINCT feature) AS features FROM (SELECT 'box' AS section, 'n' || i AS feature FROM range(40) t(i) "
                                   "UNION ALL SELECT 'categories', 's' || i FROM range(20) t(i) UNION ALL SELECT 'feature_insights', 'n' || i FROM range(40) t(i) "
                                   "UNION ALL SELECT 'importance', 'n' || i FROM range(40) t(i) UNION ALL SELECT 'importance', 's' || i FROM range(20) t(i)) GROUP BY section"))
def d39_every(spark, sf):
    """40 numeric and 20 text columns: every one is explored."""
    narrow = written(applications(spark, sf).select(q(TARGET), q("credit"), q(KEY)))  # every section reads it again; it is joined once
    wide = narrow.select(q(TARGET), *[(q("credit") * (i + 1) % 1013).alias(f"n{i}") for i in range(40)], *[(q(KEY) * (i + 2) % (i + 3)).cast("string").alias(f"s{i}") for i in range(20)])
    found = E.EDAOrchestrator(TARGET).run(wide, sections=("box", "categories", "feature_insights", "importance"))
    parts = [f.groupBy().agg(F.countDistinct("feature").alias("features")).select(F.lit(s).alias("section"), "features") for s, f in found.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

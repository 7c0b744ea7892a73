"""Registry, the `applications` view on both engines, and SQL building blocks."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabspark.sources.readers import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

KEY, TARGET = "app_id", "target"
NUM = ["cust_id", "income", "credit", "annuity", "car_age", "age_days", "flag_rare", "flag_const"]
CAT = ["status", "priority", "segment", "occupation"]
COLUMNS = [KEY, *NUM, *CAT, TARGET]

_VIEW = """
SELECT o_orderkey AS app_id, o_custkey AS cust_id,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE c_acctbal END AS income,
  o_totalprice AS credit,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice / (1 + o_custkey % 12) END AS annuity,
  CASE WHEN o_orderkey % 5 < 3 THEN NULL ELSE CAST(o_custkey % 40 AS DOUBLE) END AS car_age,
  CAST(<DAYDIFF> AS INT) AS age_days,
  CAST(CASE WHEN o_orderkey % 500 = 0 THEN 1 ELSE 0 END AS INT) AS flag_rare,
  1 AS flag_const,
  o_orderstatus AS status, o_orderpriority AS priority,
  CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE c_mktsegment END AS segment,
  CASE WHEN o_custkey % 200 = 1 THEN 'Astronaut' ELSE n_name END AS occupation,
  CAST(CASE WHEN (o_orderkey * 7919 + o_custkey * 104729) % 1000 < 60 + 40 * (o_custkey % 3) THEN 1 ELSE 0 END AS INT) AS target
FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey
"""
_SPARK_VIEW = _VIEW.replace("<DAYDIFF>", "datediff(DATE'2002-01-01', CAST(o_orderdate AS DATE))")
APP = (_VIEW.replace("<DAYDIFF>", "date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01')")
       .replace("{orders}", "orders").replace("{customer}", "customer").replace("{nation}", "nation"))


# One fifth of every class, by an arithmetic order of the key.
_SPLIT = """SELECT *, row_number() OVER (PARTITION BY target ORDER BY (app_id * 7919) % 1000003, app_id)
  <= CAST(floor(0.2 * count(*) OVER (PARTITION BY target) + 0.5) AS BIGINT) AS is_validation FROM app"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: table(spark, sf_dir, t) for t in ("orders", "customer", "nation")}
    return spark.sql(_SPARK_VIEW, **tables)


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    return applications(spark, sf_dir).filter("app_id % 5 <> 0")


def validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = applications(spark, sf_dir).filter("app_id % 5 = 0")
    return held.withColumn("occupation", F.expr("CASE WHEN app_id % 1000 = 0 THEN 'NEW' ELSE occupation END"))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of places (and no negative zero), as the checking SQL does."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, digits) + F.lit(0.0)
        elif isinstance(f.dataType, T.LongType):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(out)


def r(expr: str, alias: str, digits: int = 6) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits}) + 0.0 AS {alias}"


def stack(source: str, columns: list[str], cast: str, extra: str = "target AS y, app_id") -> str:
    """(feature, v, extras): the given columns of a relation as rows."""
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS {cast}) AS v, {extra} FROM {source}" for c in columns)


def sql(body: str, split: tuple[str, str] = ("app_id % 5 <> 0", "app_id % 5 = 0"), source: str = "app", **ctes: str) -> str:
    """DuckDB SQL over the view `app`, stacked `num` and `cat`, splits `train` and `val`, and more named parts."""
    held = [c if c != "occupation" else "CASE WHEN app_id % 1000 = 0 THEN 'NEW' ELSE occupation END AS occupation" for c in COLUMNS]
    parts = {"app": APP, "split": _SPLIT, "train": f"SELECT {', '.join(COLUMNS)} FROM {source} WHERE {split[0]}",
             "val": f"SELECT {', '.join(held)} FROM {source} WHERE {split[1]}",
             "num": stack("app", NUM, "DOUBLE"), "cat": stack("app", CAT, "VARCHAR"),
             "tnum": stack("train", NUM, "DOUBLE"), "tcat": stack("train", CAT, "VARCHAR")}
    parts.update(ctes)
    return "WITH " + ", ".join(f"{n} AS ({b})" for n, b in parts.items()) + " " + body


def query(name: str, oracle: str | None = None, digits: int = 6):
    """Register a query (spark, sf_dir) -> DataFrame and the SQL it is checked against."""
    def register(f):
        QUERIES[name] = lambda spark, sf_dir: rounded(f(spark, sf_dir), digits)
        if oracle is not None:
            ORACLES[name] = oracle
        return f
    return register


def run_folder(spark: SparkSession) -> str:
    """A new folder for one run, in the cluster's shared folder (a temporary one in local runs)."""
    from tabspark.functions.lineage import shared_folder

    return f"{shared_folder(spark).rstrip('/')}/run-{uuid.uuid4().hex}"

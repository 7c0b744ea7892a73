"""Sinks. Data is written by the executors as directories of part files; reports are small JSON or CSV sets."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabspark.operators.aggregate import small_frame


def write_frame(df: DataFrame, path: str, fmt: str = "csv") -> None:
    writer = df.write.mode("overwrite")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """A report (bounded by columns) as one CSV part, in its own order."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_json(spark: SparkSession, body: dict, path: str) -> None:
    """One JSON document through Spark's file systems (local, HDFS, object stores)."""
    small_frame(spark, [(json.dumps(body, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _single(df: DataFrame) -> dict:
    return df.first().asDict()


def write_profile(reports: dict[str, DataFrame], output_dir: str) -> None:
    """dataset_summary, missing_values, duplicates, cardinality; target_analysis and leakage when present."""
    spark = reports["dataset_stats"].sparkSession
    at = lambda name: os.path.join(output_dir, name)
    write_json(spark, _single(reports["dataset_stats"]), at("dataset_summary.json"))
    write_report_csv(missing_table(reports["missing_values"]), at("missing_values.csv"))
    write_json(spark, _single(reports["duplicates"]), at("duplicates.json"))
    write_report_csv(reports["cardinality"].orderBy(F.desc("unique_values"), "feature"), at("cardinality.csv"))
    if "target" in reports:
        write_json(spark, _single(reports["target"]), at("target_analysis.json"))
    if "leakage" in reports:
        names = sorted(r["feature"] for r in reports["leakage"].collect())
        write_json(spark, {"potential_leakage_columns": names}, at("leakage.json"))


def missing_table(missing: DataFrame) -> DataFrame:
    return missing.select("feature", "missing_count", "missing_pct").orderBy(F.desc("missing_pct"), "feature")


def write_exploration(results: dict[str, DataFrame], output_dir: str) -> None:
    """target_relationships, feature_insights and the summary."""
    for name in ("target_relationships", "feature_insights", "summary"):
        if name in results:
            write_report_csv(results[name], os.path.join(output_dir, f"{name}.csv"))


def write_run_reports(spark: SparkSession, reports: dict[str, dict], output_dir: str) -> None:
    for name, body in reports.items():
        write_json(spark, body, os.path.join(output_dir, f"{name}.json"))

"""Checks that run before a fit (schema, leakage) and before a transform (schema)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabspark.functions.types import families, family_of, is_integer, numeric_columns, q
from tabspark.operators.aggregate import collect_aggregates, small_frame
from tabspark.operators.columnwise import constant_columns, numeric_stats, value_profile
from tabspark.operators.profiling import id_like_columns

PASSED = "Passed"


class SchemaValidator:
    """Learns the ordered columns and types of a training frame, then checks other frames against them."""

    def __init__(self, target_column: str | None = None, key_column: str | None = None, allow_extra_columns: bool = True):
        self.target_column, self.key_column, self.allow_extra_columns = target_column, key_column, allow_extra_columns
        self.expected_schema_: dict[str, str] = {}
        self._family: dict[str, str] = {}
        self.rows_: int | None = None

    def fit(self, df: DataFrame) -> "SchemaValidator":
        self.expected_schema_ = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        self._family = families(df)
        return self

    @property
    def columns_(self) -> list[str]:
        return list(self.expected_schema_)

    def validate(self, df: DataFrame, is_train: bool = True) -> tuple[bool, dict]:
        names = df.columns
        report = {"missing_columns": [], "extra_columns": [], "type_mismatches": {}, "duplicate_columns":
                  sorted({c for c in names if names.count(c) > 1}), "key_violations": [], "target_check": PASSED}
        target = self.target_column
        absent = target is not None and is_train and target not in names
        if absent:
            report["target_check"] = f"no column named '{target}' to learn from"
        if not self.expected_schema_:
            return not report["duplicate_columns"] and not absent, report
        expected = [c for c in self.expected_schema_ if is_train or c != target]
        report["missing_columns"] = [c for c in expected if c not in names]
        report["extra_columns"] = [c for c in names if c not in self.expected_schema_ and c != target]
        for f in df.schema.fields:
            if f.name in self._family and (self._family[f.name] == "numeric") != (family_of(f.dataType) == "numeric"):
                report["type_mismatches"][f.name] = {"expected": self.expected_schema_[f.name], "actual": f.dataType.simpleString()}
        if not report["duplicate_columns"] and not df.isStreaming:
            self._check_values(df, is_train, report)
        valid = not (report["missing_columns"] or report["type_mismatches"] or report["duplicate_columns"] or report["key_violations"]
                     or (report["extra_columns"] and not self.allow_extra_columns)
                     or (is_train and report["target_check"] != PASSED))
        return valid, report

    def _check_values(self, df: DataFrame, is_train: bool, report: dict) -> None:
        if is_train and self.target_column in df.columns:
            got = collect_aggregates(df, {"n": F.count_if(q(self.target_column).isNull()), "rows": F.count(F.lit(1))})
            nulls, self.rows_ = got["n"], got["rows"]
            if nulls:
                report["target_check"] = f"{nulls} rows have no target"
        if self.key_column and self.key_column in df.columns:
            groups = df.groupBy(q(self.key_column)).agg(F.count(F.lit(1)).alias("n"))
            repeats = groups.agg(F.sum(F.col("n") - 1)).first()[0]
            if repeats:
                report["key_violations"].append(f"{repeats} rows repeat a key of '{self.key_column}'")


class LeakageValidator:
    """Near-constant, id-like and target-correlated columns of a training frame."""

    def __init__(self, target_column: str, cardinality_threshold: float = 0.95, correlation_threshold: float = 0.95):
        self.target_column = target_column
        self.cardinality_threshold, self.correlation_threshold = cardinality_threshold, correlation_threshold

    def analyze(self, df: DataFrame, exclude: list[str] | None = None, rows: int | None = None) -> dict:
        """Keeps the value profile and the numeric statistics it takes (`values_`, `stats_`), for stages that need them again."""
        self.values_, self.stats_ = {}, {}
        report = {"id_like_columns": [], "highly_correlated_columns": {}, "near_constant_columns": []}
        target, fams = self.target_column, families(df)
        if target not in df.columns:
            return report
        cols = [c for c in df.columns if c != target and c not in (exclude or []) and fams[c] != "other"]
        numeric = [c for c in numeric_columns(df) if c in cols] if fams[target] in ("numeric", "boolean") else []
        label = q(target).cast("double")
        rows = df.count() if rows is None else rows
        if rows == 0:
            return report
        values = value_profile(df, cols)
        stats = numeric_stats(df, {c: q(c) for c in numeric}, label) if numeric else {}
        corr = {c: s["corr"] for c, s in stats.items()}
        self.values_, self.stats_ = values, stats
        report["near_constant_columns"] = constant_columns(df, values)
        varied = [c for c in cols if c not in report["near_constant_columns"]]
        countable = [c for c in varied if is_integer(df.schema[c].dataType) or fams[c] == "categorical"]
        ids = id_like_columns(df, countable, self.cardinality_threshold, {c: values[c]["distinct"] for c in countable}, rows)
        report["id_like_columns"] = [c for c in varied if c in ids]
        report["highly_correlated_columns"] = {
            c: corr[c] for c in varied if corr.get(c) is not None and abs(corr[c]) >= self.correlation_threshold}
        return report


def schema_report(df: DataFrame, valid: bool, report: dict) -> DataFrame:
    """(check, subject, detail): the findings in long form, closed by the verdict."""
    rows = [("valid", "", str(valid).lower()), ("target_check", "", report["target_check"])]
    for check in ("missing_columns", "extra_columns", "duplicate_columns"):
        rows += [(check, c, "") for c in report[check]]
    rows += [("type_mismatches", c, f"{m['expected']}->{m['actual']}") for c, m in report["type_mismatches"].items()]
    rows += [("key_violations", "", v) for v in report["key_violations"]]
    return small_frame(df.sparkSession, rows, "check string, subject string, detail string")


def leakage_report(df: DataFrame, report: dict) -> DataFrame:
    """(check, feature, value)."""
    rows = [("near_constant", c, None) for c in report["near_constant_columns"]]
    rows += [("id_like", c, None) for c in report["id_like_columns"]]
    rows += [("highly_correlated", c, float(v)) for c, v in report["highly_correlated_columns"].items()]
    return small_frame(df.sparkSession, rows, "check string, feature string, value double")

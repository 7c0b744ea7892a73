"""What a run did: steps, shapes, and the reports of every stage, as JSON files or one long DataFrame."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession

from tabspark.operators.aggregate import small_frame

# Report name given by a stage -> report file.
REPORT_FILES = {
    "preprocessing": "preprocessing_report", "missing_values": "missing_value_report", "outliers": "outlier_report",
    "encodings": "encoding_report", "scaling": "scaling_report", "transformations": "transformation_report",
    "feature_metadata": "feature_metadata",
}


class MetadataTracker:
    def __init__(self, version: str = "1.0"):
        self.version = version
        self.run = {"version": version, "timestamp": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime()),
                    "steps": [], "input_shape": None, "output_shape": None}
        self.reports: dict[str, dict] = {name: {} for name in REPORT_FILES if name != "preprocessing"}

    def log_step(self, name: str, input_columns: int, output_columns: int, seconds: float) -> None:
        self.run["steps"].append({"step": name, "input_columns": input_columns, "output_columns": output_columns,
                                  "elapsed_seconds": seconds})

    def log_shapes(self, before: tuple, after: tuple) -> None:
        self.run["input_shape"], self.run["output_shape"] = list(before), list(after)

    def record(self, name: str, payload) -> None:
        if name in self.reports:
            self.reports[name] = payload
        else:
            self.run.setdefault("extra_reports", {})[name] = payload

    def all_reports(self) -> dict[str, dict]:
        """File stem -> content; every report carries the version."""
        named = {"preprocessing": self.run, **self.reports}
        return {REPORT_FILES[n]: r if isinstance(r, dict) and "version" in r else
                {"version": self.version, **(r if isinstance(r, dict) else {"data": r})} for n, r in named.items()}

    def long(self, spark: SparkSession) -> DataFrame:
        """(report, feature, key, value): one row per leaf, values as JSON text."""
        rows = []
        for report, body in self.all_reports().items():
            for feature, item in body.items():
                if isinstance(item, dict) and item:
                    rows += [(report, str(feature), str(k), json.dumps(v, default=str)) for k, v in item.items()]
                else:
                    rows.append((report, str(feature), "", json.dumps(item, default=str)))
        return small_frame(spark, rows, "report string, feature string, key string, value string")

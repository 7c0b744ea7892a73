"""Configuration-driven preparation: checks, then stages fitted one after the other."""

from __future__ import annotations

import time
from copy import deepcopy

from pyspark.sql import DataFrame

from tabspark.functions.lineage import written
from tabspark.functions.scalars import without_nan
from tabspark.functions.types import q
from tabspark.operators.stages import (DataCleaner, EncodingTransformer, FeatureScaler, FeatureTransformer,
                                       IterativeImputer, MissingValueTransformer, OutlierTransformer, RareCategoryTransformer, Stage)
from tabspark.plans.tracking import MetadataTracker
from tabspark.plans.validate import LeakageValidator, SchemaValidator
from tabspark.sources.writers import write_run_reports

COMPONENTS = {
    "cleaner": DataCleaner, "missing": MissingValueTransformer, "iterative_imputer": IterativeImputer, "rare_categories": RareCategoryTransformer,
    "encoder": EncodingTransformer, "outliers": OutlierTransformer, "transformations": FeatureTransformer,
    "scaler": FeatureScaler,
}
# Columns added by one stage beyond which its output is written before the next fit.
WIDE = 100
# Section names of the older configuration form.
ALIASES = {"imputation": "missing", "encoding": "encoder", "scaling": "scaler"}


def load_config(path: str) -> dict:
    import yaml

    with open(path) as f:
        return yaml.safe_load(f)


def _canonical(name: str) -> str:
    return ALIASES.get(name, name)


def _taken(section: dict, **defaults) -> dict:
    return {k: section.get(k, v) for k, v in defaults.items()}


def steps_from_sections(cfg: dict) -> list[dict]:
    """Steps of the older form, where each section of the configuration is one stage in a fixed order."""
    steps = []
    types, dedupe = cfg.get("type_standardization", True), cfg.get("drop_duplicates", True)
    if types or dedupe:
        steps.append(("cleaner", {"drop_row_duplicates": dedupe, "drop_col_duplicates": dedupe,
                                  "coerce_objects_to_category": types, "datetime_cols": cfg.get("datetime_cols", [])}))
    if "imputation" in cfg:
        s = cfg["imputation"]
        num, cat = s.get("numerical", {}), s.get("categorical", {})
        steps.append(("missing", {"num_strategy": num.get("strategy", "median"), "num_fill_value": num.get("fill_value"),
                                  "add_indicators": num.get("add_indicators", True),
                                  "cat_strategy": cat.get("strategy", "constant"), "cat_fill_value": cat.get("fill_value", "Unknown"),
                                  **_taken(s, column_strategies={}, knn_neighbors=5)}))
    if "rare_categories" in cfg:
        steps.append(("rare_categories", _taken(cfg["rare_categories"], threshold_pct=0.01, threshold_count=None, top_k=None,
                                                fill_value="OTHER", exclude_cols=[])))
    if "encoding" in cfg:
        s = cfg["encoding"]
        steps.append(("encoder", {"default_strategy": s.get("strategy", "one_hot"),
                                  **_taken(s, column_strategies={}, target_cv_folds=5, target_smoothing=10.0,
                                           catboost_prior=10.0, random_state=42)}))
    if cfg.get("outliers", {}).get("strategy", "none") != "none":
        steps.append(("outliers", _taken(cfg["outliers"], strategy="clip", method="iqr", threshold=1.5, lower_quantile=0.01,
                                         upper_quantile=0.99, contamination=0.05, random_state=42, columns=None)))
    if cfg.get("transformations"):
        steps.append(("transformations", {"transformations": cfg["transformations"]}))
    if cfg.get("scaling", {}).get("strategy", "none") != "none":
        s = cfg["scaling"]
        steps.append(("scaler", {"default_strategy": s.get("strategy", "standard"), **_taken(s, column_strategies={}, exclude_cols=[])}))
    return [{"component": c, "params": p} for c, p in steps]


def normalise_step(step) -> dict:
    if isinstance(step, str):
        step = {"component": step}
    if not isinstance(step, dict):
        raise TypeError("a step is a component name or a dictionary")
    component = step.get("component") or step.get("type") or step.get("name")
    if component is None:
        raise ValueError("a step dictionary must name its component")
    component = _canonical(component)
    return {"name": step.get("name", component), "component": component, "params": step.get("params") or {},
            "enabled": step.get("enabled", True)}


def _settings(value, **defaults) -> dict:
    """A bool or a dict of settings; a bool switches 'enabled' (and 'strict', where there is one)."""
    if isinstance(value, dict):
        return {k: value.get(k, v) for k, v in defaults.items()}
    return {**defaults, **{k: bool(value) for k in ("enabled", "strict") if k in defaults}}


class PreprocessingPipeline:
    """fit_transform on training data, transform on any split; the target and the key travel in the row.

    ``component_registry`` adds or replaces stage classes (anything with fit/transform/get_reports).
    With ``materialize``, the training frame is written to the shared folder after a stage that dropped rows,
    because every later fit would otherwise repeat that stage's shuffle, and after one that added many columns
    (a wide one-hot encoding), so that later fits read columns instead of evaluating hundreds of expressions.
    All other stages are projections and need none.
    Reports are written under ``reports_dir`` when it is given.
    """

    def __init__(self, config: dict, reports_dir: str | None = None, target_column: str = "TARGET",
                 component_registry: dict | None = None, key_column: str | None = None, materialize: bool = True):
        self.config, self.reports_dir, self.target_column = config, reports_dir, target_column
        self.registry = {**COMPONENTS, **(component_registry or {})}
        self.materialize = materialize
        cfg = config.get("pipeline", {})
        self.schema_settings = _settings(cfg.get("schema_validation", True), enabled=True, strict=True, key_column=None,
                                         allow_extra_columns=True)
        self.leakage_settings = _settings(cfg.get("leakage_validation", True), enabled=True, fail_on_detection=False,
                                          cardinality_threshold=0.95, correlation_threshold=0.95)
        self.key_column = key_column
        self.schema_validator = SchemaValidator(target_column, self.schema_settings["key_column"],
                                                self.schema_settings["allow_extra_columns"])
        self.leakage_validator = LeakageValidator(target_column, self.leakage_settings["cardinality_threshold"],
                                                  self.leakage_settings["correlation_threshold"])
        self.tracker = MetadataTracker(cfg.get("metadata", {}).get("version", "1.0"))
        self.steps_ = self._build(cfg)
        self.fitted_ = False

    def _build(self, cfg: dict) -> list[tuple[str, object]]:
        allowed = {_canonical(n) for n in cfg.get("available_components", self.registry)}
        steps = []
        for raw in cfg.get("steps") or steps_from_sections(cfg):
            step = normalise_step(raw)
            if not step["enabled"]:
                continue
            name = step["component"]
            if name not in allowed:
                raise ValueError(f"component '{name}' is not available; available: {sorted(allowed)}")
            if name not in self.registry:
                raise ValueError(f"unknown component: {name}")
            steps.append((step["name"], self.registry[name](**step["params"])))
        return steps

    def _features(self, df: DataFrame) -> list[str]:
        return [c for c in df.columns if c not in (self.target_column, self.key_column)]

    def fit(self, df: DataFrame) -> "PreprocessingPipeline":
        self.fit_transform(df)
        return self

    def fit_transform(self, df: DataFrame) -> DataFrame:
        """``df`` holds the features and, for supervised stages, the target (and the key)."""
        target = self.target_column if self.target_column in df.columns else None
        key = self.key_column if self.key_column in df.columns else None
        df = without_nan(df)
        run = self.tracker.run
        run["pipeline_steps"], run["config_snapshot"] = [n for n, _ in self.steps_], deepcopy(self.config)
        if self.schema_settings["enabled"]:
            self.schema_validator.fit(df)
            valid, report = self.schema_validator.validate(df, is_train=True)
            self.tracker.record("feature_metadata", {"expected_schema": self.schema_validator.expected_schema_,
                                                     "validation_report": report})
            self._on_schema(valid, report, "fit")
        if target is not None and self.leakage_settings["enabled"]:
            report = self.leakage_validator.analyze(df, [key] if key else None, self.schema_validator.rows_)
            run["leakage_analysis"] = report
            if self.leakage_settings["fail_on_detection"] and any(report.values()):
                raise ValueError(f"leakage validation failed: {report}")
        rows = self.schema_validator.rows_
        shape = (df.count() if rows is None else rows, len(self._features(df)))
        rows_changed, known, ranked, n = False, {}, {}, shape[0]
        seen = {}  # what the leakage check has measured, as long as the rows and values are the same
        if target is not None and self.leakage_settings["enabled"]:
            seen = {"values": self.leakage_validator.values_, "stats": self.leakage_validator.stats_}
        for name, stage in self.steps_:
            started, before = time.time(), len(self._features(df))
            if isinstance(stage, Stage):
                stage.facts, stage.ranked, stage.rows_known, stage.nan_free = known, ranked, n, True
                stage.seen = seen
                later = [s for _, s in self.steps_ if isinstance(s, Stage)]
                stage.asked = tuple(sorted({p for s in later for p in s.quantiles_wanted()}))
            if hasattr(stage, "fit_transform"):
                df = stage.fit_transform(df, target, key)
            else:
                stage.fit(df, target, key)
                df = stage.transform(df)
            known = stage.facts_out() if isinstance(stage, Stage) else {}
            ranked = stage.ranked_out() if isinstance(stage, Stage) else {}
            changed = getattr(stage, "changes_rows", False)
            seen = stage.seen_out() if isinstance(stage, Stage) and not changed else {}
            n = None if changed or not isinstance(stage, Stage) else n
            rows_changed = rows_changed or changed
            if self.materialize and stage is not self.steps_[-1][1] and (changed or len(df.columns) > before + WIDE):
                df = written(df)
            self.tracker.log_step(name, before, len(self._features(df)), time.time() - started)
            for report_name, payload in stage.get_reports().items():
                self.tracker.record(report_name, payload)
        self.fitted_ = True
        self.feature_names_out_ = self._features(df)
        self.tracker.log_shapes(shape, (df.count() if rows_changed else shape[0], len(self.feature_names_out_)))
        if self.reports_dir is not None:
            write_run_reports(df.sparkSession, self.tracker.all_reports(), self.reports_dir)
        return df

    def transform(self, df: DataFrame) -> DataFrame:
        """No row is dropped. Works on a streaming frame too: the schema check then reads metadata only."""
        if not self.fitted_:
            raise ValueError("the pipeline is not fitted yet; call fit or fit_transform first")
        if self.schema_settings["enabled"]:
            valid, report = self.schema_validator.validate(df, is_train=False)
            self._on_schema(valid, report, "transform")
        df = without_nan(df)
        for _, stage in self.steps_:
            df = stage.transform(df)
        return df

    def get_feature_names_out(self) -> list[str]:
        if not self.fitted_:
            raise ValueError("the pipeline is not fitted yet")
        return list(self.feature_names_out_)

    def _on_schema(self, valid: bool, report: dict, when: str) -> None:
        if not valid and self.schema_settings["strict"]:
            raise ValueError(f"schema validation failed during {when}: {report}")

    def ordered(self, df: DataFrame) -> DataFrame:
        """Key, features in fitted order, target."""
        ends = [c for c in (self.key_column,) if c in df.columns], [c for c in (self.target_column,) if c in df.columns]
        return df.select([q(c) for c in ends[0] + self.feature_names_out_ + ends[1]])

"""The three model-specific preparation specs, in the configuration format the runner reads."""

from __future__ import annotations

from copy import deepcopy

_CHECKS = {
    "schema_validation": {"enabled": True, "strict": True, "allow_extra_columns": True},
    "leakage_validation": {"enabled": True, "fail_on_detection": False},
    "metadata": {"version": "2.0"},
}
# Every spec cleans, fills and groups rare levels the same way (all stage defaults).
_COMMON = ["cleaner", "missing", "rare_categories"]


def _spec(*steps) -> dict:
    steps = _COMMON + list(steps)
    names = [s if isinstance(s, str) else s["component"] for s in steps]
    return {"pipeline": {**deepcopy(_CHECKS), "available_components": names, "steps": deepcopy(steps)}}


def _step(component: str, **params) -> dict:
    return {"component": component, "params": params}


_CLIP = _step("outliers", strategy="clip", method="iqr", threshold=1.5)


def tree_based() -> dict:
    return _spec(_step("encoder", default_strategy="target", target_cv_folds=5, target_smoothing=10.0))


def linear() -> dict:
    return _spec(_step("encoder", default_strategy="one_hot"), _CLIP, _step("scaler", default_strategy="robust"))


def neural_network(log1p_columns: tuple[str, ...] = ("AMT_INCOME_TOTAL", "AMT_CREDIT", "AMT_ANNUITY")) -> dict:
    return _spec(_step("encoder", default_strategy="catboost", target_cv_folds=5, target_smoothing=10.0, catboost_prior=10.0),
                 _CLIP, _step("transformations", transformations={c: "log1p" for c in log1p_columns}),
                 _step("scaler", default_strategy="quantile"))


MODEL_SPECS = {"tree_based": tree_based, "linear": linear, "neural_network": neural_network}

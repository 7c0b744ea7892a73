from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabspark.functions.scalars import box_cox, log1p_floor, log_floor, sqrt_floor, yeo_johnson
from tabspark.functions.types import dbl
from tabspark.operators.aggregate import collect_aggregates
from tabspark.operators.power import fit_lambdas
from tabspark.operators.stages.base import Stage

STATIC = {"log": log_floor, "log1p": log1p_floor, "sqrt": sqrt_floor}
LEARNED = {"box_cox": box_cox, "yeo_johnson": yeo_johnson}


class FeatureTransformer(Stage):
    """log, log1p, sqrt, box_cox, yeo_johnson per column; box_cox with a value <= 0 becomes yeo_johnson."""

    def __init__(self, transformations: dict[str, str]):
        self.transformations = transformations

    def _learn(self, df: DataFrame) -> None:
        wanted = {c: t for c, t in self.transformations.items() if c in df.columns}
        for t in wanted.values():
            if t not in STATIC and t not in LEARNED:
                raise ValueError(f"unknown transformation strategy: {t}")
        self.fitted_params_ = {}
        if not wanted:
            return
        got = collect_aggregates(df, {(c, s): f for c in wanted for s, f in
                                      (("n", F.count(dbl(c))), ("low", F.min(dbl(c))))})
        wanted = {c: t for c, t in wanted.items() if got[(c, "n")]}
        kinds = {c: "yeo_johnson" if t == "box_cox" and got[(c, "low")] <= 0 else t for c, t in wanted.items()}
        lambdas = fit_lambdas(df, {c: (k, dbl(c)) for c, k in kinds.items() if k in LEARNED})
        self.fitted_params_ = {c: {"type": k, **({"lambda": lambdas[c]} if c in lambdas else {})} for c, k in kinds.items()}

    def _apply(self, df: DataFrame) -> DataFrame:
        new = {}
        for c, p in self.fitted_params_.items():
            if c in df.columns:
                new[c] = STATIC[p["type"]](dbl(c), df.schema[c].nullable) if p["type"] in STATIC else LEARNED[p["type"]](dbl(c), p["lambda"])
        return self.replace(df, new)

    def facts_out(self) -> dict:
        return {c: f for c, f in self.facts.items() if c not in self.transformations}

    def ranked_out(self) -> dict:
        return {c: v for c, v in self.ranked.items() if c not in self.transformations}

    def get_reports(self) -> dict:
        return {"transformations": {c: {"operation": p["type"], "parameters": {k: v for k, v in p.items() if k == "lambda"}}
                                    for c, p in self.fitted_params_.items()}}

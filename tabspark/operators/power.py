"""Maximum-likelihood lambda of Box-Cox and Yeo-Johnson (kernel K9): a grid of variances per scan."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tabspark.functions.scalars import box_cox, yeo_johnson
from tabspark.operators.aggregate import collect_aggregates

START, STEP, POINTS, ROUNDS = -2.0, 0.1, 41, 4
WIDEST = 64.0


def fit_lambdas(df: DataFrame, columns: dict[str, tuple[str, Column]]) -> dict[str, float]:
    """name -> lambda for {name: (kind, expression)}, kind 'box_cox' or 'yeo_johnson'.

    Log-likelihood: (lambda-1)*sum(log-derivative) - n/2*log(var of the transformed values). Each scan
    evaluates every grid point of every column; the grid then narrows tenfold around the best point, or
    slides while the best point is on its edge. Box-Cox inputs are divided by their geometric mean, which
    leaves lambda unchanged and keeps the powers in range.
    """
    first = {}
    for name, (kind, c) in columns.items():
        x = c.cast("double")
        first[(name, "n")] = F.count(x)
        if kind == "box_cox":
            first[(name, "d")] = F.sum(F.ln(F.when(x > 0, x)))
        else:
            first[(name, "d")] = F.sum(F.signum(x) * F.log1p(F.abs(x)))
    base = collect_aggregates(df, first)
    state = {}
    for name, (kind, c) in columns.items():
        n, d = base[(name, "n")], base[(name, "d")]
        x = c.cast("double")
        if kind == "box_cox" and n:
            x, d = x / F.lit(math.exp(d / n)), 0.0
        state[name] = {"kind": kind, "x": x, "n": n, "d": d or 0.0, "lo": START, "step": STEP, "points": POINTS,
                       "left": ROUNDS, "best": 1.0, "done": not n}
    while any(not s["done"] for s in state.values()):
        exprs = {}
        for name, s in state.items():
            if s["done"]:
                continue
            f = box_cox if s["kind"] == "box_cox" else yeo_johnson
            for k in range(s["points"]):
                exprs[(name, k)] = F.var_pop(f(s["x"], s["lo"] + k * s["step"]))
        got = collect_aggregates(df, exprs)
        for name, s in state.items():
            if s["done"]:
                continue
            scores = []
            for k in range(s["points"]):
                v, lam = got[(name, k)], s["lo"] + k * s["step"]
                good = v is not None and v > 0 and math.isfinite(v)
                scores.append((lam - 1) * s["d"] - 0.5 * s["n"] * math.log(v) if good else -math.inf)
            k = max(range(len(scores)), key=scores.__getitem__)
            if scores[k] == -math.inf:
                s["done"] = True
                continue
            s["best"] = s["lo"] + k * s["step"]
            if k in (0, len(scores) - 1) and abs(s["best"]) < WIDEST:
                span = s["step"] * (s["points"] - 1)
                s["lo"] += -span + s["step"] if k == 0 else span - s["step"]
                continue
            s["left"] -= 1
            if s["left"] == 0:
                s["done"] = True
                continue
            s["lo"], s["step"], s["points"] = s["best"] - s["step"], s["step"] / 10.0, 21
    return {name: s["best"] for name, s in state.items()}

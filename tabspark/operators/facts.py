"""Closed forms for columns whose few values and their counts are already known.

Indicators and one-hot columns are made of counts that a fit has taken anyway. Their moments, quantiles and what clipping makes of
them follow from these counts, so no stage has to scan them again.
"""

from __future__ import annotations

import math

Fact = dict[float, int]  # value -> rows; the column has no nulls


def of_flag(rows: int, ones: int) -> Fact:
    return {v: n for v, n in ((0.0, rows - ones), (1.0, ones)) if n}


def stats(fact: Fact) -> dict:
    """What `numeric_stats` finds."""
    n = sum(fact.values())
    if not n:
        return {"n": 0, "lo": None, "hi": None, "mean": None, "std_pop": None, "std": None, "odd": 0}
    mean = math.fsum(v * k for v, k in fact.items()) / n
    spread = math.fsum(k * (v - mean) ** 2 for v, k in fact.items())
    return {"n": n, "lo": min(fact), "hi": max(fact), "mean": mean, "std_pop": math.sqrt(spread / n),
            "std": math.sqrt(spread / (n - 1)) if n > 1 else None, "odd": sum(k for v, k in fact.items() if v not in (0.0, 1.0))}


def _at(fact: Fact, rank: int) -> float:
    for v in sorted(fact):
        rank -= fact[v]
        if rank < 0:
            return v
    raise IndexError(rank)


def quantile(fact: Fact, p: float) -> float | None:
    n = sum(fact.values())
    if not n:
        return None
    h = (n - 1) * p
    lo = min(max(math.floor(h), 0), n - 1)
    a, b = _at(fact, lo), _at(fact, min(lo + 1, n - 1))
    return float(a + (b - a) * (h - lo))


def outside(fact: Fact, lo: float, hi: float) -> int:
    return sum(k for v, k in fact.items() if v < lo or v > hi)


def clipped(fact: Fact, lo: float, hi: float) -> Fact:
    out: Fact = {}
    for v, k in fact.items():
        v = min(max(v, lo), hi)
        out[v] = out.get(v, 0) + k
    return out


class Ranked:
    """Some order statistics of a column with nulls, and what filling and clipping make of them.

    Filling n values with k equal ones puts these between the smaller and the larger: the r-th of the filled column is the
    r-th value if that is below the fill, the (r - k)-th if that is above it, else the fill. Clipping keeps the order.
    """

    def __init__(self, n: int, k: int, fill: float, values: dict[int, float], stats_: dict, limits: tuple[tuple[float, float], ...] = ()):
        self.n, self.k, self.fill, self.values, self.stats, self.limits = n, k, fill, values, stats_, limits

    @staticmethod
    def ranks(n: int, k: int, probs) -> list[int]:
        """Ranks of the n values that quantiles of the filled column need."""
        out = set()
        for p in probs:
            lo = min(max(math.floor((n + k - 1) * p), 0), n + k - 1)
            for r in (lo, min(lo + 1, n + k - 1)):
                out |= {r, r - k}
        return sorted(r for r in out if 0 <= r < n)

    def clipped(self, lo: float, hi: float) -> "Ranked":
        return Ranked(self.n, self.k, self.fill, self.values, self.stats, (*self.limits, (lo, hi)))

    def _clip(self, v: float) -> float:
        for lo, hi in self.limits:
            v = min(max(v, lo), hi)
        return v

    def _at(self, r: int) -> float:
        if r < self.n and self.values[r] < self.fill:
            return self._clip(self.values[r])
        if r >= self.k and self.values[r - self.k] > self.fill:
            return self._clip(self.values[r - self.k])
        return self._clip(self.fill)

    def quantile(self, p: float) -> float:
        """KeyError if the ranks were not asked for."""
        h = (self.n + self.k - 1) * p
        lo = min(max(math.floor(h), 0), self.n + self.k - 1)
        a, b = self._at(lo), self._at(min(lo + 1, self.n + self.k - 1))
        return float(a + (b - a) * (h - lo))

    def has_odd(self) -> bool | None:
        """Whether the column has values other than 0 and 1; None where only a scan can tell."""
        flags = (0.0, 1.0)
        if self.stats["odd"] or (self.k and self.fill not in flags):
            return None if any(v in flags for limit in self.limits for v in limit) else True
        present = {self.stats["lo"], self.stats["hi"]} | ({self.fill} if self.k else set())
        return any(self._clip(v) not in flags for v in present)

"""Closed forms against numpy on the columns themselves."""

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tabspark.operators import facts

FEW = st.dictionaries(st.sampled_from([0.0, 1.0, 0.5, -2.0, 7.25]), st.integers(1, 9), min_size=1)


def column(fact):
    return np.array([v for v, n in fact.items() for _ in range(n)])


@given(FEW, st.floats(0, 1))
def test_few_values(fact, p):
    x, got = column(fact), facts.stats(fact)
    assert (got["n"], got["lo"], got["hi"], got["odd"]) == (len(x), x.min(), x.max(), int(((x != 0) & (x != 1)).sum()))
    assert got["mean"] == pytest.approx(x.mean()) and got["std_pop"] == pytest.approx(x.std(), abs=1e-12)
    assert got["std"] is None if len(x) == 1 else got["std"] == pytest.approx(x.std(ddof=1), abs=1e-12)
    assert facts.quantile(fact, p) == pytest.approx(np.quantile(x, p), abs=1e-9)
    assert facts.outside(fact, 0.25, 0.75) == ((x < 0.25) | (x > 0.75)).sum()
    assert sorted(column(facts.clipped(fact, -1.0, 0.75))) == sorted(np.clip(x, -1.0, 0.75))


def test_flags_and_nothing():
    assert facts.of_flag(5, 2) == {0.0: 3, 1.0: 2} and facts.of_flag(5, 0) == {0.0: 5} and facts.of_flag(0, 0) == {}
    assert facts.stats({})["n"] == 0 and facts.quantile({}, 0.5) is None


@settings(max_examples=300)
@given(st.lists(st.integers(-3, 4).map(float), min_size=1, max_size=30), st.integers(0, 12), st.integers(-4, 5).map(float),
       st.lists(st.tuples(st.integers(-3, 0).map(float), st.sampled_from([0.5, 1.0, 2.0, 3.0])), max_size=2), st.sampled_from([0.01, 0.25, 0.5, 0.75, 0.99]))
def test_filled_and_clipped(values, k, fill, limits, p):
    raw = np.sort(values)
    asked = facts.Ranked.ranks(len(raw), k, [p])
    known = facts.Ranked(len(raw), k, fill, {r: raw[r] for r in asked}, facts.stats(dict(zip(*(a.tolist() for a in np.unique(raw, return_counts=True))))))
    x = np.concatenate([raw, np.full(k, fill)])
    for lo, hi in limits:
        known, x = known.clipped(lo, hi), np.clip(x, lo, hi)
    lo = np.sort(x)[min(max(math.floor((len(x) - 1) * p), 0), len(x) - 1)]
    hi = np.sort(x)[min(math.floor((len(x) - 1) * p) + 1, len(x) - 1)]
    h = (len(x) - 1) * p
    assert known.quantile(p) == lo + (hi - lo) * (h - math.floor(h))
    odd = known.has_odd()
    assert odd is None or odd == bool(((x != 0) & (x != 1)).any())

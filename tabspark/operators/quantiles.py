"""Exact order statistics for many columns at once (kernel K2).

Small inputs (cells = rows x columns under a limit) go through one aggregate. Larger ones never sort
or shuffle the column: a small random sample proposes bucket bounds, one scan counts the rows of every
bucket exactly, and only buckets that hold a wanted rank are looked into again, first with finer
bounds and at the end value by value. The sample decides only where to look; the counts decide the
answer, so results are exact whatever the sample was.
"""

from __future__ import annotations

import math
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabspark.functions.types import number_sql
from tabspark.operators.aggregate import small_frame
from tabspark.operators.columnwise import STACK, in_parts, present_counts

ROWS_PER_COLUMN = 1_000_000     # direct path: values of one column that one task may sort ...
CELLS_IN_TOTAL = 24_000_000     # ... and of all columns together
ROWS_TO_RESOLVE = 4_000_000
RESOLVED_PART = 128             # or this part of all values, if that is more
BOUNDS = 512
MORE_BOUNDS = 16                # buckets of large inputs with many wanted ranks, in multiples of the bounds
SAMPLE_ROWS = 20_000
SAMPLED_PER_BOUND = 8           # or so many rows for each bucket, if that is more

Counted = dict[str, tuple[np.ndarray, np.ndarray]]  # name -> ascending cut points, rows up to each and beyond


def _present(columns: dict[str, Column]) -> list[Column]:
    """Each expression as double under a positional name; NaN counts as missing."""
    return [F.nanvl(c.cast("double"), F.lit(None).cast("double")).alias(f"x{i}") for i, c in enumerate(columns.values())]


def _stacked(data: DataFrame, live: list[int]) -> DataFrame:
    """(f, v): the non-null values of the positional columns as rows."""
    cells = ", ".join(f"struct({i} AS f, x{i} AS v)" for i in live)
    return data.select(F.expr(f"inline(array({cells}))")).filter("v IS NOT NULL")


def _numbers(values) -> str:
    return "array(" + ", ".join(number_sql(v) for v in values) + ")"


def order_statistics(df: DataFrame, columns: dict[str, Column], ranks, counts: dict[str, int] | None = None,
                     rows_limit: int = ROWS_PER_COLUMN, cells_limit: int = CELLS_IN_TOTAL,
                     resolve_limit: int = ROWS_TO_RESOLVE, bounds: int = BOUNDS,
                     sample_rows: int = SAMPLE_ROWS, counted: Counted | None = None) -> dict[str, tuple[int, dict[int, float]]]:
    """name -> (count of non-null values, {0-based rank: value}).

    ``ranks`` maps (name, count) to the wanted ranks of that column; ``counts``, and the rows between cut points
    of a large input (``counted``), save a scan each when already known.
    """
    if len(columns) > STACK:
        return in_parts(columns, lambda part: order_statistics(df, part, ranks, counts, rows_limit, cells_limit,
                                                               resolve_limit, bounds, sample_rows, counted))
    names = list(columns)
    data = df.select(*_present(columns))
    if counts is None:
        counts = present_counts(data, {n: F.col(f"x{i}") for i, n in enumerate(names)})
    wanted = {n: sorted({r for r in ranks(n, counts[n]) if 0 <= r < counts[n]}) for n in names}
    out: dict[str, tuple[int, dict[int, float]]] = {n: (int(counts[n]), {}) for n in names}
    live = [i for i, n in enumerate(names) if wanted[n]]
    if not live:
        return out
    sizes = [counts[names[i]] for i in live]
    if max(sizes) <= rows_limit and sum(sizes) <= cells_limit:
        _sort_directly(data, names, live, wanted, out)
    else:
        _select_by_buckets(data, names, live, wanted, counts, out, resolve_limit, bounds, sample_rows, counted)
    return out


def proposed_cuts(df: DataFrame, columns: dict[str, Column], rows: int, wanted: int, rows_limit: int = ROWS_PER_COLUMN,
                  cells_limit: int = CELLS_IN_TOTAL, resolve_limit: int = ROWS_TO_RESOLVE, bounds: int = BOUNDS,
                  sample_rows: int = SAMPLE_ROWS) -> dict[str, np.ndarray]:
    """name -> cut points to count by, for so many wanted ranks of every column; none where an input of so many rows is not large."""
    if rows <= rows_limit and rows * len(columns) <= cells_limit:
        return {}
    if len(columns) > STACK:
        return in_parts(columns, lambda part: proposed_cuts(df, part, rows, wanted, 0, cells_limit, resolve_limit, bounds, sample_rows))
    cuts = _first_cuts(df.select(*_present(columns)), list(range(len(columns))), rows, rows * len(columns), wanted, resolve_limit, bounds, sample_rows)
    return {c: cuts[i] for i, c in enumerate(columns)}


FEW_RANKS = 64


def _sort_directly(data, names, live, wanted, out):
    """Distinct values with counts (combined before the shuffle), a running total per column, the wanted ranks."""
    cells = _stacked(data, live).groupBy("f", "v").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("f").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("upto", F.sum("n").over(w)).select("f", "v", (F.col("upto") - F.col("n")).alias("lo"), F.col("upto").alias("hi"))
    if max(len(wanted[names[i]]) for i in live) <= FEW_RANKS:
        asks = ", ".join(f"{i}, array({', '.join(f'{r}L' for r in wanted[names[i]])})" for i in live)
        hits = cells.filter(F.expr(f"exists(element_at(map({asks}), f), r -> r >= lo AND r < hi)"))
    else:
        asked = {i: np.asarray(wanted[names[i]], dtype="int64") for i in live}

        def holds_a_rank(batches):
            for pdf in batches:
                for f, part in pdf.groupby("f"):
                    a = asked[int(f)]
                    yield part[np.searchsorted(a, part["lo"].to_numpy()) < np.searchsorted(a, part["hi"].to_numpy())]

        hits = cells.mapInPandas(holds_a_rank, cells.schema)
    for row in hits.collect():  # at most one row per wanted rank
        ranks, found = wanted[names[row["f"]]], out[names[row["f"]]][1]
        for at in range(bisect_left(ranks, row["lo"]), bisect_left(ranks, row["hi"])):
            found[ranks[at]] = row["v"]


def _cut_points(cells: DataFrame, keys: list[str], parts: int) -> dict[tuple, np.ndarray]:
    """Per group of sampled (keys..., v) rows, the values that cut them into so many parts."""
    def cut(key, pdf):
        v = np.quantile(np.sort(pdf["v"].to_numpy()), np.arange(1, parts) / parts, method="lower")
        return pd.DataFrame({**{k: [x] for k, x in zip(keys, key)}, "p": [v]})

    rows = cells.groupBy(*keys).applyInPandas(cut, ", ".join(f"{k} int" for k in keys) + ", p array<double>").collect()
    return {tuple(r[k] for k in keys): np.asarray(r["p"], dtype="float64") for r in rows}


def _sample_bounds(data: DataFrame, live: list[int], rows: int, inside: dict[int, list[tuple[float, float]]] | None,
                   inside_rows: int, bounds: int, sample_rows: int, seed: int) -> dict[int, np.ndarray]:
    """Per column, ascending cut points from a random sample (restricted to the span of ``inside``)."""
    fraction = min(1.0, sample_rows / max(1, inside_rows if inside else rows))
    sample = data if fraction >= 1.0 else data.sample(fraction=fraction, seed=seed)
    cells = _stacked(sample, live)
    if inside is not None:
        low, high = ([pick(x[k] for x in inside[i]) if i in inside else 0.0 for i in range(max(live) + 1)] for k, pick in ((0, min), (1, max)))
        cells = cells.filter(F.expr(f"v > get({_numbers(low)}, f) AND v <= get({_numbers(high)}, f)"))
    got = _cut_points(cells, ["f"], bounds)
    return {i: np.unique(got.get((i,), np.empty(0))) for i in live}


def _to_resolve(cells: int, resolve_limit: int) -> int:
    return max(resolve_limit, cells // RESOLVED_PART)


def _first_cuts(data, live, rows, cells, wanted, resolve_limit, bounds, sample_rows) -> dict[int, np.ndarray]:
    """As many as leave half the limit to look into, so that one count will do."""
    parts = min(max(bounds, 2 * cells * wanted // _to_resolve(cells, resolve_limit)), MORE_BOUNDS * bounds)
    return _sample_bounds(data, live, rows, None, 0, parts, max(sample_rows, SAMPLED_PER_BOUND * parts), 17)


def _bucket_counts(data: DataFrame, cuts: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Exact rows per bucket; bucket b holds cuts[b-1] < x <= cuts[b]. Every task counts in arrays, one row of them a column."""
    def count(batches):
        totals = {i: np.zeros(len(c) + 1, dtype="int64") for i, c in cuts.items()}
        for batch in batches:
            for at, (i, c) in enumerate(cuts.items()):
                x = np.sort(batch.column(at).drop_null().to_numpy(zero_copy_only=False))
                totals[i] += np.diff(np.searchsorted(x, c, side="right"), prepend=0, append=len(x))
        yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())], ["f", "n"])

    def add(key, pdf):
        return pd.DataFrame({"f": [key[0]], "n": [sum(np.frombuffer(n, dtype="int64") for n in pdf["n"]).tobytes()]})

    rows = (data.select(*[f"x{i}" for i in cuts]).mapInArrow(count, "f int, n binary")
            .groupBy("f").applyInPandas(add, "f int, n binary").collect())  # one array of at most `bounds` numbers a column and refinement
    out = {i: np.zeros(len(c) + 1, dtype="int64") for i, c in cuts.items()}
    for r in rows:
        out[r["f"]] = np.frombuffer(r["n"], dtype="int64")
    return out


def _select_by_buckets(data, names, live, wanted, counts, out, resolve_limit, bounds, sample_rows, counted):
    rows, cells = max(counts[names[i]] for i in live), sum(counts[names[i]] for i in live)
    if counted:
        cuts, hist = ({i: counted[names[i]][k] for i in live} for k in (0, 1))
    else:
        cuts, hist = _first_cuts(data, live, rows, cells, max(len(wanted[names[i]]) for i in live), resolve_limit, bounds, sample_rows), None
    resolve_limit = _to_resolve(cells, resolve_limit)
    previous = None
    for attempt in range(12):
        hist = hist or _bucket_counts(data, cuts)
        targets: dict[int, list[tuple[int, int, int]]] = {}  # column -> (bucket, rows before, rows inside)
        for i in live:
            ends = np.cumsum(hist[i])
            hit = sorted({int(np.searchsorted(ends, r, side="right")) for r in wanted[names[i]]})
            targets[i] = [(b, int(ends[b] - hist[i][b]), int(hist[i][b])) for b in hit]
        load = sum(n for t in targets.values() for _, _, n in t)
        # A bucket filled by one repeated value does not shrink; it costs nothing to resolve, so stop there.
        if load <= resolve_limit or (previous is not None and load > previous * 0.7):
            break
        previous = load
        inside = {}
        for i in live:
            edge = np.concatenate([[-np.inf], cuts[i], [np.inf]])
            inside[i] = [(float(edge[b]), float(edge[b + 1])) for b, _, _ in targets[i]]
        if max(len(v) for v in inside.values()) <= 8:
            fresh = _sample_intervals(data, live, inside, load, bounds, sample_rows, 18 + attempt)
        else:
            fresh = _sample_bounds(data, live, rows, inside, load, bounds * 4, sample_rows * 4, 18 + attempt)
        cuts, hist = {i: np.unique(np.concatenate([cuts[i], fresh[i]])) for i in live}, None
    _resolve(data, names, live, wanted, cuts, targets, out)


def _sample_intervals(data, live, inside, load, bounds, sample_rows, seed):
    """Fresh cut points inside each wanted bucket separately: few wanted ranks, deep refinement."""
    fraction = min(1.0, sample_rows * 4 / max(1, load))
    sample = data if fraction >= 1.0 else data.sample(fraction=fraction, seed=seed)
    most = max(len(v) for v in inside.values())
    # The intervals of a column are ascending and disjoint: a value is in the last one that begins below it, or in none.
    low, high = ("array(" + ", ".join(f"CAST({_numbers(x[k] for x in inside.get(i, []))} AS ARRAY<DOUBLE>)" for i in range(max(live) + 1)) + ")" for k in (0, 1))
    cells = (_stacked(sample, live).withColumn("j", F.expr(f"size(filter(get({low}, f), e -> e < v)) - 1"))
             .filter(F.expr(f"j >= 0 AND v <= get(get({high}, f), j)")))
    each = max(16, bounds // most)
    found = _cut_points(cells, ["f", "j"], each)
    return {i: np.unique(np.concatenate([np.empty(0), *[v for (f, _), v in found.items() if f == i]])) for i in live}


def _resolve(data, names, live, wanted, cuts, targets, out):
    """Value by value inside the wanted buckets: (column, bucket, value) counts, then a running total."""
    buckets = {i: [b for b, _, _ in t] for i, t in targets.items()}
    spans = {i: [np.concatenate([[-np.inf], cuts[i], [np.inf]])[np.array(b) + k] for k in (0, 1)] for i, b in buckets.items()}

    def rows_of(found):
        f, b, v, n = (np.concatenate(part) for part in zip(*found))
        return pa.RecordBatch.from_arrays([pa.array(f, pa.int32()), pa.array(b, pa.int32()), pa.array(v, pa.float64()), pa.array(n, pa.int64())], ["f", "b", "v", "n"])

    def values(batches):
        found, held = [], 0
        for batch in batches:
            for at, i in enumerate(live):
                x = np.sort(batch.column(at).drop_null().to_numpy(zero_copy_only=False))
                low, high = (np.searchsorted(x, edge, side="right") for edge in spans[i])
                for b, lo, hi in zip(buckets[i], low, high):
                    lo = lo if b else 0  # the first bucket has no lower end, also where values are infinite
                    if hi > lo:
                        v, n = np.unique(x[lo:hi], return_counts=True)
                        found.append((np.full(len(v), i), np.full(len(v), b), v, n))
                        held += len(v)
            if held > 200_000:
                yield rows_of(found)
                found, held = [], 0
        if found:
            yield rows_of(found)

    spark = data.sparkSession
    asked = []
    for i in live:
        for r in wanted[names[i]]:
            for b, before, inside in targets[i]:
                if before <= r < before + inside:
                    asked.append((i, b, r - before, r))
    asks = small_frame(spark, asked, "f int, b int, local bigint, r bigint")
    cells = (data.select(*[f"x{i}" for i in live]).mapInArrow(values, "f int, b int, v double, n bigint")
             .groupBy("f", "b", "v").agg(F.sum("n").alias("n")))
    w = Window.partitionBy("f", "b").orderBy("v")
    cells = cells.withColumn("upto", F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    found = (cells.join(F.broadcast(asks), ["f", "b"])  # one row per wanted rank
             .filter((F.col("local") < F.col("upto")) & (F.col("local") >= F.col("upto") - F.col("n")))
             .select("f", "r", "v").collect())
    for row in found:
        out[names[row["f"]]][1][int(row["r"])] = float(row["v"])


def positions(n: int, p: float) -> tuple[int, int, float]:
    h = (n - 1) * p
    lo = min(max(int(math.floor(h)), 0), n - 1)
    return lo, min(lo + 1, n - 1), h - lo


def quantiles(df: DataFrame, columns: dict[str, Column], probs: list[float], **limits) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of every column, None where a column has no value."""
    def ranks(_, n):
        return [r for p in probs for r in positions(n, p)[:2]] if n else []

    got = order_statistics(df, columns, ranks, **limits)
    out = {}
    for name, (n, values) in got.items():
        row: list[float | None] = []
        for p in probs:
            if n == 0:
                row.append(None)
                continue
            lo, hi, frac = positions(n, p)
            a, b = values[lo], values[hi]
            row.append(float(a + (b - a) * frac))
        out[name] = row
    return out


def medians(df: DataFrame, columns: dict[str, Column], **limits) -> dict[str, float | None]:
    return {n: v[0] for n, v in quantiles(df, columns, [0.5], **limits).items()}

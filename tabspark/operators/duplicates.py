"""Exact duplicate rows and duplicate columns."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, functions as F

from tabspark.functions.types import q
from tabspark.operators.aggregate import collect_aggregates
from tabspark.operators.columnwise import value_profile
from tabspark.operators.mapping import BROADCAST_ENTRIES


def _row_hash(columns: list[str]):
    return F.xxhash64(*[q(c) for c in columns])


def repeated_hashes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Row hashes that occur more than once: 8 bytes per row are shuffled, not the rows."""
    return (df.select(_row_hash(columns).alias("_h")).groupBy("_h").agg(F.count(F.lit(1)).alias("_c"))
            .filter(F.col("_c") > 1).select("_h"))


def _suspects(df: DataFrame, columns: list[str]) -> tuple[DataFrame | None, int]:
    """Repeated hashes (persisted) and their number; rows with a unique hash are certainly unique."""
    repeated = repeated_hashes(df, columns).persist()
    k = repeated.count()
    return repeated, k


def count_duplicate_rows(df: DataFrame) -> int:
    """Rows equal to an earlier row (nulls equal). Only rows with a repeated hash are compared in full."""
    columns = df.columns
    repeated, k = _suspects(df, columns)
    if k == 0:
        repeated.unpersist()
        return 0
    rows = df
    if k <= BROADCAST_ENTRIES:
        rows = df.join(F.broadcast(repeated), _row_hash(columns) == F.col("_h"), "left_semi")
    groups = rows.groupBy(*[q(c) for c in columns]).agg(F.count(F.lit(1)).alias("_c"))
    total = groups.agg(F.sum(F.col("_c") - 1)).first()[0]
    repeated.unpersist()
    return int(total or 0)


def keep_first(df: DataFrame, features: list[str], key: str | None) -> tuple[DataFrame, bool]:
    """Drop rows whose features repeat an earlier row (smallest key); other columns follow the kept row.

    Returns the frame and whether anything was dropped. Copies are folded by an aggregate with map-side
    combining, not a window, so a group of copies holding a third of the rows stays cheap.
    """
    repeated, k = _suspects(df, features)
    if k == 0:
        repeated.unpersist()
        return df, False
    others = [c for c in df.columns if c not in features]
    if others and key is None:
        raise ValueError("keep-first needs a key column that orders the rows")

    def folded(rows: DataFrame) -> DataFrame:
        if not others:
            return rows.select(*[q(c) for c in features]).distinct().select(*[q(c) for c in df.columns])
        # one struct, so that all other columns follow the same row also where keys repeat
        first = F.min(F.struct(q(key).alias("_k"), *[q(c).alias(f"_{i}") for i, c in enumerate(others)])).alias("_first")
        out = rows.groupBy(*[q(c) for c in features]).agg(first)
        return out.select(*[q(c) if c in features else F.col(f"_first._{others.index(c)}").alias(c) for c in df.columns])

    if k <= BROADCAST_ENTRIES:
        small = F.broadcast(repeated)
        same = _row_hash(features) == F.col("_h")
        unique = df.join(small, same, "left_anti")
        return unique.unionByName(folded(df.join(small, same, "left_semi"))), True
    return folded(df), True


def duplicate_columns(df: DataFrame, features: list[str], profile: dict[str, dict] | None = None) -> list[str]:
    """Columns equal to an earlier one (same type, same values row by row, nulls equal).

    One scan of order-free signatures (or a profile that is at hand) proposes pairs; a second scan compares only those row by row.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    got = {c: {k: profile[c][k] for k in ("n", "xor", "lo", "hi")} for c in features if c in (profile or {})}
    got.update(value_profile(df, [c for c in features if c not in got], distinct=False))
    groups: dict[tuple, list[str]] = {}
    for c in features:
        groups.setdefault((types[c], *got[c].values()), []).append(c)
    pairs = [p for g in groups.values() if len(g) > 1 for p in itertools.combinations(g, 2)]
    if not pairs:
        return []
    equal = collect_aggregates(df, {p: F.bool_and(q(p[0]).eqNullSafe(q(p[1]))) for p in pairs})
    dropped: list[str] = []
    for c in features:
        if c in dropped:
            continue
        dropped += [b for a, b in pairs if a == c and b not in dropped and equal[(a, b)] is not False]
    return [c for c in features if c in dropped]

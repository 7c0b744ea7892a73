"""Mutual information with a discrete target, in nats, over all rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabspark.functions.statistics import xlnx
from tabspark.functions.types import dbl, q
from tabspark.operators.aggregate import class_cells
from tabspark.operators.quantiles import quantiles

BINS = 32
EDGES = tuple(k / BINS for k in range(1, BINS))
# Types whose values Arrow can number; binned columns meet classes of other types row by row.
NUMBERED = (T.NumericType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def plug_in_information(cells: DataFrame) -> DataFrame:
    """(feature, mutual_info, rows) from (feature, value, y, n) rows.

    H(X) + H(Y) - H(X,Y) over counts: values and classes are summed from the same cells, so every step is a sum with
    map-side combining, and no plan, row or literal grows with the number of classes.
    """
    values = (cells.groupBy("feature", "value").agg(F.sum("n").alias("a"), F.sum(xlnx(F.col("n"))).alias("j"))
              .groupBy("feature").agg(F.sum("a").alias("n"), F.sum(xlnx(F.col("a"))).alias("ha"), F.sum("j").alias("hj")))
    classes = (cells.groupBy("feature", "y").agg(F.sum("n").alias("t")).groupBy("feature").agg(F.sum(xlnx(F.col("t"))).alias("hb")))
    mi = (F.col("hj") - F.col("ha") - F.col("hb") + xlnx(F.col("n"))) / F.col("n")
    return values.join(classes, "feature").select("feature", F.greatest(mi, F.lit(0.0)).alias("mutual_info"), F.col("n").alias("rows"))


def bin_of(column: str, edges: list[float]) -> Column:
    """0-based bin by ascending distinct edges (the number of edges below the value); null stays null.

    A balanced CASE over literals: log2(edges) comparisons per value, compiled with the rest of the stage.
    """
    def tree(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return f"CASE WHEN {column} <= {edges[mid]!r}D THEN {tree(lo, mid)} ELSE {tree(mid + 1, hi)} END"

    return F.expr(f"CASE WHEN {column} IS NOT NULL THEN {tree(0, len(edges))} END")


def equal_frequency_edges(df: DataFrame, columns: dict[str, Column], bins: int = BINS) -> dict[str, list[float]]:
    got = quantiles(df, columns, [k / bins for k in range(1, bins)])
    return {n: sorted({v for v in vals if v is not None}) for n, vals in got.items()}


def binned_cells(data: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """`class_cells` of the bins of columns x0, x1, ..., whose names and ascending edges are given, and the class y (never null).

    A batch of rows is binned and counted in arrays, so neither plan nor code grows with columns and edges.
    """
    kind = data.schema["y"].dataType
    if not isinstance(kind, NUMBERED):
        return class_cells(data, {c: bin_of(f"x{i}", e) for i, (c, e) in enumerate(edges.items())}, "y", "int")
    cuts = [np.asarray(e, dtype="float64") for e in edges.values()]

    def counted(cells, most):
        """Distinct numbers below ``most`` and how often they occur."""
        if most > 4 * len(cells) + 1024:
            return np.unique(cells, return_counts=True)
        n = np.bincount(cells, minlength=most)
        return np.flatnonzero(n), n[n > 0]

    def count(batches):
        for batch in batches:
            y = batch.column(0).dictionary_encode()
            classes, code = len(y.dictionary), y.indices.to_numpy(zero_copy_only=False).astype("int64")
            found = []
            for i, c in enumerate(cuts):
                x = batch.column(i + 1)
                at = code[x.is_valid().to_numpy(zero_copy_only=False)] if x.null_count else code
                cell, n = counted(np.searchsorted(c, x.drop_null().to_numpy(zero_copy_only=False)) * classes + at, (len(c) + 1) * classes)
                found.append((np.full(len(cell), i), cell // classes, cell % classes, n))
            if classes:
                f, b, k, n = (np.concatenate(part) for part in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(f, pa.int32()), pa.array(b, pa.int32()), y.dictionary.take(pa.array(k)), pa.array(n, pa.int64())], ["f", "value", "y", "n"])

    schema = T.StructType([T.StructField("f", T.IntegerType()), T.StructField("value", T.IntegerType()), T.StructField("y", kind), T.StructField("n", T.LongType())])
    name = F.get(F.array(*[F.lit(c) for c in edges]), F.col("f")).alias("feature")
    return data.select("y", *[f"x{i}" for i in range(len(cuts))]).mapInArrow(count, schema).groupBy(name, "value", "y").agg(F.sum("n").alias("n"))


def categorical_information(df: DataFrame, features: list[str], target: str, null_as_level: bool = False) -> DataFrame:
    cols = {c: (F.coalesce(q(c).cast("string"), F.lit("nan")) if null_as_level else q(c)) for c in features}
    return plug_in_information(class_cells(df, cols, target))


def numeric_information(df: DataFrame, features: list[str], target: str, bins: int = BINS, fill: dict[str, float] | None = None,
                        edges: dict[str, list[float]] | None = None) -> DataFrame:
    """Equal-frequency binned plug-in estimate; ``fill`` replaces nulls first, else they are dropped per feature. Known ``edges`` save their search."""
    filled = [(F.coalesce(dbl(c), F.lit(float(fill[c]))) if fill and fill.get(c) is not None else dbl(c)) for c in features]
    data = df.filter(q(target).isNotNull()).select(q(target).alias("y"), *[e.alias(f"x{i}") for i, e in enumerate(filled)])
    if edges is None:
        edges = equal_frequency_edges(data, {c: F.col(f"x{i}") for i, c in enumerate(features)}, bins)
    return plug_in_information(binned_cells(data, {c: edges[c] for c in features}))

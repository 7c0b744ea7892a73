"""Dataset profile: size, missing values, duplicates, constants, cardinality, leakage suspects, target balance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabspark.functions.statistics import ratio
from tabspark.functions.scalars import missing, without_nan
from tabspark.functions.types import categorical_columns, dbl, families, numeric_columns, q
from tabspark.operators.aggregate import collect_aggregates, long_values, per_feature, small_frame, value_counts
from tabspark.operators.columnwise import constant_columns, equal_counts, numeric_stats, value_profile
from tabspark.operators.duplicates import count_duplicate_rows
from tabspark.operators.quantiles import medians

# A distinct-count sketch decides which columns get an exact count; ten percent are six of its standard errors.
SKETCH_MARGIN = 0.10


def missing_profile(df: DataFrame, threshold: float = 50.0) -> DataFrame:
    """(feature, missing_count, missing_pct, high_missing): high means strictly above the threshold."""
    rows = per_feature(df, df.columns, lambda c: {"missing_count": F.count_if(missing(df, c)),
                                                  "rows": F.count(F.lit(1))})
    pct = ratio(F.col("missing_count") * 100.0, F.col("rows"))
    return rows.select("feature", "missing_count", pct.alias("missing_pct"),
                       F.coalesce(pct > threshold, F.lit(False)).alias("high_missing"))


def _bytes(f: T.StructField) -> Column:
    """Estimated bytes of a cell: 8 for numbers and times, 1 for booleans, the text length for strings."""
    if isinstance(f.dataType, T.StringType):
        return F.coalesce(F.octet_length(q(f.name)), F.lit(0)).cast("long")
    return F.lit(1 if isinstance(f.dataType, T.BooleanType) else 8).cast("long")


def dataset_stats(df: DataFrame) -> DataFrame:
    """(rows, columns, memory_mb) in one scan."""
    cell = sum((_bytes(f) for f in df.schema.fields), F.lit(0).cast("long"))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).cast("long").alias("columns"),
                  (F.coalesce(F.sum(cell), F.lit(0)) / F.lit(1024.0 * 1024.0)).alias("memory_mb"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    return small_frame(df.sparkSession, [(count_duplicate_rows(df),)], "duplicate_count bigint")


def _majority_probe(df: DataFrame, c: str) -> Column:
    """A number per row whose median belongs to any value that fills more than half of the rows."""
    return dbl(c) if _exact(df, c) else F.pmod(F.xxhash64(q(c)), F.lit(1 << 52)).cast("double")


def _exact(df: DataFrame, c: str) -> bool:
    """Whether every value of the column is its own double."""
    return isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType, T.ByteType, T.ShortType, T.IntegerType))


def constant_features(df: DataFrame, near_constant_threshold: float = 99.0) -> DataFrame:
    """(feature, status, top_share): constant (at most one distinct value) or near_constant.

    A value with more than half of the rows is the median, so for thresholds above 50 the median is the
    only candidate and its share is counted exactly; no value histogram is shuffled. For lower thresholds
    the histogram is built.
    """
    usable = [c for c, fam in families(df).items() if fam != "other"]
    if near_constant_threshold <= 50.0:
        counts = value_counts(df, usable)
        shares = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("k"), F.max("n").alias("top"), F.sum("n").alias("t"))
        names = small_frame(df.sparkSession, [(c,) for c in usable], "feature string")
        rows = names.join(F.broadcast(shares), "feature", "left")
        share = ratio(F.col("top") * 100.0, F.col("t"))
        status = F.when(F.coalesce("k", F.lit(0)) <= 1, "constant").when(share >= near_constant_threshold, "near_constant")
        return rows.select("feature", status.alias("status"), share.alias("top_share")).filter("status IS NOT NULL")
    profile = value_profile(df, usable, distinct=False)
    constant = constant_columns(df, profile)
    varied = [c for c in usable if c not in constant]
    probes = {c: F.when(q(c).isNotNull(), _majority_probe(df, c)) for c in varied}
    mid = medians(df, probes, counts={c: profile[c]["n"] for c in varied}) if varied else {}
    hits = equal_counts(df, {c: (probes[c], mid[c]) for c in varied}) if varied else {}
    near = [c for c in varied if 100.0 * hits[c] / profile[c]["n"] >= near_constant_threshold]
    # The probe of a text or a wide number is a hash: count the value itself before it is reported.
    texts = [c for c in near if not _exact(df, c)]
    if texts:
        value = collect_aggregates(df, {c: F.min(F.when(probes[c] == F.lit(mid[c]), q(c))) for c in texts})
        hits.update(collect_aggregates(df, {c: F.count_if(q(c) == F.lit(value[c])) for c in texts}))
    rows = [(c, "constant", 100.0 if profile[c]["n"] else None) for c in constant]
    rows += [(c, "near_constant", 100.0 * hits[c] / profile[c]["n"]) for c in near
             if 100.0 * hits[c] / profile[c]["n"] >= near_constant_threshold]
    return small_frame(df.sparkSession, rows, "feature string, status string, top_share double")


def _identity(df: DataFrame, c: str) -> Column:
    """Text that tells distinct values apart (adding 0.0 folds -0.0 into 0.0)."""
    return (q(c) + F.lit(0.0)).cast("string") if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)) else q(c).cast("string")


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, unique_values): exact distinct non-null values of all columns in one shuffle."""
    names = small_frame(df.sparkSession, [(c,) for c in columns], "feature string")
    if not columns:
        return names.select("feature", F.lit(0).cast("long").alias("unique_values"))
    cells = long_values(df, {c: _identity(df, c) for c in columns}, "string").filter(F.col("value").isNotNull())
    counted = cells.distinct().groupBy("feature").agg(F.count(F.lit(1)).alias("k"))
    return (names.join(F.broadcast(counted), "feature", "left")
            .select("feature", F.coalesce("k", F.lit(0)).cast("long").alias("unique_values")))


def cardinality(df: DataFrame, categorical_only: bool = True, approximate: bool = False) -> DataFrame:
    columns = categorical_columns(df) if categorical_only else df.columns
    if approximate and columns:
        got = value_profile(df, columns)
        return small_frame(df.sparkSession, [(c, got[c]["distinct"]) for c in columns], "feature string, unique_values bigint")
    return distinct_counts(df, columns)


def id_like_columns(df: DataFrame, columns: list[str], threshold: float, sketch: dict | None = None,
                    rows: int | None = None) -> dict[str, float]:
    """Columns with distinct/rows strictly above the threshold, and that ratio.

    A sketch (given, or taken here) rules out columns far below the threshold; the rest are counted exactly.
    """
    if not columns:
        return {}
    if sketch is None:
        rows = df.count()
        sketch = {c: p["distinct"] for c, p in value_profile(df, columns).items()}
    if not rows:
        return {}
    close = [c for c in columns if sketch[c] / rows > threshold * (1 - SKETCH_MARGIN)]
    if not close:
        return {}
    exact = {r["feature"]: r["unique_values"] / rows for r in distinct_counts(df, close).collect()}
    return {c: v for c, v in exact.items() if v > threshold}


def leakage_profile(df: DataFrame, target: str | None = None, corr_threshold: float = 0.95,
                    unique_ratio_threshold: float = 0.95) -> DataFrame:
    """(feature, reason): id-like columns and numeric columns whose |correlation| with the target is too high."""
    columns = [c for c in df.columns if c != target and families(df)[c] != "other"]
    flagged = {(c, "unique_ratio") for c in id_like_columns(df, columns, unique_ratio_threshold)}
    if target in numeric_columns(df):
        others = numeric_columns(df, [target])
        got = numeric_stats(df, {c: q(c) for c in others}, q(target)) if others else {}
        flagged |= {(c, "target_correlation") for c, s in got.items() if s["corr"] is not None and abs(s["corr"]) > corr_threshold}
    return small_frame(df.sparkSession, sorted(flagged), "feature string, reason string")


def _require(df: DataFrame, target: str) -> None:
    if target not in df.columns:
        raise ValueError(f"target column '{target}' is not in the data")


def target_profile(df: DataFrame, target: str) -> DataFrame:
    """(positive_count, negative_count, imbalance_ratio, baseline_accuracy); infinite ratio without positives."""
    _require(df, target)
    counts = df.agg(F.count_if(q(target) == 1).alias("positive_count"),
                    F.count_if(q(target) == 0).alias("negative_count"), F.count(F.lit(1)).alias("_rows"))
    pos, neg = F.col("positive_count"), F.col("negative_count")
    return counts.select(
        "positive_count", "negative_count",
        F.when(pos > 0, ratio(neg, pos)).otherwise(F.lit(float("inf"))).alias("imbalance_ratio"),
        ratio(F.greatest(pos, neg) * 100.0, F.col("_rows")).alias("baseline_accuracy"))


class DataProfiler:
    """Runs the whole profile. `run` returns the named reports; `long` stacks them into one table."""

    def __init__(self, target_column: str | None = None):
        self.target_column = target_column

    def run(self, df: DataFrame) -> dict[str, DataFrame]:
        """One scan each for sizes and target, value hashes, and correlations; duplicates, near-constant values and exact distinct
        counts of likely ids and texts take scans of their own."""
        df = without_nan(df)
        target = self.target_column
        if target is not None:
            _require(df, target)
        spark, fams = df.sparkSession, families(df)
        cell = sum((_bytes(f) for f in df.schema.fields), F.lit(0).cast("long"))
        exprs: dict = {"rows": F.count(F.lit(1)), "bytes": F.sum(cell)}
        if target is not None:
            exprs.update({"pos": F.count_if(q(target) == 1), "neg": F.count_if(q(target) == 0)})
        got = collect_aggregates(df, exprs)
        n = got["rows"]
        known = [c for c in df.columns if fams[c] != "other"]
        values = value_profile(df, known)
        nested = collect_aggregates(df, {c: F.count(q(c)) for c in df.columns if c not in known})
        nulls = {c: n - (values[c]["n"] if c in values else nested[c]) for c in df.columns}
        missing = [(c, nulls[c], 100.0 * nulls[c] / n if n else None) for c in df.columns]
        usable = [c for c in known if c != target]
        leaks = set(id_like_columns(df, usable, 0.95, {c: values[c]["distinct"] for c in usable}, n))
        if target in numeric_columns(df) and len(numeric_columns(df)) > 1:
            corr = numeric_stats(df, {c: q(c) for c in numeric_columns(df, [target])}, q(target))
            leaks |= {c for c, s in corr.items() if s["corr"] is not None and abs(s["corr"]) > 0.95}
        out = {
            "dataset_stats": small_frame(spark, [(n, len(df.columns), (got["bytes"] or 0) / 1024.0 / 1024.0)],
                                         "rows bigint, columns bigint, memory_mb double"),
            "missing_values": small_frame(spark, [(*m, bool(m[2] is not None and m[2] > 50.0)) for m in missing],
                                          "feature string, missing_count bigint, missing_pct double, high_missing boolean"),
            "duplicates": duplicate_rows(df),
            "constants": constant_features(df),
            "cardinality": cardinality(df),
            "leakage": small_frame(spark, [(c,) for c in sorted(leaks)], "feature string"),
        }
        if target is not None:
            pos, neg = got["pos"], got["neg"]
            out["target"] = small_frame(
                spark, [(pos, neg, neg / pos if pos else float("inf"), 100.0 * max(pos, neg) / n if n else None)],
                "positive_count bigint, negative_count bigint, imbalance_ratio double, baseline_accuracy double")
        return out

    @staticmethod
    def long(reports: dict[str, DataFrame]) -> DataFrame:
        """(section, feature, metric, value): every numeric field of every report, flags as 0/1."""
        parts = []
        for section, frame in reports.items():
            if section == "constants":
                frame = frame.select(F.col("feature"), F.lit(1.0).alias("flag"), F.col("status"))
                parts.append(frame.select(F.lit(section).alias("section"), "feature", F.col("status").alias("metric"),
                                          F.col("flag").alias("value")))
                continue
            if section == "leakage":
                parts.append(frame.select(F.lit(section).alias("section"), "feature", F.lit("suspect").alias("metric"),
                                          F.lit(1.0).alias("value")))
                continue
            feature = F.col("feature") if "feature" in frame.columns else F.lit("")
            metrics = [c for c in frame.columns if c != "feature"]
            pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
            parts.append(frame.select(F.lit(section).alias("section"), feature.alias("feature"), F.inline(pairs)))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

"""Fitted value maps and their application as projections or joins (equi left-outer with a default)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tabspark.functions.types import q

LITERAL_ENTRIES = 48          # as a map literal inside the projection
BROADCAST_ENTRIES = 500_000   # as a broadcast hash join
HOT_SHARE = 0.001             # beyond that: values above this share are broadcast, the tail is shuffled
SPREAD = 4096                 # surrogate keys for rows that need no tail lookup


@dataclass
class ValueMap:
    """value -> result for one feature: a dict while it is small, a (value, result, n) DataFrame beyond."""

    feature: str
    entries: dict | None = None
    frame: DataFrame | None = None
    result_type: str = "double"
    total: int = 0
    info: dict = field(default_factory=dict)

    def size(self) -> int:
        return len(self.entries) if self.entries is not None else self.info["size"]


def build_maps(frame: DataFrame, features: list[str], result_type: str = "double",
               limit: int = BROADCAST_ENTRIES) -> dict[str, ValueMap]:
    """Maps per feature from (feature, value, result, n) rows; collected only below the checked limit."""
    head = frame.limit(limit + 1).collect()
    if len(head) <= limit:
        out = {f: ValueMap(f, entries={}, result_type=result_type) for f in features}
        for r in head:
            out[r["feature"]].entries[r["value"]] = r["result"]
            out[r["feature"]].total += r["n"]
        return out
    frame = frame.persist()
    sizes = {r["feature"]: (r["k"], r["t"]) for r in
             frame.groupBy("feature").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("t")).collect()}
    small = [f for f in features if sizes.get(f, (0, 0))[0] <= limit]
    out = {f: ValueMap(f, entries={}, result_type=result_type, total=sizes.get(f, (0, 0))[1]) for f in small}
    budget, taken = limit, []
    for f in sorted(small, key=lambda f: sizes.get(f, (0, 0))[0]):
        budget -= sizes.get(f, (0, 0))[0]
        if budget < 0:
            break
        taken.append(f)
    for r in frame.filter(F.col("feature").isin(taken)).collect() if taken else []:
        out[r["feature"]].entries[r["value"]] = r["result"]
    large = [f for f in features if f not in taken]
    for f in large:
        out[f] = ValueMap(f, frame=frame.filter(F.col("feature") == f).select("value", "result", "n"),
                          result_type=result_type, total=sizes.get(f, (0, 0))[1], info={"size": sizes.get(f, (0, 0))[0]})
    if not large:
        frame.unpersist()
    return out


def _literal(m: ValueMap, key: Column) -> Column:
    if not m.entries:
        return F.lit(None).cast(m.result_type)
    def lit(v):
        return F.array(*[F.lit(x) for x in v]) if isinstance(v, (list, tuple)) else F.lit(v)
    pairs = [x for k, v in m.entries.items() for x in (F.lit(k), lit(v))]
    return F.try_element_at(F.create_map(*pairs), key).cast(m.result_type)


def with_lookups(df: DataFrame, wanted: list[tuple[str, ValueMap, Column]]) -> tuple[DataFrame, list[Column]]:
    """For each (column, map, key expression): the joined frame and one result Column (null = not found).

    Small maps become literals, medium ones broadcast joins. A map too large to broadcast is joined in
    one shuffle: its hot values (at most 1/HOT_SHARE of them exist) are broadcast, and rows that need no
    tail lookup get a spread-out surrogate key, so no reducer receives a hot group.
    """
    results: list[Column] = []
    temp: list[str] = []
    for i, (name, m, key) in enumerate(wanted):
        out = f"_m{i}"
        if m.entries is not None and len(m.entries) <= LITERAL_ENTRIES:
            results.append(_literal(m, key))
            continue
        spark = df.sparkSession
        if m.entries is not None:
            table = spark.createDataFrame(list(m.entries.items()), f"_k{i} string, {out} {m.result_type}")
            df = df.withColumn(f"_j{i}", key.cast("string"))
            df = df.join(F.broadcast(table), F.col(f"_j{i}") == F.col(f"_k{i}"), "left").drop(f"_k{i}", f"_j{i}")
        elif m.info["size"] <= BROADCAST_ENTRIES:
            table = m.frame.select(F.col("value").alias(f"_k{i}"), F.col("result").alias(out))
            df = df.withColumn(f"_j{i}", key.cast("string"))
            df = df.join(F.broadcast(table), F.col(f"_j{i}") == F.col(f"_k{i}"), "left").drop(f"_k{i}", f"_j{i}")
        else:
            df = _hot_and_tail(df, m, key, i, out)
        results.append(F.col(out))
        temp.append(out)
    return df, results


def _hot_and_tail(df: DataFrame, m: ValueMap, key: Column, i: int, out: str) -> DataFrame:
    floor = max(1, int(m.total * HOT_SHARE))
    hot = m.frame.filter(F.col("n") > floor).select(
        F.col("value").alias(f"_hk{i}"), F.col("result").alias(f"_h{i}"), F.lit(True).alias(f"_hf{i}"))
    tail = m.frame.filter(F.col("n") <= floor).select(
        F.col("value").alias(f"_tk{i}"), F.lit(-1).alias(f"_ts{i}"), F.col("result").alias(f"_t{i}"))
    others = [q(c) for c in df.columns]
    df = df.withColumn(f"_j{i}", key.cast("string"))
    df = df.join(F.broadcast(hot), F.col(f"_j{i}") == F.col(f"_hk{i}"), "left")
    settled = F.col(f"_hf{i}").isNotNull() | F.col(f"_j{i}").isNull()
    df = (df.withColumn(f"_s{i}", F.when(settled, F.pmod(F.xxhash64(*others), F.lit(SPREAD)).cast("int")).otherwise(F.lit(-1)))
          .withColumn(f"_jt{i}", F.when(settled, F.lit("")).otherwise(F.col(f"_j{i}"))))
    df = df.join(tail, (F.col(f"_jt{i}") == F.col(f"_tk{i}")) & (F.col(f"_s{i}") == F.col(f"_ts{i}")), "left")
    df = df.withColumn(out, F.when(F.col(f"_hf{i}").isNotNull(), F.col(f"_h{i}")).otherwise(F.col(f"_t{i}")))
    return df.drop(*[f"{p}{i}" for p in ("_j", "_hk", "_h", "_hf", "_s", "_jt", "_tk", "_ts", "_t")])

"""Registered queries of this subpackage, each over its whole tables, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tabspark.llm import attribution, decontam, langid, licenses, neardup, packing, phrases, pii, prefix_trie, quality, secret_scan, topk, warc
from tabspark.llm.common import table
from tabspark.llm.oracles import LEAKS, NEAR_DUPLICATES, PHRASES, PREFIXES, RECORDS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, operator: Callable[..., DataFrame], *tables: str, sql: str | None = None) -> None:
    QUERIES[name] = lambda spark, sf_dir: operator(spark, *(table(spark, sf_dir, t) for t in tables))
    if sql:
        ORACLES[name] = sql


register("op1_language_id", langid.op1_language_id, "documents")
register("op2_pii", pii.op2_pii, "documents")
register("op3_token_counts", attribution.op3_token_counts, "documents")
register("op4_packing", packing.op4_packing, "documents")
register("op5_licenses", licenses.op5_licenses, "documents")
register("op6_exact_top_k", topk.op6_exact_top_k, "embeddings", sql="""
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 5""")
register("op7_near_duplicates", neardup.op7_near_duplicates, "documents", sql=NEAR_DUPLICATES)
register("op8_decontamination", decontam.op8_decontamination, "documents", "benchmark", sql=LEAKS)
register("op9_secrets", secret_scan.op9_secrets, "documents")
register("op10_quality", quality.op10_quality, "documents", "labels")
register("op11_warc", warc.op11_warc, "pages", sql=RECORDS)
register("op12_prefix_trie", prefix_trie.op12_prefix_trie, "conversations", sql=PREFIXES)
register("op13_phrases", phrases.op13_phrases, "documents", sql=PHRASES)

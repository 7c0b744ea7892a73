"""From raw documents to packed training sequences, in five stages over the whole `documents` table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes each result as Parquet in the shared folder and
reads it again as the next stage's input. All stages but the last return the columns of `documents`.

Defined results: null texts are rejected by the first stage; rows with equal ids are one document for the second; empty tables give an empty
result; extra columns travel along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabspark.llm import decontam, langid, neardup, packing, secret_scan
from tabspark.llm.common import last_written, settled, sweep, table, written_so_far


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages learned from them: without a letter, or in no such language, they go."""
    return langid.accepted(docs, langid.learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, 0.8 or more alike) stays: that of the smallest id."""
    return neardup.first_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item, verbatim or with other values, go."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark, and n_chars follows; the documents stay."""
    return secret_scan.without_secrets(docs, secret_scan.learn(docs), size="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets), ("packing", packed)]
#: The learned models and the tokenizer are not expressible in SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, since = table(spark, sf_dir, "documents"), written_so_far()
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), f"stage-{name}")
        sweep(spark, since, last_written())  # the stage before, and what this one has put aside
    return docs

"""Readers. NaN becomes null once, here, so that every later operator sees one kind of missing value."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, types as T

from tabspark.functions.scalars import without_nan


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """CSV with a header row. Give a schema for large inputs: without one, Spark reads the data twice."""
    reader = spark.read.option("header", True).option("nanValue", "NaN").options(**options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return without_nan(reader.csv(path))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return without_nan(spark.read.format(fmt).load(path))


class DatasetLoader:
    """Loads datasets by file name from one data directory (local, HDFS or object store)."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark, self.data_dir = spark, str(data_dir)

    def _path(self, filename: str) -> str:
        return os.path.join(self.data_dir, filename)

    def load_csv(self, filename: str, schema=None, **options) -> DataFrame:
        return read_csv(self.spark, self._path(filename), schema, **options)

    def load_parquet(self, filename: str) -> DataFrame:
        return read_table(self.spark, self._path(filename))

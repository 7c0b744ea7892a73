"""Cutting lineage in a way that outlives executors: reliable checkpoints only."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one only on a local master with none configured.

    On a cluster without a configured folder this raises rather than write to one machine's disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    return tempfile.mkdtemp(prefix="tabspark-")


def checkpoint(df: DataFrame) -> DataFrame:
    """Materialise reliably; lost executors cannot take the data with them."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Write to a new Parquet folder in the shared folder and read it back.

    Like a checkpoint, but columnar: later passes read only the columns they use.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/tabspark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

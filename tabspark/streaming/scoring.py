"""Fitted preparation on a stream: transforms are stateless projections, so they apply unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tabspark.plans.preprocessing import PreprocessingPipeline
from tabspark.functions.scalars import without_nan


def transform_stream(plan: PreprocessingPipeline, stream: DataFrame) -> DataFrame:
    """The fitted plan over a streaming frame; fits and out-of-fold encodings stay batch work."""
    return plan.transform(without_nan(stream))


def write_stream(plan: PreprocessingPipeline, stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                 **trigger) -> StreamingQuery:
    """Start writing the transformed stream; ``checkpoint`` is a folder every executor can reach."""
    writer = transform_stream(plan, stream).writeStream.format(fmt).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)

"""Small helpers the operators share."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabspark.functions.lineage import shared_folder

VOCABULARIES = "/opt/tokenizers"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(key: str, n: int) -> Column:
    """crc32 of the key as text, mod n; null for a null key."""
    return F.crc32(F.col(key).cast("string")) % n


def share(key: str, seed: int) -> Column:
    """A number in [0, 1) that depends on the key only; null keys get one value, too."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, also where `body` uses it inside of lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def scanned(values: Column, first: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str, block: int = 256) -> Column:
    """One element of type `kind` per element of the array: step(state, value) gives the next state and the element.

    Elements are gathered in blocks, so that no array of all of them is copied at every step.
    """
    def within(done: Column, value: Column) -> Column:
        state, element = step(done["state"], value)
        return F.struct(state.alias("state"), F.concat(done["out"], F.array(element)).alias("out"))

    def over(values: Column) -> Column:
        def add(done: Column, b: Column) -> Column:
            inner = F.aggregate(F.slice(values, b * block + 1, F.lit(block)), F.struct(done["state"].alias("state"), F.array().cast(f"array<{kind}>").alias("out")), within)
            return bound(inner, lambda i: F.struct(i["state"].alias("state"), F.concat(done["out"], F.array(i["out"])).alias("out")))

        blocks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int"))
        whole = F.aggregate(blocks, F.struct(first.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out")), add)
        return F.when(F.size(values) > 0, F.flatten(whole["out"])).otherwise(F.array().cast(f"array<{kind}>"))

    return bound(values, over)


def vocabulary_file(name: str, folder: str = VOCABULARIES) -> str:
    return os.path.join(folder, name)


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once an application: their Python need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="tabspark-"), "tabspark.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def slices(rows: pa.RecordBatch, text: str, most_bytes: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about `most_bytes` of text (a single longer text stays whole); memory of earlier batches goes back first."""
    pa.default_memory_pool().release_unused()
    start = size = 0
    lengths = pc.binary_length(rows.column(text)).fill_null(0).to_pylist()
    for i, n in enumerate(lengths):
        if size + n > most_bytes and i > start:
            yield rows.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield rows.slice(start)


#: What a worker process may drop when a task ends, by module.
AT_END: list[Callable[[], None]] = []


def tidied(work: Callable) -> Callable:
    """`work` for mapInArrow, giving back what the worker process holds when the task ends: workers are reused, and stand beside the JVM."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            for drop in AT_END:
                drop()
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):
                pass  # not this C library
    return run


def scratch_path(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder; Spark makes the folder when it writes."""
    return f"{shared_folder(spark).rstrip('/')}/llm-{what}-{uuid.uuid4().hex}"


_written: list[str] = []


def settled(df: DataFrame, what: str) -> DataFrame:
    """Write to the shared folder and read back: the lineage is cut, and lost executors take nothing with them."""
    path = scratch_path(df.sparkSession, what)
    df.write.parquet(path)
    _written.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_so_far() -> int:
    return len(_written)


def discard(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def sweep(spark: SparkSession, since: int, keep: str | None = None) -> None:
    """Delete what `settled` has written from the given count on, once nothing reads it any more."""
    for path in [p for p in _written[since:] if p != keep]:
        discard(spark, path)
        _written.remove(path)


def last_written() -> str:
    return _written[-1]

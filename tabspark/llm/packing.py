"""Packing by concatenate and cut.

All documents' tokens form one long row in the order of the input's partitions. A first pass encodes and writes them with
their place inside the partition; the partitions' totals, summed in order, give every partition's place in the whole; a
second pass cuts at multiples of the window. A document that crosses a cut leaves one piece in each window (boundary
records: `continued` and `continues`). Nothing is shuffled, and what reaches the driver is one number per partition.

Defined results: null and empty texts are the end token alone; repeated rows are packed one by one; an empty table gives
no piece; other columns are ignored. All windows are full but the last.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabspark.llm.common import settled, ship, slices, tidied, vocabulary_file
from tabspark.llm.encoder import encoder

TOKENIZER = "byte_bpe_50k.json"
WINDOW, END = 2048, 1


def encoded(docs: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = vocabulary_file(TOKENIZER), end: int = END) -> DataFrame:
    """part, place (tokens before it in the part), key, tokens (little-endian, ids and `end`), width (bytes an id); one row per document."""
    ship(docs.sparkSession)
    with open(tokenizer, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, place = encoder(spec.value), TaskContext.get().partitionId(), 0
        last = np.array([end], encode.dtype).tobytes()
        for rows in batches:
            for some in slices(rows, "text"):
                tokens = [t + last for t in encode.ids(some.column("text").to_pylist())]
                places = list(accumulate((len(t) // len(last) for t in tokens), initial=place))
                place = places.pop()
                columns = [pa.array([part] * len(tokens), pa.int32()), pa.array(places, pa.int64()), some.column("key"), pa.array(tokens, pa.binary()), pa.array([len(last)] * len(tokens), pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "place", "key", "tokens", "width"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(tidied(work), f"part int, place bigint, key {kind}, tokens binary, width int")


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, tokenizer: str = vocabulary_file(TOKENIZER), end: int = END) -> DataFrame:
    """Pieces: key, start and length within the document, doc_tokens, sequence_id, offset in it, ids (unsigned 32-bit, little-endian), and
    whether the document is continued from the window before or continues in the next."""
    written = settled(encoded(docs, key, text, tokenizer, end), "tokens")
    # a row holds place, bytes and width, so the last row of a part tells its total
    totals = written.groupBy("part").agg(F.sum((F.octet_length("tokens") / F.col("width")).cast("bigint")).alias("n")).collect()
    sizes = sorted((r["part"], r["n"]) for r in totals)
    bases = dict(zip((p for p, _ in sizes), accumulate((n for _, n in sizes), initial=0)))
    kind = docs.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in (some for whole in batches for some in slices(whole, "tokens", 2_000_000)):
            out: dict[str, list] = {c: [] for c in ("row", "start", "length", "doc_tokens", "sequence_id", "offset", "ids", "continued", "continues")}
            for i, (part, place, tokens, width) in enumerate(zip(*(rows.column(c).to_pylist() for c in ("part", "place", "tokens", "width")))):
                ids = np.frombuffer(tokens, f"<u{width}").astype("<u4").tobytes()
                n, first = len(ids) // 4, bases[part] + place
                at = first
                while at < first + n:
                    stop = min(first + n, (at // window + 1) * window)
                    record = (i, at - first, stop - at, n, at // window, at % window, ids[4 * (at - first):4 * (stop - first)], at > first, stop < first + n)
                    for c, v in zip(out, record):
                        out[c].append(v)
                    at = stop
            keys = rows.column("key").take(pa.array(out.pop("row"), pa.int64()))
            kinds = [pa.int64()] * 5 + [pa.binary(), pa.bool_(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([keys, *(pa.array(v, k) for v, k in zip(out.values(), kinds))], ["key", *out])

    return written.mapInArrow(tidied(work), f"key {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary, "
                                    "continued boolean, continues boolean").withColumnRenamed("key", key)


def op4_packing(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

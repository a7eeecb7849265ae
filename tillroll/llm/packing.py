"""Packing by concatenating and cutting.

The ids of all documents, each with an end id behind it, form one row of ids
that is cut into windows of fixed length. The first pass encodes and stores the
ids with each document's offset in its partition; a prefix sum over the
partitions' totals gives the offset in the whole; the second pass cuts.

A document that runs over a window's edge gives a boundary record: a piece whose
`continues` says that it goes on in the next window. Only the last window can be
short. Null and empty texts are a document of the end id alone. Documents lie in
the order of the stored table; rows with equal ids or none are documents of
their own. Columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.bpe import word_table
from tillroll.llm.common import raw_texts, rows, slices, stored

WINDOW = 2048
END_ID = 1
# Words in a worker's table: about 100 MB.
TABLE_WORDS = 400_000


def _kind(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def encoded_partitions(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, part, first, n, ids): ids as 16- or 32-bit numbers, `first` the place in `part`."""
    texts = docs.select(
        "doc_id", F.col("text").cast("string").alias("text"), F.spark_partition_id().alias("part")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, table = 0, word_table(path, TABLE_WORDS)
        narrow = "<u2" if max(len(table.pieces) - 1, end_id) < 1 << 16 else "<u4"
        end = np.array([end_id], dtype=narrow).tobytes()
        for batch in slices(batches):
            first, count, ids = [], [], []
            for text in raw_texts(batch.column("text")):
                code = table.encode(text)
                ids.append(np.frombuffer(code, dtype="<u4").astype(narrow).tobytes() + end)
                first.append(at)
                count.append(len(code) // 4 + 1)
                at += count[-1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("part"),
                    pa.array(first, pa.int64()),
                    pa.array(count, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "part", "first", "n", "ids"],
            )

    schema = f"doc_id {_kind(docs)}, part int, first bigint, n bigint, ids binary"
    return texts.mapInArrow(run, schema)


def _cut(window: int):
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "continues"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for doc_id, at, n, raw in rows(batch, "doc_id", "at", "n", "ids"):
                width, lo = len(raw) // n, 0
                ids = np.frombuffer(raw, dtype=f"<u{width}").astype("<u4")
                while lo < n:
                    sequence, offset = divmod(at + lo, window)
                    length = min(n - lo, window - offset)
                    piece = ids[lo : lo + length].tobytes()
                    lo += length
                    out.append((doc_id, lo - length, length, piece, n, sequence, offset, lo < n))
            kinds = [batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.binary()]
            kinds += [pa.int64()] * 3 + [pa.bool_()]
            columns = list(zip(*out, strict=True)) or [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

    return run


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document.

    (doc_id, start, length, ids, doc_tokens, sequence_id, offset, continues),
    the ids as little-endian unsigned 32-bit numbers. The prefix sum runs over
    one row per partition of the input.
    """
    parts = stored(encoded_partitions(docs, path, end_id), "ids")
    totals = parts.groupBy("part").agg(F.sum("n").alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("part", F.coalesce(before, F.lit(0).cast("bigint")).alias("before"))
    # One number per partition of the input.
    placed = parts.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("before") + F.col("first")).alias("at"), "n", "ids"
    )
    schema = f"doc_id {_kind(docs)}, start bigint, length bigint, ids binary, doc_tokens bigint, "
    return placed.mapInArrow(
        _cut(window), schema + "sequence_id bigint, offset bigint, continues boolean"
    )

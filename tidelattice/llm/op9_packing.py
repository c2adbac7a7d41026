"""Packing by concatenate and cut.

Pass one encodes every text, once, and writes the ids with each text's place
inside its part and each part's token total.  Prefix sums over those totals
give every part its global offset.  Pass two reads the written ids and cuts
the concatenation into windows of `length`; the boundary records say which
slice of which document lies where.  No row is shuffled.

Defined results: a NULL or empty text is the end id alone; texts of any length
are cut across as many sequences as they need; repeated rows are packed as
often as they occur; an empty table gives no pieces; columns beyond the id and
the text are ignored.  Every sequence but the last is full, so padding is less
than one sequence in all.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bytepairs import encode_column, id_kind
from .stages import kept

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def encoded(docs: DataFrame, path: str, end: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_tokens, part, at, ids): ids as little-endian numbers of `id_kind`, `at` counts from the part's start."""
    kind = id_kind(path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            names = batch.column(0)
            for first, last, ids, counts in encode_column(batch.column(1), path, end):
                ends = np.zeros(len(counts) + 1, np.int64)
                np.cumsum(counts, out=ends[1:])
                raw = pa.py_buffer(ids.astype(kind).tobytes())
                where = pa.py_buffer((kind.itemsize * ends).astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        names.slice(first, last - first),
                        pa.array(counts, pa.int64()),
                        pa.array(np.full(len(counts), part, np.int64)),
                        pa.array(at + ends[:-1]),
                        pa.Array.from_buffers(pa.binary(), len(counts), [None, where, raw]),
                    ],
                    names=["doc_id", "n_tokens", "part", "at", "ids"],
                )
                at += int(ends[-1])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(encode, "doc_id long, n_tokens long, part long, at long, ids binary")


def part_offsets(ids: DataFrame) -> DataFrame:
    """Tokens of all parts before each part: one row per part meets in the prefix sum."""
    totals = ids.groupBy("part").agg(F.sum("n_tokens").alias("_total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("base"))


def cut_windows(placed: DataFrame, length: int, kind: np.dtype) -> DataFrame:
    """Boundary records of (doc_id, n_tokens, begin, ids) rows for windows of `length` ids of type `kind`."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_numpy(zero_copy_only=False)
            tokens, begin = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            pieces = (begin + tokens - 1) // length - begin // length + 1
            row = np.repeat(np.arange(len(pieces)), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = begin[row] // length + nth
            left = np.maximum(begin[row], sequence * length)
            right = np.minimum(begin[row] + tokens[row], (sequence + 1) * length)
            start = left - begin[row]
            crcs = np.zeros(len(row), np.int64)
            at = 0
            for k, n in enumerate(pieces):
                wide = memoryview(np.frombuffer(batch.column(3)[k].as_buffer(), kind).astype("<u4")).cast("B")
                for _ in range(n):
                    a = 4 * start[at]
                    crcs[at] = zlib.crc32(wide[a : a + 4 * (right[at] - left[at])])
                    at += 1
            columns = [names[row], start, right - left, crcs, tokens[row], sequence, left - sequence * length]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), *[pa.array(c, pa.int64()) for c in columns[1:]]],
                names=[field.split()[0] for field in PIECES.split(", ")],
            )

    return placed.select("doc_id", "n_tokens", "begin", "ids").mapInArrow(cut, PIECES)


def pack(
    docs: DataFrame, path: str, length: int = 1024, end: int = 0, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per piece of a document: where it starts there, its length, its sequence and its offset in it."""
    ids = kept(encoded(docs, path, end, id_column, text_column), "packing-ids")
    placed = ids.join(F.broadcast(part_offsets(ids)), "part").withColumn("begin", F.col("base") + F.col("at"))
    return cut_windows(placed, length, id_kind(path))

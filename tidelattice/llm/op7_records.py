"""Token-id output as length-delimited binary records with a separate offset index.

Record: 8 bytes length of the payload, 4 bytes masked checksum of those, the
payload, 4 bytes masked checksum of the payload; all little-endian.  Payload:
8 bytes doc_id, 1 byte flags (bit 0: doc_id present, bit 1: 32-bit ids), then
the ids as 16-bit numbers, or 32-bit ones where the vocabulary needs them.  The checksum is
CRC-32, masked by a rotation and an added constant so that a checksum stored
inside other checksummed data stays harmless.

Index: one 8-byte offset per record, in `<file>.index`, so that a reader can
take records in any order.  Files hold ascending doc_ids and follow one
another in that order.  A task writes its files under names of its own and
returns them as rows; Spark commits each task's rows once, so the manifest
names exactly one attempt's files even after executors are lost, and readers
open only what the manifest names.

Defined results: a NULL or empty text is the end id alone; repeated doc_ids
are kept, next to each other; NULL doc_ids come first; an empty table gives an
empty manifest and no rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_folder
from .bytepairs import encode_column, id_kind

MANIFEST = "file string, part long, nth long, records long, tokens long, bytes long"
MASK_ADDEND = 0xA282EAD8
HEAD, TAIL = 12, 4


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17)) + MASK_ADDEND) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = len(payload).to_bytes(8, "little")
    return b"".join(
        (
            length,
            masked(zlib.crc32(length)).to_bytes(4, "little"),
            payload,
            masked(zlib.crc32(payload)).to_bytes(4, "little"),
        )
    )


def unframe(blob: memoryview, at: int) -> tuple[memoryview, int]:
    """Payload of the record at a byte position, and the position after it; raises on damage."""
    length = bytes(blob[at : at + 8])
    size = int.from_bytes(length, "little")
    if int.from_bytes(blob[at + 8 : at + HEAD], "little") != masked(zlib.crc32(length)):
        raise ValueError(f"record at {at}: the length does not fit its checksum")
    payload = blob[at + HEAD : at + HEAD + size]
    if len(payload) != size or int.from_bytes(blob[at + HEAD + size : at + HEAD + size + TAIL], "little") != masked(
        zlib.crc32(payload)
    ):
        raise ValueError(f"record at {at}: the payload does not fit its checksum")
    return payload, at + HEAD + size + TAIL


class _Writer:
    """One record file and its index, closed together."""

    def __init__(self, folder: str, name: str) -> None:
        self.system, root = fs.FileSystem.from_uri(folder)
        self.name, self.path = name, f"{root}/{name}"
        self.system.create_dir(root, recursive=True)
        self.out = self.system.open_output_stream(self.path)
        self.index = self.system.open_output_stream(f"{self.path}.index")
        self.records = self.tokens = self.bytes = 0

    def add(self, payload: bytes, tokens: int) -> None:
        record = frame(payload)
        self.index.write(self.bytes.to_bytes(8, "little"))
        self.out.write(record)
        self.records += 1
        self.tokens += tokens
        self.bytes += len(record)

    def close(self) -> None:
        self.out.close()
        self.index.close()


def _uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


def write_records(
    docs: DataFrame,
    folder: str,
    path: str,
    end: int | None = 0,
    file_bytes: int = 64 << 20,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Write all documents in ascending doc_id order; returns the manifest, committed in `folder`/manifest."""
    target, kind = _uri(folder), id_kind(path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, writer, done = TaskContext.get().partitionId(), None, []

        def finish() -> None:
            writer.close()
            done.append((writer.name, part, len(done), writer.records, writer.tokens, writer.bytes))

        for batch in batches:
            names = batch.column(0).to_pylist()
            for first, last, ids, counts in encode_column(batch.column(1), path, end):
                ids = ids.astype(kind)
                ends = np.cumsum(counts)
                for name, a, b in zip(names[first:last], (ends - counts).tolist(), ends.tolist()):
                    if writer is None:
                        writer = _Writer(f"{target}/data", f"part-{part:06d}-{len(done):04d}-{uuid.uuid4().hex}.records")
                    head = (name or 0).to_bytes(8, "little", signed=True) + bytes([(name is not None) + 2 * (kind.itemsize == 4)])
                    writer.add(head + ids[a:b].tobytes(), b - a)
                    if writer.bytes >= file_bytes:
                        finish()
                        writer = None
        if writer is not None:
            finish()
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*done)], names=[f.split()[0] for f in MANIFEST.split(", ")]
            )

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    manifest = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id").mapInArrow(write, MANIFEST)
    manifest.write.parquet(f"{folder}/manifest")
    return docs.sparkSession.read.schema(manifest.schema).parquet(f"{folder}/manifest")


def read_records(manifest: DataFrame, folder: str, chunk: int = 8 << 20) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, checked against both checksums.

    `start` counts the ids of all records before it: the manifest's token
    totals give each file's base, so files are read independently.
    """
    before = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    target = _uri(folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(f"{target}/data")
        for batch in batches:
            for row in batch.to_pylist():
                start, out = row["base"], []
                with system.open_input_file(f"{root}/{row['file']}.index") as f:
                    offsets = [*np.frombuffer(f.read(), "<u8").tolist(), row["bytes"]]
                with system.open_input_file(f"{root}/{row['file']}") as f:
                    k = 0
                    while k < row["records"]:
                        # As many whole records as fit a chunk, one at least.
                        stop = max(k + 1, int(np.searchsorted(offsets, offsets[k] + chunk, "right")) - 1)
                        blob = memoryview(f.read_at(offsets[stop] - offsets[k], offsets[k]))
                        for j in range(k, stop):
                            payload, _ = unframe(blob, offsets[j] - offsets[k])
                            ids = np.frombuffer(payload[9:], "<u4" if payload[8] & 2 else "<u2").astype("<u4")
                            name = int.from_bytes(payload[:8], "little", signed=True) if payload[8] & 1 else None
                            out.append((name, start, len(ids), zlib.crc32(ids)))
                            start += len(ids)
                        k = stop
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, pa.int64()) for c in zip(*out)], names=["doc_id", "start", "n_tokens", "ids_crc32"]
                        )
                        out = []

    # A stated number of ranges, one a file: the manifest is small, so Spark would else give all files to one task.
    files = max(1, manifest.count())
    spread = placed.repartitionByRange(files, "part", "nth")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def written_and_read(spark: SparkSession, docs: DataFrame, path: str, end: int = 0) -> DataFrame:
    folder = shared_folder(spark, "token-records")
    return read_records(write_records(docs, folder, path, end), folder)

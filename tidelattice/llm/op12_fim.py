"""Fill-in-the-middle transformation by rotating blocks of a byte buffer in place.

A text becomes prefix, middle and suffix at two cuts that a hash of its id
draws.  Code points are scanned once for the byte positions of the cuts, the
sentinels are inserted in front of the three segments, and two neighbouring
blocks of the buffer change places by three reversals:

* psm: `<P>prefix <M>middle <S>suffix` -> middle and suffix change places
* spm: `<P>prefix <M>middle <S>suffix` -> the first two and the suffix change places

Restoring finds the sentinels, rotates the same blocks back, and deletes the
sentinels.  No segment holds a sentinel and every sentinel begins with the one
`<` that could start a match across a seam, so each is found exactly once.

Defined results: NULL and empty texts are plain and empty, as are, unchanged,
texts that contain a sentinel; a NULL doc_id is hashed as no digits; very long
texts are cut like any other, in a buffer of their own; repeated rows give equal
results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import text_slices

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM, SPM_BELOW = 90, 20
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _reverse(buffer: bytearray, start: int, end: int) -> None:
    """Reverse buffer[start:end] in place; at most half of it is copied."""
    view = np.frombuffer(buffer, np.uint8)
    half = (end - start) // 2
    low, high = view[start : start + half], view[end - half : end]
    held = low[::-1].copy()
    low[:] = high[::-1]
    high[:] = held


def rotate(buffer: bytearray, start: int, seam: int, end: int) -> None:
    """Exchange the blocks [start, seam) and [seam, end) by three reversals."""
    _reverse(buffer, start, seam)
    _reverse(buffer, seam, end)
    _reverse(buffer, start, end)


def draws(doc_id: int | None) -> tuple[int, int, int, int]:
    """The first four 32-bit numbers of the id's hash."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4))


def cut_points(text: bytes, first: int, second: int) -> tuple[int, int]:
    """Byte positions before the code points with these two numbers."""
    if text.isascii():
        return first, second
    leads = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    at = np.append(leads, len(text))
    return int(at[first]), int(at[second])


def characters(text: bytes) -> int:
    return len(text) if text.isascii() else int(((np.frombuffer(text, np.uint8) & 0xC0) != 0x80).sum())


def transformed(text: bytes, doc_id: int | None) -> tuple[int, str, int | None, int | None, bytes]:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    n = characters(text)
    h1, h2, h3, h4 = draws(doc_id)
    if not n or h3 % 100 >= PLAIN_FROM or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    low, high = cut_points(text, first, second)
    buffer = bytearray(text)
    # From the back, so that earlier positions hold.
    for at, sentinel in ((high, SUFFIX), (low, MIDDLE), (0, PREFIX)):
        buffer[at:at] = sentinel
    middle, suffix = low + len(PREFIX), high + len(PREFIX) + len(MIDDLE)
    if h4 % 100 < SPM_BELOW:
        form = "spm"
        rotate(buffer, 0, suffix, len(buffer))
    else:
        form = "psm"
        rotate(buffer, middle, suffix, len(buffer))
    return n, form, first, second - first, bytes(buffer)


def restored(output: bytes, form: str) -> bytes:
    """The text that `transformed` made the output from."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    if form == "spm":
        # suffix | prefix, middle: the second block goes back to the front.
        rotate(buffer, 0, buffer.index(PREFIX), len(buffer))
    else:
        # prefix | suffix | middle: the last two change places again.
        rotate(buffer, buffer.index(SUFFIX), buffer.index(MIDDLE), len(buffer))
    for sentinel in (SUFFIX, MIDDLE, PREFIX):
        at = buffer.index(sentinel)
        del buffer[at : at + len(sentinel)]
    return bytes(buffer)


def transform(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch.column(1)):
                ids = batch.column(0).slice(part.first, part.last - part.first)
                raw, at = part.data.tobytes(), part.offsets.tolist()
                made = [transformed(raw[a:b], d) for d, a, b in zip(ids.to_pylist(), at, at[1:])]
                columns = list(zip(*made))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1], pa.string()),
                        pa.array(columns[2], pa.int64()),
                        pa.array(columns[3], pa.int64()),
                        pa.array(columns[4], pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def restore(made: DataFrame) -> DataFrame:
    """The rows of `transform` with the column `restored`: each text from its output and form alone."""
    names = [*made.columns, "restored"]
    at = {c: k for k, c in enumerate(made.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch.column(at["output"])):
                rows = batch.slice(part.first, part.last - part.first)
                raw, ends = part.data.tobytes(), part.offsets.tolist()
                forms = rows.column(at["form"]).to_pylist()
                texts = [restored(raw[a:b], f) for f, a, b in zip(forms, ends, ends[1:])]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.binary()).cast(pa.string())], names=names)

    fields = ", ".join(f"`{c}` {t}" for c, t in made.dtypes)
    return made.mapInArrow(run, f"{fields}, restored string")

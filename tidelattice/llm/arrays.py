"""Whole Arrow columns of text as flat arrays: slices, words, n-grams, 64-bit hashes.

Everything here works on a slice of a record batch at a time.  A slice holds
whole texts and about `SLICE_BYTES` of them (a longer text is a slice of its
own), so memory follows the slice and the longest text, not the partition.
Hashes are fixed functions of the bytes: every worker computes the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                steps = np.full(size, np.uint64(base))
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))


_POWERS = _Powers()


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for every span; equal spans hash equally wherever they stand."""
    n = len(values)
    _POWERS.reach(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _POWERS.up[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _POWERS.down[starts] + (ends - starts).astype(np.uint64))


class Slice(NamedTuple):
    first: int  # row of the batch
    last: int  # row after the slice
    data: np.ndarray  # UTF-8 bytes of all texts
    offsets: np.ndarray  # byte position of each text, and the end


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string column into slices of whole texts; NULL counts as an empty text."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, where, raw = column.buffers()
    offsets = np.frombuffer(where, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield Slice(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


class Words(NamedTuple):
    starts: np.ndarray  # byte positions
    ends: np.ndarray
    first: np.ndarray  # index of each text's first word, and the number of words
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        """Index of the text each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def runs(keep: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values; a run does not cross into the next text."""
    n = len(keep)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = keep[:-1], keep[1:]
    edges = offsets[1:-1]
    before[edges[edges < n]] = False
    after[edges[edges > 0] - 1] = False
    return np.flatnonzero(keep & ~before), np.flatnonzero(keep & ~after) + 1


def split_words(piece: Slice, inside: np.ndarray, fold: np.ndarray | None = None) -> Words:
    """Maximal runs of bytes for which `inside` is true; `fold` maps bytes before they are hashed."""
    starts, ends = runs(inside[piece.data], piece.offsets)
    values = _BYTE_VALUES if fold is None else _BYTE_VALUES[fold]
    return Words(
        starts,
        ends,
        np.searchsorted(starts, piece.offsets),
        span_hashes(values[piece.data], starts, ends),
    )


def grams(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the `size` words from each position, and whether they all belong to one text."""
    n = len(words.hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    at = np.arange(n)
    last_of_text = np.repeat(words.first[1:], words.counts)[:n]
    return span_hashes(words.hashes, at, at + size), at + size <= last_of_text


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of the `width` values from each position on."""
    if len(values) < width:
        return values[:0]
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    if have < width:
        values = np.minimum(values[: len(values) - (width - have)], values[width - have :])
    return values


def winnow(words: Words, window: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of `window` words the least hash of its `size`-word grams, and whether it lies in one text.

    Equal windows have equal fingerprints, so two texts that share a window
    share a fingerprint (the winnowing guarantee).
    """
    hashes, _ = grams(words, size)
    least = sliding_min(hashes, window - size + 1)
    last_of_text = np.repeat(words.first[1:], words.counts)[: len(least)]
    return least, np.arange(len(least)) + window <= last_of_text


def covered(hits: np.ndarray, width: int, total: int) -> np.ndarray:
    """Positions below `total` that lie in a window of `width` starting where `hits` is true."""
    steps = np.zeros(total + 1, np.int32)
    at = np.flatnonzero(hits)
    np.add.at(steps, at, 1)
    np.add.at(steps, np.minimum(at + width, total), -1)
    return np.cumsum(steps[:total]) > 0


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed long."""
    return x.view(np.int64)


def list_column(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Lists of the given lengths over one flat array."""
    ends = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


_BYTES = np.arange(256)
# Words of any text but the six ASCII white-space bytes.
PLAIN = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
# Words of lower-cased ASCII letters, digits, and everything beyond ASCII.
FOLD = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
ALNUM = (FOLD >= 0x80) | ((FOLD >= 0x30) & (FOLD <= 0x39)) | ((FOLD >= 0x61) & (FOLD <= 0x7A))

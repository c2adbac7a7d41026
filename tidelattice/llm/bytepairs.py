"""Byte-level byte-pair pieces of whole columns of text.

A byte-pair tokenizer first cuts a text into pieces and then works inside each
piece, so what it makes of a text is the sequence of what it makes of the
pieces.  `cut` finds the pieces of a whole slice with array operations;
`PieceTable` keeps what is known about each distinct piece, by its hash, in
each Python worker, so that only pieces not seen before are worked out.
"""

from __future__ import annotations

import functools
import os
import unicodedata
from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa

from .arrays import Slice, mix, span_hashes, text_slices

OTHER, LETTER, NUMBER, SPACE = range(4)
# The characters with Unicode's White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# What may follow an apostrophe as a piece of its own.
ENDINGS = ["s", "t", "re", "ve", "m", "ll", "d"]
_QUOTE, _BLANK = ord("'"), ord(" ")


@functools.cache
def _kinds() -> np.ndarray:
    first = {"L": LETTER, "N": NUMBER}
    kinds = np.fromiter((first.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    kinds[WHITE_SPACE] = SPACE
    return kinds


@functools.cache
def _values() -> np.ndarray:
    return mix(np.arange(1, 0x110001, dtype=np.uint64))


class Pieces(NamedTuple):
    text: str  # all texts of the slice
    starts: np.ndarray  # character positions
    ends: np.ndarray
    first: np.ndarray  # index of each text's first piece, and the number of pieces
    hashes: np.ndarray


def cut(part: Slice) -> Pieces:
    """The pieces of every text of a slice, as the tokenizer's splitting pattern gives them."""
    text = part.data.tobytes().decode("utf-8")
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    chars = np.zeros(len(part.data) + 1, np.int64)
    np.cumsum((part.data & 0xC0) != 0x80, out=chars[1:])
    offsets = chars[part.offsets]
    n = len(codes)
    kinds = _kinds()[codes]
    opens = np.zeros(n + 1, bool)  # a text begins here
    opens[offsets] = True
    fresh = opens[:n].copy()  # a run of one kind begins here
    fresh[1:] |= kinds[1:] != kinds[:-1]
    begin = fresh.copy()
    # The last white space before a visible character: a blank joins what follows, another one stands alone.
    tail = np.flatnonzero((kinds[:-1] == SPACE) & (kinds[1:] != SPACE) & ~opens[1:n]) if n > 1 else np.zeros(0, np.int64)
    begin[tail] = True
    begin[tail + 1] = codes[tail] != _BLANK
    # A lone apostrophe that begins a piece takes one of the endings with it.
    quote = np.flatnonzero((codes == _QUOTE) & fresh & begin)
    quote = quote[quote + 1 < n]
    quote = quote[~opens[quote + 1] & (kinds[quote + 1] == LETTER)]
    done = np.zeros(len(quote), bool)
    for ending in ENDINGS:
        size = len(ending)
        match = ~done & (quote + size < n)
        for k, c in enumerate(ending, 1):
            at = np.minimum(quote + k, n - 1)
            match &= (codes[at] == ord(c)) & ~opens[at]
        done |= match
        at = quote[match]
        begin[at + 1] = False
        after = at + 1 + size
        after = after[after < n]
        begin[after] |= (kinds[after] == LETTER) & ~opens[after]
    starts = np.flatnonzero(begin)
    ends = np.append(starts[1:], n)
    return Pieces(text, starts, ends, np.searchsorted(starts, offsets), span_hashes(_values()[codes], starts, ends))


class PieceTable:
    """What `work` makes of each distinct piece: a list of numbers of type `kind`, kept for at most `limit` pieces.

    When the table is full it is emptied and fills again with what the next
    texts use; results do not depend on it.
    """

    def __init__(self, work: Callable[[Sequence[str]], Sequence[Sequence[int]]], kind: np.dtype, limit: int = 600_000) -> None:
        self.work, self.kind, self.limit = work, np.dtype(kind), limit
        self._clear()

    def _clear(self) -> None:
        self.slot: dict[int, int] = {}
        self.sizes = np.zeros(1024, np.int64)
        self.places = np.zeros(1024, np.int64)
        self.pool = np.zeros(1 << 14, self.kind)
        self.filled = 0

    def _add(self, hashes: list[int], texts: list[str]) -> None:
        made = self.work(texts)
        sizes = np.fromiter(map(len, made), np.int64, len(made))
        flat = np.fromiter((x for one in made for x in one), self.kind, int(sizes.sum(dtype=np.int64)))
        have, all_now = len(self.slot), len(self.slot) + len(made)
        if all_now > len(self.sizes):
            self.sizes = np.resize(self.sizes, 2 * all_now)
            self.places = np.resize(self.places, 2 * all_now)
        if self.filled + len(flat) > len(self.pool):
            self.pool = np.resize(self.pool, 2 * (self.filled + len(flat)))
        self.sizes[have:all_now] = sizes
        self.places[have:all_now] = self.filled + np.cumsum(sizes) - sizes
        self.pool[self.filled : self.filled + len(flat)] = flat
        self.filled += len(flat)
        self.slot.update(zip(hashes, range(have, all_now)))

    def slots(self, pieces: Pieces) -> np.ndarray:
        """The table's row of every piece."""
        codes, distinct = pd.factorize(pieces.hashes)
        if len(self.slot) + len(distinct) > self.limit:
            self._clear()
        at = np.fromiter((self.slot.get(h, -1) for h in distinct.tolist()), np.int64, len(distinct))
        new = np.flatnonzero(at < 0)
        if len(new):
            where = np.zeros(len(distinct), np.int64)
            where[codes[::-1]] = np.arange(len(codes))[::-1]
            where = where[new]
            begin, end = pieces.starts[where].tolist(), pieces.ends[where].tolist()
            have = len(self.slot)
            self._add(distinct[new].tolist(), [pieces.text[a:b] for a, b in zip(begin, end)])
            at[new] = np.arange(have, have + len(new))
        return at[codes]

    def gather(self, slots: np.ndarray) -> np.ndarray:
        """The numbers of all pieces, one after the other."""
        sizes = self.sizes[slots]
        before = np.cumsum(sizes, dtype=np.int64) - sizes
        total = int(before[-1] + sizes[-1]) if len(sizes) else 0
        return self.pool[np.repeat(self.places[slots] - before, sizes) + np.arange(total)]


@functools.cache
def tokenizer(path: str):
    # Spark runs one task per core; the library's own threads would only compete with them.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _specials(path: str) -> list[str]:
    return [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]


def id_kind(path: str) -> np.dtype:
    """The number type that holds every id of a tokenizer file: 16 bits, or 32 where the vocabulary needs them."""
    return np.dtype("<u2" if tokenizer(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")


@functools.cache
def _id_table(path: str) -> PieceTable:
    library = tokenizer(path)
    return PieceTable(lambda texts: [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)], id_kind(path))


def encode_column(column: pa.Array, path: str, end: int | None = None):
    """Yield (first row, last row, ids, number of ids per row) for each slice of a column.

    The ids are the library's for each whole text; `end` is appended to every
    text.  A text that contains one of the added special strings goes to the
    library as it is, because those strings cut texts differently.
    """
    table, specials, library = _id_table(path), _specials(path), tokenizer(path)
    for part in text_slices(column):
        pieces = cut(part)
        slots = table.slots(pieces)
        ids, sizes = table.gather(slots), table.sizes[slots]
        upto = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=upto[1:])
        bounds = upto[pieces.first]
        counts = np.diff(bounds)
        odd = any(s in pieces.text for s in specials)
        if odd:
            rows = []
            for k in range(part.last - part.first):
                text = column[part.first + k].as_py() or ""
                whole = any(s in text for s in specials)
                rows.append(
                    np.asarray(library.encode(text, add_special_tokens=False).ids, table.kind)
                    if whole
                    else ids[bounds[k] : bounds[k + 1]]
                )
            counts = np.fromiter(map(len, rows), np.int64, len(rows))
            ids = np.concatenate(rows) if rows else ids[:0]
            bounds = np.concatenate([[0], np.cumsum(counts)])
        if end is not None:
            ids = np.insert(ids, bounds[1:], table.kind.type(end))
            counts = counts + 1
        yield part.first, part.last, ids, counts

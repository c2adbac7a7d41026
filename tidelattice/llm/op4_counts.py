"""Token counts by heap-and-linked-list byte-pair merging.

Each piece starts as one symbol per byte in a doubly linked list.  A heap
holds the rank of every adjacent pair that the merge list knows; the lowest
rank (leftmost of equals) is popped and merged until the heap is empty.  The
count is the number of symbols minus the number of merges; no ids are made.

Defined results: NULL and empty texts have no bytes and no tokens; texts of
any length are counted whole; repeated rows are counted again; an empty table
gives no rows; other columns are ignored.  A special string inside a text
counts as one token, as in the library.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytepairs import PieceTable, cut
from .arrays import text_slices


@functools.cache
def _byte_symbols() -> list[str]:
    """The printable stand-in of each byte: itself where it is a visible Latin-1 character, else the next free one."""
    visible = [b for b in range(256) if 0x21 <= b <= 0x7E or (b >= 0xA1 and b != 0xAD)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in set(visible) else chr(next(hidden)) for b in range(256)]


class Merger:
    """Counts of one tokenizer file, from its merge list alone."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.symbols = _byte_symbols()
        self.specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)

    def count(self, piece: str) -> int:
        """Symbols left when no adjacent pair can be merged."""
        ranks, symbols = self.ranks, self.symbols
        part = [symbols[b] for b in piece.encode("utf-8")]
        n = left = len(part)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = []
        for at, pair in enumerate(zip(part, part[1:])):
            rank = ranks.get(pair)
            if rank is not None:
                heap.append((rank, at))
        heapq.heapify(heap)
        while heap:
            rank, at = heapq.heappop(heap)
            here, right = part[at], after[at]
            # The pair may have been merged away or changed since it was pushed.
            if here is None or right >= n or ranks.get((here, part[right])) != rank:
                continue
            here = part[at] = here + part[right]
            part[right] = None
            left -= 1
            beyond = after[at] = after[right]
            if beyond < n:
                before[beyond] = at
                rank = ranks.get((here, part[beyond]))
                if rank is not None:
                    heapq.heappush(heap, (rank, at))
            ahead = before[at]
            if ahead >= 0:
                rank = ranks.get((part[ahead], here))
                if rank is not None:
                    heapq.heappush(heap, (rank, ahead))
        return left

    def counts(self, pieces: Sequence[str]) -> list[tuple[int]]:
        return [(self.count(p),) for p in pieces]


@functools.cache
def merger(path: str) -> Merger:
    return Merger(path)


@functools.cache
def _table(path: str) -> PieceTable:
    return PieceTable(merger(path).counts, np.int64)


def count_column(column: pa.Array, path: str) -> np.ndarray:
    """Tokens of every text of a column."""
    table, specials = _table(path), merger(path).specials
    special = re.compile("|".join(map(re.escape, specials))) if specials else None
    out = np.zeros(len(column), np.int64)
    for part in text_slices(column):
        pieces = cut(part)
        sums = np.zeros(len(pieces.hashes) + 1, np.int64)
        np.cumsum(table.gather(table.slots(pieces)), out=sums[1:])
        out[part.first : part.last] = np.diff(sums[pieces.first])
        if special and special.search(pieces.text):
            for row in range(part.first, part.last):
                text = column[row].as_py() or ""
                if found := len(special.findall(text)):
                    rest = pa.array([t for t in special.split(text) if t], pa.string())
                    out[row] = found + int(count_column(rest, path).sum())
    return out


def token_counts(
    docs: DataFrame, path: str, limit: int = 1024, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = pa.array(count_column(batch.column(2), path))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), tokens], names=["doc_id", "n_bytes", "n_tokens"])

    text = F.col(text_column).cast("string")
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        text.alias("text"),
    )
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

"""Benchmark decontamination by winnowing.

A fingerprint of a 13-word window is the least hash of its 5-word grams.  Test
items and documents that share a window share its fingerprint, so the join of
both sides' fingerprints names every (document, item) pair that can share one,
and it moves about one fingerprint for five words.  Each hit is then extended
to whole windows: of documents with candidates, every window is compared with
the windows of its candidate items.  An item of fewer than 13 words is one
window of its own length; the lengths that occur get fingerprints of their own.

Words and windows are compared by 64-bit hashes.

Defined results: NULL and empty texts have no words and are never
contaminated; an item without words never occurs; items with equal texts count
one by one; a repeated row gets its own result; documents with a NULL doc_id
are judged like any other; empty tables give no rows, or clean ones; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import ALNUM, FOLD, Words, grams, list_column, mix, signed, split_words, text_slices, winnow
from .stages import free_name, kept, small_or_plain

WINDOW = 13
RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, text_hash long"


def _gram_size(window: int) -> int:
    """About two fifths of the window: few fingerprints, and few shared by chance."""
    return max(1, 2 * window // 5)


def _fingerprints(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all windows of one length, and the text each belongs to; runs of equal ones once."""
    least, ok = winnow(words, window, _gram_size(window))
    text = words.text_of[: len(least)]
    fresh = ok.copy()
    if len(least):
        fresh[1:] &= (least[1:] != least[:-1]) | (text[1:] != text[:-1]) | ~ok[:-1]
    return mix(least[fresh] + np.uint64(window)), text[fresh]


def _test_prints(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(item_id, item_text, size, print) of every item with words; size is its window's length."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch.column(1)):
                words = split_words(part, ALNUM, FOLD)
                sizes = np.minimum(words.counts, window)
                hashes, texts = [], []
                for size in np.unique(sizes[sizes > 0]).tolist():
                    found, text_of = _fingerprints(words, size)
                    mine = sizes[text_of] == size
                    hashes.append(found[mine])
                    texts.append(text_of[mine])
                if texts:
                    row = np.concatenate(texts)
                    at = pa.array(row + part.first)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(at),
                            batch.column(1).take(at),
                            pa.array(sizes[row], pa.int32()),
                            pa.array(signed(np.concatenate(hashes))),
                        ],
                        names=["item_id", "item_text", "size", "print"],
                    )

    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(prints, "item_id long, item_text string, size int, print long")


def _doc_prints(docs: DataFrame, sizes: list[int]) -> DataFrame:
    """(doc_id, n_words, prints) with the fingerprints of all windows of the given lengths."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch.column(1)):
                words = split_words(part, ALNUM, FOLD)
                both = [_fingerprints(words, size) for size in sizes]
                hashes = np.concatenate([h for h, _ in both] or [np.zeros(0, np.uint64)])
                texts = np.concatenate([t for _, t in both] or [np.zeros(0, np.int64)])
                order = np.argsort(texts, kind="stable")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, part.last - part.first),
                        pa.array(words.counts, pa.int64()),
                        list_column(signed(hashes[order]), np.bincount(texts, minlength=len(words.counts)), pa.int64()),
                    ],
                    names=["doc_id", "n_words", "prints"],
                )

    return docs.mapInArrow(prints, "doc_id long, n_words long, prints array<long>")


def _one_text(text: str | None) -> Words:
    return split_words(next(text_slices(pa.array([text or ""], pa.string()))), ALNUM, FOLD)


def _extend(candidates: DataFrame, window: int, share: int) -> DataFrame:
    """Exact results of (doc_id, text, items) rows, items being (item_id, item_text) candidates."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, text, items, text_hash in zip(*(c.to_pylist() for c in batch.columns)):
                words = _one_text(text)
                n = len(words.hashes)
                hit, found, windows = np.zeros(n + 1, np.int64), [], {}
                for item in items:
                    test = _one_text(item["item_text"])
                    size = min(window, len(test.hashes))
                    if size not in windows:
                        windows[size] = grams(words, size)[0]
                    at = np.flatnonzero(np.isin(windows[size], grams(test, size)[0]))
                    if len(at):
                        found.append(str(item["item_id"]) if item["item_id"] is not None else "")
                        np.add.at(hit, at, 1)
                        np.add.at(hit, at + size, -1)
                hits = int((np.cumsum(hit[:n]) > 0).sum())
                digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
                out.append((doc_id, n, hits, len(found), digest, hits > 0 and share * hits >= n, text_hash))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in list(zip(*out))[:4]]
                    + [pa.array([r[4] for r in out], pa.string()), pa.array([r[5] for r in out], pa.bool_()), pa.array([r[6] for r in out], pa.int64())],
                    names=[f.split()[0] for f in RESULT.split(", ")],
                )

    return candidates.select("doc_id", "text", "items", F.xxhash64("text")).mapInArrow(extend, RESULT)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    share: int = 20,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    broadcast_bytes: float = 16e6,
) -> DataFrame:
    """One row per document: its words, those inside occurring windows, the items, and whether it is contaminated.

    A document is contaminated if at least one word in `share` is hit.
    `text_hash` is the text's hash for documents with candidates, else NULL.
    """
    prints = kept(_test_prints(benchmark, item_column, item_text_column, window), "benchmark-prints")
    sizes = [r[0] for r in prints.select("size").distinct().orderBy("size").collect()]  # at most `window` numbers
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    scanned = kept(_doc_prints(rows, sizes), "document-prints")

    tests = prints.select("print", "item_id", "item_text").distinct()
    hits = (
        scanned.select("doc_id", F.explode("prints").alias("print"))
        .join(small_or_plain(kept(tests, "benchmark-tests"), F.octet_length("item_text") + 16, broadcast_bytes), "print")
        .groupBy("doc_id", "item_id", "item_text")
        .agg(F.first("print").alias("_print"))
    )
    items = hits.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "item_text")).alias("items"))
    size = F.aggregate("items", F.lit(0).cast("long"), lambda a, i: a + F.octet_length(i["item_text"]) + 16)
    found = small_or_plain(kept(items, "contamination-candidates"), size, broadcast_bytes).withColumnRenamed("doc_id", "_id")

    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    judged = _extend(rows.join(found, same), window, share)
    clean = scanned.join(found.select("_id"), same, "left_anti").select(
        "doc_id",
        "n_words",
        F.lit(0).cast("long").alias("n_hit"),
        F.lit(0).cast("long").alias("n_items"),
        F.lit(hashlib.sha256(b"").hexdigest()).alias("items_sha256"),
        F.lit(False).alias("contaminated"),
        F.lit(None).cast("long").alias("text_hash"),
    )
    return judged.unionByName(clean)


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """The rows of `docs` that are not contaminated, unchanged; a row is known by its id and its text."""
    judged = decontaminate(docs, benchmark, id_column=id_column, text_column=text_column, **options)
    this_id, this_hash = free_name(docs, "_id"), free_name(docs, "_hash")
    out = judged.filter("contaminated").select(F.col("doc_id").alias(this_id), F.col("text_hash").alias(this_hash)).distinct()
    gone = small_or_plain(kept(out, "contaminated"))
    this = F.col(id_column).cast("long").eqNullSafe(F.col(this_id)) & (
        F.xxhash64(F.col(text_column).cast("string")) == F.col(this_hash)
    )
    return docs.join(gone, this, "left_anti")

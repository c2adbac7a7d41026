"""Ranked lexical search by scanning documents with an Aho-Corasick automaton of all item terms.

There is no document index and no list of postings: term frequencies are
counted from the text each time it is read.  Every term stands in the automaton
between two guard bytes, and a text is folded so that each byte outside a term
is the guard, so a hit is a whole term and one pass over the text gives all of
them, overlapping guards included.

Documents are scanned twice.  The first scan counts, in every task, the
documents that hold each item term, and the corpus figures N and L; the second
one, with the terms' weights known, maps the automaton's outputs to items and
keeps the best `top` documents of each item in every task, from which the best
of all follow.  Between the scans only sums are shuffled, after it at most
`top` rows per task and item.

An automaton is broadcast as the text of its terms with the items that they map
to, and built in each Python worker.  Its size is bounded: items are dealt, in
order of their numbers, into blocks of at most `block_bytes` of terms (or one
item that is longer), and the documents are scanned once more for each further
block.

Defined results: NULL, empty and termless texts match nothing and do not count
in N; an item without terms, or without a matching document, has no rows; items
are known by item_id, and rows that share one (NULL included) are one item with
the terms of all; documents that share a doc_id are ranked one by one, a NULL
doc_id after all others of its score; very long texts are scanned whole; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import ALNUM, FOLD, runs, text_slices
from .stages import kept

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_GUARD = "\0"
# Each byte of a text as the automaton reads it: folded inside a term, the guard outside.
_READ = np.where(ALNUM, FOLD, 0).astype(np.uint8).tobytes()
SCAN_BYTES = 1 << 19
BLOCK_BYTES = 2 << 20
HITS_AT_ONCE = 1 << 20
CELLS = 1 << 20
MERGE_GROUPS = 256


class Block(NamedTuple):
    """The terms of some items: places first[t] to first[t + 1] hold the items with term t, and their `gains` per unit of impact."""

    name: str
    terms: list[str]
    first: np.ndarray
    items: np.ndarray
    gains: np.ndarray
    numbers: np.ndarray  # of the items, which a block numbers from 0


_BUILT: dict[str, ahocorasick.Automaton] = {}


def automaton(name: str, terms: list[str]) -> ahocorasick.Automaton:
    """The automaton of these terms, whose outputs are their numbers; built once in a Python worker."""
    if name not in _BUILT:
        made = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, term in enumerate(terms):
            # One character per byte of UTF-8, as the texts are read.
            made.add_word(_GUARD + term.encode("utf-8").decode("latin-1") + _GUARD, number)
        if terms:
            made.make_automaton()
        _BUILT.clear()
        _BUILT[name] = made
    return _BUILT[name]


def matches(column: pa.Array, found: ahocorasick.Automaton, terms: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each slice of texts (first row, terms per text, text, term number, tf), the last three by text and number."""
    for part in text_slices(column, SCAN_BYTES):
        starts, _ = runs(ALNUM[part.data], part.offsets)
        counts = np.diff(np.searchsorted(starts, part.offsets))
        keys, tf = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if terms:
            folded, at = part.data.tobytes().translate(_READ), part.offsets.tolist()
            # A guard before every text, and one at the end.
            line = b"\0".join([b"", *(folded[a:b] for a, b in zip(at, at[1:])), b""]).decode("latin-1")
            guards = part.offsets[:-1] + np.arange(len(counts))
            flat = itertools.chain.from_iterable(found.iter(line))
            while len(hits := np.fromiter(itertools.islice(flat, 2 * HITS_AT_ONCE), np.int64)):
                # A hit ends at the guard after its term, at the latest the one before the next text.
                text = np.searchsorted(guards, hits[0::2], "left") - 1
                more, times = np.unique(text * terms + hits[1::2], return_counts=True)
                keys, where = np.unique(np.concatenate([keys, more]), return_inverse=True)
                tf = np.bincount(where, np.concatenate([tf, times]), len(keys)).astype(np.int64)
        yield part.first, counts, keys // max(terms, 1), keys % max(terms, 1), tf


def _ranges(first: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which, at): the places `at` of the lists of all given terms, `which` being the term's place among them."""
    sizes = first[terms + 1] - first[terms]
    which = np.repeat(np.arange(len(terms)), sizes)
    before = np.cumsum(sizes) - sizes
    return which, np.repeat(first[terms] - before, sizes) + np.arange(int(sizes.sum()))


def item_terms(benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item_id, term, qtf): the distinct terms of each item and how often it repeats them."""
    words = F.regexp_extract_all(F.translate(F.col(text_column).cast("string"), _UPPER, _LOWER), F.lit(TERM), F.lit(0))
    rows = benchmark.select(F.col(id_column).cast("long").alias("item_id"), F.explode(words).alias("term"))
    return rows.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("qtf"))


def _blocks(terms: DataFrame, block_bytes: int) -> DataFrame:
    """(item, item_id, block): items numbered from 0 and dealt in that order into blocks, by prefix sums of bytes.

    Numbers and sums run over one row per item, within buckets of items first and then over the buckets.
    """
    sizes = terms.groupBy("item_id").agg(F.sum(F.octet_length("term") + 16).alias("bytes"))
    sizes = kept(sizes.withColumn("bucket", F.pmod(F.xxhash64("item_id"), F.lit(1024))), "item-bytes")
    order = ["item_id"]
    upto = Window.partitionBy("bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    buckets = sizes.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("b"))  # at most 1024 rows
    ahead = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select(
        "bucket", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("_n"), F.coalesce(F.sum("b").over(ahead), F.lit(0)).alias("_b")
    )
    return sizes.join(F.broadcast(offsets), "bucket").select(
        (F.row_number().over(Window.partitionBy("bucket").orderBy(*order)) - 1 + F.col("_n")).alias("item"),
        "item_id",
        F.floor((F.coalesce(F.sum("bytes").over(upto), F.lit(0)) + F.col("_b")) / block_bytes).cast("long").alias("block"),
    )


def count_documents(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(term, df) for each term that occurs, and one row with a NULL term: df is N, `total` is L.  One scan."""
    sent = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, terms))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, words = sent.value
        found = automaton(name, words)
        df, n, total = np.zeros(len(words) + 1, np.int64), 0, 0
        for batch in batches:
            for _, counts, _, term, _ in matches(batch.column(1), found, len(words)):
                df += np.bincount(term, minlength=len(df))
                n += int((counts > 0).sum())
                total += int(counts.sum())
        there = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None, *[words[t] for t in there.tolist()]], pa.string()),
                pa.array([n, *df[there].tolist()], pa.int64()),
                pa.array([total, *[0] * len(there)], pa.int64()),
            ],
            names=["term", "df", "total"],
        )

    counted = docs.mapInArrow(scan, "term string, df long, total long")
    return counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def best_documents(docs: DataFrame, block: Block, documents: int, all_terms: int, top: int) -> DataFrame:
    """(item, doc_id, score): at least the `top` best documents of every item of a block, `top` from each task.  One scan."""
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, words, first, items, gains, numbers = sent.value
        found, width = automaton(name, words), len(numbers)
        rows = max(1, CELLS // width)
        best = np.zeros((0, 4), np.int64)  # item, minus score, whether the id is NULL, id
        for batch in batches:
            nulls = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            for at, counts, text, term, tf in matches(batch.column(1), found, len(words)):
                m = 100 - 75 + (75 * counts * documents) // max(all_terms, 1)
                impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[text])
                for low in range(0, len(counts), rows):
                    a, b = np.searchsorted(text, (low, low + rows))
                    which, place = _ranges(first, term[a:b])
                    scores = np.zeros(min(rows, len(counts) - low) * width, np.int64)
                    np.add.at(scores, (text[a:b][which] - low) * width + items[place], gains[place] * impact[a:b][which])
                    hits = np.flatnonzero(scores)
                    row = at + low + hits // width
                    new = np.stack([hits % width, -scores[hits], nulls[row], ids[row]], 1)
                    best = _leading(np.concatenate([best, new]), top)
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers[best[:, 0]]), pa.array(best[:, 3], mask=best[:, 2] > 0), pa.array(-best[:, 1])],
            names=["item", "doc_id", "score"],
        )

    return docs.mapInArrow(scan, "item long, doc_id long, score long")


def _leading(rows: np.ndarray, top: int) -> np.ndarray:
    """The first `top` rows of each value of the first column, in the order of all columns."""
    rows = rows[np.lexsort(rows.T[::-1])]
    place = np.arange(len(rows)) - np.searchsorted(rows[:, 0], rows[:, 0])
    return rows[place < top]


def search(
    docs: DataFrame,
    benchmark: DataFrame,
    top: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of each item with a score above 0."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    terms = kept(item_terms(benchmark, item_column, item_text_column), "item-terms")
    placed = kept(_blocks(terms, block_bytes), "item-blocks")
    blocks = (placed.agg(F.max("block")).first()[0] or 0) + 1
    terms = terms.withColumn("key", F.coalesce(F.col("item_id").cast("string"), F.lit("")))
    placed = placed.withColumn("key", F.coalesce(F.col("item_id").cast("string"), F.lit("")))
    terms = kept(terms.join(placed.select("key", "item", "block"), "key").drop("key"), "block-terms")

    # What is collected below is the terms of one block: at most `block_bytes`, or one item.
    counts = None
    for number in range(blocks):
        words = [r[0] for r in terms.filter(F.col("block") == number).select("term").distinct().orderBy("term").collect()]
        found = count_documents(rows, words)
        counts = found if counts is None else counts.unionByName(found)
    # A term of several blocks has been counted alike for each.
    counts = kept(counts.groupBy("term").agg(F.max("df").alias("df"), F.max("total").alias("total")), "document-counts")
    corpus = counts.filter("term IS NULL").first()
    documents, all_terms = (corpus["df"], corpus["total"]) if corpus else (0, 0)
    weight = F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1))).cast("long")
    weighed = kept(terms.join(counts.filter("term IS NOT NULL").select("term", weight.alias("weight")), "term"), "term-weights")

    tops = docs.sparkSession.createDataFrame([], "item long, doc_id long, score long")
    for number in range(blocks):
        mine = weighed.filter(F.col("block") == number).orderBy("term", "item").collect()
        if not mine:
            continue
        names = sorted({r["item"] for r in mine})
        local = {item: k for k, item in enumerate(names)}
        spelled = {term: len(list(rows_of)) for term, rows_of in itertools.groupby(r["term"] for r in mine)}
        block = Block(
            uuid.uuid4().hex,
            list(spelled),
            np.cumsum([0, *spelled.values()]),
            np.array([local[r["item"]] for r in mine], np.int64),
            np.array([r["weight"] * r["qtf"] for r in mine], np.int64),
            np.array(names, np.int64),
        )
        tops = tops.unionByName(best_documents(rows, block, documents, all_terms, top))

    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # The rows of many tasks meet in two steps, so that none is merged whole in one task.
    some = tops.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)))
    for keys in (["item", "_group"], ["item"]):
        some = some.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= top)
    return some.join(placed.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")

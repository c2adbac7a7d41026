"""Substring dedup with suffix automata of reference shards.

A window is 13 consecutive words of one document; a word is removed if a
window over it also starts in a document with a smaller id.

1. Fingerprints (winnowing, as in decontamination) leave the windows that can
   be shared at all; documents with equal word sequences stand for one.
2. The first document of each shared window owns it.  Owned windows, joined
   to spans, are the reference: every shared passage is in it exactly once,
   however many documents repeat it.
3. The reference is cut into shards of bounded size by owner.  Each shard's
   spans become one suffix automaton over words, in which a state knows the
   least document id of its occurrences.  A shard goes to as many tasks as its
   queries need (hot passages are read by many documents).
4. Documents stream their shared spans through the automata of the shards
   that own them.  The matching statistic gives the longest match at every
   word; where it reaches the threshold, the state of the last 13 words says
   whether a smaller document has them.  Covered words form the maximal spans
   that are cut out.

Defined results: NULL and empty texts have no words; a text of fewer than 13
words loses nothing; rows that repeat a doc_id are judged one by one and do
not remove from each other; a document with a NULL id is kept whole and
removes nothing; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .arrays import PLAIN, covered, grams, list_column, runs, signed, split_words, text_slices, winnow
from .stages import free_name, kept

WINDOW, GRAM = 13, 7
NOTHING = hashlib.sha256(b"").hexdigest()


def _digest(raw: bytes) -> tuple[int, str]:
    """Of the words joined by one space: 64 bits that tell rows of one doc_id apart, and the whole digest."""
    digest = hashlib.sha256(b" ".join(raw.split()))
    return int.from_bytes(digest.digest()[:8], "little", signed=True), digest.hexdigest()


def _digests(docs: DataFrame) -> DataFrame:
    """(doc_id, key, n_words, words_sha) of every document."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            keys, digests = zip(*map(_digest, texts)) if texts else ((), ())
            counts = [len(t.split()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.string())],
                names=["doc_id", "key", "n_words", "words_sha"],
            )

    return docs.mapInArrow(digest, "doc_id long, key long, n_words long, words_sha string")


def _prints(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(doc_id, key, prints) of every document."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch.column(1)):
                words = split_words(part, PLAIN)
                least, ok = winnow(words, window, gram)
                text = words.text_of[: len(least)]
                fresh = ok.copy()
                if len(least):
                    fresh[1:] &= (least[1:] != least[:-1]) | (text[1:] != text[:-1])
                raw, at = part.data.tobytes(), part.offsets.tolist()
                keys = [_digest(raw[a:b])[0] for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, part.last - part.first),
                        pa.array(keys, pa.int64()),
                        list_column(signed(least[fresh]), np.bincount(text[fresh], minlength=len(words.counts)), pa.int64()),
                    ],
                    names=["doc_id", "key", "prints"],
                )

    return docs.mapInArrow(prints, "doc_id long, key long, prints array<long>")


def _words_of(column: pa.Array, row: int):
    return split_words(next(text_slices(column.slice(row, 1))), PLAIN)


def _candidates(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """(doc_id, key, text, windows): the distinct windows whose fingerprint another document has too."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in range(len(batch)):
                words = _words_of(batch.column(1), row)
                shared = np.asarray(batch.column(2)[row].values, np.int64)
                least, _ = winnow(words, window, gram)
                hashes, _ = grams(words, window)
                found.append(np.unique(signed(hashes[np.isin(signed(least), shared)])))
            if found:
                keys = [_digest((t or "").encode())[0] for t in batch.column(1).to_pylist()]
                lists = list_column(np.concatenate(found), [len(f) for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(keys, pa.int64()), batch.column(1), lists],
                    names=["doc_id", "key", "text", "windows"],
                )

    return rows.mapInArrow(windows, "doc_id long, key long, text string, windows array<long>")


SPANS = "shard int, own boolean, doc_id long, key long, start int, words string, n_words int"


def _spans(rows: DataFrame, window: int) -> DataFrame:
    """Spans of (doc_id, key, text, windows, shards, own) rows: joined windows of one shard, as owner or as reader."""

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in range(len(batch)):
                words = _words_of(batch.column(2), row)
                raw = (batch.column(2)[row].as_py() or "").encode()
                hashes = signed(grams(words, window)[0])
                known = np.asarray(batch.column(3)[row].values, np.int64)
                label = 2 * np.asarray(batch.column(4)[row].values, np.int64) + np.asarray(batch.column(5)[row].values, np.int64)
                order = np.argsort(known)
                known, label = known[order], label[order]
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                mine = np.where(known[at] == hashes, label[at], -1)
                for one in np.unique(mine[mine >= 0]).tolist():
                    keep = covered(mine == one, window, len(words.hashes))
                    for a, b in zip(*runs(keep, np.array([0, len(keep)]))):
                        text = b" ".join(raw[words.starts[a] : words.ends[b - 1]].split()).decode()
                        doc = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                        out.append((one // 2, bool(one % 2), *doc, int(a), text, int(b - a)))
            if out:
                kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[f.split()[0] for f in SPANS.split(", ")]
                )

    return rows.select("doc_id", "key", "text", "windows", "shards", "own").mapInArrow(spans, SPANS)


class SuffixAutomaton:
    """Suffix automaton of several word sequences; each state keeps the least owner of its occurrences."""

    def __init__(self) -> None:
        self.edges: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.owner = [float("inf")]

    def _state(self, length: int, edges: dict, link: int) -> int:
        self.edges.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.owner.append(float("inf"))
        return len(self.link) - 1

    def _split(self, state: int, word, target: int) -> int:
        """The state reached by `word` that is exactly one word longer than `state`."""
        edges, length, link = self.edges, self.length, self.link
        if length[target] == length[state] + 1:
            return target
        clone = self._state(length[state] + 1, dict(edges[target]), link[target])
        link[target] = clone
        while state >= 0 and edges[state].get(word) == target:
            edges[state][word] = clone
            state = link[state]
        return clone

    def add(self, words, owner) -> None:
        edges, link, length = self.edges, self.link, self.length
        last = 0
        for word in words:
            target = edges[last].get(word)
            if target is not None:
                last = self._split(last, word, target)
            else:
                new, state = self._state(length[last] + 1, {}, 0), last
                while state >= 0 and word not in edges[state]:
                    edges[state][word] = new
                    state = link[state]
                if state >= 0:
                    link[new] = self._split(state, word, edges[state][word])
                last = new
            if owner < self.owner[last]:
                self.owner[last] = owner

    def finish(self, threshold: int) -> None:
        """Pass owners on to suffixes, and find each state's suffix of `threshold` words."""
        link, length, owner = self.link, self.length, self.owner
        by_length = sorted(range(1, len(link)), key=length.__getitem__)
        for state in reversed(by_length):
            if owner[state] < owner[link[state]]:
                owner[link[state]] = owner[state]
        self.first = owner[:]
        for state in by_length:
            up = link[state]
            if length[up] >= threshold:
                self.first[state] = self.first[up]

    def matches(self, words) -> Iterator[tuple[int, int]]:
        """For each word the longest match that ends there, and the automaton's state."""
        edges, link, length = self.edges, self.link, self.length
        state = size = 0
        for word in words:
            while state and word not in edges[state]:
                state = link[state]
                size = length[state]
            state = edges[state].get(word, 0)
            size = size + 1 if state else 0
            yield size, state


FOUND = "doc_id long, key long, starts array<int>"


def _matching(window: int):
    def match(reference: pa.Table, readers: pa.Table) -> pa.Table:
        automaton, ids = SuffixAutomaton(), {}
        for doc_id, text in zip(reference["doc_id"].to_pylist(), reference["words"].to_pylist()):
            automaton.add([ids.setdefault(w, len(ids)) for w in text.split(" ")], doc_id)
        automaton.finish(window)
        first, names, keys, found = automaton.first, [], [], []
        for doc_id, key, start, text in zip(*(readers[c].to_pylist() for c in ("doc_id", "key", "start", "words"))):
            back = start - window + 1
            hits = [
                at + back
                for at, (size, state) in enumerate(automaton.matches([ids.get(w, -1) for w in text.split(" ")]))
                if size >= window and first[state] < doc_id
            ]
            if hits:
                names.append(doc_id)
                keys.append(key)
                found.append(hits)
        columns = [pa.array(names, pa.int64()), pa.array(keys, pa.int64()), pa.array(found, pa.list_(pa.int32()))]
        return pa.table(columns, names=["doc_id", "key", "starts"])

    return match


def _remove(rows: DataFrame, window: int) -> DataFrame:
    """(doc_id, key, n_removed, kept, spans) of (doc_id, key, text, starts) rows, starts being lists of window starts.

    `spans` holds the removed words as [first, after the last, first, ...], by their numbers in the text.
    """

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, texts, spans = [], [], []
            for text, starts in zip(batch.column(2).to_pylist(), batch.column(3)):
                words = (text or "").encode().split()
                hits = np.zeros(len(words), bool)
                hits[np.asarray(starts.values.flatten(), np.int64)] = True
                gone = covered(hits, window, len(words))
                counts.append(int(gone.sum()))
                texts.append(b" ".join(w for w, g in zip(words, gone.tolist()) if not g).decode())
                spans.append(np.flatnonzero(np.diff(gone, prepend=False, append=False)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(counts, pa.int64()),
                    pa.array(texts, pa.string()),
                    pa.array(spans, pa.list_(pa.int32())),
                ],
                names=["doc_id", "key", "n_removed", "kept", "spans"],
            )

    schema = "doc_id long, key long, n_removed long, kept string, spans array<int>"
    return rows.select("doc_id", "key", "text", "starts").mapInArrow(remove, schema)


def without_words(text: str, spans: list[int]) -> str:
    """The text without the words of the spans; what is left stands where and as it stood.

    A span goes with the white space after it, or, at the end of the text, with the white space before it.
    """
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    starts, ends = runs(PLAIN[data], np.array([0, len(data)]))
    out, at = [], 0
    for first, after in zip(spans[::2], spans[1::2]):
        if after < len(starts):
            out.append(raw[at : starts[first]])
            at = starts[after]
        else:
            out.append(raw[at : ends[first - 1] if first else 0])
            at = ends[after - 1] if first else len(raw)
    return b"".join([*out, raw[at:]]).decode()


def find_repeats(
    rows: DataFrame, first: DataFrame, window: int, gram: int, shard_windows: int, task_words: int
) -> DataFrame:
    """(doc_id, key, text, starts) of the documents in `first` that repeat windows of smaller ones."""
    prints = kept(_prints(rows, window, gram).join(first, ["doc_id", "key"], "left_semi"), "word-prints")
    prints = prints.select("doc_id", F.explode("prints").alias("print"))
    shared = (
        prints.groupBy("print")
        .agg(F.min("doc_id").alias("_a"), F.max("doc_id").alias("_b"))
        .filter("_a < _b")
        .select("print")
    )
    hits = prints.join(kept(shared, "shared-prints"), "print", "left_semi").groupBy("doc_id").agg(
        F.collect_set("print").alias("prints")
    )
    hits = kept(hits, "document-shared-prints")
    candidates = kept(_candidates(rows.join(hits, "doc_id"), window, gram), "repeat-candidates")

    windows = candidates.select("doc_id", F.explode("windows").alias("window"))
    owners = windows.groupBy("window").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("_b")).filter("owner < _b")
    owners = kept(owners.drop("_b"), "window-owners")
    shards = max(1, -(-owners.count() // shard_windows))
    labelled = (
        windows.join(owners, "window")
        .select(
            "doc_id",
            "window",
            F.pmod(F.xxhash64("owner"), F.lit(shards)).cast("int").alias("shard"),
            (F.col("owner") == F.col("doc_id")).alias("own"),
        )
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("window", "shard", "own")).alias("_w"))
        .select(
            "doc_id",
            F.col("_w.window").alias("windows"),
            F.col("_w.shard").alias("shards"),
            F.transform("_w.own", lambda x: x.cast("int")).alias("own"),
        )
    )
    labelled = kept(labelled, "window-shards")
    spans = kept(_spans(candidates.drop("windows").join(labelled, "doc_id"), window), "shared-spans")

    loads = (
        spans.filter("NOT own").groupBy("shard").agg(F.ceil(F.sum("n_words") / F.lit(task_words)).cast("int").alias("tasks"))
    )
    # One row per shard, itself one per `shard_windows` windows.
    loads = F.broadcast(kept(loads, "shard-loads"))
    readers = spans.filter("NOT own").join(loads, "shard").withColumn(
        "task", F.pmod(F.xxhash64("doc_id", "start"), F.col("tasks").cast("long")).cast("int")
    )
    reference = spans.filter("own").join(loads, "shard").withColumn(
        "task", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1))
    )
    columns = ["shard", "task", "doc_id", "key", "start", "words"]
    found = (
        reference.select(*[F.col(c).alias(c) for c in columns])
        .groupBy("shard", "task")
        .cogroup(readers.select(*[F.col(c).alias(c) for c in columns]).groupBy("shard", "task"))
        .applyInArrow(_matching(window), FOUND)
        .groupBy("doc_id", "key")
        .agg(F.collect_list("starts").alias("starts"))
    )
    return candidates.drop("windows").join(kept(found, "repeat-starts"), ["doc_id", "key"])


def dedup_substrings(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    shard_windows: int = 100_000,
    task_words: int = 1_000_000,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, words_sha, n_words, n_removed, kept_sha256, kept, spans).

    `kept` is the words left of a changed document and `spans` says which went, both NULL for others.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    scanned = kept(_digests(rows), "word-digests")
    # Written apart, so that the join below may split a hot group of copies.
    least = kept(scanned.groupBy("words_sha").agg(F.min("doc_id").alias("_least")), "least-of-equal")
    scanned = kept(
        scanned.join(least, "words_sha")
        .withColumn("is_first", F.coalesce(F.col("doc_id") == F.col("_least"), F.lit(False)))
        .drop("_least"),
        "first-of-equal",
    )
    first = scanned.filter("is_first").select("doc_id", "key")
    repeats = _remove(find_repeats(rows, first, window, gram, shard_windows, task_words), window)
    repeats = repeats.withColumn("sha", F.sha2("kept", 256)).dropDuplicates(["doc_id", "key"])
    whole = F.col("doc_id").isNotNull() & ~F.col("is_first") & (F.col("n_words") >= window)
    joined = scanned.join(repeats, ["doc_id", "key"], "left")
    return joined.select(
        "doc_id",
        "words_sha",
        "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(NOTHING)).otherwise(F.coalesce("sha", "words_sha")).alias("kept_sha256"),
        F.when(whole, F.lit("")).otherwise(F.col("kept")).alias("kept"),
        F.when(whole, F.array(F.lit(0), F.col("n_words").cast("int"))).otherwise(F.col("spans")).alias("spans"),
    )


@F.arrow_udf(StringType())
def _without_words(text: pa.Array, spans: pa.Array) -> pa.Array:
    rows = zip(text.to_pylist(), spans.to_pylist())
    return pa.array([None if s is None else without_words(t or "", s) for t, s in rows], pa.string())


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of `docs` with repeated spans cut out of their texts, the rest as it was; a row is known by its id and its words."""
    left = dedup_substrings(docs, id_column=id_column, text_column=text_column, **options)
    this_id, sha, spans = (free_name(docs, c) for c in ("_id", "_sha", "_spans"))
    changed = kept(
        left.filter("n_removed > 0")
        .select(F.col("doc_id").alias(this_id), F.col("words_sha").alias(sha), F.col("spans").alias(spans))
        .dropDuplicates([this_id, sha]),
        "cut-spans",
    )
    text = F.col(text_column).cast("string")
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    same = (F.col(id_column).cast("long") == F.col(this_id)) & (F.sha2(F.concat_ws(" ", words), 256) == F.col(sha))
    joined = docs.join(changed, same, "left")
    # Only texts that change go through Python.
    cut = _without_words(F.when(F.col(spans).isNotNull(), text), F.col(spans))
    return joined.withColumn(text_column, F.coalesce(cut, text)).select(docs.columns)

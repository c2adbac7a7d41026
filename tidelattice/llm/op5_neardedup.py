"""Near-duplicate classes by ProbMinHash, banding and verification.

A document is its five-word shingles with weights.  In a signature each shingle
is a Poisson process whose rate is its weight; arrivals fall on random
registers, a register keeps the shingle that arrives first, and a shingle stops
as soon as its next arrival is later than every register's.  Two registers
agree with the probability Jaccard similarity of the weighted shingles.

The weights are 1, and similarity then is the Jaccard similarity of distinct
shingles, or, with `weighted`, how often each shingle occurs.  Candidates,
tests and links follow the same weights, because a signature by other weights
than those that decide a link would lose links.

Bands of `BAND` registers make the buckets.  With 40 bands of 6, a pair at 0.8
misses all of them with probability 5e-6.  Pairs whose registers estimate far
less than the threshold are passed over, and so are pairs that differ in too
many shingles: each text has `PARITY` bits, a shingle flips one of them, and two
texts differ in at least as many shingles as bits, so this test loses no link.
Links are pairs from one bucket whose exact similarity is at least `threshold`;
classes are the connected components.  A link is lost only if it meets in no
band or fails the register test, with probabilities of some 1e-6 each at the
threshold and less above it; all other tests are exact.  No bucket is expanded
into all pairs:

1. documents with equal words stand for one;
2. every member of a bucket meets `CENTRES` members, chosen by hash, and
   verified links join them into classes;
3. documents of buckets that still hold several classes meet by rare shingles,
   across classes only; links inside a class can change nothing.  All shingles
   are put in one order, those of a single class first, then by the number of
   documents that hold them.  Texts that are linked share one of the first
   n - ceil(threshold n) + 1 of their n shingles (of the weight, if weighted), and
   the first one that they share stands so early in both that enough can still
   follow.  Only pairs that pass both tests are made, so a crowd of documents just
   below the threshold, each with edits of its own, hardly meets at all.

Defined results: a text of fewer than five words is one shingle; NULL and
empty texts have no shingles and are classes of their own; rows that share a
doc_id share its class; a NULL doc_id has a NULL class; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import PLAIN, Words, grams, list_column, mix, signed, span_hashes, split_words, text_slices
from .stages import free_name, kept, small_or_plain

SHINGLE, THRESHOLD = 5, 0.8
BANDS, BAND = 40, 6
CENTRES = 6
SCAN_BYTES, PAIRS_AT_ONCE = 1 << 18, 64
# Registers are compared by four bits each.  Of 240, a pair at 0.8 agrees on 195, with a deviation of 6; four and a
# half deviations off, below 168, a pair is not verified.
PLANES, WIDTH, DEVIATIONS = 4, 60, 4.5
PARITY = 1024
BROADCAST_ROWS = 200_000


def shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes and the text of each; a text shorter than a shingle is one."""
    hashes, ok = grams(words, size)
    at = np.flatnonzero(ok)
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    whole = span_hashes(words.hashes, words.first[short], words.first[short + 1])
    return np.concatenate([hashes[at], whole]), np.concatenate([words.text_of[at], short])


def distinct(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, their texts, and how often they occur there."""
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[fresh], text[fresh], np.diff(np.append(np.flatnonzero(fresh), len(hashes)))


def signatures(hashes: np.ndarray, text: np.ndarray, texts: int, registers: int, weighted: bool = False) -> np.ndarray:
    """ProbMinHash signatures, one row of `registers` shingle hashes per text."""
    hashes, text, counts = distinct(hashes, text)
    return arrivals(hashes, text, counts if weighted else np.ones(len(hashes)), texts, registers)


def arrivals(hashes: np.ndarray, text: np.ndarray, rates: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """The first shingle to arrive at each register, of distinct shingles with these rates."""
    earliest = np.full(texts * registers, np.inf)
    winner = np.zeros(texts * registers, np.uint64)
    latest = np.full(texts, np.inf)  # of the earliest arrivals of a text's registers
    at, time, turn = np.arange(len(hashes)), np.zeros(len(hashes)), 0
    while len(at):
        turn += 1
        drawn = mix(hashes[at] + np.uint64((turn * 0xD1342543DE82EF95) & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) / 2**53) / rates[at]
        early = time < latest[text[at]]
        at, time, drawn = at[early], time[early], drawn[early]
        place = text[at] * registers + (mix(drawn) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(earliest, place, time)
        won = earliest[place] == time
        winner[place[won]] = hashes[at[won]]
        latest = earliest.reshape(texts, registers).max(1)
    return winner.reshape(texts, registers)


def probability_jaccard(a: np.ndarray, of_a: np.ndarray, b: np.ndarray, of_b: np.ndarray) -> float:
    """Probability Jaccard similarity of two weighted sets of distinct hashes.

    The sum over shared x of 1 / sum over y of max(a_y / a_x, b_y / b_x).  In order of a / b the larger term is b's before x and
    a's from x on, so running sums give all the inner ones.
    """
    _, at_a, at_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    mine, other = of_a[at_a].astype(np.float64), of_b[at_b].astype(np.float64)
    order = np.argsort(mine / other)
    mine, other = mine[order], other[order]
    from_here = of_a.sum() - mine.sum() + np.cumsum(mine[::-1])[::-1]
    before = of_b.sum() - other.sum() + np.cumsum(other) - other
    return float((1 / (from_here / mine + before / other)).sum())


def band_keys(winners: np.ndarray, band: int) -> np.ndarray:
    """One key per band and text."""
    texts, registers = winners.shape
    groups = winners.reshape(texts, registers // band, band)
    keys = np.broadcast_to(np.arange(registers // band, dtype=np.uint64), groups.shape[:2]).copy()
    for k in range(band):
        keys = mix(keys * np.uint64(31) + groups[:, :, k])
    return keys


def parities(hashes: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """`PARITY` bits per text, of which every distinct shingle flips one."""
    out = np.zeros(texts * (PARITY // 64), np.uint64)
    bit = (mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(PARITY)).astype(np.int64)
    np.bitwise_xor.at(out, text * (PARITY // 64) + bit // 64, np.uint64(1) << (bit % 64).astype(np.uint64))
    return out.reshape(texts, -1)


def sketches(winners: np.ndarray) -> np.ndarray:
    """Four bits per register, as bit planes of `WIDTH` registers to a number; registers left over are not compared."""
    winners = winners[:, : winners.shape[1] // WIDTH * WIDTH]
    bits = mix(winners).reshape(len(winners), 1, winners.shape[1] // WIDTH, WIDTH) >> np.arange(PLANES, dtype=np.uint64)[:, None, None]
    planes = ((bits & np.uint64(1)) << np.arange(WIDTH, dtype=np.uint64)).sum(3, dtype=np.uint64)
    return planes.reshape(len(winners), PLANES * planes.shape[2])


def _scan(rows: DataFrame, shingle: int, bands: int, band: int, weighted: bool) -> DataFrame:
    """(doc_id, words_sha, keys, sketch): NULL sha and no keys for a text without words.

    A sketch is the register bits, then the parity bits, then the number of distinct shingles.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch.column(1), SCAN_BYTES):
                words = split_words(part, PLAIN)
                texts = part.last - part.first
                hashes, text, counts = distinct(*shingles(words, shingle))
                winners = arrivals(hashes, text, counts if weighted else np.ones(len(hashes)), texts, bands * band)
                sizes = np.bincount(text, minlength=texts).astype(np.uint64)
                keys = band_keys(winners, band)
                bits = np.concatenate([sketches(winners), parities(hashes, text, texts), sizes[:, None]], axis=1)
                there = words.counts > 0
                raw, at = part.data.tobytes(), part.offsets.tolist()
                shas = [hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest() for a, b in zip(at, at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, texts),
                        pa.array(shas, pa.string(), mask=~there),
                        list_column(signed(keys[there].reshape(-1)), there * bands, pa.int64()),
                        list_column(signed(bits.reshape(-1)), np.full(texts, bits.shape[1]), pa.int64()),
                    ],
                    names=["doc_id", "words_sha", "keys", "sketch"],
                )

    return rows.mapInArrow(scan, "doc_id long, words_sha string, keys array<long>, sketch array<long>")


def _alike(x: str, y: str, numbers: int, threshold: float, weighted: bool):
    """Whether two sketches allow a link; sizes and parities speak of distinct shingles only."""
    size, bits = numbers * WIDTH, numbers * PLANES
    equal = threshold + (1 - threshold) / 2**PLANES
    least = math.ceil(max(0.0, size * equal - DEVIATIONS * math.sqrt(size * equal * (1 - equal))))

    def apart(k: int):
        return F.col(x)[k].bitwiseXOR(F.col(y)[k])

    def differing(k: int):
        planes = [apart(p * numbers + k) for p in range(PLANES)]
        return F.bit_count(planes[0].bitwiseOR(planes[1]).bitwiseOR(planes[2]).bitwiseOR(planes[3]))

    end = bits + PARITY // 64
    total, gap = F.col(x)[end] + F.col(y)[end], F.abs(F.col(x)[end] - F.col(y)[end])
    odd = sum((F.bit_count(apart(k)) for k in range(bits, end)), F.lit(0))
    most = total * ((1 - threshold) / (1 + threshold)) + 1e-6  # shingles that only one of two linked texts may have
    agree = sum((differing(k) for k in range(numbers)), F.lit(0)) <= size - least
    return agree if weighted else (gap <= most) & (odd <= most) & agree


def _verify(pairs: DataFrame, texts: DataFrame, shingle: int, threshold: float, weighted: bool) -> DataFrame:
    """The (a, b) pairs that are similar enough, by their whole texts."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, PAIRS_AT_ONCE) for b in batches for at in range(0, b.num_rows, PAIRS_AT_ONCE)):
            sets = []
            for side in (2, 3):
                found = {}
                for part in text_slices(batch.column(side), SCAN_BYTES):
                    hashes, text = shingles(split_words(part, PLAIN), shingle)
                    order = np.argsort(text, kind="stable")
                    bounds = np.searchsorted(text[order], np.arange(part.last - part.first + 1))
                    hashes = hashes[order]
                    for k in range(part.last - part.first):
                        found[part.first + k] = np.unique(hashes[bounds[k] : bounds[k + 1]], return_counts=True)
                sets.append(found)
            near = np.zeros(len(batch), bool)
            for row in range(len(batch)):
                (a, of_a), (b, of_b) = sets[0][row], sets[1][row]
                if weighted:
                    near[row] = probability_jaccard(a, of_a, b, of_b) >= threshold - 1e-12
                elif min(len(a), len(b)) >= threshold * max(len(a), len(b)):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    near[row] = both >= threshold * (len(a) + len(b) - both)
            yield batch.select(["a", "b"]).filter(pa.array(near))

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(compare, "a long, b long")


def _rare_meetings(rows: DataFrame, shingle: int, threshold: float, weighted: bool) -> DataFrame:
    """Pairs (a, b) of documents of different classes that may be linked, by the first shingle that they share.

    `rows` has doc_id, class_id and text.  `n` is a text's weight and `pos` the weight before a shingle.  What two texts may
    still share from their first common shingle on is at most what is left of either; the probability Jaccard similarity is
    at most the overlap of both weights as shares, so it too needs `threshold` of either weight left.
    """

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch.column(3), SCAN_BYTES):
                hashes, text, counts = distinct(*shingles(split_words(part, PLAIN), shingle))
                weights = counts if weighted else np.ones(len(hashes), np.int64)
                at = pa.array(text + part.first)
                sizes = np.bincount(text, weights, part.last - part.first).astype(np.int64)
                columns = [pa.array(sizes[text], pa.int32()), pa.array(weights, pa.int32()), pa.array(signed(hashes))]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).take(at) for k in range(3)), *columns],
                    names=["set_id", "doc_id", "class_id", "n", "weight", "shingle"],
                )

    sets = rows.select(F.xxhash64("doc_id", "text").alias("set_id"), "doc_id", "class_id", "text")
    held = sets.mapInArrow(spread, "set_id long, doc_id long, class_id long, n int, weight int, shingle long")
    shared = held.groupBy("shingle").agg(F.min("class_id").alias("_a"), F.max("class_id").alias("_b"), F.count(F.lit(1)).alias("df"))
    shared = kept(shared.filter("_a < _b").select("shingle", "df"), "shared-shingles")
    mine = Window.partitionBy("set_id")
    placed = held.join(small_or_plain(shared, most=BROADCAST_ROWS), "shingle").select(
        "*",
        F.sum("weight").over(mine.orderBy("df", "shingle").rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"),
        F.sum("weight").over(mine).alias("_shared"),
    )
    pos = F.col("n") - F.col("_shared") + F.col("_upto") - F.col("weight")
    first = F.col("n") - F.ceil(F.col("n") * threshold - 1e-6)
    prefix = kept(placed.withColumn("pos", pos).filter(F.col("pos") <= first).select("shingle", "doc_id", "class_id", "n", "pos"), "prefixes")
    other = prefix.select("shingle", *[F.col(c).alias(f"_{c}") for c in ("doc_id", "class_id", "n", "pos")])
    needed = F.ceil((F.col("n") + F.col("_n")) * (threshold / (1 + threshold)) - 1e-6)
    left = F.least(F.col("n") - F.col("pos"), F.col("_n") - F.col("_pos"))
    meet = (prefix["shingle"] == other["shingle"]) & (F.col("class_id") < F.col("_class_id"))
    if not weighted:
        meet &= left >= needed
    return (
        prefix.join(other, meet)
        .select(F.least("doc_id", "_doc_id").alias("a"), F.greatest("doc_id", "_doc_id").alias("b"))
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(doc_id, class_id) of all linked documents, the least id of each connected component.

    Every document points to the least one beside it, pointers are followed to their roots, and links between roots are all
    that the next round sees.  A root that takes in none of its neighbours is one no longer after another round, so two
    rounds at least halve what is left, and the links of a crowd around few centres are gone after the first.
    """
    edges = kept(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while True:
        ends = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        roots = _roots(ends.groupBy("a").agg(F.least("a", F.min("b")).alias("class_id")).withColumnRenamed("a", "doc_id"))
        labels = roots if labels is None else kept(_over(labels, roots), "labels")
        edges = kept(_between(edges, roots), "links")
        if not edges.limit(1).count():
            return labels


def _roots(pointers: DataFrame) -> DataFrame:
    """Where the pointers (doc_id, class_id) end; each step doubles the way."""
    roots = kept(pointers, "labels")
    while True:
        up = roots.select(F.col("doc_id").alias("class_id"), F.col("class_id").alias("up"))
        new = roots.join(up, "class_id").select("doc_id", F.col("up").alias("class_id"), F.col("class_id").alias("before"))
        new = kept(new, "labels")
        changed = new.filter("class_id < before").limit(1).count()
        roots = new.drop("before")
        if not changed:
            return roots


def _over(labels: DataFrame, roots: DataFrame) -> DataFrame:
    """The labels with classes replaced by their roots; a class without one stays."""
    up = roots.select(F.col("doc_id").alias("class_id"), F.col("class_id").alias("root"))
    return labels.join(up, "class_id", "left").select("doc_id", F.coalesce("root", "class_id").alias("class_id"))


def _between(links: DataFrame, labels: DataFrame) -> DataFrame:
    """The links (a, b) of different classes, as pairs of classes; a document without a label is its own."""
    a, b = F.coalesce("_a", "a"), F.coalesce("_b", "b")
    return (
        links.join(labels.select(F.col("doc_id").alias("a"), F.col("class_id").alias("_a")), "a", "left")
        .join(labels.select(F.col("doc_id").alias("b"), F.col("class_id").alias("_b")), "b", "left")
        .filter(a != b)
        .select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .distinct()
    )


def near_classes(
    docs: DataFrame,
    shingle: int = SHINGLE,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    band: int = BAND,
    weighted: bool = False,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, copy_of, class_id): least ids of the documents with the same words, and of the whole class."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    scanned = kept(_scan(rows, shingle, bands, band, weighted), "shingle-bands")
    firsts = kept(
        scanned.filter("words_sha IS NOT NULL").groupBy("words_sha").agg(F.min("doc_id").alias("copy_of")), "first-copies"
    )
    standing = scanned.join(firsts.select(F.col("copy_of").alias("doc_id")).distinct(), "doc_id", "left_semi")
    members = kept(standing.select("doc_id", F.explode("keys").alias("bucket")).distinct(), "bucket-members")

    ranks = [F.struct(F.xxhash64("doc_id", F.lit(k)).alias("rank"), "doc_id") for k in range(CENTRES - 1)]
    crowded = members.groupBy("bucket").agg(
        F.min("doc_id").alias("_0"), F.max("doc_id").alias("_last"), *[F.min(r).alias(f"_{k + 1}") for k, r in enumerate(ranks)]
    )
    centres = kept(
        crowded.filter("_0 < _last").select(
            "bucket", F.array_distinct(F.array("_0", *[f"_{k + 1}.doc_id" for k in range(CENTRES - 1)])).alias("centres")
        ),
        "bucket-centres",
    )
    pairs = (
        members.join(centres, "bucket")
        .select("doc_id", F.explode("centres").alias("centre"))
        .filter("doc_id != centre")
        .select(F.least("doc_id", "centre").alias("a"), F.greatest("doc_id", "centre").alias("b"))
        .distinct()
    )
    numbers = bands * band // WIDTH
    sketch = kept(standing.select("doc_id", "sketch").distinct(), "sketches")
    pairs = (
        pairs.join(sketch.select(F.col("doc_id").alias("a"), F.col("sketch").alias("_x")), "a")
        .join(sketch.select(F.col("doc_id").alias("b"), F.col("sketch").alias("_y")), "b")
        .filter(_alike("_x", "_y", numbers, threshold, weighted))
        .select("a", "b")
        .distinct()
    )
    pairs = kept(pairs, "centre-pairs")

    crowd = members.join(centres.select("bucket"), "bucket", "left_semi")
    ids = kept(crowd.select("doc_id").distinct(), "candidate-ids")
    texts = rows.join(small_or_plain(ids), "doc_id", "left_semi").withColumn("_hash", F.xxhash64("text"))
    # Several texts of one doc_id all stand for it.
    texts = kept(texts.dropDuplicates(["doc_id", "_hash"]).drop("_hash"), "candidate-texts")
    links = kept(_verify(pairs, texts, shingle, threshold, weighted), "centre-links")
    classes = components(links)

    def class_of(frame: DataFrame) -> DataFrame:
        return frame.join(classes, "doc_id", "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))

    placed = kept(class_of(crowd), "crowd-classes")
    mixed = placed.groupBy("bucket").agg(F.min("class_id").alias("_a"), F.max("class_id").alias("_b")).filter("_a < _b")
    placed = placed.join(kept(mixed.select("bucket"), "mixed-buckets"), "bucket", "left_semi").select("doc_id", "class_id").distinct()
    placed = texts.join(small_or_plain(kept(placed, "mixed-members")), "doc_id")
    across = _rare_meetings(placed, shingle, threshold, weighted)
    across = (
        across.join(pairs, ["a", "b"], "left_anti")
        .join(sketch.select(F.col("doc_id").alias("a"), F.col("sketch").alias("_x")), "a")
        .join(sketch.select(F.col("doc_id").alias("b"), F.col("sketch").alias("_y")), "b")
        .filter(_alike("_x", "_y", numbers, threshold, weighted))
        .select("a", "b")
        .distinct()
    )
    more = kept(_verify(kept(across, "cross-pairs"), texts, shingle, threshold, weighted), "cross-links")
    named = scanned.select("doc_id", "words_sha").join(firsts, "words_sha", "left")
    named = named.withColumn("copy_of", F.coalesce("copy_of", "doc_id"))
    named = named.join(classes.withColumnRenamed("doc_id", "copy_of"), "copy_of", "left")
    named = named.withColumn("class_id", F.coalesce("class_id", "copy_of"))
    if more.limit(1).count():
        merged = components(_between(more, classes)).withColumnRenamed("class_id", "root")
        named = named.join(merged.withColumnRenamed("doc_id", "class_id"), "class_id", "left")
        named = named.withColumn("class_id", F.coalesce("root", "class_id"))
    return named.select("doc_id", "copy_of", F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The rows of `docs` that stand for their class: those of the least doc_id, equal words once.

    A row is known by doc_id and words: one id with several texts keeps each of them.  Rows without an id go if a row
    with an id has the same words; of the others, equal words stay once, and texts without words all stay.
    """
    classes = kept(near_classes(docs, id_column=id_column, text_column=text_column, **options), "near-classes")
    gone_id, sha_name = free_name(docs, "_id"), free_name(docs, "_words_sha")
    gone = classes.filter("class_id < doc_id").select(F.col("doc_id").alias(gone_id)).distinct()
    this = F.col(id_column).cast("long") == F.col(gone_id)
    left = docs.join(small_or_plain(kept(gone, "near-copies")), this, "left_anti")
    repeated = classes.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1")
    if repeated.limit(1).count() or classes.filter("doc_id IS NULL").limit(1).count():
        words = F.filter(F.split(F.col(text_column).cast("string"), r"[\x09-\x0D\x20]+"), lambda w: w != "")
        sha = F.when(F.size(words) > 0, F.sha2(F.concat_ws(" ", words), 256))
        named = F.col(id_column).isNotNull()
        left = left.withColumn(sha_name, sha)
        nameless = left.filter(~named & F.col(sha_name).isNotNull()).dropDuplicates([sha_name])
        nameless = nameless.join(docs.filter(named).select(sha.alias(sha_name)).distinct(), sha_name, "left_anti")
        left = (
            left.filter(named)
            .dropDuplicates([id_column, sha_name])
            .unionByName(nameless)
            .unionByName(left.filter(~named & F.col(sha_name).isNull()))
            .select(docs.columns)
        )
    return left

"""Quality rules: an isolation forest on rule statistics.

One pass over whole texts counts the rule statistics.  Documents that break a
base rule are out.  The others are described by a few ratios of the
statistics; an isolation forest, grown on a bounded sample of documents, gives
each an anomaly score from its mean path length over random splits (short
paths: easily told apart).  The score above which a document is rejected is
calibrated on all labelled rows: the cut with the best balance of rejected bad
and kept good rows that rejects at most `MAX_LOSS` of the good ones.

Defined results: NULL and empty texts have no words and fail the base rules;
texts of any length are counted whole; repeated rows get equal verdicts; without
labelled rows the forest rejects nothing; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import PLAIN, covered, grams, mix, runs, span_hashes, split_words, text_slices
from .arrays import _BYTE_VALUES as BYTE_VALUES
from .stages import fixed_sample, kept

TREES, PER_TREE, SAMPLE = 200, 256, 20_000
MAX_LOSS = 0.01
BINS = 4000
MIN_WORDS, MAX_REPEAT_SHARE, REPEAT_WINDOW = 10, 20, 5
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
UPPER = np.isin(np.arange(256), np.arange(ord("A"), ord("Z") + 1))
CONTINUES = (np.arange(256) & 0xC0) == 0x80

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper")
# Ratios that the forest splits on.  Repeats are left to the base rule: they are rare in good documents too.
FEATURES = {
    "symbols a character": "n_symbols / word_chars",
    "symbols a word": "n_symbols / n_words",
    "capitals a character": "n_upper / word_chars",
    "characters a word": "word_chars / n_words",
}


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offsets])


def _repeats(keys: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry whether its key occurs again in its group, and whether it occurred before."""
    both = mix(keys ^ mix(group.astype(np.uint64) + np.uint64(1)))
    _, first, code, count = np.unique(both, return_index=True, return_inverse=True, return_counts=True)
    again = np.ones(len(both), bool)
    again[first] = False
    return count[code] > 1, again


def count_column(column: pa.Array) -> dict[str, np.ndarray]:
    """The rule statistics of every text of a column."""
    out = {name: np.zeros(len(column), np.int64) for name in COUNTS}
    for part in text_slices(column):
        rows, data, offsets = slice(part.first, part.last), part.data, part.offsets
        texts = part.last - part.first
        words = split_words(part, PLAIN)
        out["n_words"][rows] = words.counts
        out["word_chars"][rows] = _per_text(PLAIN[data] & ~CONTINUES[data], offsets)
        for name, kind in (("n_symbols", SYMBOLS), ("n_upper", UPPER)):
            out[name][rows] = _per_text(kind[data], offsets)
        if not len(words.hashes):
            continue
        starts, ends = runs(data != 0x0A, offsets)
        with_word = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
        starts, ends = starts[with_word], ends[with_word]
        line_of = np.searchsorted(offsets, starts, "right") - 1
        _, again = _repeats(span_hashes(BYTE_VALUES[data], starts, ends), line_of)
        out["n_dup_lines"][rows] = np.bincount(line_of[again], minlength=texts)
        hashes, ok = grams(words, REPEAT_WINDOW)
        at = np.flatnonzero(ok)
        twice, _ = _repeats(hashes[at], words.text_of[at])
        hits = np.zeros(len(hashes), bool)
        hits[at[twice]] = True
        inside = covered(hits, REPEAT_WINDOW, len(words.hashes))
        out["n_repeat_words"][rows] = np.bincount(words.text_of[inside], minlength=texts)
    return out


def statistics(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, the counts, base_failed, features)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = count_column(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(counts[c]) for c in COUNTS]], names=["doc_id", *COUNTS]
            )

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    counted = rows.mapInArrow(count, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_SHARE * F.col("n_words"))
    features = F.array(*[F.expr(f"CAST({f} AS DOUBLE)") for f in FEATURES.values()])
    return counted.withColumn("base_failed", failed).withColumn(
        "features", F.when(F.col("n_words") > 0, features)
    )


class Forest(NamedTuple):
    """Trees as flat arrays: children of node i stand at 2i + 1 and 2i + 2; feature -1 marks a leaf."""

    feature: np.ndarray
    split: np.ndarray
    path: np.ndarray  # depth of a leaf and the expected depth below it
    norm: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1): 2 to the minus mean path length over the expected one."""
        total = np.zeros(len(x))
        for feature, split, path in zip(self.feature, self.split, self.path):
            node = np.zeros(len(x), np.int64)
            while True:
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[np.arange(len(x)), np.maximum(f, 0)] >= split[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += path[node]
        return 2.0 ** (-total / len(self.feature) / self.norm)


def _expected(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n values."""
    if n <= 1:
        return 0.0
    return 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n if n > 2 else 1.0


def grow(x: np.ndarray, trees: int = TREES, per_tree: int = PER_TREE, seed: int = 0) -> Forest:
    """Random trees on random subsets: a random feature, a random split within its extent, to the usual depth."""
    random = np.random.default_rng(seed)
    size = min(per_tree, len(x))
    depth = max(1, int(np.ceil(np.log2(max(2, size)))))
    nodes = 2 ** (depth + 1) - 1
    feature, split, path = np.full((trees, nodes), -1), np.zeros((trees, nodes)), np.zeros((trees, nodes))
    for t in range(trees):
        todo = [(0, 0, x[random.choice(len(x), size, replace=False)])]
        while todo:
            node, level, rows = todo.pop()
            low, high = rows.min(0), rows.max(0)
            usable = np.flatnonzero(high > low)
            if level == depth or len(rows) <= 1 or not len(usable):
                path[t, node] = level + _expected(len(rows))
                continue
            f = int(random.choice(usable))
            cut = random.uniform(low[f], high[f])
            right = rows[:, f] >= cut
            feature[t, node], split[t, node] = f, cut
            for child, part in ((2 * node + 1, rows[~right]), (2 * node + 2, rows[right])):
                if len(part):
                    todo.append((child, level + 1, part))
                else:
                    path[t, child] = level + 1
    return Forest(feature, split, path, _expected(size) or 1.0)


def with_scores(stats: DataFrame, forest: Forest) -> DataFrame:
    """Adds `anomaly` to rows with features; the others get NULL."""
    names = stats.columns

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(names.index("features"))
            there = np.asarray(column.is_valid())
            x = np.asarray(column.drop_null().flatten(), np.float64).reshape(-1, len(FEATURES))
            scores = np.full(len(batch), np.nan)
            scores[there] = forest.scores(x)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, mask=~there)], names=[*names, "anomaly"]
            )

    schema = ", ".join(f"`{c}` {t}" for c, t in stats.dtypes)
    return stats.mapInArrow(rate, f"{schema}, anomaly double")


def calibrate(scored: DataFrame, labels: DataFrame, label: str, id_column: str = "doc_id") -> float:
    """The score from which on documents are rejected, from all labelled rows that pass the base rules."""
    marked = (
        labels.select(F.col(id_column).cast("long").alias("doc_id"), F.col(label).cast("int").alias("_good"))
        .filter("doc_id IS NOT NULL AND _good IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("_good").alias("_good"))
    )
    bins = (
        scored.filter("NOT base_failed AND anomaly IS NOT NULL")
        .select("doc_id", F.floor(F.col("anomaly") * BINS).cast("int").alias("_bin"))
        .join(marked, "doc_id")
        .groupBy("_bin", "_good")
        .count()
        .collect()  # at most 2 x BINS rows
    )
    good, bad = np.zeros(BINS + 1), np.zeros(BINS + 1)
    for row in bins:
        (good if row["_good"] else bad)[row["_bin"]] += row["count"]
    if not good.sum() or not bad.sum():
        return float("inf")
    lost = np.cumsum(good[::-1])[::-1] / good.sum()
    caught = np.cumsum(bad[::-1])[::-1] / bad.sum()
    gain = np.where(lost <= MAX_LOSS, caught - lost, -1)
    best = int(np.argmax(gain))
    return best / BINS if gain[best] > 0 else float("inf")


def judge(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(doc_id, the counts, base_failed, anomaly, kept)."""
    stats = kept(statistics(docs, id_column, text_column), "rule-statistics")
    usable = stats.filter("NOT base_failed").select("doc_id", "n_words", "features")
    rows = fixed_sample(usable, SAMPLE, "doc_id", "n_words").collect()
    if not rows:
        return stats.withColumn("anomaly", F.lit(None).cast("double")).withColumn("kept", ~F.col("base_failed"))
    forest = grow(np.array([r["features"] for r in sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"]))]))
    scored = kept(with_scores(stats, forest), "rule-anomalies")
    cut = calibrate(scored, labels, label, id_column)
    return scored.withColumn(
        "kept", ~F.col("base_failed") & (F.col("anomaly").isNull() | (F.col("anomaly") < F.lit(cut)))
    )

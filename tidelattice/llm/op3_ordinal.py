"""Quality grades by ordinal regression: a cumulative-link model on hashed text.

A text is its words and word pairs (split at white space), hashed to `SLOTS`
slots; a slot holds ln(1 + count) and the whole has length one.  One weight per
slot is shared by all grades, and ordered thresholds part the grades:
P(grade <= k) = logistic(threshold k - weights . text).  The first threshold is
free and the others add positive steps, so they cannot cross.  Weights and
thresholds minimise the log loss plus a ridge penalty.

Fitted on at most `SAMPLE` labelled texts over all grades, as many of each
grade, none longer than `SAMPLE_BYTES`, chosen by a hash of doc_id and weighted
back to the share of their grade; held-out rows are never learned from.  All
documents are scored, whole.

Defined results: NULL and empty texts have no slots and get the grades that the
thresholds alone give; with fewer than two grades among the labels every
figure is NULL; repeated rows get equal figures; a doc_id with several labels
counts with its highest; a NULL doc_id is scored and not held out; an empty
table gives no rows.  Grades are whole numbers and need not be consecutive.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import PLAIN, grams, mix, split_words, text_slices
from .stages import fixed_sample
from .op8_toxicity import held_out

SLOTS = 1 << 16
SAMPLE, SAMPLE_BYTES = 6000, 1 << 16
SCAN_BYTES = 1 << 20
RIDGE, STEPS, RATE = 1e-5, 150, 0.3


class Slots(NamedTuple):
    """Filled slots of some texts, text by text."""

    text: np.ndarray
    slot: np.ndarray
    value: np.ndarray


class Model(NamedTuple):
    grades: np.ndarray  # ascending
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades


def slots(column: pa.Array) -> Iterator[tuple[int, int, Slots]]:
    """(first row, row after, slots) for slices of a column; texts are numbered from the slice's first."""
    for part in text_slices(column, SCAN_BYTES):
        words, texts = split_words(part, PLAIN), part.last - part.first
        pairs, ok = grams(words, 2)
        hashes = np.concatenate([words.hashes, pairs[ok]])
        text = np.concatenate([words.text_of, words.text_of[: len(pairs)][ok]])
        at, count = np.unique(text * SLOTS + (mix(hashes) % np.uint64(SLOTS)).astype(np.int64), return_counts=True)
        text, value = at // SLOTS, np.log1p(count)
        length = np.sqrt(np.bincount(text, value**2, minlength=texts))
        yield part.first, part.last, Slots(text, at % SLOTS, value / length[text])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(texts: Sequence[str], grade: Sequence[int], share: dict[int, float]) -> Model:
    """A model from a sample and the share of each grade among all labelled rows."""
    grades, y = np.unique(np.asarray(grade), return_inverse=True)
    parts = [(first, s) for first, _, s in slots(pa.array(texts, pa.string()))]
    text = np.concatenate([first + s.text for first, s in parts])
    slot, value = (np.concatenate([s[k] for _, s in parts]) for k in (1, 2))
    n, cuts = len(y), len(grades) - 1
    weight = np.array([share[int(g)] for g in grades])[y] / np.bincount(y)[y]
    weight /= weight.sum()
    below = np.cumsum(np.bincount(y, weight))[:-1]
    start = np.log(below / (1 - below))
    # Parameters: slot weights, first threshold, logarithms of the steps.
    at = np.concatenate([np.zeros(SLOTS), start[:1], np.log(np.diff(start))])
    mean, square = np.zeros_like(at), np.zeros_like(at)
    for step in range(1, STEPS + 1):
        w, steps = at[:SLOTS], np.exp(at[SLOTS + 1 :])
        edges = np.concatenate([[-np.inf], at[SLOTS] + np.concatenate([[0.0], np.cumsum(steps)]), [np.inf]])
        score = np.bincount(text, value * w[slot], minlength=n)
        high, low = _logistic(edges[y + 1] - score), np.where(y == 0, 0.0, _logistic(edges[y] - score))
        high = np.where(y == cuts, 1.0, high)
        inside = np.maximum(high - low, 1e-12)
        up, down = weight * high * (1 - high) / inside, weight * low * (1 - low) / inside
        slope = np.empty_like(at)
        slope[:SLOTS] = np.bincount(slot, value * (up - down)[text], minlength=SLOTS) + RIDGE * w
        by_edge = np.bincount(y, down, minlength=cuts + 1)[1:] - np.bincount(y, up, minlength=cuts + 1)[:-1]
        tail = np.cumsum(by_edge[::-1])[::-1]
        slope[SLOTS], slope[SLOTS + 1 :] = tail[0], tail[1:] * steps
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        pace = RATE * (1 - step / (STEPS + 1))
        at -= pace * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return Model(grades, at[:SLOTS].copy(), at[SLOTS] + np.concatenate([[0.0], np.cumsum(np.exp(at[SLOTS + 1 :]))]))


def probabilities(column: pa.Array, model: Model) -> np.ndarray:
    """Probability of each grade for every text of a column."""
    score = np.zeros(len(column))
    for first, last, s in slots(column):
        score[first:last] = np.bincount(s.text, s.value * model.weights[s.slot], minlength=last - first)
    most = np.concatenate([_logistic(model.thresholds - score[:, None]), np.ones((len(score), 1))], axis=1)
    return np.diff(most, axis=1, prepend=0.0)


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_column: str = "doc_id", text_column: str = "text"
) -> Model | None:
    """Fit on a bounded sample of labelled rows that are not held out."""
    marked = (
        labels.select(F.col(id_column).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .filter("doc_id IS NOT NULL AND y IS NOT NULL")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
    )
    counts = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None
    most = max(1, SAMPLE // len(counts))
    # Smallest hashes first: a fixed sample however the rows are dealt out.
    chosen = None
    for y in sorted(counts):
        part = fixed_sample(marked.filter(F.col("y") == y), most, "doc_id")
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = (
        docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
        .filter(F.octet_length("text") <= SAMPLE_BYTES)
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "y")
        .agg(F.min("text").alias("text"))
        .collect()  # at most SAMPLE texts of SAMPLE_BYTES
    )
    rows.sort(key=lambda r: r["doc_id"])
    if len({r["y"] for r in rows}) < 2:
        return None
    total = sum(counts.values())
    return train([r["text"] for r in rows], [r["y"] for r in rows], {y: n / total for y, n in counts.items()})


def score(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, held_out, expected_grade, top_probability, grade) of every whole text.

    `top_probability` is the tail probability P(grade >= highest grade), `grade` the median grade.
    """

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(0), batch.column(1)]
            if model is None:
                columns += [pa.nulls(len(batch), t) for t in (pa.float64(), pa.float64(), pa.int32())]
            else:
                p = probabilities(batch.column(2), model)
                middle = model.grades[np.minimum((np.cumsum(p, axis=1) < 0.5).sum(1), len(model.grades) - 1)]
                columns += [pa.array(p @ model.grades), pa.array(p[:, -1]), pa.array(middle.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "expected_grade", "top_probability", "grade"])

    doc_id = F.col(id_column).cast("long")
    rows = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(rate, "doc_id long, held_out boolean, expected_grade double, top_probability double, grade int")

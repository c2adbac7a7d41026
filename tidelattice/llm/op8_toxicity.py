"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled text: one on ordinary
texts, one on what recurs in toxic texts and not in ordinary ones.  Each
window of a text (whole words, about `WINDOW_BYTES` bytes) is compressed with
the ordinary dictionary and with both of them; the bytes saved by the second
say how much of the window is toxic wording.  (Dictionaries trained on whole
windows of either class, and nothing else, tell the classes apart poorly: on
held-out rows their area under the curve is 0.70 to 0.79 for sizes from 16 KB to
1.5 MB, where this one has 0.97; ordinary wording fills both.)  The savings of
all windows of a document are summed up in a few figures, and a logistic curve
calibrated on labelled rows turns those into a score; its threshold of 0.5 is
placed where precision and recall of the calibration rows balance best (F1).

`predicted` is that balance and no ground for deleting a row: at it, clean rows
are lost too.  `accept` has a cut of its own, the least one that rejects at most
`MAX_LOSS` of clean rows, with a margin for the chance in the calibration rows.

Everything is fitted on at most `SAMPLE` labelled texts a class, none longer
than `SAMPLE_BYTES`, chosen by a hash of doc_id; a third of them calibrates.
All documents are scored whole.

Defined results: NULL and empty texts are one empty window; without labelled
rows of both classes every score is 0; repeated rows get equal scores; a NULL
doc_id is not held out; an empty table gives no rows.  Only the id and the
text of `docs`, and the id and the label column of `labels`, are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stages import fixed_sample

SAMPLE, SAMPLE_BYTES = 3000, 1 << 16
WINDOW_BYTES = 100
ORDINARY_BYTES, TOXIC_BYTES = 64_000, 4_000
MAX_LOSS = 0.01  # share of the clean rows that `accept` may reject
RECURRING = 0.008  # share of the toxic texts a word must be in
LEVEL = 3
FOLDS = 5
ROWS_AT_ONCE = 200
PUNCTUATION = b".,;:!?"


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def windows(text: bytes) -> list[bytes]:
    """Whole words, joined until they reach the window's size."""
    out, words, size = [], [], 0
    for word in text.split():
        words.append(word)
        size += len(word) + 1
        if size >= WINDOW_BYTES:
            out.append(b" " + b" ".join(words) + b" ")
            words, size = [], 0
    if words or not out:
        out.append(b" " + b" ".join(words) + b" ")
    return out


class Model(NamedTuple):
    ordinary: bytes
    both: bytes
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray  # intercept first
    reject: float  # the score above which `accept` rejects


def _bare(word: bytes) -> bytes:
    return word.lower().strip(PUNCTUATION)


def _train(samples: list[bytes], size: int, segment: int) -> bytes:
    """A trained dictionary's content; of samples too few to train on, their last bytes."""
    samples = [s for s in samples if len(s) > 8]
    try:
        trained = zstandard.train_dictionary(size, samples, level=LEVEL, k=segment, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]
    return trained[min(150, len(trained) // 2) :]  # without the entropy tables in front


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if len(content) < 8:
        return zstandard.ZstdCompressor(level=LEVEL, **options)
    raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    raw.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, **options)


class Savings:
    """Figures of a text's windows: bytes that the toxic dictionary saves."""

    def __init__(self, ordinary: bytes, both: bytes) -> None:
        self.plain, self.wide = _compressor(ordinary).compress, _compressor(both).compress

    def figures(self, text: bytes) -> list[float]:
        parts = windows(text)
        saved = np.fromiter((len(self.plain(w)) - len(self.wide(w)) for w in parts), np.float64, len(parts))
        top = np.sort(saved)[::-1]
        shares = [float((saved >= least).mean()) for least in (3, 5, 8)]
        return [top[0], top[:2].mean(), top[:4].mean(), saved.mean(), saved.std(), np.log(len(parts)), *shares]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weighted logistic regression by Newton's method."""
    design = np.c_[np.ones(len(x)), x]
    w = np.zeros(design.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (weight * (y - p)) - ridge * w
        curve = design.T @ (design * (weight * p * (1 - p))[:, None]) + ridge * np.eye(len(w))
        w += np.linalg.solve(curve, slope)
    return w


def _best_cut(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The cut with the best F1 of label 1."""
    order = np.argsort(-logit, kind="stable")
    hit, all_ = np.cumsum((weight * y)[order]), np.cumsum(weight[order])
    best = int(np.argmax(2 * hit / (all_ + (weight * y).sum())))
    nearest = logit[order[min(best + 1, len(order) - 1)]]
    return float((logit[order[best]] + nearest) / 2)


def _probability(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _reject_cut(clean: np.ndarray) -> float:
    """The least score, 0.5 or more, that few enough clean scores exceed; without clean rows, 1.

    Few enough is `MAX_LOSS` of them less 1.645 deviations of that number, and none of a small sample.
    """
    if not len(clean):
        return 1.0
    most = MAX_LOSS * len(clean)
    falling = np.sort(clean)[::-1]
    return max(0.5, float(falling[max(0, int(most - 1.645 * most**0.5))]))


def train(toxic: Sequence[str], ordinary: Sequence[str], share_toxic: float) -> Model | None:
    """A model from two samples and the share of toxic rows among all labelled ones."""
    if not toxic or not ordinary:
        return None
    toxic, ordinary = [t.encode() for t in toxic], [t.encode() for t in ordinary]
    fit_o = [t for i, t in enumerate(ordinary) if i % 3] or ordinary
    fit_t = [t for i, t in enumerate(toxic) if i % 3] or toxic
    known = {_bare(w) for t in fit_o for w in t.split()}
    left = [[w for w in map(_bare, t.split()) if w not in known] for t in fit_t]
    spread_over = Counter(w for words in left for w in set(words))
    least = max(2, RECURRING * len(fit_t))
    left = [b" " + b" ".join(w for w in words if spread_over[w] >= least) + b" " for words in left]
    plain = _train([w for t in fit_o for w in windows(t)], ORDINARY_BYTES, 32)
    both = plain + _train(left, TOXIC_BYTES, 16)

    cal_t = [t for i, t in enumerate(toxic) if not i % 3]
    cal_o = [t for i, t in enumerate(ordinary) if not i % 3]
    measure = Savings(plain, both)
    x = np.array([measure.figures(t) for t in cal_t + cal_o])
    y = np.r_[np.ones(len(cal_t)), np.zeros(len(cal_o))]
    weight = np.where(y == 1, share_toxic / len(cal_t), (1 - share_toxic) / len(cal_o)) * len(y)
    centre, spread = x.mean(0), x.std(0) + 1e-9
    x = (x - centre) / spread
    weights = _logistic(x, y, weight)
    weights[0] -= _best_cut(weights[0] + x @ weights[1:], y, weight)
    clean = _probability(weights[0] + x[y == 0] @ weights[1:])
    return Model(plain, both, centre, spread, weights, _reject_cut(clean))


def _shuffled(doc_id: int) -> int:
    """A fixed shuffle, so that the thirds of a sample are alike."""
    return (doc_id * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_column: str = "doc_id", text_column: str = "text"
) -> Model | None:
    """Fit on a bounded sample of labelled rows that are not held out."""
    marked = (
        labels.select(F.col(id_column).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .filter("doc_id IS NOT NULL AND y IN (0, 1)")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
    )
    counts = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return None
    # Smallest hashes first: a fixed sample however the rows are dealt out.  Ids are sampled before texts are joined.
    chosen = [fixed_sample(marked.filter(F.col("y") == y), SAMPLE, "doc_id") for y in (0, 1)]
    texts = (
        docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
        .filter(F.octet_length("text") <= SAMPLE_BYTES)
        .join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")
        .groupBy("doc_id", "y")
        .agg(F.min("text").alias("text"))
    )
    rows = texts.collect()  # at most 2 x SAMPLE texts of SAMPLE_BYTES
    rows.sort(key=lambda r: _shuffled(r["doc_id"]))
    by = {y: [r["text"] for r in rows if r["y"] == y] for y in (0, 1)}
    return train(by[1], by[0], counts[1] / (counts[0] + counts[1]))


def _column_scores(column: pa.Array, model: Model, measure: Savings) -> np.ndarray:
    """Scores of a column, a few texts at a time."""
    parts = [_scores(column.slice(at, ROWS_AT_ONCE).to_pylist(), model, measure) for at in range(0, len(column), ROWS_AT_ONCE)]
    return np.concatenate([np.zeros(0), *parts])


def _scores(texts: Sequence[str | None], model: Model, measure: Savings) -> np.ndarray:
    if not len(texts):
        return np.zeros(0)
    x = np.array([measure.figures((t or "").encode()) for t in texts])
    logit = model.weights[0] + ((x - model.centre) / model.spread) @ model.weights[1:]
    return _probability(logit)


def accept(docs: DataFrame, model: Model | None, text_column: str = "text") -> DataFrame:
    """The rows of `docs`, unchanged, whose score is not above the model's rejection cut."""
    if model is None:
        return docs
    at = docs.columns.index(text_column)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Savings(model.ordinary, model.both)
        for batch in batches:
            yield batch.filter(pa.array(_column_scores(batch.column(at), model, measure) <= model.reject))

    return docs.mapInArrow(keep, docs.schema)


def score(docs: DataFrame, model: Model | None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        measure = Savings(model.ordinary, model.both) if model else None
        for batch in batches:
            scores = _column_scores(batch.column(2), model, measure) if model else np.zeros(len(batch))
            columns = [batch.column(0), batch.column(1), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score"])

    doc_id = F.col(id_column).cast("long")
    rows = docs.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text_column).cast("string").alias("text"))
    scored = rows.mapInArrow(rate, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

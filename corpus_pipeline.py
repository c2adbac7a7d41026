"""A training corpus from raw documents: five operators, each stage written before the next one reads it.

Stages take (spark, docs, sf_dir) and work on all rows that their predecessor
kept.  Each sets the session's defaults itself, so that one that is called alone
hands Python batches of the same few MB.  All but the last return the columns of
documents:

* toxicity: fitted on the labelled rows among the documents; those above its rejection cut go, which is set to lose at
  most op8's MAX_LOSS of clean documents
* near_dedup: one document of each class of near copies stays
* substring_dedup: spans of 13 words and more that a smaller doc_id has are cut out of the text
* decontamination: documents with passages of the benchmark go
* packing: sequences of 1024 token ids

Rows in every stage: NULL and empty texts are clean, belong to no class but
their own, lose nothing, and pack as an end id alone.  Very long texts are read
whole.  A row is known by its doc_id and text: rows that repeat both are copies,
of which near_dedup keeps one; several texts of one doc_id are judged one by
one.  Rows with a NULL doc_id go in near_dedup if another row has their words,
and keep their text in substring_dedup.  Tables may be empty, and columns beyond
doc_id and text may have any name; n_chars follows the text if there is one.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelattice.llm import op1_decontamination, op2_substrings, op5_neardedup, op8_toxicity, op9_packing
from tidelattice.llm.queries import vocabulary
from tidelattice.llm.stages import kept, table
from tidelattice.session import apply_defaults

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def with_defaults(stage: Stage) -> Stage:
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(apply_defaults(spark), docs, sf_dir)

    return run_stage


@with_defaults
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op8_toxicity.accept(docs, op8_toxicity.fit(docs, table(spark, sf_dir, "labels")))


@with_defaults
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op5_neardedup.one_of_each(docs)


@with_defaults
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = op2_substrings.without_repeats(docs)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


@with_defaults
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op1_decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


@with_defaults
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return op9_packing.pack(docs, vocabulary())


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# The first stage's model has no form in SQL; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(apply_defaults(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

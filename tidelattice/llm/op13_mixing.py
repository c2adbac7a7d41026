"""Mixing sources to target weights by entropy balancing, with DataFrame functions only.

A source's target is its share of the mix, by weight and at most `most` times
its size.  Among all document rates between 0 and `most` that meet a source's
target, entropy balancing takes those nearest to one copy of each document in
relative entropy.  They are exponentially tilted: rate = min(most, exp(lambda x
size)), with one multiplier per source, the solution of a convex dual.

Newton iterations find all multipliers at once.  A document's rate follows from
its source and size, so documents are first counted by (source, size); each
iteration sums tokens and their slope over those cells and takes a Newton step
on the logarithm of a source's tokens, held inside a bracket that each step
narrows.  Sums are of whole numbers, so they do not depend on how the rows are
dealt, and reruns agree.

Rates become copies per cell: copies follow the running sum of rates in order
of size, which leaves a source off its target by less than its longest
document; copies of its shortest documents then make up the difference.  In a
cell, documents in order of their ids' hash get the copies left over.  No cell
and no source is gathered: orders run over blocks.

Defined results: a NULL text has size 0, and a document of size 0 is taken with
0 words; NULL is a source of its own, the last; sources without words have
target 0; documents that share a doc_id are mixed one by one; very long texts
count whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scale import ordinal, range_rank, running_sum
from .stages import kept, small_or_plain

WORDS = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
# Whole numbers stand for sums: parts of a word, and of a copy.
PART, COPY_BITS = 1024, 20
SIZES_PER_BLOCK, ROWS_PER_BLOCK = 4096, 1000
TOLERANCE = 0.5


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, number, documents, source_size, target) from rows with source and size.

    Every round shares what is left by weight among the sources below their
    limit; the level only rises, so the rounds end, with two sums to the driver each.
    """
    sums = rows.groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("size").alias("source_size"))
    ranked = range_rank(sums, [F.asc_nulls_last("source")], "number")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("number") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = kept(ranked.withColumn("weight", weight.cast("long")), "mix-sources")
    limit = F.col("source_size") * most
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, stopped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > limit
        full, taken, left = sources.agg(
            F.count_if(over), F.coalesce(F.sum(F.when(over, limit)), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))
        ).first()
        if full == stopped or not left:
            break
        stopped, level = full, (total - taken) / left
    return sources.withColumn("target", F.least(limit.cast("double"), F.col("weight") * F.lit(level))).drop("weight")


def _rate(most: int) -> Column:
    return F.least(F.lit(float(most)), F.exp(F.col("tilt") * F.col("x")))


def multipliers(cells: DataFrame, most: int = MOST, tolerance: float = TOLERANCE, rounds: int = 200) -> DataFrame:
    """(number, tilt) of every source, from cells (number, size, n, x, target), x being the size over the source's mean.

    The bracket's ends are where even the shortest documents alone would reach
    the target.  A source is done within `tolerance` words of it.
    """
    wanted = cells.filter("size > 0 AND target > 0").withColumn("goal", F.round(F.col("target") * PART).cast("long"))
    wanted = kept(wanted, "mix-cells")
    state = wanted.groupBy("number", "goal").agg(
        F.min("x").alias("least"), F.max("x").alias("longest"), (F.sum(F.col("n") * F.col("size")) * PART).alias("all")
    )
    low = F.log(F.col("goal") / F.col("all")) / F.col("least")
    state = state.select(
        "number",
        "goal",
        F.when(F.col("goal") >= F.col("all") * most, math.log(most) / F.col("least")).otherwise(F.lit(0.0)).alias("tilt"),
        F.least(low, F.lit(0.0)).alias("low"),
        (F.lit(math.log(most)) / F.col("least")).alias("high"),
        F.lit(False).alias("done"),
    )
    for _ in range(rounds):
        state = kept(state, "mix-state")
        if not state.filter("NOT done").limit(1).count():
            break
        at = wanted.drop("goal").join(small_or_plain(state.filter("NOT done")), "number")
        tokens = F.col("n") * F.col("size") * _rate(most)
        free = F.col("tilt") * F.col("x") < math.log(most)
        step = at.groupBy("number").agg(
            F.sum(F.round(tokens * PART).cast("long")).alias("tokens"),
            F.sum(F.when(free, F.round(tokens * F.col("x")).cast("long")).otherwise(F.lit(0))).alias("slope"),
        )
        moved = state.join(step, "number", "left")
        low = F.when(F.col("tokens") < F.col("goal"), F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("tokens") >= F.col("goal"), F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") + F.log(F.col("goal") / F.col("tokens")) * F.col("tokens") / (F.col("slope") * PART)
        inside = (F.col("tokens") > 0) & (F.col("slope") > 0) & (newton > low) & (newton < high)
        middle = (low + high) / 2
        near = F.abs(F.col("tokens") - F.col("goal")) <= tolerance * PART
        # Where neighbouring numbers bound the tilt, no better one exists.
        done = F.col("done") | near | (middle <= low) | (middle >= high)
        tilt = F.when(done, F.col("tilt")).when(inside, newton).otherwise(middle)
        state = moved.select("number", "goal", tilt.alias("tilt"), low.alias("low"), high.alias("high"), done.alias("done"))
    return state.select("number", "tilt")


def copies(cells: DataFrame, most: int = MOST) -> DataFrame:
    """The cells with `copies`, the whole number that all documents of a cell get together; tilt is NULL where target is 0."""
    block = F.floor(F.col("size") / SIZES_PER_BLOCK)
    rate = F.when(F.col("target") > 0, F.coalesce(_rate(most), F.lit(1.0))).when(F.col("size") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    cells = cells.withColumn("rate", rate).withColumn("_parts", F.round(F.col("n") * F.col("rate") * (1 << COPY_BITS)).cast("long"))
    cells = running_sum(cells, ["number"], ["size"], "_parts", block, "_upto")
    half = 1 << (COPY_BITS - 1)
    whole = F.shiftright(F.col("_upto") + half, COPY_BITS) - F.shiftright(F.col("_upto") - F.col("_parts") + half, COPY_BITS)
    cells = kept(cells.withColumn("copies", whole).drop("_upto", "_parts"), "mix-copies")

    missing = F.round(F.max("target") - F.sum(F.col("copies") * F.col("size"))).cast("long")
    cells = cells.join(small_or_plain(kept(cells.groupBy("number").agg(missing.alias("_missing")), "mix-missing")), "number")
    room = F.when(F.col("_missing") > 0, F.col("n") * most - F.col("copies")).otherwise(F.col("copies"))
    cells = running_sum(cells.withColumn("_words", room * F.col("size")), ["number"], ["size"], "_words", block, "_upto")
    open_words = F.abs("_missing") - (F.col("_upto") - F.col("_words"))
    change = F.when(F.col("size") > 0, F.greatest(F.least(F.floor(open_words / F.col("size")), room), F.lit(0))).otherwise(F.lit(0))
    return cells.withColumn("copies", F.col("copies") + F.signum("_missing").cast("long") * change).drop("_missing", "_words", "_upto")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies, rate) of every document; taken is size times copies.

    `weights` are the sources' in code point order, repeating; the mix holds `share` times all words.
    """
    text = F.col(text_column).cast("string")
    rows = kept(
        docs.select(
            F.col(id_column).cast("long").alias("doc_id"),
            F.col(source_column).cast("string").alias("source"),
            F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
        ),
        "mix-rows",
    )
    sources = kept(targets(rows, weights, share, most), "mix-targets")
    named = sources.withColumnRenamed("source", "_source")
    same = F.col("source").eqNullSafe(F.col("_source"))
    cells = rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.join(small_or_plain(named, F.coalesce(F.octet_length("_source"), F.lit(0)) + 40, 32e6), same)
    mean = F.greatest(F.col("source_size") / F.col("documents"), F.lit(1e-9))
    cells = kept(cells.withColumn("x", F.col("size") / mean).drop("_source", "documents"), "mix-source-cells")
    tilts = multipliers(cells.select("number", "size", "n", "x", "target"), most)
    cells = copies(cells.join(small_or_plain(kept(tilts, "mix-tilts")), "number", "left"), most)
    cells = kept(
        cells.select(
            F.col("source").alias("_source"),
            F.col("size").alias("_size"),
            "number",
            "source_size",
            "target",
            "rate",
            F.col("n").alias("_n"),
            F.floor(F.col("copies") / F.col("n")).alias("_each"),
            F.pmod("copies", "n").alias("_more"),
        ),
        "mix-cell-copies",
    )
    dealt = rows.join(
        small_or_plain(cells, F.coalesce(F.octet_length("_source"), F.lit(0)) + 72, 64e6), same & (F.col("size") == F.col("_size"))
    ).withColumn("_hash", F.xxhash64("doc_id"))
    share_of_range = F.shiftrightunsigned("_hash", 1) / F.lit(float(1 << 63))
    block = F.floor(share_of_range * F.ceil(F.col("_n") / ROWS_PER_BLOCK))
    order = [F.shiftrightunsigned("_hash", 1), F.col("doc_id")]
    placed = ordinal(dealt, ["number", "size"], order, block, "_place")
    count = F.col("_each") + (F.col("_place") <= F.col("_more")).cast("long")
    return placed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * count).alias("taken"),
        count.alias("copies"),
        "rate",
    )

"""Ordered operators.  Whole-group orderings go through blocks (see `scale`)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scale import ordinal, range_rank, running_sum


def depth_bounds(layers: DataFrame, profile: Sequence[str], block: int = 10_000) -> DataFrame:
    """WN-1: upper and lower depth of each layer from the running sum of thickness."""
    summed = running_sum(layers, profile, ["k"], "dr", F.floor(F.col("k") / block), "_sum")
    return (
        summed.withColumn("zl", -F.col("_sum"))
        .withColumn("zu", -(F.col("_sum") - F.col("dr")))
        .drop("_sum")
    )


def balanced_buckets(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, buckets: int) -> DataFrame:
    """WN-4: contiguous buckets in order; the first (n mod buckets) get one row more."""
    placed = ordinal(df, keys, order, block, "_pos")
    total = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    small = F.floor(F.col("_n") / buckets)
    longer = F.pmod(F.col("_n"), F.lit(buckets))
    in_longer = longer * (small + 1)
    at = F.col("_pos") - 1
    bucket = F.when(at < in_longer, F.floor(at / (small + 1))).otherwise(
        longer + F.floor((at - in_longer) / F.greatest(small, F.lit(1)))
    )
    return placed.join(total, list(keys)).withColumn("bucket", (bucket + 1).cast("long")).drop("_pos", "_n")


def ends(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """WN-6: first and last n rows per key.

    Two ranked filters, each limited per map task before the shuffle.
    """
    up = Window.partitionBy(*keys).orderBy(*order)
    down = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    first = df.withColumn("rank", F.row_number().over(up)).filter(F.col("rank") <= n).withColumn("end", F.lit("first"))
    last = df.withColumn("rank", F.row_number().over(down)).filter(F.col("rank") <= n).withColumn("end", F.lit("last"))
    return first.unionByName(last)


def nearest_start(df: DataFrame, keys: Sequence[str], start: Column, time: str = "time_start") -> DataFrame:
    """WN-7: the candidate nearest the start date, the earlier one on a tie."""
    gap = F.abs(F.unix_micros(F.col(time)) - F.unix_micros(start))
    rest = [c for c in df.columns if c not in (*keys, time)]
    best = F.min(F.struct(gap.alias("gap"), F.col(time), *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in (time, *rest)])


def change_between(df: DataFrame, keys: Sequence[str], first: str, second: str) -> DataFrame:
    """WN-8: value at the second instant minus value at the first.

    Two conditional maxima in one aggregate; nothing is ordered.
    """
    a, b = F.lit(first).cast("timestamp"), F.lit(second).cast("timestamp")
    at = lambda t: F.max(F.when(F.col("time") == t, F.col("value")))
    both = df.filter((F.col("time") == a) | (F.col("time") == b))
    return both.groupBy(*keys).agg((at(b) - at(a)).alias("value"), F.countDistinct("time").alias("_n")).filter(
        F.col("_n") == 2
    ).drop("_n")


def record_number(df: DataFrame, keys: Sequence[str], order: str, block: Column) -> DataFrame:
    """WN-9."""
    return ordinal(df, keys, [order], block, "record")


def last_match(df: DataFrame, keys: Sequence[str], path: str) -> DataFrame:
    """WN-10: the last path in sorted order wins."""
    return df.groupBy(*keys).agg(F.max(path).alias(path))


def dense_number(df: DataFrame, name: str) -> DataFrame:
    """WN-11: zero-based number of each distinct name in sorted order, however many begin alike."""
    return range_rank(df.select(name).distinct(), [name], "_pos").select(name, (F.col("_pos") - 1).alias("number"))


def nearest_sources(pairs: DataFrame, n: int, keys: Sequence[str] = ("target_id",)) -> DataFrame:
    """WN-2: n nearest sources per target from ready pairs."""
    order = Window.partitionBy(*keys).orderBy("dist", "source_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)

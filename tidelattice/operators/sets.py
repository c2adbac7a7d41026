"""Set operations over catalogues, records and variable lists."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def later_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """SO-1: one row per key, from the last source in order."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in (*order, *rest)])


def concat_records(frames: Sequence[DataFrame]) -> DataFrame:
    """SO-2."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def common(a: DataFrame, b: DataFrame) -> DataFrame:
    """SO-3."""
    return a.intersect(b)


def only_in(a: DataFrame, b: DataFrame) -> DataFrame:
    """SO-4."""
    return a.subtract(b)


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """SO-5."""
    return a.subtract(b).unionByName(b.subtract(a))


def parse_request_key(key: Column) -> Column:
    """SO-6: `grid,time_res` -> struct; anything but one comma is an error."""
    parts = F.split(key, ",")
    good = F.struct(F.trim(parts[0]).alias("grid"), F.trim(F.get(parts, F.lit(1))).alias("time_res"))
    return F.when(F.size(parts) == 2, good).otherwise(
        F.raise_error(F.lit("request key must be 'grid,time_res'")).cast("struct<grid:string,time_res:string>")
    )


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """SO-7."""
    return df.dropDuplicates(list(keys))

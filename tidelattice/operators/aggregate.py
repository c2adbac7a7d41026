"""Aggregates over time, space and catalogues; all combine map-side before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.missing import mean_all_present, mean_present
from .scale import join_back, same_keys, summary_side, with_prefix

# Coverage duration by time resolution; sizes at or below the limit are unknown.
DURATION = {"daily": "P1D", "monthly": "P1M", "yearly": "P1Y", "snapshot": "P0S"}
UNKNOWN_SIZE_BYTES = 1024.0
LARGEST_FRACTION = 0.9


def value_range(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AG-7 / SF-50: range of the values themselves, missing ones left out."""
    return df.groupBy(*keys).agg(F.min("value").alias("valid_min"), F.max("value").alias("valid_max"))


def stored_range(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AG-8: range from ranges already stored per granule."""
    return df.groupBy(*keys).agg(F.min("valid_min").alias("valid_min"), F.max("valid_max").alias("valid_max"))


def without_empty_days(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AG-10: records whose every value is missing are left out.

    A semi join on the non-empty records, so no record is gathered in a window.
    """
    filled = df.filter(F.col("value").isNotNull()).select(*keys).distinct()
    return df.join(with_prefix(summary_side(filled, "filled-records"), keys), same_keys(keys), "left_semi")


def monthly_means(df: DataFrame, keys: Sequence[str], time: str = "time") -> DataFrame:
    """AG-9 with both settings of the missing-value switch, from one pass."""
    return df.groupBy(F.date_trunc("month", F.col(time)).alias("month"), *keys).agg(
        mean_present(F.col("value")).alias("skipped"), mean_all_present(F.col("value")).alias("strict")
    )


def monthly_mean(df: DataFrame, keys: Sequence[str], skip_missing: bool = True, time: str = "time") -> DataFrame:
    """AG-9: calendar-month mean per key."""
    mean = mean_present if skip_missing else mean_all_present
    return df.groupBy(F.date_trunc("month", F.col(time)).alias("month"), *keys).agg(mean(F.col("value")).alias("value"))


def resample(df: DataFrame, keys: Sequence[str], step: str) -> DataFrame:
    """AG-11: means per day or month of a series."""
    return df.groupBy(F.date_trunc(step, F.col("time")).alias("time"), *keys).agg(F.avg("value").alias("value"))


def time_mean(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AG-12."""
    return df.groupBy(*keys).agg(F.avg("value").alias("value"))


def anomaly(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AG-13: value minus its mean over time, through an aggregate and a join instead of a window."""
    means = df.groupBy(*keys).agg(F.avg("value").alias("_mean"))
    return join_back(df, summary_side(means, "time-means"), keys).withColumn("value", F.col("value") - F.col("_mean")).drop("_mean")


def clamp_fraction(fraction: Column) -> Column:
    return F.least(F.greatest(fraction, F.lit(0.0)), F.lit(LARGEST_FRACTION))


def footprint(pending: DataFrame, available_bytes: float, max_fraction: float = 0.5) -> DataFrame:
    """AG-14: bytes still to fetch per dataset, the share of the space they take, and what to do."""
    total = pending.groupBy("short_name").agg(F.sum("size_bytes").alias("bytes"), F.count(F.lit(1)).alias("files"))
    share = F.col("bytes") / F.lit(float(available_bytes))
    return total.select(
        "short_name",
        F.col("files").cast("long").alias("files"),
        F.round(F.col("bytes") / F.lit(float(2**30)), 3).alias("size_gb"),
        F.round(share, 6).alias("share"),
        F.when(share <= clamp_fraction(F.lit(float(max_fraction))), "download").otherwise("open_remote").alias("decision"),
    )


def repair_sizes(granules: DataFrame, everything: DataFrame) -> DataFrame:
    """AG-15: unknown sizes take the mean of the request, or of the whole dataset when none is known."""
    known = lambda c: F.when(F.col(c) > UNKNOWN_SIZE_BYTES, F.col(c))
    request = granules.groupBy("short_name").agg(F.avg(known("size_bytes")).alias("_request"))
    whole = everything.groupBy("short_name").agg(F.avg(known("size_bytes")).alias("_whole"))
    means = request.join(whole, "short_name", "left")
    return (
        granules.join(means, "short_name")
        .withColumn("size_bytes", F.coalesce(known("size_bytes"), F.col("_request"), F.col("_whole")))
        .drop("_request", "_whole")
    )


def missing_steps(df: DataFrame) -> DataFrame:
    """AG-16: variables that lack time steps other variables have."""
    seen = df.select("var", "time").distinct()
    per_var = seen.groupBy("var").agg(F.count(F.lit(1)).alias("steps"))
    overall = seen.agg(F.countDistinct("time").alias("all_steps")).scalar()
    return per_var.withColumn("all_steps", overall).withColumn("complete", F.col("steps") == F.col("all_steps"))


def distinct_indices(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """AG-17: sorted distinct indices; their number is bounded by the grid."""
    return df.groupBy(*keys).agg(*[F.array_sort(F.collect_set(n)).alias(n) for n in names])


def extent(df: DataFrame, lon: str = "xc", lat: str = "yc") -> list[Column]:
    """AG-18."""
    return [
        F.min(lat).alias("lat_min"),
        F.max(lat).alias("lat_max"),
        F.min(lon).alias("lon_min"),
        F.max(lon).alias("lon_max"),
    ]


def status_summary(df: DataFrame, status: str = "status") -> DataFrame:
    """AG-19."""
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def arrivals(df: DataFrame, patterns: dict[str, str], text: str = "url") -> DataFrame:
    """AG-20: files per pattern; a file counts for every pattern it matches."""
    hits = F.filter(
        F.array(*[F.when(F.col(text).rlike(p), F.lit(name)) for name, p in patterns.items()]), lambda x: x.isNotNull()
    )
    return df.select(F.explode(hits).alias("pattern")).groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))


def length_scale(df: DataFrame, dx: str = "dx", dy: str = "dy") -> list[Column]:
    """AG-21."""
    return [
        F.least(F.min(dx), F.min(dy)).alias("shortest"),
        F.greatest(F.max(dx), F.max(dy)).alias("longest"),
    ]


def empty_periods(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AG-23: periods with no value at all."""
    return df.groupBy(*keys).agg((F.count("value") == 0).alias("is_empty"))


def coverage(df: DataFrame, keys: Sequence[str], resolution: Column) -> DataFrame:
    """AG-24 in one pass; `resolution` is one value for all rows of the same keys."""
    codes = F.create_map(*[F.lit(x) for pair in DURATION.items() for x in pair])
    return df.groupBy(*keys).agg(
        F.min("time_start").alias("coverage_start"),
        F.max("time_end").alias("coverage_end"),
        F.try_element_at(codes, F.min(resolution)).alias("duration"),
    )


def snapshot_interval(df: DataFrame, name: str = "short_name") -> Column:
    """AG-26: daily snapshots when any of the datasets is daily."""
    return F.when(F.bool_or(F.contains(F.col(name), F.lit("DAILY"))), "daily").otherwise("monthly")


def range_audit(
    actual: DataFrame, old: DataFrame, new: DataFrame, keys: Sequence[str], also: Sequence[str] = ()
) -> DataFrame:
    """AG-27: do the stored and the corrected range contain the values?"""
    stored = old.select(*keys, *also, F.col("valid_min").alias("old_min"), F.col("valid_max").alias("old_max"))
    fixed = new.select(*keys, F.col("valid_min").alias("new_min"), F.col("valid_max").alias("new_max"))
    return (
        actual.join(stored, list(keys))
        .join(fixed, list(keys))
        .withColumn("old_bad", (F.col("old_min") > F.col("valid_min")) | (F.col("old_max") < F.col("valid_max")))
        .withColumn("new_bad", (F.col("new_min") > F.col("valid_min")) | (F.col("new_max") < F.col("valid_max")))
    )

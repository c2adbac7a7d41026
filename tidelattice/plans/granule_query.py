"""P-1: complete granule list of a date range, with gaps filled and sizes repaired."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.geometry import bytes_of
from ..functions.strings import name_resolution, with_date_token
from ..operators.aggregate import UNKNOWN_SIZE_BYTES
from ..operators.windows import nearest_start
from ..session import stored

# Fixed value: found sizes below this share of the largest are taken for wrong.
SUSPECT_SHARE = 0.1


def in_range(granules: DataFrame, start: str, end: str) -> DataFrame:
    """Granules with the closed range their dataset is asked for, and whether they lie in it.

    Monthly products belong to the range when their month overlaps it, so the
    lower bound is the month's first day.
    """
    name = F.col("short_name")
    first = D.first_day_of(F.lit(start))
    last = D.snapshot_end(name, D.last_day_of(F.lit(end)))
    low = F.when(F.contains(name, F.lit("MONTHLY")), F.trunc(first, "MM")).otherwise(first)
    return granules.withColumn("range_start", first).withColumn("range_end", last).withColumn(
        "in_range", (F.col("gdate") >= low) & (F.col("gdate") <= F.col("range_end"))
    )


def dataset_summary(ranged: DataFrame, version: str | None = None) -> DataFrame:
    """One row per dataset: dates expected, whether granules are missing, URL template, largest and mean size.

    A single pass over the listing answers for the range and for the whole dataset.
    """
    name = F.col("short_name")
    known = F.when(bytes_of(F.col("size_mb")) > UNKNOWN_SIZE_BYTES, F.col("size_mb"))
    per = ranged.groupBy("short_name").agg(
        F.count_if("in_range").alias("n_found"),
        F.min(F.when(F.col("in_range"), F.col("url"))).alias("template"),
        F.max(F.when(F.col("in_range"), F.col("size_mb"))).alias("largest"),
        F.avg(known).alias("whole_mean"),
        F.min("range_start").alias("range_start"),
        F.max("range_end").alias("range_end"),
    )
    dates = D.expected_dates(name, F.col("range_start"), F.col("range_end"), version)
    timed = name_resolution(name).isNotNull()
    return per.filter(F.col("n_found") > 0).withColumn("dates", F.when(timed, dates)).withColumn(
        "is_short", F.coalesce(timed & (F.col("n_found") < F.size("dates")), F.lit(False))
    )


def fill_gaps(found: DataFrame, summary: DataFrame) -> DataFrame:
    """Rebuild the list of every dataset that has fewer granules than dates.

    URLs follow the dataset's own URL template; a size is kept when it is
    plausible, else the largest one is used.  Complete lists stay as found.
    Found and expected granules meet in one aggregate by URL.
    """
    name = F.col("short_name")
    text = F.when(F.contains(name, F.lit("MONTHLY")), F.date_format("gdate", "yyyy-MM")).otherwise(
        F.date_format("gdate", "yyyy-MM-dd")
    )
    expected = (
        summary.filter("is_short")
        .select("short_name", "template", F.explode("dates").alias("gdate"))
        .select("short_name", with_date_token(F.col("template"), text).alias("url"), "gdate")
        .select("*", F.lit(None).cast("double").alias("size_mb"), F.lit(True).alias("expected"))
    )
    listed = found.select("short_name", "url", "gdate", "size_mb", F.lit(False).alias("expected"))
    flags = summary.select("short_name", "is_short", "largest", "whole_mean")
    merged = expected.unionByName(listed).groupBy("short_name", "url").agg(
        F.max_by("gdate", "expected").alias("gdate"), F.max("size_mb").alias("_size"), F.bool_or("expected").alias("expected")
    )
    plausible = F.col("_size") >= F.col("largest") * SUSPECT_SHARE
    size = F.when(~F.col("is_short") | plausible, F.col("_size")).otherwise(F.col("largest"))
    return (
        merged.join(flags, "short_name")
        .filter(F.col("expected") | ~F.col("is_short"))
        .select("short_name", "url", "gdate", size.alias("size_mb"), (F.col("is_short") & F.col("_size").isNull()).alias("filled"), "whole_mean")
    )


def single_days(found: DataFrame) -> DataFrame:
    """WN-7: a one-day range of a mean product keeps the granule nearest its start."""
    name, start, end = F.col("short_name"), F.col("range_start"), F.col("range_end")
    single = D.is_single_day(name, start, end)
    one = nearest_start(found.filter(single), ["short_name"], start.cast("timestamp"))
    return found.filter(~single).unionByName(one.select(*found.columns))


def granule_query(
    granules: DataFrame, start: str, end: str, version: str | None = None, interval: str = "daily"
) -> DataFrame:
    """(short_name, url, gdate, size_bytes, filled) for all datasets of a listing.

    `granules` is read twice, for the summary and for the rows; the listing of
    the answer is written once, because its mean size and its rows are both used.
    """
    ranged = in_range(granules, start, end)
    summary = dataset_summary(ranged, version)
    found = ranged.filter("in_range").drop("in_range")
    if start == end and len(start) == 10:
        found = single_days(found)
    listed = stored(fill_gaps(found, summary), "granule-list")
    known = F.when(bytes_of(F.col("size_mb")) > UNKNOWN_SIZE_BYTES, bytes_of(F.col("size_mb")))
    means = listed.groupBy("short_name").agg(F.avg(known).alias("_mean"))
    size = F.coalesce(known, F.col("_mean"), bytes_of(F.col("whole_mean")))
    out = listed.join(means, "short_name").select("short_name", "url", "gdate", "filled", size.alias("size_bytes"))
    if interval != "monthly":
        return out
    snapshot = F.contains("short_name", F.lit("SNAPSHOT"))
    return out.filter(~snapshot | (F.dayofmonth("gdate") == 1))

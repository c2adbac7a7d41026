"""Granule listings: JSON feeds, bucket listings and calendar harvests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import DATE_SLOT, basename, token_from_right
from ..operators.joins import match_calendar

# Fixed value: the schema of one page of a granule search feed.
FEED_SCHEMA = (
    "feed struct<entry: array<struct<time_start: string, time_end: string, granule_size: string, "
    "links: array<struct<title: string, href: string>>>>>"
)
DATA_LINK = ".nc"
BUCKET_LINK = "direct download access"


def data_link(title: Column) -> Column:
    """SRC-1: links to the data file itself."""
    return F.endswith(title, F.lit(DATA_LINK))


def bucket_link(title: Column) -> Column:
    """SRC-3: links for access inside the object store."""
    return F.contains(title, F.lit(BUCKET_LINK))


def feed_entries(pages: DataFrame, link=data_link) -> DataFrame:
    """SRC-1 / SRC-3: one row per entry with its first link that passes `link`."""
    entry = pages.select(F.explode("feed.entry").alias("e"))
    chosen = F.get(F.filter("e.links", lambda x: link(x["title"])), F.lit(0))
    return entry.select(
        F.to_timestamp(F.rtrim(F.translate("e.time_start", "TZ", "  "))).alias("time_start"),
        F.to_timestamp(F.rtrim(F.translate("e.time_end", "TZ", "  "))).alias("time_end"),
        F.col("e.granule_size").cast("double").alias("size_mb"),
        chosen["href"].alias("url"),
    ).filter(F.col("url").isNotNull())


def read_feed(spark: SparkSession, path: str | Sequence[str], link=data_link) -> DataFrame:
    """SRC-1 / SRC-2: a folder of feed pages; an entry on two pages counts once."""
    pages = spark.read.schema(FEED_SCHEMA).json(path, multiLine=True)
    return feed_entries(pages, link).dropDuplicates(["url"])


def to_feed(granules: DataFrame, page_size: int) -> DataFrame:
    """Feed pages (short_name, page, feed) from a listing, to write feeds or to test readers."""
    stamp = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    entry = F.struct(
        F.date_format("time_start", stamp).alias("time_start"),
        F.date_format("time_end", stamp).alias("time_end"),
        F.col("size_mb").cast("string").alias("granule_size"),
        F.array(
            F.struct(F.lit("checksum.md5").alias("title"), F.concat("url", F.lit(".md5")).alias("href")),
            F.struct(F.concat(F.lit("Download "), basename(F.col("url"))).alias("title"), F.col("url").alias("href")),
            F.struct(F.lit(f"{BUCKET_LINK} to granule").alias("title"), F.replace("url", F.lit("https://h/"), F.lit("s3://b/")).alias("href")),
        ).alias("links"),
    )
    page = F.floor(F.datediff("gdate", F.lit("1970-01-01")) / page_size)
    return granules.groupBy("short_name", page.alias("page")).agg(
        F.struct(F.array_sort(F.collect_list(entry)).alias("entry")).alias("feed")
    )


def listing_dates(listing: DataFrame) -> DataFrame:
    """SRC-4: date text and timestamp from the date slot of each path; the timestamp is as exact as the text."""
    token = token_from_right(F.col("url"), DATE_SLOT)
    stamp = (
        F.when(F.length(token) == 7, F.to_timestamp(token, "yyyy-MM"))
        .when(F.length(token) == 10, F.to_timestamp(token, "yyyy-MM-dd"))
        .when(F.length(token) == 13, F.to_timestamp(token, "yyyy-MM-dd'T'HH"))
        .when(F.length(token) == 15, F.to_timestamp(token, "yyyy-MM-dd'T'HHmm"))
        .otherwise(F.to_timestamp(token, "yyyy-MM-dd'T'HHmmss"))
    )
    return listing.withColumn("date_text", token).withColumn("time_start", stamp)


def listing_between(listing: DataFrame, start: Column, stop: Column) -> DataFrame:
    """SRC-4: half-open range of a bucket listing."""
    dated = listing_dates(listing)
    return dated.filter((F.col("time_start") >= start) & (F.col("time_start") < stop))


def year_dates(year: int, time_scale: str) -> Column:
    """SRC-11: array of the dates a complete year has."""
    step = {"DAILY": "INTERVAL '1' DAY", "MONTHLY": "INTERVAL '1' MONTH"}[time_scale.upper()]
    return F.sequence(F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year}-12-31").cast("date"), F.expr(step))


def harvest_year(spark: SparkSession, files: DataFrame, year: int, time_scale: str = "DAILY", pattern: str = "yyyyMMdd", hemisphere: str = "") -> DataFrame:
    """SRC-11: each expected date of a year with the last path that carries it (empty when none).

    `pattern` is how the date is written in the file name.  The date is cut out
    of each path once, so dates and paths meet in an equi join.
    """
    dates = spark.range(1).select(F.explode(year_dates(year, time_scale)).alias("date"))
    digits = "".join(r"\d" if ch.isalpha() else ch for ch in pattern)
    kept = files.filter(F.contains("path", F.lit(hemisphere))) if hemisphere else files
    text = F.regexp_extract(basename(F.col("path")), rf"(?<!\d)({digits})(?!\d)", 1)
    dated = kept.select("path", F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit(pattern)).cast("date").alias("date")).filter(
        F.col("date").isNotNull()
    )
    return match_calendar(dates, dated)

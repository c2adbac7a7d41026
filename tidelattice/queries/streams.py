"""Streams over the events table as arriving files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import shared_folder
from ..streaming import arrivals as S
from .registry import query
from .text import day, r6, stamp

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def arriving(t):
    stream = S.watch(t.spark, t.folder, EVENTS, "events.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query("st_1", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def st_1(t):
    path = shared_folder(t.spark, "arrivals")
    S.replace_at(S.arrival_counts(arriving(t), "event_type"), path).awaitTermination()
    return S.latest(t.spark, path)


@query("st_2", "SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d') AS \"day\" FROM events")
def st_2(t):
    """One granule per user, kind and day, however often it arrives."""
    path = shared_folder(t.spark, "ingest")
    keyed = arriving(t).select("ts", "user_id", "event_type", day("ts").alias("day"))
    once = S.ingest_once(keyed, ["user_id", "event_type", "day"], part=F.col("day"))
    S.append_to(once, path).awaitTermination()
    return S.ingested(t.spark, path).drop("ts")


@query(
    "st_3",
    """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS time_start, event_type, round(avg(value), 6) AS mean, min(value) AS valid_min, max(value) AS valid_max, count(*) AS n
FROM events GROUP BY ALL
""",
)
def st_3(t):
    """Daily products of all windows, open ones too."""
    path = shared_folder(t.spark, "daily")
    S.replace_at(S.running_products(arriving(t), "ts", ["event_type"], "1 day"), path).awaitTermination()
    out = S.latest(t.spark, path)
    return out.select(stamp("time_start").alias("time_start"), "event_type", r6("mean").alias("mean"), "valid_min", "valid_max", "n")

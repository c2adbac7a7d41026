"""Streams over several files equal the batch result, and resume where they stopped."""

import pytest
from pyspark.sql import functions as F

from tidelattice.queries.streams import EVENTS
from tidelattice.streaming import arrivals as S

SOURCE = "/root/testdata/sf0.001/events.parquet"


@pytest.fixture()
def folder(spark, tmp_path):
    """Five files in time order."""
    events = spark.read.parquet(SOURCE)
    days = F.dayofmonth("ts")
    for part in range(5):
        cut = events.filter((days > part * 6) & (days <= (part + 1) * 6)).orderBy("ts").coalesce(1)
        cut.write.mode("append").parquet(str(tmp_path / "in"))
    return str(tmp_path / "in"), str(tmp_path / "out")


def stream(spark, path):
    return S.watch(spark, path, EVENTS, files_per_batch=1).withColumn("ts", F.col("ts").cast("timestamp"))


def test_counts_equal_batch(spark, folder):
    source, out = folder
    S.replace_at(S.arrival_counts(stream(spark, source), "event_type"), out).awaitTermination()
    got = {r.event_type: r.n for r in S.latest(spark, out).collect()}
    assert got == {r.event_type: r["count"] for r in spark.read.parquet(SOURCE).groupBy("event_type").count().collect()}


def test_ingest_once_survives_a_restart(spark, folder):
    source, out = folder
    run = lambda: S.append_to(S.ingest_once(stream(spark, source), ["event_id"], "ts"), out).awaitTermination()
    run()
    spark.read.parquet(SOURCE).filter("day(ts) >= 30").write.mode("append").parquet(source)
    run()
    ids = spark.read.parquet(f"{out}/rows").select("event_id")
    assert ids.count() == ids.distinct().count() == spark.read.parquet(SOURCE).count()


def test_daily_products_equal_batch(spark, folder):
    source, out = folder
    S.append_to(S.period_products(stream(spark, source), "ts", ["event_type"], "1 day"), out).awaitTermination()
    got = {(str(r.time_start)[:10], r.event_type): (round(r.mean, 6), r.n) for r in spark.read.parquet(f"{out}/rows").collect()}
    batch = spark.read.parquet(SOURCE).groupBy(F.date_format("ts", "yyyy-MM-dd").alias("d"), "event_type").agg(F.avg("value").alias("m"), F.count("*").alias("n"))
    want = {(r.d, r.event_type): (round(r.m, 6), r.n) for r in batch.collect()}
    assert got and all(want[k] == v for k, v in got.items())
    closed = {k for k in want if k[0] <= "2024-01-28"}
    assert closed <= set(got)


def test_months_equal_batch(spark, folder):
    source, out = folder
    S.replace_at(S.monthly_products(stream(spark, source), "ts", ["event_type"]), out).awaitTermination()
    assert S.latest(spark, out).count() == 5


@pytest.fixture()
def backwards(spark, tmp_path):
    """Five files, the latest rows first."""
    events = spark.read.parquet(SOURCE)
    days = F.dayofmonth("ts")
    for part in reversed(range(5)):
        cut = events.filter((days > part * 6) & (days <= (part + 1) * 6)).coalesce(1)
        cut.write.mode("append").parquet(str(tmp_path / "late"))
    return str(tmp_path / "late"), str(tmp_path / "late-out")


def test_late_keys_are_ingested(spark, backwards):
    source, out = backwards
    S.append_to(S.ingest_once(stream(spark, source), ["event_id"]), out).awaitTermination()
    ids = spark.read.parquet(f"{out}/rows").select("event_id")
    assert ids.count() == ids.distinct().count() == spark.read.parquet(SOURCE).count()


def test_all_windows_with_late_rows(spark, backwards):
    source, out = backwards
    S.replace_at(S.running_products(stream(spark, source), "ts", ["event_type"], "1 day"), out).awaitTermination()
    got = {(str(r.time_start)[:10], r.event_type): (round(r.mean, 6), r.n) for r in S.latest(spark, out).collect()}
    batch = spark.read.parquet(SOURCE).groupBy(F.date_format("ts", "yyyy-MM-dd").alias("d"), "event_type").agg(F.avg("value").alias("m"), F.count("*").alias("n"))
    assert got == {(r.d, r.event_type): (round(r.m, 6), r.n) for r in batch.collect()}


def test_only_touched_periods_are_written_again(spark, folder):
    source, out = folder
    events = spark.read.parquet(SOURCE).withColumn("ts", F.col("ts").cast("timestamp"))
    spec = S.running_products(events, "ts", ["event_type"], "1 day", part_format="yyyy-MM-dd")
    write = S.writer(spec, out)
    write(events.filter("day(ts) <= 3"), 0)
    write(events.filter("day(ts) BETWEEN 4 AND 6"), 1)
    first, second, fifth = "2024-01-01", "2024-01-02", "2024-01-05"
    assert (S._versions(out, first), S._versions(out, fifth)) == ([0], [1])
    late = events.filter("day(ts) = 1").limit(3)
    for number in (2, 3, 4):
        write(late, number)
    # The last two versions of the touched day are left, and the other days are as they were.
    assert (S._versions(out, first), S._versions(out, second), S._versions(out, fifth)) == ([3, 4], [0], [1])
    counted = S.latest(spark, out).agg(F.sum("n")).first()[0]
    assert counted == events.filter("day(ts) <= 6 AND value IS NOT NULL").count() + 3 * late.filter("value IS NOT NULL").count()


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path):
    events = spark.read.parquet(SOURCE)
    for spec, shown in ((S.arrival_counts(events, "event_type"), S.latest), (S.ingest_once(events, ["event_id"]), S.ingested)):
        out = str(tmp_path / shown.__name__)
        write = S.writer(spec, out)
        write(events.limit(400), 0)
        write(events.filter("event_id % 2 = 0"), 1)
        want = sorted(map(str, shown(spark, out).collect()))
        write(events.filter("event_id % 2 = 0"), 1)
        assert sorted(map(str, shown(spark, out).collect())) == want
        # A driver that is lost before the commit: the rows are there, the commit is not.
        (tmp_path / shown.__name__ / "_commits" / f"{1:012d}").unlink()
        assert sorted(map(str, shown(spark, out).collect())) != want
        write(events.filter("event_id % 2 = 0"), 1)
        assert sorted(map(str, shown(spark, out).collect())) == want


def test_no_batch_and_odd_parts(spark, tmp_path):
    events = spark.read.parquet(SOURCE)
    with pytest.raises(ValueError, match="no batch"):
        S.latest(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="a part is named"):
        S.writer(S.ingest_once(events, ["event_id"], part=F.lit("a/b")), str(tmp_path / "odd"))(events, 0)
    write = S.writer(S.ingest_once(events, ["user_id"], part=F.lit(None)), str(tmp_path / "null"))
    write(events.select(F.lit(None).cast("bigint").alias("user_id")), 0)
    write(events.select(F.lit(None).cast("bigint").alias("user_id")), 1)
    assert S.ingested(spark, str(tmp_path / "null")).count() == 1

"""Listings, catalogue search, repair, nearest times and other compositions."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelattice.operators import aggregate as A
from tidelattice.operators import joins as J
from tidelattice.operators import select as S
from tidelattice.plans import catalogue as C
from tidelattice.plans import products as P
from tidelattice.plans import quality as Q
from tidelattice.plans.granule_query import granule_query
from tidelattice.sources.derived import Tables

FOLDER = "/root/testdata/sf0.001"


def listing(spark, name, days, size=10.0, period="day_mean"):
    fmt = "%Y-%m" if "MONTHLY" in name else "%Y-%m-%d"
    rows = []
    for at, day in enumerate(days):
        d = dt.date.fromisoformat(day)
        url = f"https://h/{name}/SSH_{period}_{d.strftime(fmt)}_MODEL_V1_latlon_g.nc"
        rows.append((name, url, size if not callable(size) else size(at), d, dt.datetime(d.year, d.month, d.day)))
    return spark.createDataFrame(rows, "short_name string, url string, size_mb double, gdate date, time_start timestamp")


def dates(df):
    return [str(r.gdate) for r in df.orderBy("gdate").collect()]


def test_gap_fill_expects_the_first_day(spark):
    found = listing(spark, "X_DAILY_V1", ["2000-01-03", "2000-01-05"])
    out = granule_query(found, "2000-01-02", "2000-01-06")
    assert dates(out) == [f"2000-01-0{d}" for d in range(2, 7)]
    assert {str(r.gdate) for r in out.filter("filled").collect()} == {"2000-01-02", "2000-01-04", "2000-01-06"}


def test_gap_fill_is_idempotent(spark):
    found = listing(spark, "X_DAILY_V1", ["2000-01-03", "2000-01-05"], size=lambda at: [10.0, 0.5][at])
    once = granule_query(found, "2000-01-02", "2000-01-06")
    again = granule_query(
        once.select("short_name", "url", (F.col("size_bytes") / 2**20).alias("size_mb"), "gdate", F.col("gdate").cast("timestamp").alias("time_start")),
        "2000-01-02", "2000-01-06",
    )
    view = lambda df: sorted((r.url, r.size_bytes) for r in df.collect())
    assert view(once) == view(again)
    assert {r.size_bytes for r in once.collect()} == {10.0 * 2**20}


def test_complete_list_is_untouched_and_sizes_are_repaired(spark):
    sizes = [8.0, None, 0.0005, 4.0]
    found = listing(spark, "X_DAILY_V1", [f"2000-01-0{d}" for d in range(1, 5)], size=lambda at: sizes[at])
    out = granule_query(found, "2000-01-01", "2000-01-04").orderBy("gdate").collect()
    assert [r.size_bytes / 2**20 for r in out] == [8.0, 6.0, 6.0, 4.0] and not any(r.filled for r in out)


def test_unknown_sizes_take_the_mean_of_the_whole_dataset(spark):
    found = listing(spark, "X_DAILY_V1", ["2000-01-01", "2000-01-02", "2001-01-01"], size=lambda at: [None, None, 7.0][at])
    out = granule_query(found, "2000-01-01", "2000-01-02")
    assert [r.size_bytes / 2**20 for r in out.collect()] == [7.0, 7.0]


def test_single_day_keeps_the_nearest(spark):
    found = listing(spark, "X_DAILY_V1", ["2000-01-01", "2000-01-02"])
    assert dates(granule_query(found, "2000-01-01", "2000-01-01")) == ["2000-01-01"]


def test_monthly_partial_dates_and_snapshots(spark):
    monthly = listing(spark, "X_MONTHLY_V1", ["2000-01-01", "2000-03-01"])
    assert dates(granule_query(monthly, "2000-01-15", "2000-03")) == ["2000-01-01", "2000-02-01", "2000-03-01"]
    snaps = listing(spark, "X_SNAPSHOT_V1", ["2000-01-01", "2000-01-15", "2000-02-01"], period="snap")
    out = granule_query(snaps, "2000-01", "2000-01", interval="monthly")
    assert dates(out) == ["2000-01-01", "2000-02-01"]
    assert granule_query(listing(spark, "X_GEOMETRY_V1", ["2000-01-01"]), "2000", "2001").count() == 1


def test_two_day_range_keeps_both(spark):
    found = listing(spark, "X_DAILY_V1", ["2000-01-01", "2000-01-02"])
    assert dates(granule_query(found, "2000-01-01", "2000-01-02")) == ["2000-01-01", "2000-01-02"]


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_nearest_time_with_long_gaps(spark, parts):
    rng = np.random.default_rng(8)
    base = dt.datetime(2000, 1, 1)
    at = lambda days: base + dt.timedelta(seconds=int(days * 86400))
    series = sorted({(v, at(x)) for v in "ab" for x in np.concatenate([rng.uniform(0, 2, 60), rng.uniform(90, 91, 5)])})
    probes = sorted({(v, at(x)) for v in "abc" for x in rng.uniform(-3, 120, 80)} | set(series[:5]))
    sdf = spark.createDataFrame([(v, x, float(n)) for n, (v, x) in enumerate(series)], "var string, time timestamp, value double")
    pdf = spark.createDataFrame(probes, "var string, probe timestamp")
    got = {(r["var"], r.probe): (r.time, r.value) for r in J.nearest_time_join(pdf, sdf, ["var"], parts).collect()}
    for v, p in probes:
        own = [(abs((x - p).total_seconds()), x, float(n)) for n, (w, x) in enumerate(series) if w == v]
        want = min(own)[1:] if own else (None, None)
        assert got[(v, p)] == want
    few = J.nearest_time(sdf, ["2000-02-01 00:00:00"], ["var"]).collect()
    for r in few:
        own = [(abs((x - dt.datetime(2000, 2, 1)).total_seconds()), x) for w, x in series if w == r["var"]]
        assert r.time == min(own)[1]


def test_anomaly_mean_is_zero(spark):
    out = A.anomaly(Tables(spark, FOLDER).series(), ["var"]).groupBy("var").agg(F.avg("value").alias("m")).collect()
    assert len(out) == 5 and all(abs(r.m) < 1e-9 for r in out)


def test_range_holds_all_values(spark):
    field = Tables(spark, FOLDER).field()
    bad = field.join(A.value_range(field, ["var"]), "var").filter("value < valid_min or value > valid_max")
    assert bad.count() == 0


def test_unknown_location_is_an_error(spark):
    t = Tables(spark, FOLDER)
    with pytest.raises(Exception, match="unknown field location"):
        S.land_mask(t.field().withColumn("loc", F.lit("q")), t.mask()).agg(F.max("value")).collect()


def test_two_dimensional_field_uses_level_zero(spark):
    t = Tables(spark, FOLDER)
    flat = t.field().filter("k = 0")
    a = S.land_mask(flat, t.mask()).agg(F.count("value")).first()[0]
    b = S.land_mask(flat.withColumn("k", F.lit(None).cast("int")), t.mask()).agg(F.count("value")).first()[0]
    assert a == b > 0


def test_footprint_limit_is_clamped(spark):
    pending = spark.createDataFrame([("D", 95.0)], "short_name string, size_bytes double")
    assert A.footprint(pending, 100.0, 2.0).first().decision == "open_remote"
    assert A.footprint(pending, 1000.0, 0.5).first().decision == "download"


def test_search_routes_mixed_sections(spark):
    rows = [
        ("native,monthly", "DS_A_MONTHLY", None, "SSH", "height", 0, 1),
        ("mixed,all", "DS_B", "*for lat-lon grid, daily*", "SSH", "height", 0, 2),
        ("mixed,all", "DS_C", "*for native grid, monthly*", "ssh2", "x", 0, 3),
        ("latlon,daily", "DS_D", None, "T", "sea SSH", 0, 4),
        ("native,monthly", "SSH", None, "T", "t", 0, 5),
    ]
    cat = spark.createDataFrame(rows, "section string, short_name string, note string, var string, description string, source_order int, entry_id long")
    names = lambda *a, **k: [r.short_name for r in C.search(cat, *a, **k).orderBy("position").collect()]
    assert names("ssh") == ["DS_A_MONTHLY", "DS_B", "DS_C", "DS_D", "SSH"]
    assert names("ssh", grid="native", time_res="monthly") == ["DS_A_MONTHLY", "DS_C", "SSH"]
    assert names("note") == [] and names("'") == []
    assert C.choose(C.search(cat, "ssh")).first().short_name == "SSH"
    assert C.choose(C.search(cat, "height"), option=2).first().short_name == "DS_B"


def test_status_ladder(spark):
    granules = spark.createDataFrame(
        [("a", "L?ShortName=A", "T", "S"), ("b", "L?ShortName=B", "T", "S"), ("c", "L?ShortName=C", "T", "S"), ("d", "L?ShortName=D", "T", "S")],
        "id string, link string, title string, summary string",
    )
    fixes = spark.createDataFrame([("a", "T", "A", "S"), ("b", "T", "B2", "S"), ("c", "other", "C", "S")], "id string, fix_title string, fix_short_name string, fix_summary string")
    got = {r.id: (r.status, r.new_link) for r in Q.header_status(granules, fixes).collect()}
    assert got == {"a": (0, "L?ShortName=A"), "b": (1, "L?ShortName=B2"), "c": (-1, "L?ShortName=C"), "d": (-1, "L?ShortName=D")}


def test_hidden_records_and_residual(spark):
    series = spark.createDataFrame(
        [(v, dt.datetime(2000, 1, 1, h), float(h + n)) for n, v in enumerate(("total", "a", "b")) for h in range(4)], "var string, time timestamp, value double"
    )
    hidden = S.hide_leading(series, ["var"], "time", F.when(F.col("var") == "a", 2).otherwise(0))
    assert hidden.filter("value is null").count() == 2
    out = P.budget_residual(series, "total", ["a", "b"]).orderBy("time").collect()
    assert [r.residual for r in out] == [float(h - (h + 1 + h + 2)) for h in range(4)]


def test_unknown_transform_is_an_error(spark):
    with pytest.raises(KeyError):
        P.apply_transforms(spark.range(1), ["nope"])


def test_leading_records_are_hidden_up_to_any_limit(spark):
    from tidelattice.operators.select import hide_leading

    df = spark.createDataFrame([("a", t, 1.0) for t in range(6)], "var string, time int, value double")
    left = hide_leading(df, ["var"], "time", F.lit(4)).filter("value IS NOT NULL").orderBy("time").collect()
    assert [r["time"] for r in left] == [4, 5]

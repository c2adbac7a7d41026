"""Whole products and jobs on small frames: bounds, ranges, notes, nearest cells, access and repair."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelattice.functions import dates as D
from tidelattice.operators import joins as J
from tidelattice.plans import products as P
from tidelattice.plans import quality as Q
from tidelattice.plans import subset as SB

RUN = ("1992-01-01 12:00:00", "2018-01-01 00:00:00")


def at(text):
    return dt.datetime.fromisoformat(text)


@pytest.mark.parametrize(
    "code, end, start, centre",
    [
        ("AVG_DAY", "2000-03-01", "2000-02-29", "2000-02-29T12:00"),
        ("AVG_MON", "2000-03-01", "2000-02-01", "2000-02-15T12:00"),
        ("AVG_DAY", "1992-01-02", "1992-01-01T12:00", "1992-01-01T18:00"),
        ("AVG_MON", "2018-01-01", "2017-12-01T12:00", "2017-12-16T18:00"),
        ("SNAPSHOT", "1992-01-01T12:00", "1992-01-01T12:00", "1992-01-01T12:00"),
        ("SNAPSHOT", "2018-01-01", "2018-01-01", "2018-01-01"),
    ],
)
def test_record_bounds(spark, code, end, start, centre):
    df = spark.createDataFrame([(at(end), code)], "time_end timestamp, code string")
    row = P.with_record_bounds(df, F.col("code"), *RUN).first()
    assert (row.time_start, row.time, row.time_end) == (at(start), at(centre), at(end))


def test_written_product_merges_variables_and_keeps_ranges_per_record(spark):
    rows = [("a", 1, "V0", 1.0), ("a", 2, "V0", 5.0), ("a", 1, "V1", None), ("b", 1, "V1", 7.0), ("b", None, "V1", 8.0)]
    values = spark.createDataFrame(rows, "rec string, k int, var string, value double")
    product, ranges = P.written_product(values, ["rec", "k"], ["V0", "V1"], ["rec"])
    got = {(r.rec, r.k): (r.V0, r.V1) for r in product.collect()}
    assert got == {("a", 1): (1.0, None), ("a", 2): (5.0, None), ("b", 1): (None, 7.0), ("b", None): (None, 8.0)}
    spans = {(r.rec, r["var"]): (r.valid_min, r.valid_max) for r in ranges.collect()}
    assert spans == {("a", "V0"): (1.0, 5.0), ("a", "V1"): (None, None), ("b", "V0"): (None, None), ("b", "V1"): (7.0, 8.0)}


@pytest.mark.parametrize(
    "rule, first, last, want",
    [
        ("compact", "20240203T01", "20240204T02", ("2024-02-03", "2024-02-04")),
        ("zone", "2024-02-03T01:00:00Z", "2024-02-03T05:00:00Z", ("2024-02-03T01:00", "2024-02-03T05:00")),
        ("plain", "2024-02-03 01:00:00", "2024-02-03 05:00:00", ("2024-02-03T01:00", "2024-02-03T05:00")),
        ("day", "2024-02-03 11:00:00", "x", ("2024-02-03", "2024-02-04")),
        ("no_time", "x", "y", ("2024-02-01", "2024-02-01")),
        ("time_bounds", "x", "y", ("2024-01-05", "2024-01-06")),
    ],
)
def test_file_bounds(spark, rule, first, last, want):
    pair = "struct<start: timestamp, end: timestamp>"
    rows = [(dt.date(2024, 2, 1), first, last, None, (at("2024-01-05"), at("2024-01-06")))]
    df = spark.createDataFrame(rows, f"date date, time_coverage_start string, time_coverage_end string, time_bnds {pair}, timebounds {pair}")
    got = df.select(D.file_bounds(rule, F.col("date"), df.columns).alias("b")).first().b
    assert (got.start, got.end) == tuple(at(x) for x in want)


def test_observation_year_takes_the_last_file_and_notes_gaps(spark):
    target = spark.createDataFrame([(0, 0.0, 0.0, 2e5), (1, 90.0, 0.0, 2e5)], "target_id long, lon double, lat double, radius double")
    obs = spark.createDataFrame(
        [
            ("x_202401_v1.nc", 1, 0.1, 0.0, 4.0), ("x_202401_v0.nc", 2, 0.1, 0.0, 9.0), ("x_202403_v0.nc", 3, 0.1, 0.0, -4.0),
            ("y_202404_v0.nc", 4, 0.1, 0.0, 3.0), ("x_202405_v0.nc", 5, 0.1, 0.0, 2.0),
        ],
        "path string, source_id long, lon double, lat double, value double",
    )
    files = obs.select("path", F.lit("2024-01-01T00:00:00Z").alias("time_coverage_start"), F.lit("2024-01-02T00:00:00Z").alias("time_coverage_end"))
    values, records = P.observation_year(
        obs, files, target, 2024, 3e5, "zone", ["remove_negative"], -1.0, time_scale="MONTHLY", pattern="yyyyMM", hemisphere="x_"
    )
    got = {(r.date.month, r.target_id): r.value for r in values.collect()}
    assert len(got) == 24 and {k: v for k, v in got.items() if v != -1.0} == {(1, 0): 4.0, (5, 0): 2.0}
    notes = {r.date.month: (r.path, r.notes, r.time_end) for r in records.collect()}
    assert notes[1] == ("x_202401_v1.nc", "", at("2024-01-02")) and notes[3][1] == "empty record"
    assert notes[4] == ("", "file not found", at("2024-05-01")) and len(notes) == 12


def nearest_by_hand(cells, lon, lat):
    wrapped = (cells[:, 0] - lon + 180.0) % 360.0 - 180.0
    dist = 111.1 * np.hypot(np.cos(np.radians(lat)) * wrapped, cells[:, 1] - lat)
    return dist.min()


@pytest.mark.parametrize("count, start", [(1, None), (3, 1.0), (400, None), (400, 0.25), (4000, None)])
def test_nearest_cells_against_all_pairs(spark, count, start):
    rng = np.random.default_rng(count)
    cells = np.column_stack([rng.uniform(-180, 180, count), rng.uniform(-90, 90, count)])
    cells[: count // 3] = cells[: count // 3] * 0.01 + [179.5, 85.0]
    cells[:, 0] = (cells[:, 0] + 180.0) % 360.0 - 180.0
    spots = np.vstack([
        np.column_stack([rng.uniform(-180, 180, 150), rng.uniform(-90, 90, 150)]),
        [[180.0, 0.0], [-180.0, 90.0], [10.0, -90.0], [179.99, 84.9], [540.0, 3.0]],
    ])
    rows = [(n, float(x), float(y)) for n, (x, y) in enumerate(cells)]
    cdf = spark.createDataFrame(rows, "i long, xc double, yc double")
    pdf = spark.createDataFrame([(n, float(x), float(y)) for n, (x, y) in enumerate(spots)], "point long, lon double, lat double")
    got = J.nearest_cells(cdf, pdf, ["i"], start).collect()
    assert len(got) == len(spots)
    for r in got:
        best = nearest_by_hand(cells, r.lon, r.lat)
        assert r.dist == pytest.approx(best, abs=1e-6)
        assert nearest_by_hand(cells[[r.i]], r.lon, r.lat) == pytest.approx(best, abs=1e-6)


def test_nearest_cells_without_cells_positions_and_with_repeats(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (1, 0.0, 0.0), (2, None, 5.0), (None, 1.0, 1.0)], "point long, lon double, lat double")
    cells = spark.createDataFrame([(7, 1.0, 0.0), (5, -1.0, 0.0), (9, None, 0.0)], "i long, xc double, yc double")
    got = sorted((r.point or 0, r.i) for r in J.nearest_cells(cells, points, ["i"]).collect())
    assert got == [(0, 7), (1, 5), (2, None)]
    assert [r.i for r in J.nearest_cells(cells.limit(0), points, ["i"]).collect()] == [None] * 3


def test_first_size_takes_the_first_entry(spark):
    listing = spark.createDataFrame([("a", None, 1), ("a", 5.0, 2), ("b", 3.0, 2), ("b", 4.0, 3)], "url string, size_mb double, at int")
    urls = spark.createDataFrame([("a",), ("b",), ("c",)], "url string")
    assert {r.url: r.size_mb for r in J.first_size(urls, listing, "at").collect()} == {"a": None, "b": 3.0, "c": None}


def test_access_thins_snapshots_unless_a_daily_dataset_is_found(spark):
    days = [dt.date(2000, 1, 1) + dt.timedelta(n) for n in range(40)]
    names = {"S_SNAPSHOT_V1": ("snap", "native,snapshot"), "D_DAILY_V1": ("day_mean", "native,daily")}
    field = spark.createDataFrame([(n, dt.datetime(d.year, d.month, d.day, 6), 1.0) for n in names for d in days], "short_name string, time timestamp, value double")
    listing = spark.createDataFrame(
        [(n, f"https://h/{n}/T_{p}_{d}_MODEL_V1_native_g.nc", 2.0, d, dt.datetime(d.year, d.month, d.day)) for n, (p, _) in names.items() for d in days if d.day != 20],
        "short_name string, url string, size_mb double, gdate date, time_start timestamp",
    )
    catalogue = spark.createDataFrame([(s, n, None, "T", "heat", e) for e, (n, (_, s)) in enumerate(names.items())],
                                      "section string, short_name string, note string, var string, description string, entry_id long")
    view = lambda rows, n: sorted(r.time.date() for r in rows.collect() if r.short_name == n)
    granules, rows = SB.access_dataset(field, listing, catalogue, "heat", "2000-01-05", "2000-02-03", "native")
    assert view(rows, "D_DAILY_V1") == days[4:34] and view(rows, "S_SNAPSHOT_V1") == days[4:35]
    assert granules.filter("filled").count() == 2
    _, thin = SB.access_dataset(field, listing, catalogue, "heat", "2000-01-05", "2000-02-03", "native", "snapshot")
    assert view(thin, "S_SNAPSHOT_V1") == [dt.date(2000, 2, 1)] and not view(thin, "D_DAILY_V1")


def test_repair_job_sorts_attributes_and_leaves_failed_granules(spark):
    granules = spark.createDataFrame(
        [("1", "S=?ShortName=A", "t", "s", "A", {"b": "1", "A": "2"}, {"V0": "m"}), ("2", "S=?ShortName=A", "u", "s", "A", {"b": "1", "A": "2"}, {"V0": "m"})],
        "id string, link string, title string, summary string, dataset string, attrs map<string,string>, units map<string,string>",
    )
    repairs = spark.createDataFrame([("1", "t", "A", "s"), ("2", "t", "A", "s")], "id string, fix_title string, fix_short_name string, fix_summary string")
    stored = spark.createDataFrame([("A", "V0", "f1", 0.0, 9.0), ("A", "V0", "f2", 0.0, 8.0)], "dataset string, var string, file string, valid_min double, valid_max double")
    new = spark.createDataFrame([("A", "V0", 0.0, 9.0)], "dataset string, var string, valid_min double, valid_max double")
    fixed, ranges, summary = Q.repair_job(granules, repairs, stored, new, new, patch={"b": None, "c": "3"})
    got = {r.id: (r.status, [(a.key, a.value) for a in r.attrs]) for r in fixed.collect()}
    assert got["1"] == (1, [("A", "2"), ("c", "3")])
    assert got["2"][0] == -1 and sorted(got["2"][1]) == [("A", "2"), ("b", "1")]
    assert {r.file: (r.status, r.valid_max) for r in ranges.collect()} == {"f1": (0, 9.0), "f2": (1, 9.0)}
    assert {r.status: r.n for r in summary.collect()} == {1: 1, -1: 1}

"""Binned mapping against brute force, with poles, date line, hot spots and missing values."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelattice.operators import regrid as R

RADIUS = 6371008.8


def distance(lon_a, lat_a, lon_b, lat_b):
    dlat, dlon = np.radians(lat_b - lat_a) / 2, np.radians(lon_b - lon_a) / 2
    h = np.sin(dlat) ** 2 + np.cos(np.radians(lat_a)) * np.cos(np.radians(lat_b)) * np.sin(dlon) ** 2
    return 2 * RADIUS * np.arcsin(np.minimum(1, np.sqrt(h)))


def points(seed, n):
    """Points everywhere; a third in one spot, some at the poles and on the date line."""
    rng = np.random.default_rng(seed)
    lon, lat = rng.uniform(-180, 180, n), np.degrees(np.arcsin(rng.uniform(-1, 1, n)))
    third = n // 3
    lon[:third], lat[:third] = 20 + rng.uniform(0, 0.5, third), 45 + rng.uniform(0, 0.5, third)
    lat[third : third + 10] = rng.choice([90.0, -90.0, 89.9, -89.9], 10)
    lon[third + 10 : third + 20] = rng.choice([-180.0, 179.99, -179.99], 10)
    return lon, lat


def grid(seed, n):
    rng = np.random.default_rng(seed)
    lon, lat = rng.uniform(-180, 180, n), rng.uniform(-90, 90, n)
    lat[:6], lon[6:12] = [90, -90, 89.5, -89.5, 88, -88], [-180, 179.9, -179.9, 179.5, -179.5, 180 - 1e-9]
    lon[12:16], lat[12:16] = 20.2, 45.2
    return lon, lat, rng.uniform(50e3, 600e3, n)


def frames(spark, seed, n=600, m=150, missing=0.2):
    lon, lat = points(seed, n)
    rng = np.random.default_rng(seed + 1)
    value = rng.normal(size=n)
    gone = rng.uniform(size=n) < missing
    tlon, tlat, radius = grid(seed + 2, m)
    source = spark.createDataFrame(
        [(i, float(a), float(b), None if g else float(v)) for i, (a, b, v, g) in enumerate(zip(lon, lat, value, gone))],
        "source_id long, lon double, lat double, value double",
    )
    target = spark.createDataFrame(
        [(i, float(a), float(b), float(r)) for i, (a, b, r) in enumerate(zip(tlon, tlat, radius))],
        "target_id long, lon double, lat double, radius double",
    )
    dist = distance(lon[None, :], lat[None, :], tlon[:, None], tlat[:, None])
    return source, target, dist, radius, np.where(gone, np.nan, value)


PATHS = [{}, {"broadcast_rows": 0, "rows_per_split": 20}]


@pytest.mark.parametrize("options", PATHS, ids=["broadcast", "shuffle-split"])
def test_pairs_equal_brute_force(spark, options):
    source, target, dist, radius, _ = frames(spark, 1)
    got = {
        (r.target_id, r.source_id)
        for r in R.radius_pairs(source, target, neighbours=None, **options).collect()
    }
    inside = dist <= np.minimum(radius, math.floor(radius.max()))[:, None]
    assert got == set(zip(*(a.tolist() for a in np.nonzero(inside))))
    rows = R.radius_pairs(source, target, neighbours=None, **options).count()
    assert rows == len(got)


@pytest.mark.parametrize("options", PATHS, ids=["broadcast", "shuffle-split"])
def test_nearest_equals_brute_force(spark, options):
    source, target, dist, _, _ = frames(spark, 2)
    got = {r.target_id: r.source_id for r in R.nearest_pairs(source, target, 800e3, **options).collect()}
    want = {t: int(d.argmin()) for t, d in enumerate(dist) if d.min() <= 800e3}
    assert got == want


@pytest.mark.parametrize("neighbours", [5, None])
def test_edges_and_fallback(spark, neighbours):
    source, target, dist, radius, _ = frames(spark, 3)
    edges = R.mapping_edges(source, target, 900e3, neighbours).collect()
    want = set()
    for t, d in enumerate(dist):
        near = [int(s) for s in np.argsort(d, kind="stable") if d[s] <= min(radius[t], math.floor(radius.max()))]
        if near:
            want |= {(t, s, False) for s in near[:neighbours]}
        elif d.min() <= 900e3:
            want.add((t, int(d.argmin()), True))
    assert {(e.target_id, e.source_id, e.is_fallback) for e in edges} == want


REDUCERS = {
    "mean": lambda v, d: float("nan") if np.isnan(v).any() else v.mean(),
    "nanmean": lambda v, d: np.nan if np.isnan(v).all() else np.nanmean(v),
    "median": lambda v, d: float("nan") if np.isnan(v).any() else np.median(v),
    "nanmedian": lambda v, d: np.nan if np.isnan(v).all() else np.nanmedian(v),
    "nearest": lambda v, d: v[d.argmin()],
}


@pytest.mark.parametrize("operation", sorted(REDUCERS))
@pytest.mark.parametrize("missing", [0.0, 0.2, 1.0])
def test_reductions(spark, operation, missing):
    source, target, dist, radius, value = frames(spark, 4, missing=missing)
    one_pass = R.regrid_points(source, target, operation, longest=900e3)
    edges = R.mapping_edges(source, target, 900e3, neighbours=None)
    two_step = R.apply_mapping(edges, source.select("source_id", "value"), operation, group=())
    for out in (one_pass, two_step):
        got = {r.target_id: r for r in out.collect()}
        for t, d in enumerate(dist):
            inside = d <= min(radius[t], math.floor(radius.max()))
            if inside.any():
                want = REDUCERS[operation](value[inside], d[inside])
            elif d.min() <= 900e3:
                want = value[d.argmin()]
            else:
                assert t not in got
                continue
            have = got[t].value
            assert (have is None) == bool(np.isnan(want))
            assert have is None or have == pytest.approx(want, abs=1e-9)


def test_mean_equals_nanmean_without_missing(spark):
    source, target, *_ = frames(spark, 5, missing=0.0)
    a = {r.target_id: r.value for r in R.regrid_points(source, target, "mean").collect()}
    b = {r.target_id: r.value for r in R.regrid_points(source, target, "nanmean").collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)


def test_counts_keep_zeros(spark):
    source, target, dist, radius, _ = frames(spark, 6)
    got = {r.target_id: r.n_source for r in R.source_counts(source, target).collect()}
    want = (dist <= np.minimum(radius, math.floor(radius.max()))[:, None]).sum(axis=1)
    assert got == dict(enumerate(want.tolist()))


def test_no_cap_touches_more_bins_than_stated(spark):
    """The bound behind broadcasting without a count."""
    for widest in (20e3, 300e3, 2000e3):
        lat = [float(x) for x in np.linspace(-90, 90, 721)]
        target = spark.createDataFrame(
            [(i, 12.3, v, widest) for i, v in enumerate(lat)], "target_id long, lon double, lat double, radius double"
        ).withColumn("_reach", F.col("radius"))
        width = math.degrees(widest / RADIUS)
        most = R.binned_targets(target, width).groupBy("target_id").count().agg(F.max("count")).first()[0]
        assert most <= R.MOST_BINS_PER_TARGET


def test_plans_have_no_pairwise_join(spark):
    source, target, *_ = frames(spark, 7)
    for options in PATHS:
        for neighbours in (None, 100):
            pairs = R.radius_pairs(source, target, neighbours=neighbours, **options)
            plan = pairs._jdf.queryExecution().executedPlan().toString()
            assert "NestedLoop" not in plan and "Cartesian" not in plan
            # Only a limit ranks, and it does so before the shuffle.
            assert ("WindowGroupLimit" in plan) == (neighbours is not None)
    broadcast = R.regrid_points(source, target, "mean")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in broadcast and "SortMergeJoin" not in broadcast


def test_a_cell_without_a_radius_has_only_a_fallback(spark):
    source = spark.createDataFrame([(1, 0.0, 0.0)], "source_id long, lon double, lat double")
    cells = [(1, 0.0, 0.001, None), (2, 0.0, 0.001, float("nan")), (3, 0.0, 0.001, 1000.0)]
    target = spark.createDataFrame(cells, "target_id long, lon double, lat double, radius double")
    assert [r.target_id for r in R.radius_pairs(source, target).collect()] == [3]
    edges = R.mapping_edges(source, target, 5000.0).collect()
    assert {r.target_id: r.is_fallback for r in edges} == {1: True, 2: True, 3: False}


def test_no_cap_on_partners(spark):
    source = spark.range(250).selectExpr("id AS source_id", "id / 1000D AS lon", "0D AS lat", "double(id) AS value")
    target = spark.sql("SELECT 0L AS target_id, 0D AS lon, 0D AS lat, 100000D AS radius")
    assert R.radius_pairs(source, target).count() == 250
    assert R.radius_pairs(source, target, neighbours=200).count() == 200
    edges = R.mapping_edges(source, target, 200e3)
    assert edges.count() == 250
    out = R.apply_mapping(edges, source.select("source_id", "value"), "mean", group=()).first()
    assert (out.value, out.n_source) == (124.5, 250)

"""A NULL key, such as the level of a 2-D field, is a key like any other; ranks and ranges spread over tasks."""

import random

import pytest
from pyspark.sql import functions as F

from tidelattice.operators import aggregate as A
from tidelattice.operators import joins as J
from tidelattice.operators import regrid as R
from tidelattice.operators import scale
from tidelattice.operators import select as S
from tidelattice.operators import windows as W

ROWS = [(None, 1, 1.0), (None, 2, 3.0), (0, 1, 5.0), (0, 2, None), (1, 1, 7.0)]


@pytest.fixture(scope="module")
def levels(spark):
    return spark.createDataFrame(ROWS, "k int, day int, value double")


def values(frame, *names):
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=str)


def test_anomaly_and_empty_days(levels):
    assert values(A.anomaly(levels, ["k"]), "k", "day", "value") == sorted(
        [(None, 1, -1.0), (None, 2, 1.0), (0, 1, 0.0), (0, 2, None), (1, 1, 0.0)], key=str
    )
    assert values(A.without_empty_days(levels, ["k", "day"]), "k", "day") == sorted([(None, 1), (None, 2), (0, 1), (1, 1)], key=str)


def test_difference_and_median(levels):
    got = J.difference(levels, levels.withColumn("value", F.col("value") * 2), ["k", "day"])
    assert values(got, "k", "day", "value") == sorted([(None, 1, -1.0), (None, 2, -3.0), (0, 1, -5.0), (0, 2, None), (1, 1, -7.0)], key=str)
    assert values(scale.exact_median(levels, ["k"], "value", "m"), "k", "m") == sorted([(None, 2.0), (0, 5.0), (1, 7.0)], key=str)


def test_blocks_keep_null_keys(levels):
    sums = scale.running_sum(levels.fillna(0.0, ["value"]), ["k"], ["day"], "value", F.col("day"), "s")
    assert values(sums, "k", "day", "s") == sorted([(None, 1, 1.0), (None, 2, 4.0), (0, 1, 5.0), (0, 2, 5.0), (1, 1, 7.0)], key=str)
    carried = scale.carry_forward(levels, ["k"], "day", {"v": F.col("value")}, 1)
    assert values(carried, "k", "day", "v") == sorted([(None, 1, 1.0), (None, 2, 3.0), (0, 1, 5.0), (0, 2, 5.0), (1, 1, 7.0)], key=str)


def test_wet_points_of_a_field_without_levels(spark):
    grid = spark.createDataFrame([(0, 1, 0, 0, 1.0), (0, 1, 0, 1, 0.0), (1, 1, 0, 0, 0.0)], "k int, tile int, j int, i int, hfac double")
    cells = [(None, 1, 0, 0, 1.0), (None, 1, 0, 1, 2.0), (0, 1, 0, 0, 3.0), (1, 1, 0, 0, 4.0)]
    field = spark.createDataFrame(cells, "k int, tile int, j int, i int, value double")
    assert values(S.wet_points(field, grid), "k", "i", "value") == sorted([(None, 0, 1.0), (0, 0, 3.0)], key=str)
    rows = values(S.wet_points(field, grid, keep_rows=True), "k", "i", "value")
    assert rows == sorted([(None, 0, 1.0), (None, 1, None), (0, 0, 3.0), (1, 0, None)], key=str)


def test_median_of_a_null_group(spark):
    source = spark.createDataFrame([(k, 0.0, 0.001 * k, float(k), None) for k in range(5)], "source_id long, lon double, lat double, value double, g string")
    target = spark.createDataFrame([(1, 0.0, 0.0, 1e5)], "target_id long, lon double, lat double, radius double")
    got = R.regrid_points(source, target, "nanmedian", group=("g",)).collect()
    assert [(r.g, r.value, r.n_source) for r in got] == [(None, 2.0, 5)]


def test_range_rank_equals_a_sort(spark):
    pick = random.Random(0)
    rows = [(pick.choice(["a", "b", None]), pick.random(), k) for k in range(3000)]
    frame = spark.createDataFrame(rows, "key string, x double, id long")
    whole = {r.id: r["rank"] for r in scale.range_rank(frame, ["x"], "rank", parts=7).collect()}
    assert whole == {k: n for n, (_, _, k) in enumerate(sorted(rows, key=lambda r: r[1]), 1)}
    for parts in (1, 7, 40):
        keyed = {r.id: r["rank"] for r in scale.range_rank(frame, [F.desc("x")], "rank", keys=["key"], parts=parts).collect()}
        for key in ("a", "b", None):
            own = sorted((r for r in rows if r[0] == key), key=lambda r: -r[1])
            assert [keyed[r[2]] for r in own] == list(range(1, len(own) + 1))
    assert scale.range_rank(frame.limit(0), ["x"], "rank").count() == 0


def test_names_with_one_long_prefix_spread_over_tasks(spark):
    names = spark.range(1000).selectExpr("concat(repeat('same beginning ', 20), lpad(id, 4, '0')) AS name")
    assert {r.name[-4:]: r.number for r in W.dense_number(names.union(names), "name").collect()} == {f"{k:04d}": k for k in range(1000)}
    ranged = scale.sorted_ranges(names, ["name"], 8)
    sizes = [r["count"] for r in ranged.groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 300
    plan = W.dense_number(names, "name")._jdf.queryExecution().executedPlan().toString()
    # What meets in one task is a row per range, behind a partial count.
    assert plan.count("SinglePartition") <= 1


def test_nearest_time_holds_no_window_over_a_variable(spark):
    series = spark.range(2000).selectExpr("'v' AS var", "timestamp_seconds(id * 60) AS time", "double(id) AS value")
    probes = spark.range(50).selectExpr("'v' AS var", "timestamp_seconds(id * 2000 + 31) AS probe")
    found = J.nearest_time_join(probes, series, ["var"], parts=16)
    assert found.count() == 50 and found.filter("abs(unix_seconds(time) - unix_seconds(probe)) > 30").count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_part" in plan and "hashpartitioning(var#" not in plan.split("range-edges")[0]

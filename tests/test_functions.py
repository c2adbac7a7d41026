"""Properties of index arithmetic, geometry, dates and missing values."""

import math

import pytest
from pyspark.sql import functions as F

from tidelattice.functions import dates as D
from tidelattice.functions import geometry as G
from tidelattice.functions import gridindex as X
from tidelattice.functions import missing as M
from tidelattice.functions import strings as T
from tidelattice.operators import sets as O
from tidelattice.operators.joins import stem_and_tail
from tidelattice.operators.select import choose_columns, hyperslab, interface_slice
from tidelattice.plans.grids import regular_grid


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


@pytest.mark.parametrize("n", [1, 2, 5])
def test_layouts_are_bijections(spark, n):
    cells = spark.range(13 * n * n).select(
        F.floor(F.col("id") / (n * n)).alias("tile"), F.floor(F.col("id") / n) % n, F.col("id") % n
    ).toDF("tile", "j", "i")
    tile, j, i = F.col("tile"), F.col("j"), F.col("i")
    spot, face = X.tile_to_compact(tile, j, i, n), X.tile_to_face(tile, j, i, n)
    out = cells.select("*", spot.alias("s"), face.alias("f")).withColumns(
        {
            "back": X.compact_to_tile(F.col("s.row"), F.col("s.col"), n),
            "unface": X.face_to_tile(F.col("f.face"), F.col("f.row"), F.col("f.col"), n),
            "again": X.face_to_compact(F.col("f.face"), F.col("f.row"), F.col("f.col"), n),
        }
    )
    rows = out.collect()
    assert len({tuple(r.s) for r in rows}) == len({tuple(r.f) for r in rows}) == 13 * n * n
    for r in rows:
        assert tuple(r.back) == tuple(r.unface) == (r.tile, r.j, r.i)
        assert r.again == r.s
        assert 0 <= r.s.row < 13 * n and 0 <= r.s.col < n


def test_four_quarter_turns(spark):
    cell = F.struct(F.lit(1).alias("j"), F.lit(3).alias("i"))
    for _ in range(4):
        cell = X.quarter_turn(cell["j"], cell["i"], 5)
    assert tuple(one(spark, c=cell).c) == (1, 3)


def test_sphere_area(spark):
    total = regular_grid(spark, 5, 5).agg(F.sum("area")).first()[0]
    assert total == pytest.approx(4 * math.pi * G.EARTH_RADIUS**2)


def test_wrap_and_box(spark):
    got = one(spark, a=G.wrap_longitude(F.lit(190.0)), b=G.wrap_longitude(F.lit(-180.0)), c=G.wrap_longitude(F.lit(180.0)))
    assert tuple(got) == (-170.0, -180.0, -180.0)
    inside = lambda lon: one(spark, x=G.in_box(F.lit(lon), F.lit(0.0), -10, 10, 170, -170)).x
    assert inside(175.0) and inside(-175.0) and not inside(0.0)


def test_partial_dates(spark):
    got = one(spark, a=D.first_day_of(F.lit("2000-02")), b=D.last_day_of(F.lit("2000-02")), c=D.last_day_of(F.lit("1999")))
    assert [str(x) for x in got] == ["2000-02-01", "2000-02-29", "1999-12-31"]


@pytest.mark.parametrize(
    "bad",
    [
        lambda: D.first_day_of(F.lit("20000")),
        lambda: D.last_day_of(F.lit("x")),
        lambda: D.period_start(F.lit("2000-01-01").cast("timestamp"), F.lit("AVG_HOUR")),
        lambda: D.from_date_code(F.lit("2000"), F.lit("yyyy")),
        lambda: stem_and_tail(F.lit("no_period_2000-01_MODEL_V1_x.nc")),
        lambda: O.parse_request_key(F.lit("native")),
    ],
)
def test_errors_are_raised(spark, bad):
    with pytest.raises(Exception, match="USER_RAISED_EXCEPTION"):
        spark.range(1).select(bad()).collect()


def test_month_bounds_clip(spark):
    end = F.lit("2000-03-31 00:00:00").cast("timestamp")
    got = one(spark, b=D.time_bounds(end, F.lit("AVG_MON"))).b
    assert str(got.start) == "2000-02-29 00:00:00" and str(got.centre) == "2000-03-15 12:00:00"


def test_clamped_bounds(spark):
    import datetime as dt

    ts = lambda s: F.lit(s).cast("timestamp")
    last = one(spark, b=D.clamp_bounds(ts("2017-12-31"), ts("2018-01-01"), F.lit(D.MODEL_START), F.lit(D.MODEL_END))).b
    first = one(spark, b=D.clamp_bounds(ts("1992-01-01"), ts("1992-01-02"), F.lit(D.MODEL_START), F.lit(D.MODEL_END))).b
    assert last.start == dt.datetime(2017, 12, 31, 12) and last.centre == dt.datetime(2017, 12, 31, 18)
    assert first.start == dt.datetime(1992, 1, 1, 12) and first.centre == dt.datetime(1992, 1, 1, 18)


def test_snapshot_extent_and_tokens(spark):
    lo, hi = F.lit("2017-12-30").cast("date"), F.lit("2018-02-01").cast("date")
    got = one(
        spark,
        snap=D.expected_dates(F.lit("X_SNAPSHOT_V"), lo, hi, "v4r4"),
        mean=D.expected_dates(F.lit("X_DAILY_V"), lo, hi, "v4r4"),
        monthly=D.expand_date_token(F.lit("2001-05-17"), F.lit("X_SNAPSHOT"), "monthly"),
        year=D.expand_date_token(F.lit("2001"), F.lit("X_SNAPSHOT")),
    )
    assert str(got.snap[-1]) == "2018-01-01" and str(got["mean"][-1]) == "2017-12-31"
    assert [str(d) for d in got.monthly] == ["2001-05-01", "2001-06-01"]
    assert len(got.year) == 13


def test_missing_values(spark):
    nan = F.lit(float("nan"))
    got = one(spark, a=M.fill_missing(nan, -9999), b=M.fill_missing(F.lit(None).cast("double"), -1), c=M.fill_missing(F.lit(2.0), -1))
    assert tuple(got) == (-9999.0, -1.0, 2.0)
    df = spark.createDataFrame([("all", 1.0), ("all", 3.0), ("some", 1.0), ("some", float("nan")), ("none", float("nan"))], "g string, v double")
    rows = {
        r.g: (r.strict, r.loose, r.top)
        for r in M.normalise_missing(df, "v").groupBy("g").agg(
            M.mean_all_present(F.col("v")).alias("strict"), M.mean_present(F.col("v")).alias("loose"), F.max("v").alias("top")
        ).collect()
    }
    assert rows == {"all": (2.0, 2.0, 3.0), "some": (None, 1.0, 1.0), "none": (None, None, None)}


def test_hyperslab_clamps_and_ignores_absent_dims(spark):
    df = spark.range(13).select(F.col("id").alias("tile"))
    out = hyperslab(df, {"tile": (-2, 99, 5), "Z": (0, 1, 1)}, {"tile": (1, 12)})
    assert [r.tile for r in out.orderBy("tile").collect()] == [1, 6, 11]
    assert interface_slice((0, 4, 2)) == (0, 5, 2)


def test_wide_variable_choice(spark):
    df = spark.range(1).select(*[F.lit(1).alias(c) for c in ("time", "XC", "YC", "SSH", "SALT")])
    assert choose_columns(df, ["time"], include=["SSH"]).columns == ["time", "XC", "YC", "SSH"]
    assert choose_columns(df, ["time"], omit=["SSH"], latlon_coords=False).columns == ["time", "SALT"]
    assert "XC" in choose_columns(df, ["time"], latlon_coords=False, geometry=True).columns
    deep = df.select("*", *[F.lit(1).alias(c) for c in ("nv", "Zl", "time_bnds")])
    assert choose_columns(deep, ["time", "nv"], include=["SALT"], omit=["SALT"]).columns == ["time", "XC", "YC", "SALT", "Zl", "time_bnds"]
    assert choose_columns(deep, ["time"], omit=["Zl", "time"]).columns == ["time", "XC", "YC", "SSH", "SALT", "time_bnds"]


def test_url_template(spark):
    url = F.lit("https://h/DS_L4_X_V1/SSH_day_mean_2000-01-01_MODEL_V1_latlon_g.nc")
    got = one(spark, u=T.with_date_token(url, F.lit("2001-02-03")), d=T.granule_date_text(url))
    assert got.u == "https://h/DS_L4_X_V1/SSH_day_mean_2001-02-03_MODEL_V1_latlon_g.nc" and got.d == "2000-01-01"

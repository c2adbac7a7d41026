"""Projections, filters and per-value rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import missing as M
from ..functions.attrs import rename_by_list
from ..functions.geometry import in_box
from ..operators import select as S
from ..operators import windows as W
from ..operators.joins import merge_variables, on_dates
from ..plans.products import apply_transforms, budget_residual
from ..sources.derived import FIELD_N
from .registry import query
from .text import day, r6, stamp



def field_cols():
    return ["dataset", stamp("time").alias("time"), "k", "tile", "j", "i", "var"]


FIELD_SQL = "dataset, strftime(\"time\", '%Y-%m-%d %H:%M:%S') AS \"time\", k, tile, j, i, var"


@query(
    "prj_1",
    f"""
SELECT {FIELD_SQL.replace(', var', '')}, CAST(k * -10 - 10 AS BIGINT) AS "Zl", max(value) FILTER (var = 'V0') AS "V0", max(value) FILTER (var = 'V2') AS "V2"
FROM dayfield GROUP BY dataset, "time", k, tile, j, i
""",
)
def prj_1(t):
    """A wide file: two variables asked for, so depths come along; the positions of cells and the bounds dimension do not."""
    dims = ["dataset", "time", "k", "tile", "j", "i", "nv"]
    wide = merge_variables(t.daily(), dims[:-1], ["V0", "V1", "V2"]).withColumns(
        {"time": stamp("time"), "XC": F.col("i") * 1.0, "Zl": (F.col("k") * -10 - 10).cast("long"), "nv": F.lit(2)}
    )
    return S.choose_columns(wide, dims, include=["V0", "V2"], omit=["V0", "Zl"], latlon_coords=False)


@query("prj_2", f"SELECT {FIELD_SQL}, value FROM field WHERE tile >= 2 AND tile <= 12 AND (tile - 2) % 3 = 0 AND j >= 0 AND j <= 2 AND k = 0")
def prj_2(t):
    slices = {"tile": (2, 40, 3), "j": (-4, 3, 1), "k": (0, 1, 1), "latitude": (0, 10, 1)}
    bounds = {"tile": (0, 12), "j": (0, FIELD_N - 1), "k": (0, 1)}
    return S.hyperslab(t.field(), slices, bounds).select(*field_cols(), "value")


@query("prj_3", f"SELECT {FIELD_SQL}, value FROM field WHERE CAST(\"time\" AS DATE) BETWEEN DATE '2000-01-15' AND DATE '2000-02-29'")
def prj_3(t):
    return S.between_days(t.field(), "2000-01-15", "2000-02-29").select(*field_cols(), "value")


@query(
    "prj_4",
    """
SELECT url, strftime(gdate, '%Y-%m-%d') AS "date" FROM gran
WHERE (short_name LIKE '%MONTHLY%' AND (year(gdate) = 1997 OR gdate IN (DATE '1998-03-01', DATE '2000-05-01')))
   OR (short_name LIKE '%DAILY%' AND (year(gdate) = 1997 OR (year(gdate) = 1998 AND month(gdate) = 3) OR gdate = DATE '2000-05-17'))
   OR (short_name LIKE '%SNAPSHOT%' AND ((day(gdate) = 1 AND (year(gdate) = 1997 OR gdate IN (DATE '1998-01-01', DATE '1998-03-01', DATE '1998-04-01'))) OR gdate = DATE '2000-05-17'))
""",
)
def prj_4(t):
    from ..functions.dates import expand_date_token

    granules = t.granules()
    tokens = F.explode(F.array(F.lit("1997"), F.lit("1998-03"), F.lit("2000-05-17")))
    names = granules.select("short_name").distinct().withColumn("token", tokens)
    dates = names.select("short_name", F.explode(expand_date_token(F.col("token"), F.col("short_name"))).alias("gdate"))
    return on_dates(granules, dates, ["short_name", "gdate"]).select("url", day("gdate").alias("date"))


@query("prj_5", "SELECT url, strftime(gdate, '%Y-%m-%d') AS \"date\" FROM gran WHERE day(gdate) = 1")
def prj_5(t):
    return S.month_firsts(t.granules(), "gdate").select("url", day("gdate").alias("date"))


BOX_SQL = """yc BETWEEN CAST(-85.5 AS DOUBLE) AND CAST(40 AS DOUBLE)
  AND (((xc - CAST(150.15 AS DOUBLE) - CAST(0.00001 AS DOUBLE)) % 360) + 360) % 360 <= CAST(99.69999 AS DOUBLE)"""


@query("prj_6", f"SELECT tile, j, i, round(xc, 6) AS xc, yc FROM cells WHERE {BOX_SQL}")
def prj_6(t):
    box = in_box(F.col("xc"), F.col("yc"), -85.5, 40, 150.15, -110.15)
    return t.cells().filter(box).select("tile", "j", "i", r6("xc").alias("xc"), "yc")


DEPTHS = """
SELECT profile, k, dr, -sum(dr) OVER (PARTITION BY profile ORDER BY k) AS zl,
       -(sum(dr) OVER (PARTITION BY profile ORDER BY k) - dr) AS zu FROM layers
"""


def depths(t):
    return W.depth_bounds(t.layers(), ["profile"], block=16)


@query("prj_7", f"SELECT profile, k, round(zu, 6) AS zu, round(zl, 6) AS zl FROM ({DEPTHS}) WHERE zu < 0 AND zl > -2000")
def prj_7(t):
    return S.depth_range(depths(t), 0, -2000).select("profile", "k", r6("zu").alias("zu"), r6("zl").alias("zl"))


@query("prj_8", f"SELECT {FIELD_SQL}, value FROM field WHERE tile = 7")
def prj_8(t):
    return t.field().filter(F.col("tile") == 7).select(*field_cols(), "value")


@query(
    "prj_9",
    f"""
SELECT {FIELD_SQL}, CASE WHEN hfac > 0 THEN value END AS value, hfac > 0 AS wet
FROM field JOIN gridmask USING (k, tile, j, i)
""",
)
def prj_9(t):
    wet = S.wet_points(t.field(), t.mask()).withColumn("wet", F.lit(True))
    dry = S.wet_points(t.field(), t.mask(), keep_rows=True).join(
        t.mask().filter(F.col("hfac") <= 0).select("k", "tile", "j", "i"), ["k", "tile", "j", "i"], "left_semi"
    )
    return wet.unionByName(dry.withColumn("wet", F.lit(False))).select(*field_cols(), "value", "wet")


@query(
    "prj_10",
    f"""
SELECT {FIELD_SQL}, loc, CASE WHEN CASE loc WHEN 'c' THEN maskc WHEN 'w' THEN maskw ELSE masks END THEN value END AS value
FROM field JOIN gridmask USING (k, tile, j, i)
""",
)
def prj_10(t):
    return S.land_mask(t.field(), t.mask()).select(*field_cols(), "loc", "value")


@query("prj_11", f"SELECT {FIELD_SQL}, coalesce(value, CAST(-9999 AS DOUBLE)) AS value FROM field")
def prj_11(t):
    return t.field().select(*field_cols(), M.fill_missing(F.col("value"), -9999).alias("value"))


@query("prj_12", "SELECT source_id, CASE WHEN value >= 100 THEN round(value - CAST(100 AS DOUBLE), 6) END AS value FROM obs")
def prj_12(t):
    shifted = t.obs().withColumn("value", F.col("value") - 100.0)
    return apply_transforms(shifted, ["remove_negative"]).select("source_id", r6("value").alias("value"))


@query("prj_13", "SELECT source_id, var, round(CASE WHEN var = 'view' THEN value - CAST(273.15 AS DOUBLE) ELSE value END, 6) AS value FROM obs")
def prj_13(t):
    v = S.kelvin_to_celsius(F.col("var"), F.col("value"), "view")
    return t.obs().select("source_id", "var", r6(v).alias("value"))


@query("prj_14", "SELECT source_id, var, round(CASE WHEN var = 'click' THEN value / CAST(100 AS DOUBLE) ELSE value END, 6) AS value FROM obs")
def prj_14(t):
    v = S.percent_to_fraction(F.col("var"), F.col("value"), "click")
    return t.obs().select("source_id", "var", r6(v).alias("value"))


@query("prj_15", f"SELECT {FIELD_SQL}, round(CAST(CAST(value / CAST(7 AS DOUBLE) AS FLOAT) AS DOUBLE), 3) AS value FROM field")
def prj_15(t):
    stored = (F.col("value") / 7.0).cast("float")
    return t.field().select(*field_cols(), F.round(stored.cast("double"), 3).alias("value"))


@query("prj_16", "SELECT s_suppkey, 'SSH' AS v0, CASE WHEN s_suppkey % 2 = 0 THEN 'TEMP' ELSE 'V1' END AS v1, 'W9' AS other FROM meta")
def prj_16(t):
    named = lambda n: rename_by_list(F.lit(n), F.col("rename"))
    return t.metadata().select("s_suppkey", named("V0").alias("v0"), named("V1").alias("v1"), named("W9").alias("other"))


@query("prj_17", f"SELECT {FIELD_SQL}, value FROM field WHERE var <> 'V1'")
def prj_17(t):
    return S.choose_variables(t.field(), omit=["V1"]).select(*field_cols(), "value")


@query(
    "prj_18",
    """
SELECT strftime("time", '%Y-%m-%d %H:%M:%S') AS "time", var,
  CASE WHEN row_number() OVER (PARTITION BY var ORDER BY "time") > CASE WHEN regexp_matches(var, 'sign|err') THEN 1 ELSE 2 END THEN value END AS value
FROM series
""",
)
def prj_18(t):
    limit = F.when(F.col("var").rlike("sign|err"), 1).otherwise(2)
    return S.hide_leading(t.series(), ["var"], "time", limit).select(stamp("time").alias("time"), "var", "value")


@query(
    "prj_19",
    f"""
WITH d AS (SELECT profile, k, CASE WHEN profile % 2 = 0 THEN zu ELSE zl END - 1 AS zu, CASE WHEN profile % 2 = 0 THEN zl ELSE zu END - 1 AS zl FROM ({DEPTHS})),
s AS (SELECT profile, k, CASE WHEN profile % 3 = 0 THEN -zu ELSE zu END AS zu, zl FROM d),
f AS (SELECT *, first_value(zu) OVER (PARTITION BY profile ORDER BY k) AS first_zu FROM s)
SELECT profile, k, round(CASE WHEN first_zu < 0 THEN zu ELSE zl END, 6) AS zu, round(CASE WHEN first_zu < 0 THEN zl ELSE zu END, 6) AS zl,
       NOT first_zu < 0 AS swapped FROM f
""",
)
def prj_19(t):
    even, third = F.col("profile") % 2 == 0, F.col("profile") % 3 == 0
    mixed = depths(t).select(
        "profile", "k",
        (F.when(even, F.col("zu")).otherwise(F.col("zl")) - 1.0).alias("zu"),
        (F.when(even, F.col("zl")).otherwise(F.col("zu")) - 1.0).alias("zl"),
    ).withColumn("zu", F.when(third, -F.col("zu")).otherwise(F.col("zu")))
    return S.layer_swap(mixed, ["profile"]).select("profile", "k", r6("zu").alias("zu"), r6("zl").alias("zl"), "swapped")


@query("prj_20", "SELECT source_id, coalesce(CASE WHEN source_id % 3 = 0 THEN NULL ELSE value END, CAST(-1 AS DOUBLE)) AS value FROM obs")
def prj_20(t):
    """New values laid over a default; both NULL and NaN count as no new value."""
    new = F.when(F.col("source_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return t.obs().select("source_id", S.overlay(new, F.lit(-1.0)).alias("value"))


@query(
    "prj_21",
    """
WITH w AS (SELECT "time", max(value) FILTER (var = 'view') AS a, max(value) FILTER (var = 'click') AS b, max(value) FILTER (var = 'purchase') AS c
           FROM series GROUP BY "time")
SELECT strftime("time", '%Y-%m-%d %H:%M:%S') AS "time", round(b + c, 6) AS term_sum, round(a - (b + c), 6) AS residual FROM w
""",
)
def prj_21(t):
    out = budget_residual(t.series(), "view", ["click", "purchase"])
    return out.select(stamp("time").alias("time"), r6("term_sum").alias("term_sum"), r6("residual").alias("residual"))


@query("prj_22", "SELECT source_id, CASE WHEN ts < TIMESTAMP '2024-01-15 06:00:00' THEN round(lat, 6) END AS lat FROM obs")
def prj_22(t):
    limit = F.lit("2024-01-15 06:00:00").cast("timestamp")
    return t.obs().select("source_id", S.track_before(F.col("ts"), limit, r6("lat")).alias("lat"))


@query("ud_1", "SELECT source_id, var, round(CASE WHEN value >= 0 THEN value * 2 END, 6) AS value FROM obs")
def ud_1(t):
    """User transforms are plain DataFrame functions, registered by name and applied in order."""
    from ..plans.products import register_transform

    register_transform("doubled", lambda df: df.withColumn("value", F.col("value") * 2.0))
    out = apply_transforms(t.obs(), ["remove_negative", "kelvin_to_celsius", "percent_to_fraction", "doubled"])
    return out.select("source_id", "var", r6("value").alias("value"))


@query("ud_2", "SELECT s_suppkey, lower(s_name) || ' (' || n_name || ')' AS title FROM meta")
def ud_2(t):
    """A callable modifier sees the old value and may use any other column."""
    from ..functions.attrs import patch_attributes

    modifier = lambda old: F.concat(F.lower(old), F.lit(" ("), F.col("attrs")["author"], F.lit(")"))
    patched = patch_attributes(F.col("attrs"), {"Title": modifier})
    return t.metadata().select("s_suppkey", patched["Title"].alias("title"))

"""Projections, filters and per-value rules on long fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.missing import null_if_nan
from .scale import dimension, summary_side

# Horizontal coordinates of the native grid, the other coordinates, the dimensions of bounds, and
# field location -> mask column.
LATLON_COORDS = ("XC", "YC", "XG", "YG", "XC_bnds", "YC_bnds")
OTHER_COORDS = ("time_bnds", "Zl", "Zu", "Zp1", "Z_bnds", "latitude_bnds", "longitude_bnds")
BOUNDS_DIMS = ("nb", "nv")
LOCATION_MASK = {"c": "maskc", "w": "maskw", "s": "masks"}


def choose_variables(
    df: DataFrame, include: Sequence[str] | str = "all", omit: Sequence[str] | None = None
) -> DataFrame:
    """PRJ-1 / PRJ-17: an include list wins; only with `all` does the omit list apply."""
    if include != "all":
        return df.filter(F.col("var").isin(*include))
    if omit:
        return df.filter(~F.col("var").isin(*omit))
    return df


def choose_columns(
    df: DataFrame,
    dims: Sequence[str],
    include: Sequence[str] | str = "all",
    omit: Sequence[str] | None = None,
    latlon_coords: bool = True,
    geometry: bool = False,
) -> DataFrame:
    """PRJ-1 on a wide frame: an include list wins, and coordinates come along with it; only with `all` does the omit list apply.

    Dimensions stay, but for those of bounds.  Horizontal coordinates may go, except from geometry products.
    An omit list may name coordinates too.
    """
    dropped = set() if latlon_coords or geometry else set(LATLON_COORDS)
    dropped |= set(BOUNDS_DIMS)

    def wanted(name: str) -> bool:
        if name in dropped:
            return False
        if name in dims:
            return True
        if include == "all":
            return name not in (omit or ())
        return name in include or name in LATLON_COORDS or name in OTHER_COORDS

    return df.select(*[c for c in df.columns if wanted(c)])


def hyperslab(df: DataFrame, slices: Mapping[str, tuple[int, int, int]], bounds: Mapping[str, tuple[int, int]]) -> DataFrame:
    """PRJ-2: half-open index slices clamped to the first and last index that exist.

    The stride counts from the clamped start; dimensions without a slice, or
    absent from the frame, stay whole.
    """
    tests: list[Column] = []
    for dim, (start, end, stride) in slices.items():
        if dim not in df.columns:
            continue
        low, high = bounds[dim]
        first, last = max(start, low), min(end - 1, high)
        tests.append(F.col(dim).between(first, last))
        if stride > 1:
            tests.append((F.col(dim) - first) % stride == 0)
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df


def interface_slice(k: tuple[int, int, int]) -> tuple[int, int, int]:
    """PRJ-2: layer interfaces have one index more than layers."""
    return k[0], k[1] + 1, k[2]


def between_days(df: DataFrame, start: str, end: str, time: str = "time") -> DataFrame:
    """PRJ-3: closed range at day precision, written as a range on the raw column so that it is pushed down."""
    lo = F.lit(start).cast("date").cast("timestamp")
    hi = F.date_add(F.lit(end).cast("date"), 1).cast("timestamp")
    return df.filter((F.col(time) >= lo) & (F.col(time) < hi))


def month_firsts(df: DataFrame, date: str) -> DataFrame:
    """PRJ-5."""
    return df.filter(F.dayofmonth(date) == 1)


def depth_range(df: DataFrame, top: float, bottom: float) -> DataFrame:
    """PRJ-7: layers that overlap (bottom, top)."""
    return df.filter((F.col("zu") < F.lit(float(top))) & (F.col("zl") > F.lit(float(bottom))))


def land_mask(field: DataFrame, grid: DataFrame, cell: Sequence[str] = ("tile", "j", "i")) -> DataFrame:
    """PRJ-10: keep values where the mask of their staggered location is true.

    A field without a level uses level 0.  An unknown location is an error.
    """
    known = reduce(lambda a, b: a | b, [F.col("loc") == loc for loc in LOCATION_MASK])
    mask = F.lit(None).cast("boolean")
    for loc, name in LOCATION_MASK.items():
        mask = F.when(F.col("loc") == loc, F.col(name)).otherwise(mask)
    levelled = field.withColumn("_level", F.coalesce(F.col("k"), F.lit(0)))
    masks = grid.select(F.col("k").alias("_level"), *cell, *LOCATION_MASK.values())
    joined = levelled.join(dimension(masks), ["_level", *cell], "left")
    masked = F.when(known, F.when(mask, F.col("value"))).otherwise(
        F.raise_error(F.lit("unknown field location")).cast("double")
    )
    return joined.withColumn("value", masked).select(*field.columns)


def wet_points(field: DataFrame, grid: DataFrame, keep_rows: bool = False) -> DataFrame:
    """PRJ-9: only cells with a wet fraction, or missing values elsewhere when rows must stay.

    A field without a level uses level 0.
    """
    cell = ["_level", "tile", "j", "i"]
    wet = dimension(grid.filter(F.col("hfac") > 0).select(F.col("k").alias("_level"), *cell[1:]))
    levelled = field.withColumn("_level", F.coalesce(F.col("k"), F.lit(0)))
    if not keep_rows:
        return levelled.join(wet, cell, "left_semi").select(field.columns)
    flagged = levelled.join(wet.withColumn("_wet", F.lit(True)), cell, "left")
    return flagged.withColumn("value", F.when(F.col("_wet"), F.col("value"))).select(field.columns)


def negative_to_missing(value: Column) -> Column:
    """PRJ-12."""
    return F.when(value >= 0, value)


def kelvin_to_celsius(name: Column, value: Column, field: str) -> Column:
    """PRJ-13 for one named field."""
    return F.when(name == field, value - 273.15).otherwise(value)


def percent_to_fraction(name: Column, value: Column, field: str) -> Column:
    """PRJ-14 for one named field."""
    return F.when(name == field, value / 100.0).otherwise(value)


def overlay(new: Column, old: Column) -> Column:
    """PRJ-20: the new value where there is one."""
    return F.coalesce(null_if_nan(new), old)


def track_before(ts: Column, limit: Column, value: Column) -> Column:
    """PRJ-22: positions are hidden from `limit` on."""
    return F.when(ts < limit, value)


def layer_swap(df: DataFrame, profile: Sequence[str]) -> DataFrame:
    """PRJ-19: swap upper and lower layer depths of profiles whose first upper depth is not yet negative.

    Adds `swapped`, so a dry run is a look at that column.
    """
    first = df.groupBy(*profile).agg(F.min_by("zu", "k").alias("_first"))
    done = F.col("_first") < 0
    return (
        df.join(summary_side(first, "first-layers"), list(profile))
        .withColumn("_zu", F.when(done, F.col("zu")).otherwise(F.col("zl")))
        .withColumn("_zl", F.when(done, F.col("zl")).otherwise(F.col("zu")))
        .withColumn("swapped", ~done)
        .drop("zu", "zl", "_first")
        .withColumnsRenamed({"_zu": "zu", "_zl": "zl"})
    )


def hide_leading(df: DataFrame, keys: Sequence[str], order: str, limit: Column) -> DataFrame:
    """PRJ-18: the first records of each series become missing.

    `limit` is the number to hide, a Column over `keys`.  Only the leading
    records are ranked (up to the largest limit), so a long series never meets
    in one task.
    """
    most = df.agg(F.max(limit)).first()[0] or 0
    first = Window.partitionBy(*keys).orderBy(order)
    leading = (
        df.select(*keys, order)
        .withColumn("_pos", F.row_number().over(first))
        .filter(F.col("_pos") <= most)
        .filter(F.col("_pos") <= limit)
        .drop("_pos")
        .withColumn("_hide", F.lit(True))
    )
    hidden = df.join(summary_side(leading, "leading-records"), [*keys, order], "left")
    return hidden.withColumn("value", F.when(F.col("_hide").isNull(), F.col("value"))).drop("_hide")


def apply_mask(product: DataFrame, mask: DataFrame, keys: Sequence[str], name: str = "mask") -> DataFrame:
    """JN-4: values stay where the target mask is true; cells without a mask are missing."""
    joined = product.join(dimension(mask.select(*keys, F.col(name).alias("_mask"))), list(keys), "left")
    return joined.withColumn("value", F.when(F.col("_mask"), F.col("value"))).drop("_mask")

"""Mapping between scattered or gridded points and the cells of a target grid.

The distance predicate is turned into an equi join on latitude-longitude bins.
Longitude bins widen towards the poles, so bins cover similar areas and the
polar caps have one bin.  A source point lies in exactly one bin; a target is
repeated over the bins its search cap touches, so no pair is produced twice.

Column contract: sources have (source_id, lon, lat), targets have
(target_id, lon, lat, radius).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import EARTH_RADIUS, great_circle, neighbour_cap
from ..functions.missing import mean_all_present, mean_present, null_if_nan
from ..session import stored
from .scale import exact_median, join_back, split_hot_keys

# Target rows (after repetition over bins) that may be broadcast: about 60 bytes each.
BROADCAST_TARGET_ROWS = 2_000_000
# No cap touches more bins than this: a bin is at least as wide as the largest reach, so a
# cap spans at most three latitude bins, and the bins that near a pole number at most nineteen.
MOST_BINS_PER_TARGET = 60
SMALLEST_BIN_DEGREES = 0.01
_SLACK = 1e-9


def _lon_bins(lat_bin: Column, width: float) -> Column:
    """How many longitude bins a latitude bin has, from its most poleward edge."""
    low = lat_bin * F.lit(width) - 90.0
    poleward = F.least(F.greatest(F.abs(low), F.abs(low + F.lit(width))), F.lit(90.0))
    return F.greatest(F.floor(F.lit(360.0) * F.cos(F.radians(poleward)) / F.lit(width)), F.lit(1))


def _lat_bin(lat: Column, width: float) -> Column:
    return F.floor((lat + 90.0) / F.lit(width))


def _lon_bin(lon: Column, bins: Column) -> Column:
    return F.pmod(F.floor((lon + 180.0) * bins / 360.0), bins)


def binned_sources(source: DataFrame, width: float) -> DataFrame:
    row = _lat_bin(F.col("lat"), width)
    return source.withColumn("_row", row).withColumn("_col", _lon_bin(F.col("lon"), _lon_bins(F.col("_row"), width)))


def binned_targets(target: DataFrame, width: float) -> DataFrame:
    """Targets repeated over every bin that their cap of `_reach` metres can touch."""
    reach = F.col("_reach") / F.lit(EARTH_RADIUS)
    spread = F.degrees(reach) + _SLACK
    touches_pole = F.abs(F.col("lat")) + spread >= 90.0
    half_width = F.when(touches_pole, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(F.lit(1.0), F.sin(reach) / F.cos(F.radians(F.col("lat")))))) + _SLACK
    )
    top = math.ceil(180.0 / width)
    rows = F.sequence(
        F.greatest(_lat_bin(F.col("lat") - spread, width), F.lit(0)),
        F.least(_lat_bin(F.col("lat") + spread, width), F.lit(top)),
    )
    spread_rows = target.withColumn("_half", half_width).withColumn("_row", F.explode(rows))
    bins = _lon_bins(F.col("_row"), width)
    first = F.floor((F.col("lon") + 180.0 - F.col("_half")) * bins / 360.0)
    last = F.floor((F.col("lon") + 180.0 + F.col("_half")) * bins / 360.0)
    cols = F.when(last - first + 1 >= bins, F.sequence(F.lit(0).cast("long"), bins - 1)).otherwise(
        F.transform(F.sequence(first, last), lambda c: F.pmod(c, bins))
    )
    return spread_rows.withColumn("_col", F.explode(cols)).drop("_half")


@dataclass(frozen=True)
class GridSize:
    """What one aggregate tells about a target grid before the plan is chosen."""

    cells: int
    widest: float

    @staticmethod
    def of(target: DataFrame) -> GridSize:
        row = target.agg(F.count(F.lit(1)), F.max(null_if_nan(F.col("radius")))).first()
        return GridSize(int(row[0]), float(row[1] or 0.0))


def pairs_within(
    source: DataFrame,
    target: DataFrame,
    reach: Column,
    widest: float,
    size: GridSize,
    carry: Sequence[str] = (),
    broadcast_rows: int = BROADCAST_TARGET_ROWS,
    rows_per_split: int = 2_000_000,
) -> DataFrame:
    """All (target, source) pairs whose great-circle distance is at most the target's `reach` metres.

    `widest` bounds `reach` and sets the bin width.  The repeated target grid is
    bounded from its cell count, or counted when the bound is too wide: up to
    `broadcast_rows` it is broadcast and the sources never shuffle; beyond that
    both sides shuffle on the bin, with hot bins split.
    """
    width = max(math.degrees(widest / EARTH_RADIUS), SMALLEST_BIN_DEGREES)
    points = binned_sources(source.select("source_id", "lon", "lat", *carry), width)
    cells = binned_targets(
        target.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull())
        .select("target_id", F.col("lon").alias("lon"), F.col("lat").alias("lat"), "radius")
        .withColumn("_reach", reach)
        .filter("_reach >= 0"),
        width,
    ).withColumnsRenamed({"lon": "_tlon", "lat": "_tlat"})
    keys = ["_row", "_col"]
    if size.cells * MOST_BINS_PER_TARGET <= broadcast_rows or cells.count() <= broadcast_rows:
        joined = points.join(F.broadcast(cells), keys)
    else:
        points, cells, keys = split_hot_keys(points, cells, keys, F.col("source_id"), rows_per_split)
        joined = points.join(cells, keys)
    return (
        joined.withColumn("dist", great_circle(F.col("lon"), F.col("lat"), F.col("_tlon"), F.col("_tlat")))
        .filter(F.col("dist") <= F.col("_reach"))
        .select("target_id", "source_id", "dist", "radius", *carry)
    )


def in_reach(widest: float) -> Column:
    """The search radius is whole metres of the largest radius, and never beyond the cell's own.

    A cell without a radius (NULL or NaN) reaches nothing, so it can only have a fallback.
    """
    own = null_if_nan(F.col("radius"))
    return F.when(own.isNotNull(), F.least(own, F.lit(float(math.floor(widest))))).otherwise(F.lit(-1.0))


def radius_pairs(
    source: DataFrame,
    target: DataFrame,
    neighbours: int | None = None,
    carry: Sequence[str] = (),
    group: Sequence[str] = (),
    size: GridSize | None = None,
    **options,
) -> DataFrame:
    """JN-1 / WN-2: sources within each target's radius, nearest first, with their rank.

    `neighbours` is the user's limit on sources per target (the nearest are
    kept); None, the default, keeps them all and adds no rank and no window.  The
    rank filter is applied per map task before the shuffle.
    """
    size = size or GridSize.of(target)
    widest = size.widest
    pairs = pairs_within(source, target, in_reach(widest), widest, size, [*carry, *group], **options).drop("radius")
    if neighbours is None:
        return pairs
    nearest_first = Window.partitionBy("target_id", *group).orderBy("dist", "source_id")
    return pairs.withColumn("rank", F.row_number().over(nearest_first)).filter(F.col("rank") <= neighbours)


def nearest_pairs(
    source: DataFrame,
    target: DataFrame,
    longest: float,
    carry: Sequence[str] = (),
    group: Sequence[str] = (),
    size: GridSize | None = None,
    **options,
) -> DataFrame:
    """JN-2: the one nearest source within whole metres of `longest`, per target and group."""
    limit = float(math.floor(longest))
    size = size or GridSize.of(target)
    pairs = pairs_within(source, target, F.lit(limit), limit, size, [*carry, *group], **options)
    best = F.struct("dist", "source_id", *carry)
    return pairs.groupBy("target_id", *group).agg(F.min(best).alias("_best")).select("target_id", *group, "_best.*")


def mapping_edges(
    source: DataFrame,
    target: DataFrame,
    longest: float,
    neighbours: int | None = None,
    group: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Mapping factors as rows (target_id, …group, source_id, dist, is_fallback).

    A fallback edge exists only for a target with no source in its radius.
    `group` holds columns such as the level, whose sources differ.  Nearest
    first, a target's first source is inside the radius if any source is.  The
    pairs of one radius join are written, and read once for the edges inside and
    once for the nearest sources of the targets that have none.
    """
    keys = ["target_id", *group]
    size = GridSize.of(target)
    inner = in_reach(size.widest)
    limit = float(math.floor(longest))
    reach = F.greatest(inner, F.lit(limit))
    pairs = pairs_within(source, target, reach, max(size.widest, limit), size, group, **options).withColumn(
        "is_fallback", F.col("dist") > inner
    )
    out = [*keys, "source_id", "dist", "is_fallback"]
    if neighbours is not None:
        nearest_first = Window.partitionBy(*keys).orderBy("dist", "source_id")
        ranked = pairs.withColumn("rank", F.row_number().over(nearest_first)).filter(F.col("rank") <= neighbours)
        return ranked.filter(~F.col("is_fallback") | (F.col("rank") == 1)).select(*out)
    pairs = stored(pairs.select(*out), "radius-pairs")
    best = pairs.groupBy(*keys).agg(F.min(F.struct("dist", "source_id", "is_fallback")).alias("_best"))
    fallback = best.select(*keys, "_best.*").filter("is_fallback")
    return pairs.filter(~F.col("is_fallback")).unionByName(fallback.select(*out))


def reduction(operation: str, value: Column, order: Column) -> Column:
    """AG-1..AG-5 as one aggregate Column; `order` ranks the sources (distance, id)."""
    if operation == "mean":
        return mean_all_present(value)
    if operation == "nanmean":
        return mean_present(value)
    if operation == "median":
        return F.when(F.count(value) == F.count(F.lit(1)), F.median(value))
    if operation == "nanmedian":
        return F.median(value)
    if operation == "nearest":
        return F.min_by(value, order)
    raise ValueError(f"unknown operation {operation!r}")


def apply_mapping(
    edges: DataFrame,
    field: DataFrame,
    operation: str = "mean",
    group: Sequence[str] = ("time", "var"),
    edge_keys: Sequence[str] = ("source_id",),
    allow_nearest: bool = True,
    neighbours: int | None = None,
) -> DataFrame:
    """JN-3: gather field values along the edges and reduce per target and group.

    Time and variable are ordinary grouping columns, so one plan maps a whole
    archive.  A source misses from `field` only when it holds no row at all.
    `neighbours` is the limit the edges were made with; without one, medians go
    through the bracketed exact median.
    """
    used = edges if allow_nearest else edges.filter(~F.col("is_fallback"))
    keys = [*[c for c in edge_keys if c != "source_id"], "target_id", *group]
    joined = used.join(field, list(edge_keys))
    wide_median = operation in ("median", "nanmedian") and neighbours is None
    core = F.lit(None).cast("double") if wide_median else reduction(operation, F.col("value"), F.struct("dist", "source_id"))
    out = joined.groupBy(*keys).agg(
        core.alias("value"),
        F.count(F.lit(1)).alias("n_source"),
        F.count("value").alias("_present"),
        F.bool_or("is_fallback").alias("is_fallback"),
    )
    if wide_median:
        keep = F.lit(True) if operation == "nanmedian" else F.col("_present") == F.col("n_source")
        out = join_back(out, exact_median(joined, keys, "value", "_middle"), keys, "left")
        out = out.withColumn("value", F.when(keep, F.col("_middle"))).drop("_middle")
    return out.drop("_present")


def regrid_points(
    source: DataFrame,
    target: DataFrame,
    operation: str = "mean",
    longest: float | None = None,
    group: Sequence[str] = (),
    **options,
) -> DataFrame:
    """Scattered observations to a grid in one pass: one bin join, one aggregate.

    Every source inside the radius counts.  The nearest source within `longest`
    is used only where the radius holds none; None switches the fallback off.
    Medians of whole neighbourhoods go through a bracketed exact median.
    """
    size = GridSize.of(target)
    widest = size.widest
    inner = in_reach(widest)
    limit = 0.0 if longest is None else float(math.floor(longest))
    reach = F.greatest(inner, F.lit(limit)) if longest is not None else inner
    pairs = pairs_within(source, target, reach, max(widest, limit), size, ["value", *group], **options)
    keys = ["target_id", *group]
    order = F.struct("dist", "source_id")
    inside = F.col("dist") <= inner
    near = F.col("dist") <= limit
    n_in = F.count_if(inside)
    if operation in ("mean", "nanmean"):
        total = F.avg(F.when(inside, F.col("value")))
        core = total if operation == "nanmean" else F.when(F.count_if(inside & F.col("value").isNotNull()) == n_in, total)
    elif operation == "nearest":
        core = F.min_by("value", order)
    elif operation in ("median", "nanmedian"):
        core = F.lit(None).cast("double")
    else:
        raise ValueError(f"unknown operation {operation!r}")
    # min_by skips rows whose order is missing, so sources out of reach cannot win.
    fallback = F.min_by("value", F.when(near, order))
    out = pairs.groupBy(*keys).agg(
        n_in.alias("n_source"),
        F.count_if(inside & F.col("value").isNotNull()).alias("n_present"),
        core.alias("_core"),
        fallback.alias("_fallback"),
        F.count_if(near).alias("_near"),
    )
    if operation in ("median", "nanmedian"):
        middle = exact_median(pairs.filter(inside), keys, "value", "_middle")
        out = join_back(out, middle, keys, "left")
        keep = F.lit(True) if operation == "nanmedian" else F.col("n_present") == F.col("n_source")
        out = out.withColumn("_core", F.when(keep, F.col("_middle"))).drop("_middle")
    return out.filter((F.col("n_source") > 0) | (F.col("_near") > 0)).select(
        *keys,
        F.when(F.col("n_source") > 0, F.col("_core")).otherwise(F.col("_fallback")).alias("value"),
        F.col("n_source").cast("long").alias("n_source"),
        (F.col("n_source") == 0).alias("is_fallback"),
    )


def source_counts(source: DataFrame, target: DataFrame, **options) -> DataFrame:
    """AG-6: number of sources within each target's radius, zeros kept."""
    size = GridSize.of(target)
    counted = pairs_within(source, target, in_reach(size.widest), size.widest, size, **options).groupBy("target_id").agg(
        F.count(F.lit(1)).alias("n_source")
    )
    return target.select("target_id").join(counted, "target_id", "left").select(
        "target_id", F.coalesce("n_source", F.lit(0)).cast("long").alias("n_source")
    )


def neighbour_limit(target: DataFrame, shortest: float, neighbours: int = 100) -> DataFrame:
    """SF-37 over a whole target grid."""
    return target.agg(F.max("radius").alias("r_max")).select(
        "r_max", neighbour_cap(F.col("r_max"), F.lit(float(shortest)), neighbours).alias("cap")
    )

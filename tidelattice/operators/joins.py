"""Calendar, lookup, nearest and reconciliation joins.

Only grid dimensions whose rows were counted are hinted; other sides are
broadcast by Catalyst or AQE when their measured size allows, and sort-merge
with skew splitting applies beyond.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import KM_PER_DEGREE, planar_km
from ..functions.strings import basename
from ..session import stored
from .scale import dimension, join_back, sorted_ranges, summary_side

# Period words that separate the stem of a granule name from its date.
PERIOD_WORDS = ("snap", "day_mean", "mon_mean")


def calendar(df: DataFrame, start: Column, end: Column, out: str = "date") -> DataFrame:
    """One row per day of a closed range for every row of `df`."""
    return df.withColumn(out, F.explode(F.sequence(start, end, F.expr("INTERVAL '1' DAY"))))


def densify(records: DataFrame, grid: DataFrame, start: str, end: str, keys: Sequence[str], date: str = "date") -> DataFrame:
    """JN-5: every grid row for every day; days or cells without a record are missing.

    The calendar is exploded onto the grid rows, which is the size of the result.
    """
    days = calendar(grid, F.lit(start).cast("date"), F.lit(end).cast("date"), date)
    return days.join(records, [date, *keys], "left")


def match_calendar(dates: DataFrame, files: DataFrame) -> DataFrame:
    """JN-5 / SRC-11: expected dates with the last matching path of each (empty when none)."""
    last = files.groupBy("date").agg(F.max("path").alias("path"))
    return dates.join(last, "date", "left").select(*dates.columns, F.coalesce("path", F.lit("")).alias("path"))


def merge_variables(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """JN-6: one column per variable over the union of their coordinates."""
    return df.groupBy(*keys).pivot("var", list(names)).agg(F.max("value"))


def difference(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JN-7: aligned difference on shared coordinates; a missing level is a coordinate like any other."""
    right = b.select(*keys, F.col("value").alias("_other"))
    return join_back(a.select(*keys, "value"), right, keys).select(*keys, (F.col("value") - F.col("_other")).alias("value"))


def stem_and_tail(name: Column) -> Column:
    """JN-8: struct(head incl. period word, tail after the model token); an error without a period word."""
    head = F.regexp_extract(name, rf"^(.*?_(?:{'|'.join(PERIOD_WORDS)}))_", 1)
    checked = F.coalesce(F.nullif(head, F.lit("")), F.raise_error(F.lit("file name has no period word")).cast("string"))
    return F.struct(checked.alias("head"), F.regexp_extract(name, r"_MODEL_V1_(.*)$", 1).alias("tail"))


def lookup_by_name(granules: DataFrame, catalogue: DataFrame, name: str, pattern: str, first: str) -> DataFrame:
    """JN-8: catalogue row whose file-name pattern starts and ends like the granule's name.

    The head and tail of both names are cut out once, which makes it an equi
    join; of several catalogue rows the first by `first` counts.
    """
    parts = stem_and_tail(F.col(pattern))
    table = (
        catalogue.select(parts.alias("_p"), F.struct(first, *[c for c in catalogue.columns if c != first]).alias("_row"))
        .groupBy(F.col("_p.head").alias("_head"), F.col("_p.tail").alias("_tail"))
        .agg(F.min("_row").alias("_row"))
    )
    own = stem_and_tail(F.col(name))
    keyed = granules.withColumn("_own", own).withColumn("_head", F.col("_own.head")).withColumn("_tail", F.col("_own.tail"))
    return keyed.join(table, ["_head", "_tail"], "left").select(*granules.columns, "_row.*")


def not_present(granules: DataFrame, present: DataFrame, force: bool = False) -> DataFrame:
    """JN-10: granules whose file name is not there yet; `force` keeps them all."""
    if force:
        return granules
    named = granules.withColumn("_base", basename(F.col("url")))
    return named.join(present.select(F.col("basename").alias("_base")), "_base", "left_anti").drop("_base")


def on_dates(granules: DataFrame, dates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JN-11 / PRJ-4: granules on one of the requested dates."""
    return granules.join(dates.select(*keys), list(keys), "left_semi")


def unmatched_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """JN-12 / SO-5: keys of only one side, with the side they came from."""
    left = a.select(key).distinct().withColumn("_a", F.lit(True))
    right = b.select(key).distinct().withColumn("_b", F.lit(True))
    return (
        left.join(right, key, "full")
        .filter(F.col("_a").isNull() | F.col("_b").isNull())
        .select(key, F.when(F.col("_a"), "left").otherwise("right").alias("side"))
    )


def nearest_time(series: DataFrame, times: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """JN-13: for a short list of instants, the record nearest to each (the earlier one on a tie).

    The instants ride along as a literal array, so records meet only in a
    map-side combined minimum.
    """
    probes = F.array(*[F.lit(t).cast("timestamp") for t in times])
    exploded = series.withColumn("probe", F.explode(probes))
    gap = F.abs(F.unix_micros("time") - F.unix_micros("probe"))
    best = F.min(F.struct(gap.alias("gap"), F.col("time"), F.col("value"))).alias("_best")
    return exploded.groupBy(*keys, "probe").agg(best).select(
        *keys, "probe", F.col("_best.time").alias("time"), F.col("_best.value").alias("value")
    )


def nearest_time_join(probes: DataFrame, series: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """JN-13 for a table of probes (…keys, probe): nearest record of the same keys, the earlier one on a tie.

    Probes and records are sorted together into ranges of (keys, time).  Inside
    a range each probe sees the last record before it and the first one after;
    of a range only its first and last record per key are carried to the others,
    so no window holds a whole variable, and gaps of any length stay exact.
    A probe of a key without records finds nothing: its time and value are missing.
    """
    records = series.groupBy(*keys, "time").agg(F.min("value").alias("value")).filter(F.col("time").isNotNull())
    rec = F.struct(F.col("time"), F.col("value"))
    kind = records.select(rec.alias("r")).schema["r"].dataType
    held = records.select(*keys, F.col("time").alias("_at"), rec.alias("_rec"), F.lit(0).alias("_probe"))
    asked = probes.select(*keys, "probe").distinct().filter(F.col("probe").isNotNull())
    asked = asked.select(*keys, F.col("probe").alias("_at"), F.lit(None).cast(kind).alias("_rec"), F.lit(1).alias("_probe"))
    mixed = sorted_ranges(held.unionByName(asked), [*keys, "_at", "_probe"], parts)

    # At most one row a range and key more than there are keys.
    edges = mixed.groupBy(*keys, "_part").agg(F.min("_rec").alias("_first"), F.max("_rec").alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    outer = edges.select(
        *keys,
        "_part",
        F.last("_last", ignorenulls=True).over(earlier).alias("_prev"),
        F.last("_first", ignorenulls=True).over(later).alias("_next"),
    )
    # Both directions use growing frames; a frame that reaches forward would be quadratic.
    inside = Window.partitionBy("_part", *keys).orderBy("_place")
    after = Window.partitionBy("_part", *keys).orderBy(F.desc("_place"))
    reach = (Window.unboundedPreceding, 0)
    # A record at a probe's own instant stands before it, so it is found looking back.
    near = (
        mixed.withColumn("_before", F.last("_rec", ignorenulls=True).over(inside.rowsBetween(*reach)))
        .withColumn("_after", F.last("_rec", ignorenulls=True).over(after.rowsBetween(*reach)))
        .filter(F.col("_probe") == 1)
    )
    near = join_back(near, summary_side(outer, "range-edges"), [*keys, "_part"])
    back, ahead = F.coalesce("_before", "_prev"), F.coalesce("_after", "_next")
    gap = lambda r: F.abs(F.unix_micros(r["time"]) - F.unix_micros("_at"))
    pick = (
        F.when(ahead.isNull(), back)
        .when(back.isNull(), ahead)
        .when(gap(ahead) < gap(back), ahead)
        .otherwise(back)
    )
    best = near.select(*keys, F.col("_at").alias("probe"), pick.alias("_r"))
    return best.select(*keys, "probe", F.col("_r.time").alias("time"), F.col("_r.value").alias("value"))


def nearest_cell(cells: DataFrame, points: Sequence[tuple[str, float, float]], cell: Sequence[str] = ("tile", "j", "i")) -> DataFrame:
    """JN-14: for a short list of (name, lon, lat) points, the nearest cell on the scaled plane.

    One pass over the cells with a map-side combined minimum; ties by cell index.
    """
    probes = F.array(
        *[
            F.struct(F.lit(n).alias("point"), F.lit(float(lon)).alias("plon"), F.lit(float(lat)).alias("plat"))
            for n, lon, lat in points
        ]
    )
    far = cells.withColumn("_p", F.explode(probes)).withColumn(
        "dist", planar_km(F.col("xc"), F.col("yc"), F.col("_p.plon"), F.col("_p.plat"))
    )
    best = F.min(F.struct("dist", *cell)).alias("_best")
    return far.groupBy(F.col("_p.point").alias("point")).agg(best).select(
        "point", *[F.col(f"_best.{c}").alias(c) for c in cell], F.col("_best.dist").alias("dist")
    )


def nearest_cells(
    cells: DataFrame, points: DataFrame, cell: Sequence[str] = ("tile", "j", "i"), start: float | None = None
) -> DataFrame:
    """JN-14 for a table of points (point, lon, lat): the nearest cell on the scaled plane, exactly.

    Cells lie in bins of latitude bands, which hold fewer bins towards the poles.  A round looks at the
    bins within `start` degrees of each point, scaled as the distance is; a point whose best cell is nearer
    than that is done, the others go on with twice the width and bins twice as wide, so that every round
    meets a few bins a point.  The default width follows from the number of cells.  Ties go to the least
    cell index; rows that repeat a point are one point.  A point without a position, or where there are no
    cells, has no cell.
    """
    placed = stored(cells.select(*cell, "xc", "yc").filter(F.col("xc").isNotNull() & F.col("yc").isNotNull()), "placed-cells")
    width = start or min(360.0, (64800.0 / max(placed.count(), 1)) ** 0.5)
    keys = ["point", "lon", "lat"]
    left = points.select(*keys).distinct()
    done: list[DataFrame] = []
    while True:
        found = _nearest_within(placed, left, width, cell)
        round_ = stored(join_back(left, found, keys, "left"), "nearest-round")
        whole = F.lit(width >= 360.0) | F.col("lon").isNull() | F.col("lat").isNull()
        near = F.coalesce(F.col("_best.dist") < F.lit(KM_PER_DEGREE * width * (1 - 1e-9)), F.lit(False))
        done.append(round_.filter(whole | near))
        if width >= 360.0 or (left := round_.filter(~(whole | near)).select(*keys)).isEmpty():
            break
        width = min(360.0, width * 2)
    out = reduce(DataFrame.unionByName, done)
    return out.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in cell], F.col("_best.dist").alias("dist"))


def _nearest_within(placed: DataFrame, points: DataFrame, width: float, cell: Sequence[str]) -> DataFrame:
    """The best cell of each point (point, lon, lat, _best) among the bins within `width` degrees."""
    size = F.lit(width)
    turn = lambda lon: F.pmod(lon + 180.0, F.lit(360.0))
    band = lambda lat: F.floor((lat + 90.0) / size)

    def bins_in(at: Column) -> Column:
        low, high = at * size - 90.0, (at + 1) * size - 90.0
        inner = F.when((low < 0) & (high > 0), 0.0).otherwise(F.least(F.abs(low), F.abs(high), F.lit(90.0)))
        return F.greatest(F.floor(F.cos(F.radians(inner)) * 360.0 / size), F.lit(1))

    slot = lambda turned, count: F.floor(turned * count / 360.0)
    binned = placed.withColumn("_band", band(F.col("yc"))).withColumn(
        "_bin", F.least(slot(turn(F.col("xc")), bins_in(F.col("_band"))), bins_in(F.col("_band")) - 1)
    )
    # The window in longitude grows with the scale of the plane at the point; a hair covers rounding.
    reach = F.least(F.lit(180.0), size / F.greatest(F.cos(F.radians("lat")), F.lit(1e-9)) + 1e-9)
    spread = points.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull()).withColumn(
        "_band", F.explode(F.sequence(band(F.col("lat") - size - 1e-9), band(F.col("lat") + size + 1e-9)))
    )
    count = bins_in(F.col("_band"))
    first, last = slot(turn(F.col("lon")) - reach, count), slot(turn(F.col("lon")) + reach, count)
    spread = spread.withColumn("_at", F.explode(F.sequence(first, F.least(last, first + count - 1)))).withColumn(
        "_bin", F.pmod("_at", count)
    )
    met = spread.drop("_at").join(binned, ["_band", "_bin"])
    far = planar_km(F.col("xc"), F.col("yc"), F.col("lon"), F.col("lat"))
    return met.groupBy("point", "lon", "lat").agg(F.min(F.struct(far.alias("dist"), *cell)).alias("_best"))


def first_size(urls: DataFrame, listing: DataFrame, order: str) -> DataFrame:
    """JN-18: the size of each URL's first entry in a listing, missing where it has none."""
    sizes = listing.groupBy("url").agg(F.min_by("size_mb", order).alias("size_mb"))
    return urls.join(sizes, "url", "left")


def cell_corners(corners: DataFrame, n: int) -> DataFrame:
    """JN-16: four corners per cell from corner points, ordered (j,i), (j,i+1), (j+1,i+1), (j+1,i).

    Each corner point is offered to the cells around it, so one grouped pass
    replaces a four-way self join.  Cells without all four corners have missing
    entries in their arrays.
    """
    offers = F.array(
        *[
            F.struct(F.lit(slot).alias("slot"), F.lit(dj).alias("dj"), F.lit(di).alias("di"))
            for slot, (dj, di) in enumerate([(0, 0), (0, 1), (1, 1), (1, 0)])
        ]
    )
    spread = corners.withColumn("_o", F.explode(offers)).select(
        "tile",
        (F.col("j") - F.col("_o.dj")).alias("j"),
        (F.col("i") - F.col("_o.di")).alias("i"),
        F.col("_o.slot").alias("slot"),
        "xg",
        "yg",
    )
    inside = spread.filter(F.col("j").between(0, n - 1) & F.col("i").between(0, n - 1))

    def slots(name: str) -> Column:
        return F.array(*[F.max(F.when(F.col("slot") == s, F.col(name))) for s in range(4)])

    return inside.groupBy("tile", "j", "i").agg(slots("xg").alias("x_bounds"), slots("yg").alias("y_bounds"))


def with_bounds(product: DataFrame, grid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JN-17: coordinate bounds from the grid dimension."""
    return product.join(dimension(grid), list(keys), "left")


def memberships(names: DataFrame, groupings: DataFrame) -> DataFrame:
    """JN-19: variables of each grouping's comma list with the number of directories that carry them."""
    wanted = groupings.select(
        "grouping", F.explode(F.split(F.trim("fields"), r"\s*,\s*")).alias("var")
    )
    found = names.groupBy("var").agg(F.countDistinct("directory").alias("matches"))
    return wanted.join(found, "var", "left").select(
        "grouping",
        "var",
        F.coalesce("matches", F.lit(0)).cast("long").alias("matches"),
        F.when(F.coalesce("matches", F.lit(0)) == 1, "ok").when(F.col("matches") > 1, "ambiguous").otherwise("missing").alias("status"),
    )

"""P-5 to P-12: observation, monthly, lat-lon, native, 1-D and geometry products."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.attrs import rename_by_list
from ..functions.missing import fill_missing
from ..operators import aggregate as A
from ..operators import joins as J
from ..operators import regrid as R
from ..operators import select as S
from ..operators.scale import dimension
from ..session import stored
from ..sources import granules as G

# UD-1: named transforms applied before mapping; each is DataFrame -> DataFrame.
TRANSFORMS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "remove_negative": lambda df: df.withColumn("value", S.negative_to_missing(F.col("value"))),
    "kelvin_to_celsius": lambda df: df.withColumn("value", S.kelvin_to_celsius(F.col("var"), F.col("value"), "analysed_sst")),
    "percent_to_fraction": lambda df: df.withColumn("value", S.percent_to_fraction(F.col("var"), F.col("value"), "ice_conc")),
}


def register_transform(name: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    """UD-1."""
    TRANSFORMS[name] = fn


def apply_transforms(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """UD-1: transforms in order; an unknown name is an error."""
    for name in names:
        df = df.transform(TRANSFORMS[name])
    return df


def with_bounds(df: DataFrame, end: Column, code: str) -> DataFrame:
    bounds = D.time_bounds(end, F.lit(code))
    return df.withColumn("_b", bounds).withColumns(
        {"time_start": F.col("_b.start"), "time": F.col("_b.centre"), "time_end": F.col("_b.end")}
    ).drop("_b")


def with_record_bounds(df: DataFrame, code: Column, model_start: str, model_end: str) -> DataFrame:
    """SF-5/6: bounds and centre of records that end at `time_end`."""
    limits = [F.lit(x).cast("timestamp") for x in (model_start, model_end)]
    bounds = D.record_bounds(F.col("time_end"), code, *limits)
    return df.withColumn("_b", bounds).withColumns({"time_start": F.col("_b.start"), "time": F.col("_b.centre")}).drop("_b")


def written_product(
    values: DataFrame, keys: Sequence[str], names: Sequence[str], record: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """JN-6 and SF-50: one row per coordinate with a column per variable, and each variable's range per record.

    The product is written before its ranges are read off it, so nothing is mapped twice.  The range of a
    variable without any value in a record is missing.
    """
    product = stored(J.merge_variables(values, keys, names), "product")
    ranges = [F.struct(F.lit(n).alias("var"), F.min(n).alias("valid_min"), F.max(n).alias("valid_max")) for n in names]
    return product, product.groupBy(*record).agg(F.array(*ranges).alias("_r")).select(*record, F.inline("_r"))


def observation_records(
    obs: DataFrame,
    target: DataFrame,
    start: str,
    end: str,
    longest: float,
    transforms: Sequence[str] = (),
    default: float | None = None,
) -> DataFrame:
    """P-5: daily observations on a model grid, one record per calendar day.

    Days without observations, and cells without a source in reach, are missing
    records; mapped values are laid over `default`.
    """
    ready = apply_transforms(obs, transforms).withColumn("date", F.to_date("ts"))
    mapped = R.regrid_points(ready, target, "mean", longest=longest, group=("date",))
    dense = J.densify(mapped.select("date", "target_id", "value"), target.select("target_id"), start, end, ["target_id"])
    laid = dense.withColumn("value", S.overlay(F.col("value"), F.lit(default).cast("double")))
    return laid.withColumn("time_start", F.col("date").cast("timestamp")).withColumn(
        "time_end", D.record_end(F.col("date"), F.lit("DAILY")).cast("timestamp")
    )


def observation_year(
    obs: DataFrame,
    files: DataFrame,
    target: DataFrame,
    year: int,
    longest: float,
    rule: str,
    transforms: Sequence[str] = (),
    default: float | None = None,
    time_scale: str = "DAILY",
    pattern: str = "yyyyMMdd",
    hemisphere: str = "",
) -> tuple[DataFrame, DataFrame]:
    """P-5 from files: the mapped values (date, target_id, value) of a year and its records.

    Every expected date takes the last file that carries it (SRC-11); `obs` rows name the file they are
    from, so other files' rows fall out in a join with at most one row per date.  Records have the chosen
    path, time bounds by the file's `rule` and notes on missing files and on files without a valid value;
    a date without a file covers its own period (SF-10).
    """
    chosen = stored(G.harvest_year(obs.sparkSession, files, year, time_scale, pattern, hemisphere), "chosen-files")
    rows = apply_transforms(obs.join(dimension(chosen.filter("path <> ''")), "path"), transforms)
    mapped = R.regrid_points(rows, target, "mean", longest=longest, group=("date",)).select("date", "target_id", "value")
    cells = target.select("target_id", F.explode(G.year_dates(year, time_scale)).alias("date"))
    laid = cells.join(mapped, ["date", "target_id"], "left").withColumn(
        "value", S.overlay(F.col("value"), F.lit(default).cast("double"))
    )
    valid = rows.groupBy("path").agg(F.count("value").alias("_valid"))
    found = chosen.join(files, "path", "left").join(valid, "path", "left")
    missing = F.col("path") == ""
    own = F.struct(F.col("date").cast("timestamp").alias("start"), D.record_end(F.col("date"), F.lit(time_scale)).cast("timestamp").alias("end"))
    bounds = F.when(missing, own).otherwise(D.file_bounds(rule, F.col("date"), files.columns))
    notes = F.when(missing, "file not found").when(F.coalesce("_valid", F.lit(0)) == 0, "empty record").otherwise("")
    records = found.withColumn("_b", bounds).select(
        "date", "path", F.col("_b.start").alias("time_start"), F.col("_b.end").alias("time_end"), notes.alias("notes")
    )
    return laid, records


def monthly_product(
    daily: DataFrame, keys: Sequence[str], skip_missing: bool, drop_empty_days: bool, record: Sequence[str], fill: float
) -> DataFrame:
    """P-6: calendar-month means with exact bounds, filled.

    A month without any value is not written.  Leaving out empty records leaves
    out such months too.
    """
    dated = daily.withColumn("_month", F.date_trunc("month", "time"))
    kept = A.without_empty_days(dated, record if drop_empty_days else ["_month"])
    written = A.monthly_mean(kept, keys, skip_missing)
    month_end = F.add_months(F.col("month").cast("date"), 1).cast("timestamp")
    bounded = with_bounds(written, month_end, "AVG_MON")
    return bounded.withColumn("duration", F.lit(A.DURATION["monthly"])).withColumn("value", fill_missing(F.col("value"), fill))


def merged_records(records: DataFrame, grid: DataFrame, cell: Sequence[str], start: str, end: str, drop_empty_days: bool) -> DataFrame:
    """P-7: one record per day, missing where no file exists; optionally without empty days."""
    dense = J.densify(records, grid.select(*cell), start, end, cell)
    return A.without_empty_days(dense, ["date"]) if drop_empty_days else dense


def level_edges(native: DataFrame, target: DataFrame, longest: float, neighbours: int | None = None) -> DataFrame:
    """Mapping factors per level from wet cells only."""
    wet = native.filter(F.col("hfac") > 0)
    return R.mapping_edges(wet, target, longest, neighbours, group=("k",))


def nearest_mask(native: DataFrame, target: DataFrame, longest: float) -> DataFrame:
    """Land mask of the target per level: is the nearest native cell wet?"""
    return R.nearest_pairs(native, target, longest, carry=["hfac"], group=["k"]).select(
        "target_id", "k", (F.col("hfac") > 0).alias("mask")
    )


def latlon_values(
    field: DataFrame, native: DataFrame, target: DataFrame, longest: float, group: Sequence[str], edges: DataFrame | None = None
) -> DataFrame:
    """Wet native cells -> lat-lon cells, masked, in stored precision."""
    factors = level_edges(native, target, longest) if edges is None else edges
    cell = ["k", "tile", "j", "i"]
    placed = field.join(dimension(native.select(*cell, "source_id")), cell)
    mapped = R.apply_mapping(factors, placed.select("k", "source_id", "value", *group), "mean", group, ("k", "source_id"))
    mask = stored(nearest_mask(native, target, longest), "nearest-mask")
    masked = S.apply_mask(mapped, mask, ["target_id", "k"])
    return masked.withColumn("value", F.col("value").cast("float"))


def with_cell_bounds(product: DataFrame, target: DataFrame) -> DataFrame:
    """JN-17."""
    return J.with_bounds(product, target.select("target_id", "lon0", "lon1", "lat0", "lat1"), ["target_id"])


def latlon_product(
    field: DataFrame,
    native: DataFrame,
    target: DataFrame,
    longest: float,
    names: Sequence[str],
    code: Column,
    model_start: str,
    model_end: str,
    edges: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """P-8: one row per lat-lon cell, level and record with a column per variable, and the ranges of each record.

    `field` has records that end at `time_end`.  Wet native cells are mapped, masked and cast, merged on
    their coordinates, and given time bounds by averaging code and cell bounds.
    """
    values = latlon_values(field, native, target, longest, ["time_end", "var"], edges)
    product, ranges = written_product(values, ["target_id", "k", "time_end"], names, ["time_end"])
    return with_cell_bounds(with_record_bounds(product, code, model_start, model_end), target), ranges


def native_product(
    field: DataFrame, grid: DataFrame, rename: str, names: Sequence[str], code: Column, model_start: str, model_end: str
) -> tuple[DataFrame, DataFrame]:
    """P-9: one row per native cell and record with a column per variable, and the ranges of each record.

    Values are masked by staggering, renamed, in stored precision; `code` is the averaging code, a Column
    over the dataset.  Records end at the field's `time`.
    """
    ended = field.withColumnRenamed("time", "time_end")
    masked = S.land_mask(ended, grid).withColumn("var", rename_by_list(F.col("var"), F.lit(rename)))
    cast = masked.withColumn("value", F.col("value").cast("float"))
    keys = ["dataset", "time_end", "k", "tile", "j", "i"]
    product, ranges = written_product(cast, keys, names, ["dataset", "time_end"])
    return with_record_bounds(product, code, model_start, model_end), ranges


def series_product(
    series: DataFrame, hide: Column, total: str, parts: Sequence[str], step: str = "day"
) -> DataFrame:
    """P-10: leading records hidden, anomalies from the mean, period means, and total minus parts."""
    hidden = S.hide_leading(series, ["var"], "time", hide)
    means = A.resample(A.anomaly(hidden, ["var"]), ["var"], step)
    return budget_residual(means, total, parts)


def budget_residual(series: DataFrame, total: str, parts: Sequence[str]) -> DataFrame:
    """PRJ-21: wide terms with their sum and what the total leaves over."""
    wide = J.merge_variables(series, ["time"], [total, *parts])
    added = F.col(parts[0])
    for name in parts[1:]:
        added = added + F.col(name)
    return wide.withColumn("term_sum", added).withColumn("residual", F.col(total) - added)


def geometry_product(native: DataFrame, target: DataFrame, layers: DataFrame, longest: float) -> DataFrame:
    """P-11: mask by nearest cell, wet fraction by mean, area and layer thickness per target and level."""
    cell_fraction = native.select("k", "source_id", F.col("hfac").alias("value"))
    edges = R.mapping_edges(native, target, longest, group=("k",))
    fraction = R.apply_mapping(edges, cell_fraction, "mean", (), ("k", "source_id")).select(
        "target_id", "k", F.col("value").alias("hfac")
    )
    mask = nearest_mask(native, target, longest)
    return (
        target.select("target_id", "area", "lon", "lat")
        .join(fraction, "target_id")
        .join(mask, ["target_id", "k"], "left")
        .join(layers.select("k", F.col("dr"), "zu", "zl"), "k", "left")
        .withColumn("depth", F.col("hfac") * F.col("dr"))
    )


def mixing_product(
    field: DataFrame, native: DataFrame, target: DataFrame, longest: float
) -> tuple[DataFrame, DataFrame]:
    """P-12: time-invariant 3-D coefficients on the lat-lon grid and their ranges; masked after mapping.

    The product is written before its ranges are taken from it.
    """
    cell = ["k", "tile", "j", "i"]
    steady = A.time_mean(field, [*cell, "var"])
    values = with_cell_bounds(latlon_values(steady, native, target, longest, ["var"]), target)
    product = stored(values, "mixing-product")
    return product, A.value_range(product, ["var"])

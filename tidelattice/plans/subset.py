"""P-3 and P-4: subset access and opening of matching datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..operators import aggregate as A
from ..operators import select as S
from ..operators.joins import on_dates
from ..session import stored
from . import catalogue as C
from .granule_query import granule_query


def requested_dates(datasets: DataFrame, tokens: Sequence[str], interval: str = "daily") -> DataFrame:
    """SF-19: (dataset, date) rows that a short list of date tokens stands for, per dataset's resolution."""
    asked = datasets.withColumn("_token", F.explode(F.array(*[F.lit(x) for x in tokens])))
    dates = D.expand_date_token(F.col("_token"), F.col("resolution"), interval)
    return asked.select("dataset", F.explode(dates).alias("date")).distinct()


def subset(
    field: DataFrame,
    datasets: DataFrame,
    include: Sequence[str] | str = "all",
    omit: Sequence[str] | None = None,
    times: Sequence[str] | str = "all",
    slices: Mapping[str, tuple[int, int, int]] | None = None,
    bounds: Mapping[str, tuple[int, int]] | None = None,
    interval: str = "daily",
) -> DataFrame:
    """P-3: variables x times x index slices; every filter sits below the joins."""
    out = S.choose_variables(field, include, omit)
    if slices:
        out = S.hyperslab(out, slices, bounds or {})
    if times == "all":
        return out
    dated = out.withColumn("date", F.to_date("time"))
    return on_dates(dated, requested_dates(datasets, times, interval), ["dataset", "date"]).drop("date")


def access_dataset(
    field: DataFrame,
    listing: DataFrame,
    catalogue: DataFrame,
    query: str,
    start: str,
    end: str,
    grid: str | None = None,
    time_res: str = "all",
    interval: str | None = None,
    version: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """P-4: the granules of the datasets a search finds, and the rows of those granules in the date range.

    `field` names its dataset in `short_name`.  Without an `interval`, snapshots come daily when any dataset
    found is daily and else at the first of each month (AG-26, PRJ-5).  Granules are listed as P-1 lists
    them, gaps filled; a monthly granule holds its month's rows, any other one a day's.
    """
    found = C.search(catalogue, query, grid, time_res).select("short_name")
    asked = listing.join(found, "short_name", "left_semi")
    if interval is None:
        interval = asked.agg(A.snapshot_interval(asked).alias("interval")).first()["interval"]
    granules = stored(granule_query(asked, start, end, version, interval), "access-granules")
    name, day = F.col("short_name"), F.to_date("time")
    low = D.first_day_of(F.lit(start)).cast("timestamp")
    high = F.date_add(D.snapshot_end(name, D.last_day_of(F.lit(end))), 1).cast("timestamp")
    ranged = field.filter((F.col("time") >= low) & (F.col("time") < high)).withColumn(
        "gdate", F.when(F.contains(name, F.lit("MONTHLY")), F.trunc(day, "MM")).otherwise(day)
    )
    return granules, on_dates(ranged, granules, ["short_name", "gdate"]).drop("gdate")

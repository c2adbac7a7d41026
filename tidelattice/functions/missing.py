"""Missing values: NaN becomes NULL on the way in, NULL becomes a fill on the way out.

Spark orders NaN above every number and treats it as equal to itself, so `max`,
`median` and `avg` over raw NaN are wrong for gridded data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def normalise_missing(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: null_if_nan(F.col(c)) for c in cols})


def fill_missing(value: Column, fill: float) -> Column:
    """PRJ-11: the on-disk fill for NULL or NaN."""
    return F.coalesce(null_if_nan(value), F.lit(float(fill)))


def mean_all_present(value: Column) -> Column:
    """Mean that is missing as soon as one input is missing."""
    return F.when(F.count(value) == F.count(F.lit(1)), F.avg(value))


def mean_present(value: Column) -> Column:
    return F.avg(value)

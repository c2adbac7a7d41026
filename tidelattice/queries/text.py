"""Small helpers that fix how results are written so both engines agree."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stamp(c) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def stamp6(c) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def day(c) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def r6(c) -> Column:
    return F.round(c, 6)


def r3(c) -> Column:
    return F.round(c, 3)


def big(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


def r7(c) -> Column:
    """Means of two-decimal values: seven digits never fall on a rounding tie below 64 values."""
    return F.round(c, 7)

"""Date and time expressions.  Timestamps are UTC; every function returns Columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

# Time origin of the model run and the closed-open extents of its versions.
MODEL_START = dt.datetime(1992, 1, 1, 12)
MODEL_END = dt.datetime(2018, 1, 1)
VERSION_EXTENT = {
    "v4r4": (dt.date(1992, 1, 1), dt.date(2018, 1, 1)),
    "v4r5": (dt.date(1992, 1, 1), dt.date(2020, 1, 1)),
}

# Averaging codes and the calendar step each one covers.
PERIOD_STEP = {
    "AVG_DAY": "INTERVAL '1' DAY",
    "AVG_WEEK": "INTERVAL '7' DAY",
    "AVG_MON": "INTERVAL '1' MONTH",
    "AVG_YEAR": "INTERVAL '1' YEAR",
}

# Names under which source files keep their time bounds, first one first.
BOUNDS_PRIORITY = ("Time_bounds", "time_bnds", "time_bounds", "timebounds")

# File-name date codes and the Spark pattern that reads them.
DATE_CODES = {
    "yyyymm": "yyyyMM",
    "yyyy_mm": "yyyy_MM",
    "yyyyddd": "yyyyDDD",
    "yyyymmdd": "yyyyMMdd",
}

# Period code -> (file-name label, ISO duration, date pattern in file names).
PERIOD_LABELS = {
    "AVG_DAY": ("day_mean", "P1D", "yyyy-MM-dd"),
    "AVG_MON": ("mon_mean", "P1M", "yyyy-MM"),
    "SNAPSHOT": ("snap", "P0S", "yyyy-MM-dd'T'HHmmss"),
}


def _bad(message: str) -> Column:
    return F.raise_error(F.lit(message))


def first_day_of(text: Column) -> Column:
    """SF-1: `YYYY`, `YYYY-MM` or `YYYY-MM-DD` -> its first day."""
    return (
        F.when(F.length(text) == 4, F.to_date(F.concat(text, F.lit("-01-01"))))
        .when(F.length(text) == 7, F.to_date(F.concat(text, F.lit("-01"))))
        .when(F.length(text) == 10, F.to_date(text))
        .otherwise(_bad("start date must be YYYY, YYYY-MM or YYYY-MM-DD").cast("date"))
    )


def last_day_of(text: Column) -> Column:
    """SF-2: the same partial dates -> the last day they cover."""
    return (
        F.when(F.length(text) == 4, F.to_date(F.concat(text, F.lit("-12-31"))))
        .when(F.length(text) == 7, F.last_day(F.to_date(F.concat(text, F.lit("-01")))))
        .when(F.length(text) == 10, F.to_date(text))
        .otherwise(_bad("end date must be YYYY, YYYY-MM or YYYY-MM-DD").cast("date"))
    )


def snapshot_end(short_name: Column, end: Column) -> Column:
    """SF-3: snapshots need the instant that closes the range."""
    return F.when(F.contains(short_name, F.lit("SNAPSHOT")), F.date_add(end, 1)).otherwise(end)


def is_mean_product(short_name: Column) -> Column:
    return F.contains(short_name, F.lit("MONTHLY")) | F.contains(short_name, F.lit("DAILY"))


def catalogue_start(short_name: Column, start: Column, end: Column) -> Column:
    """SF-4: means search from one day later so that the previous period is not returned."""
    spans = is_mean_product(short_name) & (F.datediff(end, start) > 1)
    return F.when(spans, F.date_add(start, 1)).otherwise(start)


def is_single_day(short_name: Column, start: Column, end: Column) -> Column:
    """SF-4: the flag that asks for the one granule nearest the start date."""
    return is_mean_product(short_name) & (F.datediff(end, start) <= 1)


def midpoint(start: Column, end: Column) -> Column:
    a, b = F.unix_micros(start), F.unix_micros(end)
    return F.timestamp_micros((a + F.floor((b - a) / 2)).cast("long"))


def period_start(end: Column, code: Column) -> Column:
    """SF-5: one calendar step before the end of the averaging period."""
    out = F.when(F.lit(False), end)
    for name, step in PERIOD_STEP.items():
        out = out.when(code == name, end - F.expr(step))
    return out.otherwise(_bad("averaging code must be AVG_DAY, AVG_WEEK, AVG_MON or AVG_YEAR").cast("timestamp"))


def time_bounds(end: Column, code: Column) -> Column:
    """SF-5: struct(start, centre, end)."""
    start = period_start(end, code)
    return F.struct(start.alias("start"), midpoint(start, end).alias("centre"), end.alias("end"))


def clamp_bounds(start: Column, end: Column, model_start: Column, model_end: Column) -> Column:
    """SF-6: the last record starts half a day later, then the first one starts at the model start."""
    late = F.when(F.to_date(end) == F.to_date(model_end), start + F.expr("INTERVAL '12' HOUR")).otherwise(start)
    clamped = F.when(F.to_date(late) == F.to_date(model_start), model_start).otherwise(late)
    return F.struct(clamped.alias("start"), midpoint(clamped, end).alias("centre"), end.alias("end"))


def record_bounds(end: Column, code: Column, model_start: Column, model_end: Column) -> Column:
    """SF-5 and SF-6: struct(start, centre, end) by averaging code; a record of any other code is an instant."""
    mean = clamp_bounds(period_start(end, code), end, model_start, model_end)
    instant = F.struct(end.alias("start"), end.alias("centre"), end.alias("end"))
    return F.when(F.contains(code, F.lit("AVG")), mean).otherwise(instant)


def month_offsets(month_index: Column, base: Column) -> Column:
    """SF-7: days from `base` to the bounds and middle of the n-th month, plus its ANSI date."""
    lo = F.datediff(F.add_months(base, month_index), base)
    hi = F.datediff(F.add_months(base, month_index + 1), base)
    mid = (lo + hi) / F.lit(2.0)
    ansi = F.timestamp_seconds(F.unix_timestamp(base.cast("timestamp")) + (mid * 86400).cast("long"))
    return F.struct(
        lo.cast("long").alias("day_start"),
        hi.cast("long").alias("day_end"),
        mid.alias("day_mid"),
        F.date_format(ansi, "yyyy-MM-dd HH:mm:ss").alias("ansi"),
    )


def timestamp_parts(ts: Column) -> dict[str, Column]:
    """SF-8."""
    parts = {"year": F.year, "month": F.month, "day": F.dayofmonth, "hour": F.hour, "minute": F.minute, "second": F.second}
    return {name: fn(ts).cast("long") for name, fn in parts.items()}


def day_bounds(ts: Column) -> Column:
    """SF-9."""
    start = F.date_trunc("day", ts)
    return F.struct(start.alias("start"), (start + F.expr("INTERVAL '1' DAY")).alias("end"))


def record_end(record_date: Column, time_scale: Column) -> Column:
    """SF-10: a record that carries no time covers its whole month or day."""
    return F.when(F.upper(time_scale) == "MONTHLY", F.add_months(F.trunc(record_date, "MM"), 1)).otherwise(
        F.date_add(record_date, 1)
    )


def from_compact(text: Column) -> Column:
    """SF-11: `yyyymmdd...` -> date."""
    return F.to_date(F.substring(text, 1, 8), "yyyyMMdd")


def without_zone(text: Column) -> Column:
    """SF-12: drop the trailing zone letter and read as UTC."""
    return F.to_timestamp(F.left(text, F.length(text) - 1))


def first_bounds(*candidates: Column) -> Column:
    """SF-13: the first bounds column present, in order of priority."""
    return F.coalesce(*candidates)


def file_bounds(rule: str, date: Column, columns: Collection[str]) -> Column:
    """SF-9 and SF-11 to SF-13: struct(start, end) of a record by how its file keeps times.

    `time_bounds` takes the first bounds column there is, `no_time` the record's date, and the others read
    time_coverage_start and time_coverage_end: `compact` yyyymmdd, `zone` with a zone letter, `plain`, and
    `day` the whole day of the start.
    """
    first, last = F.col("time_coverage_start"), F.col("time_coverage_end")
    if rule == "time_bounds":
        return first_bounds(*[F.col(c) for c in BOUNDS_PRIORITY if c in columns])
    if rule == "day":
        return day_bounds(F.to_timestamp(first))
    if rule == "no_time":
        pair = date, date
    else:
        read = {"compact": from_compact, "zone": without_zone, "plain": F.to_timestamp}[rule]
        pair = read(first), read(last)
    return F.struct(pair[0].cast("timestamp").alias("start"), pair[1].cast("timestamp").alias("end"))


def step_to_time(step_hours: Column, origin: dt.datetime = MODEL_START) -> Column:
    """SF-14: model step in hours -> timestamp."""
    return F.timestamp_seconds(F.unix_timestamp(F.lit(origin)) + step_hours.cast("long") * 3600)


def from_date_code(text: Column, code: Column) -> Column:
    """SF-15: read a file-name date by its code; other codes are an error."""
    out = F.when(F.lit(False), F.current_date())
    for name, pattern in DATE_CODES.items():
        out = out.when(code == name, F.to_date(text, pattern))
    return out.otherwise(_bad("unknown date code").cast("date"))


def align_year(ts: Column, month: int, day: int, base_year: int) -> Column:
    """SF-16: shift every year onto one axis through its own (month, day)."""
    anchor = F.make_date(F.year(ts), F.lit(month), F.lit(day))
    return F.date_add(F.make_date(F.lit(base_year), F.lit(month), F.lit(day)), F.datediff(F.to_date(ts), anchor))


def period_label(code: Column) -> Column:
    """SF-17: struct(label, duration) of a period code."""
    out = F.when(F.lit(False), F.struct(F.lit("").alias("label"), F.lit("").alias("duration")))
    for name, (label, duration, _) in PERIOD_LABELS.items():
        out = out.when(code == name, F.struct(F.lit(label).alias("label"), F.lit(duration).alias("duration")))
    return out


def period_date(ts: Column, code: Column) -> Column:
    """SF-17: the date as it is written in a file name."""
    out = F.when(F.lit(False), F.lit(""))
    for name, (_, _, pattern) in PERIOD_LABELS.items():
        out = out.when(code == name, F.date_format(ts, pattern))
    return out


def expected_dates(short_name: Column, start: Column, end: Column, version: str | None = None) -> Column:
    """SF-18: array of the dates a complete listing has between two closed dates.

    Monthly products expect month starts.  The version extent is half open for
    means; snapshots also have the instant at its end.
    """
    monthly = F.contains(short_name, F.lit("MONTHLY"))
    lo, hi = start, end
    if version is not None:
        first, stop = VERSION_EXTENT[version]
        last = F.when(F.contains(short_name, F.lit("SNAPSHOT")), F.lit(stop)).otherwise(F.date_sub(F.lit(stop), 1))
        lo, hi = F.greatest(lo, F.lit(first)), F.least(hi, last)
    none = F.array().cast("array<date>")
    months = F.sequence(F.trunc(lo, "MM"), F.trunc(hi, "MM"), F.expr("INTERVAL '1' MONTH"))
    days = F.sequence(lo, hi, F.expr("INTERVAL '1' DAY"))
    return F.when(lo > hi, none).when(monthly, months).otherwise(days)


def expand_date_token(token: Column, short_name: Column, snapshot_interval: str = "daily") -> Column:
    """SF-19: array of dates a year, month or day token stands for in a dataset."""
    first = first_day_of(token)
    is_year, is_month = F.length(token) == 4, F.length(token) == 7
    month = F.expr("INTERVAL '1' MONTH")
    day = F.expr("INTERVAL '1' DAY")
    start_of_month = F.trunc(first, "MM")
    monthly = F.when(is_year, F.sequence(first, F.add_months(first, 11), month)).otherwise(F.array(start_of_month))
    daily = (
        F.when(is_year, F.sequence(first, F.date_sub(F.add_months(first, 12), 1), day))
        .when(is_month, F.sequence(first, F.last_day(first), day))
        .otherwise(F.array(first))
    )
    pairs = F.array(start_of_month, F.add_months(start_of_month, 1))
    single = pairs if snapshot_interval == "monthly" else F.array(first)
    snapshot = (
        F.when(is_year, F.sequence(first, F.add_months(first, 12), month)).when(is_month, pairs).otherwise(single)
    )
    return (
        F.when(F.contains(short_name, F.lit("MONTHLY")), monthly)
        .when(F.contains(short_name, F.lit("DAILY")), daily)
        .when(F.contains(short_name, F.lit("SNAPSHOT")), snapshot)
        .otherwise(F.array().cast("array<date>"))
    )

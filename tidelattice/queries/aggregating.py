"""Aggregates over time, space and catalogues."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.attrs import keyword_union
from ..functions.geometry import bytes_of, in_box
from ..operators import aggregate as A
from ..operators import joins as J
from ..plans import quality as Q
from .registry import query
from .selecting import BOX_SQL
from .text import day, r3, r6, r7, stamp


@query("ag_7", "SELECT dataset, var, min(value) AS valid_min, max(value) AS valid_max FROM field GROUP BY dataset, var")
def ag_7(t):
    return A.value_range(t.field(), ["dataset", "var"])


@query("ag_8", "SELECT dataset, var, round(min(valid_min), 6) AS valid_min, round(max(valid_max), 6) AS valid_max FROM qc GROUP BY dataset, var")
def ag_8(t):
    out = A.stored_range(t.stored_ranges(), ["dataset", "var"])
    return out.select("dataset", "var", r6("valid_min").alias("valid_min"), r6("valid_max").alias("valid_max"))


CELL = ["dataset", "k", "tile", "j", "i", "var"]


@query(
    "ag_9",
    """
SELECT strftime(date_trunc('month', "time"), '%Y-%m-%d') AS "month", dataset, k, tile, j, i, var, round(avg(value), 7) AS skipped,
       round(CASE WHEN count(value) = count(*) THEN avg(value) END, 7) AS strict
FROM field GROUP BY ALL
""",
)
def ag_9(t):
    """Both settings of the missing-value switch side by side."""
    both = A.monthly_means(t.field(), CELL)
    return both.select(day("month").alias("month"), *CELL, r7("skipped").alias("skipped"), r7("strict").alias("strict"))


@query(
    "ag_10",
    """
SELECT strftime("time", '%Y-%m-%d') AS "day", tile, j, i, count(*) AS n, count(value) AS present FROM field f
WHERE EXISTS (SELECT 1 FROM field g WHERE g."time" = f."time" AND g.tile = f.tile AND g.j = f.j AND g.i = f.i AND g.value IS NOT NULL)
GROUP BY ALL
""",
)
def ag_10(t):
    kept = A.without_empty_days(t.field(), ["time", "tile", "j", "i"])
    return kept.groupBy(day("time").alias("day"), "tile", "j", "i").agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("present")
    )


@query(
    "ag_11",
    """
SELECT 'day' AS step, strftime(date_trunc('day', "time"), '%Y-%m-%d') AS "time", var, round(avg(value), 6) AS value FROM series GROUP BY ALL
UNION ALL SELECT 'month', strftime(date_trunc('month', "time"), '%Y-%m-%d'), var, round(avg(value), 6) FROM series GROUP BY ALL
""",
)
def ag_11(t):
    s = t.series()
    one = lambda step: A.resample(s, ["var"], step).select(
        F.lit(step).alias("step"), day("time").alias("time"), "var", r6("value").alias("value")
    )
    return one("day").unionByName(one("month"))


@query("ag_12", "SELECT dataset, k, tile, j, i, var, round(avg(value), 7) AS value FROM field GROUP BY ALL")
def ag_12(t):
    return A.time_mean(t.field(), CELL).withColumn("value", r7("value"))


@query(
    "ag_13",
    """
SELECT strftime("time", '%Y-%m-%d %H:%M:%S') AS "time", var, round(value - avg(value) OVER (PARTITION BY var), 4) AS value FROM series
""",
)
def ag_13(t):
    out = A.anomaly(t.series(), ["var"])
    return out.select(stamp("time").alias("time"), "var", F.round("value", 4).alias("value"))


@query(
    "ag_14",
    """
WITH p AS (SELECT short_name, size_mb * CAST(1048576 AS DOUBLE) AS b FROM gran WHERE regexp_extract(url, '[^/]*$') NOT IN (SELECT basename FROM have)),
s AS (SELECT short_name, count(*) AS files, sum(b) AS b FROM p GROUP BY short_name)
SELECT short_name, files, round(b / CAST(1073741824 AS DOUBLE), 3) AS size_gb, round(b / CAST(3000000000 AS DOUBLE), 6) AS share,
       CASE WHEN b / CAST(3000000000 AS DOUBLE) <= CAST(0.5 AS DOUBLE) THEN 'download' ELSE 'open_remote' END AS decision FROM s
""",
)
def ag_14(t):
    pending = J.not_present(t.granules(), t.have()).withColumn("size_bytes", bytes_of(F.col("size_mb")))
    return A.footprint(pending, available_bytes=3e9, max_fraction=0.5)


@query(
    "ag_15",
    """
WITH b AS (SELECT short_name, url, gdate, size_mb * CAST(1048576 AS DOUBLE) AS b FROM gran),
k AS (SELECT *, CASE WHEN b > 1024 THEN b END AS kb FROM b),
r AS (SELECT short_name, avg(kb) AS m FROM k WHERE year(gdate) = 1998 GROUP BY short_name), w AS (SELECT short_name, avg(kb) AS m FROM k GROUP BY short_name)
SELECT url, round(coalesce(kb, r.m, w.m), 3) AS size_bytes FROM k JOIN r USING (short_name) JOIN w USING (short_name) WHERE year(gdate) = 1998
""",
)
def ag_15(t):
    sized = t.granules().select("short_name", "url", "gdate", bytes_of(F.col("size_mb")).alias("size_bytes"))
    request = sized.filter(F.year("gdate") == 1998)
    return A.repair_sizes(request, sized).select("url", r3("size_bytes").alias("size_bytes"))


@query(
    "ag_16",
    """
WITH s AS (SELECT DISTINCT dataset || var || tile AS var, "time" FROM field)
SELECT var, count(*) AS steps, (SELECT count(DISTINCT "time") FROM s) AS all_steps, count(*) = (SELECT count(DISTINCT "time") FROM s) AS complete FROM s GROUP BY var
""",
)
def ag_16(t):
    named = t.field().select(F.concat("dataset", "var", F.col("tile").cast("string")).alias("var"), "time")
    return A.missing_steps(named)


@query(
    "ag_17",
    f"""
SELECT array_to_string(list_sort(list(DISTINCT tile)), ',') AS tile, array_to_string(list_sort(list(DISTINCT j)), ',') AS j, array_to_string(list_sort(list(DISTINCT i)), ',') AS i FROM cells WHERE {BOX_SQL}
""",
)
def ag_17(t):
    inside = t.cells().filter(in_box(F.col("xc"), F.col("yc"), -85.5, 40, 150.15, -110.15))
    names = ["tile", "j", "i"]
    return A.distinct_indices(inside, [], names).select(*[F.array_join(n, ",").alias(n) for n in names])


@query("ag_18", "SELECT tile, min(yc) AS lat_min, max(yc) AS lat_max, round(min(xc), 6) AS lon_min, round(max(xc), 6) AS lon_max FROM cells GROUP BY tile")
def ag_18(t):
    cells = t.cells()
    out = cells.groupBy("tile").agg(*A.extent(cells))
    return out.select("tile", "lat_min", "lat_max", r6("lon_min").alias("lon_min"), r6("lon_max").alias("lon_max"))


@query(
    "ag_19",
    """
SELECT CAST(CASE WHEN fix_title IS NULL OR fix_title <> title THEN -1 WHEN string_split(link, 'ShortName=')[2] <> fix_short_name OR summary <> fix_summary THEN 1 ELSE 0 END AS BIGINT) AS status,
       count(*) AS n FROM meta LEFT JOIN repairs USING (id) GROUP BY 1
""",
)
def ag_19(t):
    return A.status_summary(Q.header_status(t.metadata(), t.repairs()))


PATTERNS = {"daily": "day_mean", "monthly": "mon_mean", "snapshots": "_snap_", "temperature": "TEMP_M", "ssh": "/SSH_M"}


@query(
    "ag_20",
    " UNION ALL ".join(
        f"SELECT '{name}' AS pattern, count(*) AS n FROM gran WHERE regexp_matches(url, '{p}')" for name, p in PATTERNS.items()
    ),
)
def ag_20(t):
    return A.arrivals(t.granules(), PATTERNS)


@query(
    "ag_21",
    """
WITH d AS (SELECT tile, CAST(111.1 AS DOUBLE) * cos(radians(yc)) / CAST(3 AS DOUBLE) AS dx, CAST(222.2 AS DOUBLE) AS dy FROM cells)
SELECT tile, round(least(min(dx), min(dy)), 6) AS shortest, round(greatest(max(dx), max(dy)), 6) AS longest FROM d GROUP BY tile
""",
)
def ag_21(t):
    lengths = t.cells().select(
        "tile", (F.lit(111.1) * F.cos(F.radians("yc")) / 3.0).alias("dx"), F.lit(222.2).alias("dy")
    )
    out = lengths.groupBy("tile").agg(*A.length_scale(lengths))
    return out.select("tile", r6("shortest").alias("shortest"), r6("longest").alias("longest"))


@query(
    "ag_22",
    """
SELECT s_suppkey, array_to_string(list_sort(list_distinct(list_transform(string_split(keywords || ',' || keywords_extra, ','), lambda x: trim(x)))), ', ') AS keywords FROM meta
""",
)
def ag_22(t):
    return t.metadata().select("s_suppkey", keyword_union(F.col("keywords"), F.col("keywords_extra")).alias("keywords"))


@query(
    "ag_23",
    """
SELECT strftime("time", '%Y-%m-%d') AS "day", tile, k, j, i, count(value) = 0 AS is_empty FROM field GROUP BY ALL
""",
)
def ag_23(t):
    days = t.field().withColumn("time", F.date_trunc("day", "time"))
    out = A.empty_periods(days, ["time", "tile", "k", "j", "i"])
    return out.select(day("time").alias("day"), "tile", "k", "j", "i", "is_empty")


@query(
    "ag_24",
    """
SELECT short_name, strftime(min(time_start), '%Y-%m-%d %H:%M:%S') AS coverage_start, strftime(max(time_end), '%Y-%m-%d %H:%M:%S') AS coverage_end,
       CASE WHEN short_name LIKE '%MONTHLY%' THEN 'P1M' WHEN short_name LIKE '%DAILY%' THEN 'P1D' ELSE 'P0S' END AS duration
FROM gran GROUP BY short_name
""",
)
def ag_24(t):
    from ..functions.strings import name_resolution

    out = A.coverage(t.granules(), ["short_name"], name_resolution(F.col("short_name")))
    return out.select("short_name", stamp("coverage_start").alias("coverage_start"), stamp("coverage_end").alias("coverage_end"), "duration")


@query(
    "ag_26",
    """
SELECT stem, CASE WHEN bool_or(short_name LIKE '%DAILY%') THEN 'daily' ELSE 'monthly' END AS "interval" FROM gran GROUP BY stem
""",
)
def ag_26(t):
    g = t.granules()
    return g.groupBy("stem").agg(A.snapshot_interval(g).alias("interval"))


@query(
    "ag_27",
    """
WITH a AS (SELECT dataset, var, min(value) AS lo, max(value) AS hi FROM field GROUP BY dataset, var)
SELECT q.dataset, q.var, q."month", q.valid_min > a.lo OR q.valid_max < a.hi AS old_bad, n.lo > a.lo OR n.hi < a.hi AS new_bad
FROM qc q JOIN a USING (dataset, var)
JOIN (SELECT dataset, var, min(valid_min) AS lo, max(valid_max) AS hi FROM qc WHERE var = 'V0' OR "month" > '2000-01' GROUP BY dataset, var) n USING (dataset, var)
""",
)
def ag_27(t):
    """New ranges come from the stored ones: all months of one variable, and of the others those after the first."""
    keys = ["dataset", "var"]
    stored = t.stored_ranges().select(*keys, "month", "valid_min", "valid_max")
    new = A.stored_range(stored.filter((F.col("var") == "V0") | (F.col("month") > "2000-01")), keys)
    return A.range_audit(A.value_range(t.field(), keys), stored, new, keys, ["month"]).select(*keys, "month", "old_bad", "new_bad")

"""Date, string, geometry and index expressions over whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import attrs as A
from ..functions import dates as D
from ..functions import geometry as G
from ..functions import gridindex as X
from ..functions import strings as T
from ..plans.grids import regular_grid
from ..sources.derived import CELL_N
from .registry import query
from .text import big, day, r3, r6, stamp

PARTIAL = """
SELECT o_orderkey, o_orderdate,
       left(strftime(o_orderdate, '%Y-%m-%d'), [4, 7, 10][CAST(o_orderkey % 3 + 1 AS INTEGER)]) AS part_date
FROM orders
"""


def partial_dates(t):
    cut = F.element_at(F.array(F.lit(4), F.lit(7), F.lit(10)), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return t.table("orders").select("o_orderkey", F.left(day("o_orderdate"), cut).alias("part_date"))


@query(
    "sf_1",
    f"""
SELECT o_orderkey, CASE length(part_date) WHEN 4 THEN part_date || '-01-01' WHEN 7 THEN part_date || '-01' ELSE part_date END AS first_day
FROM ({PARTIAL})
""",
)
def sf_1(t):
    return partial_dates(t).select("o_orderkey", day(D.first_day_of(F.col("part_date"))).alias("first_day"))


@query(
    "sf_2",
    f"""
SELECT o_orderkey, CASE length(part_date) WHEN 4 THEN part_date || '-12-31'
         WHEN 7 THEN strftime(last_day(o_orderdate), '%Y-%m-%d') ELSE part_date END AS last_day
FROM ({PARTIAL})
""",
)
def sf_2(t):
    return partial_dates(t).select("o_orderkey", day(D.last_day_of(F.col("part_date"))).alias("last_day"))


@query(
    "sf_3",
    """
SELECT url, strftime(CASE WHEN short_name LIKE '%SNAPSHOT%' THEN gdate + INTERVAL 1 DAY ELSE gdate END, '%Y-%m-%d') AS end_day FROM gran
""",
)
def sf_3(t):
    return t.granules().select("url", day(D.snapshot_end(F.col("short_name"), F.col("gdate"))).alias("end_day"))


@query(
    "sf_4",
    """
SELECT url,
       strftime(CASE WHEN mean AND span > 1 THEN gdate + INTERVAL 1 DAY ELSE gdate END, '%Y-%m-%d') AS start_day,
       mean AND span <= 1 AS single_day
FROM (SELECT *, short_name LIKE '%MONTHLY%' OR short_name LIKE '%DAILY%' AS mean, day(gdate) % 4 AS span FROM gran)
""",
)
def sf_4(t):
    start, end = F.col("gdate"), F.date_add("gdate", (F.dayofmonth("gdate") % 4).cast("int"))
    name = F.col("short_name")
    return t.granules().select(
        "url",
        day(D.catalogue_start(name, start, end)).alias("start_day"),
        D.is_single_day(name, start, end).alias("single_day"),
    )


CODED = """
SELECT event_id, date_trunc('hour', ts) + INTERVAL 7 HOUR AS t_end,
       ['AVG_DAY', 'AVG_WEEK', 'AVG_MON', 'AVG_YEAR'][CAST(event_id % 4 + 1 AS INTEGER)] AS code FROM events
"""
BOUNDED = f"""
SELECT *, CASE code WHEN 'AVG_DAY' THEN t_end - INTERVAL 1 DAY WHEN 'AVG_WEEK' THEN t_end - INTERVAL 7 DAY
           WHEN 'AVG_MON' THEN t_end - INTERVAL 1 MONTH ELSE t_end - INTERVAL 1 YEAR END AS t_start
FROM ({CODED})
"""


def coded(t):
    code = F.element_at(F.array(*[F.lit(c) for c in D.PERIOD_STEP]), (F.col("event_id") % 4 + 1).cast("int"))
    return t.table("events").select(
        "event_id", (F.date_trunc("hour", "ts") + F.expr("INTERVAL '7' HOUR")).alias("t_end"), code.alias("code")
    )


@query(
    "sf_5",
    f"""
SELECT event_id, strftime(t_start, '%Y-%m-%d %H:%M:%S') AS t_start, strftime(t_end, '%Y-%m-%d %H:%M:%S') AS t_end,
       strftime(make_timestamp((epoch_us(t_start) + epoch_us(t_end)) // 2), '%Y-%m-%d %H:%M:%S') AS t_centre
FROM ({BOUNDED})
""",
)
def sf_5(t):
    b = coded(t).select("event_id", D.time_bounds(F.col("t_end"), F.col("code")).alias("b"))
    return b.select(
        "event_id", stamp("b.start").alias("t_start"), stamp("b.end").alias("t_end"), stamp("b.centre").alias("t_centre")
    )


@query(
    "sf_6",
    f"""
WITH late AS (
  SELECT event_id, t_end, CASE WHEN CAST(t_end AS DATE) = DATE '2024-01-30' THEN t_start + INTERVAL 12 HOUR ELSE t_start END AS s
  FROM ({BOUNDED})),
clamped AS (
  SELECT event_id, t_end, CASE WHEN CAST(s AS DATE) = DATE '2024-01-01' THEN TIMESTAMP '2024-01-01 12:00:00' ELSE s END AS s FROM late)
SELECT event_id, strftime(s, '%Y-%m-%d %H:%M:%S') AS t_start, strftime(t_end, '%Y-%m-%d %H:%M:%S') AS t_end,
       strftime(make_timestamp((epoch_us(s) + epoch_us(t_end)) // 2), '%Y-%m-%d %H:%M:%S') AS t_centre
FROM clamped
""",
)
def sf_6(t):
    start = D.period_start(F.col("t_end"), F.col("code"))
    first, last = F.lit(dt.datetime(2024, 1, 1, 12)), F.lit(dt.datetime(2024, 1, 30))
    b = coded(t).select("event_id", D.clamp_bounds(start, F.col("t_end"), first, last).alias("b"))
    return b.select(
        "event_id", stamp("b.start").alias("t_start"), stamp("b.end").alias("t_end"), stamp("b.centre").alias("t_centre")
    )


@query(
    "sf_7",
    """
SELECT o_orderkey, lo AS day_start, hi AS day_end, (lo + hi) / CAST(2 AS DOUBLE) AS day_mid,
       strftime(TIMESTAMP '1992-01-01' + to_hours(CAST((lo + hi) * 12 AS BIGINT)), '%Y-%m-%d %H:%M:%S') AS ansi
FROM (SELECT o_orderkey, datediff('day', DATE '1992-01-01', CAST(DATE '1992-01-01' + to_months(CAST(m AS INTEGER)) AS DATE)) AS lo,
             datediff('day', DATE '1992-01-01', CAST(DATE '1992-01-01' + to_months(CAST(m + 1 AS INTEGER)) AS DATE)) AS hi
      FROM (SELECT o_orderkey, (year(o_orderdate) - 1992) * 12 + month(o_orderdate) - 1 AS m FROM orders))
""",
)
def sf_7(t):
    index = ((F.year("o_orderdate") - 1992) * 12 + F.month("o_orderdate") - 1).cast("int")
    b = t.table("orders").select(
        "o_orderkey", D.month_offsets(index, F.lit("1992-01-01").cast("date")).alias("b")
    )
    return b.select("o_orderkey", "b.*")


@query(
    "sf_8",
    """
SELECT event_id, year(ts) AS "year", month(ts) AS "month", day(ts) AS "day", hour(ts) AS "hour", minute(ts) AS "minute",
       second(ts) AS "second" FROM events
""",
)
def sf_8(t):
    return t.table("events").select("event_id", *[c.alias(n) for n, c in D.timestamp_parts(F.col("ts")).items()])


@query(
    "sf_9",
    """
SELECT event_id, strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS t_start,
       strftime(date_trunc('day', ts) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS t_end FROM events
""",
)
def sf_9(t):
    b = t.table("events").select("event_id", D.day_bounds(F.col("ts")).alias("b"))
    return b.select("event_id", stamp("b.start").alias("t_start"), stamp("b.end").alias("t_end"))


@query(
    "sf_10",
    """
SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 2 = 0 THEN date_trunc('month', o_orderdate) + INTERVAL 1 MONTH
                          ELSE o_orderdate + INTERVAL 1 DAY END, '%Y-%m-%d') AS record_end FROM orders
""",
)
def sf_10(t):
    scale = F.when(F.col("o_orderkey") % 2 == 0, "MONTHLY").otherwise("daily")
    return t.table("orders").select("o_orderkey", day(D.record_end(F.to_date("o_orderdate"), scale)).alias("record_end"))


@query("sf_11", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS iso_day FROM events")
def sf_11(t):
    compact = F.date_format("ts", "yyyyMMdd'T'HHmmss")
    return t.table("events").select("event_id", day(D.from_compact(compact)).alias("iso_day"))


@query("sf_12", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t FROM events")
def sf_12(t):
    zoned = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    return t.table("events").select("event_id", stamp(D.without_zone(zoned)).alias("t"))


@query(
    "sf_13",
    """
SELECT event_id, strftime(CASE WHEN event_id % 2 = 0 THEN ts WHEN event_id % 3 = 0 THEN ts + INTERVAL 1 DAY
         WHEN event_id % 5 = 0 THEN ts + INTERVAL 2 DAY WHEN event_id % 7 = 0 THEN ts + INTERVAL 3 DAY END, '%Y-%m-%d %H:%M:%S') AS t_start
FROM events
""",
)
def sf_13(t):
    """Four optional bounds columns; the first present in their fixed priority counts."""
    present = {f"{name}_{d}": p for d, (name, p) in enumerate(zip(D.BOUNDS_PRIORITY, (2, 3, 5, 7)))}
    wide = t.table("events").select(
        "event_id",
        *[
            F.when(F.col("event_id") % p == 0, F.col("ts") + F.expr(f"INTERVAL '{c[-1]}' DAY")).alias(c)
            for c, p in present.items()
        ],
    )
    return wide.select("event_id", stamp(D.first_bounds(*[F.col(c) for c in present])).alias("t_start"))


@query(
    "sf_14",
    """
SELECT o_orderkey, strftime(TIMESTAMP '1992-01-01 12:00:00' + to_hours(o_orderkey), '%Y-%m-%d %H:%M:%S') AS t FROM orders
""",
)
def sf_14(t):
    return t.table("orders").select("o_orderkey", stamp(D.step_to_time(F.col("o_orderkey"))).alias("t"))


@query(
    "sf_15",
    """
SELECT o_orderkey, ['yyyymm', 'yyyy_mm', 'yyyyddd', 'yyyymmdd'][CAST(o_orderkey % 4 + 1 AS INTEGER)] AS code,
       strftime(CASE WHEN o_orderkey % 4 < 2 THEN date_trunc('month', o_orderdate) ELSE o_orderdate END, '%Y-%m-%d') AS iso_day
FROM orders
""",
)
def sf_15(t):
    at = (F.col("o_orderkey") % 4 + 1).cast("int")
    coded_dates = t.table("orders").select(
        "o_orderkey",
        F.element_at(F.array(*[F.lit(c) for c in D.DATE_CODES]), at).alias("code"),
        F.element_at(F.array(*[F.date_format("o_orderdate", p.replace("D" * 3, "DDD")) for p in D.DATE_CODES.values()]), at).alias("text"),
    )
    return coded_dates.select("o_orderkey", "code", day(D.from_date_code(F.col("text"), F.col("code"))).alias("iso_day"))


@query(
    "sf_16",
    """
SELECT o_orderkey, strftime(DATE '2004-08-01' + CAST(datediff('day', make_date(year(o_orderdate), 8, 1), CAST(o_orderdate AS DATE)) AS INTEGER), '%Y-%m-%d') AS axis_day
FROM orders
""",
)
def sf_16(t):
    return t.table("orders").select("o_orderkey", day(D.align_year(F.col("o_orderdate"), 8, 1, 2004)).alias("axis_day"))


@query(
    "sf_17",
    """
SELECT event_id, ['day_mean', 'mon_mean', 'snap'][CAST(event_id % 3 + 1 AS INTEGER)] AS label,
       ['P1D', 'P1M', 'P0S'][CAST(event_id % 3 + 1 AS INTEGER)] AS duration,
       CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%Y-%m')
            ELSE strftime(ts, '%Y-%m-%dT%H%M%S') END AS date_text
FROM events
""",
)
def sf_17(t):
    code = F.element_at(F.array(*[F.lit(c) for c in D.PERIOD_LABELS]), (F.col("event_id") % 3 + 1).cast("int"))
    return t.table("events").select(
        "event_id", D.period_label(code).alias("p"), D.period_date(F.col("ts"), code).alias("date_text")
    ).select("event_id", "p.*", "date_text")


@query(
    "sf_18",
    """
WITH r AS (SELECT short_name, min(gdate) AS lo, max(gdate) AS hi FROM gran GROUP BY short_name)
SELECT short_name, strftime(d, '%Y-%m-%d') AS "date" FROM (
  SELECT short_name, unnest(CASE WHEN short_name LIKE '%MONTHLY%'
    THEN generate_series(CAST(date_trunc('month', lo) AS TIMESTAMP), CAST(date_trunc('month', hi) AS TIMESTAMP), INTERVAL 1 MONTH)
    ELSE generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY) END) AS d FROM r)
""",
)
def sf_18(t):
    spans = t.granules().groupBy("short_name").agg(F.min("gdate").alias("lo"), F.max("gdate").alias("hi"))
    dates = D.expected_dates(F.col("short_name"), F.col("lo"), F.col("hi"), version="v4r4")
    return spans.select("short_name", F.explode(dates).alias("d")).select("short_name", day("d").alias("date"))


@query(
    "sf_19",
    """
WITH k AS (SELECT o_orderkey, part_date, ['X_MONTHLY', 'X_DAILY', 'X_SNAPSHOT'][CAST((o_orderkey // 3) % 3 + 1 AS INTEGER)] AS short_name,
                  CAST(CASE length(part_date) WHEN 4 THEN part_date || '-01-01' WHEN 7 THEN part_date || '-01' ELSE part_date END AS TIMESTAMP) AS f
           FROM (SELECT o_orderkey, left(strftime(o_orderdate, '%Y-%m-%d'), [4, 7, 10][CAST(o_orderkey % 3 + 1 AS INTEGER)]) AS part_date FROM orders)),
e AS (SELECT o_orderkey, short_name, unnest(CASE
        WHEN short_name = 'X_MONTHLY' AND length(part_date) = 4 THEN generate_series(f, f + INTERVAL 11 MONTH, INTERVAL 1 MONTH)
        WHEN short_name = 'X_MONTHLY' THEN [CAST(date_trunc('month', f) AS TIMESTAMP)]
        WHEN short_name = 'X_DAILY' AND length(part_date) = 4 THEN generate_series(f, CAST(f + INTERVAL 1 YEAR - INTERVAL 1 DAY AS TIMESTAMP), INTERVAL 1 DAY)
        WHEN short_name = 'X_DAILY' AND length(part_date) = 7 THEN generate_series(f, CAST(f + INTERVAL 1 MONTH - INTERVAL 1 DAY AS TIMESTAMP), INTERVAL 1 DAY)
        WHEN short_name = 'X_SNAPSHOT' AND length(part_date) = 4 THEN generate_series(f, f + INTERVAL 12 MONTH, INTERVAL 1 MONTH)
        WHEN short_name = 'X_SNAPSHOT' AND length(part_date) = 7 THEN [f, f + INTERVAL 1 MONTH]
        ELSE [f] END) AS d FROM k)
SELECT o_orderkey, short_name, strftime(d, '%Y-%m-%d') AS "date" FROM e
""",
)
def sf_19(t):
    name = F.element_at(
        F.array(F.lit("X_MONTHLY"), F.lit("X_DAILY"), F.lit("X_SNAPSHOT")), (F.floor(F.col("o_orderkey") / 3) % 3 + 1).cast("int")
    )
    asked = partial_dates(t).withColumn("short_name", name)
    dates = D.expand_date_token(F.col("part_date"), F.col("short_name"))
    return asked.select("o_orderkey", "short_name", F.explode(dates).alias("d")).select("o_orderkey", "short_name", day("d").alias("date"))


@query("sf_20", r"SELECT url, regexp_extract(url, '_(\d{4}-\d{2}(-\d{2})?)', 1) AS date_text FROM gran")
def sf_20(t):
    return t.granules().select("url", T.granule_date_text(F.col("url")).alias("date_text"))


@query("sf_21", "SELECT url, string_split(url, '_')[-5] AS token FROM gran")
def sf_21(t):
    return t.granules().select("url", T.token_from_right(F.col("url"), -5).alias("token"))


@query(
    "sf_22",
    """
SELECT url, replace(url, '_' || string_split(url, '_')[-5] || '_', '_' || strftime(gdate + INTERVAL 1 DAY, '%Y-%m-%d') || '_') AS filled FROM gran
""",
)
def sf_22(t):
    return t.granules().select("url", T.with_date_token(F.col("url"), day(F.date_add("gdate", 1))).alias("filled"))


@query(
    "sf_24",
    """
SELECT url, CASE WHEN short_name LIKE '%LLC%' THEN 'native' ELSE 'latlon' END AS grid,
       CASE WHEN short_name LIKE '%MONTHLY%' THEN 'monthly' WHEN short_name LIKE '%DAILY%' THEN 'daily' ELSE 'snapshot' END AS resolution,
       stem AS core,
       (CASE WHEN short_name LIKE '%LLC%' THEN 'native' ELSE 'latlon' END) || '/' ||
       (CASE WHEN short_name LIKE '%MONTHLY%' THEN 'mon_mean' WHEN short_name LIKE '%DAILY%' THEN 'day_mean' ELSE 'snap' END) || '/' || stem AS folder
FROM gran
""",
)
def sf_24(t):
    name = F.col("short_name")
    return t.granules().select(
        "url", T.name_grid(name).alias("grid"), T.name_resolution(name).alias("resolution"),
        T.name_core(name).alias("core"), T.name_folder(name).alias("folder"),
    )


@query(
    "sf_25",
    """
SELECT entry_id, contains(lower(short_name), 'econ') AS in_name,
       contains(lower(short_name), 'red') OR contains(lower(var), 'red') OR contains(lower(description), 'red')
         OR coalesce(contains(lower(note), 'red'), false) AS anywhere
FROM cat
""",
)
def sf_25(t):
    from ..plans.catalogue import matches

    return t.catalogue().select(
        "entry_id", T.contains_ci(F.col("short_name"), F.lit("ECON")).alias("in_name"), matches(F.lit("Red")).alias("anywhere")
    )


@query(
    "sf_26",
    """
SELECT s_suppkey, 'DS_' || s_suppkey AS id_part, string_split(link, 'ShortName=')[2] AS link_name,
       replace('ARCH-' || s_suppkey, 'ARCH-', '10.9999/') AS doi
FROM meta
""",
)
def sf_26(t):
    return t.metadata().select(
        "s_suppkey",
        T.id_tail(F.col("id")).alias("id_part"),
        T.link_short_name(F.col("link")).alias("link_name"),
        T.replace_prefix(F.concat(F.lit("ARCH-"), "s_suppkey"), "ARCH-", "10.9999/").alias("doi"),
    )


@query("sf_28", "SELECT url, regexp_extract(url, '[^/]*$') AS basename FROM gran")
def sf_28(t):
    return t.granules().select("url", T.basename(F.col("url")).alias("basename"))


@query("sf_29", "SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS step FROM orders")
def sf_29(t):
    return t.table("orders").select("o_orderkey", T.padded_step(F.col("o_orderkey")).alias("step"))


@query(
    "sf_31",
    """
SELECT entry_id, CASE WHEN note LIKE '%*%' THEN note ELSE
   '*' || (CASE WHEN short_name LIKE '%LLC%' THEN 'native grid,' WHEN short_name LIKE '%DEG%' THEN 'lat-lon grid,' ELSE '' END)
       || (CASE WHEN short_name LIKE '%MONTHLY%' THEN 'monthly means*' WHEN short_name LIKE '%DAILY%' THEN 'daily means*'
                WHEN short_name LIKE '%SNAPSHOT%' THEN 'snapshots at daily intervals*' ELSE '' END) END AS label
FROM cat
""",
)
def sf_31(t):
    return t.catalogue().select("entry_id", T.product_label(F.col("short_name"), F.col("note")).alias("label"))


@query(
    "sf_32",
    """
SELECT entry_id, note IS NULL OR (contains(note, 'native') AND contains(note, 'monthly')) AS allowed FROM cat
""",
)
def sf_32(t):
    return t.catalogue().select("entry_id", T.note_allows(F.col("note"), "native", "monthly").alias("allowed"))


BOXES = """
SELECT source_id, floor(lon / CAST(5 AS DOUBLE)) * CAST(5 AS DOUBLE) AS lon0, floor(lat / CAST(5 AS DOUBLE)) * CAST(5 AS DOUBLE) AS lat0 FROM obs
"""
AREA = """(sin(radians(lat0 + CAST(5 AS DOUBLE))) - sin(radians(lat0))) * (radians(lon0 + CAST(5 AS DOUBLE)) - radians(lon0))
         * CAST(40589753129677.44 AS DOUBLE)"""


def boxes(t):
    box = lambda c: F.floor(F.col(c) / 5.0) * F.lit(5.0)
    return t.obs().select("source_id", box("lon").alias("lon0"), box("lat").alias("lat0"))


def box_area():
    return G.cell_area(F.col("lon0"), F.col("lon0") + 5.0, F.col("lat0"), F.col("lat0") + 5.0)


@query("sf_33", f"SELECT source_id, round({AREA} / CAST(1000000 AS DOUBLE), 3) AS area_km2 FROM ({BOXES})")
def sf_33(t):
    return boxes(t).select("source_id", r3(box_area() / F.lit(1e6)).alias("area_km2"))


@query(
    "sf_34",
    """
SELECT t.target_id, t."row", t.col, t.lon0, t.lon1, t.lat0, t.lat1, round(t.area / CAST(1000000 AS DOUBLE), 3) AS area_km2, coalesce(n, 0) AS n_obs
FROM target t LEFT JOIN (
  SELECT CAST(least(floor((90 - lat) / CAST(5 AS DOUBLE)), 35) * 72 + floor((lon + 180) / CAST(5 AS DOUBLE)) AS BIGINT) AS target_id, count(*) AS n
  FROM obs GROUP BY 1) o ON o.target_id = t.target_id
""",
)
def sf_34(t):
    """Regular grid of areas and edges with the observations that fall in each cell."""
    row = F.least(F.floor((90.0 - F.col("lat")) / 5.0), F.lit(35))
    hits = t.obs().groupBy((row * 72 + F.floor((F.col("lon") + 180.0) / 5.0)).cast("long").alias("target_id")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return regular_grid(t.spark, 5.0, 5.0).join(hits, "target_id", "left").select(
        "target_id", "row", "col", "lon0", "lon1", "lat0", "lat1",
        r3(F.col("area") / F.lit(1e6)).alias("area_km2"), big(F.coalesce("n", F.lit(0))).alias("n_obs"),
    )


@query(
    "sf_35",
    f"""
SELECT source_id, round(sqrt(a / pi()), 3) AS disc, round(CAST(0.5 AS DOUBLE) * sqrt(a), 3) AS half_side,
       round(CAST(0.5 AS DOUBLE) * sqrt(a) * sqrt(CAST(2 AS DOUBLE)), 3) AS half_diagonal,
       round(CAST(25000 AS DOUBLE) * sqrt(CAST(2 AS DOUBLE)), 3) AS polar_25km
FROM (SELECT source_id, {AREA} AS a FROM ({BOXES}))
""",
)
def sf_35(t):
    sized = boxes(t).select("source_id", box_area().alias("a"))
    methods = ("disc", "half_side", "half_diagonal", "polar_25km")
    return sized.select("source_id", *[r3(G.effective_radius(F.col("a"), m)).alias(m) for m in methods])


@query(
    "sf_36",
    """
SELECT source_id, round(cos(radians(abs(lat))) * (CAST(0.5 AS DOUBLE) * CAST(112000 AS DOUBLE)), 3) AS shortest, CAST(56000 AS DOUBLE) AS longest FROM obs
""",
)
def sf_36(t):
    s = t.obs().select("source_id", G.source_lengths(F.lit(0.5), F.abs("lat")).alias("s"))
    return s.select("source_id", r3("s.shortest").alias("shortest"), "s.longest")


@query(
    "sf_37",
    """
SELECT event_id, CAST(least(ceil(power(CAST(10000 AS DOUBLE) / (value + CAST(500 AS DOUBLE)), 2)), 100) AS BIGINT) AS cap FROM events
""",
)
def sf_37(t):
    cap = G.neighbour_cap(F.lit(5000.0), F.col("value") + 500.0, 100)
    return t.table("events").select("event_id", cap.alias("cap"))


@query(
    "sf_38",
    """
SELECT source_id, round(((x % 360) + 360) % 360 - 180, 6) AS lon FROM (SELECT source_id, lon + CAST(500 AS DOUBLE) - CAST(1000 AS DOUBLE) * (source_id % 2) + CAST(180 AS DOUBLE) AS x FROM obs)
""",
)
def sf_38(t):
    far = F.col("lon") + 500.0 - F.col("source_id") % 2 * F.lit(1000.0)
    return t.obs().select("source_id", r6(G.wrap_longitude(far)).alias("lon"))


@query(
    "sf_39",
    """
SELECT source_id, round(sqrt(dx * dx + dy * dy), 3) AS km FROM (
  SELECT source_id, CAST(111.1 AS DOUBLE) * cos(radians(CAST(28.4 AS DOUBLE)))
           * ((((lon + CAST(87.5 AS DOUBLE) + CAST(180 AS DOUBLE)) % 360) + 360) % 360 - 180) AS dx,
         CAST(111.1 AS DOUBLE) * (lat - CAST(28.4 AS DOUBLE)) AS dy FROM obs)
""",
)
def sf_39(t):
    return t.obs().select(
        "source_id", r3(G.planar_km(F.col("lon"), F.col("lat"), F.lit(-87.5), F.lit(28.4))).alias("km")
    )


@query(
    "sf_40",
    """
SELECT o.source_id, t.lon AS cell_lon, t.lat AS cell_lat, t.lon0, t.lon1, t.lat0, t.lat1
FROM obs o JOIN target t ON t.target_id = least(CAST(floor((90 - o.lat) / CAST(5 AS DOUBLE)) AS BIGINT), 35) * 72 + CAST(floor((o.lon + 180) / CAST(5 AS DOUBLE)) AS BIGINT)
""",
)
def sf_40(t):
    """Centres and half-resolution bounds of the regular cell every observation falls in."""
    row = F.least(F.floor((90.0 - F.col("lat")) / 5.0), F.lit(35))
    keyed = t.obs().select("source_id", (row * 72 + F.floor((F.col("lon") + 180.0) / 5.0)).cast("long").alias("target_id"))
    grid = regular_grid(t.spark, 5.0, 5.0).withColumnsRenamed({"lon": "cell_lon", "lat": "cell_lat"})
    return keyed.join(grid, "target_id").select("source_id", "cell_lon", "cell_lat", "lon0", "lon1", "lat0", "lat1")


@query(
    "sf_41",
    """
SELECT url, round(size_mb * CAST(1048576 AS DOUBLE), 1) AS size_bytes, round(size_mb * CAST(1048576 AS DOUBLE) / CAST(1073741824 AS DOUBLE), 3) AS size_gb FROM gran
""",
)
def sf_41(t):
    b = G.bytes_of(F.col("size_mb"))
    return t.granules().select("url", F.round(b, 1).alias("size_bytes"), G.gigabytes(b).alias("size_gb"))


@query(
    "sf_42",
    """
SELECT tile, j, i, CAST(CASE WHEN tile < 7 THEN tile * 90 + j WHEN tile < 10 THEN 630 + 3 * j + tile - 7 ELSE 900 + 3 * j + tile - 10 END AS BIGINT) AS "row",
       CAST(i AS BIGINT) AS col FROM cells
""",
)
def sf_42(t):
    spot = X.tile_to_compact(F.col("tile"), F.col("j"), F.col("i"), CELL_N)
    return t.cells().select("tile", "j", "i", spot.alias("s")).select("tile", "j", "i", "s.*")


FACE = """
SELECT tile, j, i, CAST(CASE WHEN tile < 3 THEN 1 WHEN tile < 6 THEN 2 WHEN tile < 7 THEN 3 WHEN tile < 10 THEN 4 ELSE 5 END AS BIGINT) AS face,
  CAST(CASE WHEN tile < 3 THEN tile * 90 + j WHEN tile < 6 THEN (tile - 3) * 90 + j ELSE j END AS BIGINT) AS "row",
  CAST(CASE WHEN tile < 7 THEN i WHEN tile < 10 THEN (tile - 7) * 90 + i ELSE (tile - 10) * 90 + i END AS BIGINT) AS col FROM cells
"""


@query("sf_43", FACE)
def sf_43(t):
    spot = X.tile_to_face(F.col("tile"), F.col("j"), F.col("i"), CELL_N)
    return t.cells().select("tile", "j", "i", spot.alias("s")).select("tile", "j", "i", "s.*")


@query(
    "sf_44",
    f"""
SELECT f.face, f."row" AS face_row, f.col AS face_col,
  CAST(CASE WHEN tile < 7 THEN tile * 90 + j WHEN tile < 10 THEN 630 + 3 * j + tile - 7 ELSE 900 + 3 * j + tile - 10 END AS BIGINT) AS "row",
  CAST(i AS BIGINT) AS col FROM ({FACE}) f
""",
)
def sf_44(t):
    faces = t.cells().select(X.tile_to_face(F.col("tile"), F.col("j"), F.col("i"), CELL_N).alias("f"))
    spot = X.face_to_compact(F.col("f.face"), F.col("f.row"), F.col("f.col"), CELL_N)
    return faces.select(
        "f.face", F.col("f.row").alias("face_row"), F.col("f.col").alias("face_col"), spot["row"].alias("row"), spot["col"].alias("col")
    )


@query(
    "sf_45",
    """
SELECT tile, j, i, CAST(CASE WHEN tile >= 7 THEN 89 - i ELSE j END AS BIGINT) AS "row",
       CAST(CASE WHEN tile >= 7 THEN j ELSE i + 90 END AS BIGINT) AS col FROM cells
""",
)
def sf_45(t):
    """Each tile as one half of a pair: rotated tiles turn upright on the left, upright ones sit right."""
    pair = X.unrotate_pair(F.col("tile"), F.col("j"), F.col("i"), F.greatest(F.col("tile"), F.lit(7)), CELL_N)
    return t.cells().select("tile", "j", "i", pair.alias("s")).select("tile", "j", "i", "s.*")


@query(
    "sf_46",
    """
SELECT s_suppkey, upper(s_name) AS "Title", n_name || '!' AS author, CAST(n_regionkey AS VARCHAR) AS "Zone", 'daily' AS cadence, CAST(4 AS BIGINT) AS size
FROM meta
""",
)
def sf_46(t):
    patch = {"Title": F.upper, "author": lambda old: F.concat(old, F.lit("!")), "date": None, "cadence": "daily", "absent": None}
    m = t.metadata().select("s_suppkey", A.patch_attributes(F.col("attrs"), patch).alias("m"))
    names = ("Title", "author", "Zone", "cadence")
    return m.select("s_suppkey", *[F.col("m")[n].alias(n) for n in names], big(F.size("m")).alias("size"))


@query(
    "sf_48",
    """
SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'XC YC time' WHEN 1 THEN 'time' ELSE 'XG time' END AS coordinates FROM meta
""",
)
def sf_48(t):
    own = F.when(F.col("s_suppkey") % 3 == 0, F.array(F.lit("time"), F.lit("YC"), F.lit("XC"), F.lit("odd"))).when(
        F.col("s_suppkey") % 3 == 1, F.array(F.lit("time"))
    ).otherwise(F.array(F.lit("time"), F.lit("XG")))
    return t.metadata().select("s_suppkey", A.coordinates_attribute(own, ["time", "XC", "YC", "XG", "YG"]).alias("coordinates"))


@query(
    "sf_49",
    """
SELECT dataset, var, "month", round(CAST(CAST(valid_min * CAST(0.5 AS DOUBLE) AS FLOAT) AS DOUBLE), 3) AS low,
       round(CAST(CAST(valid_max * CAST(0.5 AS DOUBLE) AS FLOAT) AS DOUBLE), 3) AS high FROM qc
""",
)
def sf_49(t):
    s = t.stored_ranges().select("dataset", "var", "month", A.scaled_range(F.col("valid_min"), F.col("valid_max"), 0.5).alias("s"))
    return s.select("dataset", "var", "month", r3(F.col("s.low").cast("double")).alias("low"), r3(F.col("s.high").cast("double")).alias("high"))


@query("sf_50", "SELECT var, loc, min(value) AS valid_min, max(value) AS valid_max FROM field GROUP BY var, loc")
def sf_50(t):
    from ..operators.aggregate import value_range

    return value_range(t.field(), ["var", "loc"])


@query(
    "sf_51",
    """
SELECT s_suppkey, concat_ws(' ', summary, CASE WHEN s_suppkey % 2 = 0 THEN 'Group note.' END) AS comment, 'Fixed reference' AS "references" FROM meta
""",
)
def sf_51(t):
    note = F.when(F.col("s_suppkey") % 2 == 0, F.lit("Group note."))
    return t.metadata().select(
        "s_suppkey", A.appended_comment(F.col("summary"), note).alias("comment"),
        A.patch_attributes(F.col("attrs"), {"references": "Fixed reference"})["references"].alias("references"),
    )


@query("sf_52", "SELECT event_id, event_id % 100 < 5 AS checked FROM events")
def sf_52(t):
    from ..plans.quality import in_sample

    return t.table("events").select("event_id", in_sample(F.col("event_id"), 0.05).alias("checked"))

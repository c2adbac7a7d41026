"""Whole jobs: listings, searches, subsets, products, quality and regions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregate as A
from ..operators import windows as W
from ..plans import catalogue as C
from ..plans import granule_query as GQ
from ..plans import grids as GR
from ..plans import products as P
from ..plans import quality as Q
from ..plans import region as RG
from ..plans import subset as SB
from ..sources.derived import CELL_N
from ..session import stored
from ..sources.varlist import parse_varlist
from .ordering import SEARCH_SQL
from .registry import query
from .selecting import field_cols
from .text import big, day, r3, r6, r7, stamp
from .varlists import PARSED_SQL, varlist_lines

LONGEST = 800000.0


@query(
    "p_1",
    """
WITH rng AS (SELECT *, CASE WHEN short_name LIKE '%SNAPSHOT%' THEN DATE '2000-12-01' ELSE DATE '2000-11-30' END AS hi FROM gran),
found AS (SELECT * FROM rng WHERE gdate >= DATE '1996-02-01' AND gdate <= hi),
per AS (SELECT short_name, count(*) AS n, min(url) AS tpl, max(size_mb) AS mx, max(hi) AS hi FROM found GROUP BY short_name),
plan AS (SELECT *, CASE WHEN short_name LIKE '%MONTHLY%' THEN generate_series(TIMESTAMP '1996-02-01', TIMESTAMP '2000-11-01', INTERVAL 1 MONTH)
                   ELSE generate_series(TIMESTAMP '1996-02-01', CAST(hi AS TIMESTAMP), INTERVAL 1 DAY) END AS dates FROM per),
exp AS (SELECT short_name, mx, tpl, unnest(dates) AS d FROM plan WHERE n < len(dates)),
filled AS (SELECT short_name, mx, CAST(d AS DATE) AS gdate, replace(tpl, '_' || string_split(tpl, '_')[-5] || '_',
             '_' || (CASE WHEN short_name LIKE '%MONTHLY%' THEN strftime(d, '%Y-%m') ELSE strftime(d, '%Y-%m-%d') END) || '_') AS url FROM exp),
listed AS (SELECT f.short_name, f.url, f.gdate, CASE WHEN g.size_mb >= f.mx * CAST(0.1 AS DOUBLE) THEN g.size_mb ELSE f.mx END AS size_mb, g.size_mb IS NULL AS filled
           FROM filled f LEFT JOIN found g ON g.url = f.url
           UNION ALL SELECT short_name, url, gdate, size_mb, false FROM found WHERE short_name IN (SELECT short_name FROM plan WHERE n >= len(dates))),
b AS (SELECT *, CASE WHEN size_mb * 1048576 > 1024 THEN size_mb * CAST(1048576 AS DOUBLE) END AS kb FROM listed),
m AS (SELECT short_name, avg(kb) AS mean FROM b GROUP BY short_name)
SELECT url, strftime(gdate, '%Y-%m-%d') AS gdate, filled, round(coalesce(kb, mean), 1) AS size_bytes FROM b JOIN m USING (short_name)
WHERE short_name NOT LIKE '%SNAPSHOT%' OR day(gdate) = 1
""",
)
def p_1(t):
    listing = stored(t.granules(), "granules")
    out = GQ.granule_query(listing, "1996-02", "2000-11", interval="monthly")
    return out.select("url", day("gdate").alias("gdate"), "filled", F.round("size_bytes", 1).alias("size_bytes"))


@query(
    "p_2",
    f"""
WITH parsed AS ({PARSED_SQL}),
listed AS (SELECT 'mixed,all' AS section, short_name, note, var, description, 0 AS source_order, line_no AS entry_id FROM parsed)
SELECT short_name, exact, position FROM ({SEARCH_SQL.format(q='Ocean', where="note IS NULL OR note NOT LIKE '%*%' OR contains(note, 'native')").replace('FROM cat', 'FROM listed')})
""",
)
def p_2(t):
    """Lists are parsed, sources merged, and the native sections searched for a word."""
    parsed = parse_varlist(varlist_lines(t), "DS_L4_", block_rows=256)
    catalogue = parsed.select(
        F.lit(C.MIXED_SECTION).alias("section"), "short_name", "note", "var", "description", F.lit(0).alias("source_order"), big("line_no").alias("entry_id")
    )
    return C.search(C.merged(catalogue), "Ocean", grid="native")


@query(
    "p_3",
    """
SELECT dataset, strftime("time", '%Y-%m-%d %H:%M:%S') AS "time", k, tile, j, i, var, value FROM field
WHERE var <> 'V1' AND tile >= 1 AND tile <= 12 AND (tile - 1) % 2 = 0 AND i < 4
  AND ((dataset = 'DS_0' AND (month("time") = 1 OR CAST("time" AS DATE) = DATE '2000-02-29')) OR (dataset = 'DS_1' AND day("time") = 1 AND month("time") <= 2))
""",
)
def p_3(t):
    """One daily and one monthly dataset, asked for a month and a day."""
    field = t.field()
    datasets = field.select("dataset").distinct().withColumn(
        "resolution", F.when(F.col("dataset") == "DS_0", "DAILY").otherwise("MONTHLY")
    )
    out = SB.subset(
        field, datasets, omit=["V1"], times=["2000-01", "2000-02-29"],
        slices={"tile": (1, 13, 2), "i": (0, 4, 1)}, bounds={"tile": (0, 12), "i": (0, 4)},
    )
    return out.select(*field_cols(), "value")


@query(
    "p_4",
    """
WITH f AS (SELECT *, CASE dataset WHEN 'DS_0' THEN 'DS_L4_PRICE_LLC0090GRID_DAILY_V1' ELSE 'DS_L4_PRICE_LLC0090GRID_SNAPSHOT_V1' END AS short_name FROM field),
asked AS (SELECT 'all' AS asked, * FROM f WHERE CAST("time" AS DATE) BETWEEN DATE '2000-01-10' AND CASE dataset WHEN 'DS_0' THEN DATE '2000-03-15' ELSE DATE '2000-03-16' END
          UNION ALL SELECT 'snapshot', * FROM f WHERE dataset = 'DS_1' AND CAST("time" AS DATE) IN (DATE '2000-02-01', DATE '2000-03-01'))
SELECT asked, short_name, strftime("time", '%Y-%m-%d %H:%M:%S') AS "time", k, tile, j, i, var, value FROM asked
""",
)
def p_4(t):
    """Two datasets searched, listed with gaps filled and opened: all of them, and the snapshots alone, then by month.

    The listing lacks every fifth day of a month, which the field has.
    """
    name = F.concat(F.lit("DS_L4_PRICE_LLC0090GRID_"), F.when(F.col("dataset") == "DS_0", "DAILY").otherwise("SNAPSHOT"), F.lit("_V1"))
    field = t.field().withColumn("short_name", name)
    period = F.when(F.col("dataset") == "DS_0", "day_mean").otherwise("snap")
    listing = field.groupBy("short_name", period.alias("period"), F.to_date("time").alias("gdate")).agg(
        (F.count(F.lit(1)) / F.lit(10.0)).alias("size_mb")
    ).filter(F.dayofmonth("gdate") % 5 != 0).select(
        "*",
        F.concat(F.lit("https://h/"), "short_name", F.lit("/"), F.concat_ws("_", F.lit("PRICE"), "period", day("gdate"), F.lit("MODEL_V1_native_g.nc"))).alias("url"),
        F.col("gdate").cast("timestamp").alias("time_start"),
    )
    kind = F.when(F.contains("short_name", F.lit("DAILY")), "native,daily").otherwise("native,snapshot")
    catalogue = field.groupBy("short_name", "var").agg(F.count(F.lit(1)).alias("entry_id")).select(
        kind.alias("section"), "short_name", F.lit(None).cast("string").alias("note"), "var",
        F.concat(F.lit("Variable of part group "), "var").alias("description"), "entry_id",
    )
    opened = None
    for time_res in ("all", "snapshot"):
        _, rows = SB.access_dataset(field, listing, catalogue, "PART GROUP", "2000-01-10", "2000-03-15", "native", time_res)
        rows = rows.withColumn("asked", F.lit(time_res))
        opened = rows if opened is None else opened.unionByName(rows)
    return opened.select("asked", "short_name", *field_cols()[1:], "value")


@query(
    "p_5",
    """
WITH o AS (SELECT *, CAST(ts AS DATE) AS d, day(ts) AS dd, CASE WHEN day(ts) % 3 = 0 THEN 0 ELSE source_id % 2 END AS version FROM near
           WHERE var IN ('click', 'view') AND day(ts) % 5 <> 0),
last AS (SELECT d, max(version) AS version FROM (SELECT CAST(ts AS DATE) AS d, CASE WHEN day(ts) % 3 = 0 THEN 0 ELSE source_id % 2 END AS version FROM obs
           WHERE var = 'click' AND day(ts) % 5 <> 0) GROUP BY d),
fed AS (SELECT target_id, o.d, dist, source_id, radius, CASE WHEN dd % 8 <> 0 AND value - 20 >= 0 THEN value - 20 END AS value
        FROM o JOIN last ON last.d = o.d AND last.version = o.version WHERE var = 'click'),
i AS (SELECT target_id, d, count(*) AS n, CASE WHEN count(value) = count(*) THEN avg(value) END AS v FROM fed
      WHERE dist <= radius AND dist <= (SELECT floor(max(radius)) FROM target) GROUP BY ALL),
c AS (SELECT target_id, d, value FROM (SELECT *, row_number() OVER (PARTITION BY target_id, d ORDER BY dist, source_id) AS rn FROM fed WHERE dist <= CAST(400000 AS DOUBLE)) WHERE rn = 1),
mapped AS (SELECT c.target_id, c.d, CASE WHEN i.n > 0 THEN i.v ELSE c.value END AS value FROM c LEFT JOIN i USING (target_id, d)),
days AS (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-05', INTERVAL 1 DAY)) AS DATE) AS d),
rec AS (SELECT days.d, coalesce('click_' || strftime(days.d, '%Y%m%d') || '_v' || version || '.nc', '') AS path,
               CASE WHEN version IS NULL THEN 'file not found' WHEN coalesce(n, 0) = 0 THEN 'empty record' ELSE '' END AS notes,
               CASE WHEN version IS NULL THEN CAST(days.d + INTERVAL 1 DAY AS TIMESTAMP) ELSE days.d + INTERVAL 23 HOUR END AS time_end
        FROM days LEFT JOIN last USING (d)
        LEFT JOIN (SELECT CAST(ts AS DATE) AS d, CASE WHEN day(ts) % 3 = 0 THEN 0 ELSE source_id % 2 END AS version,
                          count(CASE WHEN day(ts) % 8 <> 0 AND value - 20 >= 0 THEN 1 END) AS n FROM obs WHERE var = 'click' GROUP BY ALL) v USING (d, version))
SELECT strftime(rec.d, '%Y-%m-%d') AS "date", t.target_id, round(coalesce(m.value, CAST(-1 AS DOUBLE)), 7) AS value, path, notes,
       strftime(rec.d, '%Y-%m-%d %H:%M:%S') AS time_start, strftime(time_end, '%Y-%m-%d %H:%M:%S') AS time_end
FROM target t CROSS JOIN rec LEFT JOIN mapped m ON m.target_id = t.target_id AND m.d = rec.d
""",
)
def p_5(t):
    """Files of one kind of event, one or two a day: days without a file, with an older version only, and with nothing valid."""
    dom = F.dayofmonth("ts")
    version = F.when(dom % 3 == 0, 0).otherwise((F.col("source_id") % 2).cast("int"))
    path = F.concat("var", F.lit("_"), F.date_format("ts", "yyyyMMdd"), F.lit("_v"), version.cast("string"), F.lit(".nc"))
    obs = t.obs().filter(F.col("var").isin("click", "view") & (dom % 5 != 0)).withColumns(
        {"path": path, "value": F.when(dom % 8 != 0, F.col("value") - F.lit(20.0))}
    )
    stamped = lambda c, p: F.date_format(c, p).alias
    files = obs.groupBy("path", F.to_date("ts").alias("_d")).agg(F.count(F.lit(1)).alias("n_rows")).select(
        "path", stamped("_d", "yyyy-MM-dd'T00:00:00Z'")("time_coverage_start"), stamped("_d", "yyyy-MM-dd'T23:00:00Z'")("time_coverage_end")
    )
    values, records = P.observation_year(
        obs, files, t.target(), 2024, 400000.0, "zone", transforms=["remove_negative"], default=-1.0, hemisphere="click"
    )
    out = values.filter(F.col("date") <= "2024-02-05").join(records, "date")
    return out.select(
        day("date").alias("date"), "target_id", r7("value").alias("value"), "path", "notes",
        stamp("time_start").alias("time_start"), stamp("time_end").alias("time_end"),
    )


@query(
    "p_6",
    """
WITH kept AS (SELECT * FROM field f WHERE EXISTS (SELECT 1 FROM field g WHERE g."time" = f."time" AND g.dataset = f.dataset AND g.value IS NOT NULL)),
m AS (SELECT date_trunc('month', "time") AS "month", dataset, k, tile, j, i, var, avg(value) AS value FROM kept GROUP BY ALL),
w AS (SELECT * FROM m WHERE "month" IN (SELECT "month" FROM m WHERE value IS NOT NULL))
SELECT dataset, k, tile, j, i, var, round(coalesce(value, CAST(-9999 AS DOUBLE)), 7) AS value, strftime("month", '%Y-%m-%d %H:%M:%S') AS time_start,
       strftime("month" + INTERVAL 1 MONTH, '%Y-%m-%d %H:%M:%S') AS time_end,
       strftime(make_timestamp((epoch_us(CAST("month" AS TIMESTAMP)) + epoch_us(CAST("month" + INTERVAL 1 MONTH AS TIMESTAMP))) // 2), '%Y-%m-%d %H:%M:%S') AS "time", 'P1M' AS duration
FROM w
""",
)
def p_6(t):
    keys = ["dataset", "k", "tile", "j", "i", "var"]
    out = P.monthly_product(t.field(), keys, True, True, ["dataset", "time"], -9999.0)
    return out.select(*keys, r7("value").alias("value"), stamp("time_start").alias("time_start"), stamp("time_end").alias("time_end"), stamp("time").alias("time"), "duration")


@query(
    "p_7",
    """
WITH rec AS MATERIALIZED (SELECT CAST("time" AS DATE) AS d, k, tile, j, i, max(value) AS value FROM field GROUP BY ALL),
days AS (SELECT CAST(unnest(generate_series(TIMESTAMP '1999-12-25', TIMESTAMP '2000-04-10', INTERVAL 1 DAY)) AS DATE) AS d),
dense AS (SELECT days.d, g.k, g.tile, g.j, g.i, rec.value FROM gridmask g CROSS JOIN days
          LEFT JOIN rec ON rec.d = days.d AND rec.k = g.k AND rec.tile = g.tile AND rec.j = g.j AND rec.i = g.i)
SELECT strftime(d, '%Y-%m-%d') AS "date", k, tile, j, i, value FROM dense WHERE d IN (SELECT d FROM rec WHERE value IS NOT NULL)
""",
)
def p_7(t):
    cell = ["k", "tile", "j", "i"]
    records = t.field().groupBy(F.to_date("time").alias("date"), *cell).agg(F.max("value").alias("value"))
    out = P.merged_records(records, t.mask(), cell, "1999-12-25", "2000-04-10", drop_empty_days=True)
    return out.select(day("date").alias("date"), *cell, "value")


def product_rows(product, ranges, record, coords, names):
    """A product beside the ranges of its records: rounded columns, stamped times."""
    lows = ranges.groupBy(*record).pivot("var", names).agg(F.first("valid_min").alias("min"), F.first("valid_max").alias("max"))
    two = lambda c: F.round(F.col(c).cast("double"), 2).alias(c)
    values = [two(f"{n}{part}") for n in names for part in ("", "_min", "_max")]
    return product.join(lows, record).select(*[stamp(c).alias(c) for c in ("time_start", "time", "time_end")], *coords, *values)


def product_sql(values, names, record, coords, start, also=""):
    """SQL of the same rows from (..., time_end, var, value); `start` is the record's start before the limits of the run."""
    cols = ", ".join(f"max(value) FILTER (var = '{n}') AS \"{n}\"" for n in names)
    two = lambda e, n: f'round(CAST({e} AS DOUBLE), 2) AS "{n}"'
    over = f"OVER (PARTITION BY {', '.join(record)})"
    shown = ", ".join(
        x for n in names for x in (two(f'"{n}"', n), two(f'min("{n}") {over}', f"{n}_min"), two(f'max("{n}") {over}', f"{n}_max"))
    )
    return f"""
WITH v AS ({values}),
w AS (SELECT {', '.join(record + [c for c in coords if c not in record])}, {cols} FROM v GROUP BY ALL),
late AS (SELECT *, CASE WHEN {start} < time_end AND CAST(time_end AS DATE) = DATE '2000-03-31' THEN {start} + INTERVAL 12 HOUR ELSE {start} END AS s1 FROM w),
b AS (SELECT *, CASE WHEN s1 < time_end AND CAST(s1 AS DATE) = DATE '2000-01-01' THEN TIMESTAMP '2000-01-01 12:00:00' ELSE CAST(s1 AS TIMESTAMP) END AS time_start FROM late)
SELECT strftime(time_start, '%Y-%m-%d %H:%M:%S') AS time_start, strftime(make_timestamp((epoch_us(time_start) + epoch_us(time_end)) // 2), '%Y-%m-%d %H:%M:%S') AS "time",
       strftime(time_end, '%Y-%m-%d %H:%M:%S') AS time_end, {', '.join(coords)}{also}, {shown}
FROM b
"""


MONTHLY = """SELECT CAST(date_trunc('month', "time") + INTERVAL 1 MONTH - INTERVAL 1 DAY AS TIMESTAMP) AS time_end, k, tile, j, i, var, avg(value) AS value FROM field GROUP BY ALL"""
RUN = ("2000-01-01 12:00:00", "2000-03-31 00:00:00")


@query(
    "p_8",
    product_sql(
        f"""SELECT p.target_id, p.k, p.time_end, p.var, CAST(CASE WHEN l.wet THEN p.value END AS FLOAT) AS value
FROM (SELECT e.target_id, e.k, m.time_end, m.var, CASE WHEN count(m.value) = count(*) THEN avg(m.value) END AS value
      FROM celledges e JOIN ({MONTHLY}) m ON m.k = e.k AND m.tile * 25 + m.j * 5 + m.i = e.source_id GROUP BY ALL) p LEFT JOIN landmask l USING (target_id, k)""",
        ["V0", "V1", "V2"], ["time_end"], ["target_id", "k"], "time_end - INTERVAL 1 MONTH",
    ).replace("FROM b\n", "FROM b JOIN target USING (target_id)\n").replace("target_id, k, round", "target_id, k, lon0, lon1, lat0, lat1, round"),
)
def p_8(t):
    """Monthly means whose records end with the last day of the month."""
    months = A.monthly_mean(t.field(), ["k", "tile", "j", "i", "var"])
    ended = months.withColumn("time_end", F.last_day("month").cast("timestamp"))
    names = ["V0", "V1", "V2"]
    product, ranges = P.latlon_product(ended, t.native_grid(), t.target(), LONGEST, names, F.lit("AVG_MON"), *RUN)
    return product_rows(product, ranges, ["time_end"], ["target_id", "k", "lon0", "lon1", "lat0", "lat1"], names)


@query(
    "p_9",
    product_sql(
        """SELECT f.dataset, f."time" AS time_end, k, tile, j, i, CASE var WHEN 'V0' THEN 'SSH' WHEN 'V2' THEN 'SALT' ELSE var END AS var,
  CAST(CASE WHEN CASE loc WHEN 'c' THEN maskc WHEN 'w' THEN maskw ELSE masks END THEN value END AS FLOAT) AS value
FROM dayfield f JOIN gridmask USING (k, tile, j, i)""",
        ["SSH", "V1", "SALT"], ["dataset", "time_end"], ["dataset", "k", "tile", "j", "i"],
        "(CASE dataset WHEN 'DS_0' THEN time_end - INTERVAL 1 DAY ELSE time_end END)",
    ),
)
def p_9(t):
    """One dataset of daily means and one of snapshots, by days."""
    names = ["SSH", "V1", "SALT"]
    code = F.when(F.col("dataset") == "DS_0", "AVG_DAY").otherwise("SNAPSHOT")
    product, ranges = P.native_product(t.daily(), t.mask(), "V0:SSH,V2:SALT", names, code, *RUN)
    return product_rows(product, ranges, ["dataset", "time_end"], ["dataset", "k", "tile", "j", "i"], names)


@query(
    "p_10",
    """
WITH h AS (SELECT "time", var, CASE WHEN row_number() OVER (PARTITION BY var ORDER BY "time") > CASE WHEN var = 'view' THEN 2 ELSE 1 END THEN value END AS value FROM series),
a AS (SELECT "time", var, value - avg(value) OVER (PARTITION BY var) AS value FROM h),
d AS (SELECT date_trunc('day', "time") AS "time", var, avg(value) AS value FROM a GROUP BY ALL),
w AS (SELECT "time", max(value) FILTER (var = 'view') AS v, max(value) FILTER (var = 'click') AS c, max(value) FILTER (var = 'error') AS e FROM d GROUP BY "time")
SELECT strftime("time", '%Y-%m-%d') AS "day", round(v, 4) AS total, round(c + e, 4) AS term_sum, round(v - (c + e), 4) AS residual FROM w
""",
)
def p_10(t):
    hide = F.when(F.col("var") == "view", 2).otherwise(1)
    out = P.series_product(t.series(), hide, "view", ["click", "error"])
    four = lambda c, n: F.round(c, 4).alias(n)
    return out.select(day("time").alias("day"), four("view", "total"), four("term_sum", "term_sum"), four("residual", "residual"))


ALL_EDGES = """
SELECT target_id, k, hfac FROM nearcell WHERE dist <= radius AND dist <= (SELECT floor(max(radius)) FROM target)
UNION ALL
SELECT target_id, k, hfac FROM (
  SELECT *, row_number() OVER (PARTITION BY target_id, k ORDER BY dist, source_id) AS rn,
         count_if(dist <= radius AND dist <= (SELECT floor(max(radius)) FROM target)) OVER (PARTITION BY target_id, k) AS n_in
  FROM nearcell) WHERE rn = 1 AND n_in = 0
"""


@query(
    "p_11",
    f"""
WITH layer AS (SELECT k, avg(dr) AS dr FROM layers GROUP BY k),
bound AS (SELECT k, dr, -sum(dr) OVER (ORDER BY k) AS zl FROM layer),
f AS (SELECT target_id, k, avg(hfac) AS hfac FROM ({ALL_EDGES}) GROUP BY ALL)
SELECT f.target_id, f.k, round(f.hfac, 6) AS hfac, l.wet AS mask, round(area / CAST(1000000 AS DOUBLE), 3) AS area_km2, round(b.dr, 6) AS dr,
       round(b.zl, 6) AS zl, round(f.hfac * b.dr, 6) AS depth
FROM f JOIN target USING (target_id) LEFT JOIN landmask l USING (target_id, k) LEFT JOIN bound b ON b.k = f.k
""",
)
def p_11(t):
    layer = t.layers().groupBy("k").agg(F.avg("dr").alias("dr"))
    bounds = W.depth_bounds(layer.withColumn("profile", F.lit(0)), ["profile"])
    out = P.geometry_product(t.native_grid(), t.target(), bounds, LONGEST)
    return out.select(
        "target_id", F.col("k").cast("int").alias("k"), r6("hfac").alias("hfac"), "mask", r3(F.col("area") / F.lit(1e6)).alias("area_km2"), r6("dr").alias("dr"), r6("zl").alias("zl"), r6("depth").alias("depth")
    )


@query(
    "p_12",
    """
WITH m AS (SELECT k, tile, j, i, var, avg(value) AS value FROM field GROUP BY ALL),
p AS (SELECT e.target_id, e.k, m.var, CASE WHEN count(m.value) = count(*) THEN avg(m.value) END AS value
      FROM celledges e JOIN m ON m.k = e.k AND m.tile * 25 + m.j * 5 + m.i = e.source_id GROUP BY ALL),
x AS (SELECT p.target_id, p.k, p.var, CAST(CASE WHEN l.wet THEN p.value END AS FLOAT) AS value FROM p LEFT JOIN landmask l USING (target_id, k))
SELECT x.target_id, x.k, x.var, round(CAST(x.value AS DOUBLE), 2) AS value, round(CAST(r.lo AS DOUBLE), 2) AS valid_min, round(CAST(r.hi AS DOUBLE), 2) AS valid_max
FROM x JOIN (SELECT var, min(value) AS lo, max(value) AS hi FROM x GROUP BY var) r USING (var)
""",
)
def p_12(t):
    product, ranges = P.mixing_product(t.field(), t.native_grid(), t.target(), LONGEST)
    two = lambda c: F.round(F.col(c).cast("double"), 2).alias(c)
    return product.join(ranges, "var").select("target_id", "k", "var", two("value"), two("valid_min"), two("valid_max"))


@query(
    "p_13",
    """
WITH n AS (SELECT dataset, var, CAST(CAST(min(value) AS FLOAT) AS DOUBLE) AS lo, CAST(CAST(max(value) AS FLOAT) AS DOUBLE) AS hi FROM field GROUP BY dataset, var)
SELECT q.dataset, q.var, q.file, CAST(CASE WHEN q.valid_min = lo AND q.valid_max = hi THEN 0 ELSE 1 END AS BIGINT) AS status,
       round(lo, 3) AS valid_min, round(hi, 3) AS valid_max, round(e.emin, 3) AS easy_min, round(e.emax, 3) AS easy_max
FROM qc q JOIN n USING (dataset, var) JOIN (SELECT dataset, var, min(valid_min) AS emin, max(valid_max) AS emax FROM qc GROUP BY dataset, var) e USING (dataset, var)
""",
)
def p_13(t):
    """Ranges from values replace the stored ones; the stored ranges' own range is set beside them."""
    keys = ["dataset", "var"]
    stored = t.stored_ranges()
    hard = Q.calculate_ranges(t.field(), keys, "hard")
    easy = Q.calculate_ranges(stored, keys, "easy").withColumnsRenamed({"valid_min": "easy_min", "valid_max": "easy_max"})
    out = Q.correct_ranges(stored, hard, keys, factor=1.0, bits=32).join(easy, keys)
    three = lambda c: F.round(F.col(c).cast("double"), 3).alias(c)
    return out.select(*keys, "file", "status", *[three(c) for c in ("valid_min", "valid_max", "easy_min", "easy_max")])


@query(
    "p_14",
    """
WITH a AS (SELECT dataset, var, min(value) AS lo, max(value) AS hi FROM field GROUP BY dataset, var),
u AS (SELECT dataset, var, "month", valid_min AS omin, valid_max AS omax FROM qc),
n AS (SELECT dataset, var, min(omin) AS nmin, max(omax) AS nmax FROM u WHERE "month" > '2000-01' GROUP BY dataset, var),
x AS (SELECT u.dataset, bool_or(nmin > lo OR nmax < hi) AS bad, bool_or(omin <> nmin OR omax <> nmax) AS changed FROM u JOIN a USING (dataset, var) JOIN n USING (dataset, var) GROUP BY u.dataset),
h AS (SELECT m.*, 'DS_' || (s_suppkey % 3) AS dataset, CASE WHEN fix_title IS NULL OR fix_title <> title THEN -1
         WHEN string_split(link, 'ShortName=')[2] <> fix_short_name OR summary <> fix_summary THEN 1 ELSE 0 END AS st FROM meta m LEFT JOIN repairs USING (id)),
g AS (SELECT s_suppkey, s_name, n_name, n_regionkey, h.dataset, CAST(CASE WHEN st = -1 OR changed IS NULL OR bad THEN -1 WHEN st = 1 OR changed OR s_suppkey % 3 = 1 OR s_suppkey % 5 = 2 THEN 1 ELSE 0 END AS BIGINT) AS status
FROM h LEFT JOIN x ON x.dataset = h.dataset)
SELECT 'granule' AS part, 'DS_' || s_suppkey AS name, status, CAST(NULL AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS valid_min, CAST(NULL AS DOUBLE) AS valid_max,
       CASE WHEN status = -1 THEN 'Title=' || s_name || ';author=' || n_name || ';Zone=' || n_regionkey || ';date=2000-01-01'
            ELSE 'author=' || n_name || ';references=R1;Title=' || s_name || ';Zone=' || n_regionkey END AS attrs FROM g
UNION ALL SELECT 'range', q.dataset || q."month" || q.var, CAST(CASE WHEN omin = nmin AND omax = nmax THEN 0 ELSE 1 END AS BIGINT), NULL, round(nmin, 6), round(nmax, 6), NULL
FROM u q JOIN n USING (dataset, var)
UNION ALL SELECT 'summary', 'status', status, count(*), NULL, NULL, NULL FROM g GROUP BY status
""",
)
def p_14(t):
    key = F.col("s_suppkey")
    unit = F.when(key % 5 == 2, "degC").otherwise("degree_K")
    granules = t.metadata().withColumns(
        {
            "dataset": F.concat(F.lit("DS_"), key % 3),
            "file_id": key,
            "units": F.create_map(F.concat(F.lit("V"), key % 3), F.lit("m"), F.lit("Tair"), unit),
        }
    )
    actual = A.value_range(t.field(), ["dataset", "var"])
    stored_rows = t.stored_ranges()
    new = A.stored_range(stored_rows.filter(F.col("month") > "2000-01"), ["dataset", "var"])
    fixed, ranges, summary = Q.repair_job(
        granules, t.repairs(), stored_rows, actual, new, comment_fixes=["V1", "absent"], unit_fixes={"Tair": "degree_K"},
        patch={"references": "R1", "date": None},
    )
    none = lambda kind: F.lit(None).cast(kind)
    text = F.array_join(F.transform("attrs", lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    parts = (
        (fixed, "granule", F.concat(F.lit("DS_"), "s_suppkey"), none("long"), none("double"), none("double"), text),
        (ranges, "range", F.concat("dataset", F.regexp_extract("file", r"(\d{4}-\d{2})\.nc", 1), "var"), none("long"), r6("valid_min"), r6("valid_max"), none("string")),
        (summary, "summary", F.lit("status"), F.col("n"), none("double"), none("double"), none("string")),
    )
    out = None
    for df, part, name, n, low, high, attrs in parts:
        rows = df.select(
            F.lit(part).alias("part"), name.alias("name"), "status", n.alias("n"), low.alias("valid_min"), high.alias("valid_max"), attrs.alias("attrs")
        )
        out = rows if out is None else out.unionByName(rows)
    return out


REGION_BOX = (-85.5, 60.0, -170.15, 130.15)


@query(
    "p_15",
    """
WITH box AS (SELECT * FROM cells WHERE yc BETWEEN CAST(-85.5 AS DOUBLE) AND CAST(60 AS DOUBLE)
   AND (((xc + CAST(170.15 AS DOUBLE) - CAST(0.00001 AS DOUBLE)) % 360) + 360) % 360 <= CAST(300.29999 AS DOUBLE) AND tile IN (10, 2)),
v AS (SELECT l_partkey % 13 AS tile, l_suppkey % 90 AS j, l_orderkey % 90 AS i, l_returnflag AS var, l_extendedprice AS value FROM lineitem)
SELECT var, CAST(CASE WHEN tile = 10 THEN 89 - i ELSE j END AS BIGINT) AS "row", CAST(CASE WHEN tile = 10 THEN j ELSE i + 90 END AS BIGINT) AS col, round(avg(value), 7) AS value
FROM v SEMI JOIN box ON box.tile = v.tile AND box.j = v.j AND box.i = v.i GROUP BY tile, j, i, var
""",
)
def p_15(t):
    """Mean price per return flag on two neighbouring tiles inside a box, turned into one frame."""
    field = t.table("lineitem").select(
        (F.col("l_partkey") % 13).cast("int").alias("tile"), (F.col("l_suppkey") % CELL_N).cast("int").alias("j"),
        (F.col("l_orderkey") % CELL_N).cast("int").alias("i"), F.col("l_returnflag").alias("var"), F.col("l_extendedprice").alias("value"),
    )
    out = RG.region_map(field, t.cells(), REGION_BOX, rotated_tile=10, upright_tile=2, n=CELL_N)
    return out.withColumn("value", r7("value"))


@query(
    "p_16",
    """
WITH p AS (SELECT * FROM (VALUES ('gulf', CAST(-87.5 AS DOUBLE), CAST(28.4 AS DOUBLE)), ('dateline', CAST(179.9 AS DOUBLE), CAST(-10 AS DOUBLE)),
                                 ('north', CAST(10 AS DOUBLE), CAST(88 AS DOUBLE))) v(point, plon, plat)),
d AS (SELECT point, tile, j, i, CAST(111.1 AS DOUBLE) * cos(radians(plat)) * ((((xc - plon + 180) % 360) + 360) % 360 - 180) AS dx,
             CAST(111.1 AS DOUBLE) * (yc - plat) AS dy FROM p CROSS JOIN cells),
n AS (SELECT point, tile, j, i FROM (SELECT *, row_number() OVER (PARTITION BY point ORDER BY sqrt(dx * dx + dy * dy), tile, j, i) AS rn FROM d) WHERE rn = 1),
v AS (SELECT l_partkey % 13 AS tile, l_suppkey % 90 AS j, l_orderkey % 90 AS i, l_shipdate AS "time", max(l_extendedprice) AS value FROM lineitem GROUP BY ALL)
SELECT point, CAST(n.tile AS INTEGER) AS tile, CAST(n.j AS INTEGER) AS j, CAST(n.i AS INTEGER) AS i, strftime("time", '%Y-%m-%d') AS "time", value,
       strftime(DATE '2004-08-01' + CAST(datediff('day', make_date(year("time"), 8, 1), CAST("time" AS DATE)) AS INTEGER), '%Y-%m-%d') AS axis_day
FROM v JOIN n USING (tile, j, i)
""",
)
def p_16(t):
    from .joining import POINTS

    field = t.table("lineitem").groupBy(
        (F.col("l_partkey") % 13).cast("int").alias("tile"), (F.col("l_suppkey") % CELL_N).cast("int").alias("j"),
        (F.col("l_orderkey") % CELL_N).cast("int").alias("i"), F.col("l_shipdate").alias("time"),
    ).agg(F.max("l_extendedprice").alias("value"))
    out = RG.point_series(field, t.cells(), POINTS, 8, 1, 2004)
    return out.select("point", "tile", "j", "i", day("time").alias("time"), "value", day("axis_day").alias("axis_day"))


@query(
    "p_17",
    """
WITH regular AS (SELECT '2x2deg' AS grid, lon, lat, CAST(0.5 AS DOUBLE) * sqrt(area) AS radius FROM (
    SELECT lon, lat, (sin(radians(lat + 1)) - sin(radians(lat - 1))) * radians(CAST(2 AS DOUBLE)) * CAST(40589753129677.44 AS DOUBLE) AS area
    FROM (SELECT DISTINCT floor(lon / CAST(2 AS DOUBLE)) * 2 + 1 AS lon, least(floor(lat / CAST(2 AS DOUBLE)) * 2 + 1, 89) AS lat FROM obs))),
polar AS (SELECT 'polar_25km' AS grid, xc AS lon, yc AS lat, CAST(25000 AS DOUBLE) * sqrt(CAST(2 AS DOUBLE)) AS radius FROM cells WHERE yc >= 30),
llc AS (SELECT 'llc' AS grid, xc AS lon, yc AS lat, CAST(0.5 AS DOUBLE) * sqrt(a) * sqrt(CAST(2 AS DOUBLE)) AS radius FROM (
    SELECT *, (sin(radians(yc + 1)) - sin(radians(yc - 1))) * (radians(CAST(1 AS DOUBLE)) / CAST(3 AS DOUBLE)) * CAST(40589753129677.44 AS DOUBLE) AS a FROM cells))
SELECT grid, count(*) AS cells, min(lat) AS lat_min, max(lat) AS lat_max, round(min(lon), 6) AS lon_min, round(max(lon), 6) AS lon_max,
       round(min(radius), 3) AS radius_min, round(max(radius), 3) AS radius_max
FROM (SELECT * FROM regular UNION ALL SELECT * FROM polar UNION ALL SELECT * FROM llc) GROUP BY grid
""",
)
def p_17(t):
    """Three demo grids over the places that occur: regular, polar with a constant radius, native."""
    from ..functions.geometry import cell_area
    from ..operators.sets import concat_records

    centre = lambda c: F.floor(F.col(c) / 2.0) * 2.0 + 1.0
    two = t.obs().select(centre("lon").alias("lon"), F.least(centre("lat"), F.lit(89.0)).alias("lat")).distinct()
    lon, lat = F.col("lon"), F.col("lat")
    two = two.withColumn("area", cell_area(lon - 1.0, lon + 1.0, lat - 1.0, lat + 1.0))
    native = t.cells().select(F.col("xc").alias("lon"), F.col("yc").alias("lat"))
    native = native.withColumn("area", cell_area(F.lit(0.0), F.lit(1.0), lat - 1.0, lat + 1.0) / 3.0)
    grids = concat_records([
        GR.demo_grid(two, "2x2deg", "half_side"),
        GR.demo_grid(native.filter(F.col("lat") >= 30), "polar_25km", "polar_25km"),
        GR.demo_grid(native, "llc", "half_diagonal"),
    ])
    out = GR.grid_summary(grids)
    return out.select("grid", "cells", "lat_min", "lat_max", *[r6(c).alias(c) for c in ("lon_min", "lon_max")], *[r3(c).alias(c) for c in ("radius_min", "radius_max")])

"""Calendar, lookup, nearest and reconciliation joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins as J
from ..plans import quality as Q
from .registry import query
from .text import day, r3, r6, r7, stamp, stamp6

POINTS = [("gulf", -87.5, 28.4), ("dateline", 179.9, -10.0), ("north", 10.0, 88.0)]


@query(
    "jn_5",
    """
WITH rec AS (SELECT CAST("time" AS DATE) AS d, k, tile, j, i, max(value) AS value FROM field GROUP BY ALL),
     days AS (SELECT CAST(unnest(generate_series(TIMESTAMP '1999-12-30', TIMESTAMP '2000-04-05', INTERVAL 1 DAY)) AS DATE) AS d)
SELECT strftime(days.d, '%Y-%m-%d') AS "date", g.k, g.tile, g.j, g.i, rec.value
FROM gridmask g CROSS JOIN days LEFT JOIN rec ON rec.d = days.d AND rec.k = g.k AND rec.tile = g.tile AND rec.j = g.j AND rec.i = g.i
""",
)
def jn_5(t):
    cell = ["k", "tile", "j", "i"]
    records = t.field().groupBy(F.to_date("time").alias("date"), *cell).agg(F.max("value").alias("value"))
    out = J.densify(records, t.mask().select(*cell), "1999-12-30", "2000-04-05", cell)
    return out.select(day("date").alias("date"), *cell, "value")


@query(
    "jn_6",
    """
SELECT dataset, strftime("time", '%Y-%m-%d') AS "day", k, tile, j, i, max(value) FILTER (var = 'V0') AS "V0",
       max(value) FILTER (var = 'V1') AS "V1", max(value) FILTER (var = 'V2') AS "V2"
FROM dayfield GROUP BY ALL
""",
)
def jn_6(t):
    keys = ["dataset", "time", "k", "tile", "j", "i"]
    wide = J.merge_variables(t.daily(), keys, ["V0", "V1", "V2"])
    return wide.withColumn("day", day("time")).drop("time")


@query(
    "jn_7",
    """
WITH m AS (SELECT dataset, "time", k, tile, j, var, avg(value) AS value FROM dayfield GROUP BY ALL)
SELECT strftime(a."time", '%Y-%m-%d') AS "day", a.k, a.tile, a.j, a.var, round(a.value - b.value, 7) AS value
FROM m a JOIN m b USING ("time", k, tile, j, var) WHERE a.dataset = 'DS_1' AND b.dataset = 'DS_0'
""",
)
def jn_7(t):
    keys = ["time", "k", "tile", "j", "var"]
    means = t.daily().groupBy("dataset", *keys).agg(F.avg("value").alias("value"))
    out = J.difference(means.filter(F.col("dataset") == "DS_1"), means.filter(F.col("dataset") == "DS_0"), keys)
    return out.select(day("time").alias("day"), "k", "tile", "j", "var", r7("value").alias("value"))


@query(
    "jn_8",
    """
WITH c AS (SELECT stem, period, regexp_extract(url, '_MODEL_V1_(.*)$', 1) AS tail, min(short_name) AS title FROM gran GROUP BY ALL)
SELECT g.url, c.title FROM gran g LEFT JOIN c ON c.stem = g.stem AND c.period = g.period AND c.tail = regexp_extract(g.url, '_MODEL_V1_(.*)$', 1)
""",
)
def jn_8(t):
    """Catalogue rows carry one example file name each; a granule takes the row with its stem and tail."""
    granules = t.granules().withColumn("name", F.substring_index("url", "/", -1))
    catalogue = granules.select(
        F.col("short_name").alias("title"), F.concat_ws("_", "stem", "period", F.lit("DATE_MODEL_V1"), F.regexp_extract("url", "_MODEL_V1_(.*)$", 1)).alias("pattern")
    ).distinct()
    return J.lookup_by_name(granules.select("url", "name"), catalogue, "name", "pattern", "title").select("url", "title")


@query(
    "jn_9",
    """
WITH x AS (SELECT m.*, r.fix_title, r.fix_summary, r.fix_short_name, string_split(m.link, 'ShortName=')[2] AS ln FROM meta m LEFT JOIN repairs r USING (id))
SELECT s_suppkey, CAST(CASE WHEN fix_title IS NULL OR fix_title <> title THEN -1 WHEN ln <> fix_short_name OR summary <> fix_summary THEN 1 ELSE 0 END AS BIGINT) AS status,
       CASE WHEN fix_title = title AND ln <> fix_short_name THEN 'https://h/search?ShortName=' || fix_short_name ELSE link END AS new_link,
       CASE WHEN fix_title = title AND summary <> fix_summary THEN fix_summary ELSE summary END AS new_summary
FROM x
""",
)
def jn_9(t):
    return Q.header_status(t.metadata(), t.repairs()).select("s_suppkey", "status", "new_link", "new_summary")


@query("jn_10", "SELECT url FROM gran WHERE regexp_extract(url, '[^/]*$') NOT IN (SELECT basename FROM have)")
def jn_10(t):
    return J.not_present(t.granules(), t.have()).select("url")


@query(
    "jn_11",
    """
SELECT url FROM gran WHERE gdate IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '1-URGENT')
""",
)
def jn_11(t):
    asked = t.table("orders").filter(F.col("o_orderpriority") == "1-URGENT").select(F.to_date("o_orderdate").alias("gdate"))
    return J.on_dates(t.granules(), asked, ["gdate"]).select("url")


@query(
    "jn_12",
    """
SELECT coalesce(m.id, r.id) AS id, CASE WHEN r.id IS NULL THEN 'left' ELSE 'right' END AS side
FROM meta m FULL JOIN (SELECT id || CASE WHEN fix_title LIKE '%(new)' THEN '_NEW' ELSE '' END AS id FROM repairs) r ON m.id = r.id
WHERE m.id IS NULL OR r.id IS NULL
""",
)
def jn_12(t):
    renamed = t.repairs().select(
        F.concat("id", F.when(F.endswith("fix_title", F.lit("(new)")), "_NEW").otherwise("")).alias("id")
    )
    return J.unmatched_keys(t.metadata(), renamed, "id")


NEXT_KIND = {"view": "click", "click": "purchase", "purchase": "signup", "signup": "error", "error": "view"}


@query(
    "jn_13",
    """
WITH p AS (SELECT DISTINCT CASE event_type WHEN 'view' THEN 'click' WHEN 'click' THEN 'purchase' WHEN 'purchase' THEN 'signup'
                  WHEN 'signup' THEN 'error' ELSE 'view' END AS var, ts AS probe FROM events),
c AS (SELECT p.var, p.probe, s."time", s.value,
        row_number() OVER (PARTITION BY p.var, p.probe ORDER BY abs(epoch_us(s."time") - epoch_us(p.probe)), s."time") AS rn
      FROM p JOIN series s ON p.var = s.var AND s."time" BETWEEN p.probe - INTERVAL 4 DAY AND p.probe + INTERVAL 4 DAY)
SELECT var, strftime(probe, '%Y-%m-%d %H:%M:%S.%f') AS probe, strftime("time", '%Y-%m-%d %H:%M:%S') AS "time", value FROM c WHERE rn = 1
""",
)
def jn_13(t):
    """Every event looks up the nearest hourly mean of another kind."""
    kind = F.create_map(*[F.lit(x) for pair in NEXT_KIND.items() for x in pair])
    probes = t.table("events").select(kind[F.col("event_type")].alias("var"), F.col("ts").alias("probe"))
    out = J.nearest_time_join(probes, t.series(), ["var"])
    return out.select("var", stamp6("probe").alias("probe"), stamp("time").alias("time"), "value")


@query(
    "jn_14",
    """
WITH p AS (SELECT c_custkey AS point, CAST(c_custkey * 3701 % 36000 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(179.9963 AS DOUBLE) AS plon,
             CAST(c_custkey * 2903 % 18001 AS DOUBLE) / CAST(100.013 AS DOUBLE) - CAST(89.9917 AS DOUBLE) AS plat FROM customer),
d AS (SELECT point, tile, j, i, CAST(111.1 AS DOUBLE) * cos(radians(plat)) * ((((xc - plon + 180) % 360) + 360) % 360 - 180) AS dx,
             CAST(111.1 AS DOUBLE) * (yc - plat) AS dy FROM p CROSS JOIN cells),
b AS (SELECT point, min({'dist': sqrt(dx * dx + dy * dy), 'tile': tile, 'j': j, 'i': i}) AS best FROM d GROUP BY point)
SELECT point, best.j AS j, best.i AS i, round(best.dist, 3) AS dist FROM b
""",
)
def jn_14(t):
    """The nearest cell to a place for every customer; tiles 0 and 12 lie on the same places, so the tile is left out."""
    key = F.col("c_custkey")
    points = t.table("customer").select(
        key.alias("point"), (key * 3701 % 36000 / F.lit(100.0) - F.lit(179.9963)).alias("lon"), (key * 2903 % 18001 / F.lit(100.013) - F.lit(89.9917)).alias("lat")
    )
    return J.nearest_cells(t.cells(), points).select("point", "j", "i", r3("dist").alias("dist"))


@query(
    "jn_15",
    """
WITH n AS (SELECT dataset, replace(var, 'V2', 'V9') AS var, min(value) AS lo, max(value) AS hi FROM field GROUP BY dataset, var)
SELECT coalesce(q.dataset, n.dataset) AS dataset, coalesce(q.var, n.var) AS var, q.file,
       CAST(CASE WHEN q.file IS NULL OR n.lo IS NULL THEN -1 WHEN q.valid_min = n.lo AND q.valid_max = n.hi THEN 0 ELSE 1 END AS BIGINT) AS status,
       round(coalesce(n.lo, q.valid_min), 6) AS valid_min, round(coalesce(n.hi, q.valid_max), 6) AS valid_max
FROM qc q FULL JOIN n ON q.dataset = n.dataset AND q.var = n.var
""",
)
def jn_15(t):
    renamed = t.field().withColumn("var", F.replace("var", F.lit("V2"), F.lit("V9")))
    new = Q.calculate_ranges(renamed, ["dataset", "var"])
    out = Q.correct_ranges(t.stored_ranges(), new, ["dataset", "var"])
    return out.select("dataset", "var", "file", "status", r6("valid_min").alias("valid_min"), r6("valid_max").alias("valid_max"))


@query(
    "jn_16",
    """
WITH c AS (SELECT tile, j, i, xc AS xg, yc AS yg FROM cells)
SELECT a.tile, a.j, a.i, round(a.xg, 3) AS x0, round(b.xg, 3) AS x1, round(c2.xg, 3) AS x2, round(d.xg, 3) AS x3, a.yg AS y0, b.yg AS y1, c2.yg AS y2, d.yg AS y3
FROM c a JOIN c b ON b.tile = a.tile AND b.j = a.j AND b.i = a.i + 1
JOIN c c2 ON c2.tile = a.tile AND c2.j = a.j + 1 AND c2.i = a.i + 1
JOIN c d ON d.tile = a.tile AND d.j = a.j + 1 AND d.i = a.i
WHERE a.j < 89 AND a.i < 89
""",
)
def jn_16(t):
    """Cells whose four corner points all occur."""
    corners = t.cells().withColumnsRenamed({"xc": "xg", "yc": "yg"})
    built = J.cell_corners(corners, 89)
    whole = built.filter(~F.exists("x_bounds", lambda x: x.isNull()))
    return whole.select(
        "tile", "j", "i", *[r3(F.col("x_bounds")[s]).alias(f"x{s}") for s in range(4)], *[F.col("y_bounds")[s].alias(f"y{s}") for s in range(4)]
    )


@query(
    "jn_17",
    """
SELECT target_id, var, round(v, 7) AS value, lon0, lon1, lat0, lat1
FROM (SELECT target_id, var, avg(value) AS v FROM inside GROUP BY target_id, var) JOIN target USING (target_id)
""",
)
def jn_17(t):
    from ..operators.regrid import regrid_points

    target = t.target()
    mapped = regrid_points(t.obs(), target, "nanmean", group=("var",))
    out = J.with_bounds(mapped, target.select("target_id", "lon0", "lon1", "lat0", "lat1"), ["target_id"])
    return out.select("target_id", "var", r7("value").alias("value"), "lon0", "lon1", "lat0", "lat1")


@query(
    "jn_18",
    """
WITH l AS (SELECT url, size_mb, 1 AS page FROM gran WHERE delivered UNION ALL SELECT url, size_mb * 2, 2 FROM gran WHERE day(gdate) % 2 = 0),
f AS (SELECT url, size_mb FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page) AS rn FROM l) WHERE rn = 1)
SELECT g.url, f.size_mb FROM gran g LEFT JOIN f USING (url)
""",
)
def jn_18(t):
    """All URLs looked up in a listing of two pages: some are on both, some on one, some on none."""
    granules = t.granules()
    pages = granules.filter("delivered").select("url", "size_mb", F.lit(1).alias("page")).unionByName(
        granules.filter(F.dayofmonth("gdate") % 2 == 0).select("url", (F.col("size_mb") * 2).alias("size_mb"), F.lit(2).alias("page"))
    )
    return J.first_size(granules.select("url"), pages, "page")


@query(
    "jn_19",
    """
WITH w AS (SELECT short_name AS grouping, trim(unnest(string_split(fields, ','))) AS var FROM meta),
n AS (SELECT var, count(DISTINCT CASE var WHEN 'V1' THEN 'SHARED' ELSE dataset END) AS matches FROM field GROUP BY var)
SELECT grouping, var, coalesce(matches, 0) AS matches, CASE WHEN coalesce(matches, 0) = 1 THEN 'ok' WHEN matches > 1 THEN 'ambiguous' ELSE 'missing' END AS status
FROM w LEFT JOIN n USING (var)
""",
)
def jn_19(t):
    names = t.field().select("var", F.when(F.col("var") == "V1", "SHARED").otherwise(F.col("dataset")).alias("directory"))
    groupings = t.metadata().select(F.col("short_name").alias("grouping"), "fields")
    return J.memberships(names, groupings)

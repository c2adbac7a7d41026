"""SQL of the frames in `sources.derived`, by the same arithmetic."""

FRAMES: dict[str, str] = {}

FIELD = """
SELECT 'DS_' || (l_partkey % 2) AS dataset,
       make_timestamp((epoch_us(TIMESTAMP '2000-01-01') + ((l_orderkey % 91) * 86400 + {second}) * 1000000)) AS "time",
       CAST((l_linenumber - 1) % 2 AS INTEGER) AS k, CAST(l_partkey % 13 AS INTEGER) AS tile,
       CAST(l_suppkey % 5 AS INTEGER) AS j, CAST(l_orderkey % 5 AS INTEGER) AS i,
       'V' || (l_partkey % 3) AS var, ['c', 'w', 's'][CAST(l_partkey % 3 + 1 AS INTEGER)] AS loc,
       CASE WHEN ((l_partkey % 13) + (l_suppkey % 5) + (l_orderkey % 5)
                 + day(DATE '2000-01-01' + CAST(l_orderkey % 91 AS INTEGER))) % 7 <> 0
            THEN max(l_extendedprice) END AS value
FROM lineitem
GROUP BY l_partkey % 2, l_orderkey % 91, {second}, (l_linenumber - 1) % 2, l_partkey % 13, l_suppkey % 5,
         l_orderkey % 5, l_partkey % 3
"""

# One instant per order; and the maxima of whole days.
FRAMES["field"] = FIELD.format(second="(l_orderkey // 91) % 86400")
FRAMES["dayfield"] = FIELD.format(second="(l_orderkey * 0)")

FRAMES["gridmask"] = """
SELECT *, CAST((tile * 31 + j * 7 + i * 3 + k) % 5 AS DOUBLE) / CAST(4 AS DOUBLE) AS hfac,
       (tile * 31 + j * 7 + i * 3 + k) % 5 > 0 AS maskc,
       (tile + j + i + k) % 6 <> 0 AS maskw, (tile + j + 2 * i + k) % 6 <> 0 AS masks
FROM (SELECT CAST(g // 325 AS INTEGER) AS k, CAST((g // 25) % 13 AS INTEGER) AS tile,
             CAST((g // 5) % 5 AS INTEGER) AS j, CAST(g % 5 AS INTEGER) AS i
      FROM range(650) r(g))
"""

FRAMES["native"] = """
SELECT g.*, CAST(g.tile * 25 + g.j * 5 + g.i AS BIGINT) AS source_id,
       CAST((g.tile * 28 + g.i * 7) % 360 AS DOUBLE) - CAST(180 AS DOUBLE) AS lon,
       CAST(g.j * 36 - 80 + g.tile AS DOUBLE) AS lat
FROM gridmask g SEMI JOIN field f ON g.k = f.k AND g.tile = f.tile AND g.j = f.j AND g.i = f.i
"""

FRAMES["cells"] = """
SELECT tile, j, i,
       (CAST(tile * 30 AS DOUBLE) + CAST(i AS DOUBLE) / CAST(3 AS DOUBLE)) % CAST(360 AS DOUBLE) - CAST(180 AS DOUBLE) AS xc,
       least(greatest(CAST(j * 2 - 90 + tile % 2 AS DOUBLE), CAST(-89 AS DOUBLE)), CAST(89 AS DOUBLE)) AS yc
FROM (SELECT DISTINCT CAST(l_partkey % 13 AS INTEGER) AS tile, CAST(l_suppkey % 90 AS INTEGER) AS j,
             CAST(l_orderkey % 90 AS INTEGER) AS i FROM lineitem)
"""

FRAMES["layers"] = """
SELECT l_suppkey AS profile, CAST(l_quantity - 1 AS BIGINT) AS k,
       round(max(l_tax) * CAST(100 AS DOUBLE), 0) + CAST(10 AS DOUBLE) + CAST(l_quantity - 1 AS BIGINT) * CAST(5 AS DOUBLE) AS dr
FROM lineitem GROUP BY l_suppkey, l_quantity
"""

FRAMES["obs"] = """
SELECT event_id AS source_id, ts, event_type AS var,
       CAST((user_id * 3701 + event_id * 1301) % 36000 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(180 AS DOUBLE) AS lon,
       CAST((event_id * 2903 + user_id * 701) % 18001 AS DOUBLE) / CAST(100 AS DOUBLE) - CAST(90 AS DOUBLE) AS lat,
       CASE WHEN event_id % 23 <> 0 THEN value END AS value
FROM events
"""

FRAMES["target"] = """
SELECT *, (lon0 + lon1) / CAST(2 AS DOUBLE) AS lon, (lat0 + lat1) / CAST(2 AS DOUBLE) AS lat,
       (sin(radians(lat1)) - sin(radians(lat0))) * (radians(lon1) - radians(lon0))
         * CAST(40589753129677.44 AS DOUBLE) AS area,
       sqrt((sin(radians(lat1)) - sin(radians(lat0))) * (radians(lon1) - radians(lon0))
         * CAST(40589753129677.44 AS DOUBLE) / pi()) AS radius
FROM (SELECT CAST(g AS BIGINT) AS target_id, CAST(g // 72 AS INTEGER) AS "row", CAST(g % 72 AS INTEGER) AS col,
             CAST(-180 + (g % 72) * 5 AS DOUBLE) AS lon0, CAST(-180 + (g % 72 + 1) * 5 AS DOUBLE) AS lon1,
             CAST(90 - (g // 72 + 1) * 5 AS DOUBLE) AS lat0, CAST(90 - (g // 72) * 5 AS DOUBLE) AS lat1
      FROM range(2592) r(g))
"""

# Every (target, observation) pair within 400 km or the target's own radius.
FRAMES["near"] = """
SELECT * FROM (
  SELECT t.target_id, t.radius, o.source_id, o.var, o.ts, o.value,
         CAST(12742017.6 AS DOUBLE) * asin(least(CAST(1 AS DOUBLE), sqrt(
             sin(radians(t.lat - o.lat) / CAST(2 AS DOUBLE)) * sin(radians(t.lat - o.lat) / CAST(2 AS DOUBLE))
             + cos(radians(o.lat)) * cos(radians(t.lat))
               * sin(radians(t.lon - o.lon) / CAST(2 AS DOUBLE)) * sin(radians(t.lon - o.lon) / CAST(2 AS DOUBLE))))) AS dist
  FROM target t JOIN obs o ON abs(t.lat - o.lat) <= CAST(4 AS DOUBLE))
WHERE dist <= greatest(radius, CAST(400000 AS DOUBLE))
"""

FRAMES["inside"] = """
SELECT * FROM near
WHERE dist <= radius AND dist <= (SELECT floor(max(radius)) FROM target)
"""

FRAMES["nearest400"] = """
SELECT * FROM near WHERE dist <= CAST(400000 AS DOUBLE)
"""

# Every (target, native cell) pair within 800 km, all levels.
FRAMES["nearcell"] = """
SELECT * FROM (
  SELECT t.target_id, t.radius, o.source_id, o.k, o.hfac,
         CAST(12742017.6 AS DOUBLE) * asin(least(CAST(1 AS DOUBLE), sqrt(
             sin(radians(t.lat - o.lat) / CAST(2 AS DOUBLE)) * sin(radians(t.lat - o.lat) / CAST(2 AS DOUBLE))
             + cos(radians(o.lat)) * cos(radians(t.lat))
               * sin(radians(t.lon - o.lon) / CAST(2 AS DOUBLE)) * sin(radians(t.lon - o.lon) / CAST(2 AS DOUBLE))))) AS dist
  FROM target t JOIN native o ON abs(t.lat - o.lat) <= CAST(8 AS DOUBLE))
WHERE dist <= CAST(800000 AS DOUBLE)
"""

# Mapping factors of wet native cells: inside the radius, else the nearest within 800 km.
FRAMES["celledges"] = """
SELECT target_id, k, source_id, dist, false AS is_fallback FROM nearcell
WHERE hfac > 0 AND dist <= radius AND dist <= (SELECT floor(max(radius)) FROM target)
UNION ALL
SELECT target_id, k, source_id, dist, true FROM (
  SELECT *, row_number() OVER (PARTITION BY target_id, k ORDER BY dist, source_id) AS rn,
         count_if(dist <= radius AND dist <= (SELECT floor(max(radius)) FROM target)) OVER (PARTITION BY target_id, k) AS n_in
  FROM nearcell WHERE hfac > 0) WHERE rn = 1 AND n_in = 0
"""

# Land mask of the target grid: the nearest native cell of the level is wet.
FRAMES["landmask"] = """
SELECT target_id, k, hfac > 0 AS wet FROM (
  SELECT *, row_number() OVER (PARTITION BY target_id, k ORDER BY dist, source_id) AS rn FROM nearcell) WHERE rn = 1
"""

FRAMES["series"] = """
SELECT date_trunc('hour', ts) AS "time", event_type AS var, round(avg(value), 7) AS value
FROM events GROUP BY date_trunc('hour', ts), event_type
"""

FRAMES["gran"] = """
SELECT short_name, stem, period, gdate,
       'https://h/' || short_name || '/' || stem || '_' || period || '_'
         || (CASE WHEN period = 'mon_mean' THEN strftime(gdate, '%Y-%m') ELSE strftime(gdate, '%Y-%m-%d') END)
         || '_MODEL_V1_' || grid || '_g.nc' AS url,
       CASE WHEN kmin % 17 = 0 THEN NULL WHEN kmin % 19 = 0 THEN CAST(0.0005 AS DOUBLE)
            ELSE pmax / CAST(10000 AS DOUBLE) END AS size_mb,
       CAST(gdate AS TIMESTAMP) AS time_start,
       CAST(CASE period WHEN 'mon_mean' THEN gdate + INTERVAL 1 MONTH WHEN 'snap' THEN gdate
            ELSE gdate + INTERVAL 1 DAY END AS TIMESTAMP) AS time_end,
       delivered
FROM (
  SELECT 'DS_L4_' || ['SSH', 'SSH', 'TEMP', 'TEMP'][kind + 1] || '_M' || mission || '_'
           || ['LLC0090GRID_MONTHLY', '05DEG_DAILY', 'LLC0090GRID_DAILY', 'LLC0090GRID_SNAPSHOT'][kind + 1] || '_V1' AS short_name,
         ['SSH', 'SSH', 'TEMP', 'TEMP'][kind + 1] || '_M' || mission AS stem,
         ['mon_mean', 'day_mean', 'day_mean', 'snap'][kind + 1] AS period,
         ['native', 'latlon', 'native', 'native'][kind + 1] AS grid,
         CAST(CASE WHEN kind = 0 THEN date_trunc('month', o_orderdate) ELSE o_orderdate END AS DATE) AS gdate,
         max(o_totalprice) AS pmax, min(o_orderkey) AS kmin, bool_or(o_orderstatus = 'F') AS delivered
  FROM (SELECT *, CAST(o_orderkey % 4 AS INTEGER) AS kind,
               lpad(CAST(o_custkey % 25 AS VARCHAR), 2, '0') AS mission FROM orders)
  GROUP BY 1, 2, 3, 4, 5)
"""

FRAMES["have"] = """
SELECT regexp_extract(url, '[^/]*$') AS basename FROM gran WHERE delivered
"""

FRAMES["cat"] = """
SELECT CASE WHEN p_size % 5 = 0 THEN 'mixed,all'
            ELSE ['native', 'latlon'][p_size % 2 + 1] || ',' || ['monthly', 'daily', 'snapshot'][p_size % 3 + 1] END AS section,
       'DS_L4_' || p_type || '_' || replace(p_brand, 'Brand#', 'B') || '_'
         || CASE WHEN p_size % 5 = 0 THEN 'MIXED'
                 ELSE ['LLC0090GRID', '05DEG'][p_size % 2 + 1] || '_' || ['MONTHLY', 'DAILY', 'SNAPSHOT'][p_size % 3 + 1] END
         || '_V1' AS short_name,
       CASE WHEN p_size % 5 = 0 THEN '*for ' || ['native', 'lat-lon'][p_size % 2 + 1] || ' grid, '
            || ['monthly', 'daily', 'snapshot'][p_size % 3 + 1] || '*' END AS note,
       p_name AS var, p_type || ' ' || p_size AS description, CAST(p_partkey % 2 AS INTEGER) AS source_order,
       p_partkey AS entry_id
FROM part
"""

FRAMES["meta"] = """
SELECT s_suppkey, s_acctbal, '10.9999/DS_' || s_suppkey AS id, 'DS_' || s_suppkey AS short_name,
       'https://h/search?ShortName=DS_' || s_suppkey || CASE WHEN s_suppkey % 7 = 0 THEN '_OLD' ELSE '' END AS link,
       s_name || ' of ' || n_name AS title, 'Fields of ' || n_name || '. Marker text ' || s_suppkey AS summary,
       'OCEAN, ' || n_name || ',ICE' AS keywords, 'ICE, REGION_' || n_regionkey || ' , ocean' AS keywords_extra,
       s_name, n_name, n_regionkey,
       'V' || (s_suppkey % 3) || ' , V' || ((s_suppkey + 1) % 3) || ',W' || (s_suppkey % 5) AS fields,
       'V0:SSH,V' || (s_suppkey % 2 + 1) || ':TEMP' AS rename
FROM supplier JOIN nation ON s_nationkey = n_nationkey
"""

FRAMES["repairs"] = """
SELECT id, title || CASE WHEN s_suppkey % 10 = 0 THEN ' (new)' ELSE '' END AS fix_title,
       short_name AS fix_short_name,
       summary || CASE WHEN s_suppkey % 4 = 0 THEN ' revised' ELSE '' END AS fix_summary
FROM meta WHERE s_acctbal >= 1000
"""

FRAMES["qc"] = """
SELECT dataset, var, mon AS "month", dataset || '_' || mon || '.nc' AS file,
       CASE m WHEN 1 THEN lo - (hi - lo) * CAST(0.1 AS DOUBLE) WHEN 2 THEN lo + (hi - lo) * CAST(0.1 AS DOUBLE) ELSE lo END AS valid_min,
       CASE m WHEN 1 THEN hi + (hi - lo) * CAST(0.1 AS DOUBLE) WHEN 2 THEN hi - (hi - lo) * CAST(0.1 AS DOUBLE) ELSE hi END AS valid_max
FROM (SELECT dataset, var, strftime("time", '%Y-%m') AS mon, month(max("time")) AS m, min(value) AS lo, max(value) AS hi
      FROM field GROUP BY dataset, var, strftime("time", '%Y-%m'))
"""

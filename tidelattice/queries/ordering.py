"""Windows, sorts, top rows and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.attrs import sorted_attributes
from ..operators import sets as O
from ..operators import windows as W
from ..plans import catalogue as C
from ..sources.varlist import parse_varlist
from .registry import query
from .selecting import DEPTHS, depths
from .text import big, day, r6, r7, stamp
from .varlists import LINES_SQL, PARSED_SQL, varlist_lines


@query("wn_1", f"SELECT profile, k, round(zu, 6) AS zu, round(zl, 6) AS zl FROM ({DEPTHS})")
def wn_1(t):
    return depths(t).select("profile", "k", r6("zu").alias("zu"), r6("zl").alias("zl"))


@query(
    "wn_3",
    f"""
SELECT file, CAST(line_no AS BIGINT) AS line_no, last_value(CASE WHEN is_section THEN section_name END IGNORE NULLS)
  OVER (PARTITION BY file ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS short_name
FROM ({LINES_SQL})
""",
)
def wn_3(t):
    from ..operators.scale import carry_forward

    line = F.col("line")
    star = F.locate("*", line)
    name = F.replace(F.when(star > 0, F.substring(line, F.lit(1), star - 1)).otherwise(line), F.lit(" "), F.lit(""))
    section = F.when(F.contains(line, F.lit("DS_L4_")), name)
    out = carry_forward(varlist_lines(t), ["file"], "line_no", {"short_name": section}, block_rows=64)
    return out.select("file", big("line_no").alias("line_no"), "short_name")


@query("wn_4", "SELECT short_name, url, ntile(7) OVER (PARTITION BY short_name ORDER BY url) AS bucket FROM gran")
def wn_4(t):
    out = W.balanced_buckets(t.granules(), ["short_name"], ["url"], F.date_format("gdate", "yyyy-MM"), 7)
    return out.select("short_name", "url", "bucket")


@query(
    "wn_6",
    """
SELECT url, 'first' AS "end", rank FROM (SELECT url, row_number() OVER (PARTITION BY short_name ORDER BY url) AS rank FROM gran) WHERE rank <= 2
UNION ALL SELECT url, 'last', rank FROM (SELECT url, row_number() OVER (PARTITION BY short_name ORDER BY url DESC) AS rank FROM gran) WHERE rank <= 2
""",
)
def wn_6(t):
    return W.ends(t.granules(), ["short_name"], ["url"], 2).select("url", "end", big("rank").alias("rank"))


@query(
    "wn_7",
    """
SELECT short_name, url FROM (SELECT short_name, url, row_number() OVER (PARTITION BY short_name
  ORDER BY abs(epoch_us(time_start) - epoch_us(TIMESTAMP '1998-05-11')), time_start, url) AS rn FROM gran) WHERE rn = 1
""",
)
def wn_7(t):
    g = t.granules().select("short_name", "time_start", "url")
    start = F.lit("1998-05-11").cast("timestamp")
    return W.nearest_start(g, ["short_name"], start).select("short_name", "url")


@query(
    "wn_8",
    """
WITH m AS (SELECT date_trunc('month', "time") AS "time", k, tile, j, i, var, avg(value) AS value FROM field GROUP BY ALL)
SELECT a.k, a.tile, a.j, a.i, a.var, round(b.value - a.value, 7) AS value FROM m a JOIN m b USING (k, tile, j, i, var)
WHERE a."time" = TIMESTAMP '2000-01-01' AND b."time" = TIMESTAMP '2000-03-01'
""",
)
def wn_8(t):
    from ..operators.aggregate import monthly_mean

    keys = ["k", "tile", "j", "i", "var"]
    months = monthly_mean(t.field(), keys).withColumnRenamed("month", "time")
    return W.change_between(months, keys, "2000-01-01", "2000-03-01").withColumn("value", r7("value"))


@query(
    "wn_9",
    """
SELECT strftime("time", '%Y-%m-%d %H:%M:%S') AS "time", var, row_number() OVER (PARTITION BY var ORDER BY "time") AS record FROM series
""",
)
def wn_9(t):
    out = W.record_number(t.series(), ["var"], "time", F.date_trunc("day", "time"))
    return out.select(stamp("time").alias("time"), "var", "record")


@query("wn_10", "SELECT strftime(gdate, '%Y-%m-%d') AS gdate, max(url) AS url FROM gran GROUP BY gdate")
def wn_10(t):
    return W.last_match(t.granules(), ["gdate"], "url").withColumn("gdate", day("gdate"))


@query("wn_11", "SELECT name, dense_rank() OVER (ORDER BY name) - 1 AS number FROM (SELECT DISTINCT short_name AS name FROM cat)")
def wn_11(t):
    return W.dense_number(t.catalogue().select(F.col("short_name").alias("name")), "name")


@query("sr_1", "SELECT url, strftime(gdate, '%Y-%m-%d') AS gdate FROM gran ORDER BY gran.gdate, url")
def sr_1(t):
    return t.granules().orderBy("gdate", "url").select("url", day("gdate").alias("gdate"))


@query(
    "sr_2",
    """
SELECT s_suppkey, unnest(['author', 'date', 'Title', 'Zone']) AS "key", unnest([n_name, '2000-01-01', s_name, CAST(n_regionkey AS VARCHAR)]) AS value,
       unnest([CAST(0 AS BIGINT), 1, 2, 3]) AS position FROM meta
""",
)
def sr_2(t):
    entries = F.posexplode(sorted_attributes(F.col("attrs")))
    out = t.metadata().select("s_suppkey", entries.alias("position", "e"))
    return out.select("s_suppkey", F.col("e.key").alias("key"), F.col("e.value").alias("value"), big("position").alias("position"))


@query(
    "sr_3",
    """
SELECT 'first' AS part, url FROM (SELECT url FROM gran ORDER BY url LIMIT 30)
UNION ALL SELECT 'slice', url FROM (SELECT url FROM gran ORDER BY url LIMIT 2 OFFSET 2)
""",
)
def sr_3(t):
    """Debug subsets: the first n, and a slice."""
    ordered = t.granules().select("url").orderBy("url")
    first = ordered.limit(30).select(F.lit("first").alias("part"), "url")
    return first.unionByName(ordered.offset(2).limit(2).select(F.lit("slice").alias("part"), "url"))


SEARCH_SQL = """
SELECT short_name, lower(short_name) = lower('{q}') AS exact, min(entry_id) AS position FROM cat
WHERE {where} GROUP BY short_name
HAVING bool_or(contains(lower(short_name), lower('{q}')) OR contains(lower(var), lower('{q}')) OR contains(lower(description), lower('{q}')) OR coalesce(contains(lower(note), lower('{q}')), false))
"""


@query(
    "sr_4",
    f"""
SELECT 'exact' AS asked, short_name FROM (SELECT * FROM ({SEARCH_SQL.format(q='ds_l4_promo_b3_05deg_monthly_v1', where="section <> 'latlon,snapshot'")}) ORDER BY exact DESC, position, short_name LIMIT 1)
UNION ALL SELECT 'third', short_name FROM (SELECT * FROM ({SEARCH_SQL.format(q='blue', where="section <> 'latlon,snapshot'")}) ORDER BY exact DESC, position, short_name LIMIT 1 OFFSET 2)
""",
)
def sr_4(t):
    cat = t.catalogue()
    exact = C.choose(C.search(cat, "ds_l4_promo_b3_05deg_monthly_v1"))
    third = C.choose(C.search(cat, "blue"), option=3)
    return exact.select(F.lit("exact").alias("asked"), "short_name").unionByName(third.select(F.lit("third").alias("asked"), "short_name"))


@query(
    "so_1",
    """
SELECT section, short_name, var, description, source_order, entry_id FROM (
  SELECT *, row_number() OVER (PARTITION BY section, short_name, var ORDER BY source_order DESC, entry_id DESC) AS rn FROM cat) WHERE rn = 1
""",
)
def so_1(t):
    return C.merged(t.catalogue()).drop("note")


@query(
    "so_2",
    """
SELECT strftime("time", '%Y-%m-%d %H:%M:%S') AS "time", var, value, CAST(NULL AS BIGINT) AS n FROM series
UNION ALL SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S'), event_type, round(avg(value), 6), count(*) FROM events GROUP BY ALL
""",
)
def so_2(t):
    daily = t.table("events").groupBy(F.date_trunc("day", "ts").alias("time"), F.col("event_type").alias("var")).agg(
        r6(F.avg("value")).alias("value"), F.count(F.lit(1)).alias("n")
    )
    return O.concat_records([t.series(), daily]).withColumn("time", stamp("time"))


def variable_sets(t):
    """Variable names of two groups of brands."""
    named = F.concat_ws(" ", "p_name", F.col("p_size").cast("string")).alias("v")
    low = F.col("p_brand") < "Brand#2"
    part = t.table("part")
    return part.filter(low).select(named), part.filter(~low).select(named)


@query("so_3", "SELECT p_name || ' ' || p_size AS v FROM part WHERE p_brand < 'Brand#2' INTERSECT SELECT p_name || ' ' || p_size FROM part WHERE p_brand >= 'Brand#2'")
def so_3(t):
    return O.common(*variable_sets(t))


@query("so_4", "SELECT p_name || ' ' || p_size AS v FROM part WHERE p_brand < 'Brand#2' EXCEPT SELECT p_name || ' ' || p_size FROM part WHERE p_brand >= 'Brand#2'")
def so_4(t):
    return O.only_in(*variable_sets(t))


@query(
    "so_5",
    """
WITH a AS (SELECT DISTINCT p_name || ' ' || p_size AS v FROM part WHERE p_brand < 'Brand#2'), b AS (SELECT DISTINCT p_name || ' ' || p_size AS v FROM part WHERE p_brand >= 'Brand#2')
(SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)
""",
)
def so_5(t):
    return O.symmetric_difference(*variable_sets(t))


@query(
    "so_6",
    """
WITH r AS (SELECT DISTINCT ['native,monthly', 'latlon,daily', 'native,all'][CAST(p_partkey % 3 + 1 AS INTEGER)] AS "key", split_part(p_name, ' ', 1) AS query FROM part),
k AS (SELECT *, split_part("key", ',', 1) AS g, split_part("key", ',', 2) AS tr FROM r)
SELECT DISTINCT k."key", k.query, c.short_name FROM k JOIN cat c
  ON (c.section = 'mixed,all' OR (split_part(c.section, ',', 1) = g AND (tr = 'all' OR split_part(c.section, ',', 2) = tr)))
WHERE (note IS NULL OR (contains(note, CASE g WHEN 'latlon' THEN 'lat-lon' ELSE g END) AND (tr = 'all' OR contains(note, tr))))
  AND (contains(lower(short_name), lower(query)) OR contains(lower(var), lower(query)) OR contains(lower(description), lower(query)) OR coalesce(contains(lower(note), lower(query)), false))
""",
)
def so_6(t):
    key = F.element_at(
        F.array(F.lit("native,monthly"), F.lit("latlon,daily"), F.lit("native,all")), (F.col("p_partkey") % 3 + 1).cast("int")
    )
    requests = t.table("part").select(key.alias("key"), F.split_part("p_name", F.lit(" "), F.lit(1)).alias("query")).distinct()
    return C.search_requests(t.catalogue(), requests)


@query("so_7", "SELECT DISTINCT short_name, var FROM cat")
def so_7(t):
    return O.distinct_keys(t.catalogue().select("short_name", "var"), ["short_name", "var"])


@query("src_10", PARSED_SQL)
def src_10(t):
    out = parse_varlist(varlist_lines(t), "DS_L4_", block_rows=64)
    return out.withColumn("line_no", big("line_no"))

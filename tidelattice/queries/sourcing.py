"""Scans and sinks, on rows that Spark derives from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import shared_folder
from ..sources import binary as B
from ..sources import fields as FS
from ..sources import granules as G
from ..sources import sinks as K
from ..sources import tables as T
from ..sources.derived import FIELD_N, LEVELS
from .registry import query
from .text import big, day, r3, r6, stamp

ENTRY_SQL = """
SELECT strftime(time_start, '%Y-%m-%d %H:%M:%S') AS time_start, strftime(time_end, '%Y-%m-%d %H:%M:%S') AS time_end, round(size_mb, 6) AS size_mb, {url} AS url FROM gran
"""


def feed(t):
    return G.to_feed(t.granules(), page_size=200)


def _entries(df):
    return df.select(stamp("time_start").alias("time_start"), stamp("time_end").alias("time_end"), r6("size_mb").alias("size_mb"), "url")


@query("src_1", ENTRY_SQL.format(url="url"))
def src_1(t):
    return _entries(G.feed_entries(feed(t)))


@query("src_2", ENTRY_SQL.format(url="url"))
def src_2(t):
    """Feed pages written to the shared folder and read back, each page twice: an entry counts once."""
    path = shared_folder(t.spark, "feed-pages")
    pages = feed(t).select("feed").repartition(16)
    pages.write.option("compression", "gzip").json(path)
    pages.write.mode("append").json(path)
    stored = t.spark.read.schema(G.FEED_SCHEMA).json(path)
    return _entries(G.feed_entries(stored).dropDuplicates(["url"]))


@query("src_3", ENTRY_SQL.format(url="replace(url, 'https://h/', 's3://b/')"))
def src_3(t):
    return _entries(G.feed_entries(feed(t), G.bucket_link))


@query(
    "src_4",
    """
SELECT url, string_split(url, '_')[-5] AS date_text, strftime(gdate, '%Y-%m-%d %H:%M:%S') AS time_start FROM gran
WHERE gdate >= DATE '1996-03-01' AND gdate < DATE '2000-02-15'
""",
)
def src_4(t):
    start, stop = F.lit("1996-03-01").cast("timestamp"), F.lit("2000-02-15").cast("timestamp")
    out = G.listing_between(t.granules().select("url"), start, stop)
    return out.orderBy("time_start", "url").select("url", "date_text", stamp("time_start").alias("time_start"))


@query(
    "src_5",
    """
SELECT DISTINCT 'native' AS grid, 'daily' AS time_type, dataset, dense_rank() OVER (ORDER BY dataset) - 1 AS number FROM field
""",
)
def src_5(t):
    """Dataset folders found by their partition values, numbered in sorted order."""
    from ..operators.windows import dense_number

    path = shared_folder(t.spark, "folders")
    kinds = t.field().withColumns({"grid": F.lit("native"), "time_type": F.lit("daily")})
    kinds.repartition("dataset", "tile").write.partitionBy("grid", "time_type", "dataset").parquet(path)
    found = FS.dataset_folders(t.spark, path).select("grid", "time_type", "dataset").distinct()
    return found.join(dense_number(found, "dataset"), "dataset").select("grid", "time_type", "dataset", "number")


@query(
    "src_6",
    """
SELECT dataset, strftime("time", '%Y-%m-%d') AS "day", count(*) AS n, count(value) AS present, max(value) AS value FROM field GROUP BY ALL
""",
)
def src_6(t):
    """Files of several months, written apart, opened as one dataset."""
    path = shared_folder(t.spark, "months")
    field = t.field().withColumn("month", F.date_format("time", "yyyyMM"))
    field.repartition("month", "tile").write.partitionBy("month").parquet(path)
    whole = FS.open_many(t.spark, path)
    return whole.groupBy("dataset", day("time").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("present"), F.max("value").alias("value")
    )


RECORD_SQL = """
WITH rec AS (SELECT var, strftime("time", '%Y%m%d') AS step, k, tile, j, i, max(value) AS value FROM field GROUP BY ALL)
"""


def records(t):
    cell = ["k", "tile", "j", "i"]
    return t.field().groupBy("var", F.date_format("time", "yyyyMMdd").alias("step"), *cell).agg(F.max("value").alias("value"))


@query(
    "src_7",
    RECORD_SQL
    + """
SELECT var, CAST(step AS BIGINT) AS step, CAST(k AS BIGINT) AS k, CAST(tile AS BIGINT) AS tile, CAST(j AS BIGINT) AS j, CAST(i AS BIGINT) AS i,
       round(CAST(CAST(value AS FLOAT) AS DOUBLE), 3) AS value
FROM rec WHERE value IS NOT NULL
""",
)
def src_7(t):
    """Big-endian record files, one per variable and step, read as cells; absent cells hold the fill."""
    path = shared_folder(t.spark, "records")
    B.write_records(records(t), path, FIELD_N, LEVELS)
    return B.read_records(t.spark, path, FIELD_N).filter(F.col("value").isNotNull()).withColumn("value", r3("value"))


@query("src_8", "SELECT s_suppkey, title, summary FROM meta")
def src_8(t):
    path = shared_folder(t.spark, "datasets-csv")
    t.metadata().select("s_suppkey", "title", "summary").write.option("header", True).option("escape", '"').csv(path)
    return T.read_csv_table(t.spark, path, "s_suppkey long, title string, summary string")


@query("src_9", "SELECT s_suppkey, short_name, s_name AS list_title, n_name AS author FROM meta")
def src_9(t):
    """Lists of datasets with attributes of any shape, which stay VARIANT until they are asked for."""
    path = shared_folder(t.spark, "lists-json")
    t.metadata().select("s_suppkey", "short_name", "attrs").write.json(path)
    stored = T.read_json_list(t.spark, path, "s_suppkey long, short_name string, attrs variant", lines=True)
    attr = lambda name: F.variant_get("attrs", f"$.{name}", "string")
    return stored.select("s_suppkey", "short_name", attr("Title").alias("list_title"), attr("author").alias("author"))


@query(
    "src_11",
    """
WITH d AS (SELECT CAST(unnest(generate_series(TIMESTAMP '1997-01-01', TIMESTAMP '1997-12-31', INTERVAL 1 DAY)) AS DATE) AS d),
f AS (SELECT gdate, max(url) AS path FROM gran WHERE short_name LIKE '%SSH%' AND period = 'day_mean' GROUP BY gdate)
SELECT strftime(d, '%Y-%m-%d') AS "date", coalesce(path, '') AS path FROM d LEFT JOIN f ON gdate = d
""",
)
def src_11(t):
    files = t.granules().filter("period = 'day_mean'").select(F.col("url").alias("path"))
    out = G.harvest_year(t.spark, files, 1997, "DAILY", "yyyy-MM-dd", hemisphere="SSH")
    return out.select(day("date").alias("date"), "path")


@query("src_12", "SELECT strftime(\"time\", '%Y-%m-%d %H:%M:%S') AS \"time\", var, value FROM series")
def src_12(t):
    path = shared_folder(t.spark, "series")
    t.series().write.parquet(path)
    return FS.open_series(t.spark, path).withColumn("time", stamp("time"))


@query("src_13", "SELECT dataset, var, round(valid_min, 6) AS valid_min, round(valid_max, 6) AS valid_max FROM qc")
def src_13(t):
    """Range files, one folder a dataset, written and read back."""
    path = shared_folder(t.spark, "ranges")
    stored = t.stored_ranges().withColumn("id", F.concat(F.lit("10.9999/"), "dataset"))
    K.write_ranges(stored, path, "native", "daily")
    out = T.read_stored_ranges(t.spark, path, "*.parquet")
    return out.select("dataset", "var", r6("valid_min").alias("valid_min"), r6("valid_max").alias("valid_max"))


@query(
    "snk_1",
    """
SELECT dataset, var, k, tile, j, i, strftime("time", '%Y-%m') AS year_month,
       CAST((epoch("time") - epoch(TIMESTAMP '1992-01-01 12:00:00')) // 3600 AS INTEGER) AS hours,
       round(CAST(CAST(coalesce(value, CAST(-9999 AS DOUBLE)) AS FLOAT) AS DOUBLE), 3) AS value
FROM field
""",
)
def snk_1(t):
    """Product rows written by dataset and month and read back."""
    path = shared_folder(t.spark, "product")
    K.write_product(t.field(), path, fill=-9999.0)
    out = t.spark.read.parquet(path)
    return out.select("dataset", "var", "k", "tile", "j", "i", "year_month", "hours", r3(F.col("value").cast("double")).alias("value"))


@query(
    "snk_2",
    RECORD_SQL
    + """,
placed AS (
  SELECT var, step, k * 325 + i + 5 * CASE WHEN tile < 7 THEN tile * 5 + j WHEN tile < 10 THEN 35 + 3 * j + tile - 7 ELSE 50 + 3 * j + tile - 10 END AS pos,
    CAST(CAST(value AS FLOAT) AS DOUBLE) AS v FROM rec WHERE value IS NOT NULL),
scaled AS (SELECT var, step, pos, v, CAST(floor(log2(v)) AS BIGINT) AS e0 FROM placed),
exact AS (SELECT var, step, pos, v, CASE WHEN v < pow(2, e0) THEN e0 - 1 WHEN v >= pow(2, e0 + 1) THEN e0 + 1 ELSE e0 END AS e FROM scaled),
bits AS (SELECT var, step, pos, printf('%08x', (e + 127) * 8388608 + CAST((v / pow(2, e) - 1) * 8388608 AS BIGINT)) AS hex FROM exact),
files AS (SELECT DISTINCT var, step FROM rec),
payload AS (
  SELECT f.var, f.step, string_agg(coalesce(hex, 'c61c3c00'), '' ORDER BY f.pos) AS hex
  FROM (SELECT var, step, unnest(range(650)) AS pos FROM files) f LEFT JOIN bits b ON f.var = b.var AND f.step = b.step AND f.pos = b.pos GROUP BY f.var, f.step)
SELECT var, step, CAST(length(hex) // 2 AS BIGINT) AS payload_bytes, sha256(unhex(hex)) AS payload_sha256 FROM payload
""",
)
def snk_2(t):
    """Record files with their sizes and the digests of their bytes."""
    manifest = B.write_records(records(t), shared_folder(t.spark, "records"), FIELD_N, LEVELS)
    part = F.split("file", r"\.")
    return manifest.select(part[0].alias("var"), part[1].alias("step"), F.col("bytes").alias("payload_bytes"), F.col("sha256").alias("payload_sha256"))


@query(
    "snk_3",
    """
SELECT short_name, regexp_extract(url, '[^/]*$') AS file_name,
  '{"title":"' || stem || '","time_coverage_start":"' || strftime(time_start, '%Y-%m-%dT%H:%M:%S') || '","time_coverage_end":"' || strftime(time_end, '%Y-%m-%dT%H:%M:%S')
  || '","time_coverage_duration":"' || CASE period WHEN 'mon_mean' THEN 'P1M' WHEN 'day_mean' THEN 'P1D' ELSE 'P0S' END || '"}' AS entry
FROM gran
""",
)
def snk_3(t):
    duration = F.when(F.col("period") == "mon_mean", "P1M").when(F.col("period") == "day_mean", "P1D").otherwise("P0S")
    return K.manifest_rows(t.granules().withColumn("title", F.col("stem")).withColumn("duration", duration))


@query(
    "snk_4",
    """
SELECT p_name AS name, p_name || ' of ' || p_type AS long_name, CASE WHEN p_size % 2 = 0 THEN 'size ' || p_size ELSE '' END AS comments, 'm' AS units, p_size || 'D' AS dimension FROM part
""",
)
def snk_4(t):
    """Tab-separated documentation, written and read back."""
    path = shared_folder(t.spark, "documentation")
    size = F.col("p_size").cast("string")
    variables = t.table("part").select(
        F.col("p_name").alias("name"), F.concat_ws(" of ", "p_name", "p_type").alias("long_name"),
        F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("size "), size)).alias("comments"), F.lit("m").alias("units"),
        F.concat(size, F.lit("D")).alias("dimension"),
    )
    K.write_documentation(variables, path)
    stored = t.spark.read.option("sep", "\t").option("header", True).csv(path)
    return stored.withColumn("comments", F.coalesce("comments", F.lit("")))


@query(
    "snk_6",
    """
SELECT dataset, var, min(value) AS valid_min, max(value) AS valid_max, 'native' AS grid, 'daily' AS time_type, 'valid_minmax_' || dataset || '_native_daily' AS name
FROM field GROUP BY dataset, var
""",
)
def snk_6(t):
    """Ranges of a product's granules: the second update scans the granules of the last month only."""
    from ..plans import ranges as N

    field, granules, store = t.field(), shared_folder(t.spark, "granules"), shared_folder(t.spark, "range-store")
    dated = field.withColumn("year_month", F.date_format("time", "yyyy-MM"))
    last = dated.agg(F.max("year_month")).first()[0]
    for some in (F.col("year_month") < last, F.col("year_month") == last):
        dated.filter(some).write.mode("append").partitionBy("year_month").parquet(granules)
        N.update(t.spark, store, granules, ["dataset", "var"])
    path = shared_folder(t.spark, "ranges")
    K.write_ranges(N.current(t.spark, store, granules, ["dataset", "var"]), path, "native", "daily")
    return t.spark.read.parquet(path)


@query("snk_7", "SELECT id, short_name, title, string_split(summary, ' Marker')[1] || ' Second part.' AS summary FROM meta")
def snk_7(t):
    """Summaries, written as JSON and read back."""
    path = shared_folder(t.spark, "summaries")
    K.write_summary(t.metadata().withColumnRenamed("summary", "description"), path, " Marker", " Second part.")
    return t.spark.read.schema("id string, short_name string, title string, summary string").json(path)


@query(
    "snk_8",
    """
SELECT target_id, k, source_id, round(dist, 3) AS dist, is_fallback FROM celledges
""",
)
def snk_8(t):
    """Mapping factors: the first call computes and stores them, the second reads the stored table."""
    from ..plans.products import level_edges

    path, longest = shared_folder(t.spark, "mapping"), 800000.0
    native, target = t.native_grid(), t.target()
    made_from = {"native": native, "target": target}
    K.stored_or_computed(t.spark, path, lambda: level_edges(native, target, longest), made_from, longest=longest)

    def refuse():
        raise RuntimeError("the stored factors were not found")

    return K.stored_or_computed(t.spark, path, refuse, made_from, longest=longest).withColumn("dist", r3("dist"))


@query(
    "snk_9",
    """
SELECT url, stem || '_' || period || '_' || CASE period WHEN 'mon_mean' THEN strftime(gdate, '%Y-%m') WHEN 'day_mean' THEN strftime(gdate, '%Y-%m-%d')
  ELSE strftime(gdate, '%Y-%m-%dT000000') END || '_MODEL_V1_g.nc' AS name FROM gran
""",
)
def snk_9(t):
    code = F.when(F.col("period") == "mon_mean", "AVG_MON").when(F.col("period") == "day_mean", "AVG_DAY").otherwise("SNAPSHOT")
    return t.granules().select("url", K.granule_name(F.col("stem"), code, F.col("time_start"), F.lit("MODEL_V1_g.nc")).alias("name"))

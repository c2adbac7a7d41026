"""Radius mapping, fallback and bin reductions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import regrid as R
from ..operators import select as S
from ..operators import windows as W
from ..operators.scale import range_rank
from ..plans import medians as M
from ..session import shared_folder, stored
from .registry import query
from .text import day, r3, r7

LONGEST = 400000.0

RANKED = """
SELECT target_id, source_id, dist, row_number() OVER (PARTITION BY target_id ORDER BY dist, source_id) AS rank
FROM inside
"""

CLOSEST = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY dist, source_id) AS rn FROM nearest400)
WHERE rn = 1
"""


def reduced_sql(operation: str) -> str:
    return f"""
WITH core AS (SELECT target_id, count(*) AS n, {operation} AS v FROM inside GROUP BY target_id),
     closest AS ({CLOSEST})
SELECT c.target_id, round(CASE WHEN core.n > 0 THEN core.v ELSE c.value END, 7) AS value,
       coalesce(core.n, 0) AS n_source, core.n IS NULL AS is_fallback
FROM closest c LEFT JOIN core USING (target_id)
"""


@query("jn_1", f"SELECT target_id, source_id, round(dist, 3) AS dist, rank FROM ({RANKED})")
def jn_1(t):
    pairs = range_rank(R.radius_pairs(t.obs(), t.target()), ["dist", "source_id"], "rank", keys=["target_id"])
    return pairs.select("target_id", "source_id", r3("dist").alias("dist"), "rank")


@query("jn_2", f"SELECT target_id, source_id, round(dist, 3) AS dist FROM ({CLOSEST})")
def jn_2(t):
    return R.nearest_pairs(t.obs(), t.target(), LONGEST).select("target_id", "source_id", r3("dist").alias("dist"))


@query(
    "jn_3",
    f"""
WITH ranked AS ({RANKED}), closest AS ({CLOSEST}),
     edges AS (
       SELECT target_id, source_id, false AS is_fallback FROM ranked
       UNION ALL
       SELECT target_id, source_id, true FROM closest WHERE target_id NOT IN (SELECT target_id FROM ranked))
SELECT target_id, strftime(ts, '%Y-%m-%d') AS day, var, round(avg(value), 7) AS value,
       count(*) AS n_source, bool_or(is_fallback) AS is_fallback
FROM edges JOIN obs USING (source_id) GROUP BY target_id, strftime(ts, '%Y-%m-%d'), var
""",
)
def jn_3(t):
    obs = t.obs()
    edges = R.mapping_edges(obs, t.target(), LONGEST)
    field = obs.select("source_id", day("ts").alias("day"), "var", "value")
    out = R.apply_mapping(edges, field, "nanmean", group=("day", "var"))
    return out.withColumn("value", r7("value"))


@query(
    "jn_4",
    """
SELECT target_id, round(CASE WHEN ("row" + col) % 4 <> 0 THEN v END, 7) AS value
FROM (SELECT target_id, avg(value) AS v FROM inside GROUP BY target_id) JOIN target USING (target_id)
""",
)
def jn_4(t):
    target = t.target()
    mask = target.select("target_id", ((F.col("row") + F.col("col")) % 4 != 0).alias("mask"))
    mapped = R.regrid_points(t.obs(), target, "nanmean")
    return S.apply_mask(mapped, mask, ["target_id"]).select("target_id", r7("value").alias("value"))


def _reduce(t, operation):
    out = R.regrid_points(t.obs(), t.target(), operation, longest=LONGEST)
    return out.withColumn("value", r7("value"))


@query("ag_1", reduced_sql("CASE WHEN count(value) = count(*) THEN avg(value) END"))
def ag_1(t):
    return _reduce(t, "mean")


@query("ag_2", reduced_sql("avg(value)"))
def ag_2(t):
    return _reduce(t, "nanmean")


@query("ag_3", reduced_sql("CASE WHEN count(value) = count(*) THEN median(value) END"))
def ag_3(t):
    return _reduce(t, "median")


@query("ag_4", reduced_sql("median(value)"))
def ag_4(t):
    return _reduce(t, "nanmedian")


@query(
    "ag_3_stored",
    """
SELECT target_id, count(*) AS n_rows, count(value) AS n_present,
       CASE WHEN count(value) = count(*) THEN round(median(value), 7) END AS median, round(median(value), 7) AS nanmedian
FROM inside GROUP BY target_id
""",
)
def ag_3_stored(t):
    """Both medians of the sources in reach, kept for a growing archive: the second update scans the last day's granules only."""
    granules, store, keys = shared_folder(t.spark, "mapped"), shared_folder(t.spark, "median-store"), {"target_id": "long"}
    mapped = R.radius_pairs(t.obs(), t.target(), carry=["value", "ts"]).withColumn("day", F.to_date("ts"))
    mapped = stored(mapped.select("target_id", "value", "day"), "mapped-sources")
    last = mapped.agg(F.max("day")).first()[0]
    for some in (F.col("day") < last, F.col("day") == last):
        mapped.filter(some).repartition("day").write.mode("append").partitionBy("day").parquet(granules)
        M.update(t.spark, store, granules, keys)
    return M.current(t.spark, store, granules, keys).withColumns({c: r7(c) for c in ("median", "nanmedian")})


@query(
    "ag_5",
    f"""
WITH n AS (SELECT target_id, count(*) AS n FROM inside GROUP BY target_id)
SELECT target_id, round(value, 7) AS value, coalesce(n, 0) AS n_source, n IS NULL AS is_fallback
FROM ({CLOSEST}) LEFT JOIN n USING (target_id)
""",
)
def ag_5(t):
    return _reduce(t, "nearest")


@query(
    "ag_6",
    """
SELECT t.target_id, coalesce(n, 0) AS n_source
FROM target t LEFT JOIN (SELECT target_id, count(*) AS n FROM inside GROUP BY target_id) USING (target_id)
""",
)
def ag_6(t):
    return R.source_counts(t.obs(), t.target())


@query("wn_2", f"SELECT target_id, source_id, round(dist, 3) AS dist, rank FROM ({RANKED}) WHERE rank <= 5")
def wn_2(t):
    pairs = R.radius_pairs(t.obs(), t.target())
    return W.nearest_sources(pairs, 5).select(
        "target_id", "source_id", r3("dist").alias("dist"), F.col("rank").cast("long").alias("rank")
    )

"""Plans a cluster would want: pushdown, pruning, no pairwise joins, co-located mapping."""

import pytest
from pyspark.sql import functions as F

from tidelattice.operators import aggregate as A
from tidelattice.operators import regrid as R
from tidelattice.operators import select as S
from tidelattice.operators import windows as W
from tidelattice.operators.scale import dimension
from tidelattice.plans import products as P
from tidelattice.session import shared_folder
from tidelattice.sources import sinks as K
from tidelattice.sources.derived import Tables

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, FOLDER)


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_time_range_and_columns_reach_the_scan(spark, tmp_path, tables):
    tables.field().write.parquet(str(tmp_path / "f"))
    out = S.between_days(spark.read.parquet(str(tmp_path / "f")), "2000-01-05", "2000-01-06").select("var", "value")
    text = plan(out)
    assert "GreaterThanOrEqual(time" in text and "LessThan(time" in text
    assert "ReadSchema: struct<time:timestamp,var:string,value:double>" in text


def test_no_pairwise_joins(tables):
    t = tables
    for df in (
        P.latlon_values(A.monthly_mean(t.field(), ["k", "tile", "j", "i", "var"]), t.native_grid(), t.target(), 8e5, ["month", "var"]),
        P.native_product(t.field(), t.mask(), "V0:SSH", ["SSH", "V1", "V2"], F.lit("AVG_DAY"), "1992-01-01 12:00:00", "2018-01-01")[0],
        P.observation_records(t.obs(), t.target(), "2024-01-01", "2024-01-31", 4e5),
    ):
        assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)


def test_top_rows_are_limited_before_the_shuffle(tables):
    ends = W.ends(tables.granules(), ["short_name"], ["url"], 2)
    assert plan(ends).count("WindowGroupLimit") >= 2


def test_anomaly_does_not_shuffle_its_rows(spark, tmp_path, tables):
    tables.series().write.parquet(str(tmp_path / "s"))
    text = plan(A.anomaly(spark.read.parquet(str(tmp_path / "s")), ["var"]))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_dimension_is_broadcast_only_when_small(spark):
    big, small = spark.range(1000).toDF("a"), spark.range(100).toDF("a")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(big.join(dimension(small), "a"))
        assert "SortMergeJoin" in plan(big.join(dimension(small, max_rows=10), "a"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_mapping_joins_without_a_shuffle(spark, tmp_path, tables):
    edges = P.level_edges(tables.native_grid(), tables.target(), 8e5)
    placed = tables.field().join(tables.native_grid().select("k", "tile", "j", "i", "source_id"), ["k", "tile", "j", "i"])
    keys = ["k", "source_id"]
    want = R.apply_mapping(edges, placed, "nanmean", ("time", "var"), keys).agg(F.count("value"), F.round(F.sum("value"), 3)).first()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        e = K.write_bucketed(edges, "mapping_edges", str(tmp_path / "e"), keys, 4)
        f = K.write_bucketed(placed, "placed_field", str(tmp_path / "f"), keys, 4)
        joined = plan(e.join(f, keys))
        assert "SortMergeJoin" in joined and "Exchange" not in joined
        got = R.apply_mapping(e, f, "nanmean", ("time", "var"), keys).agg(F.count("value"), F.round(F.sum("value"), 3)).first()
        assert tuple(got) == pytest.approx(tuple(want))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS mapping_edges")
        spark.sql("DROP TABLE IF EXISTS placed_field")


def test_skewed_join_is_split(spark):
    """A key with a third of all rows is split by the session's adaptive settings."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = spark.range(60000).select(
            F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("source_id"), F.rand(1).alias("value"),
            F.lit("t").alias("time"), F.lit("v").alias("var"),
        )
        edges = spark.range(-1, 60000).select(F.col("id").alias("source_id"), (F.col("id") % 50).alias("target_id"), F.lit(1.0).alias("dist"), F.lit(False).alias("is_fallback"))
        out = R.apply_mapping(edges, rows, "nanmean")
        assert out.agg(F.sum("n_source")).first()[0] == 60000
        out.collect()
        assert "skew=true" in plan(out)
    finally:
        for key in settings:
            spark.conf.unset(key)

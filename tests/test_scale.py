"""Blocked operators against pandas, with one group holding most rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidelattice.operators import scale as S
from tidelattice.operators import windows as W


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    key = np.where(rng.uniform(size=3000) < 0.5, "hot", rng.choice(list("abcdef"), 3000))
    pdf = pd.DataFrame({"key": key, "pos": np.arange(3000), "value": rng.integers(0, 50, 3000).astype(float)})
    pdf.loc[rng.uniform(size=3000) < 0.3, "value"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("value", F.when(~F.isnan("value"), F.col("value")))
    return pdf, df


@pytest.mark.parametrize("block", [1, 7, 1000, 100000])
def test_running_sum_and_ordinal(spark, table, block):
    pdf, df = table
    df = df.withColumn("value", F.coalesce("value", F.lit(0.0)))
    got = S.running_sum(df, ["key"], ["pos"], "value", F.floor(F.col("pos") / block), "total")
    got = S.ordinal(got, ["key"], ["pos"], F.floor(F.col("pos") / block), "n").toPandas().sort_values("pos")
    filled = pdf.assign(value=pdf.value.fillna(0.0))
    assert np.allclose(got.total.to_numpy(), filled.groupby("key").value.cumsum().to_numpy())
    assert (got.n.to_numpy() == pdf.groupby("key").cumcount().to_numpy() + 1).all()


@pytest.mark.parametrize("block", [1, 13, 100000])
@pytest.mark.parametrize("current", [True, False])
def test_carry_forward(spark, table, block, current):
    pdf, df = table
    got = S.carry_forward(df, ["key"], "pos", {"last": F.col("value")}, block, current).toPandas().sort_values("pos")
    filled = pdf.groupby("key").value.ffill()
    want = filled if current else filled.groupby(pdf.key).shift(1)
    assert np.array_equal(got["last"].to_numpy(dtype=float), want.to_numpy(), equal_nan=True)


@pytest.mark.parametrize("accuracy", [4, 50, 10_000])
def test_exact_median(spark, table, accuracy):
    pdf, df = table
    got = {r.key: r.middle for r in S.exact_median(df, ["key"], "value", "middle", accuracy).collect()}
    want = pdf.groupby("key").value.median().to_dict()
    assert got == pytest.approx(want)


def test_split_hot_keys_keeps_the_join(spark, table):
    _, df = table
    small = df.select("key").distinct().withColumn("side", F.length("key"))
    big, repeated, keys = S.split_hot_keys(df, small, ["key"], F.col("pos"), rows_per_split=100)
    joined = big.join(repeated, keys)
    assert joined.count() == df.count() == joined.select("pos").distinct().count()
    assert big.filter("key = 'hot'").select(S.SPLIT).distinct().count() > 5


def test_balanced_buckets_equal_ntile(spark):
    for n in (1, 5, 10, 23):
        df = spark.range(n).select(F.lit("x").alias("key"), F.format_string("%04d", "id").alias("name"))
        out = W.balanced_buckets(df, ["key"], ["name"], F.substring("name", 1, 3), 4).orderBy("name").collect()
        sizes = [len(part) for part in np.array_split(np.arange(n), 4)]
        assert [r.bucket for r in out] == [b + 1 for b, size in enumerate(sizes) for _ in range(size)]

"""Medians of a growing product against numpy's, and what an update and a median read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelattice.plans import medians as M

KEYS = {"var": "string", "cell": "int"}


@pytest.fixture(scope="module")
def rows(spark):
    """Two months; NULL keys, ties, a key with nothing present, missing values, and one hot key."""
    frame = spark.range(6000).selectExpr(
        "if(id % 5 = 0, NULL, concat('V', id % 2)) AS var", "if(id % 3 = 0, 0, cast(id % 7 AS int)) AS cell", "cast(id % 2 AS int) AS month",
        "CASE WHEN id % 7 = 6 THEN NULL WHEN id % 97 = 1 THEN double('NaN') WHEN id % 4 = 0 THEN 5.0D ELSE (id * 7919) % 1013 / 8.0D END AS value",
    )
    return frame.unionByName(spark.createDataFrame([("none", 1, 0, None), ("one", 1, 1, -3.5)], frame.schema))


def write(rows, path):
    rows.coalesce(1).write.mode("append").partitionBy("month").parquet(path)


def as_dict(frame):
    return {(r["var"], r["cell"]): (r["n_rows"], r["n_present"], r["median"], r["nanmedian"]) for r in frame.collect()}


def plain(rows):
    out, by_key = {}, {}
    for r in rows.collect():
        by_key.setdefault((r["var"], r["cell"]), []).append(r["value"])
    for key, values in by_key.items():
        there = [v for v in values if v is not None and v == v]
        middle = float(np.median(there)) if there else None
        out[key] = (len(values), len(there), middle if len(there) == len(values) else None, middle)
    return out


def test_second_update_merges(spark, rows, tmp_path):
    granules, store = str(tmp_path / "granules"), str(tmp_path / "store")
    write(rows.filter("month = 0"), granules)
    assert M.update(spark, store, granules, KEYS) == 1
    assert as_dict(M.current(spark, store, granules, KEYS)) == plain(rows.filter("month = 0"))
    write(rows.filter("month = 1"), granules)
    # The first month cannot have been read again: it is not among what the update scans.
    assert M.update(spark, store, granules, KEYS) == 1 and M.update(spark, store, granules, KEYS) == 0
    assert as_dict(M.current(spark, store, granules, KEYS)) == plain(rows)
    # A bracket that is too narrow for a sketch's error changes nothing.
    assert as_dict(M.current(spark, store, granules, KEYS, margin=0.0)) == plain(rows)
    for file in (tmp_path / "granules" / "month=0").glob("*.parquet"):
        file.unlink()
    assert as_dict(M.current(spark, store, granules, KEYS)) == plain(rows.filter("month = 1"))


def test_only_slices_at_the_middle_are_read(spark, tmp_path, monkeypatch):
    granules, store = str(tmp_path / "granules"), str(tmp_path / "store")
    keys = {"var": "string"}
    frame = spark.range(20_000).select(F.lit("T").alias("var"), (F.xxhash64("id") % 100_000).cast("double").alias("value"))
    frame.coalesce(1).write.parquet(granules)
    M.update(spark, store, granules, keys)
    read = []
    values = M._values
    monkeypatch.setattr(M, "_values", lambda *a: read.append(values(*a)) or read[-1])
    got = M.current(spark, store, granules, keys).first()
    assert got["median"] == np.median([r[0] for r in frame.select("value").collect()])
    assert len(read) == 1 and read[0].count() < 20_000 * 3 / M.SLICES
    # A bracket of a wrong place: the key is placed among all its values.
    monkeypatch.setattr(M, "_placed", lambda *a, placed=M._placed: placed(*a[:4], a[4].withColumn("hi", F.col("lo")) if len(read) == 1 else a[4]))
    assert M.current(spark, store, granules, keys).first()["median"] == got["median"] and len(read) == 3


def test_empty_store_and_granules_without_rows(spark, tmp_path):
    granules, store = str(tmp_path / "granules"), str(tmp_path / "store")
    spark.createDataFrame([], "var string, value double").coalesce(1).write.parquet(granules)
    assert M.current(spark, store, granules, {"var": "string"}).count() == 0
    files = M.update(spark, store, granules, {"var": "string"})
    assert M.update(spark, store, granules, {"var": "string"}) == 0 and files <= 1
    assert M.current(spark, store, granules, {"var": "string"}).count() == 0

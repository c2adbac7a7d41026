"""AG-3, AG-4 of a growing product: exact medians from sketches and slices kept per granule.

An update scans the granules that the store has not seen.  Of each granule and
key it keeps a KLL sketch, the counts of present and missing values, and the
distinct values with their counts, dealt by the sketch's own quantiles over
SLICES folders, each with its least and greatest value.

A median merges the sketches of the granules that are there now; the merged
sketch brackets the middle.  Slices below the bracket count as a whole, those
above it do not count, and only folders of slices that meet it are read, where
exact counts place the median.  A sketch errs with a small chance: a key whose
bracket does not hold the middle is placed once more among all its values, so
the result is exact whatever the sketches say.

Granules that are replaced or removed take their values along.  No key and no
granule has to fit a task: sketches merge, and values meet only as counts.  A
NULL key is a key like any other; NaN is missing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.missing import normalise_missing
from ..operators.scale import join_back, running_sum, summary_side
from ..session import stored
from ..sources.files import get, names, opened, put
from .ranges import GRANULE, listed

SLICES = 16
# Size of a sketch: its ranks are off by some 0.3 %; the bracket is twice that wide on either side.
SKETCH_SIZE = 1024
MARGIN = 6.0 / SKETCH_SIZE
# Parts of a bracket whose counts are summed on their own.
BINS = 256


def _runs(store: str) -> list[str]:
    """The runs that count, by their commits."""
    system, root = opened(f"{store}/commits")
    return [json.loads(get(f"{store}/commits/{n}"))["run"] for n in names(system, root) if n.endswith(".json")]


def _kept(spark: SparkSession, store: str, part: str, keys: Mapping[str, str], columns: str) -> DataFrame:
    """Rows (granule, keys, columns, run) of a part of the store; of runs that count."""
    schema = ", ".join(["path string, length long, modified long", *[f"{k} {kind}" for k, kind in keys.items()], columns])
    folders = [f"{store}/{part}/run={run}" for run in _runs(store)]
    reader = spark.read.schema(f"{schema}, run string").option("basePath", f"{store}/{part}")
    return reader.parquet(*folders) if folders else spark.createDataFrame([], f"{schema}, run string")


def _quantiles(sketch: str, ranks: Column) -> Column:
    """Quantiles of a row's sketch; a sketch of nothing has none, and must not be asked even where a filter moves."""
    return F.when(F.col("n_present") > 0, F.kll_sketch_get_quantile_double(sketch, ranks))


def _sketches(spark: SparkSession, store: str, keys: Mapping[str, str]) -> DataFrame:
    return _kept(spark, store, "sketches", keys, "sketch binary, n_present long, n_rows long")


def update(spark: SparkSession, store: str, granules: str, keys: Mapping[str, str], value: str = "value") -> int:
    """Keep sketches and slices of the granules that are new or changed; returns how many there were.

    `keys` names the key columns and their types.
    """
    seen = _sketches(spark, store, keys).select(*GRANULE).distinct()
    fresh = listed(spark, granules).join(seen, list(GRANULE), "left_anti")
    # As many names as the listing that found them: the driver's file index holds them anyway.
    paths = [r["path"] for r in fresh.select("path").collect()]
    if not paths:
        return 0
    run, by = uuid.uuid4().hex, ["path", *keys]
    rows = normalise_missing(spark.read.parquet(*paths), value).select(
        F.col("_metadata.file_path").alias("path"),
        *[F.col(k).cast(kind).alias(k) for k, kind in keys.items()],
        F.col(value).cast("double").alias("value"),
    )
    # Counted once, so a value that recurs meets the later steps once a granule.
    counts = stored(rows.groupBy(*by, "value").agg(F.count(F.lit(1)).alias("n")), "value-counts")
    sketches = rows.groupBy(*by).agg(
        F.kll_sketch_agg_double("value", SKETCH_SIZE).alias("sketch"),
        F.count("value").alias("n_present"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    # A granule without rows is kept too, or it would be scanned again.
    fresh.join(sketches, "path", "left").select(*GRANULE, *keys, "sketch", "n_present", "n_rows").write.parquet(f"{store}/sketches/run={run}")
    own = spark.read.parquet(f"{store}/sketches/run={run}").filter("n_present > 0")
    inner = F.array(*[F.lit(s / SLICES) for s in range(1, SLICES)])
    cuts = own.select(*GRANULE, *keys, _quantiles("sketch", inner).alias("_cuts"))
    dealt = join_back(counts.filter("value IS NOT NULL"), summary_side(cuts, "slice-cuts"), by).withColumn(
        "slice", F.size(F.filter("_cuts", lambda cut: cut <= F.col("value")))
    )
    values = dealt.select(*GRANULE, *keys, "value", "n", "slice")
    values.repartition("slice", "path", F.pmod(F.xxhash64("value"), F.lit(8))).write.partitionBy("slice").parquet(f"{store}/values/run={run}")
    written = spark.read.option("basePath", f"{store}/values/run={run}").parquet(f"{store}/values/run={run}") if own.count() else values
    zones = written.groupBy(*GRANULE, *keys, "slice").agg(F.min("value").alias("low"), F.max("value").alias("high"), F.sum("n").alias("n"))
    zones.write.parquet(f"{store}/zones/run={run}")
    put(f"{store}/commits/{run}.json", json.dumps({"run": run, "granules": len(paths)}).encode())
    return len(paths)


def _values(spark: SparkSession, store: str, keys: Mapping[str, str], wanted: DataFrame) -> DataFrame:
    """The values of the wanted slices; other folders are not listed, let alone read."""
    # At most runs x SLICES names.
    folders = [f"{store}/values/run={r['run']}/slice={r['slice']}" for r in wanted.select("run", "slice").distinct().collect()]
    schema = ", ".join(["path string, length long, modified long", *[f"{k} {kind}" for k, kind in keys.items()]])
    schema += ", value double, n long, run string, slice int"
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{store}/values").parquet(*folders)


def _placed(spark: SparkSession, store: str, keys: Mapping[str, str], zones: DataFrame, brackets: DataFrame) -> DataFrame:
    """(keys, median) of those brackets (keys, n_present, lo, hi) that hold the middle."""
    by = list(keys)
    met = join_back(zones, brackets, by)
    below = met.groupBy(*by).agg(F.sum(F.when(F.col("high") < F.col("lo"), F.col("n")).otherwise(0)).alias("_below"))
    wanted = stored(
        met.filter("high >= lo AND low <= hi").select(*GRANULE, *by, F.col("slice").cast("int").alias("slice"), "run", "lo", "hi"), "slices"
    )
    near = join_back(_values(spark, store, keys, wanted).drop("run"), wanted, [*GRANULE, *by, "slice"]).filter("value <= hi")
    below = below.unionByName(near.filter("value < lo").groupBy(*by).agg(F.sum("n").alias("_below")))
    below = below.groupBy(*by).agg(F.sum("_below").alias("_below"))
    inside = near.filter("value >= lo").groupBy(*by, "lo", "hi", "value").agg(F.sum("n").alias("n"))
    width = F.col("hi") - F.col("lo")
    bin_of = F.when((width > 0) & (width < float("inf")), F.floor((F.col("value") - F.col("lo")) / width * BINS)).otherwise(0)
    summed = running_sum(inside, by, ["value"], "n", bin_of, "_upto")
    counted = join_back(join_back(summed, below, by), brackets.select(*by, "n_present"), by)
    upto = F.col("_upto") + F.col("_below")
    holds = lambda rank: (rank > upto - F.col("n")) & (rank <= upto)
    first, second = F.floor((F.col("n_present") + 1) / 2), F.floor((F.col("n_present") + 2) / 2)
    middle = (F.max(F.when(holds(first), F.col("value"))) + F.max(F.when(holds(second), F.col("value")))) / 2.0
    return counted.groupBy(*by).agg(middle.alias("median")).filter("median IS NOT NULL")


def current(spark: SparkSession, store: str, granules: str, keys: Mapping[str, str], margin: float = MARGIN) -> DataFrame:
    """(keys, n_rows, n_present, median, nanmedian) over the granules that are there now.

    `nanmedian` skips missing values; `median` is missing where one is.
    """
    by, present = list(keys), listed(spark, granules)
    of_present = _sketches(spark, store, keys).join(present, list(GRANULE), "left_semi").filter("n_rows IS NOT NULL")
    merged = of_present.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_present").alias("n_present"),
        F.kll_merge_agg_double(F.when(F.col("n_present") > 0, F.col("sketch")), SKETCH_SIZE).alias("_sketch"),
    )
    merged = stored(merged, "merged-sketches")
    ends = _quantiles("_sketch", F.array(F.lit(max(0.0, 0.5 - margin)), F.lit(min(1.0, 0.5 + margin))))
    brackets = merged.filter("n_present > 0").withColumn("_ends", ends).select(
        *by, "n_present", F.col("_ends")[0].alias("lo"), F.col("_ends")[1].alias("hi")
    )
    zones = _kept(spark, store, "zones", keys, "slice int, low double, high double, n long").join(present, list(GRANULE), "left_semi")
    found = stored(_placed(spark, store, keys, zones, brackets), "medians")
    lost = join_back(brackets, found, by, "left").filter("median IS NULL").select(*by, "n_present")
    if not lost.isEmpty():
        whole = zones.groupBy(*by).agg(F.min("low").alias("lo"), F.max("high").alias("hi"))
        again = stored(join_back(lost, whole, by), "whole-brackets")
        found = found.unionByName(_placed(spark, store, keys, zones, again))
    out = join_back(merged.drop("_sketch"), found, by, "left")
    return out.select(
        *by, "n_rows", "n_present", F.when(F.col("n_present") == F.col("n_rows"), F.col("median")).alias("median"), F.col("median").alias("nanmedian")
    )

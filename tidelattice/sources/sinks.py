"""Product, manifest, documentation and cache writers.

Each sink has a `*_rows` function that shapes the rows, and a writer.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import MODEL_START, period_date, period_label
from ..functions.missing import fill_missing
from .files import get, put

# Fixed value: the default fill of 64-bit and 32-bit floats in the product format.
FLOAT_FILL = 9.969209968386869e36


def product_rows(field: DataFrame, fill: float = FLOAT_FILL) -> DataFrame:
    """SNK-1: stored precision, filled values and whole hours since the model start."""
    hours = F.floor((F.unix_timestamp("time") - F.unix_timestamp(F.lit(MODEL_START))) / 3600)
    return (
        field.withColumn("hours", hours.cast("int"))
        .withColumn("year_month", F.date_format("time", "yyyy-MM"))
        .withColumn("value", fill_missing(F.col("value"), fill).cast("float"))
    )


def write_product(field: DataFrame, path: str, fill: float = FLOAT_FILL) -> None:
    """SNK-1: partitioned by dataset and month, clustered by cell for range pruning.

    Rows of one month are spread over tiles, and a partition that is still too
    large is split when the shuffle is read.
    """
    rows = product_rows(field, fill)
    (
        rows.hint("rebalance", "dataset", "year_month", "tile")
        .sortWithinPartitions("dataset", "year_month", "var", "tile", "k", "j", "i")
        .write.mode("overwrite")
        .partitionBy("dataset", "year_month")
        .option("compression", "zstd")
        .parquet(path)
    )


def manifest_entry() -> Column:
    """SNK-3: the JSON text of one granule."""
    stamp = "yyyy-MM-dd'T'HH:mm:ss"
    return F.to_json(
        F.struct(
            F.col("title"),
            F.date_format("time_start", stamp).alias("time_coverage_start"),
            F.date_format("time_end", stamp).alias("time_coverage_end"),
            F.col("duration").alias("time_coverage_duration"),
        )
    )


def manifest_rows(granules: DataFrame) -> DataFrame:
    """SNK-3: (short_name, file_name, entry) per granule; a dataset is never gathered into one value."""
    return granules.select("short_name", F.substring_index("url", "/", -1).alias("file_name"), manifest_entry().alias("entry"))


def write_manifest(granules: DataFrame, path: str) -> None:
    manifest_rows(granules).write.mode("overwrite").partitionBy("short_name").json(path)


def documentation_rows(variables: DataFrame) -> DataFrame:
    """SNK-4: the documented columns in their order, missing ones empty."""
    cols = ("name", "long_name", "comments", "units", "dimension")
    return variables.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in cols])


def write_documentation(variables: DataFrame, path: str) -> None:
    documentation_rows(variables).write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def range_rows(ranges: DataFrame, grid: str, time_type: str) -> DataFrame:
    """SNK-6: ranges with their composed name and provenance."""
    return ranges.withColumns(
        {
            "grid": F.lit(grid),
            "time_type": F.lit(time_type),
            "name": F.concat_ws("_", F.lit("valid_minmax"), F.col("dataset"), F.lit(grid), F.lit(time_type)),
        }
    )


def write_ranges(ranges: DataFrame, path: str, grid: str, time_type: str) -> None:
    range_rows(ranges, grid, time_type).write.mode("overwrite").partitionBy("grid", "time_type", "dataset").parquet(path)


def summary_rows(catalogue: DataFrame, marker: str, second_part: str) -> DataFrame:
    """SNK-7: text before the marker, then a fixed second part."""
    return catalogue.select(
        "id", "short_name", "title", F.concat(F.split_part(F.col("description"), F.lit(marker), F.lit(1)), F.lit(second_part)).alias("summary")
    )


def write_summary(catalogue: DataFrame, path: str, marker: str, second_part: str) -> None:
    summary_rows(catalogue, marker, second_part).write.mode("overwrite").json(path)


def content_digest(df: DataFrame) -> str:
    """A digest of a frame's rows, in whatever order and files they are: names and types, count, and two sums of row hashes."""
    names = sorted(df.columns)
    halves = [F.sum(F.xxhash64(F.lit(seed), *names).cast("decimal(38,0)")) for seed in (0, 1)]
    count, *sums = df.agg(F.count(F.lit(1)), *halves).first()
    kinds = dict(df.dtypes)
    return hashlib.sha256(json.dumps([[(n, kinds[n]) for n in names], count, [str(s) for s in sums]]).encode()).hexdigest()


def stored_or_computed(
    spark: SparkSession, path: str, compute: Callable[[], DataFrame], made_from: dict[str, DataFrame], **parameters
) -> DataFrame:
    """SNK-8: mapping factors from the cache at `path`, else computed and written once.

    An entry is known by the contents of the frames that it is made from and the
    parameters, so another grid or radius never finds it.  Its rows are written
    to a folder of their own, and only then named by the entry's file: what is
    half written is not seen, and of two writers one wins.  Rows are clustered
    by source, so mapping many fields reads them in join order.
    """
    said = {"frames": {k: content_digest(df) for k, df in sorted(made_from.items())}, "parameters": parameters}
    entry = f"{path}/entries/{hashlib.sha256(json.dumps(said, sort_keys=True).encode()).hexdigest()}.json"
    if get(entry) is None:
        folder = f"rows-{uuid.uuid4().hex}"
        compute().repartition("source_id").sortWithinPartitions("source_id").write.parquet(f"{path}/{folder}")
        put(entry, json.dumps(said | {"folder": folder}).encode())
    return spark.read.parquet(f"{path}/{json.loads(get(entry))['folder']}")


def write_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """SNK-8: a table bucketed and sorted by `keys`.

    Mapping factors and fields stored with the same buckets by (k, source_id)
    join without a shuffle of either side, however often factors are reused.
    """
    df.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)


def granule_name(stem: Column, code: Column, time: Column, tail: Column) -> Column:
    """SNK-9: `stem_period_date_tail`."""
    return F.concat_ws("_", stem, period_label(code)["label"], period_date(time, code), tail)

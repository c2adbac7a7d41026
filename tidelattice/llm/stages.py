"""Written intermediates and checked sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder

# Spark drops a job's shuffle files as soon as the job has ended, not when the driver next collects garbage.
_EARLY_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """Write once to the shared folder and read back: work is not repeated, and no executor's loss undoes it."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    before = spark.conf.get(_EARLY_CLEANUP, None)
    spark.conf.set(_EARLY_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_EARLY_CLEANUP)
        else:
            spark.conf.set(_EARLY_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def small_or_plain(df: DataFrame, weight=None, most: float = 2e6) -> DataFrame:
    """A written frame, broadcast only if its measured weight allows it; otherwise the join is planned as usual.

    The weight is the number of rows, or the sum of a column such as bytes.
    """
    measure = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return F.broadcast(df) if (df.agg(measure).first()[0] or 0) <= most else df


def fixed_sample(df: DataFrame, most: int, *key: str) -> DataFrame:
    """The `most` rows with the least hashes of `key`, the same ones however the table is dealt out.

    A bound on the hash, from the number of rows, leaves few more than these to be sorted.
    """
    share = (most + 8 * most**0.5 + 64) / max(1, df.count())
    hashed = F.xxhash64(*key)
    near = df.filter(hashed < int((share - 0.5) * (1 << 64))) if share < 1 else df
    return near.orderBy(hashed, *key).limit(most)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")

"""Field scans: partitioned datasets, many files as one, and 1-D series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.missing import normalise_missing

FIELD_SCHEMA = (
    "dataset string, time timestamp, k int, tile int, j int, i int, var string, loc string, value double"
)
SERIES_SCHEMA = "time timestamp, var string, value double"


def dataset_folders(spark: SparkSession, base: str, pattern: str = "*.parquet") -> DataFrame:
    """SRC-5: files of every dataset folder below `grid=/time_type=/dataset=`, one row per file.

    The file source lists paths and partition values; contents are pruned away,
    so no file is opened however large it is.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(base)
    return files.select("grid", "time_type", "dataset", "path")


def open_many(spark: SparkSession, *paths: str) -> DataFrame:
    """SRC-6: many files as one field, NaN as NULL; coordinates live once in the grid table."""
    return normalise_missing(spark.read.schema(FIELD_SCHEMA).parquet(*paths), "value")


def open_series(spark: SparkSession, *paths: str) -> DataFrame:
    """SRC-12: 1-D products as (time, var, value), NaN as NULL."""
    return normalise_missing(spark.read.schema(SERIES_SCHEMA).parquet(*paths), "value")

"""Metadata tables: CSV catalogues, JSON lists and stored ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import id_tail


def read_csv_table(spark: SparkSession, path: str, schema: str | None = None, spanning: bool = False) -> DataFrame:
    """SRC-8: a CSV catalogue with a header, read in blocks.

    With `spanning`, quoted fields may span lines; a file then is one task's, because no block can tell where a row begins.
    """
    reader = spark.read.option("header", True).option("multiLine", spanning).option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(path)


def read_json_list(spark: SparkSession, path: str, schema: str | None = None, lines: bool = False) -> DataFrame:
    """SRC-9: one row per element of JSON lists, with the file it came from.

    Fields whose shape differs from row to row may be VARIANT in the schema.  With `lines` a file holds an element a line, and
    is read in blocks; a list that spans lines is one task's.
    """
    reader = spark.read.option("multiLine", not lines)
    frame = (reader.schema(schema) if schema else reader).json(path)
    return frame.withColumn("list_name", F.regexp_extract("_metadata.file_name", r"^(.*)\.json$", 1))


def read_stored_ranges(spark: SparkSession, path: str, pattern: str = "valid_minmax*") -> DataFrame:
    """SRC-13: every stored-range file below `path` whose name fits, keyed by the dataset part of its id."""
    stored = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).parquet(path)
    return ranges_by_dataset(stored)


def ranges_by_dataset(stored: DataFrame) -> DataFrame:
    return stored.select(
        id_tail(F.col("id")).alias("dataset"), "var", F.col("valid_min"), F.col("valid_max")
    )

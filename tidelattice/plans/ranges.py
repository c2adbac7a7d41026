"""P-13: valid ranges of a growing product, kept per granule so that only new granules are scanned.

The store holds one row per granule, key and range.  An update lists the
granules' files, scans those whose path, length or time it has not seen, and
adds their ranges as one run, which counts once its commit file is there.  The
ranges of a product are the least and greatest of its present granules' ranges,
so granules that are replaced or removed take theirs with them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.missing import normalise_missing
from ..operators.aggregate import stored_range, value_range
from ..sources.files import get, names, opened, put

GRANULE = ("path", "length", "modified")


def listed(spark: SparkSession, granules: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, length, modified) of the granule files below a folder; no file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(granules)
    return files.select("path", "length", F.unix_micros("modificationTime").alias("modified"))


def _runs(store: str) -> list[str]:
    """The folders of the runs that count."""
    system, root = opened(f"{store}/commits")
    return [json.loads(get(f"{store}/commits/{n}"))["rows"] for n in names(system, root) if n.endswith(".json")]


def known(spark: SparkSession, store: str, keys: Sequence[str]) -> DataFrame:
    """(granule, keys, valid_min, valid_max) of all runs; a granule without rows has one row with NULL keys."""
    schema = ", ".join(["path string, length long, modified long", *[f"{k} string" for k in keys], "valid_min double, valid_max double"])
    runs = _runs(store)
    return spark.read.schema(schema).parquet(*runs) if runs else spark.createDataFrame([], schema)


def update(spark: SparkSession, store: str, granules: str, keys: Sequence[str], value: str = "value") -> int:
    """Scan the granules that are new or changed; returns how many there were."""
    present = listed(spark, granules)
    fresh = present.join(known(spark, store, keys).select(*GRANULE).distinct(), list(GRANULE), "left_anti")
    # As many names as the listing that found them: the driver's file index holds them anyway.
    paths = [r["path"] for r in fresh.select("path").collect()]
    if not paths:
        return 0
    rows = normalise_missing(spark.read.parquet(*paths), value).select(
        F.col("_metadata.file_path").alias("path"), *[F.col(k).cast("string").alias(k) for k in keys], F.col(value).cast("double").alias("value")
    )
    ranges = value_range(rows, ["path", *keys])
    out = fresh.join(ranges, "path", "left").select(*GRANULE, *keys, "valid_min", "valid_max")
    folder = f"{store}/runs/{uuid.uuid4().hex}"
    out.write.parquet(folder)
    put(f"{store}/commits/{uuid.uuid4().hex}.json", json.dumps({"rows": folder, "granules": len(paths)}).encode())
    return len(paths)


def current(spark: SparkSession, store: str, granules: str, keys: Sequence[str]) -> DataFrame:
    """(keys, valid_min, valid_max) over the granules that are there now, merged from the store."""
    of_present = known(spark, store, keys).join(listed(spark, granules), list(GRANULE), "left_semi")
    return stored_range(of_present.filter(F.coalesce(*keys).isNotNull()), keys)

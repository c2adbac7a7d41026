"""Arrival counts, ingest-once and period products as Structured Streaming queries.

The streams keep no state between batches.  A running result is a table of
mergeable rows in parts, such as months: each batch reduces its own rows, merges
them with the current rows of the parts that it touches, and writes these parts
anew under the batch's number; other parts stay as they are.  Late rows and open
periods are therefore counted whenever they come, and nothing grows but the
table.  Ingest-once keeps the keys that its table does not hold yet.

A batch counts once its commit file is there.  A batch that runs again, after a
lost driver or executor, starts from the same rows as before, so it overwrites
itself and adds nothing twice.  Of every part the last two versions are kept.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources.files import get, names, opened, put

PART, BATCH = "part", "batch"
BUCKETS = 64
VERSIONS = 2


def watch(spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Files that arrive in a folder, as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


@dataclass(frozen=True)
class Running:
    """A running result: rows of a batch are reduced by `partial`, and rows of one key are joined by `merge`.

    Columns whose names begin with `_` are kept in the table but not shown.
    """

    stream: DataFrame
    partial: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    part: Column  # of a partial row: which part of the table holds its key


@dataclass(frozen=True)
class Once:
    """The first arrival of each key; `part` is the part of the table that holds a key, and must follow from it."""

    stream: DataFrame
    keys: tuple[str, ...]
    part: Column


def arrival_counts(stream: DataFrame, key: str) -> Running:
    """ST-1: running count per dataset."""
    return Running(
        stream,
        lambda rows: rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")),
        lambda rows: rows.groupBy(key).agg(F.sum("n").alias("n")),
        _bucket([key]),
    )


def ingest_once(stream: DataFrame, keys: Sequence[str], time: str | None = None, part: Column | None = None) -> Once:
    """ST-2: the first arrival of each key, however late it comes.

    Only the parts of the table that a batch touches are read, so a `part` that
    follows from the key, such as its day, keeps old keys out of the way; the
    default is a hash of the key.  `time` is not read.
    """
    return Once(stream, tuple(keys), _bucket(keys) if part is None else part)


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))


def _means(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    merged = rows.groupBy(*keys).agg(
        F.sum("_sum").alias("_sum"), F.min("valid_min").alias("valid_min"), F.max("valid_max").alias("valid_max"), F.sum("n").alias("n")
    )
    return merged.withColumn("mean", F.col("_sum") / F.nullif(F.col("n"), F.lit(0)))


def _sums() -> list[Column]:
    return [F.sum("value").alias("_sum"), F.min("value").alias("valid_min"), F.max("value").alias("valid_max"), F.count("value").alias("n")]


def running_products(stream: DataFrame, time: str, keys: Sequence[str], width: str, part_format: str = "yyyy-MM") -> Running:
    """ST-3: mean and valid range of every tumbling window; late rows and open windows count."""
    by = ["time_start", "time_end", *keys]

    def partial(rows: DataFrame) -> DataFrame:
        windows = rows.groupBy(F.window(time, width).alias("_w"), *keys).agg(*_sums())
        return windows.select(F.col("_w.start").alias("time_start"), F.col("_w.end").alias("time_end"), *keys, "_sum", "valid_min", "valid_max", "n")

    return Running(stream, partial, lambda rows: _means(rows, by), F.date_format("time_start", part_format))


def monthly_products(stream: DataFrame, time: str, keys: Sequence[str]) -> Running:
    """ST-3: calendar months have no fixed width, so the month is a key of a running aggregate."""
    by = ["month", *keys]
    month = F.date_trunc("month", F.col(time)).alias("month")
    return Running(stream, lambda rows: rows.groupBy(month, *keys).agg(*_sums()), lambda rows: _means(rows, by), F.date_format("month", "yyyy-MM"))


def period_products(stream: DataFrame, time: str, keys: Sequence[str], width: str, delay: str = "1 day") -> DataFrame:
    """Mean and valid range of closed tumbling windows only, final once the watermark passes their end.

    Rows later than `delay` and open windows are left out; `running_products` has them all.
    """
    windows = stream.withWatermark(time, delay).groupBy(F.window(time, width).alias("_w"), *keys)
    return windows.agg(
        F.avg("value").alias("mean"), F.min("value").alias("valid_min"), F.max("value").alias("valid_max"), F.count("value").alias("n")
    ).select(F.col("_w.start").alias("time_start"), F.col("_w.end").alias("time_end"), *keys, "mean", "valid_min", "valid_max", "n")


def _commits(path: str) -> list[int]:
    system, root = opened(f"{path}/_commits")
    return [int(n) for n in names(system, root) if n.isdigit()]


def _committed(path: str) -> int:
    """Number of the last batch that counts, -1 before the first."""
    return max(_commits(path), default=-1)


def _versions(path: str, part: str) -> list[int]:
    """Batches that wrote a part, ascending, whether they count or not."""
    system, root = opened(f"{path}/rows/{PART}={part}")
    return sorted(int(n.removeprefix(f"{BATCH}=")) for n in names(system, root, fs.FileType.Directory))


def _stored_parts(path: str) -> list[str]:
    system, root = opened(f"{path}/rows")
    return [n.removeprefix(f"{PART}=") for n in names(system, root, fs.FileType.Directory)]


def _read(spark: SparkSession, path: str, schema: StructType, parts: Sequence[str], upto: int, every: bool) -> DataFrame:
    """Rows of the given parts: every version up to a batch, or the last of them."""
    found = []
    for part in parts:
        versions = [v for v in _versions(path, part) if v <= upto]
        found += [f"{path}/rows/{PART}={part}/{BATCH}={v}" for v in (versions if every else versions[-1:])]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def _drop(path: str) -> None:
    system, at = opened(path)
    if system.get_file_info(at).type == fs.FileType.Directory:
        system.delete_dir(at)


def _touched(rows: DataFrame) -> list[str]:
    """The parts in a batch: as many as it has months, days or buckets."""
    parts = sorted(r[0] for r in rows.select(PART).distinct().collect())
    odd = [p for p in parts if not re.fullmatch(r"[\w.-]+", p, re.ASCII)]
    if odd:
        raise ValueError(f"a part is named by letters, digits, '.', '_' and '-', not {odd[0]!r}")
    return parts


def writer(spec: Running | Once, path: str) -> Callable[[DataFrame, int], None]:
    """What is done with each batch and its number."""

    def write(batch: DataFrame, number: int) -> None:
        last = _committed(path)
        if number <= last:  # it counted before the query could note it
            return
        spark, work = batch.sparkSession, f"{path}/_work/{number}"
        mine = spec.partial(batch) if isinstance(spec, Running) else batch.dropDuplicates(list(spec.keys))
        named = mine.withColumn(PART, F.coalesce(spec.part.cast("string"), F.lit("none")))
        named.write.mode("overwrite").parquet(work)
        new = spark.read.schema(named.schema).parquet(work)
        touched = _touched(new)
        for part in touched:  # what a run of this batch that did not end has left
            _drop(f"{path}/rows/{PART}={part}/{BATCH}={number}")
        columns = mine.schema
        if isinstance(spec, Running):
            before = _read(spark, path, columns, touched, last, every=False)
            rows = spec.merge(new.drop(PART).unionByName(before))
            rows = rows.withColumn(PART, F.coalesce(spec.part.cast("string"), F.lit("none")))
        else:
            known = _read(spark, path, columns, touched, last, every=True).select(*[F.col(k).alias(f"_k_{k}") for k in spec.keys])
            rows = new.join(known, reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in spec.keys]), "left_anti")
        out = rows.withColumn(BATCH, F.lit(number)).hint("rebalance", PART)
        out.write.partitionBy(PART, BATCH).mode("append").parquet(f"{path}/rows")
        shown = rows.drop(PART).schema
        put(f"{path}/_commits/{number:012d}", json.dumps(shown.jsonValue()).encode())
        _drop(work)
        system, root = opened(f"{path}/_commits")
        for old in sorted(_commits(path))[:-VERSIONS]:
            system.delete_file(f"{root}/{old:012d}")
        if isinstance(spec, Running):
            for part in touched:
                for old in _versions(path, part)[:-VERSIONS]:
                    _drop(f"{path}/rows/{PART}={part}/{BATCH}={old}")

    return write


def _start(spec: Running | Once, path: str) -> StreamingQuery:
    return (
        spec.stream.writeStream.option("checkpointLocation", f"{path}/_state")
        .trigger(availableNow=True)
        .foreachBatch(writer(spec, path))
        .start()
    )


def replace_at(running: Running, path: str) -> StreamingQuery:
    """Keep a running result at a path; stops when all arrived files are read."""
    return _start(running, path)


def append_to(stream: Once | DataFrame, path: str) -> StreamingQuery:
    """Append finished rows to a table of files, exactly once; stops when all arrived files are read."""
    if isinstance(stream, Once):
        return _start(stream, path)
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{path}/_state")
        .option("path", f"{path}/rows")
        .trigger(availableNow=True)
        .start()
    )


def _shown(spark: SparkSession, path: str, every: bool) -> DataFrame:
    last = _committed(path)
    if last < 0:
        raise ValueError(f"no batch has been written to {path}")
    schema = StructType.fromJson(json.loads(get(f"{path}/_commits/{last:012d}")))
    rows = _read(spark, path, schema, _stored_parts(path), last, every)
    return rows.select(*[c for c in rows.columns if not c.startswith("_")])


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The running result at a path: the last version of every part that counts."""
    return _shown(spark, path, every=False)


def ingested(spark: SparkSession, path: str) -> DataFrame:
    """All rows ingested at a path."""
    return _shown(spark, path, every=True)

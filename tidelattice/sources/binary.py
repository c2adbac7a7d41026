"""Flat big-endian records, one file per variable and step, as a Python data source.

A file `var.step.data` holds the levels of one grid snapshot, each in the
compact layout.  Reading plans one task per group of level ranges: a task opens
its files, reads the bytes of its levels and makes Arrow batches of them.
Filters on variable, step and level are pushed down, so files that they rule
out are neither opened nor planned.  Writing streams sorted cells through a
task into a file aside; the commit moves the files of all tasks into place and
lists them, with their sizes and digests, in a manifest.  No task holds a file.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

from ..functions.gridindex import compact_to_tile, tile_to_compact
from .files import opened, put

MISSING = -9999.0
FORMAT = "grid_records"
CELLS = "var string, step long, k long, pos long, value double"
PARTITION_BYTES = 32 << 20
# Opening a file costs as much as reading this many bytes.
OPEN_BYTES = 1 << 18
VALUES_AT_ONCE = 1 << 18
MANIFEST = "file string, bytes long, sha256 string"

_TESTS: dict[type[Filter], Callable] = {
    EqualTo: lambda x, v: x == v,
    In: lambda x, v: x in v,
    GreaterThan: lambda x, v: x > v,
    GreaterThanOrEqual: lambda x, v: x >= v,
    LessThan: lambda x, v: x < v,
    LessThanOrEqual: lambda x, v: x <= v,
    IsNotNull: lambda x, v: True,
}


@dataclass(frozen=True)
class Piece:
    """Levels [first, last) of one file."""

    path: str
    var: str
    step: int
    first: int
    last: int


class RecordPieces(InputPartition):
    def __init__(self, pieces: tuple[Piece, ...]) -> None:
        super().__init__(pieces)


@dataclass
class Written(WriterCommitMessage):
    """What a task has written aside: (staged name, final name, bytes, digest)."""

    files: list[tuple[str, str, int, str]] = field(default_factory=list)


class RecordSource(DataSource):
    """Options: path, n (cells along a tile's edge), dtype, fill, cores, partition_bytes; for writing also levels."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return CELLS

    def reader(self, schema) -> RecordReader:
        return RecordReader(self.options)

    def writer(self, schema, overwrite: bool) -> RecordWriter:
        return RecordWriter(self.options)


class _Layout:
    def __init__(self, options) -> None:
        self.path = options["path"]
        self.level = 13 * int(options["n"]) ** 2
        self.dtype = np.dtype(options.get("dtype", ">f4"))
        self.fill = float(options.get("fill", MISSING))


class RecordReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.layout = _Layout(options)
        self.cores = int(options.get("cores", 1))
        self.most = int(options.get("partition_bytes", PARTITION_BYTES))
        self.tests: list[tuple[str, Callable, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes tests of a file's variable and step and of the level; the rest stays with Spark."""
        for test in filters:
            column = getattr(test, "attribute", ())
            if type(test) in _TESTS and len(column) == 1 and column[0] in ("var", "step", "k"):
                self.tests.append((column[0], _TESTS[type(test)], getattr(test, "value", None)))
            else:
                yield test

    def _passes(self, column: str, value) -> bool:
        return all(test(value, wanted) for name, test, wanted in self.tests if name == column)

    def pieces(self) -> list[Piece]:
        """The level ranges to read, files in order of their names."""
        system, root = opened(self.layout.path)
        width = self.layout.level * self.layout.dtype.itemsize
        out = []
        for info in sorted(system.get_file_info(fs.FileSelector(root)), key=lambda f: f.base_name):
            parts = info.base_name.split(".")
            if info.type != fs.FileType.File or info.base_name[0] in "._" or len(parts) < 3:
                continue
            var, step = parts[0], int(parts[-2])
            if not self._passes("var", var) or not self._passes("step", step):
                continue
            if info.size % width:
                raise ValueError(f"{info.path} has {info.size} bytes, which are no whole levels of {width}")
            levels = [k for k in range(info.size // width) if self._passes("k", k)]
            per_piece = max(1, self.most // width)
            runs = np.split(levels, np.flatnonzero(np.diff(levels) > 1) + 1) if levels else []
            for run in runs:
                for at in range(int(run[0]), int(run[-1]) + 1, per_piece):
                    out.append(Piece(info.path, var, step, at, min(at + per_piece, int(run[-1]) + 1)))
        return out

    def partitions(self) -> Sequence[InputPartition]:
        pieces = self.pieces()
        width = self.layout.level * self.layout.dtype.itemsize
        weights = [(p.last - p.first) * width + OPEN_BYTES for p in pieces]
        # As Spark packs its own file splits: all cores have work, and no task more than its bytes.
        share = min(self.most, max(1, sum(weights) // max(self.cores, 1)))
        groups, room = [], 0
        for piece, weight in zip(pieces, weights):
            if weight > room:
                groups.append([])
                room = share
            groups[-1].append(piece)
            room -= weight
        return [RecordPieces(tuple(g)) for g in groups]

    def read(self, partition: RecordPieces) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no file at all
            return
        level, dtype = self.layout.level, self.layout.dtype
        system, _ = opened(self.layout.path)
        for piece in partition.value:
            with system.open_input_file(piece.path) as data:
                end = piece.last * level
                for at in range(piece.first * level, end, VALUES_AT_ONCE):
                    count = min(VALUES_AT_ONCE, end - at)
                    raw = data.read_at(count * dtype.itemsize, at * dtype.itemsize)
                    values = np.frombuffer(raw, dtype).astype(np.float64)
                    spot = np.arange(at, at + count, dtype=np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.repeat(piece.var, count),
                            pa.repeat(pa.scalar(piece.step, pa.int64()), count),
                            pa.array(spot // level),
                            pa.array(spot % level),
                            pa.array(values, mask=np.isnan(values) | (values == self.layout.fill)),
                        ],
                        names=["var", "step", "k", "pos", "value"],
                    )


class _File:
    """One record on its way out: cells in order, gaps filled."""

    def __init__(self, system: fs.FileSystem, path: str, name: str, layout: _Layout, size: int) -> None:
        self.name, self.path, self.layout, self.size = name, path, layout, size
        self.out, self.digest, self.at = system.open_output_stream(path), hashlib.sha256(), 0

    def _write(self, values: np.ndarray) -> None:
        raw = values.astype(self.layout.dtype).tobytes()
        self.out.write(raw)
        self.digest.update(raw)
        self.at += len(values)

    def add(self, pos: np.ndarray, values: np.ndarray) -> None:
        """Cells in ascending order; each must lie beyond those before."""
        if len(pos) and (pos[0] < self.at or (np.diff(pos) < 1).any()):
            raise ValueError(f"record {self.name} has several rows for one cell")
        if len(pos) and pos[-1] >= self.size:
            raise ValueError(f"record {self.name} has a cell beyond its {self.size} cells")
        done = 0
        while done < len(pos):
            block = np.full(min(VALUES_AT_ONCE, int(pos[-1]) + 1 - self.at), self.layout.fill)
            upto = int(np.searchsorted(pos, self.at + len(block)))
            block[pos[done:upto] - self.at] = values[done:upto]
            done = upto
            self._write(block)

    def close(self) -> tuple[str, str, int, str]:
        while self.at < self.size:
            self._write(np.full(min(VALUES_AT_ONCE, self.size - self.at), self.layout.fill))
        self.out.close()
        return self.path, self.name, self.size * self.layout.dtype.itemsize, self.digest.hexdigest()


class RecordWriter(DataSourceArrowWriter):
    """Writes rows (file, pos, value), sorted by both, all rows of a file in one task."""

    def __init__(self, options) -> None:
        self.layout, self.levels = _Layout(options), int(options["levels"])
        self.job = options.get("job") or uuid.uuid4().hex

    def _staging(self) -> tuple[fs.FileSystem, str, str]:
        system, root = opened(self.layout.path)
        return system, root, f"{root}/_staging-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, _, staging = self._staging()
        done, now = Written(), None
        for batch in iterator:
            runs = pc.run_end_encode(batch.column("file"))
            pos = batch.column("pos").to_numpy()
            values = batch.column("value").to_numpy(zero_copy_only=False)
            values = np.where(np.isnan(values), self.layout.fill, values)
            first = 0
            for name, last in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if now is None or now.name != name:
                    if now:
                        done.files.append(now.close())
                    system.create_dir(staging, recursive=True)
                    # An attempt's own name: a task that runs twice cannot meet itself.
                    now = _File(system, f"{staging}/{uuid.uuid4().hex}", name, self.layout, self.levels * self.layout.level)
                now.add(pos[first:last], values[first:last])
                first = last
        if now:
            done.files.append(now.close())
        return done

    def commit(self, messages: list[Written | None]) -> None:
        system, root, staging = self._staging()
        files = sorted((f for m in messages if m for f in m.files), key=lambda f: f[1])
        if len({f[1] for f in files}) < len(files):
            raise ValueError("two tasks wrote one record")
        system.create_dir(root, recursive=True)
        for staged, name, _, _ in files:
            system.move(staged, f"{root}/{name}")
        lines = [json.dumps({"file": name, "bytes": size, "sha256": digest}) for _, name, size, digest in files]
        put(f"{self.layout.path}/_manifests/{self.job}.json", "\n".join([*lines, ""]).encode())
        if system.get_file_info(staging).type == fs.FileType.Directory:
            system.delete_dir(staging)

    def abort(self, messages: list[Written | None]) -> None:
        system, _, staging = self._staging()
        if system.get_file_info(staging).type == fs.FileType.Directory:
            system.delete_dir(staging)


def _format(spark: SparkSession, n: int, dtype: str) -> dict[str, str]:
    spark.dataSource.register(RecordSource)
    return {"n": str(n), "dtype": dtype, "cores": str(spark.sparkContext.defaultParallelism)}


def read_levels(spark: SparkSession, path: str, n: int, dtype: str = ">f4", **options) -> DataFrame:
    """SRC-7: a folder of record files -> (var, step, k, pos, value); the step is the next-to-last name part."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format(FORMAT).options(**(_format(spark, n, dtype) | {"path": path} | options)).load()


def on_tiles(levels: DataFrame, n: int) -> DataFrame:
    """Rows of `read_levels` as cells (var, step, k, tile, j, i, value); index arithmetic stays in Spark."""
    cell = compact_to_tile(F.floor(F.col("pos") / n), F.pmod(F.col("pos"), F.lit(n)), n)
    return levels.withColumn("cell", cell).select("var", "step", "k", "cell.*", "value")


def read_records(spark: SparkSession, path: str, n: int, dtype: str = ">f4", **options) -> DataFrame:
    """SRC-7 as cells; filters on var, step and k reach the file listing."""
    return on_tiles(read_levels(spark, path, n, dtype, **options), n)


def write_records(
    cells: DataFrame, path: str, n: int, levels: int, keys: Sequence[str] = ("var", "step"), dtype: str = ">f4", fill: float = MISSING
) -> DataFrame:
    """SNK-2: one file per record, cells in compact order and missing ones filled; returns the manifest (file, bytes, sha256).

    A record's cells are sorted in one task and streamed, so neither the grid
    nor the archive has to fit it.  Two rows for one cell of a record are an error.
    """
    spark, job = cells.sparkSession, uuid.uuid4().hex
    spot = tile_to_compact(F.col("tile"), F.col("j"), F.col("i"), n)
    placed = cells.withColumn("_s", spot).select(
        F.concat_ws(".", *[F.col(k).cast("string") for k in keys], F.lit("data")).alias("file"),
        (F.col("k").cast("long") * (13 * n * n) + F.col("_s.row") * n + F.col("_s.col")).alias("pos"),
        F.col("value").cast("double").alias("value"),
    )
    sorted_cells = placed.repartition("file").sortWithinPartitions("file", "pos")
    options = _format(spark, n, dtype) | {"levels": str(levels), "fill": str(fill), "job": job, "path": path}
    sorted_cells.write.format(FORMAT).options(**options).mode("append").save()
    return spark.read.schema(MANIFEST).json(f"{path}/_manifests/{job}.json")

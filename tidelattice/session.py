"""Session defaults and the shared folder used for written intermediates."""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Only engine-neutral settings: sizes are left to the cluster's own configuration.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed partition may be split even when that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Batches for Python are bounded by bytes too: rows may be long texts.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def build_session(app: str = "tidelattice", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; `conf` keys use `__` for a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def apply_defaults(spark: SparkSession) -> SparkSession:
    """The same defaults on a session someone else built."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


@functools.cache
def _local_root() -> str:
    """The folder of a local session, removed when Python ends."""
    root = tempfile.mkdtemp(prefix="tidelattice-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the cluster's shared checkpoint folder.

    A machine-local folder is used only by a local master that names none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = _local_root()
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    Used where a plan would otherwise compute the same frame several times.
    The files outlive any executor, and the reading plan has real statistics.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

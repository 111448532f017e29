"""Session settings the jobs rely on, and the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange behind the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows dealt by file stay where they are for a join by file and number.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Ids and hashes are hexadecimal text: written files take half the disk of the default codec.
    "spark.sql.parquet.compression.codec": "zstd",
    # State of streams lies on disk, and a checkpoint writes what changed.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@cache
def _own_dir() -> str:
    return tempfile.mkdtemp(prefix="ratelake-")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`; in local mode a folder of our own where it is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _own_dir()
    return folder.rstrip("/")


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run, below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Writes in here remove their shuffle files as they end, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def staged(df: DataFrame, folder: str) -> DataFrame:
    """The rows as a written table: computed once however often they are read, and safe from lost executors."""
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)

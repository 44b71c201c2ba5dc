"""Session helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution splits skewed join partitions (even when that costs one more
# shuffle) and turns a join into a broadcast only after it has measured the side.
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # small files still give every core a split
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lotwise")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LOTWISE_DRIVER_MEMORY", "12g"))
    )
    for key, value in {**RUNTIME, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def spread_shuffles(spark: SparkSession, rows: int, task_rows: int = 1 << 19) -> Iterator[None]:
    """While this is open, shuffles start with a partition for each ``task_rows`` of ``rows``.

    A sort or hash table behind a shuffle then holds as much of a large table as of a small one.
    Adaptive execution joins partitions that turn out small. What is only planned here and run later is
    not affected.
    """
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before, parts = spark.conf.get(name, None), rows // task_rows + 1
    if parts <= int(before or spark.conf.get("spark.sql.shuffle.partitions")):
        yield
        return
    spark.conf.set(name, str(parts))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """Fresh path for intermediate tables.

    On a cluster this lies in the shared folder named by ``spark.checkpoint.dir``.
    A machine-local folder is used only where that is unset and Spark runs on one machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="lotwise-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def through_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a scratch table and read it back.

    Cuts the plan where several later branches start from the same result: it is computed
    once and survives the loss of an executor.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """Rows dealt over ``parts`` tasks by ``keys``; left where they are if ``parts`` is None.

    For costly work on each row of a table that is one row group of one file, which no split size
    divides. Tables of many splits need none.
    """
    return df if parts is None else df.repartition(parts, *keys)

"""Sinks. Spark cannot overwrite a path it is reading, so results go to new paths."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.contract import SAMPLE_COLUMNS, SAMPLE_SEED, SAMPLE_SIZES
from lotwise.operators.cleaning import DEFAULT_ORDER, ObservedCleaning, Rules, clean
from lotwise.operators.merge import conform, pick_present
from lotwise.sources.readers import table_or_empty

CLEAN_SAMPLE_ROWS = 60


def encode_json_cells(df: DataFrame) -> DataFrame:
    """Lists, maps, structs and VARIANT cells as JSON text, for flat formats."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    names = [field.name for field in df.schema if isinstance(field.dataType, nested)]
    return df.withColumns({name: F.to_json(F.col(name)) for name in names})


def write_raw(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Raw table in contract order. Nested cells keep their types."""
    conform(df).write.mode(mode).parquet(path)
    return path


def write_clean(
    raw: DataFrame, path: str, rules: Rules, order: Sequence[str] = DEFAULT_ORDER, mode: str = "overwrite"
) -> str:
    """Clean ``raw`` and write the processed table; partitions adapt to the data size."""
    clean(raw, rules, order).write.mode(mode).parquet(path)
    return path


def head_rows(df: DataFrame, key: str = "listing_id", n: int = CLEAN_SAMPLE_ROWS) -> DataFrame:
    """First ``n`` rows by ``key``."""
    return df.orderBy(key).limit(n)


def sample_rows(df: DataFrame, n: int, key: str = "listing_id", seed: int = SAMPLE_SEED) -> DataFrame:
    """Reproducible random sample: the ``n`` rows with the smallest seeded hash of their key.

    Only the human-readable columns are kept. ``n`` must be one of the sample sizes; a
    smaller table is returned whole.
    """
    if n not in SAMPLE_SIZES:
        raise ValueError(f"sample size must be one of {SAMPLE_SIZES}, got {n}")
    shuffled = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return pick_present(df.orderBy(shuffled, F.col(key)).limit(n), SAMPLE_COLUMNS)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """One CSV file with header; for samples of bounded size."""
    encode_json_cells(df).coalesce(1).write.mode(mode).csv(path, header=True, escape='"')
    return path


def write_samples(raw: DataFrame, folder: str) -> list[str]:
    """The 30- and 60-row samples of a raw table."""
    return [write_csv(sample_rows(raw, n), f"{folder.rstrip('/')}/sample_{n}") for n in SAMPLE_SIZES]


HISTORY = "version int, path string, source int"


def publish(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    source: int | None = None,
    check: Callable[[DataFrame], None] = lambda written: None,
) -> str:
    """Write ``df`` as the next snapshot of ``root`` and record it.

    Every attempt writes to a path of its own. The record is appended only after the snapshot is
    complete and ``check`` has passed on it, so readers never see a partial one and a failed
    attempt leaves the current snapshot in place. ``source`` notes the version of the
    table that the snapshot was derived from.
    """
    version = (latest_version(spark, root) or 0) + 1
    path = f"{root}/snapshots/{version:08d}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    check(spark.read.schema(df.schema).parquet(path))
    record = spark.range(1).select(
        F.lit(version).alias("version"), F.lit(path).alias("path"), F.lit(source).cast("int").alias("source")
    )
    record.write.mode("append").parquet(f"{root}/history")
    return path


def publish_clean(
    raw: DataFrame, root: str, rules: Rules, order: Sequence[str] = DEFAULT_ORDER, source: int | None = None
) -> ObservedCleaning:
    """Clean ``raw`` and publish the result as the next snapshot of ``root``, in one job.

    The post-conditions are counted while the rows are written; if one is broken the snapshot is not
    recorded. The returned cleaning has the audit of the rules.
    """
    observed = ObservedCleaning(raw, rules, order)
    publish(raw.sparkSession, observed.rows, root, source, lambda written: observed.require(written.columns))
    return observed


def snapshots(spark: SparkSession, root: str) -> DataFrame:
    """Version, path and source of all published snapshots."""
    return table_or_empty(spark, f"{root}/history", HISTORY)


def _latest(spark: SparkSession, root: str) -> Row:
    """Version, path and source of the newest record, nulls when there is none."""
    history = snapshots(spark, root)
    newest = F.max(F.struct("version", "path", "source")).alias("newest")
    return history.agg(newest).select("newest.version", "newest.path", "newest.source").first()


def latest_version(spark: SparkSession, root: str) -> int | None:
    return _latest(spark, root).version


def latest_source(spark: SparkSession, root: str) -> int | None:
    """Version of the table that the current snapshot was derived from."""
    return _latest(spark, root).source


def current_snapshot(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Latest published snapshot, empty when there is none; a recorded one must exist."""
    path = _latest(spark, root).path
    return spark.createDataFrame([], schema) if path is None else spark.read.schema(schema).parquet(path)

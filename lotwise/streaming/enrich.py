"""Resumable detail enrichment: landed pages -> detail log -> listings with details.

Details are appended per micro-batch; the checkpoint remembers which pages were read, so an
interrupted run continues where it stopped. A run with a limit leaves the pages it does not
take in a waiting table, and the next run takes them first: no landed page is lost.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lotwise.contract import RAW
from lotwise.operators.dedup import keep_last
from lotwise.operators.joins import only_new
from lotwise.operators.merge import ALWAYS_SET, SET_IF_PRESENT, apply_details
from lotwise.operators.pages import extract_details
from lotwise.streaming.batches import FAN_IN, BatchTable
from lotwise.streaming.sync import stored_listings

PAGES_PER_FILE_BATCH = 50

PAGE = "listing_id string, html string, landed_at timestamp, file string"
WAITING = f"{PAGE}, batch bigint"
_MOMENT = ("landed_at", "file")

DETAIL_LOG = T.StructType(
    [
        T.StructField("listing_id", T.StringType()),
        T.StructField("matched", T.BooleanType()),
        *[RAW[name] for name in [*ALWAYS_SET, *SET_IF_PRESENT]],
        T.StructField("landed_at", T.TimestampType()),
        T.StructField("file", T.StringType()),
        T.StructField("batch", T.LongType()),
    ]
)


@dataclass
class Run:
    """What is left of a run's limit (None: no limit) and how many ids it has enriched."""

    left: int | None = None
    enriched: int = 0


def details_path(store: str) -> str:
    return f"{store.rstrip('/')}/details"


def waiting_path(store: str) -> str:
    return f"{store.rstrip('/')}/waiting"


def details_table(store: str) -> BatchTable:
    return BatchTable(details_path(store), DETAIL_LOG)


def waiting_table(store: str) -> BatchTable:
    return BatchTable(waiting_path(store), WAITING)


def detail_log(spark: SparkSession, store: str) -> DataFrame:
    return details_table(store).read(spark)


def _still_waiting(pages: DataFrame, log: DataFrame) -> DataFrame:
    """Pages that no batch has taken since they were left."""
    taken = log.groupBy("listing_id").agg(F.max(F.struct(*_MOMENT)).alias("_taken"))
    left = pages.join(taken, "listing_id", "left")
    return left.filter(F.col("_taken").isNull() | (F.struct(*_MOMENT) > F.col("_taken"))).select(*pages.columns)


def waiting_pages(spark: SparkSession, store: str) -> DataFrame:
    """Pages that earlier runs left because of their limit and that no later run has taken."""
    return _still_waiting(waiting_table(store).read(spark).drop("batch"), detail_log(spark, store))


def enrich_batch(
    pages: DataFrame,
    batch_id: int,
    store: str,
    force: bool = False,
    run: Run | None = None,
    keep_rest: bool = True,
    fan_in: int = FAN_IN,
) -> int:
    """Extract one batch of pages into the detail log; returns how many ids got a usable page.

    ``pages`` has ``listing_id`` and ``html`` and, where known, ``landed_at`` and ``file``. Ids
    that already have a usable page are skipped unless ``force``. Of several pages of an id the
    usable one that landed last counts, so a blocked page never replaces a good one. The
    run's limit takes the first ids; pages of the others are kept waiting. ``fan_in`` finished
    batches are folded into one, without the waiting pages that have been taken.
    """
    spark, run = pages.sparkSession, run or Run()
    for name, kind in (("landed_at", "timestamp"), ("file", "string")):
        if name not in pages.columns:
            pages = pages.withColumn(name, F.lit(None).cast(kind))
    pages = pages.select("listing_id", "html", *_MOMENT)
    if not force:
        done = detail_log(spark, store).filter((F.col("batch") < batch_id) & F.col("matched")).select("listing_id")
        pages = only_new(pages, done, "listing_id")
    if run.left is not None:
        first = pages.select("listing_id").distinct().orderBy("listing_id").limit(run.left)
        first = spark.createDataFrame(first.collect(), "listing_id string")  # at most the caller's limit
        if keep_rest:
            rest = pages.join(first, "listing_id", "left_anti")
            waiting_table(store).write(rest, batch_id)
        pages = pages.join(first, "listing_id", "left_semi")
    columns = [name for name in DETAIL_LOG.fieldNames() if name != "batch"]
    details = extract_details(pages, keep=_MOMENT).select(*columns)
    best = keep_last(details, "listing_id", ["matched", *_MOMENT])
    path = details_table(store).write(best, batch_id)
    found, taken = spark.read.parquet(path).agg(F.count_if("matched"), F.count(F.lit(1))).first()
    run.enriched += found
    if run.left is not None:
        run.left -= taken
    details_table(store).fold(spark, batch_id, fan_in)
    waiting_table(store).fold(spark, batch_id, fan_in, lambda rows: _still_waiting(rows, detail_log(spark, store)))
    return found


def take_waiting(spark: SparkSession, store: str, run: Run, force: bool = False) -> int:
    """Enrich waiting pages within the run's limit; batches of their own, numbered downwards."""
    if waiting_pages(spark, store).isEmpty():
        return 0
    lowest = detail_log(spark, store).agg(F.min("batch")).first()[0]
    return enrich_batch(waiting_pages(spark, store), min(lowest or 0, 0) - 1, store, True, run, keep_rest=False)


def start_enrichment(
    spark: SparkSession,
    landing: str,
    store: str,
    checkpoint: str,
    force: bool = False,
    limit: int | None = None,
    files_per_batch: int = PAGES_PER_FILE_BATCH,
    run: Run | None = None,
    fan_in: int = FAN_IN,
) -> StreamingQuery:
    """Process landed Parquet files of ``(listing_id, html)`` and stop when caught up.

    ``limit`` bounds the ids that this run takes, over all its batches; what it leaves is taken
    by later runs. ``run`` tells afterwards how many ids this run enriched.
    """
    state = run or Run()
    state.left = limit
    take_waiting(spark, store, state, force)
    pages = (
        spark.readStream.schema("listing_id string, html string")
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
        .select(
            "listing_id",
            "html",
            F.col("_metadata.file_modification_time").alias("landed_at"),
            F.col("_metadata.file_path").alias("file"),
        )
    )

    def process(batch: DataFrame, batch_id: int) -> None:
        enrich_batch(batch, batch_id, store, force, state, fan_in=fan_in)

    return (
        pages.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_details(spark: SparkSession, store: str) -> DataFrame:
    """The usable page per listing that landed last."""
    usable = detail_log(spark, store).filter("matched")
    return keep_last(usable, "listing_id", [*_MOMENT, "batch"]).drop("batch", *_MOMENT)


def enriched_listings(spark: SparkSession, store: str) -> DataFrame:
    """Stored listings with their details written in."""
    listings = stored_listings(spark, store).select(*RAW.fieldNames())
    return apply_details(listings, latest_details(spark, store))


def enriched_count(spark: SparkSession, store: str) -> DataFrame:
    """One row: number of stored listings that have a usable page."""
    ids = detail_log(spark, store).filter("matched").select("listing_id").distinct()
    return stored_listings(spark, store).join(ids, "listing_id", "left_semi").agg(F.count(F.lit(1)).alias("enriched"))

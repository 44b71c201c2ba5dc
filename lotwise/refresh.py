"""One refresh of a listings store from a batch of landed feed pages.

The store is a folder with the raw table in buckets (``raw/``), published snapshots of the clean table
(``clean/``), quarantined items (``rejects/``), pages that could not be read (``dead-letters/``) and CSV
samples (``samples/``).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.contract import CLEAN, RAW_COLUMNS
from lotwise.functions.times import instant
from lotwise.functions.variants import at
from lotwise.operators import market, profiling
from lotwise.operators.cleaning import Rules
from lotwise.operators.dedup import keep_first
from lotwise.operators.feed import accepted, explode_envelopes, map_items, parsed_pages, rejected
from lotwise.session import through_table
from lotwise.sources import bucket_store, readers, writers
from lotwise.streaming.sync import numbered_letters


@dataclass
class Refresh:
    """What a refresh produced; ``raw`` and ``clean`` are stored tables."""

    caught_up: bool
    raw: DataFrame
    clean: DataFrame

    def quality(self) -> DataFrame:
        return profiling.quality_gate(self.raw)

    def completeness(self) -> DataFrame:
        return profiling.completeness(self.raw)

    def brands(self) -> DataFrame:
        return market.processed_summary(self.clean)

    def summary(self, as_of: Column) -> DataFrame:
        return market.market_summary(self.clean, instant(F.col("scraped_at")), as_of)

    def freshness(self, as_of: Column) -> DataFrame:
        return market.freshness(self.clean, instant(F.col("scraped_at")), as_of)


def refresh(
    spark: SparkSession,
    landing: str,
    store: str,
    rules: Rules,
    scraped_at: str,
    url_prefix: str,
    whole_files: bool = False,
    layout: bucket_store.Layout | None = None,
) -> Refresh:
    """Add the listings of ``landing`` that the store does not have yet, then clean and sample.

    Only the buckets of the raw table that the landed ids fall into are read and rewritten. When
    nothing is new the raw table stays as it is. The clean table is derived whenever it does
    not belong to the current raw version, so a run that failed half-way is made up for by
    the next one. Quarantined items and unreadable pages are kept per landing folder and
    replaced by a retry. ``whole_files`` and ``layout`` as in ``read_feed`` and ``bucket_store.upsert``.
    """
    store = store.rstrip("/")
    raw_root, clean_root = f"{store}/raw", f"{store}/clean"
    landed = hashlib.md5(landing.encode()).hexdigest()
    pages = readers.read_feed(spark, landing, whole_files).drop("envelope")
    parsed = through_table(parsed_pages(pages), "landed-pages")
    letters = numbered_letters(parsed, whole_files)
    letters.write.mode("overwrite").parquet(f"{store}/dead-letters/landing={landed}")
    items = explode_envelopes(parsed.filter("fault is null").drop("fault", "text"))
    items = items.withColumn("_id", at(F.col("payload"), "id", dtype="string"))
    # known items are not mapped again; items without an id are kept for the quarantine
    unseen = bucket_store.only_new(items, raw_root, "_id").drop("_id")
    mapped = through_table(map_items(unseen, rules.as_of_year, F.lit(scraped_at), url_prefix), "mapped")
    rejected(mapped).write.mode("overwrite").parquet(f"{store}/rejects/landing={landed}")
    order = ["_file", "_block", "_line", "position"]
    fresh = through_table(keep_first(accepted(mapped), "listing_id", order).select(*RAW_COLUMNS), "new-listings")
    # an id is read from the item once more when it is mapped, so it is looked up once more
    fresh = bucket_store.only_new(fresh, raw_root)
    caught_up = bucket_store.upsert(fresh, raw_root, ["scraped_at"], layout=layout) is None
    version = bucket_store.version(spark, raw_root)
    if version is not None and writers.latest_source(spark, clean_root) != version:
        raw = bucket_store.read(spark, raw_root)
        writers.write_samples(raw, f"{store}/samples")
        writers.publish_clean(raw, clean_root, rules, source=version)
        head = writers.head_rows(writers.current_snapshot(spark, clean_root, CLEAN))
        writers.write_csv(head, f"{store}/samples/clean_60")
    return Refresh(
        caught_up,
        bucket_store.read(spark, raw_root),
        writers.current_snapshot(spark, clean_root, CLEAN),
    )

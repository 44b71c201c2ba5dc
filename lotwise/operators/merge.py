"""Upserts, incremental selection and detail enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.contract import LEGACY_NAMES, RAW
from lotwise.functions.flags import to_bit
from lotwise.operators.dedup import keep_first, keep_last
from lotwise.operators.joins import only_new

# Enrichment columns that overwrite the stored value even when null ...
ALWAYS_SET = """
    description likes_count is_like is_saved listing_available listing_status
    detail_specs raw_detail_payload
""".split()
# ... and those that leave it alone when the page does not state them.
SET_IF_PRESENT = """
    sale_price original_price amount_saved vehicle_model_year vehicle_condition vehicle_tax_type
    vehicle_transmission vehicle_color vehicle_fuel_type vehicle_mileage_km vehicle_brand vehicle_model
""".split()


def conform(df: DataFrame, schema: T.StructType = RAW) -> DataFrame:
    """Contract columns in contract order; absent ones are null, others are dropped."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def pick_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Those of ``names`` that exist, in the order given."""
    return df.select(*[name for name in names if name in df.columns])


def rename_legacy(df: DataFrame) -> DataFrame:
    """Old dataset names to contract names."""
    return df.withColumnsRenamed(LEGACY_NAMES)


def legacy_flags(df: DataFrame, names: Sequence[str] = ("is_like", "is_saved", "listing_available")) -> DataFrame:
    """Booleans of older enrichment runs as 1 / 0 / null."""
    return df.withColumns({name: to_bit(F.col(name)) for name in names if name in df.columns})


def new_listings(batch: DataFrame, stored: DataFrame, position: Sequence[str], key: str = "listing_id") -> DataFrame:
    """First occurrence per id within the batch, without ids that are already stored."""
    return only_new(keep_first(batch, key, position), stored, key)


def upsert(
    old: DataFrame,
    new: DataFrame,
    order: Sequence[str] = (),
    schema: T.StructType = RAW,
    key: str = "listing_id",
) -> DataFrame:
    """Stored rows replaced or extended by new ones, in contract order.

    A new row beats a stored one; within each side the greatest ``order`` wins.
    """
    ranked = [
        conform(side, schema).withColumn("_side", F.lit(rank)) for rank, side in enumerate((old, new))
    ]
    return keep_last(ranked[0].unionByName(ranked[1]), key, ["_side", *order]).drop("_side")


def unenriched(raw: DataFrame, force: bool = False, limit: int | None = None) -> DataFrame:
    """Ids that still need their detail page; ``limit`` takes the first ones by id."""
    waiting = raw
    if not force:
        payload = F.col("raw_detail_payload")
        text = payload if isinstance(raw.schema["raw_detail_payload"].dataType, T.StringType) else F.to_json(payload)
        waiting = raw.filter(text.isNull() | text.isin("", '""'))
    ids = waiting.select(F.col("listing_id").cast("string").alias("listing_id"))
    return ids if limit is None else ids.orderBy("listing_id").limit(limit)


def apply_details(raw: DataFrame, details: DataFrame, key: str = "listing_id") -> DataFrame:
    """Write page details into the listings they belong to.

    ``details`` has at most one row per id; rows with ``matched = false`` change nothing.
    """
    found = details.filter("matched").select(
        key, *[F.col(name).alias(f"_new_{name}") for name in details.columns if name not in (key, "matched")]
    )
    joined = raw.join(found.withColumn("_found", F.lit(True)), key, "left")
    replaced = {}
    for name in raw.columns:
        fresh = f"_new_{name}"
        if fresh not in found.columns:
            continue
        update = F.col(fresh).cast(raw.schema[name].dataType)
        if name in ALWAYS_SET:
            replaced[name] = F.when(F.col("_found"), update).otherwise(F.col(name))
        else:
            replaced[name] = F.coalesce(update, F.col(name))
    return joined.withColumns(replaced).select(*raw.columns)

"""Table contracts of the listings data model.

``RAW`` is the 54-column record every ingest step produces; ``CLEAN_COLUMNS`` is
the 34-column subset the quality rules hand on. Column order is part of both
contracts.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _B, _I, _L = T.StringType(), T.DoubleType(), T.BooleanType(), T.IntegerType(), T.LongType()
_V, _SS = T.VariantType(), T.ArrayType(T.StringType())


def _columns(dtype: T.DataType, names: str) -> list[T.StructField]:
    return [T.StructField(name, dtype, True) for name in names.split()]


# Names, order and types of the raw record.
RAW = T.StructType(
    _columns(_S, "listing_id listing_title")
    + _columns(_D, "price")
    + _columns(_S, "currency")
    + _columns(_D, "discount_price")
    + _columns(_B, "is_premium")
    + _columns(_S, "category category_slug category_id")
    + _columns(_S, "province province_slug province_id district location_full")
    + _columns(_V, "location_coordinates")
    + _columns(_S, "seller_id seller_name seller_type seller_username seller_avatar_url")
    + _columns(_B, "seller_is_verified")
    + _columns(_S, "seller_store_id")
    + _columns(_SS, "seller_phones")
    + _columns(_S, "seller_telco")
    + _columns(_I, "view_count likes_count")
    + _columns(_B, "is_like is_saved")
    + _columns(_S, "posted_at renewed_at thumbnail_url")
    + _columns(_SS, "image_urls")
    + _columns(_S, "listing_url")
    + _columns(_B, "listing_available")
    + _columns(_S, "listing_status description")
    + _columns(_D, "sale_price original_price amount_saved")
    + _columns(_I, "vehicle_model_year")
    + _columns(_S, "vehicle_condition vehicle_tax_type vehicle_brand vehicle_model")
    + _columns(_L, "vehicle_mileage_km")
    + _columns(_S, "vehicle_fuel_type vehicle_transmission")
    + _columns(_I, "vehicle_engine_cc")
    + _columns(_S, "vehicle_color")
    + _columns(_V, "raw_specs detail_specs raw_feed_payload raw_detail_payload")
    + _columns(_S, "scraped_at")
)
RAW_COLUMNS: list[str] = RAW.fieldNames()

# The processed contract, in order.
CLEAN_COLUMNS: list[str] = """
    listing_id listing_title price currency discount_price is_premium
    category category_slug province province_slug district location_full
    seller_id seller_name seller_type seller_username seller_phones
    view_count posted_at renewed_at thumbnail_url listing_url
    vehicle_model_year vehicle_condition vehicle_tax_type vehicle_brand vehicle_model
    vehicle_mileage_km vehicle_fuel_type vehicle_transmission vehicle_engine_cc vehicle_color
    raw_specs scraped_at
""".split()
CLEAN = T.StructType([RAW[name] for name in CLEAN_COLUMNS])

# Human-readable columns of the CSV samples, in order.
SAMPLE_COLUMNS: list[str] = """
    listing_id listing_title price vehicle_model_year vehicle_condition vehicle_tax_type
    vehicle_brand vehicle_model vehicle_mileage_km vehicle_fuel_type vehicle_transmission
    vehicle_engine_cc vehicle_color province district seller_type view_count
    posted_at scraped_at is_premium listing_url
""".split()
SAMPLE_SIZES = (30, 60)
SAMPLE_SEED = 42

# Names used by older datasets -> contract names (the other 17 are unchanged).
LEGACY_NAMES: dict[str, str] = {
    "id": "listing_id",
    "title": "listing_title",
    "full_location": "location_full",
    "phone_numbers": "seller_phones",
    "views": "view_count",
    "posted_date": "posted_at",
    "renew_date": "renewed_at",
    "product_link": "listing_url",
    "car_year": "vehicle_model_year",
    "car_condition": "vehicle_condition",
    "tax_type": "vehicle_tax_type",
    "mileage_km": "vehicle_mileage_km",
    "fuel_type": "vehicle_fuel_type",
    "transmission": "vehicle_transmission",
    "engine_cc": "vehicle_engine_cc",
    "color": "vehicle_color",
    "specs": "raw_specs",
}

# Quality thresholds.
PRICE_MIN, PRICE_MAX = 500.0, 300_000.0
YEAR_MIN, YEAR_MAX_OFFSET = 1990, 1
GATE_ROWS, GATE_PRICED = 2_000, 1_500
STALE_AFTER_DAYS = 7
SOURCE_UTC_OFFSET = "+07:00"


def columns_of_type(dtype: type[T.DataType]) -> list[str]:
    """Raw columns whose type is an instance of ``dtype``."""
    return [field.name for field in RAW if isinstance(field.dataType, dtype)]


# Nested cells: JSON text on export, native arrays or VARIANT inside Spark.
LIST_COLUMNS = columns_of_type(T.ArrayType)
VARIANT_COLUMNS = columns_of_type(T.VariantType)

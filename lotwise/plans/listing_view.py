"""The driver's star schema seen as raw listings.

``lineitem`` joined with its dimensions plays the listing table: ids repeat, some prices
and years are missing, and category spellings vary, so that every quality rule has work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.contract import CLEAN_COLUMNS, RAW
from lotwise.operators.cleaning import Rules, clean
from lotwise.plans.registry import table
from lotwise.session import through_table

RULES = Rules(as_of_year=1999, price_min=2_000.0, price_max=100_000.0, year_min=1996)
ORDER = ("scraped_at", "l_partkey", "l_suppkey", "l_extendedprice")
AS_OF_YEAR = 2001


def _columns() -> dict[str, Column]:
    flag, number = F.col("l_returnflag"), F.col("l_linenumber")
    has_no_year = (flag == "N") & (number == 7)
    return {
        "listing_id": F.concat_ws("-", "l_orderkey", "l_linenumber"),
        "listing_title": F.col("p_name"),
        "price": F.when(F.col("l_discount") != 0, F.col("l_extendedprice")),
        "currency": F.lit("USD"),
        "province": F.when(F.col("n_name") == "NATION_1", F.lit("Phnom Penh")).otherwise(F.col("n_name")),
        "seller_type": F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("store")).otherwise(
            F.lit("individual")
        ),
        "view_count": F.col("l_quantity").cast("int"),
        "vehicle_model_year": F.when(~has_no_year, F.year("l_shipdate")),
        "vehicle_condition": F.when(flag == "N", F.lit(" New ")).when(flag == "R", F.lit("Second Hand")),
        "vehicle_tax_type": F.when(F.col("p_type") == "PROMO", F.lit("Import PROMO")).otherwise(F.col("p_type")),
        "vehicle_brand": F.col("p_brand"),
        "vehicle_model": F.col("p_name"),
        "vehicle_fuel_type": F.when(F.col("l_linestatus") == "O", F.lit("Gasoline")).otherwise(F.lit(" Diesel")),
        "vehicle_transmission": F.when(number % 3 == 0, F.lit("Auto")).when(number % 3 == 1, F.lit("Manual")),
        "scraped_at": F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"),
    }


_FROM_PART = {"listing_title", "vehicle_tax_type", "vehicle_brand", "vehicle_model"}


def listings(spark: SparkSession, folder: str, columns: Sequence[str] = CLEAN_COLUMNS) -> DataFrame:
    """Raw listings with ``columns`` and the keep-last order columns.

    Only the dimensions that ``columns`` need are joined. Which sides are broadcast is left
    to the optimizer's size estimates and to adaptive execution.
    """
    rows = table(spark, folder, "lineitem")
    if _FROM_PART & set(columns):
        rows = rows.join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    if "province" in columns:
        places = table(spark, folder, "supplier").join(
            table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
        )
        rows = rows.join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    if "seller_type" in columns:
        rows = rows.join(table(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    made = _columns()
    wanted = list(dict.fromkeys(["listing_id", *columns, "price", "vehicle_model_year", "scraped_at"]))
    return rows.select(
        *[made.get(name, F.lit(None)).cast(RAW[name].dataType).alias(name) for name in wanted],
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
    )


def clean_listings(spark: SparkSession, folder: str, columns: Sequence[str] = CLEAN_COLUMNS) -> DataFrame:
    """Cleaned listings, narrowed to ``columns``."""
    return clean(listings(spark, folder, columns), RULES, ORDER, columns)


def stored_clean(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    """Cleaned listings written once and read back, for queries that read them repeatedly."""
    return through_table(clean_listings(spark, folder, columns), "clean")


LISTING_SQL = """
listing AS (
  SELECT l_orderkey || '-' || l_linenumber AS listing_id,
         p_name AS listing_title,
         CASE WHEN l_discount <> 0 THEN l_extendedprice END AS price,
         CASE WHEN n_name = 'NATION_1' THEN 'Phnom Penh' ELSE n_name END AS province,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'store' ELSE 'individual' END AS seller_type,
         CAST(l_quantity AS INTEGER) AS view_count,
         CASE WHEN NOT (l_returnflag = 'N' AND l_linenumber = 7)
              THEN CAST(year(l_shipdate) AS INTEGER) END AS vehicle_model_year,
         CASE l_returnflag WHEN 'N' THEN ' New ' WHEN 'R' THEN 'Second Hand' END AS vehicle_condition,
         CASE WHEN p_type = 'PROMO' THEN 'Import PROMO' ELSE p_type END AS vehicle_tax_type,
         p_brand AS vehicle_brand,
         p_name AS vehicle_model,
         CASE WHEN l_linestatus = 'O' THEN 'Gasoline' ELSE ' Diesel' END AS vehicle_fuel_type,
         CASE l_linenumber % 3 WHEN 0 THEN 'Auto' WHEN 1 THEN 'Manual' END AS vehicle_transmission,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S+00:00') AS scraped_at,
         l_shipdate, l_partkey, l_suppkey, l_extendedprice
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN orders ON l_orderkey = o_orderkey
)"""

CLEAN_SQL = (
    LISTING_SQL
    + """,
valid AS (
  SELECT * FROM listing
  WHERE price IS NOT NULL AND price BETWEEN 2000 AND 100000
    AND (vehicle_model_year IS NULL OR vehicle_model_year BETWEEN 1996 AND 2000)
),
clean AS (
  SELECT listing_id, listing_title, price, view_count, seller_type, vehicle_model_year, vehicle_model,
         scraped_at, l_shipdate,
         coalesce(CASE lower(trim(vehicle_condition)) WHEN 'second hand' THEN 'used' WHEN 'pre-owned' THEN 'used'
                  ELSE lower(trim(vehicle_condition)) END, 'unknown') AS vehicle_condition,
         coalesce(lower(trim(vehicle_tax_type)), 'unknown') AS vehicle_tax_type,
         coalesce(lower(trim(vehicle_brand)), 'unknown') AS vehicle_brand,
         coalesce(lower(trim(province)), 'unknown') AS province,
         coalesce(CASE lower(trim(vehicle_transmission)) WHEN 'auto' THEN 'automatic'
                  ELSE lower(trim(vehicle_transmission)) END, 'unknown') AS vehicle_transmission,
         coalesce(CASE lower(trim(vehicle_fuel_type)) WHEN 'gasoline' THEN 'petrol' WHEN 'gas' THEN 'petrol'
                  ELSE lower(trim(vehicle_fuel_type)) END, 'unknown') AS vehicle_fuel_type
  FROM valid
  QUALIFY row_number() OVER (PARTITION BY listing_id
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1
)"""
)

"""Market aggregates over clean listings.

Most of them read their input more than once, so they expect a stored table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.contract import STALE_AFTER_DAYS
from lotwise.functions.times import age_in_days
from lotwise.operators.quantiles import exact_quantiles, usable


def frequencies(df: DataFrame, key: str, count: str = "n") -> DataFrame:
    """Rows per non-null value of ``key``."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(count))


def top_values(df: DataFrame, key: str, limit: int, exclude: Sequence[str] = (), count: str = "n") -> DataFrame:
    """Most frequent values; ties in ascending key order."""
    kept = df.filter(~F.col(key).isin(*exclude)) if exclude else df
    return frequencies(kept, key, count).orderBy(F.desc(count), F.asc(key)).limit(limit)


def only_top(df: DataFrame, key: str, limit: int, exclude: Sequence[str] = ()) -> DataFrame:
    """Rows that belong to the ``limit`` most frequent values of ``key``."""
    # at most ``limit`` rows are broadcast
    return df.join(F.broadcast(top_values(df, key, limit, exclude).select(key)), key, "left_semi")


def top_with_median(df: DataFrame, key: str, value: str, limit: int) -> DataFrame:
    """Row count and exact median of ``value`` for the ``limit`` most frequent keys.

    Every row counts for the ranking; rows without a value are left out of the median.
    """
    leaders = top_values(df, key, limit, count="listings")
    # at most ``limit`` keys are broadcast
    of_leaders = df.join(F.broadcast(leaders.select(key)), key, "left_semi")
    middle = exact_quantiles(of_leaders, [key], value, {"median_price": 0.5}, "_valued")
    return leaders.join(middle, key, "left").select(key, "listings", "median_price")


def group_medians(df: DataFrame, key: str, value: str) -> DataFrame:
    """Exact median and size per group, highest median first."""
    middle = exact_quantiles(df, [key], value, {"median_price": 0.5})
    return middle.orderBy(F.desc("median_price"), F.asc(key))


def by_year(df: DataFrame, year: str, value: str) -> DataFrame:
    """Count, exact median and mean of ``value`` per model year."""
    middle = exact_quantiles(df, [year], value, {"median_price": 0.5}, "listings")
    means = df.filter(usable(F.col(value))).groupBy(year).agg(F.avg(value).alias("mean_price"))
    return middle.join(means, year).select(year, "listings", "median_price", "mean_price")


def with_price_features(df: DataFrame, as_of_year: int) -> DataFrame:
    """Numeric proxy columns for the correlation study."""
    return df.withColumns(
        {
            "car_age": F.lit(as_of_year) - F.col("vehicle_model_year"),
            "log_price": F.log1p("price"),
            "is_new": (F.col("vehicle_condition") == "new").cast("int"),
            "is_imported": F.contains(F.lower("vehicle_tax_type"), F.lit("import")).cast("int"),
            "is_phnom_penh": (F.col("province") == "phnom penh").cast("int"),
            "is_store": (F.col("seller_type") == "store").cast("int"),
        }
    )


def freshness(df: DataFrame, moment: Column, as_of: Column, stale_after: int = STALE_AFTER_DAYS) -> DataFrame:
    """One row: newest time, its age in days (one decimal) and whether the data is stale."""
    newest = df.agg(F.max(moment).alias("newest"))
    age = age_in_days(F.col("newest"), as_of)
    return newest.select("newest", F.bround(age, 1).alias("freshness_days"), (age > stale_after).alias("is_stale"))


def price_summary(df: DataFrame, value: str = "price") -> DataFrame:
    """One row: priced listings, median, mean (2 decimals), min and max; nulls when empty."""
    middle = exact_quantiles(df, [], value, {"median_price": 0.5}, "_n")
    basics = df.filter(usable(F.col(value))).agg(
        F.count(F.lit(1)).alias("total_listings"),
        F.avg(value).alias("_mean"),
        F.min(value).alias("min_price"),
        F.max(value).alias("max_price"),
    )
    return basics.select(
        "total_listings",
        middle.select("median_price").scalar().alias("median_price"),
        F.bround("_mean", 2).alias("mean_price"),
        "min_price",
        "max_price",
    )


def market_summary(df: DataFrame, moment: Column, as_of: Column, brands: int = 8, provinces: int = 5) -> DataFrame:
    """Price summary, top brands, top provinces and freshness as one row.

    The top-N lists have at most ``brands`` and ``provinces`` entries.
    """

    def listed(rows: DataFrame, *fields: str) -> Column:
        entries = F.array_sort(F.collect_list(F.struct((-F.col("listings")).alias("_rank"), *fields)))
        return rows.agg(F.transform(entries, lambda e: F.struct(*[e[f].alias(f) for f in fields]))).scalar()

    top_brands = top_with_median(df, "vehicle_brand", "price", brands)
    top_provinces = top_values(df, "province", provinces, count="listings")
    return price_summary(df).select(
        "*",
        listed(top_brands, "vehicle_brand", "listings", "median_price").alias("top_brands"),
        listed(top_provinces, "province", "listings").alias("top_provinces"),
        freshness(df, moment, as_of).select("freshness_days").scalar().alias("freshness_days"),
    )


def processed_summary(df: DataFrame, limit: int = 10) -> DataFrame:
    """Most frequent brands, each with the overall price summary, for the run report."""
    overall = price_summary(df).select(F.struct("*").alias("overall"))
    return (
        top_values(df, "vehicle_brand", limit, count="listings")
        .withColumn("_overall", overall.scalar())
        .select("vehicle_brand", "listings", "_overall.*")
    )

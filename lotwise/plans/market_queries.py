"""Cleaning, profiling and market queries on the listing view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.contract import CLEAN_COLUMNS
from lotwise.functions.text import contains_ignoring_case, equals_ignoring_case
from lotwise.functions.times import instant
from lotwise.operators import cleaning, market, profiling
from lotwise.plans.listing_view import (
    AS_OF_YEAR,
    CLEAN_SQL,
    LISTING_SQL,
    ORDER,
    RULES,
    clean_listings,
    listings,
    stored_clean,
)
from lotwise.plans.registry import SQL, query, table
from lotwise.session import scratch_dir
from lotwise.sources.writers import encode_json_cells, head_rows, sample_rows

AS_OF = "2002-01-01 12:00:00"


def rounded(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def typed_nulls(sql_types: dict[str, str]) -> str:
    return ", ".join(f"CAST(NULL AS {dtype}) AS {name}" for name, dtype in sql_types.items())


_PRESENT = """listing_id listing_title price province seller_type view_count vehicle_model_year vehicle_condition
vehicle_tax_type vehicle_brand vehicle_model vehicle_fuel_type vehicle_transmission scraped_at""".split()
_ABSENT = {
    name: {"discount_price": "DOUBLE", "is_premium": "BOOLEAN", "vehicle_mileage_km": "BIGINT", "vehicle_engine_cc": "INTEGER"}.get(
        name, "VARCHAR"
    )
    for name in CLEAN_COLUMNS
    if name not in _PRESENT and name != "currency"
}


@query(
    "clean_listings",
    f"WITH {CLEAN_SQL} SELECT {', '.join(_PRESENT)}, 'USD' AS currency, {typed_nulls(_ABSENT)} FROM clean",
)
def _clean_listings(spark, folder):
    return encode_json_cells(clean_listings(spark, folder))


@query(
    "clean_audit",
    f"""WITH {LISTING_SQL},
flags AS (
  SELECT listing_id, price IS NOT NULL AS r1,
         price IS NOT NULL AND price BETWEEN 2000 AND 100000 AS r2,
         price IS NOT NULL AND price BETWEEN 2000 AND 100000
           AND (vehicle_model_year IS NULL OR vehicle_model_year BETWEEN 1996 AND 2000) AS r3
  FROM listing
),
t AS (
  SELECT count(*) AS n0, count(*) FILTER (r1) AS n1, count(*) FILTER (r2) AS n2, count(*) FILTER (r3) AS n3,
         count(DISTINCT listing_id) FILTER (r3) AS n4 FROM flags
)
SELECT '1 has price' AS rule, n0 - n1 AS removed, n1 AS remaining FROM t
UNION ALL SELECT '2 price range', n1 - n2, n2 FROM t
UNION ALL SELECT '3 model year', n2 - n3, n3 FROM t
UNION ALL SELECT '6 last per id', n3 - n4, n4 FROM t""",
)
def _clean_audit(spark, folder):
    return cleaning.rule_audit(listings(spark, folder, ["listing_id"]), RULES)


@query("clean_observed", SQL["clean_audit"])
def _clean_observed(spark, folder):
    """The audit of the cleaning, counted by the job that writes the clean table."""
    observed = cleaning.ObservedCleaning(listings(spark, folder, ["listing_id", "price"]), RULES, ORDER, ["listing_id", "price"])
    observed.rows.write.parquet(scratch_dir(spark, "clean-observed"))
    return observed.audit()


@query(
    "integrity_checks",
    f"""WITH {CLEAN_SQL},
both_tables AS (
  SELECT 'raw' AS stage, listing_id, price, vehicle_model_year FROM listing
  UNION ALL SELECT 'clean', listing_id, price, vehicle_model_year FROM clean
)
SELECT stage, count(*) AS "rows", count(*) FILTER (listing_id IS NULL) AS missing_ids,
       count(*) - count(DISTINCT listing_id) AS duplicate_ids,
       count(*) FILTER (price IS NULL OR NOT price BETWEEN 2000 AND 100000) AS bad_prices,
       count(*) FILTER (NOT vehicle_model_year BETWEEN 1996 AND 2000) AS bad_years
FROM both_tables GROUP BY stage""",
)
def _integrity_checks(spark, folder):
    columns = ["listing_id", "price", "vehicle_model_year"]
    raw = cleaning.integrity(listings(spark, folder, columns), RULES)
    clean = cleaning.integrity(clean_listings(spark, folder, columns), RULES)
    return (
        raw.select(F.lit("raw").alias("stage"), "*").unionByName(clean.select(F.lit("clean").alias("stage"), "*"))
    )


@query(
    "top_brands_median",
    f"""WITH {CLEAN_SQL}
SELECT vehicle_brand, count(*) AS listings, round(median(price), 4) AS median_price
FROM clean GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8""",
)
def top_brands_median(spark, folder):
    brands = stored_clean(spark, folder, ["vehicle_brand", "price"])
    return rounded(market.top_with_median(brands, "vehicle_brand", "price", 8), "median_price")


@query(
    "top_provinces",
    f"WITH {CLEAN_SQL} SELECT province, count(*) AS listings FROM clean GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
)
def _top_provinces(spark, folder):
    return market.top_values(clean_listings(spark, folder, ["province"]), "province", 5, count="listings")


@query(
    "top_brand_shares",
    f"""WITH {CLEAN_SQL}
SELECT vehicle_brand, count(*) AS n FROM clean WHERE vehicle_brand NOT IN ('unknown', 'brand#7')
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 12""",
)
def _top_brand_shares(spark, folder):
    brands = clean_listings(spark, folder, ["vehicle_brand"])
    return market.top_values(brands, "vehicle_brand", 12, exclude=["unknown", "brand#7"])


_SUMMARY = """count(price) AS total_listings, round(median(price), 4) AS median_price,
       round_even(avg(price), 2) AS mean_price, min(price) AS min_price, max(price) AS max_price"""


@query(
    "market_summary",
    f"""WITH {CLEAN_SQL},
brands AS (SELECT vehicle_brand AS k, count(*) AS n, median(price) AS m FROM clean GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8),
places AS (SELECT province AS k, count(*) AS n FROM clean GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)
SELECT {_SUMMARY},
       (SELECT string_agg(k || '=' || n || '@' || CAST(CAST(round(m * 100) AS BIGINT) AS VARCHAR), '|' ORDER BY n DESC, k)
        FROM brands) AS top_brands,
       (SELECT string_agg(k || '=' || n, '|' ORDER BY n DESC, k) FROM places) AS top_provinces,
       round_even(epoch(TIMESTAMP '{AS_OF}' - max(l_shipdate)) / 86400.0, 1) AS freshness_days
FROM clean""",
)
def _market_summary(spark, folder):
    rows = stored_clean(spark, folder, ["vehicle_brand", "province", "price", "scraped_at"])
    summary = market.market_summary(rows, instant(F.col("scraped_at")), F.lit(f"{AS_OF}+00:00").cast("timestamp"))

    def brand(entry):
        cents = F.round(entry["median_price"] * 100).cast("bigint")
        return F.concat(entry["vehicle_brand"], F.lit("="), entry["listings"].cast("string"), F.lit("@"), cents.cast("string"))

    def place(entry):
        return F.concat(entry["province"], F.lit("="), entry["listings"].cast("string"))

    return rounded(
        summary.withColumns(
            {
                "top_brands": F.array_join(F.transform("top_brands", brand), "|"),
                "top_provinces": F.array_join(F.transform("top_provinces", place), "|"),
            }
        ),
        "median_price",
    )


@query(
    "processed_summary",
    f"""WITH {CLEAN_SQL},
s AS (SELECT {_SUMMARY} FROM clean),
b AS (SELECT vehicle_brand, count(*) AS listings FROM clean GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)
SELECT b.*, s.* FROM b, s""",
)
def _processed_summary(spark, folder):
    return rounded(
        market.processed_summary(stored_clean(spark, folder, ["vehicle_brand", "price"])), "median_price"
    )


@query(
    "price_describe",
    f"""WITH {CLEAN_SQL}
SELECT count(price) AS "count", round(avg(price), 4) AS mean, round(stddev_samp(price), 4) AS std,
       min(price) AS min, round(quantile_cont(price, 0.25), 4) AS q1, round(median(price), 4) AS median,
       round(quantile_cont(price, 0.75), 4) AS q3, max(price) AS max
FROM clean""",
)
def _price_describe(spark, folder):
    described = profiling.describe(stored_clean(spark, folder, ["price"]), "price")
    return rounded(described, "mean", "std", "q1", "median", "q3")


@query(
    "price_skew",
    f"""WITH {CLEAN_SQL}
SELECT count(price) AS n, round(skewness(price), 6) AS skew, round(avg(ln(1 + price)), 6) AS mean_log FROM clean""",
)
def _price_skew(spark, folder):
    return rounded(
        profiling.skew_and_log(clean_listings(spark, folder, ["price"]), "price"), "skew", "mean_log", digits=6
    )


@query(
    "log_price_stats",
    f"""WITH {CLEAN_SQL}, logs AS (SELECT ln(1 + price) AS x FROM clean)
SELECT count(x) AS "count", round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS std, round(min(x), 6) AS min,
       round(quantile_cont(x, 0.25), 6) AS q1, round(median(x), 6) AS median, round(quantile_cont(x, 0.75), 6) AS q3,
       round(max(x), 6) AS max
FROM logs""",
)
def _log_price_stats(spark, folder):
    logs = stored_clean(spark, folder, ["price"]).select(F.log1p("price").alias("log_price"))
    described = profiling.describe(logs, "log_price")
    return rounded(described, "mean", "std", "min", "q1", "median", "q3", "max", digits=6)


# Orders with the line items of returned goods: unreturned orders leave gaps.
_SPARSE_SQL = """sparse AS (
  SELECT o_orderkey AS listing_id, o_totalprice AS original_price, 'USD' AS currency, o_orderstatus AS listing_status,
         CASE WHEN l_discount <> 0 THEN l_extendedprice END AS price, l_quantity AS quantity, l_shipdate AS posted_at
  FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') ON o_orderkey = l_orderkey
)"""
_SPARSE_COLUMNS = {
    "currency": "string",
    "listing_id": "bigint",
    "listing_status": "string",
    "original_price": "double",
    "posted_at": "timestamp",
    "price": "double",
    "quantity": "double",
}


def _sparse(spark, folder):
    returned = table(spark, folder, "lineitem").filter("l_returnflag = 'R'")
    joined = table(spark, folder, "orders").join(returned, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select(
        F.col("o_orderkey").alias("listing_id"),
        F.col("o_totalprice").alias("original_price"),
        F.lit("USD").alias("currency"),
        F.col("o_orderstatus").alias("listing_status"),
        F.when(F.col("l_discount") != 0, F.col("l_extendedprice")).alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_shipdate").cast("timestamp").alias("posted_at"),
    )


def _sparse_union(fields: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{dtype}' AS data_type, count(*) AS total, count({name}) AS present, "
        f"count(DISTINCT {name}) <= 1 AS is_constant FROM sparse"
        for name, dtype in _SPARSE_COLUMNS.items()
    ).join((f"WITH {_SPARSE_SQL}, profile AS (", f") {fields}"))


@query(
    "column_completeness",
    _sparse_union(
        'SELECT column_name, data_type, total AS "rows", present AS non_null, '
        "round(present * 100.0 / total, 4) AS non_null_pct, is_constant FROM profile"
    ),
)
def _column_completeness(spark, folder):
    return rounded(profiling.completeness(_sparse(spark, folder)), "non_null_pct")


@query(
    "missing_profile",
    _sparse_union(
        "SELECT column_name, total - present AS missing_count, "
        "round_even((total - present) * 100.0 / total, 1) AS missing_pct, data_type FROM profile WHERE present < total"
    ),
)
def _missing_profile(spark, folder):
    return profiling.missing_profile(_sparse(spark, folder))


@query(
    "constant_columns",
    _sparse_union("SELECT column_name, present AS non_null FROM profile WHERE is_constant"),
)
def _constant_columns(spark, folder):
    return profiling.constant_columns(_sparse(spark, folder))


@query(
    "quality_gate",
    f"""WITH {_SPARSE_SQL}
SELECT count(*) AS total_listings, count(price) AS priced, count(*) >= 2000 AS enough_listings,
       count(price) >= 1500 AS enough_priced, count(*) >= 2000 AND count(price) >= 1500 AS requirements_met
FROM sparse""",
)
def _quality_gate(spark, folder):
    return profiling.quality_gate(_sparse(spark, folder))


@query(
    "year_depreciation",
    f"""WITH {CLEAN_SQL}
SELECT vehicle_model_year, count(price) AS listings, round(median(price), 4) AS median_price,
       round(avg(price), 4) AS mean_price
FROM clean WHERE vehicle_model_year IS NOT NULL GROUP BY 1""",
)
def _year_depreciation(spark, folder):
    rows = stored_clean(spark, folder, ["vehicle_model_year", "price"])
    return rounded(market.by_year(rows, "vehicle_model_year", "price"), "median_price", "mean_price")


def _median_sql(key: str) -> str:
    return f"WITH {CLEAN_SQL} SELECT {key}, count(*) AS n, round(median(price), 4) AS median_price FROM clean GROUP BY 1"


@query("median_by_tax_type", _median_sql("vehicle_tax_type"))
def _median_by_tax_type(spark, folder):
    rows = stored_clean(spark, folder, ["vehicle_tax_type", "price"])
    return rounded(market.group_medians(rows, "vehicle_tax_type", "price"), "median_price")


@query("median_by_condition", _median_sql("vehicle_condition"))
def _median_by_condition(spark, folder):
    rows = stored_clean(spark, folder, ["vehicle_condition", "price"])
    return rounded(market.group_medians(rows, "vehicle_condition", "price"), "median_price")


def _box_sql(key: str, where: str = "true") -> str:
    return f"""WITH {CLEAN_SQL},
boxed AS (
  SELECT {key} AS k, count(*) AS n, quantile_cont(price, 0.25) AS q1, median(price) AS median,
         quantile_cont(price, 0.75) AS q3
  FROM clean WHERE {where} GROUP BY 1
),
fenced AS (
  SELECT b.*, price, price BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
  FROM boxed b JOIN clean ON {key} = k
)
SELECT k AS {key}, n, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
       round(least(min(price) FILTER (inside), q1), 4) AS whisker_low,
       round(greatest(max(price) FILTER (inside), q3), 4) AS whisker_high,
       CAST(count(*) FILTER (NOT inside) AS BIGINT) AS outliers
FROM fenced GROUP BY k, n, q1, median, q3"""


def _boxes(df: DataFrame, key: str) -> DataFrame:
    return rounded(profiling.box_stats(df, key, "price"), "q1", "median", "q3", "whisker_low", "whisker_high")


def _top_filter(key: str, limit: int) -> str:
    return f"{key} IN (SELECT {key} FROM clean GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT {limit})"


@query("box_stats_by_brand", _box_sql("vehicle_brand", _top_filter("vehicle_brand", 12)))
def _box_stats_by_brand(spark, folder):
    rows = stored_clean(spark, folder, ["vehicle_brand", "price"])
    return _boxes(market.only_top(rows, "vehicle_brand", 12, exclude=["unknown"]), "vehicle_brand")


@query("box_stats_by_province", _box_sql("province", _top_filter("province", 6)))
def _box_stats_by_province(spark, folder):
    rows = stored_clean(spark, folder, ["province", "price"])
    return _boxes(market.only_top(rows, "province", 6), "province")


@query("box_stats_by_tax_type", _box_sql("vehicle_tax_type"))
def _box_stats_by_tax_type(spark, folder):
    return _boxes(stored_clean(spark, folder, ["vehicle_tax_type", "price"]), "vehicle_tax_type")


@query("box_stats_by_condition", _box_sql("vehicle_condition"))
def _box_stats_by_condition(spark, folder):
    return _boxes(stored_clean(spark, folder, ["vehicle_condition", "price"]), "vehicle_condition")


@query("box_stats_by_seller_type", _box_sql("seller_type"))
def _box_stats_by_seller_type(spark, folder):
    return _boxes(stored_clean(spark, folder, ["seller_type", "price"]), "seller_type")


_BOX_DIMENSIONS = {
    "vehicle_brand": profiling.Leaders(12, ("unknown",)),
    "province": profiling.Leaders(6),
    "vehicle_tax_type": None,
    "vehicle_condition": None,
    "seller_type": None,
}


def _all_boxes_sql() -> str:
    parts = []
    for key, leaders in _BOX_DIMENSIONS.items():
        boxes = _box_sql(key, _top_filter(key, leaders.limit) if leaders else "true")
        parts.append(f"""SELECT '{key}' AS dimension, {key} AS "group", * EXCLUDE ({key}) FROM ({boxes})""")
    return " UNION ALL ".join(parts)


@query("box_stats_all", _all_boxes_sql())
def _box_stats_all(spark, folder):
    """The five box queries from one read of the cleaned listings."""
    rows = clean_listings(spark, folder, [*_BOX_DIMENSIONS, "price"])
    boxes = profiling.box_stats_many(rows, _BOX_DIMENSIONS, "price")
    return rounded(boxes, "q1", "median", "q3", "whisker_low", "whisker_high")


def _histogram_sql(value: str) -> str:
    return f"""WITH {CLEAN_SQL},
p AS (SELECT {value} AS x FROM clean),
r AS (SELECT min(x) AS lo, max(x) AS hi FROM p),
f AS (SELECT least(CAST(floor((x - lo) * 40 / (hi - lo)) AS BIGINT), 39) AS b, count(*) AS c FROM p, r GROUP BY 1)
SELECT i AS bin, round(lo + i * (hi - lo) / 40, 4) AS bin_start, coalesce(c, 0) AS n
FROM (SELECT unnest(range(40)) AS i) CROSS JOIN r LEFT JOIN f ON b = i"""


@query("price_histogram", _histogram_sql("price"))
def _price_histogram(spark, folder):
    return rounded(profiling.histogram(stored_clean(spark, folder, ["price"]), F.col("price")), "bin_start")


@query("log_price_histogram", _histogram_sql("ln(1 + price)"))
def _log_price_histogram(spark, folder):
    return rounded(profiling.histogram(stored_clean(spark, folder, ["price"]), F.log1p("price")), "bin_start")


_FEATURES = "price log_price vehicle_model_year car_age view_count is_new is_imported is_phnom_penh is_store".split()
_FEATURE_SQL = f"""WITH {CLEAN_SQL},
f AS (
  SELECT price, ln(1 + price) AS log_price, vehicle_model_year, {AS_OF_YEAR} - vehicle_model_year AS car_age, view_count,
         CAST(vehicle_condition = 'new' AS INTEGER) AS is_new,
         CAST(contains(vehicle_tax_type, 'import') AS INTEGER) AS is_imported,
         CAST(province = 'phnom penh' AS INTEGER) AS is_phnom_penh,
         CAST(seller_type = 'store' AS INTEGER) AS is_store
  FROM clean
) """


@query(
    "feature_correlation",
    _FEATURE_SQL
    + " UNION ALL ".join(
        f"SELECT '{x}' AS x, '{y}' AS y, nullif(round(corr({x}, {y}), 6), CAST('nan' AS DOUBLE)) AS corr FROM f" for x in _FEATURES for y in _FEATURES
    ),
)
def _feature_correlation(spark, folder):
    needed = "price vehicle_model_year view_count vehicle_condition vehicle_tax_type province seller_type".split()
    featured = market.with_price_features(stored_clean(spark, folder, needed), AS_OF_YEAR)
    return rounded(profiling.correlations(featured, _FEATURES), "corr", digits=6)


@query(
    "price_features",
    _FEATURE_SQL
    + """SELECT is_new, is_imported, is_phnom_penh, is_store, count(*) AS n, round(avg(car_age), 6) AS mean_age,
       round(avg(log_price), 6) AS mean_log FROM f GROUP BY 1, 2, 3, 4""",
)
def _price_features(spark, folder):
    needed = "price vehicle_model_year vehicle_condition vehicle_tax_type province seller_type".split()
    featured = market.with_price_features(clean_listings(spark, folder, needed), AS_OF_YEAR)
    grouped = featured.groupBy("is_new", "is_imported", "is_phnom_penh", "is_store").agg(
        F.count(F.lit(1)).alias("n"), F.avg("car_age").alias("mean_age"), F.avg("log_price").alias("mean_log")
    )
    return rounded(grouped, "mean_age", "mean_log", digits=6)


@query(
    "freshness",
    """SELECT event_type, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS newest,
       round_even(epoch_us(TIMESTAMP '2024-02-05 06:00:00') / 86400e6 - epoch_us(max(ts)) / 86400e6, 1) AS freshness_days,
       TIMESTAMP '2024-02-05 06:00:00' - max(ts) > INTERVAL 7 DAY AS is_stale
FROM (SELECT ts, event_type FROM events UNION ALL SELECT ts, 'all' FROM events)
WHERE event_type IN ('all', 'error', 'view') GROUP BY 1""",
)
def _freshness(spark, folder):
    events = table(spark, folder, "events")
    as_of = F.lit("2024-02-05 06:00:00").cast("timestamp")
    groups = {"all": events, "error": events.filter("event_type = 'error'"), "view": events.filter("event_type = 'view'")}
    parts = [
        market.freshness(rows, F.col("ts").cast("timestamp"), as_of).select(F.lit(name).alias("event_type"), "*")
        for name, rows in groups.items()
    ]
    joined = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return joined.withColumn("newest", F.date_format("newest", "yyyy-MM-dd'T'HH:mm:ss"))


@query(
    "row_and_id_counts",
    f"""WITH {LISTING_SQL}
SELECT count(*) AS row_count, CAST(7 AS INTEGER) AS column_count, count(DISTINCT listing_id) AS distinct_ids FROM listing""",
)
def _row_and_id_counts(spark, folder):
    return profiling.shape(listings(spark, folder, ["listing_id"]), "listing_id")


@query(
    "predicate_filters",
    f"""WITH {CLEAN_SQL}
SELECT vehicle_tax_type, count(*) AS n,
       count(*) FILTER (lower(vehicle_brand) = 'brand#12') AS brand_is,
       count(*) FILTER (contains(lower(vehicle_model), 'ring')) AS model_contains,
       count(*) FILTER (contains(lower(vehicle_model), '.*')) AS literal_pattern
FROM clean
WHERE vehicle_condition <> 'unknown'
  AND {_top_filter('province', 10)}
GROUP BY 1""",
)
def _predicate_filters(spark, folder):
    needed = "vehicle_tax_type vehicle_brand vehicle_model vehicle_condition province".split()
    rows = market.only_top(stored_clean(spark, folder, needed), "province", 10)
    return (
        rows.filter(F.col("vehicle_condition") != "unknown")
        .groupBy("vehicle_tax_type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(equals_ignoring_case(F.col("vehicle_brand"), "Brand#12")).alias("brand_is"),
            F.count_if(contains_ignoring_case(F.col("vehicle_model"), "RING")).alias("model_contains"),
            F.count_if(contains_ignoring_case(F.col("vehicle_model"), ".*")).alias("literal_pattern"),
        )
    )


@query(
    "reproducible_sample",
    """SELECT CAST(o_orderkey AS VARCHAR) AS listing_id, 'Order ' || o_orderkey AS listing_title, o_totalprice AS price,
       o_orderpriority AS seller_type
FROM orders ORDER BY md5('42:' || o_orderkey), CAST(o_orderkey AS VARCHAR) LIMIT 30""",
)
def _reproducible_sample(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("listing_id"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("listing_title"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("seller_type"),
        F.col("o_custkey").alias("not_in_the_sample"),
    )
    return sample_rows(orders, 30)


@query(
    "head_sample",
    f"""WITH {CLEAN_SQL}
SELECT listing_id, price, vehicle_brand, vehicle_model_year, scraped_at FROM clean ORDER BY listing_id LIMIT 60""",
)
def _head_sample(spark, folder):
    columns = ["listing_id", "price", "vehicle_brand", "vehicle_model_year", "scraped_at"]
    return head_rows(clean_listings(spark, folder, columns))

"""Batch price estimates for requests derived from the part table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.operators import comparables_index
from lotwise.operators.cleaning import reject_requests
from lotwise.operators.valuation import value_requests
from lotwise.plans.listing_view import AS_OF_YEAR, CLEAN_SQL, RULES, clean_listings
from lotwise.plans.registry import query, table
from lotwise.session import scratch_dir, spread_shuffles

# Requested model by kind of request. Part names are "<adjective> <noun>".
_KINDS = ("exact", "brand_model", "brand", "prior")


def _requests(spark, folder):
    """One request of each kind per part.

    ``exact`` asks for the noun of the part name in a year that exists, ``brand_model`` for a
    year after the data, ``brand`` for a model nobody lists, ``prior`` for an unknown brand.
    """
    part = table(spark, folder, "part")
    key, noun = F.col("p_partkey"), F.substring_index("p_name", " ", -1)
    kinds = F.explode(F.array(*[F.lit(kind) for kind in _KINDS]))
    rows = part.select("p_partkey", "p_brand", "p_name", "p_type", "p_size", kinds.alias("kind"))
    kind = F.col("kind")
    return rows.select(
        "kind",
        F.concat_ws("-", kind, key.cast("string")).alias("request_id"),
        F.when(kind == "prior", F.concat(F.lit("no "), F.col("p_brand")))
        .otherwise(F.concat(F.lit(" "), F.upper("p_brand")))
        .alias("vehicle_brand"),
        F.when(kind == "brand", F.when(key % 2 == 0, F.lit("zeppelin")).otherwise(F.lit(" ")))
        .otherwise(F.concat(F.upper(noun), F.lit(" ")))
        .alias("vehicle_model"),
        F.when(kind == "exact", (F.lit(1996) + key % 5).cast("int"))
        .when(key % 11 == 0, F.lit(0))
        .otherwise((F.lit(2002) + key % 2).cast("int"))
        .alias("vehicle_model_year"),
        F.when(key % 3 == 0, F.lit("New ")).when(key % 3 == 1, F.lit("used")).alias("vehicle_condition"),
        F.when(F.col("p_type") == "PROMO", F.lit("Imported"))
        .when(F.col("p_type") == "LARGE", F.lit("TAX PAPER"))
        .when(F.col("p_type") == "SMALL", F.lit(""))
        .otherwise(F.lit("plate number"))
        .alias("vehicle_tax_type"),
        F.when(F.col("p_size") % 4 != 0, F.col("p_size").cast("bigint") * 9_000).alias("vehicle_mileage_km"),
    )


_ESTIMATE_SQL = f"""WITH {CLEAN_SQL},
market AS (
  SELECT lower(vehicle_brand) AS b, lower(vehicle_model) AS m, vehicle_model_year AS y, price FROM clean
),
requests AS (
  SELECT kind, kind || '-' || p_partkey AS request_id,
         CASE WHEN kind = 'prior' THEN 'no ' || lower(p_brand) ELSE lower(p_brand) END AS b,
         CASE WHEN kind = 'brand' THEN CASE WHEN p_partkey % 2 = 0 THEN 'zeppelin' END
              ELSE lower(split_part(p_name, ' ', -1)) END AS m,
         CASE WHEN kind = 'exact' THEN 1996 + p_partkey % 5 WHEN p_partkey % 11 = 0 THEN {AS_OF_YEAR} - 5
              ELSE 2002 + p_partkey % 2 END AS y,
         CASE WHEN p_partkey % 3 = 0 THEN 1.25 ELSE 1.0 END AS condition_factor,
         CASE WHEN p_type IN ('PROMO', 'LARGE') THEN 1.10 ELSE 1.0 END AS tax_factor,
         CASE WHEN p_size % 4 <> 0 THEN CAST(p_size AS BIGINT) * 9000 END AS km
  FROM part, (SELECT unnest(['exact', 'brand_model', 'brand', 'prior']) AS kind)
),
asked AS (SELECT DISTINCT b, m, y FROM requests),
t1 AS (
  SELECT a.b, a.m, a.y, count(*) AS n, median(price) AS med FROM asked a
  JOIN market k ON k.b = a.b AND contains(k.m, a.m) AND k.y = a.y GROUP BY 1, 2, 3
),
t2 AS (
  SELECT a.b, a.m, count(*) AS n, median(price) AS med, median(k.y) AS ref FROM (SELECT DISTINCT b, m FROM asked) a
  JOIN market k ON k.b = a.b AND contains(k.m, a.m) GROUP BY 1, 2
),
t3 AS (SELECT b, count(*) AS n, median(price) AS med, median(y) AS ref FROM market GROUP BY 1),
tiers AS (
  SELECT r.*,
         CASE WHEN t1.n >= 3 THEN 1 WHEN t2.n >= 3 THEN 2 WHEN t3.n >= 3 THEN 3 ELSE 0 END AS tier,
         t1.n AS n1, t1.med AS med1, t2.n AS n2, t2.med AS med2, t2.ref AS ref2, t3.n AS n3, t3.med AS med3, t3.ref AS ref3
  FROM requests r
  LEFT JOIN t1 ON t1.b = r.b AND t1.m = r.m AND t1.y = r.y
  LEFT JOIN t2 ON t2.b = r.b AND t2.m = r.m
  LEFT JOIN t3 ON t3.b = r.b
),
based AS (
  SELECT *,
         CASE tier WHEN 1 THEN med1 WHEN 2 THEN med2 * power(CAST(1.065 AS DOUBLE), y - ref2)
              WHEN 3 THEN med3 * power(CAST(1.065 AS DOUBLE), y - ref3)
              ELSE 22500 * power(CAST(0.935 AS DOUBLE), greatest(0, {AS_OF_YEAR} - y)) END AS base,
         CASE tier WHEN 1 THEN 'exact_match_' || b || '_' || m || '_' || y WHEN 2 THEN 'brand_model_median_' || b || '_' || m
              WHEN 3 THEN 'brand_median_' || b ELSE 'general_cambodia_market_prior' END AS valuation_basis,
         CASE tier WHEN 1 THEN n1 WHEN 2 THEN n2 WHEN 3 THEN n3 ELSE 0 END AS market_sample_size,
         CASE WHEN km > 0 THEN greatest(-0.15, least(0.10,
              -((km - greatest(1, {AS_OF_YEAR} - y) * 15000) / CAST(20000 AS DOUBLE)) * CAST(0.015 AS DOUBLE)))
              ELSE 0 END AS km_effect
  FROM tiers
),
priced AS (
  SELECT *, greatest(500, least(300000, round_even(base * CAST(condition_factor AS DOUBLE)
              * CAST(tax_factor AS DOUBLE) * (1 + CAST(km_effect AS DOUBLE)), -2))) AS price
  FROM based
),
estimates AS (
  SELECT kind, request_id, CAST(price AS DOUBLE) AS predicted_price_usd,
         CAST(greatest(500, round_even(price * CAST(0.88 AS DOUBLE), -2)) AS DOUBLE) AS price_range_low_usd,
         CAST(least(300000, round_even(price * CAST(1.12 AS DOUBLE), -2)) AS DOUBLE) AS price_range_high_usd,
         CAST(market_sample_size AS BIGINT) AS market_sample_size, valuation_basis,
         CAST(greatest(0, {AS_OF_YEAR} - y) AS INTEGER) AS estimated_age_years, 'USD' AS currency
  FROM priced
)
"""

_OUTPUT = """predicted_price_usd price_range_low_usd price_range_high_usd market_sample_size valuation_basis
estimated_age_years currency""".split()


def _market(spark, folder):
    return clean_listings(spark, folder, ["vehicle_brand", "vehicle_model", "vehicle_model_year", "price"])


def _market_rows(spark, folder):
    """Number of raw listings, from the files' footers."""
    return table(spark, folder, "lineitem").count()


def _estimates(spark, folder, kind):
    asked = _requests(spark, folder)
    if kind:
        asked = asked.filter(F.col("kind") == kind)
    with spread_shuffles(spark, _market_rows(spark, folder)):
        return value_requests(asked, _market(spark, folder), AS_OF_YEAR).select("request_id", *_OUTPUT)


def _register(name: str, kind: str | None) -> None:
    where = f"WHERE kind = '{kind}'" if kind else ""

    @query(name, f"{_ESTIMATE_SQL} SELECT request_id, {', '.join(_OUTPUT)} FROM estimates {where}")
    def _run(spark, folder):
        return _estimates(spark, folder, kind)


for _kind in _KINDS:
    _register(f"value_{_kind}", _kind)
_register("value_batch", None)


@query("value_indexed", f"{_ESTIMATE_SQL} SELECT request_id, {', '.join(_OUTPUT)} FROM estimates")
def _value_indexed(spark, folder):
    """Two batches of requests from one index."""
    asked, model_kinds = _requests(spark, folder), F.col("kind").isin("exact", "brand_model")
    batches = [asked.filter(model_kinds), asked.filter(~model_kinds)]
    with spread_shuffles(spark, _market_rows(spark, folder)):
        index = comparables_index.build(_market(spark, folder), scratch_dir(spark, "comparables"), buckets=8)
        first, second = [comparables_index.value_indexed(batch, index, AS_OF_YEAR).select("request_id", *_OUTPUT) for batch in batches]
    return first.unionByName(second)


@query(
    "request_validation",
    """WITH r AS (
  SELECT c_custkey, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_name END AS brand,
         1985 + c_custkey % 20 AS y, CAST(trunc(c_acctbal) AS BIGINT) AS km FROM customer
)
SELECT c_custkey, CASE WHEN brand IS NULL THEN 'missing_brand' WHEN NOT y BETWEEN 1996 AND 2000 THEN 'year_out_of_range'
       WHEN km < 0 THEN 'negative_mileage' END AS reject_reason
FROM r""",
)
def _request_validation(spark, folder):
    key = F.col("c_custkey")
    requests = table(spark, folder, "customer").select(
        "c_custkey",
        F.when(key % 17 != 0, F.col("c_name")).alias("vehicle_brand"),
        F.col("c_mktsegment").alias("vehicle_model"),
        (F.lit(1985) + key % 20).cast("int").alias("vehicle_model_year"),
        F.col("c_acctbal").cast("bigint").alias("vehicle_mileage_km"),
    )
    return reject_requests(requests, RULES).select("c_custkey", "reject_reason")

"""Batch price estimates from comparable listings.

Each request takes the first set of comparables that has at least three listings:
(1) same brand and year, model name containing the requested one, (2) the same in any
year, (3) same brand; otherwise a market prior. The price is the set's median, moved
along the depreciation curve for (2) and (3), then adjusted for condition, tax status and
mileage.

Plan: the market is counted per (brand, model, year, price) once (:func:`market_index`).
Set sizes come from the much smaller (brand, model, year) counts, so the medians are only
computed for the sets that some request really uses, once per distinct set, by value-sliced
exact quantiles. The results that many branches start from, the index and the chosen
sets, go through scratch tables, and so do the medians, so that all work on the market is done when
the estimates are returned.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.contract import PRICE_MAX, PRICE_MIN
from lotwise.functions.text import strip, stripped_or_null
from lotwise.operators.cleaning import Rules, reject_requests
from lotwise.operators.joins import contains_join, salted_lookup
from lotwise.operators.quantiles import count_values, exact_quantiles, usable
from lotwise.session import through_table

# Model constants.
PRIOR_PRICE = 22_500.0
YEARLY_RATE = 0.065
DEFAULT_AGE = 5
MIN_COMPARABLES = 3
NEW_FACTOR = 1.25
CLEARED_TAX_FACTOR = 1.10
CLEARED_TAX_WORDS = ("tax paper", "import", "ក្រដាសពន្ធ")
KM_PER_YEAR, KM_STEP, KM_STEP_EFFECT = 15_000, 20_000.0, 0.015
KM_FLOOR, KM_CEILING = -0.15, 0.10
BAND_LOW, BAND_HIGH = 0.88, 1.12
DEFAULT_CONDITION, DEFAULT_TAX = "used", "plate number"
PRIOR_BASIS = "general_cambodia_market_prior"

SET = ["_tier", "_b", "_m", "_y"]


def market_index(market: DataFrame) -> DataFrame:
    """(brand, model, year, price) -> number of listings, names in lower case.

    All that estimates need to know of the market; may be stored and used for many batches.
    """
    return (
        market.filter(usable(F.col("price")) & F.col("vehicle_brand").isNotNull())
        .groupBy(
            F.lower("vehicle_brand").alias("_b"),
            F.lower("vehicle_model").alias("_text"),
            F.col("vehicle_model_year").alias("_year"),
            F.col("price").cast("double").alias("price"),
        )
        .agg(F.count(F.lit(1)).alias("weight"))
    )


def choose_sets(asked: DataFrame, slices: DataFrame, matches: DataFrame) -> DataFrame:
    """Add ``_tier`` (1, 2, 3 or 0) to every distinct (brand, model, year) asked for."""
    by_year = (
        matches.join(slices, ["_b", "_text"]).groupBy("_b", "_m", "_year").agg(F.sum("weight").alias("_n1"))
    )
    any_year = by_year.groupBy("_b", "_m").agg(F.sum("_n1").alias("_n2"))
    brand = slices.groupBy("_b").agg(F.sum("weight").alias("_n3"))

    def enough(count: str) -> Column:
        return F.col(count) >= MIN_COMPARABLES

    return (
        asked.join(by_year.withColumnRenamed("_year", "_y"), ["_b", "_m", "_y"], "left")
        .join(any_year, ["_b", "_m"], "left")
        .join(brand, "_b", "left")
        .select(
            "_b",
            "_m",
            "_y",
            F.when(enough("_n1"), 1).when(enough("_n2"), 2).when(enough("_n3"), 3).otherwise(0).alias("_tier"),
        )
    )


def set_key(model: Column, year: Column) -> list[Column]:
    """Parts of the request that identify its comparables; unused parts are blanked."""
    tier = F.col("_tier")
    return [
        tier,
        F.col("_b"),
        F.when(tier <= 2, model).otherwise(F.lit("")).alias("_m"),
        F.when(tier == 1, year).otherwise(F.lit(0)).alias("_y"),
    ]


def set_medians(
    sets: DataFrame, counts: DataFrame, slices: DataFrame, matches: DataFrame, brands: DataFrame | None = None
) -> DataFrame:
    """Median price, median year and size of each set.

    ``brands`` has those of whole brands (``_b``, ``_median``, ``_ref_year``, ``_size``), if they are known already.
    """

    def rows(members: DataFrame, what: str, value: Column) -> DataFrame:
        return members.select(*SET, F.lit(what).alias("_what"), value.cast("double").alias("_amount"), "weight")

    named = {tier: sets.filter(F.col("_tier") == tier) for tier in (1, 2, 3)}
    exact = named[1].join(matches, ["_b", "_m"]).withColumn("_year", F.col("_y")).join(counts, ["_b", "_text", "_year"])
    model_sets = named[2].join(matches, ["_b", "_m"])
    price, year = F.col("price"), F.col("_year")
    parts = [
        rows(exact, "price", price),
        rows(model_sets.join(counts, ["_b", "_text"]), "price", price),
        rows(model_sets.join(slices, ["_b", "_text"]), "year", year),
    ]
    if brands is None:
        brand_prices = counts.groupBy("_b", "price").agg(F.sum("weight").alias("weight"))
        brand_years = slices.groupBy("_b", "_year").agg(F.sum("weight").alias("weight"))
        parts += [
            rows(named[3].join(brand_prices, "_b"), "price", price),
            rows(named[3].join(brand_years, "_b"), "year", year),
        ]
    stats = _medians(reduce(DataFrame.unionByName, parts), SET)
    if brands is None:
        return stats
    return stats.unionByName(named[3].join(brands, "_b").select(*stats.columns))


def _medians(members: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_median`` price, median year ``_ref_year`` and ``_size`` from (keys, _what, _amount, weight)."""
    by = [*keys, "_what"]
    middle = exact_quantiles(count_values(members, by, "_amount", "weight"), by, "_amount", {"_mid": 0.5}, "_n", "weight")
    is_price = F.col("_what") == "price"
    return middle.groupBy(*keys).agg(
        F.max(F.when(is_price, F.col("_mid"))).alias("_median"),
        F.max(F.when(~is_price, F.col("_mid"))).alias("_ref_year"),
        F.max(F.when(is_price, F.col("_n"))).alias("_size"),
    )


def brand_medians(counts: DataFrame) -> DataFrame:
    """(_b, _median, _ref_year, _size) of each brand as a whole."""
    parts = [
        counts.select("_b", F.lit(what).alias("_what"), F.col(name).cast("double").alias("_amount"), "weight")
        for what, name in (("price", "price"), ("year", "_year"))
    ]
    return _medians(parts[0].unionByName(parts[1]), ["_b"])


def comparables(asked: DataFrame, counts: DataFrame) -> DataFrame:
    """Tier, size, median price and median year for distinct (``_b``, ``_m``, ``_y``)."""
    slices = counts.groupBy("_b", "_text", "_year").agg(F.sum("weight").alias("weight"))
    wanted = asked.select("_b", "_m").filter("_b is not null and _m is not null").distinct()
    texts = slices.select("_b", "_text").distinct()
    matches = contains_join(wanted, texts, "_b", "_m", "_text")
    chosen = choose_sets(asked.filter("_b is not null"), slices, matches).filter("_tier > 0")
    keyed = through_table(
        chosen.select(
            F.col("_m").alias("_asked_m"), F.col("_y").alias("_asked_y"), *set_key(F.col("_m"), F.col("_y"))
        ),
        "chosen-sets",
    )
    stats = through_table(set_medians(keyed.select(*SET).distinct(), counts, slices, matches), "set-medians")
    # one brand's set can serve a large share of what was asked
    return salted_lookup(keyed, stats, SET, spread_by="_asked_m").select(
        "_b", F.col("_asked_m").alias("_m"), F.col("_asked_y").alias("_y"), "_tier", "_median", "_ref_year", "_size"
    )


def _hundreds(value: Column) -> Column:
    """Round to hundreds, halves to even."""
    return F.bround(value, -2)


def _bounded(value: Column) -> Column:
    return F.greatest(F.lit(PRICE_MIN), F.least(F.lit(PRICE_MAX), value))


def keyed_requests(requests: DataFrame, as_of_year: int) -> DataFrame:
    """Requests with brand ``_b``, model ``_m`` and year ``_y`` as comparables are looked up by."""
    default_year = as_of_year - DEFAULT_AGE
    return requests.withColumns(
        {
            "_b": stripped_or_null(F.lower("vehicle_brand")),
            "_m": stripped_or_null(F.lower("vehicle_model")),
            "_y": F.coalesce(F.nullif(F.col("vehicle_model_year"), F.lit(0)), F.lit(default_year)).cast("int"),
        }
    )


def value_requests(
    requests: DataFrame, market: DataFrame, as_of_year: int, index: DataFrame | None = None
) -> DataFrame:
    """Estimate a price for every request row; all request columns are kept.

    ``index`` is a stored :func:`market_index` of ``market``, if there is one. The scratch
    tables are written while this is called.

    Requests need ``vehicle_brand``, ``vehicle_model``, ``vehicle_model_year``,
    ``vehicle_condition``, ``vehicle_tax_type`` and ``vehicle_mileage_km``. Where a set has
    no model year at all, the reference year is ``as_of_year - 5``.
    """
    keyed = keyed_requests(requests, as_of_year)
    counts = index if index is not None else through_table(market_index(market), "market-index")
    found = comparables(keyed.select("_b", "_m", "_y").distinct(), counts)
    return priced_requests(keyed, found, requests.columns, as_of_year)


def priced_requests(keyed: DataFrame, found: DataFrame, columns: Sequence[str], as_of_year: int) -> DataFrame:
    """``columns`` of keyed requests and their estimates from the comparables ``found`` for them."""
    default_year = as_of_year - DEFAULT_AGE
    # requests without a model still find their brand, hence the null-free join key
    model_key = F.coalesce("_m", F.lit("")).alias("_mk")
    stats = found.select("_b", model_key, "_y", "_tier", "_median", "_ref_year", "_size")
    joined = keyed.withColumn("_mk", model_key).join(stats, ["_b", "_mk", "_y"], "left")

    year, tier = F.col("_y"), F.coalesce("_tier", F.lit(0))
    age = F.greatest(F.lit(0), F.lit(as_of_year) - year)
    drift = year - F.coalesce("_ref_year", F.lit(float(default_year)))
    base = (
        F.when(tier == 1, F.col("_median"))
        .when(tier > 1, F.col("_median") * F.pow(F.lit(1.0 + YEARLY_RATE), drift))
        .otherwise(F.lit(PRIOR_PRICE) * F.pow(F.lit(1.0 - YEARLY_RATE), age))
    )
    basis = (
        F.when(tier == 1, F.concat(F.lit("exact_match_"), "_b", F.lit("_"), "_m", F.lit("_"), year.cast("string")))
        .when(tier == 2, F.concat(F.lit("brand_model_median_"), "_b", F.lit("_"), "_m"))
        .when(tier == 3, F.concat(F.lit("brand_median_"), "_b"))
        .otherwise(F.lit(PRIOR_BASIS))
    )

    def worded(name: str, default: str) -> Column:
        given = F.col(name)
        return F.lower(strip(F.when(given.isNull() | (given == ""), F.lit(default)).otherwise(given)))

    tax = worded("vehicle_tax_type", DEFAULT_TAX)
    cleared = reduce(lambda a, b: a | b, [F.contains(tax, F.lit(word)) for word in CLEARED_TAX_WORDS])
    km = F.col("vehicle_mileage_km")
    excess = km - F.greatest(F.lit(1), F.lit(as_of_year) - year) * KM_PER_YEAR
    km_effect = F.when(
        km > 0,
        F.greatest(F.lit(KM_FLOOR), F.least(F.lit(KM_CEILING), -(excess / F.lit(KM_STEP)) * F.lit(KM_STEP_EFFECT))),
    ).otherwise(F.lit(0.0))
    condition_factor = F.when(worded("vehicle_condition", DEFAULT_CONDITION) == "new", NEW_FACTOR).otherwise(1.0)
    tax_factor = F.when(cleared, CLEARED_TAX_FACTOR).otherwise(1.0)

    priced = joined.withColumn(
        "predicted_price_usd", _bounded(_hundreds(base * condition_factor * tax_factor * (F.lit(1.0) + km_effect)))
    )
    price = F.col("predicted_price_usd")
    return priced.select(
        *columns,
        "predicted_price_usd",
        F.greatest(F.lit(PRICE_MIN), _hundreds(price * BAND_LOW)).alias("price_range_low_usd"),
        F.least(F.lit(PRICE_MAX), _hundreds(price * BAND_HIGH)).alias("price_range_high_usd"),
        F.coalesce("_size", F.lit(0)).cast("bigint").alias("market_sample_size"),
        basis.alias("valuation_basis"),
        age.alias("estimated_age_years"),
        F.lit("USD").alias("currency"),
    )


def answer_requests(
    requests: DataFrame, market: DataFrame, rules: Rules, index: DataFrame | None = None
) -> DataFrame:
    """Check requests and price the valid ones.

    Every request comes back once, either with its estimate and a null ``reject_reason`` or
    with the reason and no estimate.
    """
    checked = reject_requests(requests, rules)
    priced = value_requests(checked.filter("reject_reason is null"), market, rules.as_of_year, index)
    return priced.unionByName(checked.filter("reject_reason is not null"), allowMissingColumns=True)

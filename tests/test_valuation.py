"""Estimates against a request-by-request evaluation in plain Python."""

import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from lotwise.operators import valuation
from lotwise.operators.cleaning import Rules
from lotwise.operators.valuation import answer_requests, market_index, value_requests
from lotwise.session import spread_shuffles

AS_OF = 2026
REQUEST = (
    "request_id int, vehicle_brand string, vehicle_model string, vehicle_model_year int, vehicle_condition string, "
    "vehicle_tax_type string, vehicle_mileage_km bigint"
)
MARKET = "vehicle_brand string, vehicle_model string, vehicle_model_year int, price double"


def bounded(value):
    return max(500.0, min(300000.0, value))


def by_hand(request, market):
    _, brand, model, year, condition, tax, km = request
    brand, model = (brand or "").strip().lower(), (model or "").strip().lower()
    target = year or AS_OF - 5
    same_brand = [r for r in market if r[3] is not None and (r[0] or "").lower() == brand and brand]
    same_model = [r for r in same_brand if model and r[1] is not None and model in r[1].lower()]
    same_year = [r for r in same_model if r[2] == target]

    def drifted(rows):
        years = [r[2] for r in rows if r[2] is not None]
        reference = statistics.median(years) if years else AS_OF - 5
        return statistics.median(r[3] for r in rows) * 1.065 ** (target - reference)

    if len(same_year) >= 3:
        base, size, basis = statistics.median(r[3] for r in same_year), len(same_year), f"exact_match_{brand}_{model}_{target}"
    elif len(same_model) >= 3:
        base, size, basis = drifted(same_model), len(same_model), f"brand_model_median_{brand}_{model}"
    elif len(same_brand) >= 3:
        base, size, basis = drifted(same_brand), len(same_brand), f"brand_median_{brand}"
    else:
        base, size, basis = 22500 * 0.935 ** max(0, AS_OF - target), 0, "general_cambodia_market_prior"
    condition = (condition or "used").strip().lower()
    tax = (tax or "plate number").strip().lower()
    effect = 0.0
    if km is not None and km > 0:
        effect = max(-0.15, min(0.10, -((km - max(1, AS_OF - target) * 15000) / 20000.0) * 0.015))
    raised = 1.10 if any(word in tax for word in ("tax paper", "import", "ក្រដាសពន្ធ")) else 1.0
    price = bounded(round(base * (1.25 if condition == "new" else 1.0) * raised * (1 + effect), -2))
    return (
        price,
        max(500.0, round(price * 0.88, -2)),
        min(300000.0, round(price * 1.12, -2)),
        size,
        basis,
        max(0, AS_OF - target),
        "USD",
    )


def estimates(spark, requests, market, **options):
    out = value_requests(
        spark.createDataFrame(requests, REQUEST), spark.createDataFrame(market, MARKET), AS_OF, **options
    )
    return {row.request_id: tuple(row)[7:] for row in out.collect()}


def test_random_requests(spark):
    rng = random.Random(4)
    brands, models = ["Toyota", "KIA", "Jeep"], ["Camry", "camry SE", "Corolla Cross", "Cross", "K5", None]
    market = [
        (
            rng.choice(brands[:1] * 3 + brands),
            rng.choice(models),
            rng.choice([None, 2014, 2015, 2016, 2020]),
            rng.choice([None, *[float(rng.randint(10, 4000) * 100) for _ in range(9)]]),
        )
        for _ in range(150)
    ] + [("Lada", "Niva", None, 5000.0)] * 3
    requests = [
        (
            i,
            rng.choice([*brands, " toyota ", "Lada", "Nobody", "", None]),
            rng.choice([*models, "a", "cross", " ", "M", "Camry SE Long"]),
            rng.choice([2015, 2016, 2020, 2026, 2027, 0, None]),
            rng.choice(["New ", "used", None, ""]),
            rng.choice(["Tax Paper", "imported", "ក្រដាសពន្ធ", "plate number", None, ""]),
            rng.choice([None, 0, -5, 100, 60_000, 900_000]),
        )
        for i in range(400)
    ]
    got = estimates(spark, requests, market)
    assert len(got) == len(requests)
    tiers = set()
    for request in requests:
        want = by_hand(request, market)
        assert got[request[0]] == want, request
        tiers.add(want[4].split("_")[0] + want[4].split("_")[1])
    assert tiers == {"exactmatch", "brandmodel", "brandmedian", "generalcambodia"}


@pytest.mark.parametrize(
    ("condition", "tax", "expected"),
    [
        ("used", "plate number", (22500.0, 19800.0, 25200.0)),
        ("new", "plate number", (28100.0, 24700.0, 31500.0)),
        ("used", "tax paper", (24800.0, 21800.0, 27800.0)),
    ],
)
def test_prior(spark, condition, tax, expected):
    got = estimates(spark, [(1, "X", "Y", 2026, condition, tax, None)], [("A", "B", 2000, 1.0)])
    assert got[1][:3] == expected and got[1][5] == 0


def test_stored_index(spark):
    market = [("Kia", "K5", 2020, price) for price in (10000.0, 20000.0, 40000.0)]
    index = market_index(spark.createDataFrame(market, MARKET))
    got = estimates(spark, [(1, "kia", "k5", 2020, None, None, None)], market, index=index)
    assert got[1][0] == 20000.0 and got[1][3] == 3


def test_invalid_requests_get_a_reason_instead_of_a_price(spark):
    market = spark.createDataFrame([("Kia", "K5", 2019, 9000.0 + i) for i in range(3)], MARKET)
    rows = [
        (1, "Kia", "K5", 2019, "used", None, 60000),
        (2, "Kia", "K5", 1900, "used", None, 60000),
        (3, "Kia", "K5", 2019, "used", None, -1),
        (4, None, "K5", 2019, "used", None, 1),
    ]
    answers = answer_requests(spark.createDataFrame(rows, REQUEST), market, Rules(as_of_year=AS_OF)).collect()
    got = {r.request_id: (r.reject_reason, r.predicted_price_usd is None) for r in answers}
    assert got == {
        1: (None, False),
        2: ("year_out_of_range", True),
        3: ("negative_mileage", True),
        4: ("missing_brand", True),
    }


def test_partitions_behind_a_shuffle_follow_the_rows(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(name, None)

    def started(rows):
        """Partitions that the shuffle of a grouping starts with."""
        with spread_shuffles(spark, rows, task_rows=100):
            counts = spark.range(rows).groupBy((F.col("id") % 97).alias("k")).agg(F.count(F.lit(1)).alias("n"))
            counts.collect()
        plan = counts._jdf.queryExecution().executedPlan().toString()
        return int(re.search(r"hashpartitioning\(\w+#\d+L?, (\d+)\)", plan).group(1))

    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert started(100) == own
    assert started(100 * 10 * own) == 10 * own + 1
    assert spark.conf.get(name, None) == before
    with pytest.raises(ValueError), spread_shuffles(spark, 10**6, task_rows=1):
        raise ValueError
    assert spark.conf.get(name, None) == before


def test_medians_are_stored_before_estimates_are_returned(spark, monkeypatch):
    stored, whole = [], valuation.through_table
    monkeypatch.setattr(valuation, "through_table", lambda df, label: stored.append(label) or whole(df, label))
    market = spark.createDataFrame([("Toyota", "Camry", 2000, 9000.0)] * 3, MARKET)
    asked = spark.createDataFrame([("toyota", "camry", 2000)], "_b string, _m string, _y int")
    found = valuation.comparables(asked, valuation.market_index(market)).collect()
    assert [(row._tier, row._median, row._size) for row in found] == [(1, 9000.0, 3)]
    assert stored == ["chosen-sets", "set-medians"]

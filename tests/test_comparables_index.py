import pytest
from pyspark.sql import functions as F

from lotwise.operators import comparables_index
from lotwise.operators.valuation import value_requests

REQUEST = "vehicle_brand string, vehicle_model string, vehicle_model_year int, vehicle_condition string, vehicle_tax_type string, vehicle_mileage_km bigint"


@pytest.fixture(scope="module")
def market_rows(spark):
    brands, models = ["Kia", "KIA", "Ford", "Audi", None], ["K5", "k5 gt", "Ranger wildtrak 4x4 limited", "", None, "A4"]
    rows = [
        (brands[i % 5], models[i * 7 % 6], [2015, 2018, None, 2020][i % 4], [1000.0 + i * 37 % 900, None, float("nan")][i % 11 // 9])
        for i in range(300)
    ]
    return spark.createDataFrame(rows, "vehicle_brand string, vehicle_model string, vehicle_model_year int, price double")


def asked(spark, *brands):
    models = ["K5", " gt ", "ranger WILDTRAK 4x4", "", None, "zeppelin"]
    rows = [(b, m, y, "new", "import", 30_000) for b in brands for m in models for y in (2015, 2018, 0, None, 1999)]
    return spark.createDataFrame(rows, REQUEST)


@pytest.fixture(scope="module")
def index(spark, market_rows, tmp_path_factory):
    return comparables_index.build(market_rows, str(tmp_path_factory.mktemp("index") / "kia"), buckets=16, files=2)


def test_index_gives_the_same_estimates(spark, market_rows, index):
    requests = asked(spark, "Kia", "ford", "AUDI", "nobody", None)
    got = comparables_index.value_indexed(requests, index, 2021)
    want = value_requests(requests, market_rows, 2021)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert {r.valuation_basis.split("_")[0] for r in got.collect()} == {"exact", "brand", "general"}


def test_only_buckets_of_the_brands_asked_for_are_read(spark, index):
    (bucket,) = asked(spark, "Kia").select(index.bucket(F.lower("vehicle_brand"))).distinct().first()
    for name in ("prices", "names", "pieces", "brands"):
        part, whole = index.table(spark, name, [bucket]), index.table(spark, name)
        assert 0 < part.count() < whole.count()
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and f"= {bucket})" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_empty_market_and_no_requests(spark, market_rows, index, tmp_path):
    none = comparables_index.build(market_rows.filter("false"), str(tmp_path / "none"), buckets=4)
    rows = comparables_index.value_indexed(asked(spark, "Kia"), none, 2021).collect()
    assert {r.valuation_basis for r in rows} == {"general_cambodia_market_prior"} and len(rows) == 30
    assert comparables_index.value_indexed(asked(spark, "Kia").filter("false"), index, 2021).collect() == []

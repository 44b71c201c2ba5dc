import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lotwise.contract import CLEAN_COLUMNS, LEGACY_NAMES, RAW, RAW_COLUMNS, SAMPLE_COLUMNS
from lotwise.functions.times import instant
from lotwise.operators import cleaning, market, merge, profiling
from lotwise.operators.cleaning import Rules
from lotwise.operators.dedup import keep_first, keep_last
from lotwise.operators.joins import contains_join, only_new, salted_lookup
from lotwise.operators.quantiles import count_values, exact_quantiles

RULES = Rules(as_of_year=2026)


def raw_rows(spark, rows, schema):
    return merge.conform(spark.createDataFrame(rows, schema))


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        ("k", 2750.0, 2004, " Pre-Owned", "m01"),
        ("k", 2600.0, 2004, "used", "m03"),
        ("k", 2700.0, 2004, "Used ", "m02"),
        ("l", 499.99, 2012, "new", "m04"),
        ("m", 300_000.01, 2022, "used", "m05"),
        ("n", float("nan"), 2015, "used", "m06"),
        ("o", 8_000.0, 1989, "used", "m07"),
        ("p", 300_000.0, 2027, "Second Hand", "m08"),
        ("q", None, None, None, "m09"),
    ]
    schema = "listing_id string, price double, vehicle_model_year int, vehicle_condition string, scraped_at string"
    return raw_rows(spark, rows, schema)


def test_contract_sizes():
    assert len(RAW_COLUMNS) == len(set(RAW_COLUMNS)) == 54
    assert len(CLEAN_COLUMNS) == 34 and set(CLEAN_COLUMNS) < set(RAW_COLUMNS)
    assert len(SAMPLE_COLUMNS) == 21
    assert len(LEGACY_NAMES) == 17 and set(LEGACY_NAMES.values()) < set(CLEAN_COLUMNS)


def test_clean(raw):
    out = cleaning.clean(raw, RULES)
    assert out.columns == CLEAN_COLUMNS
    rows = {r.listing_id: (r.price, r.vehicle_condition) for r in out.collect()}
    assert rows == {"k": (2600.0, "used"), "p": (300_000.0, "used")}
    categories = ("vehicle_tax_type", "vehicle_brand", "province", "vehicle_transmission", "vehicle_fuel_type")
    assert {r[name] for r in out.collect() for name in categories} == {"unknown"}
    cleaning.require_integrity(out, RULES)


def test_clean_needs_every_contract_column(raw):
    with pytest.raises(AnalysisException):
        cleaning.clean(raw.drop("vehicle_model_year"), RULES)


def test_year_bound_follows_as_of_year(raw):
    assert cleaning.clean(raw, Rules(as_of_year=2025)).count() == 1


def test_audit_and_integrity(raw):
    lines = [(r.rule, r.removed, r.remaining) for r in cleaning.rule_audit(raw, RULES).orderBy("rule").collect()]
    assert lines == [("1 has price", 2, 7), ("2 price range", 2, 5), ("3 model year", 1, 4), ("6 last per id", 2, 2)]
    found = cleaning.integrity(raw, RULES).first()
    assert (found["rows"], found.duplicate_ids, found.bad_prices, found.bad_years) == (9, 2, 4, 1)
    with pytest.raises(ValueError, match="duplicate_ids"):
        cleaning.require_integrity(raw.select(CLEAN_COLUMNS), RULES)
    with pytest.raises(ValueError, match="columns"):
        cleaning.require_integrity(raw, RULES)


def test_deduplication_collapses_hot_keys_before_the_shuffle(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("at"), F.lit("x").alias("v")
    )
    last = keep_last(rows, "k", ["at"])
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max_by") > plan.index("Exchange")  # below the exchange
    assert "Window" not in plan
    kept = {r.k: r["at"] for r in last.collect()}
    assert kept[0] == 19998 and len(kept) == 1 + 20000 - 6667
    assert keep_first(rows, "k", ["at"], ["at"]).filter("at = 0").count() == 1


def group_values(seed):
    rng = random.Random(seed)
    values = defaultdict(list)
    for _ in range(6000):
        group = "hot" if rng.random() < 0.4 else f"g{rng.randint(0, 30)}"
        value = rng.choice([round(rng.uniform(500, 300000), 2), rng.uniform(-5, 5), 1000.0, 0.0, -0.0, 1e-300, -1e250])
        values[group].append(value)
    values["one"] = [3.5]
    values["two"] = [1.0, 2.0]
    return values


@pytest.mark.parametrize("counted", [False, True])
def test_quantiles_match_numpy(spark, counted):
    values = group_values(3)
    rows = [(g, v) for g, vs in values.items() for v in vs] + [("hot", None), ("hot", float("nan")), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    wanted = {"lo": 0.0, "q1": 0.25, "p37": 0.37, "mid": 0.5, "hi": 1.0}
    if counted:
        out = exact_quantiles(count_values(df, ["g"], "v"), ["g"], "v", wanted, weight="weight")
    else:
        out = exact_quantiles(df, ["g"], "v", wanted)
    assert "percentile" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.g: r for r in out.collect()}
    assert set(got) == set(values)
    for group, members in values.items():
        assert got[group].n == len(members)
        for name, p in wanted.items():
            assert got[group][name] == pytest.approx(np.quantile(members, p), rel=1e-12, abs=1e-12), (group, name)


def test_quantiles_without_groups(spark):
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("v"))
    row = exact_quantiles(df, [], "v", {"mid": 0.5, "q1": 0.25}).first()
    assert (row.n, row.mid, row.q1) == (100, 50.5, 25.75)
    assert exact_quantiles(df.filter("v < 0"), [], "v", {"mid": 0.5}).count() == 0


def test_describe_and_skew(spark):
    values = [1.0, 2.0, 4.0, 10.0]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "price double")
    got, want = profiling.describe(df, "price").first(), pd.Series(values).describe()
    assert [got[n] for n in ("count", "mean", "min", "q1", "median", "q3", "max")] == [
        want[n] for n in ("count", "mean", "min", "25%", "50%", "75%", "max")
    ]
    assert got["std"] == pytest.approx(want["std"])
    assert profiling.skew_and_log(df, "price").first().skew == pytest.approx(pd.Series(values).skew())
    flat = spark.createDataFrame([(5.0,)] * 4, "price double")
    assert profiling.skew_and_log(flat, "price").first().skew is None
    assert profiling.describe(df.filter("price < 0"), "price").first()["count"] == 0


def test_describe_by_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "k string, price double")
    rows = {r.k: (r["count"], r.mean, r.median) for r in profiling.describe(df, "price", ["k"]).collect()}
    assert rows == {"a": (2, 2.0, 2.0), "b": (1, 5.0, 5.0)}


def test_correlations_skip_missing_and_flat_columns(spark):
    rows = [(1.0, 2.0, 5.0, None), (2.0, 1.0, 5.0, 3.0), (3.0, 5.0, 5.0, 1.0), (4.0, None, 5.0, 9.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    want = pd.DataFrame(rows, columns=list("abcd")).corr()
    for row in profiling.correlations(df, list("abcd")).collect():
        expected = want.loc[row.x, row.y]
        if np.isnan(expected):
            assert row["corr"] is None
        else:
            assert row["corr"] == pytest.approx(expected)


def test_histogram(spark):
    rng = np.random.default_rng(1)
    values = [*rng.uniform(500, 300000, 500), 500.0, 300000.0]
    df = spark.createDataFrame([(float(v),) for v in values], "price double")
    counts, edges = np.histogram(values, bins=40)
    rows = profiling.histogram(df, F.col("price")).orderBy("bin").collect()
    assert [r.n for r in rows] == counts.tolist()
    assert [r.bin_start for r in rows] == pytest.approx(edges[:-1].tolist())
    flat = profiling.histogram(df.limit(1), F.col("price")).collect()
    assert sum(r.n for r in flat) == 1 and len(flat) == 40


def test_completeness(spark):
    rows = raw_rows(spark, [("1", 1000.0, "Toyota"), ("2", 2000.0, "Lexus")], "listing_id string, price double, vehicle_brand string")
    profile = {r.column_name: r for r in profiling.completeness(rows).collect()}
    assert list(profile) == RAW_COLUMNS
    assert profile["price"].non_null_pct == 100.0 and not profile["price"].is_constant
    assert profile["raw_specs"].non_null == 0 and profile["raw_specs"].is_constant
    assert profiling.completeness(rows.limit(0)).count() == 0
    gate = profiling.quality_gate(rows).first()
    assert (gate.total_listings, gate.priced, gate.requirements_met) == (2, 2, False)
    assert profiling.missing_profile(rows).first().missing_pct == 100.0


def test_box_stats(spark):
    rng = np.random.default_rng(5)
    values = [*rng.normal(100, 10, 300), 300.0, -50.0, 301.0]
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("b", 1.0)], "k string, price double")
    row = profiling.box_stats(df, "k", "price").filter("k = 'a'").first()
    q1, q3 = np.quantile(values, [0.25, 0.75])
    inside = [v for v in values if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
    assert (row.n, row.outliers) == (len(values), len(values) - len(inside))
    assert (row.whisker_low, row.whisker_high) == pytest.approx((min(inside), max(inside)))


def market_rows(spark):
    rows = [("a", "x", 10.0, "2026-01-01T00:00:00+00:00")] * 3 + [("b", "x", 20.0, "2026-01-03T12:00:00+00:00")] * 3
    rows += [("c", "y", None, None), (None, None, 40.0, None), ("c", "y", 30.0, None), ("c", "z", 31.0, None)]
    return spark.createDataFrame(rows, "vehicle_brand string, province string, price double, scraped_at string")


def test_market_summary(spark):
    as_of = F.lit("2026-01-10 00:00:00").cast("timestamp")
    row = market.market_summary(market_rows(spark), instant(F.col("scraped_at")), as_of).first()
    assert (row.total_listings, row.median_price, row.min_price, row.max_price) == (9, 20.0, 10.0, 40.0)
    assert row.mean_price == 21.22 and row.freshness_days == 6.5
    assert [tuple(b) for b in row.top_brands] == [("a", 3, 10.0), ("b", 3, 20.0), ("c", 3, 30.5)]
    assert [tuple(p) for p in row.top_provinces] == [("x", 6), ("y", 2), ("z", 1)]
    empty = market.market_summary(market_rows(spark).limit(0), instant(F.col("scraped_at")), as_of).first()
    assert empty.total_listings == 0 and empty.median_price is None and empty.top_brands == []


def test_freshness(spark):
    df = market_rows(spark)
    as_of = F.lit("2026-02-03 00:00:00").cast("timestamp")
    assert market.freshness(df, instant(F.col("scraped_at")), as_of).first().is_stale is True
    fresh = market.freshness(df.filter("price is null"), instant(F.col("scraped_at")), as_of).first()
    assert fresh.freshness_days is None


def test_merge_keeps_the_newest(spark):
    old = spark.createDataFrame([("1", 1000), ("2", 2000)], "listing_id string, price bigint")
    new = spark.createDataFrame([("1", 9999, "t"), ("3", 3000, "u")], "listing_id string, price bigint, listing_title string")
    merged = merge.upsert(old, new)
    assert merged.columns == RAW_COLUMNS and merged.schema["price"].dataType == RAW["price"].dataType
    assert {r.listing_id: (r.price, r.listing_title) for r in merged.collect()} == {
        "1": (9999.0, "t"),
        "2": (2000.0, None),
        "3": (3000.0, "u"),
    }


def test_merge_carries_variants(spark):
    old = spark.createDataFrame([("1", '{"a":1}')], "listing_id string, j string")
    old = old.select("listing_id", F.parse_json("j").alias("raw_specs"))
    assert merge.upsert(old, old.limit(0)).select(F.to_json("raw_specs")).first()[0] == '{"a":1}'


def test_new_listings(spark):
    batch = spark.createDataFrame([("1", 2, "b"), ("1", 1, "a"), ("2", 3, "c"), ("9", 4, "d")], "listing_id string, at int, v string")
    stored = spark.createDataFrame([(9,), (8,)], "listing_id int")
    fresh = only_new(keep_first(batch, "listing_id", ["at"]), stored, "listing_id")
    assert sorted((r.listing_id, r.v) for r in fresh.collect()) == [("1", "a"), ("2", "c")]
    assert merge.new_listings(batch, stored, ["at"]).count() == 2


def test_details_overwrite_or_fill(spark):
    raw = raw_rows(
        spark,
        [("1", "old", 5, 1.0, "Manual"), ("2", "old", 5, 1.0, "Manual"), ("3", "old", 5, 1.0, "Manual")],
        "listing_id string, description string, likes_count int, sale_price double, vehicle_transmission string",
    )
    details = spark.createDataFrame(
        [("1", True, None, 9, None, "Automatic"), ("2", False, "new", 9, 2.0, "x"), ("7", True, "new", 9, 2.0, "x")],
        "listing_id string, matched boolean, description string, likes_count int, sale_price double, vehicle_transmission string",
    )
    out = merge.apply_details(raw, details)
    assert out.columns == RAW_COLUMNS
    got = {r.listing_id: (r.description, r.likes_count, r.sale_price, r.vehicle_transmission) for r in out.collect()}
    untouched = ("old", 5, 1.0, "Manual")
    assert got == {"1": (None, 9, 1.0, "Automatic"), "2": untouched, "3": untouched}


def test_unenriched_ids(spark):
    df = spark.createDataFrame([("3", None), ("1", ""), ("2", "{}")], "listing_id string, raw_detail_payload string")
    assert [r[0] for r in merge.unenriched(df).orderBy("listing_id").collect()] == ["1", "3"]
    assert [r[0] for r in merge.unenriched(df, limit=1).collect()] == ["1"]
    assert merge.unenriched(df, force=True).count() == 3
    typed = df.withColumn("raw_detail_payload", F.try_parse_json("raw_detail_payload"))
    assert merge.unenriched(typed).count() == 2


def test_contains_join_matches_brute_force(spark):
    rng = random.Random(11)

    def word(low, high):
        return "".join(rng.choice("abc ") for _ in range(rng.randint(low, high)))

    needles = {("hot" if i % 3 else "k", word(1, 12)) for i in range(300)}
    texts = {("hot" if i % 3 else "k", word(0, 30)) for i in range(300)}
    a = spark.createDataFrame(sorted(needles), "on string, needle string")
    b = spark.createDataFrame(sorted(texts), "on string, text string")
    joined = contains_join(a, b, "on", "needle", "text")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = Counter((r["on"], r.needle, r.text) for r in joined.collect())
    assert got == Counter((k, n, t) for k, n in needles for j, t in texts if j == k and n in t)


def test_salted_lookup_spreads_a_group(spark):
    rows = spark.range(1000).select(F.lit("hot").alias("k"), F.col("id").alias("v"))
    groups = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, w int")
    out = salted_lookup(rows, groups, ["k"], "v", salts=4)
    assert out.columns == ["k", "v", "w"] and out.agg(F.sum("w")).first()[0] == 1000


def test_renames_and_flags(spark):
    legacy = spark.createDataFrame([(1, "t", True)], "id int, title string, is_like boolean")
    renamed = merge.rename_legacy(legacy)
    assert renamed.columns == ["listing_id", "listing_title", "is_like"]
    assert merge.legacy_flags(renamed).first().is_like == 1
    assert merge.pick_present(renamed, ["x", "is_like", "listing_id"]).columns == ["is_like", "listing_id"]


def test_request_validation(spark):
    rows = [("T", "C", 2019, 5), ("T", "C", 1950, 5), ("T", "C", 2020, -1), ("T", "C", 2020, None), (None, "C", 2020, 1)]
    df = spark.createDataFrame(rows, "vehicle_brand string, vehicle_model string, vehicle_model_year int, vehicle_mileage_km bigint")
    assert [r.reject_reason for r in cleaning.reject_requests(df, RULES).collect()] == [
        None, "year_out_of_range", "negative_mileage", None, "missing_brand"
    ]


def test_quantiles_take_infinity_as_a_value(spark):
    values = [float("-inf"), 1.0, 2.0, 5.0, float("inf"), float("inf"), float("nan"), None]
    df = spark.createDataFrame([("g", v) for v in values], "k string, v double")
    row = exact_quantiles(df, ["k"], "v", {"low": 0.0, "mid": 0.5, "high": 1.0}).first()
    assert (row.n, row.low, row.mid, row.high) == (6, float("-inf"), 3.5, float("inf"))

"""Statistics and checks that share a scan with other work."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from test_storage import minimal

from lotwise.operators import profiling
from lotwise.operators.cleaning import ObservedCleaning, Rules, clean, integrity, rule_audit
from lotwise.operators.profiling import Leaders
from lotwise.sources import writers

RULES = Rules(as_of_year=2026)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def random_columns(seed, rows=400):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=rows)
    data = pd.DataFrame(
        {
            "a": base * 1e-3 + 1e6,  # a small spread around a large mean
            "b": base + rng.normal(size=rows),
            "c": np.where(rng.random(rows) < 0.5, 1.0, np.nan),
            "d": rng.integers(0, 3, rows).astype(float),
            "e": 7.1,
        }
    )
    for name in "bd":
        data.loc[rng.random(rows) < 0.4, name] = np.nan
    return data


@pytest.mark.parametrize("seed", [1, 2])
def test_correlations_equal_pandas(spark, seed):
    data = random_columns(seed)
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in row) for row in data.values], "a double, b double, c double, d double, e double")
    want, got = data.corr(), profiling.correlations(df.repartition(3), list("abcde")).collect()
    assert len(got) == 25
    for row in got:
        expected = want.loc[row.x, row.y]
        if row.x in "ce" or row.y in "ce":
            assert row["corr"] is None
        else:
            assert row["corr"] == pytest.approx(expected, abs=1e-6)  # pandas loses digits here too


def test_correlations_of_pairs_that_never_meet(spark):
    rows = [(1.0, None), (2.0, None), (None, 3.0), (None, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = {(r.x, r.y): r["corr"] for r in profiling.correlations(df, ["a", "b"]).collect()}
    assert got == {("a", "a"): 1.0, ("b", "b"): 1.0, ("a", "b"): None, ("b", "a"): None}
    none = profiling.correlations(df.filter("false"), ["a", "b"]).collect()
    assert len(none) == 4 and all(r["corr"] is None for r in none)
    # one row for each pattern of missing values, whatever the number of rows
    assert profiling.null_pattern_sums(df, ["a", "b"]).count() == 2


def box_rows(spark):
    rows = [(f"k{i % 7}", ["x", "y", None][i % 3], i % 2, float(i * i % 97) if i % 11 else None) for i in range(300)]
    return spark.createDataFrame([*rows, ("k1", "x", 0, 1e9), ("k9", "x", 0, None)], "brand string, place string, flag int, price double")


def test_boxes_of_all_dimensions_equal_single_ones(spark):
    df = box_rows(spark)
    got = profiling.box_stats_many(df, {"brand": None, "place": None, "flag": None}, "price").collect()
    want = [
        (name, str(r[name]), *r[1:]) for name in ("brand", "place", "flag") for r in profiling.box_stats(df, name, "price").collect()
    ]
    assert sorted(map(tuple, got)) == sorted(want)


def test_boxes_of_the_leading_groups(spark):
    df = box_rows(spark)
    leaders = {"brand": Leaders(2, ("k0",)), "place": None}
    got = {(r.dimension, r.group) for r in profiling.box_stats_many(df, leaders, "price").collect()}
    assert got == {("brand", "k1"), ("brand", "k2"), ("place", "x"), ("place", "y")}
    assert profiling.box_stats_many(df.filter("false"), leaders, "price").collect() == []


def test_all_dimensions_take_one_scan(spark, tmp_path):
    box_rows(spark).write.parquet(str(tmp_path / "t"))
    counts = profiling.counts_by_dimension(spark.read.parquet(str(tmp_path / "t")), ["brand", "place"], "price")
    assert plan_of(counts).count("FileScan") == 1


def raw_rows(spark):
    ids = [str(i % 40) for i in range(60)] + [None]
    rows = minimal(spark, *ids).withColumn("row", F.monotonically_increasing_id())
    price = F.when(F.col("listing_id").isNull(), F.lit(9999.0)).when(F.col("row") % 7 == 0, F.lit(None)).when(F.col("row") % 5 == 0, F.lit(3.0)).otherwise(F.lit(9000.0) + F.col("row"))
    year = F.when(F.col("listing_id").isNull(), F.lit(None)).when(F.col("row") % 3 == 0, F.lit(1950)).when(F.col("row") % 4 == 0, F.lit(2020))
    return rows.withColumns({"price": price, "vehicle_model_year": year.cast("int"), "scraped_at": F.col("row").cast("string")}).drop("row")


def test_observed_cleaning(spark, tmp_path):
    raw = raw_rows(spark)
    raw.write.parquet(str(tmp_path / "raw"))
    raw = spark.read.schema(raw.schema).parquet(str(tmp_path / "raw"))
    observed = ObservedCleaning(raw, RULES)
    assert plan_of(observed.rows).count("FileScan") == 1 and "likes_count" not in plan_of(observed.rows).split("ReadSchema")[1]
    observed.rows.write.parquet(str(tmp_path / "clean"))
    assert sorted(observed.audit(raw.count()).collect()) == sorted(rule_audit(raw, RULES).collect())
    with pytest.raises(RuntimeError, match="a stage was repeated"):
        observed.audit(raw.count() - 1)
    written = spark.read.parquet(str(tmp_path / "clean"))
    assert sorted(map(str, written.drop("raw_specs").collect())) == sorted(map(str, clean(raw, RULES).drop("raw_specs").collect()))
    with pytest.raises(ValueError, match="missing_ids"):
        observed.require()
    assert integrity(written, RULES).first().missing_ids == 1


def test_a_breach_keeps_the_snapshot_from_being_published(spark, tmp_path):
    root, good = str(tmp_path / "store"), raw_rows(spark).filter("listing_id is not null")
    done = writers.publish_clean(good, root, RULES, source=4)
    assert writers.latest_version(spark, root) == 1 and writers.latest_source(spark, root) == 4
    assert done.audit(60).count() == 4
    with pytest.raises(ValueError, match="missing_ids"):
        writers.publish_clean(raw_rows(spark), root, RULES)
    assert writers.latest_version(spark, root) == 1

import json

import pytest
from pyspark.sql import functions as F

from lotwise import Rules, read_csv, refresh

RULES = Rules(as_of_year=2026)


def land(folder, name, *items):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({"total": 9, "data": list(items)}) + "\n")


def item(i, price, title="Kia K5 2019", **more):
    return {"id": i, "title": title, "price": price, "location": {"en_name": " Phnom Penh "}, **more}


def run(spark, base, day):
    return refresh(
        spark, str(base / f"landing{day}"), str(base / "store"), RULES, f"2026-08-0{day}T00:00:00+00:00", "https://cars.example/"
    )


def test_two_refreshes(spark, tmp_path):
    land(tmp_path / "landing1", "a.json", item(1, "9000"), item(2, "10"), item(1, "8000"), {"title": "no id"})
    first = run(spark, tmp_path, 1)
    assert not first.caught_up
    assert {r.listing_id: r.price for r in first.raw.collect()} == {"1": 9000.0, "2": 10.0}
    (row,) = first.clean.collect()
    assert (row.listing_id, row.vehicle_brand, row.province, row.vehicle_fuel_type) == ("1", "kia", "phnom penh", "unknown")
    assert first.quality().first().requirements_met is False and first.completeness().count() == 54
    assert [r.listings for r in first.brands().collect()] == [1]

    land(tmp_path / "landing2", "a.json", item(1, "7000"), item(3, "20000", "Prius"))
    second = run(spark, tmp_path, 2)
    assert {r.listing_id: r.price for r in second.raw.collect()} == {"1": 9000.0, "2": 10.0, "3": 20000.0}
    assert second.clean.count() == 2
    fresh = second.freshness(F.lit("2026-08-05 00:00:00+00:00").cast("timestamp")).first()
    assert fresh.freshness_days == 3.0 and fresh.is_stale is False

    third = run(spark, tmp_path, 2)
    assert third.caught_up and third.raw.count() == 3
    assert read_csv(spark, str(tmp_path / "store/samples/clean_60"), third.clean.drop("raw_specs", "seller_phones").schema).count() == 2
    assert spark.read.parquet(str(tmp_path / "store/rejects")).count() == 1


def test_a_refresh_makes_up_for_a_failed_one(spark, tmp_path, monkeypatch):
    land(tmp_path / "landing1", "a.json", item(1, "9000"))
    run(spark, tmp_path, 1)
    land(tmp_path / "landing2", "a.json", item(2, "8000"), {"title": "no id"})

    def fail(*args):
        raise OSError("disk")

    with monkeypatch.context() as broken:
        broken.setattr("lotwise.sources.writers.write_samples", fail)
        with pytest.raises(OSError):
            run(spark, tmp_path, 2)
    retried = run(spark, tmp_path, 2)
    assert retried.caught_up and retried.raw.count() == 2 and retried.clean.count() == 2
    assert spark.read.parquet(str(tmp_path / "store/rejects")).count() == 1
    assert retried.summary(F.lit("2026-08-05 00:00:00+00:00").cast("timestamp")).count() == 1

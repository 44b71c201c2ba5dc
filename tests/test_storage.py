import json

import pytest
from pyspark.sql import functions as F

from lotwise.contract import RAW, RAW_COLUMNS, SAMPLE_COLUMNS
from lotwise.operators.cleaning import Rules
from lotwise.operators.merge import conform, upsert
from lotwise.session import scratch_dir, through_table
from lotwise.sources import readers, writers


def minimal(spark, *ids):
    return conform(
        spark.createDataFrame([(i, f"Car {i}", 1000.0) for i in ids], "listing_id string, listing_title string, price double")
    )


def test_raw_round_trip(spark, tmp_path):
    first = minimal(spark, "1").withColumns(
        {
            "seller_phones": F.array(F.lit("012345")),
            "image_urls": F.array(F.lit("https://img.example/a-b.jpg")),
            "raw_specs": F.parse_json(F.lit('{"car-year":2020}')),
            "location_coordinates": F.parse_json(F.lit('{"x":"11.5","z":15}')),
            "raw_detail_payload": F.parse_json(F.lit('{"id":1,"title":"Car"}')),
        }
    )
    path = writers.write_raw(first.unionByName(minimal(spark, "2")), str(tmp_path / "raw"))
    stored = readers.read_raw(spark, path)
    assert stored.columns == RAW_COLUMNS
    row = writers.encode_json_cells(stored).orderBy("listing_id").first()
    assert json.loads(row.seller_phones) == ["012345"] and json.loads(row.raw_specs) == {"car-year": 2020}
    assert json.loads(row.location_coordinates) == {"x": "11.5", "z": 15}
    restored = readers.restore_json_cells(writers.encode_json_cells(stored))
    assert restored.schema["raw_specs"].dataType == RAW["raw_specs"].dataType
    assert restored.schema["seller_phones"].dataType == RAW["seller_phones"].dataType
    again = restored.orderBy("listing_id").select("seller_phones", F.to_json("raw_detail_payload").alias("p")).first()
    assert again.seller_phones == ["012345"] and json.loads(again.p)["title"] == "Car"


def test_restoring_leaves_plain_text(spark):
    df = spark.createDataFrame([('{"a":1}',), ("plain",), (None,), ("{broken",)], "raw_specs string")
    got = [r[0] for r in readers.restore_json_cells(df).select(F.to_json("raw_specs")).collect()]
    assert got == ['{"a":1}', '"plain"', None, None]


def test_missing_sources_are_empty(spark, tmp_path):
    assert readers.stored_ids(spark, str(tmp_path / "nope")).count() == 0
    (tmp_path / "bare").mkdir()
    assert readers.read_raw(spark, str(tmp_path / "bare")).count() == 0


def test_damaged_sources_are_errors_unless_asked_for(spark, tmp_path):
    broken = tmp_path / "broken.parquet"
    broken.write_bytes(b"this is no parquet file")
    for read in (readers.read_raw, readers.read_clean, readers.stored_ids):
        with pytest.raises(Exception):  # noqa: B017
            read(spark, str(broken)).collect()
    assert readers.clean_for_lookup(spark, str(broken)).count() == 0
    assert readers.stored_ids(spark, str(broken), unreadable_is_empty=True).count() == 0
    spark.createDataFrame([(1,), (2,), (2,)], "listing_id bigint").write.parquet(str(tmp_path / "ids"))
    with pytest.raises(Exception):  # noqa: B017 - a wrong type is an error, not an empty table
        readers.table_or_empty(spark, str(tmp_path / "ids"), "listing_id boolean").collect()


def test_a_damaged_snapshot_is_never_overwritten(spark, tmp_path):
    root = str(tmp_path / "store")
    path = writers.publish(spark, minimal(spark, *map(str, range(100))).repartition(4), root)
    files = sorted(p for p in (tmp_path / "store/snapshots").glob("*/part-*") if p.suffix == ".parquet")
    files[0].write_bytes(files[0].read_bytes()[:40])
    files[0].with_name(f".{files[0].name}.crc").unlink()
    with pytest.raises(Exception):  # noqa: B017
        writers.publish(spark, upsert(writers.current_snapshot(spark, root, RAW), minimal(spark, "new")), root)
    assert writers.latest_version(spark, root) == 1 and path.startswith(f"{root}/snapshots/00000001-")


def test_a_failed_check_leaves_the_snapshot(spark, tmp_path):
    root = str(tmp_path / "store")
    writers.publish(spark, minimal(spark, "1"), root, source=3)

    def refuse(written):
        raise ValueError(written.count())

    with pytest.raises(ValueError):
        writers.publish(spark, minimal(spark, "1", "2"), root, check=refuse)
    assert writers.current_snapshot(spark, root, RAW).count() == 1 and writers.latest_source(spark, root) == 3


def test_stored_ids_are_text(spark, tmp_path):
    minimal(spark, "1", "2", "3").write.parquet(str(tmp_path / "t"))
    ids = readers.stored_ids(spark, str(tmp_path / "t"))
    assert sorted(r.listing_id for r in ids.collect()) == ["1", "2", "3"]
    assert "ReadSchema: struct<listing_id:string>" in ids._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_samples(spark, tmp_path):
    rows = conform(spark.range(100).select(F.col("id").cast("string").alias("listing_id"), F.lit("a\n\"b\",ខ្មែរ").alias("listing_title")))
    sample = writers.sample_rows(rows, 30)
    assert sample.columns == SAMPLE_COLUMNS
    ids = [r.listing_id for r in sample.collect()]
    assert len(set(ids)) == 30 and ids == [r.listing_id for r in writers.sample_rows(rows.repartition(7), 30).collect()]
    assert sorted(ids, key=int) != [str(i) for i in range(30)]
    assert writers.sample_rows(rows.limit(7), 60).count() == 7
    with pytest.raises(ValueError):
        writers.sample_rows(rows, 45)
    paths = writers.write_samples(rows, str(tmp_path))
    schema = ", ".join(f"{name} string" for name in SAMPLE_COLUMNS)
    back = readers.read_csv(spark, paths[1], schema)
    assert back.count() == 60 and back.first().listing_title == "a\n\"b\",ខ្មែរ"


def test_csv_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "bom.csv"
    path.write_text('listing_id,listing_title,price\n1,"two\nlines ""x""",5.5\n', encoding="utf-8-sig")
    row = readers.read_csv(spark, str(path), "listing_id string, listing_title string, price double").first()
    assert tuple(row) == ("1", 'two\nlines "x"', 5.5)


def test_clean_and_snapshots(spark, tmp_path):
    path = writers.write_clean(minimal(spark, "1", "1", "2"), str(tmp_path / "clean"), Rules(as_of_year=2026))
    assert readers.read_clean(spark, path).count() == 2
    assert [r.listing_id for r in writers.head_rows(readers.read_clean(spark, path)).collect()] == ["1", "2"]
    root = str(tmp_path / "store")
    assert writers.current_snapshot(spark, root, RAW).count() == 0
    writers.publish(spark, minimal(spark, "1"), root)
    writers.publish(spark, writers.current_snapshot(spark, root, RAW).unionByName(minimal(spark, "2")), root)
    assert writers.latest_version(spark, root) == 2
    assert writers.current_snapshot(spark, root, RAW).count() == 2


def test_scratch_tables_use_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(shared) and scratch_dir(spark, "x") != scratch_dir(spark, "x")
    assert through_table(spark.range(3).toDF("v"), "three").count() == 3


def test_pages_and_feeds_from_files(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "123.html").write_text("<html>\nwhole\n</html>")
    assert tuple(readers.read_pages(spark, str(tmp_path / "pages")).first()) == ("123", "<html>\nwhole\n</html>")
    (tmp_path / "feed.json").write_text('{"data":[{"id":1}]}\n{broken\n')
    rows = readers.read_feed(spark, str(tmp_path / "feed.json")).select(F.to_json("envelope").alias("e")).collect()
    assert sorted(str(r.e) for r in rows) == ["None", '{"data":[{"id":1}]}']

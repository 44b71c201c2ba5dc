"""Incremental selection, upsert, enrichment and storage round trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.contract import LEGACY_NAMES, RAW
from lotwise.operators import merge
from lotwise.operators.dedup import keep_last
from lotwise.plans.listing_view import CLEAN_SQL, ORDER, RULES, clean_listings, listings
from lotwise.plans.registry import query, table
from lotwise.session import scratch_dir
from lotwise.sources import readers, writers

_CUTOFF = "1998-01-01"


@query(
    "new_listings_anti",
    f"""SELECT CAST(l_orderkey AS VARCHAR) AS listing_id, l_linenumber, l_partkey, l_extendedprice AS price
FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < TIMESTAMP '{_CUTOFF}')
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1""",
)
def _new_listings_anti(spark, folder):
    stored = table(spark, folder, "orders").filter(F.col("o_orderdate") < F.lit(_CUTOFF).cast("timestamp"))
    stored = stored.select(F.col("o_orderkey").cast("string").alias("listing_id"))
    batch = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("listing_id"),
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_extendedprice").alias("price"),
    )
    fresh = merge.new_listings(batch, stored, ["l_linenumber", "l_partkey", "l_suppkey", "price"])
    return fresh.drop("l_suppkey")


@query(
    "upsert_merge",
    """WITH merged AS (
  SELECT 0 AS side, o_orderkey AS id, CAST(NULL AS VARCHAR) AS title, o_totalprice AS price, o_orderdate AS seen FROM orders
  UNION ALL
  SELECT 1, o_orderkey, 'again ' || o_orderkey, o_totalprice * 0.5, o_orderdate FROM orders WHERE o_orderstatus = 'O'
  UNION ALL
  SELECT 1, o_orderkey, 'again ' || o_orderkey, o_totalprice * 0.25, o_orderdate + INTERVAL 1 DAY FROM orders
  WHERE o_orderstatus = 'O' AND o_orderkey % 2 = 0
  UNION ALL
  SELECT 1, o_orderkey + 1000000000, 'more ' || o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_orderstatus = 'P'
)
SELECT CAST(id AS VARCHAR) AS listing_id, title AS listing_title, price, strftime(seen, '%Y-%m-%d') AS scraped_at,
       CAST(NULL AS VARCHAR) AS province
FROM merged QUALIFY row_number() OVER (PARTITION BY id ORDER BY side DESC, seen DESC) = 1""",
)
def _upsert_merge(spark, folder):
    orders = table(spark, folder, "orders")

    def shaped(rows, title, factor, offset=0, days=0):
        columns = {
            "listing_id": (F.col("o_orderkey") + offset).cast("string"),
            "listing_title": F.concat(F.lit(title), F.col("o_orderkey").cast("string")) if title else F.lit(None),
            "price": F.col("o_totalprice") * factor,
            "scraped_at": F.date_format(F.date_add("o_orderdate", days), "yyyy-MM-dd"),
            "not_in_the_contract": F.lit(1),
        }
        if title is None:
            columns.pop("listing_title")
        return rows.select(*[value.alias(name) for name, value in columns.items()])

    open_orders = orders.filter("o_orderstatus = 'O'")
    old = shaped(orders, None, F.lit(1.0))
    new = (
        shaped(open_orders, "again ", F.lit(0.5))
        .unionByName(shaped(open_orders.filter("o_orderkey % 2 = 0"), "again ", F.lit(0.25), days=1))
        .unionByName(shaped(orders.filter("o_orderstatus = 'P'"), "more ", F.lit(1.0), offset=1_000_000_000))
    )
    merged = merge.upsert(old, new, order=["scraped_at"])
    return merged.select("listing_id", "listing_title", "price", "scraped_at", "province")


_DETAILS_SQL = """details AS (
  SELECT l_orderkey AS id, max(CASE WHEN l_quantity > 45 THEN 'pages of ' || l_orderkey END) AS description,
         CAST(count(*) AS INTEGER) AS likes, max(l_extendedprice) FILTER (l_linestatus = 'O') AS sale_price,
         max(CASE WHEN l_discount > 0.05 THEN 'Automatic' END) AS transmission
  FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1
)"""


def _order_details(spark, folder):
    returned = table(spark, folder, "lineitem").filter("l_returnflag = 'R'")
    page = F.when(F.col("l_quantity") > 45, F.concat(F.lit("pages of "), F.col("l_orderkey").cast("string")))
    return (
        returned.groupBy(F.col("l_orderkey").cast("string").alias("listing_id"))
        .agg(
            F.max(page).alias("description"),
            F.count(F.lit(1)).cast("int").alias("likes_count"),
            F.max(F.when(F.col("l_linestatus") == "O", F.col("l_extendedprice"))).alias("sale_price"),
            F.max(F.when(F.col("l_discount") > 0.05, F.lit("Automatic"))).alias("vehicle_transmission"),
        )
        .withColumn("matched", F.col("likes_count") > 1)
    )


@query(
    "enrich_update",
    f"""WITH {_DETAILS_SQL}
SELECT CAST(o_orderkey AS VARCHAR) AS listing_id,
       CASE WHEN d.id IS NOT NULL THEN d.description ELSE 'stored' END AS description,
       CASE WHEN d.id IS NOT NULL THEN d.likes ELSE 0 END AS likes_count,
       coalesce(d.sale_price, o_totalprice) AS sale_price,
       coalesce(d.transmission, o_orderpriority) AS vehicle_transmission
FROM orders LEFT JOIN (SELECT * FROM details WHERE likes > 1) d ON o_orderkey = d.id""",
)
def _enrich_update(spark, folder):
    raw = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("listing_id"),
        F.lit("stored").alias("description"),
        F.lit(0).alias("likes_count"),
        F.col("o_totalprice").alias("sale_price"),
        F.col("o_orderpriority").alias("vehicle_transmission"),
    )
    return merge.apply_details(raw, _order_details(spark, folder))


def _payload_column():
    """Payload states of a stored listing: absent, empty or filled."""
    return F.when(F.col("o_orderstatus") == "O", F.lit(None)).when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(
        F.lit("{}")
    )


@query(
    "unenriched_queue",
    """SELECT 'all' AS mode, count(*) AS n, min(id) AS first_id, max(id) AS last_id
FROM (SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus IN ('O', 'P'))
UNION ALL SELECT 'force', count(*), min(CAST(o_orderkey AS VARCHAR)), max(CAST(o_orderkey AS VARCHAR)) FROM orders
UNION ALL SELECT 'limit', count(*), min(id), max(id) FROM (
  SELECT CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderstatus IN ('O', 'P') ORDER BY 1 LIMIT 50)""",
)
def _unenriched_queue(spark, folder):
    raw = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("listing_id"), _payload_column().alias("raw_detail_payload")
    )
    modes = {
        "all": merge.unenriched(raw),
        "force": merge.unenriched(raw, force=True),
        "limit": merge.unenriched(raw, limit=50),
    }
    parts = [
        ids.agg(
            F.count(F.lit(1)).alias("n"), F.min("listing_id").alias("first_id"), F.max("listing_id").alias("last_id")
        ).select(F.lit(mode).alias("mode"), "*")
        for mode, ids in modes.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "rename_contract",
    """SELECT CAST(o_orderkey AS VARCHAR) AS listing_id, o_orderpriority AS listing_title, o_totalprice AS price,
       o_orderstatus AS vehicle_condition, CAST(year(o_orderdate) AS INTEGER) AS vehicle_model_year,
       CAST(NULL AS VARCHAR) AS seller_name, 54 AS contract_columns
FROM orders""",
)
def _rename_contract(spark, folder):
    legacy = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("title"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("car_condition"),
        F.year("o_orderdate").alias("car_year"),
        F.lit("dropped").alias("unknown_column"),
    )
    renamed = merge.rename_legacy(legacy)
    assert not set(renamed.columns) & set(LEGACY_NAMES)
    full = merge.conform(renamed)
    picked = ["listing_id", "listing_title", "price", "vehicle_condition", "vehicle_model_year", "seller_name", "absent"]
    return merge.pick_present(full, picked).withColumn("contract_columns", F.lit(len(full.columns)))


@query(
    "legacy_flags",
    """SELECT o_orderkey, CAST(o_orderstatus = 'O' AS INTEGER) AS is_like,
       CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN 0 END AS is_saved,
       CAST(o_totalprice > 100000 AS INTEGER) AS listing_available
FROM orders""",
)
def _legacy_flags(spark, folder):
    status = F.col("o_orderstatus")
    flags = table(spark, folder, "orders").select(
        "o_orderkey",
        (status == "O").alias("is_like"),
        F.when(status == "O", F.lit(True)).when(status == "F", F.lit(False)).alias("is_saved"),
        (F.col("o_totalprice") > 100_000).alias("listing_available"),
    )
    return merge.legacy_flags(flags)


# ---------------------------------------------------------------- storage


@query(
    "parquet_round_trip",
    f"""WITH {CLEAN_SQL}
SELECT listing_id, price, vehicle_brand, province, vehicle_model_year, '["0' || vehicle_model_year || '"]' AS seller_phones,
       '{{"tax":"' || vehicle_tax_type || '"}}' AS raw_specs
FROM clean""",
)
def _parquet_round_trip(spark, folder):
    needed = ["vehicle_brand", "province", "price", "vehicle_model_year", "vehicle_tax_type", "scraped_at"]
    rows = clean_listings(spark, folder, ["listing_id", *needed]).withColumns(
        {
            "seller_phones": F.array(F.concat(F.lit("0"), F.col("vehicle_model_year").cast("string"))),
            "raw_specs": F.to_variant_object(F.struct(F.col("vehicle_tax_type").alias("tax"))),
        }
    )
    path = writers.write_raw(rows, scratch_dir(spark, "raw"))
    stored = readers.read_raw(spark, path)
    assert stored.schema == RAW
    picked = stored.select(
        "listing_id", "price", "vehicle_brand", "province", "vehicle_model_year", "seller_phones", "raw_specs"
    )
    phones = F.when(F.col("vehicle_model_year").isNotNull(), F.col("seller_phones"))
    return writers.encode_json_cells(picked.withColumn("seller_phones", phones))


@query(
    "clean_written",
    f"""WITH {CLEAN_SQL}
SELECT vehicle_brand, count(*) AS n, min(price) AS low, max(price) AS high FROM clean GROUP BY 1""",
)
def _clean_written(spark, folder):
    raw = listings(spark, folder)
    stored = readers.read_clean(spark, writers.write_clean(raw, scratch_dir(spark, "clean"), RULES, ORDER))
    return stored.groupBy("vehicle_brand").agg(
        F.count(F.lit(1)).alias("n"), F.min("price").alias("low"), F.max("price").alias("high")
    )


@query(
    "csv_round_trip",
    """SELECT CAST(doc_id AS VARCHAR) AS listing_id, replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10))
         AS listing_title, CAST(n_chars AS DOUBLE) AS price
FROM documents ORDER BY md5('42:' || doc_id), CAST(doc_id AS VARCHAR) LIMIT 60""",
)
def _csv_round_trip(spark, folder):
    """Samples drawn from all documents, with their whole multi-line texts, through CSV."""
    documents = table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("listing_id"),
        F.col("text").alias("listing_title"),
        F.col("n_chars").cast("double").alias("price"),
    )
    path = writers.write_csv(writers.sample_rows(documents, 60), scratch_dir(spark, "csv"))
    return readers.read_csv(spark, path, "listing_id string, listing_title string, price double")


@query(
    "missing_source",
    "SELECT CAST(o_orderkey AS VARCHAR) AS listing_id, o_totalprice AS price FROM orders",
)
def _missing_source(spark, folder):
    """A store that does not exist yet has no known ids, so every order is new."""
    absent = readers.stored_ids(spark, scratch_dir(spark, "absent"))
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("listing_id"), F.col("o_totalprice").alias("price")
    )
    return merge.new_listings(orders, absent, ["price"])


@query(
    "snapshot_merge",
    """SELECT CAST(o_orderkey AS VARCHAR) AS listing_id, CASE WHEN o_orderstatus = 'O' THEN o_totalprice * 2 ELSE o_totalprice END AS price,
       2 AS version
FROM orders WHERE o_orderstatus <> 'P'""",
)
def _snapshot_merge(spark, folder):
    """Two published snapshots: a first load, then an upsert of the open orders."""
    root = scratch_dir(spark, "snapshots")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("listing_id"), F.col("o_totalprice").alias("price"), "o_orderstatus"
    )
    finished = orders.filter("o_orderstatus = 'F'")
    writers.publish(spark, merge.conform(finished.unionByName(orders.filter("o_orderstatus = 'O'"))), root)
    doubled = orders.filter("o_orderstatus = 'O'").withColumn("price", F.col("price") * 2)
    writers.publish(spark, merge.upsert(writers.current_snapshot(spark, root, RAW), doubled), root)
    current = writers.current_snapshot(spark, root, RAW)
    return current.select("listing_id", "price", F.lit(writers.latest_version(spark, root)).alias("version"))


@query(
    "json_round_trip",
    """SELECT event_id, '{"k":' || CAST(regexp_extract(props, '[0-9]+') AS BIGINT) || '}' AS raw_specs,
       CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k, '["' || event_type || '"]' AS seller_phones,
       CASE WHEN event_id % 5 = 0 THEN '"plain ' || event_type || '"' END AS detail_specs
FROM events""",
)
def _json_round_trip(spark, folder):
    encoded = table(spark, folder, "events").select(
        "event_id",
        F.col("props").alias("raw_specs"),
        F.to_json(F.array("event_type")).alias("seller_phones"),
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("plain "), F.col("event_type"))).alias("detail_specs"),
    )
    restored = readers.restore_json_cells(encoded)
    decoded = restored.withColumn("k", F.try_variant_get("raw_specs", "$.k", "bigint"))
    return writers.encode_json_cells(decoded)


@query(
    "keep_last_rows",
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey
  ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) = 1""",
)
def _keep_last_rows(spark, folder):
    """Few keys with many rows each: the last shipment of every supplier."""
    columns = ["l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice"]
    rows = table(spark, folder, "lineitem").select(*columns)
    return keep_last(rows, "l_suppkey", columns[1:]).drop("l_shipdate")

"""Text functions on texts formed from the driver tables.

The SQL states the expected result from how each text was formed, not by parsing it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lotwise.functions import flags, numbers, phones, specs, text, times
from lotwise.functions.titles import BRAND_ALIASES, BRANDS, MODELS, with_brand_model
from lotwise.operators import dictionary
from lotwise.operators.cleaning import standardise_categories
from lotwise.plans.registry import SQL, parts_of, query, table
from lotwise.session import dealt


def pick(index, *choices):
    """The choice at position ``index``."""
    chain = F
    for i, choice in enumerate(choices):
        chain = chain.when(index == i, choice)
    return chain


@query(
    "clean_price_text",
    """WITH c AS (SELECT o_orderkey, o_orderkey % 8 AS form, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
SELECT o_orderkey,
       CASE WHEN form IN (0, 1, 7) THEN cents / CAST(100 AS DOUBLE) END AS price,
       CASE WHEN form IN (0, 1, 7) THEN cents / CAST(100 AS DOUBLE) WHEN form = 2 THEN 0
            WHEN form = 4 THEN -cents / CAST(100 AS DOUBLE) END AS amount
FROM c""",
)
def _clean_price_text(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents")
    )
    units = F.expr("cents div 100")
    fraction = F.lpad((F.col("cents") % 100).cast("string"), 2, "0")
    plain = F.concat(units.cast("string"), F.lit("."), fraction)
    form = F.col("o_orderkey") % 8
    written = pick(
        form,
        F.concat(F.lit("$"), F.format_number(units, 0), F.lit("."), fraction),
        F.concat(F.lit("  "), plain, F.lit("\t")),
        F.lit("0.00"),
        F.concat(plain, F.lit("d")),
        F.concat(F.lit("-$"), plain),
        F.lit("NaN"),
        F.concat(F.lit("about "), plain),
        F.concat(F.lit("+"), plain, F.lit("e0")),
    )
    return orders.select(
        "o_orderkey", numbers.price(written).alias("price"), numbers.amount(written).alias("amount")
    )


_FLAG_WORDS = ["1", "TRUE", " yes ", "Y", "0", "False", "no\n", "n", "maybe", "", "2"]


@query(
    "coerce_bool_text",
    """SELECT event_id, CASE WHEN event_id % 12 < 4 THEN true WHEN event_id % 12 < 8 THEN false END AS flag,
       CASE WHEN event_id % 12 < 4 THEN 1 WHEN event_id % 12 < 8 THEN 0 END AS bit
FROM events""",
)
def _coerce_bool_text(spark, folder):
    word = pick(F.col("event_id") % 12, *[F.lit(word) for word in _FLAG_WORDS])
    flag = flags.to_bool(word)
    return table(spark, folder, "events").select("event_id", flag.alias("flag"), flags.to_bit(flag).alias("bit"))


@query(
    "year_text",
    """SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_partkey % 6 < 3 AND year(l_shipdate) <= 2000 THEN CAST(year(l_shipdate) AS INTEGER) END AS model_year,
       CASE WHEN l_partkey % 6 <> 5 THEN CAST(year(l_shipdate) AS INTEGER) * CASE WHEN l_partkey % 6 = 3 THEN 10 ELSE 1 END END AS digits
FROM lineitem""",
)
def _year_text(spark, folder):
    shipped = F.year("l_shipdate").cast("string")
    khmer = F.translate(shipped, "0123456789", "០១២៣៤៥៦៧៨៩")
    written = pick(
        F.col("l_partkey") % 6,
        shipped,
        F.concat(F.lit(" +"), shipped, F.lit(" ")),
        khmer,
        F.concat(shipped, F.lit(".0")),
        F.concat(F.lit("year "), shipped),
        F.lit("unknown"),
    )
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        numbers.model_year(written, 2000).alias("model_year"),
        numbers.digits_only_year(written).alias("digits"),
    )


@query(
    "int_text",
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN CAST(trunc(o_totalprice) AS BIGINT)
         WHEN 1 THEN CAST(trunc(o_totalprice) AS BIGINT) WHEN 2 THEN -CAST(trunc(o_totalprice) AS BIGINT) END AS number,
       CASE WHEN o_orderkey % 5 = 3 THEN CAST(trunc(o_totalprice) AS BIGINT) ELSE 0 END AS likes
FROM orders""",
)
def _int_text(spark, folder):
    plain = F.format_string("%.2f", "o_totalprice")
    whole = F.floor("o_totalprice").cast("bigint")
    form = F.col("o_orderkey") % 5
    written = pick(
        form,
        F.concat(F.lit(" "), plain),
        F.concat(F.format_number(whole, 0), F.lit(".9")),
        F.concat(F.lit("-"), plain),
        F.concat(plain, F.lit(" cc")),
        F.lit("inf"),
    )
    liked = F.when(form == 3, whole.cast("string")).otherwise(plain)
    return table(spark, folder, "orders").select(
        "o_orderkey",
        numbers.int_spec(written).alias("number"),
        numbers.like_count(liked).cast("bigint").alias("likes"),
    )


@query(
    "mileage_text",
    """SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_partkey % 7 IN (0, 1, 3) THEN CAST(l_quantity AS BIGINT) * 1000 WHEN l_partkey % 7 = 2
            THEN CAST(l_quantity AS BIGINT) * 1000 + 500 WHEN l_partkey % 7 = 4 THEN CAST(l_quantity AS BIGINT) END AS km
FROM lineitem""",
)
def _mileage_text(spark, folder):
    thousands = F.col("l_quantity").cast("int").cast("string")
    written = pick(
        F.col("l_partkey") % 7,
        F.concat(thousands, F.lit(",000 km")),
        F.concat(thousands, F.lit("k")),
        F.concat(thousands, F.lit(".5 K")),
        F.concat(thousands, F.lit("000.75KM")),
        F.concat(thousands, F.lit(" ")),
        F.concat(thousands, F.lit("K km")),
        F.lit("unknown"),
    )
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", numbers.mileage(written).alias("km")
    )


@query(
    "utc_normalise",
    """WITH e AS (SELECT event_id, event_id % 8 AS form, date_trunc('second', ts) AS s, ts FROM events),
w AS (
  SELECT event_id, CASE WHEN form IN (0, 5) THEN s - INTERVAL 7 HOUR WHEN form = 1 THEN s - INTERVAL 2 HOUR
         WHEN form = 2 THEN s WHEN form = 3 THEN ts - INTERVAL 7 HOUR
         WHEN form = 4 THEN CAST(CAST(s AS DATE) AS TIMESTAMP) - INTERVAL 7 HOUR
         WHEN form = 6 THEN s + INTERVAL 330 MINUTE END AS t
  FROM e
)
SELECT event_id, strftime(t, '%Y-%m-%dT%H:%M:%S')
         || CASE WHEN microsecond(t) % 1000000 <> 0 THEN strftime(t, '.%f') ELSE '' END || '+00:00' AS iso
FROM w""",
)
def _utc_normalise(spark, folder):
    seconds = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    joined = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    written = pick(
        F.col("event_id") % 8,
        seconds,
        F.concat(joined, F.lit("+02:00")),
        F.concat(joined, F.lit("Z")),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        F.date_format("ts", "yyyy-MM-dd"),
        F.date_format("ts", "yyyyMMdd'T'HHmmss"),
        F.concat(joined, F.lit("-0530")),
        F.date_format("ts", "yyyy-M"),
    )
    return table(spark, folder, "events").select("event_id", times.normalise(written).alias("iso"))


_PREFIX_SQL = " ".join(
    f"WHEN prefix IN ({', '.join(repr(p) for p in prefixes)}) THEN '{name}'"
    for name, prefixes in phones.CARRIER_PREFIXES.items()
)


@query(
    "phone_carrier",
    f"""WITH p AS (SELECT c_custkey, '0' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') AS prefix FROM customer)
SELECT c_custkey, CASE {_PREFIX_SQL} END AS carrier FROM p""",
)
def _phone_carrier(spark, folder):
    pair = F.lpad((F.col("c_custkey") % 100).cast("string"), 2, "0")
    rest = F.lpad((F.col("c_custkey") % 1_000_000).cast("string"), 6, "0")
    first = pick(
        F.col("c_custkey") % 3,
        F.concat(F.lit("0"), pair, F.lit(" "), F.substring(rest, 1, 3), F.lit("-"), F.substring(rest, 4, 3)),
        F.concat(F.lit("+855 "), pair, rest),
        F.concat(F.lit("(0"), pair, F.lit(")"), rest),
    )
    return table(spark, folder, "customer").select(
        "c_custkey", phones.carrier_of_first(F.array(first, F.lit("012000000"))).alias("carrier")
    )


_MODEL_LIST = [
    (name, brand) for brand, models in MODELS.items() for name in models if not any(b.lower() in name.lower() for b in BRANDS)
]


def _values(rows) -> str:
    return ", ".join(f"({', '.join(repr(cell) for cell in row)})" for row in rows)


_BRAND_VALUES = _values((i, name, BRAND_ALIASES.get(name, name)) for i, name in enumerate(BRANDS))
_MODEL_VALUES = _values((i, name, brand) for i, (name, brand) in enumerate(_MODEL_LIST))


@query(
    "title_brand_model",
    f"""WITH b(i, name, canonical) AS (VALUES {_BRAND_VALUES}), m(j, model, owner) AS (VALUES {_MODEL_VALUES}),
p AS (SELECT *, p_partkey % 6 AS form, upper(split_part(p_name, ' ', 1)) AS w1, split_part(p_name, ' ', -1) AS w2 FROM part)
SELECT p_partkey,
       CASE WHEN form IN (0, 1, 2) THEN canonical WHEN form IN (3, 4) THEN owner END AS vehicle_brand,
       CASE form WHEN 0 THEN CASE WHEN w1 <> 'NEW' THEN w1 || ' ' || w2 END WHEN 1 THEN w2 WHEN 3 THEN model WHEN 4 THEN model END AS vehicle_model
FROM p JOIN b ON i = p_partkey % {len(BRANDS)} JOIN m ON j = p_partkey % {len(_MODEL_LIST)}""",
)
def _title_brand_model(spark, folder):
    named = with_brand_model(_titles(spark, folder))
    return named.select("p_partkey", "vehicle_brand", "vehicle_model")


def _titles(spark, folder):
    """Titles of all kinds from the part table."""
    part = table(spark, folder, "part")
    key = F.col("p_partkey")
    brand = F.element_at(F.lit(BRANDS), (key % len(BRANDS) + 1).cast("int"))
    model = F.element_at(F.lit([name for name, _ in _MODEL_LIST]), (key % len(_MODEL_LIST) + 1).cast("int"))
    first = F.upper(F.substring_index("p_name", " ", 1))
    last = F.substring_index("p_name", " ", -1)
    year = (F.lit(1995) + key % 30).cast("string")
    titles = part.select("p_partkey", "p_name", brand.alias("brand"), model.alias("model"))
    one_word = F.replace("model", F.lit(" "), F.lit(""))
    title = pick(
        key % 6,
        F.concat_ws(" ", F.lit(" 99"), F.upper("brand"), first, year, last, F.lit("for sale")),
        F.concat(F.lit("ឡាន"), F.lower("brand"), last, F.lit(" "), year, F.lit(" Urgent price")),
        F.concat_ws(" ", "brand", year, F.lit("Full option")),
        F.concat_ws(" ", year, F.upper("model"), first),
        F.concat(F.lit("("), F.lower("model"), F.lit(") in good condition")),
        F.concat(F.lit("x"), one_word, F.lit(" "), one_word, F.lit("y "), last),
    )
    return titles.select("p_partkey", title.alias("listing_title"))


@query("title_dictionary", SQL["title_brand_model"])
def _title_dictionary(spark, folder):
    """The same titles, with brands and models as tables."""
    brands = [(name, i, BRAND_ALIASES.get(name, name)) for i, name in enumerate(BRANDS)]
    models = [(name, i, brand) for i, (name, brand) in enumerate((m, b) for b, names in MODELS.items() for m in names)]
    named = dictionary.with_brand_model_from(
        _titles(spark, folder),
        spark.createDataFrame(brands, "name string, position int, canonical string"),
        spark.createDataFrame(models, "name string, position int, brand string"),
    )
    return named.select("p_partkey", "vehicle_brand", "vehicle_model")


@query(
    "title_part_names",
    """WITH name AS (SELECT p_name AS name, min(p_partkey) AS position FROM part GROUP BY 1),
title AS (SELECT p_partkey, upper(p_type) || ' (' || p_name || '), not ' || p_brand || ' ' || lower(p_name) || 's' AS title FROM part)
SELECT p_partkey, name, instr(lower(title), lower(name)) AS "at" FROM title JOIN name
  ON regexp_matches(lower(title), '(^|[^a-z0-9_])' || lower(name) || '($|[^a-z0-9_])')
QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY length(name) DESC, position, name) = 1""",
)
def _title_part_names(spark, folder):
    """All part names as the dictionary: the longest one that stands in a title as whole words."""
    part = table(spark, folder, "part")
    names = part.groupBy(F.col("p_name").alias("name")).agg(F.min("p_partkey").alias("position"))
    title = F.concat(F.upper("p_type"), F.lit(" ("), "p_name", F.lit("), not "), "p_brand", F.lit(" "), F.lower("p_name"), F.lit("s"))
    titles = part.select("p_partkey", title.alias("title"))
    found = dictionary.find_names(titles, names, "title", boundary=dictionary.WORD)
    return titles.join(found, "title").select("p_partkey", "found.name", F.col("found.at").cast("long").alias("at"))


@query(
    "category_text",
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'used' WHEN 1 THEN 'used' WHEN 2 THEN 'unknown' WHEN 3 THEN ''
         ELSE 'second hand car' END AS vehicle_condition,
       CASE WHEN o_orderkey % 3 = 0 THEN 'petrol' ELSE lower(o_orderpriority) END AS vehicle_fuel_type,
       CASE WHEN o_orderkey % 2 = 0 THEN 'automatic' ELSE 'auto matic' END AS vehicle_transmission,
       CASE WHEN o_orderkey % 4 = 0 THEN 'Daun Penh' END AS district
FROM orders""",
)
def _category_text(spark, folder):
    key = F.col("o_orderkey")
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        pick(
            key % 5,
            F.lit("Second Hand"),
            F.lit(" PRE-OWNED\n"),
            F.lit(None),
            F.lit(" "),
            F.lit("second hand car"),
        ).alias("vehicle_condition"),
        F.when(key % 3 == 0, F.lit("Gas ")).otherwise(F.col("o_orderpriority")).alias("vehicle_fuel_type"),
        F.when(key % 2 == 0, F.lit("AUTO")).otherwise(F.lit("Auto matic")).alias("vehicle_transmission"),
        text.before_comma(
            F.when(key % 4 == 0, F.lit(" Daun Penh , Phnom Penh, KH")).otherwise(F.lit("Phnom Penh"))
        ).alias("district"),
    )
    return standardise_categories(rows)


@query(
    "spec_map",
    """SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(year(l_shipdate) AS INTEGER) AS vehicle_model_year,
       CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_quantity AS BIGINT) * 1000 ELSE CAST(l_quantity AS BIGINT) END AS vehicle_mileage_km,
       CASE WHEN l_linestatus = 'O' THEN l_shipinstruct ELSE 'Black' END AS vehicle_color,
       CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS vehicle_transmission
FROM (SELECT *, 'White' AS l_shipinstruct FROM lineitem)""",
)
def _spec_map(spark, folder):
    """Each line item as a table of specifications, some unreadable, some given by title only."""
    quantity = F.col("l_quantity").cast("int").cast("string")
    shipped = F.year("l_shipdate").cast("string")

    def row(field=None, title=None, display=None, value=None, slug=None):
        given = {"field": field, "title": title, "display_value": display, "value": value, "value_slug": slug}
        return F.struct(
            *[
                (part if part is not None and not isinstance(part, str) else F.lit(part)).cast("string").alias(name)
                for name, part in given.items()
            ]
        )

    rows = F.array(
        row("car-year", display="9999"),
        row("car-year", value=F.concat(F.lit("Y"), shipped)),
        row("car-year", display="no digits"),
        row("odometer", slug=F.when(F.col("l_linenumber") % 2 == 0, F.concat(quantity, F.lit("k"))).otherwise(quantity)),
        row("mileage", display="low"),
        row("unknown", "ពណ៌", display="Black"),
        row(display="ignored"),
        row(F.when(F.col("l_linestatus") == "O", F.lit("color")), "none", value=" White "),
        row("transmission", display=F.when(F.col("l_returnflag") != "R", F.col("l_returnflag"))),
    )
    used = "l_orderkey l_linenumber l_partkey l_quantity l_shipdate l_linestatus l_returnflag".split()
    lines = dealt(table(spark, folder, "lineitem").select(*used), parts_of(spark), "l_orderkey")
    mapped = lines.select("l_orderkey", "l_linenumber", "l_partkey", specs.mapped_rows(rows).alias("mapped"))
    values = specs.column_values(F.col("mapped"))
    kept = ["vehicle_model_year", "vehicle_mileage_km", "vehicle_color", "vehicle_transmission"]
    return mapped.select("l_orderkey", "l_linenumber", "l_partkey", *[values[name].alias(name) for name in kept])

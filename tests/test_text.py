"""Literal vectors, and random texts against small independent readers."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from lotwise.functions import flags, numbers, phones, text, times
from lotwise.functions.titles import with_brand_model

TITLES = [
    ("Suzuki Swift for the city", "Suzuki", "Swift"),
    ("Subaru Forester XT 2008 urgent", "Subaru", "Forester XT"),
    ("VOLVO V70 1999", "Volvo", "V70"),
    ("cheap Peugeot 2011 diesel", "Peugeot", None),
    ("លក់Isuzu MU-X 2016", "Isuzu", "MU-X"),
    ("Mercedes Vito 110 van", "Mercedes-Benz", "Vito 110 van"),
    ("A Mercedes-Benz 2004", "Mercedes-Benz", None),
    ("Aston Martin DB9", "Aston Martin", "DB9"),
    ("Chevrolet", "Chevrolet", None),
    ("Renault full option", "Renault", None),
    ("garden furniture, two chairs", None, None),
    ("   ", None, None),
    ("", None, None),
    (None, None, None),
    # a model names the brand
    ("2016 xpander, silver", "Mitsubishi", "Xpander"),
    ("Vios taxi", "Toyota", "Vios"),
    ("GX470 V8 2005", "Lexus", "GX470"),
    ("My old Pajero Sport", "Mitsubishi", "Pajero Sport"),
    # known effects of substring search, and of its priority order
    ("JACKET for riders", "JAC", "KET"),
    ("afford it", "Ford", "it"),
    ("MazdaBongo1998", "Mazda", "Bongo1998"),
    ("Kia or Hyundai a b c d", "Hyundai", "a b c"),
    # models: whole words only, the longest wins wherever it stands
    ("Patrol beside an Eclipse Cross", "Mitsubishi", "Eclipse Cross"),
    ("K3 X1", "Kia", "K3"),
    ("ឡានVitz", None, None),
    ("Dodge 1999 2000 r 2001 t", "Dodge", "r"),
]


def test_titles(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(TITLES)], "i int, listing_title string")
    got = {r.i: (r.vehicle_brand, r.vehicle_model) for r in with_brand_model(df).collect()}
    for i, (title, brand, model) in enumerate(TITLES):
        assert got[i] == (brand, model), title


def test_titles_with_left_boundary(spark):
    rows = [("JACKET",), ("afford it",), ("MazdaBongo1998",), ("លក់Isuzu MU-X",)]
    df = spark.createDataFrame(rows, "listing_title string")
    got = {r.listing_title: r.vehicle_brand for r in with_brand_model(df, left_boundary=True).collect()}
    assert [got[t] for (t,) in rows] == ["JAC", None, "Mazda", "Isuzu"]


def test_mileage(column):
    vectors = {
        "73210": 73210, "73,210": 73210, "73210 km": 73210, "62k": 62000, "7.25k": 7250, "0": 0, None: None,
        "many": None, "62K km": None, "62K KM": None, "3.7 KM": 3, "-8": -8, "k": None, "inf": None, "nank": None, "": None,
    }
    assert column(numbers.mileage, list(vectors)) == list(vectors.values())


def test_prices(column):
    vectors = {
        "$12,500": 12500.0, "0": None, "0.00": None, "": None, None: None, "$11,500": 11500.0, "11500.00": 11500.0,
        "700": 700.0, "-1": None, "NaN": None, "inf": None, "1e400": None, "1d": None, "1f": None, " 5 ": 5.0,
        "1_000": 1000.0, "_1": None, "1__0": None, ".5": 0.5, "5.": 5.0, "០.៥": 0.5, "0x10": None,
    }
    assert column(numbers.price, list(vectors)) == list(vectors.values())
    assert column(numbers.amount, ["$0", "-1,0", "x"]) == [0.0, -10.0, None]


def test_years_and_integers(column):
    years = {"1975": None, "2024": 2024, " 2027 ": 2027, "2028": None, "2019.0": None, "1990": 1990, "x": None, "២០១៩": 2019}
    assert column(lambda c: numbers.model_year(c, 2027), list(years)) == list(years.values())
    ints = {"150,000": 150000, "12.9": 12, "-12.9": -12, "x": None, "": None, "1e3": 1000, "1e30": None}
    assert column(numbers.int_spec, list(ints)) == list(ints.values())
    assert column(numbers.like_count, ["12", " 7 ", "x", None, "1.5", "99999999999"]) == [12, 7, 0, 0, 0, 0]
    assert column(numbers.digits_only_year, ["2024", "y2019", "ក", "105", "99999999999"]) == [2024, 2019, None, 105, None]


def test_flags(column):
    words = ["1", "0", "true", "YES", " y ", "n", "No", "maybe", "", None, "2"]
    assert column(flags.to_bool, words) == [True, False, True, True, True, False, False, None, None, None, None]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps(spark, column, zone):
    vectors = {
        "2026-08-13 16:39:12": "2026-08-13T09:39:12+00:00",
        "2026-08-13T10:00:00+02:00": "2026-08-13T08:00:00+00:00",
        "2026-08-13T09:39:12Z": "2026-08-13T09:39:12+00:00",
        "2026-08-13 16:39:12.5": "2026-08-13T09:39:12.500000+00:00",
        "2026-08-13 16:39:12,123456789": "2026-08-13T09:39:12.123456+00:00",
        "2026-03-08 09:30:00": "2026-03-08T02:30:00+00:00",
        "2026-08-13": "2026-08-12T17:00:00+00:00",
        "20260813T163912": "2026-08-13T09:39:12+00:00",
        "2026-08-13T10:00-0530": "2026-08-13T15:30:00+00:00",
        "": None, None: None, "2026": None, "2026-7-8": None, "2026-13-01 00:00:00": None, "2026-02-30": None, "soon": None,
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert column(times.normalise, list(vectors)) == list(vectors.values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_carriers(spark):
    vectors = [
        (["077 100 200"], "cellcard"),
        (["+855 15 100 200"], "smart"),
        (["0881234567"], "metfone"),
        (["012000000", "096111111"], "cellcard"),
        (["012 998 785"], "cellcard"),
        (["+855 12 998785"], "cellcard"),
        ([], None),
        (["011000000"], None),
        (None, None),
    ]
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(vectors)], "i int, p array<string>")
    got = [r.c for r in df.select("i", phones.carrier_of_first(F.col("p")).alias("c")).orderBy("i").collect()]
    assert got == [carrier for _, carrier in vectors]


def test_categories(column):
    words = [" Gasoline ", "gas", "DIESEL", None, "", " ", " Petrol\n"]
    known = text.CATEGORY_SYNONYMS["vehicle_fuel_type"]
    assert column(lambda c: text.category(c, known), words) == ["petrol", "petrol", "diesel", "unknown", "", "", "petrol"]
    assert column(text.before_comma, ["A , B", "A", None, ",B"]) == ["A", None, None, ""]
    assert column(lambda c: text.first_filled(c, F.lit("z")), ["", None, "a"]) == ["z", "z", "a"]


# ------------------------------------------------ random texts against plain Python readers


def read_float(value):
    try:
        number = float(value)
    except ValueError:
        return None
    return number if math.isfinite(number) else None


def python_price(value):
    number = read_float(value.replace("$", "").replace(",", "").strip())
    return number if number is not None and number > 0 else None


def python_year(value):
    try:
        year = int(value.strip())
    except ValueError:
        return None
    return year if 1990 <= year <= 2027 else None


def python_mileage(value):
    value = value.lower().replace(",", "").replace(" ", "")
    if value.endswith("k"):
        number = read_float(value[:-1])
        number = None if number is None else number * 1000
    else:
        number = read_float(re.sub("km$", "", value))
    return None if number is None or abs(number) > 2**62 else int(number)


def random_texts(alphabet, count, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 7))) for _ in range(count)]


@pytest.mark.parametrize(
    ("function", "reader", "alphabet"),
    [
        (numbers.price, python_price, "0123456789$,. -+e_"),
        (lambda c: numbers.model_year(c, 2027), python_year, "1290 +_."),
        (numbers.mileage, python_mileage, "0123456789,. kKmM"),
    ],
    ids=["price", "year", "mileage"],
)
def test_random_texts(column, function, reader, alphabet):
    texts = random_texts(alphabet, 4000, 7) + [f"{n}" for n in range(1985, 2030)]
    for value, got in zip(texts, column(function, texts), strict=True):
        assert got == reader(value), repr(value)

import json
import random

import pytest
from pyspark.sql import functions as F
from test_pages import TABLE, html

from lotwise.functions import page_tables
from lotwise.functions.page_tables import decode_text, first_listing
from lotwise.operators.page_decode import decode_pages, extract_decoded
from lotwise.operators.pages import extract_details


def is_number(value):
    return isinstance(value, int) and not isinstance(value, bool)


def plainly(entries):
    """What a table stands for, by following every rule as it is written."""
    done = {}

    def look(value, depth):
        if depth > 60:
            return None
        if is_number(value) and value in range(len(entries)):
            if is_number(entries[value]):
                return entries[value]
            if value not in done:
                done[value] = "<cycle>"
                done[value] = look(entries[value], depth + 1)
            return done[value]
        if isinstance(value, list):
            start = 1 if value and isinstance(value[0], str) else 0
            return value[:start] + [look(inner, depth + 1) for inner in value[start:]]
        if isinstance(value, dict):
            return {name: look(inner, depth + 1) for name, inner in value.items()}
        return value

    return look(entries, 0)


def listing_of(value):
    if isinstance(value, dict) and {"specs", "title", "price"} <= set(value):
        return value
    inside = value.values() if isinstance(value, dict) else value if isinstance(value, list) else []
    return next((found for found in map(listing_of, inside) if found is not None), None)


def random_table(rng, size):
    def value(depth):
        kind = rng.randrange(8)
        if kind < 3 or depth > 2:
            return rng.randrange(-1, size + 2)
        if kind == 3:
            return rng.choice(["text", "1", 2.5, None, True, False])
        if kind == 4:
            return ["Tag", *[value(depth + 1) for _ in range(rng.randrange(3))]]
        if kind == 5:
            return [value(depth + 1) for _ in range(rng.randrange(4))]
        names = rng.choice([["a", "b"], ["specs", "title", "price"], ["x"], []])
        return {name: value(depth + 1) for name in names}

    return [value(0) for _ in range(size)]


def test_random_tables_equal_a_plain_decoder():
    rng = random.Random(7)
    found = 0
    for _ in range(3000):
        entries = random_table(rng, rng.randrange(9))
        decoded, listing, position = decode_text(json.dumps(entries), whole=True)
        want = plainly(entries)
        assert json.loads(decoded) == want
        expected = listing_of(want)
        assert (None if listing is None else json.loads(listing)) == expected
        if position is not None:
            found += 1
            assert set(entries[position]) == set(expected)
    assert found > 300


@pytest.mark.parametrize(
    ("entries", "want"),
    [
        ([["Wrap", 2, 9], "blue", {"hue": 1, "deep": [1, -1]}], [["Wrap", {"hue": "blue", "deep": ["blue", -1]}, 9], "blue", {"hue": "blue", "deep": ["blue", -1]}]),
        ([{"n": 1, "far": 500}, 77], [{"n": 77, "far": 500}, 77]),
        ([[0, 1], {"me": 1}], [[["<cycle>", {"me": "<cycle>"}], {"me": "<cycle>"}], {"me": {"me": "<cycle>"}}]),
        ([{"a": 1}, {"b": 0}], [{"a": {"b": {"a": "<cycle>"}}}, {"b": {"a": "<cycle>"}}]),
        ([], []),
    ],
)
def test_rules(entries, want):
    assert json.loads(decode_text(json.dumps(entries), True)[0]) == want == plainly(entries)


def test_depth_and_size_are_bounded(monkeypatch):
    chain = [{"n": i + 1} for i in range(99)] + ["end"]
    assert json.loads(decode_text(json.dumps(chain), True)[0]) == plainly(chain)
    # shared entries double at each level when they are written out
    monkeypatch.setattr(page_tables, "MOST_NODES", 1000)
    doubling = [{"specs": 1, "title": 1, "price": 1}] + [[i + 1, i + 1] for i in range(1, 25)] + ["x"]
    assert decode_text(json.dumps(doubling), True) == (None, None, 0)
    assert first_listing([1, "x", None]) is None


@pytest.mark.parametrize("text", [None, "", "{broken", '{"a":1}', "7", "[NaN]"])
def test_unreadable_tables(text):
    assert decode_text(text, True) == (None, None, None)


def page(table):
    return f'<script data-nuxt-data="nuxt-app" id="__NUXT_DATA__">{json.dumps(table)}</script>'


def test_the_listing_is_the_one_met_first(spark):
    low = {"specs": 4, "title": 5, "price": 6}
    entries = [{"state": 3}, low, "pad", {"post": 7}, [], "low", "1.5", {"specs": 4, "title": 8, "price": 6, "total_like": 9}, ["Tag", 10], "12", "top"]
    rows = [("1", page(entries)), ("2", "<html></html>"), ("3", None), (None, page([]))]
    pages = spark.createDataFrame(rows, "listing_id string, html string")
    found = {r.listing_id: (r.position, r.t) for r in decode_pages(pages).withColumn("t", F.to_json("listing")).collect()}
    assert found["1"] == (7, '{"price":"1.5","specs":[],"title":["Tag","top"],"total_like":"12"}')
    assert found["2"] == found["3"] == found[None] == (None, None)
    row = extract_decoded(pages).filter("listing_id = '1'").first()
    assert row.matched and row.likes_count == 12
    assert decode_pages(pages.filter("false")).collect() == []


def test_details_agree_where_one_object_looks_like_the_listing(spark):
    pages = spark.createDataFrame([("1", html(TABLE)), ("2", "<html>blocked</html>")], "listing_id string, html string")

    def rows(details):
        return details.drop("raw_detail_payload").withColumn("detail_specs", F.to_json("detail_specs")).orderBy("listing_id").collect()

    assert rows(extract_decoded(pages)) == rows(extract_details(pages))
    receipt = extract_decoded(pages).filter("matched").select(F.to_json("raw_detail_payload")).first()[0]
    assert json.loads(receipt) == listing_of(plainly(TABLE))

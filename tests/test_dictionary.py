import random
import re

import pytest

from lotwise.functions.titles import BRAND_ALIASES, BRANDS, MODELS, with_brand_model
from lotwise.operators.dictionary import ANYWHERE, LEFT, WORD, find_names, with_brand_model_from

NAMES = ["kia", "Kia K5", "k5", "MG", "amg", "a very long name of a thing", "a very long name of a thing too", "x", "Ford-150", "150"]
TEXTS = ["KIA k5", "kia K5x", "my AMG 63", "A VERY LONG NAME OF A THING TOO", "a very long name of a thing t", "x_x x", "", None, "ford-1500 ford-150"]


def by_hand(text, boundary):
    before = {ANYWHERE: "", LEFT: "(?<![a-z])", WORD: r"(?<!\w)"}[boundary]
    after = r"(?!\w)" if boundary == WORD else ""
    for name in sorted(NAMES, key=lambda n: (-len(n), NAMES.index(n))):
        found = re.search(before + re.escape(name.lower()) + after, text.lower())
        if found:
            return name, found.start() + 1
    return None


@pytest.mark.parametrize("boundary", [ANYWHERE, LEFT, WORD])
def test_names_found_equal_all_names_tried(spark, boundary):
    rng = random.Random(5)
    texts = TEXTS + ["".join(rng.choice(["kia", "K5", " ", "mg", "a", "ford-150", "x", "é", "-"]) for _ in range(8)) for _ in range(60)]
    names = spark.createDataFrame([(name, i, f"of {name}") for i, name in enumerate(NAMES)], "name string, position int, what string")
    rows = find_names(spark.createDataFrame([(t,) for t in texts * 2], "t string"), names, "t", boundary=boundary).collect()
    got = {r.t: (r.found.name, r.found.at) for r in rows}
    assert len(got) == len(rows) and all(r.found.what == f"of {r.found.name}" for r in rows)
    assert got == {t: by_hand(t, boundary) for t in texts if t and by_hand(t, boundary)}


def test_empty_dictionary_and_texts(spark):
    names = spark.createDataFrame([("kia", 0)], "name string, position int")
    texts = spark.createDataFrame([("kia",), (None,)], "t string")
    assert find_names(texts, names.filter("false"), "t").collect() == []
    assert find_names(texts.filter("false"), names, "t").collect() == []


@pytest.mark.parametrize("left_boundary", [False, True])
def test_titles_equal_the_compiled_dictionary(spark, left_boundary):
    rng = random.Random(9)
    words = [*BRANDS, *(m for names in MODELS.values() for m in names), "2019", "for", "sale", "SUV", "ឡាន", "x"]
    titles = ["".join(rng.choice(words) + rng.choice([" ", "", "-"]) for _ in range(4)).swapcase() for _ in range(150)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*titles, None, "", " AMG "])], "i int, listing_title string")
    brands = spark.createDataFrame(
        [(b, i, BRAND_ALIASES.get(b, b)) for i, b in enumerate(BRANDS)], "name string, position int, canonical string"
    )
    listed = [(m, b) for b, names in MODELS.items() for m in names]
    models = spark.createDataFrame([(m, i, b) for i, (m, b) in enumerate(listed)], "name string, position int, brand string")
    got = with_brand_model_from(df, brands, models, left_boundary=left_boundary)
    want = with_brand_model(df, left_boundary=left_boundary)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))

"""Whitespace, emptiness and category helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Unicode counts as white space. ``trim`` alone only removes U+0020.
_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0" + "".join(
    chr(code) for code in [0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
BLANK_RUN = r"[\s\p{Z}\x1c-\x1f\x85]+"

# Category spellings that mean the same thing.
CATEGORY_SYNONYMS: dict[str, dict[str, str]] = {
    "vehicle_condition": {"second hand": "used", "pre-owned": "used"},
    "vehicle_tax_type": {},
    "vehicle_brand": {},
    "province": {},
    "vehicle_transmission": {"auto": "automatic"},
    "vehicle_fuel_type": {"gasoline": "petrol", "gas": "petrol"},
}
UNKNOWN = "unknown"


def strip(text: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.btrim(text, F.lit(_BLANKS))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def stripped_or_null(text: Column) -> Column:
    return blank_to_null(strip(text))


def first_filled(*texts: Column) -> Column:
    """First value that is neither null nor the empty string."""
    return F.coalesce(*[blank_to_null(text) for text in texts])


def category(text: Column, synonyms: dict[str, str] | None = None) -> Column:
    """Strip, lower-case, merge synonyms and turn null into ``unknown``.

    An empty string stays empty: only null counts as missing.
    """
    key = F.lower(strip(text))
    merged = reduce(
        lambda chain, pair: chain.when(key == pair[0], F.lit(pair[1])),
        (synonyms or {}).items(),
        F.when(key.isNull(), F.lit(UNKNOWN)),
    )
    return merged.otherwise(key)


def before_comma(text: Column) -> Column:
    """Text in front of the first comma; null when there is no comma."""
    return F.when(F.contains(text, F.lit(",")), strip(F.substring_index(text, ",", 1)))


def contains_ignoring_case(text: Column, needle: str) -> Column:
    """Literal containment; a null text does not match."""
    return F.coalesce(F.contains(F.lower(text), F.lit(needle.lower())), F.lit(False))


def equals_ignoring_case(text: Column, value: str) -> Column:
    return F.coalesce(F.lower(text) == value.lower(), F.lit(False))

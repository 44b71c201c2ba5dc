"""Detail pages to enrichment columns.

A page embeds its data as a JSON array in which integers inside objects and lists are
indexes into that same array; an index that points at an integer yields that integer, an
index out of range stands for itself. The fields used here sit at fixed depth, so
following a fixed number of references is enough and no recursion is needed.

Where several objects of a page look like the listing, the one at the lowest position is
taken; ``page_decode.extract_decoded`` takes the one that a depth-first walk meets first, and
follows references to any depth.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions import numbers
from lotwise.functions.flags import DETAIL_NO, DETAIL_YES, to_bool
from lotwise.functions.specs import column_values, mapped_rows
from lotwise.functions.variants import Field, at, is_object, items, last_per_name, probe, text, type_is

# How the data script is marked, and which members identify the listing.
SCRIPT = r'(?s)<script[^>]*data-nuxt-data="nuxt-app"[^>]*id="__NUXT_DATA__">(.*?)</script>'
LISTING_MEMBERS = ("specs", "title", "price")
SPEC_MEMBERS = ("field", "title", "display_value", "value", "value_slug")
PRICE_MEMBERS = ("sale_price", "original_price", "amount_saved")
PAGE_MEMBERS = ("description", "total_like", "is_like", "is_saved", "available", "status")
RECEIPT_MEMBERS = ("id", "title", "price", *PAGE_MEMBERS)
CYCLE = "<cycle>"


def embedded_table(html: Column) -> Column:
    """The page's data array, null when there is none or it is not valid JSON."""
    return items(F.try_parse_json(F.nullif(F.regexp_extract(html, SCRIPT, 1), F.lit(""))))


def follow(table: Column, value: Column) -> Column:
    """The entry ``value`` refers to, or ``value`` itself when it is no reference."""
    index = F.try_variant_get(value, "$", "int")
    # the cheap range test comes first; the type test keeps numeric text from being followed
    points = (index >= 0) & (index < F.size(table)) & (F.schema_of_variant(value) == "BIGINT")
    return F.when(points, F.get(table, index)).otherwise(value)


def _unwrapped(table: Column, value: Column) -> Column:
    """Content of a ``["Tag", x]`` wrapper, other values unchanged."""
    wrapper = items(value)
    tagged = (F.size(wrapper) > 1) & type_is(F.get(wrapper, F.lit(0)), "STRING")
    return F.when(tagged, follow(table, F.get(wrapper, F.lit(1)))).otherwise(value)


def _flag(field: Field) -> Column:
    return (
        F.when(field.is_flag, field.text.try_cast("boolean"))
        .when(field.is_number, field.text.try_cast("double") != 0)
        .when(field.is_text, to_bool(field.text, DETAIL_YES, DETAIL_NO))
    )


def _likes(field: Field) -> Column:
    number = numbers.truncated(field.text.try_cast("double")).try_cast("int")
    return (
        F.when(field.is_number, F.coalesce(number, F.lit(0)))
        .when(field.is_text, numbers.like_count(field.text))
        .otherwise(F.lit(0))
    )


def _not_cycle(field: Field) -> Column:
    return F.nullif(text(field.value), F.lit(CYCLE))


def extract_details(
    pages: DataFrame, decode_receipt: bool = False, keep: Sequence[str] = (), listing: str | None = None
) -> DataFrame:
    """One row per page: ``listing_id``, ``matched``, the enrichment columns and those of ``keep``.

    ``listing`` names a column with the page's listing object, decoded already; it is then taken as
    it is, and as the receipt. Otherwise the object is looked up in the page's ``html``.

    ``raw_detail_payload`` is the page's whole data array. ``decode_receipt=True`` replaces
    it by the listing object: its own members, its specs and its discount with their
    references followed.
    """
    table, post, rows = F.col("_table"), F.col("_post"), F.col("_spec_rows")
    first, *others = LISTING_MEMBERS

    def looks_like_listing(entry: Column) -> Column:
        found = at(entry, first).isNotNull()
        for name in others:
            found = found & at(entry, name).isNotNull()
        return found

    def spec_field(entry: Column, name: str) -> Column:
        return follow(table, at(entry, name))

    unwrapped, prices, spec_names = PAGE_MEMBERS, PRICE_MEMBERS, SPEC_MEMBERS
    if listing is None:
        located = pages.select("listing_id", *keep, embedded_table(F.col("html")).alias("_table")).withColumn(
            "_post", F.get(F.filter(table, looks_like_listing), F.lit(0))
        )
    else:
        # without a table no number is a reference
        nothing = F.expr("CAST(array() AS array<variant>)")
        located = pages.select("listing_id", *keep, nothing.alias("_table"), F.col(listing).alias("_post"))
    followed = located.withColumns(
        {f"_f_{name}": follow(table, at(post, name)) for name in (*unwrapped, *prices, "discount", "specs")}
    ).withColumn("_spec_objects", F.transform(items(F.col("_f_specs")), lambda entry: follow(table, entry)))
    resolved = probe(
        followed.withColumn(
            "_spec_rows",
            F.transform(
                F.filter(F.col("_spec_objects"), is_object),
                lambda entry: F.struct(*[spec_field(entry, name).alias(name) for name in spec_names]),
            ),
        ),
        {name: _unwrapped(table, F.col(f"_f_{name}")) for name in unwrapped},
    )
    as_text = F.transform(rows, lambda row: F.struct(*[text(row[name]).alias(name) for name in spec_names]))
    shown = F.transform(
        rows,
        lambda row: F.struct(
            text(row["field"]).alias("name"),
            F.when(_is_filled(row["display_value"]), row["display_value"]).otherwise(row["value"]).alias("value"),
        ),
    )
    final = resolved.withColumns(
        {
            "_texts": as_text,
            "_shown": F.filter(shown, lambda pair: pair["name"].isNotNull()),
            **{
                f"_p_{name}": F.coalesce(
                    text(follow(table, at(F.col("_f_discount"), name))), text(F.col(f"_f_{name}"))
                )
                for name in prices
            },
        }
    ).withColumn("_mapped", mapped_rows(F.col("_texts")))

    matched = post.isNotNull()
    whole_table = F.to_variant_object(table)
    receipt = _receipt(table, post, F.col("_spec_objects")) if decode_receipt else whole_table
    receipt = receipt if listing is None else post
    return final.select(
        "listing_id",
        matched.alias("matched"),
        _not_cycle(Field("description")).alias("description"),
        F.when(matched, _likes(Field("total_like"))).alias("likes_count"),
        _flag(Field("is_like")).alias("is_like"),
        _flag(Field("is_saved")).alias("is_saved"),
        _flag(Field("available")).alias("listing_available"),
        _not_cycle(Field("status")).alias("listing_status"),
        F.when(F.size("_shown") > 0, F.to_variant_object(last_per_name(F.col("_shown")))).alias("detail_specs"),
        *keep,
        F.when(matched, receipt).alias("raw_detail_payload"),
        *[numbers.amount(F.col(f"_p_{name}")).alias(name) for name in prices],
        *[value.alias(name) for name, value in column_values(F.col("_mapped")).items()],
    )


def _members(table: Column, entry: Column, names: Sequence[str]) -> Column:
    return F.struct(*[follow(table, at(entry, name)).alias(name) for name in names])


def _receipt(table: Column, post: Column, specs: Column) -> Column:
    """The listing object with its references followed, as deep as listings go."""
    own = F.struct(
        *[_unwrapped(table, follow(table, at(post, name))).alias(name) for name in RECEIPT_MEMBERS],
        F.transform(specs, lambda entry: _members(table, entry, SPEC_MEMBERS)).alias("specs"),
        _members(table, follow(table, at(post, "discount")), PRICE_MEMBERS).alias("discount"),
    )
    return F.to_variant_object(own)


def _is_filled(value: Column) -> Column:
    shown = text(value)
    return F.coalesce(~shown.isin("", "0", "false", "[]", "{}") | ((shown != "") & type_is(value, "STRING")), F.lit(False))

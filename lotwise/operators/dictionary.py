"""Names of a dictionary found in texts, where the dictionary is a table of any size.

A name is looked up by its first characters, up to 16, among the pieces of the text that begin where a
name may begin: an equi-join, after which the whole name is compared. Of all names found in a text
the one of highest priority is kept by an aggregate. Texts are reduced to distinct ones first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.functions.text import strip
from lotwise.functions.titles import finish_brand_model, fold

_ANCHOR = 16
_WORD = r"[\p{L}\p{N}_]"
ANYWHERE, LEFT, WORD = "anywhere", "left", "word"


def _may_begin(folded: Column, at: Column, boundary: str) -> Column:
    before = F.substr(folded, at - 1, F.lit(1))
    free = {LEFT: ~before.rlike("[a-z]"), WORD: ~before.rlike(_WORD)}.get(boundary, F.lit(True))
    return (at == 1) | free


def find_names(texts: DataFrame, names: DataFrame, text: str, name: str = "name", boundary: str = ANYWHERE) -> DataFrame:
    """(text, found): for each distinct text the first of the names it holds, with its place ``at`` and other columns.

    The longest name comes first, of equally long ones that of the smallest ``position``, then the one that sorts first.
    ``names`` has ``name``, ``position`` and whatever else is wanted. Case does not matter for A-Z. ``boundary`` says what may not
    stand next to a name: nothing is asked (``anywhere``), no Latin letter before it (``left``), or no letter, digit or
    underscore on either side (``word``). Null texts, and texts without a name, are not returned.
    """
    others = [c for c in names.columns if c not in (name, "position")]
    listed = names.filter(F.length(name) > 0).select(
        fold(F.col(name)).alias("_name"),
        F.struct((-F.length(name)).alias("shorter"), F.col("position"), F.col(name).alias("name")).alias("_rank"),
        F.struct(F.col(name).alias("name"), *others).alias("_entry"),
    )
    listed = listed.withColumn("_anchor", F.substring("_name", 1, _ANCHOR))
    # at most 16 numbers
    sizes = sorted(row.n for row in listed.select(F.length("_anchor").alias("n")).distinct().collect())
    sizes = sizes or [_ANCHOR]
    distinct = texts.select(F.col(text).alias("_text")).filter(F.length("_text") > 0).distinct()
    folded = distinct.withColumn("_folded", fold(F.col("_text")))
    starts = F.filter(F.sequence(F.lit(1), F.length("_folded")), lambda at: _may_begin(F.col("_folded"), at, boundary))
    placed = folded.select("_text", "_folded", F.explode(starts).alias("_at"))
    pieces = F.array(*[F.struct(F.lit(n).alias("n"), F.substring(F.col("_folded"), F.col("_at"), F.lit(n)).alias("piece")) for n in sizes])
    pieces = F.filter(pieces, lambda entry: F.length(entry["piece"]) == entry["n"])
    looked_up = placed.select("_text", "_folded", "_at", F.explode(pieces).alias("_piece"))
    looked_up = looked_up.select("_text", "_folded", "_at", F.col("_piece.piece").alias("_anchor"))
    met = looked_up.join(listed, "_anchor")
    size = F.length("_name")
    fits = F.substr("_folded", F.col("_at"), size) == F.col("_name")
    if boundary == WORD:
        fits = fits & ~F.substr("_folded", F.col("_at") + size, F.lit(1)).rlike(_WORD)
    best = F.min_by(F.struct("_at", "_entry"), F.struct("_rank", "_at")).alias("_best")
    found = met.filter(fits).groupBy("_text").agg(best)
    columns = [F.col(f"_best._entry.{c}").alias(c) for c in ("name", *others)]
    return found.select(F.col("_text").alias(text), F.struct(F.col("_best._at").alias("at"), *columns).alias("found"))


def with_brand_model_from(
    df: DataFrame,
    brands: DataFrame,
    models: DataFrame,
    title: str = "listing_title",
    brand: str = "vehicle_brand",
    model: str = "vehicle_model",
    left_boundary: bool = False,
) -> DataFrame:
    """As ``titles.with_brand_model``, with dictionaries given as tables.

    ``brands`` has (name, position, canonical), ``models`` (name, position, brand). Models are looked for only in
    titles without a brand.
    """
    titled = df.withColumn("_title", strip(F.col(title)))
    branded = find_names(titled, brands, "_title", boundary=LEFT if left_boundary else ANYWHERE)
    branded = titled.select("_title").distinct().join(branded, "_title", "left").withColumnRenamed("found", "_b")
    modelled = find_names(branded.filter("_b is null"), models, "_title", boundary=WORD).withColumnRenamed("found", "_m")
    known = branded.join(modelled, "_title", "left").filter("_title is not null")
    named = titled.join(known, "_title", "left").withColumns(
        {
            "_brand": F.col("_b.name"),
            "_at": F.col("_b.at"),
            "_full": F.col("_b.canonical"),
            "_known": F.when(F.col("_m").isNotNull(), F.struct(F.col("_m.brand").alias("brand"), F.col("_m.name").alias("model"))),
        }
    )
    return finish_brand_model(named, brand, model).drop("_b", "_m").select(*df.columns, brand, model)

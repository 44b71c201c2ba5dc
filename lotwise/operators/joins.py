"""Join shapes that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ANCHOR = 16


def salted_lookup(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], spread_by: str, salts: int | None = None
) -> DataFrame:
    """Inner join of many ``rows`` with one row per group.

    ``groups`` is repeated once per salt and ``rows`` are salted by ``spread_by``, so the
    rows of one group go to up to ``salts`` tasks, by default to as many as the session has
    shuffle partitions.
    """
    salts = salts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    repeated = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*keys, "_salt"]).drop("_salt")


def anchored(needles: DataFrame, needle: str) -> DataFrame:
    """Add ``_anchor``, the first 16 characters that a text holding ``needle`` must have among its pieces."""
    return needles.withColumn("_anchor", F.substring(needle, 1, _ANCHOR))


def with_pieces(texts: DataFrame, text: str) -> DataFrame:
    """One row for each distinct piece, ``_anchor``, of up to 16 characters of each text."""
    starts = F.sequence(F.lit(1), F.length(text))
    pieces = F.flatten(
        F.transform(
            starts,
            lambda start: F.transform(
                F.sequence(F.lit(1), F.least(F.lit(_ANCHOR), F.length(text) - start + 1)),
                lambda size: F.substr(F.col(text), start, size),
            ),
        )
    )
    return texts.filter(F.length(text) > 0).withColumn("_anchor", F.explode(F.array_distinct(pieces)))


def contains_join(needles: DataFrame, texts: DataFrame, on: str, needle: str, text: str) -> DataFrame:
    """Pairs (on, needle, text) with equal ``on`` where ``text`` contains ``needle``.

    Not all pairs of an ``on`` group are compared: a needle is looked up by its first
    16 characters among the pieces of up to 16 characters that occur in each text, an
    equi-join. Needles of that length or less meet only texts that contain them; for longer
    ones the containment check removes chance hits. Meant for short texts such as names.
    """
    met = anchored(needles, needle).join(with_pieces(texts, text), [on, "_anchor"])
    return met.filter(F.contains(F.col(text), F.col(needle))).drop("_anchor")


def only_new(batch: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """Rows of ``batch`` whose ``key`` is not in ``stored``.

    The stored keys are first reduced to those the batch asks for. Adaptive execution
    broadcasts these once it has measured them as small, and the stored table is then not
    shuffled at all. ``batch`` is read twice.
    """
    asked = batch.select(key).distinct()
    known = stored.select(F.col(key).cast("string").alias(key)).join(asked, key, "left_semi").distinct()
    return batch.join(known, key, "left_anti")

"""One row per key, chosen by an explicit order.

A DataFrame has no row position, so "first" and "last" are defined by order
columns, which should make the order total. Both operators are aggregates: every
task reduces its rows to one per key before the shuffle, so a key that holds a third
of all rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str] | None, pick) -> DataFrame:
    wanted = list(columns or df.columns)
    payload = [name for name in wanted if name != key]
    chosen = df.groupBy(key).agg(pick(F.struct(*payload), F.struct(*order)).alias("_row"))
    return chosen.select(*[F.col(key) if name == key else F.col(f"_row.{name}") for name in wanted])


def keep_last(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """The row with the greatest ``order`` for each ``key``, narrowed to ``columns``."""
    return _one_per_key(df, key, order, columns, F.max_by)


def keep_first(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """The row with the smallest ``order`` for each ``key``, narrowed to ``columns``."""
    return _one_per_key(df, key, order, columns, F.min_by)

"""Exact quantiles that never hold one group in one task.

``percentile`` and ``median`` keep every distinct value of a group in a single
aggregation buffer, so one group with a third of all rows ends up in one task.
Here the work is spread by value instead:

1. values are cut into slices by magnitude (relative width 1/512, at most a few
   hundred thousand slices for the whole double range) and counted per (group, slice).
   Every task sends one row per slice it has seen, whatever the number of rows;
2. the running total of the slices tells in which slice each wanted rank lies;
3. only the values of those slices are looked at again and ranked. They are counted before
   they meet the slices, so a value that repeats is one row for each task and no hot key is left.

The result equals linear interpolation between the two neighbouring order
statistics. The input is read twice, so it should be a table or a cheap plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SLICES_PER_E = 512
_LAST_SLICE = 710.0 * _SLICES_PER_E  # beyond the largest double; infinity stands here
_ONE = "_all"


def value_slice(value: Column) -> Column:
    """Order-preserving slice number of a double that is not null.

    Declared non-null: a null check inferred for one branch only would keep Spark from
    sharing the counted values between the branches that use them.
    """
    magnitude = F.least(F.log1p(F.abs(value)) * _SLICES_PER_E, F.lit(_LAST_SLICE))
    return F.coalesce(F.when(value < 0, -F.floor(magnitude) - 1).otherwise(F.floor(magnitude)).cast("int"), F.lit(0))


def usable(value: Column) -> Column:
    """Null and NaN both count as missing; infinity is a value."""
    return value.isNotNull() & ~F.isnan(value)


def _present(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    rows = df.filter(usable(F.col(value).cast("double")))
    for key in keys:
        rows = rows.filter(F.col(key).isNotNull())
    return rows


def count_values(df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """(keys, value, weight): how often each value occurs; missing values and keys are left out.

    Worth doing before :func:`exact_quantiles` when there are very many groups.
    """
    times = F.sum(weight) if weight else F.count(F.lit(1))
    # + 0.0 folds -0.0 into 0.0
    number = (F.col(value).cast("double") + F.lit(0.0)).alias(value)
    return _present(df, keys, value).groupBy(*keys, number).agg(times.alias("weight"))


def exact_quantiles(
    rows: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: dict[str, float],
    size: str = "n",
    weight: str | None = None,
) -> DataFrame:
    """One row per group: ``keys``, number of rows ``size`` and one column per probability.

    Rows with a missing value or key are left out; ``weight`` names a column that says how
    many rows a row stands for. Without keys the result is one row, or none when there
    are no values.
    """
    by = list(keys) or [_ONE]
    sliced = _present(rows, keys, value).select(
        *(keys or [F.lit(0).alias(_ONE)]),
        (F.col(value).cast("double") + F.lit(0.0)).alias("_value"),
        (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("_weight"),
        value_slice(F.col(value).cast("double")).alias("_slice"),
    )

    group = Window.partitionBy(*by)
    running = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    located = (
        sliced.groupBy(*by, "_slice")
        .agg(F.sum("_weight").alias("_here"))
        .withColumn("_through", F.sum("_here").over(running))
        .withColumn("_n", F.sum("_here").over(group))
        .withColumn("_before", F.col("_through") - F.col("_here"))
    )

    def position(probability: float) -> Column:
        return F.lit(float(probability)) * (F.col("_n") - 1)

    def below(probability: float) -> Column:
        return F.floor(position(probability))

    def above(probability: float) -> Column:
        return F.ceil(position(probability))

    def covers(rank: Column) -> Column:
        return (rank >= F.col("_before")) & (rank < F.col("_through"))

    needed = F.lit(False)
    for probability in probabilities.values():
        needed = needed | covers(below(probability)) | covers(above(probability))
    targets = located.filter(needed).select(*by, "_slice", F.col("_before").alias("_base"), "_n")

    in_slice = (
        Window.partitionBy(*by, "_slice").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counted = sliced.groupBy(*by, "_slice", "_value").agg(F.sum("_weight").alias("_here"))
    ranked = (
        counted.join(targets, [*by, "_slice"])
        .withColumn("_through", F.col("_base") + F.sum("_here").over(in_slice))
        .withColumn("_before", F.col("_through") - F.col("_here"))
    )
    ends = [F.first("_n").alias("_n")]
    for name, probability in probabilities.items():
        ends.append(F.max(F.when(covers(below(probability)), F.col("_value"))).alias(f"_lo_{name}"))
        ends.append(F.max(F.when(covers(above(probability)), F.col("_value"))).alias(f"_hi_{name}"))
    found = ranked.groupBy(*by).agg(*ends)
    return found.select(
        *keys,
        F.col("_n").alias(size),
        *[
            F.when(F.col(f"_lo_{name}") == F.col(f"_hi_{name}"), F.col(f"_lo_{name}"))
            .otherwise(
                F.col(f"_lo_{name}")
                + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * (position(probability) - below(probability))
            )
            .alias(name)
            for name, probability in probabilities.items()
        ],
    )

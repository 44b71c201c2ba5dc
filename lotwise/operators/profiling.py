"""Column profiles and distribution statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotwise.contract import GATE_PRICED, GATE_ROWS
from lotwise.operators.joins import salted_lookup
from lotwise.operators.quantiles import count_values, exact_quantiles, usable
from lotwise.session import through_table

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _present(df: DataFrame, name: str) -> Column:
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return usable(column)
    return column.isNotNull()


def _comparable(df: DataFrame, name: str) -> Column:
    """Column in a form that min and max accept."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.VariantType, T.MapType)):
        column = F.to_json(column)
    return F.when(_present(df, name), column)


def completeness(df: DataFrame) -> DataFrame:
    """Per column: rows, non-null count and share, and whether it holds at most one value.

    Two extreme values per column decide constancy, so there is one pass and no
    distinct count.
    """
    totals = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(_present(df, name)).alias(f"_n_{i}") for i, name in enumerate(df.columns)],
        *[
            F.min(_comparable(df, name)).eqNullSafe(F.max(_comparable(df, name))).alias(f"_c_{i}")
            for i, name in enumerate(df.columns)
        ],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(df.schema[name].dataType.simpleString()).alias("data_type"),
                F.col("_rows").alias("rows"),
                F.col(f"_n_{i}").alias("non_null"),
                (F.col(f"_n_{i}") * 100.0 / F.col("_rows")).alias("non_null_pct"),
                F.col(f"_c_{i}").alias("is_constant"),
            )
            for i, name in enumerate(df.columns)
        ]
    )
    return totals.filter("_rows > 0").select(F.inline(lines))


def missing_profile(df: DataFrame) -> DataFrame:
    """Columns with missing values, most missing first; share rounded to one decimal."""
    missing = F.col("rows") - F.col("non_null")
    return (
        completeness(df)
        .select(
            "column_name",
            missing.alias("missing_count"),
            F.bround(missing * 100.0 / F.col("rows"), 1).alias("missing_pct"),
            "data_type",
        )
        .filter("missing_count > 0")
        .orderBy(F.desc("missing_count"), "column_name")
    )


def constant_columns(df: DataFrame) -> DataFrame:
    return completeness(df).filter("is_constant").select("column_name", "non_null")


def quality_gate(df: DataFrame, min_rows: int = GATE_ROWS, min_priced: int = GATE_PRICED) -> DataFrame:
    """One row: volume, priced volume and whether both thresholds are met."""
    totals = df.agg(F.count(F.lit(1)).alias("total_listings"), F.count_if(_present(df, "price")).alias("priced"))
    return totals.withColumns(
        {
            "enough_listings": F.col("total_listings") >= min_rows,
            "enough_priced": F.col("priced") >= min_priced,
            "requirements_met": (F.col("total_listings") >= min_rows) & (F.col("priced") >= min_priced),
        }
    )


def shape(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, columns and distinct non-null keys."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return per_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
        F.lit(len(df.columns)).alias("column_count"),
        F.count(key).alias("distinct_ids"),
    )


def describe(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample standard deviation, min, quartiles and max of ``value`` per group."""
    number = F.col(value).cast("double")
    present = df.filter(usable(number)).select(*keys, number.alias(value))
    for key in keys:
        present = present.filter(F.col(key).isNotNull())
    moments = [F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")]
    extremes = [F.min(value).alias("min"), F.max(value).alias("max")]
    quartiles = exact_quantiles(present, keys, value, QUARTILES, "count")
    names = ["count", *QUARTILES]
    if keys:
        joined = present.groupBy(*keys).agg(*moments, *extremes).join(quartiles, list(keys))
    else:
        row = quartiles.select(F.struct(*names).alias("row")).scalar()
        joined = present.agg(*moments, *extremes).withColumn("_row", row).select("*", "_row.*")
    return joined.select(
        *keys, F.coalesce("count", F.lit(0)).alias("count"), "mean", "std", "min", "q1", "median", "q3", "max"
    )


def adjusted_skewness(value: Column) -> Column:
    """Sample-adjusted (bias-corrected) skewness; null below three values or without spread."""
    n = F.count(value)
    spread = F.max(value) > F.min(value)
    return F.when((n >= 3) & spread, F.skewness(value) * F.sqrt(n * (n - 1)) / (n - 2))


def skew_and_log(df: DataFrame, value: str) -> DataFrame:
    """One row: adjusted skewness of ``value`` and mean of ``log1p(value)``."""
    present = df.filter(usable(F.col(value)))
    return present.agg(
        F.count(F.lit(1)).alias("n"),
        adjusted_skewness(F.col(value)).alias("skew"),
        F.avg(F.log1p(value)).alias("mean_log"),
    )


def histogram(df: DataFrame, value: Column, bins: int = 40) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins are listed too."""
    points = df.select(value.cast("double").alias("x")).filter(usable(F.col("x")))
    # the range is one row, read back as a scalar subquery
    ends = points.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("ends"))
    low, high = F.col("_ends.lo"), F.col("_ends.hi")
    # a single distinct value gets a unit-wide range around it, as histogram edges do
    start = F.when(high > low, low).otherwise(low - 0.5)
    width = F.when(high > low, high - low).otherwise(F.lit(1.0))
    ranged = points.withColumn("_ends", ends.scalar())
    index = F.least(F.floor((F.col("x") - start) * bins / width), F.lit(bins - 1).cast("bigint"))
    filled = ranged.groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    edges = df.sparkSession.range(bins).withColumn("_ends", ends.scalar())
    return (
        edges.join(F.broadcast(filled.withColumnRenamed("bin", "id")), "id", "left")
        .select(
            F.col("id").alias("bin"),
            (start + F.col("id") * width / bins).alias("bin_start"),
            F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        )
        .filter("bin_start is not null")
    )


def null_pattern_sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sums for correlations, one row for each set of columns that are present together.

    ``pattern`` has a bit for each column; ``n`` rows; arrays ``s`` of sums, ``lo`` and ``hi`` of extremes by
    column, and ``p`` of sums of products by pair, in the order of :func:`_pairs`. Values are taken from
    their column's mean first, so that products do not lose digits. At most 2^columns rows.
    """
    numbers = df.select(
        *[F.when(usable(F.col(name).cast("double")), F.col(name).cast("double")).alias(f"_{i}") for i, name in enumerate(columns)]
    )
    means = numbers.agg(F.struct(*[F.avg(f"_{i}").alias(f"_{i}") for i in range(len(columns))]).alias("means")).scalar()
    centred = numbers.withColumn("_means", means).select(
        *[(F.col(f"_{i}") - F.col(f"_means._{i}")).alias(f"_{i}") for i in range(len(columns))]
    )
    bits = [F.when(F.col(f"_{i}").isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i in range(len(columns))]
    marked = centred.withColumn("pattern", reduce(lambda x, y: x + y, bits))
    grouped = marked.groupBy("pattern").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(f"_{i}").alias(f"s{i}") for i in range(len(columns))],
        *[F.min(f"_{i}").alias(f"lo{i}") for i in range(len(columns))],
        *[F.max(f"_{i}").alias(f"hi{i}") for i in range(len(columns))],
        *[F.sum(F.col(f"_{i}") * F.col(f"_{j}")).alias(f"p{k}") for k, (i, j) in enumerate(_pairs(len(columns)))],
    )
    listed = {"s": len(columns), "lo": len(columns), "hi": len(columns), "p": len(_pairs(len(columns)))}
    return grouped.select(
        "pattern", "n", *[F.array(*[F.col(f"{name}{i}") for i in range(size)]).alias(name) for name, size in listed.items()]
    )


def _pairs(many: int) -> list[tuple[int, int]]:
    """Pairs of column numbers: each with itself, then all others."""
    return [(i, i) for i in range(many)] + list(combinations(range(many), 2))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form, each pair over the rows where both are present.

    A column without spread among those rows gives null. Rows are reduced to one row of plain sums for
    each pattern of missing values, and pairs are put together from these few rows. ``df`` is
    read twice (means, sums), so it should be a table or a cheap plan.
    """
    pairs = _pairs(len(columns))
    spots = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(k).alias("k")) for k, (i, j) in enumerate(pairs)])
    empty = [F.lit(0).alias("pattern"), F.lit(0).cast("long").alias("n")]
    arrays = [F.expr(f"CAST(array() AS array<double>) AS {name}") for name in ("s", "lo", "hi", "p")]
    # one row without data, so that a table without rows has its lines too
    patterns = null_pattern_sums(df, columns).unionByName(df.sparkSession.range(1).select(*empty, *arrays))
    both = patterns.select("*", F.explode(spots).alias("pair")).select("*", "pair.*")
    has = F.col("pattern").bitwiseAND(F.expr("shiftleft(1, i) | shiftleft(1, j)")) == F.expr("shiftleft(1, i) | shiftleft(1, j)")

    def of(name: str, spot: str) -> Column:
        return F.when(has, F.get(name, F.col(spot)))

    sums = both.groupBy("i", "j").agg(
        F.sum(F.when(has, F.col("n"))).alias("n"),
        F.sum(of("s", "i")).alias("x"),
        F.sum(of("s", "j")).alias("y"),
        F.sum(of("p", "i")).alias("xx"),
        F.sum(of("p", "j")).alias("yy"),
        F.sum(of("p", "k")).alias("xy"),
        ((F.max(of("hi", "i")) > F.min(of("lo", "i"))) & (F.max(of("hi", "j")) > F.min(of("lo", "j")))).alias("spread"),
    )

    def around(product: str, a: str, b: str) -> Column:
        return F.col(product) - F.col(a) * F.col(b) / F.col("n")

    strength = F.when(F.col("i") == F.col("j"), F.when(F.isnan("xx"), F.lit(float("nan"))).otherwise(1.0)).otherwise(
        F.try_divide(around("xy", "x", "y"), F.sqrt(around("xx", "x", "x")) * F.sqrt(around("yy", "y", "y")))
    )
    names = F.array(*[F.lit(name) for name in columns])
    line = sums.select(F.get(names, "i").alias("a"), F.get(names, "j").alias("b"), F.when(F.col("spread"), strength).alias("corr"))
    ends = F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y")))
    return line.select(F.explode(F.array_distinct(ends)).alias("ends"), "corr").select("ends.x", "ends.y", "corr")


def box_stats(df: DataFrame, key: str, value: str, reach: float = 1.5) -> DataFrame:
    """Box-plot numbers per group: quartiles, whiskers within ``reach``·IQR, outliers."""
    return _boxes(count_values(df, [key], value), [key], value, reach)


def _boxes(rows: DataFrame, keys: Sequence[str], value: str, reach: float) -> DataFrame:
    """Box-plot numbers of counted values (keys, value, weight)."""
    boxes = exact_quantiles(rows, keys, value, QUARTILES, weight="weight")
    spread = F.col("q3") - F.col("q1")
    fences = boxes.withColumns({"_low": F.col("q1") - reach * spread, "_high": F.col("q3") + reach * spread})
    fenced = salted_lookup(rows, fences, keys, spread_by=value)
    inside = F.col(value).between(F.col("_low"), F.col("_high"))
    same = ["n", "q1", "median", "q3"]
    return (
        fenced.groupBy(*keys)
        .agg(
            *[F.first(name).alias(name) for name in same],
            F.min(F.when(inside, F.col(value))).alias("_least"),
            F.max(F.when(inside, F.col(value))).alias("_most"),
            F.sum(F.when(inside, 0).otherwise(F.col("weight"))).alias("outliers"),
        )
        .select(
            *keys,
            *same,
            F.least("_least", "q1").alias("whisker_low"),
            F.greatest("_most", "q3").alias("whisker_high"),
            "outliers",
        )
    )


@dataclass(frozen=True)
class Leaders:
    """The ``limit`` most frequent groups of a dimension, ties by name; ``exclude`` are not ranked."""

    limit: int
    exclude: tuple[str, ...] = ()


def counts_by_dimension(
    df: DataFrame, dimensions: Sequence[str], value: str, weight: str | None = None
) -> DataFrame:
    """(dimension, group, value, weight): how often each value occurs in each group of each dimension.

    One scan serves all dimensions: every row stands for itself in each of them and is counted before
    anything is shuffled. A missing value keeps its count, a missing group is left out. ``weight`` names
    a column that says how many rows a row stands for.
    """
    number = F.col(value).cast("double") + F.lit(0.0)
    number = F.when(usable(number), number).alias(value)
    places = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("group")) for d in dimensions])
    times = (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("weight")
    placed = df.select(F.explode(places).alias("_place"), number, times).select("_place.*", value, "weight")
    counted = placed.filter(F.col("group").isNotNull()).groupBy("dimension", "group", value)
    return counted.agg(F.sum("weight").alias("weight"))


def box_stats_many(
    df: DataFrame, dimensions: Mapping[str, Leaders | None], value: str, reach: float = 1.5
) -> DataFrame:
    """Box-plot numbers of several dimensions, as (dimension, group, …), from one read of ``df``.

    The counts of :func:`counts_by_dimension` are written once; quartiles, fences and leading
    groups all come from them.
    """
    counts = through_table(counts_by_dimension(df, list(dimensions), value), "dimension-counts")
    sizes = counts.groupBy("dimension", "group").agg(F.sum("weight").alias("_rows"))
    for dimension, leaders in dimensions.items():
        if leaders is None:
            continue
        of_it = F.col("dimension") == dimension
        ranked = sizes.filter(of_it & ~F.col("group").isin(*leaders.exclude)) if leaders.exclude else sizes.filter(of_it)
        first = ranked.orderBy(F.desc("_rows"), "group").limit(leaders.limit).select("dimension", "group")
        # at most ``limit`` rows are broadcast
        kept = counts.join(F.broadcast(first), ["dimension", "group"], "left_semi")
        counts = counts.filter(~of_it).unionByName(kept)
    return _boxes(counts.filter(F.col(value).isNotNull()), ["dimension", "group"], value, reach)

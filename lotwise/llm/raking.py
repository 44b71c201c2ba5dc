"""Mixing sources to target weights by iterative proportional fitting.

Token weights are summed into cells, one for each combination of the dimensions' values, and
the cells are raked: each round scales them to every dimension's target shares in turn.
A document's probability follows from the weight its cell ends with, so the expected tokens
of the sample have the target shares in all dimensions at once. With a token rate, no cell
gives more than it has: a value or cell too small for its share is taken whole, and the
others make up for it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import sort_joined, stored

MISSING = "\u0000missing"


def tokens(text: Column) -> Column:
    """Number of runs of ``[^\\x20\\x09-\\x0D]``; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _value(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(MISSING))


def cells(docs: DataFrame, dimensions: Sequence[str], weight: str) -> DataFrame:
    """(dimensions, tokens): summed weights; a null value is a category of its own."""
    keyed = docs.select(*[_value(d).alias(f"_{d}") for d in dimensions], F.col(weight).alias("_w"))
    return keyed.groupBy(*[f"_{d}" for d in dimensions]).agg(F.sum("_w").cast("double").alias("tokens"))


def softened_targets(cell_table: DataFrame, dimension: str, power: float) -> DataFrame:
    """(value, share): observed token sums raised to ``power``; 1 keeps their ratios, 0 makes them equal."""
    sums = cell_table.groupBy(F.col(f"_{dimension}").alias("value")).agg(F.sum("tokens").alias("n"))
    return sums.where("n > 0").select("value", F.pow(F.col("n"), F.lit(power)).alias("share"))


def rake(
    cell_table: DataFrame, targets: Mapping[str, DataFrame], rounds: int = 50, tolerance: float = 1e-6
) -> DataFrame:
    """Add ``weight`` to each cell; weights sum to 1 and meet the targets of every dimension.

    Targets (value, share) need not sum to 1 and are taken relative to the values that occur;
    a value without a target, and a cell without tokens, gets weight 0. Rounds end when no
    share is off by more than ``tolerance``; targets that contradict each other end after
    ``rounds`` with the last weights. Each round is written, which cuts the lineage; only the
    largest error reaches the driver.
    """
    present = cell_table.where("tokens > 0")
    goals = {}
    for dimension, wanted in targets.items():
        values = present.select(F.col(f"_{dimension}").alias("value")).distinct()
        wanted = values.join(wanted, "value").where("share > 0")
        total = wanted.agg(F.sum("share")).first()[0] or 1.0
        goals[dimension] = stored(
            wanted.select(F.col("value").alias(f"_{dimension}"), (F.col("share") / total).alias("goal")), "targets"
        )
    table = present
    for dimension, goal in goals.items():
        table = table.join(goal.select(f"_{dimension}"), f"_{dimension}", "left_semi")
    table = stored(table.withColumn("weight", F.col("tokens")), "cells")

    def shares(df: DataFrame, dimension: str) -> DataFrame:
        sums = df.groupBy(f"_{dimension}").agg(F.sum("weight").alias("now"))
        return sums.join(goals[dimension], f"_{dimension}")

    for _ in range(rounds):
        for dimension in goals:
            factors = shares(table, dimension).select(f"_{dimension}", (F.col("goal") / F.col("now")).alias("factor"))
            table = table.join(factors, f"_{dimension}").withColumn("weight", F.col("weight") * F.col("factor"))
            table = table.drop("factor")
        table = stored(table, "cells")
        worst = None
        for dimension in goals:
            off = shares(table, dimension).select(F.abs(F.col("now") - F.col("goal")).alias("off"))
            worst = off if worst is None else worst.union(off)
        error = worst.agg(F.max("off")).first()[0] if worst is not None else None
        if error is None or error <= tolerance:
            break
    names = [c for c in cell_table.columns if c != "tokens"]
    return cell_table.join(table.select(*names, "weight"), names, "left").fillna(0.0, ["weight"])


def _bounded_goals(cell_table: DataFrame, dimension: str, wanted: DataFrame, kept: float, rounds: int) -> DataFrame:
    """(_dimension, goal): tokens to keep of each value, ``kept`` in sum; a value too small for its share is whole."""
    name = f"_{dimension}"
    sums = cell_table.groupBy(name).agg(F.sum("tokens").alias("has"))
    sums = stored(sums.join(wanted.select(F.col("value").alias(name), "share"), name), "targets")
    level, whole = 0.0, -1
    for _ in range(rounds):
        full = F.col("share") * level >= F.col("has")
        count, has, share = sums.agg(
            F.count_if(full), F.sum(F.when(full, F.col("has")).otherwise(0.0)), F.sum(F.when(~full, F.col("share")))
        ).first()
        if count == whole or not share:
            break
        level, whole = (kept - has) / share, count
    goal = F.col("has") if kept and not share else F.least("has", F.col("share") * level)
    return stored(sums.select(name, goal.alias("goal")), "targets")


def rake_bounded(
    cell_table: DataFrame,
    targets: Mapping[str, DataFrame],
    rate: float,
    rounds: int = 50,
    tolerance: float = 1e-6,
) -> DataFrame:
    """Add ``weight`` to each cell: the tokens to keep of it, at most all, ``rate`` of all tokens in sum.

    Targets are taken as by ``rake``. Values that have less than their share of the kept
    tokens are whole, and the others share the rest by their targets. A cell's weight is its
    tokens times one factor for each of its values, or all its tokens if that is less. Cells
    without a target cannot be kept; if the rest has fewer tokens than ``rate`` asks for, all
    of the rest is kept. Rounds end as those of ``rake``, their error relative to the kept
    tokens; goals that no weights meet end after ``rounds``.
    """
    table = cell_table.where("tokens > 0")
    for dimension, wanted in targets.items():
        known = wanted.where("share > 0").select(F.col("value").alias(f"_{dimension}"))
        table = table.join(known, f"_{dimension}", "left_semi")
    table = stored(table.withColumn("weight", F.col("tokens") * rate), "cells")
    kept = min(rate * (cell_table.agg(F.sum("tokens")).first()[0] or 0.0), table.agg(F.sum("tokens")).first()[0] or 0.0)
    goals = {d: f"goal{i}" for i, d in enumerate(targets)}
    for dimension, wanted in targets.items():
        bounds = _bounded_goals(table, dimension, wanted, kept, rounds)
        table = table.join(sort_joined(bounds.withColumnRenamed("goal", goals[dimension])), f"_{dimension}")
    # cells carry their goals, so that no round joins them again
    table = stored(table, "cells")
    full = F.col("weight") >= F.col("tokens")
    by_all = F.col("goal") / F.col("every")
    # a Newton step towards the factor that meets the goal; neither quotient is above that factor
    factor = (
        F.when(F.col("free") > 0, F.greatest((F.col("goal") - F.col("fixed")) / F.col("free"), by_all))
        .when(F.col("goal") >= F.col("fixed") * (1 - 1e-9), 1.0)
        .otherwise(by_all)
    )
    # a cell's value and goal in each dimension, so that all shares are summed at once
    places = [
        F.struct(F.lit(d).alias("dimension"), F.col(f"_{d}").cast("string").alias("value"), F.col(g).alias("goal"))
        for d, g in goals.items()
    ]
    for _ in range(rounds if goals else 0):
        for dimension, goal in goals.items():
            sums = table.groupBy(f"_{dimension}").agg(
                F.sum(F.when(full, F.col("tokens")).otherwise(0.0)).alias("fixed"),
                F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("free"),
                F.sum("weight").alias("every"),
                F.max(goal).alias("goal"),
            )
            factors = sums.select(f"_{dimension}", factor.alias("factor"))
            table = table.join(sort_joined(factors), f"_{dimension}").withColumn("weight", F.col("weight") * F.col("factor"))
            # written for each dimension: sums of sums would double the plan each time, and the driver holds it
            table = stored(table.drop("factor"), "cells")
        placed = table.select(F.least("weight", "tokens").alias("now"), F.inline(F.array(*places)))
        sums = placed.groupBy("dimension", "value").agg(F.sum("now").alias("now"), F.max("goal").alias("goal"))
        error = sums.agg(F.max(F.abs(F.col("now") - F.col("goal")))).first()[0]
        if error is None or error <= tolerance * kept:
            break
    names = [c for c in cell_table.columns if c != "tokens"]
    bounded = table.select(*names, F.least("weight", "tokens").alias("weight"))
    return cell_table.join(bounded, names, "left").fillna(0.0, ["weight"])


def row_key(key: str, text: str) -> Column:
    """Key that no row lacks: ``key`` as text, or a hash of the row's text where it is null."""
    return F.coalesce(F.col(key).cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")))))


def sample(
    docs: DataFrame,
    dimensions: Sequence[str],
    weight: str,
    key: str,
    power: float = 0.7,
    targets: Mapping[str, DataFrame] | None = None,
    rate: float | None = None,
    seed: int = 7,
) -> DataFrame:
    """Add ``probability`` and ``sampled`` to each document.

    Without ``targets``, every dimension aims at its observed shares raised to ``power``.
    Probabilities are cell weight over cell tokens. With ``rate``, the expected tokens are
    that share of all tokens whatever the smallest cells are: cells that are too small are
    taken whole (``rake_bounded``), and shares are off by what the small values lack. Without,
    the scale is the largest that keeps all probabilities at most 1 and the expected shares
    are the targets exactly; the most up-weighted cell then decides how much is kept.
    The draw is a hash of ``key`` and ``seed``: repeatable, and equal for rows that repeat a
    key. A document without tokens, or with a null key, has probability 0.
    """
    cell_table = stored(cells(docs, dimensions, weight), "cells")
    if targets is None:
        targets = {d: softened_targets(cell_table, d, power) for d in dimensions}
    raked = rake(cell_table, targets) if rate is None else rake_bounded(cell_table, targets, rate)
    raked = stored(raked, "raked")
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    scale = 1.0
    if rate is None:
        top = raked.agg(F.max(ratio)).first()[0]
        scale = 1.0 / top if top else 0.0
    names = [f"_{d}" for d in dimensions]
    rates = raked.select(*names, F.least(ratio * scale, F.lit(1.0)).alias("_p"))
    keyed = docs.withColumns({f"_{d}": _value(d) for d in dimensions})
    draw = (F.xxhash64(F.col(key), F.lit(seed)).bitwiseAND(F.lit((1 << 53) - 1))).cast("double") / float(1 << 53)
    usable = F.col(key).isNotNull() & (F.col(weight) > 0)
    joined = keyed.join(rates, names, "left")
    joined = joined.withColumn("probability", F.when(usable, F.coalesce("_p", F.lit(0.0))).otherwise(0.0))
    return joined.withColumn("sampled", draw < F.col("probability")).drop(*names, "_p")

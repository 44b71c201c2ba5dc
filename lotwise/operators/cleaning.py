"""Quality rules that turn raw listings into the clean contract.

1. a price is present, 2. it lies in [500, 300000], 3. the model year lies in
[1990, as_of_year + 1] or is null, 4. only contract columns remain, 5. categories are
standardised, 6. one row per listing id, the last one.

``as_of_year`` and the order that defines "last" are parameters: nothing depends on
the clock or on row position.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lotwise.contract import CLEAN_COLUMNS, PRICE_MAX, PRICE_MIN, YEAR_MAX_OFFSET, YEAR_MIN
from lotwise.functions import text
from lotwise.operators.dedup import keep_last
from lotwise.operators.quantiles import usable

DEFAULT_ORDER = ("scraped_at",)


@dataclass(frozen=True)
class Rules:
    as_of_year: int
    price_min: float = PRICE_MIN
    price_max: float = PRICE_MAX
    year_min: int = YEAR_MIN
    year_max_offset: int = YEAR_MAX_OFFSET
    synonyms: dict[str, dict[str, str]] = field(default_factory=lambda: text.CATEGORY_SYNONYMS)

    @property
    def year_max(self) -> int:
        return self.as_of_year + self.year_max_offset

    def has_price(self) -> Column:
        return usable(F.col("price"))

    def price_in_range(self) -> Column:
        return F.col("price").between(self.price_min, self.price_max)

    def year_plausible(self) -> Column:
        year = F.col("vehicle_model_year")
        return year.isNull() | year.between(self.year_min, self.year_max)


def standardise_categories(df: DataFrame, synonyms: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """Standardise the category columns that are present."""
    words = text.CATEGORY_SYNONYMS if synonyms is None else synonyms
    return df.withColumns(
        {name: text.category(F.col(name), known) for name, known in words.items() if name in df.columns}
    )


def clean(
    raw: DataFrame,
    rules: Rules,
    order: Sequence[str] = DEFAULT_ORDER,
    columns: Sequence[str] = CLEAN_COLUMNS,
) -> DataFrame:
    """Apply all rules. ``order`` may name raw columns outside the contract.

    ``columns`` narrows the contract for consumers that need less, so that less data is
    carried through the deduplication. A missing contract column is an error.
    """
    valid = raw.filter(rules.has_price() & rules.price_in_range() & rules.year_plausible())
    wanted = list(dict.fromkeys(["listing_id", *columns]))
    ordering = [F.col(name).alias(f"_order_{i}") for i, name in enumerate(order)]
    slim = standardise_categories(valid.select(*wanted, *ordering), rules.synonyms)
    last = keep_last(slim, "listing_id", [f"_order_{i}" for i in range(len(order))], wanted)
    return last.select(*columns)


def rule_audit(raw: DataFrame, rules: Rules) -> DataFrame:
    """Rows removed and remaining per rule, in one pass plus a distinct count of ids."""
    priced = F.coalesce(rules.has_price(), F.lit(False))
    in_range = priced & F.coalesce(rules.price_in_range(), F.lit(False))
    plausible = in_range & F.coalesce(rules.year_plausible(), F.lit(False))
    # counted per id first, so that distinct ids need no second pass over the rows
    per_id = raw.groupBy("listing_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(priced).alias("priced"),
        F.count_if(in_range).alias("in_range"),
        F.count_if(plausible).alias("plausible"),
    )
    totals = per_id.agg(
        *[F.sum(name).alias(name) for name in ("rows", "priced", "in_range", "plausible")],
        F.count_if(F.col("plausible") > 0).alias("ids"),
    )
    steps = [
        ("1 has price", "rows", "priced"),
        ("2 price range", "priced", "in_range"),
        ("3 model year", "in_range", "plausible"),
        ("6 last per id", "plausible", "ids"),
    ]
    lines = F.array(
        *[
            F.struct(
                F.lit(rule).alias("rule"),
                (F.col(before) - F.col(after)).alias("removed"),
                F.col(after).alias("remaining"),
            )
            for rule, before, after in steps
        ]
    )
    return totals.select(F.inline(lines))


class ObservedCleaning:
    """Cleaning whose audit and post-conditions are counted by the very job that takes its ``rows``.

    ``rows`` are those of :func:`clean`. After they have been written once, :meth:`audit` has the lines of
    :func:`rule_audit` and :meth:`require` checks what :func:`require_integrity` checks, without reading
    anything again. Ids of the result are distinct, as it is grouped by them. The counts of the raw rows
    come from the stage that reads them; should that stage be repeated after the loss of an
    executor, they are too high, which ``audit(raw_rows=…)`` notices.
    """

    def __init__(
        self, raw: DataFrame, rules: Rules, order: Sequence[str] = DEFAULT_ORDER, columns: Sequence[str] = CLEAN_COLUMNS
    ):
        self._spark, self._columns = raw.sparkSession, list(columns)
        self._before, self._after = Observation(), Observation()
        priced = F.coalesce(rules.has_price(), F.lit(False))
        in_range = priced & F.coalesce(rules.price_in_range(), F.lit(False))
        plausible = in_range & F.coalesce(rules.year_plausible(), F.lit(False))
        # narrowed first: what is observed above the scan would otherwise be read with all its columns
        needed = dict.fromkeys(["listing_id", *columns, "price", "vehicle_model_year", *order])
        watched = raw.select(*needed).observe(
            self._before,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(priced).alias("priced"),
            F.count_if(in_range).alias("in_range"),
            F.count_if(plausible).alias("plausible"),
        )
        # the conditions are looked at where their columns are among those asked for
        checks = {"bad_prices": ~F.coalesce(rules.price_in_range(), F.lit(False)), "bad_years": ~rules.year_plausible()}
        shown = {"bad_prices": "price", "bad_years": "vehicle_model_year"}
        cleaned = clean(watched, rules, order, columns)
        self.rows = cleaned.observe(
            self._after,
            F.count(F.lit(1)).alias("ids"),
            F.count_if(F.col("listing_id").isNull() if "listing_id" in columns else F.lit(False)).alias("missing_ids"),
            *[F.count_if(check if shown[name] in columns else F.lit(False)).alias(name) for name, check in checks.items()],
        )

    def audit(self, raw_rows: int | None = None) -> DataFrame:
        """Rows removed and remaining per rule; ``raw_rows`` is the known number of raw rows, if it is to be compared."""
        found = {**self._before.get, **self._after.get}
        if raw_rows is not None and raw_rows != found["rows"]:
            raise RuntimeError(f"{found['rows']} raw rows were counted, {raw_rows} are there: a stage was repeated")
        steps = [
            ("1 has price", "rows", "priced"),
            ("2 price range", "priced", "in_range"),
            ("3 model year", "in_range", "plausible"),
            ("6 last per id", "plausible", "ids"),
        ]
        lines = [(rule, found[before] - found[after], found[after]) for rule, before, after in steps]
        return self._spark.createDataFrame(lines, "rule string, removed bigint, remaining bigint")

    def require(self, columns: Sequence[str] = CLEAN_COLUMNS) -> None:
        """Raise ``ValueError`` unless the rows that were written satisfy the clean contract."""
        if self._columns != list(columns):
            raise ValueError(f"columns differ from the contract: {self._columns}")
        broken = {name: count for name, count in self._after.get.items() if name != "ids" and count}
        if broken:
            raise ValueError(f"clean table violates its contract: {broken}")


def integrity(df: DataFrame, rules: Rules) -> DataFrame:
    """One row of post-condition checks on a cleaned table."""
    per_id = df.groupBy("listing_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.coalesce(rules.price_in_range(), F.lit(False))).alias("bad_price"),
        F.count_if(~rules.year_plausible()).alias("bad_year"),
    )
    return per_id.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("listing_id").isNull(), F.col("rows"))), F.lit(0)).alias("missing_ids"),
        F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("duplicate_ids"),
        F.coalesce(F.sum("bad_price"), F.lit(0)).alias("bad_prices"),
        F.coalesce(F.sum("bad_year"), F.lit(0)).alias("bad_years"),
    )


def require_integrity(df: DataFrame, rules: Rules, columns: Sequence[str] = CLEAN_COLUMNS) -> None:
    """Raise ``ValueError`` unless ``df`` satisfies the clean contract."""
    if df.columns != list(columns):
        raise ValueError(f"columns differ from the contract: {df.columns}")
    found = integrity(df, rules).first().asDict()
    broken = {name: count for name, count in found.items() if name != "rows" and count}
    if broken:
        raise ValueError(f"clean table violates its contract: {broken}")


def reject_requests(requests: DataFrame, rules: Rules) -> DataFrame:
    """Price requests with ``reject_reason``; null means accepted."""
    year, km = F.col("vehicle_model_year"), F.col("vehicle_mileage_km")
    return requests.withColumn(
        "reject_reason",
        F.when(F.col("vehicle_brand").isNull(), F.lit("missing_brand"))
        .when(F.col("vehicle_model").isNull(), F.lit("missing_model"))
        .when(year.isNull(), F.lit("missing_year"))
        .when(~year.between(rules.year_min, rules.year_max), F.lit("year_out_of_range"))
        .when(km < 0, F.lit("negative_mileage")),
    )

"""A stored index of comparables: built once for a market, read by many batches of requests.

Four tables, each partitioned by a fixed hash of the brand, so that a batch opens only the folders
of the brands it asks for:

* ``prices``  (brand, model, year, price) with the number of listings;
* ``names``   (brand, model, year) with the number of listings, from which set sizes come;
* ``pieces``  (brand, piece, model): where a requested name may occur, an equi-join instead of
  a comparison of all names;
* ``brands``  median price, median year and size of each brand, as whole brands are asked for most
  and cost most.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.operators.joins import anchored, salted_lookup, with_pieces
from lotwise.operators.valuation import (
    SET,
    brand_medians,
    choose_sets,
    keyed_requests,
    market_index,
    priced_requests,
    set_key,
    set_medians,
)
from lotwise.session import through_table

_TABLES = {
    "prices": "_b string, _text string, _year int, price double, weight bigint, bucket int",
    "names": "_b string, _text string, _year int, weight bigint, bucket int",
    "pieces": "_b string, _text string, _anchor string, bucket int",
    "brands": "_b string, _median double, _ref_year double, _size bigint, bucket int",
}
_SALTS = 8


@dataclass(frozen=True)
class ComparablesIndex:
    """Index at ``path``; ``buckets`` must be what it was built with."""

    path: str
    buckets: int = 64

    def bucket(self, brand: Column) -> Column:
        return F.pmod(F.xxhash64(brand), F.lit(self.buckets)).cast("int")

    def table(self, spark: SparkSession, name: str, wanted: list[int] | None = None) -> DataFrame:
        """One of the tables, or the part of it that lies in some buckets."""
        rows = spark.read.schema(_TABLES[name]).parquet(f"{self.path.rstrip('/')}/{name}")
        return (rows if wanted is None else rows.filter(F.col("bucket").isin(wanted))).drop("bucket")


def build(market: DataFrame, path: str, buckets: int = 64, files: int = 4) -> ComparablesIndex:
    """Write the index of ``market`` to a new folder, each bucket over up to ``files`` files a table."""
    spark, index = market.sparkSession, ComparablesIndex(path, buckets)

    def write(name: str, rows: DataFrame, *order: str) -> DataFrame:
        placed = rows.withColumn("bucket", index.bucket(F.col("_b")))
        # a brand with a third of the market is dealt over several files
        placed = placed.withColumn("_file", F.pmod(F.hash(*(order[:1] or ("_b",))), F.lit(files)))
        dealt = placed.repartition("bucket", "_file").sortWithinPartitions("bucket", "_b", *order)
        dealt.drop("_file").write.partitionBy("bucket").parquet(f"{path}/{name}")
        return index.table(spark, name)

    year = F.col("_year").cast("int").alias("_year")
    prices = write("prices", market_index(market).select("_b", "_text", year, "price", "weight"), "_text", "price")
    names = write("names", prices.groupBy("_b", "_text", "_year").agg(F.sum("weight").alias("weight")), "_text")
    texts = names.select("_b", "_text").distinct()
    write("pieces", with_pieces(texts, "_text").select("_b", "_text", "_anchor"), "_anchor")
    write("brands", brand_medians(prices).select("_b", "_median", "_ref_year", "_size"))
    return index


def comparables(asked: DataFrame, index: ComparablesIndex) -> DataFrame:
    """Tier, size, median price and median year for distinct (``_b``, ``_m``, ``_y``)."""
    spark = asked.sparkSession
    asked = through_table(asked.filter("_b is not null"), "asked-sets")
    # at most `buckets` numbers
    wanted = sorted(row[0] for row in asked.select(index.bucket(F.col("_b"))).distinct().collect())
    names, prices = index.table(spark, "names", wanted), index.table(spark, "prices", wanted)
    brands, pieces = index.table(spark, "brands", wanted), index.table(spark, "pieces", wanted)
    needles = anchored(asked.select("_b", "_m").filter("_m is not null").distinct(), "_m")
    matches = needles.join(pieces, ["_b", "_anchor"]).filter(F.contains("_text", F.col("_m"))).select("_b", "_m", "_text")
    matches = through_table(matches, "matched-names")
    chosen = choose_sets(asked, names, matches).filter("_tier > 0")
    model, year = F.col("_m"), F.col("_y")
    keyed = chosen.select(model.alias("_asked_m"), year.alias("_asked_y"), *set_key(model, year))
    keyed = through_table(keyed, "chosen-sets")
    stats = through_table(set_medians(keyed.select(*SET).distinct(), prices, names, matches, brands), "set-medians")
    found = salted_lookup(keyed, stats, SET, spread_by="_asked_m", salts=_SALTS)
    asked_for = [F.col("_asked_m").alias("_m"), F.col("_asked_y").alias("_y")]
    return found.select("_b", *asked_for, "_tier", "_median", "_ref_year", "_size")


def value_indexed(requests: DataFrame, index: ComparablesIndex, as_of_year: int) -> DataFrame:
    """As ``valuation.value_requests``, from a stored index; only the buckets of the requests' brands are read."""
    keyed = keyed_requests(requests, as_of_year)
    found = comparables(keyed.select("_b", "_m", "_y").distinct(), index)
    return priced_requests(keyed, found, requests.columns, as_of_year)

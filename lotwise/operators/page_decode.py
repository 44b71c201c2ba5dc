"""Whole reference tables of pages, decoded to any depth.

Pages are independent rows: they are decoded where Spark has read them, without a shuffle. Within a
page the depth-first order of a walk decides what shared and cyclic entries look like, which
joins over (page, position) cannot express without walking every path; so the walk itself is a
small Python function over Arrow batches (``functions.page_tables``). What is read from the listing
afterwards stays in the JVM.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lotwise.functions import page_tables
from lotwise.operators.pages import SCRIPT, extract_details

_ADDED = "decoded string, listing string, position int"

# executors need no copy of the package
cloudpickle.register_pickle_by_value(page_tables)
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def script_text(html: Column) -> Column:
    """The page's table as JSON text, null when there is none."""
    return F.nullif(F.regexp_extract(html, SCRIPT, 1), F.lit(""))


def decode_pages(pages: DataFrame, keep: Sequence[str] = ("listing_id",), whole: bool = True) -> DataFrame:
    """``keep`` and, as VARIANT, ``decoded`` (the table, if ``whole``) and ``listing``, and its ``position``.

    The listing is the object with specs, title and price that a depth-first walk from the first entry
    meets first; ``position`` is its place in the table (null if it stands inside another entry). All are null on a page
    without a table or with one that cannot be read; a page whose references write out to more
    than ``page_tables.MOST_NODES`` values keeps its position only.
    """
    source = pages.select(*keep, script_text(F.col("html")).alias("_table"))
    names = [*keep, *StructType.fromDDL(_ADDED).fieldNames()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [page_tables.decode_text(value.as_py(), whole) for value in batch.column("_table")]
            decoded, listing, position = zip(*rows, strict=True) if rows else ((), (), ())
            added = [pa.array(decoded, pa.string()), pa.array(listing, pa.string()), pa.array(position, pa.int32())]
            yield pa.RecordBatch.from_arrays([*[batch.column(name) for name in keep], *added], names)

    schema = StructType([*source.drop("_table").schema.fields, *StructType.fromDDL(_ADDED).fields])
    done = source.mapInArrow(run, schema)
    return done.withColumns({name: F.try_parse_json(name) for name in ("decoded", "listing")})


def extract_decoded(pages: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """As ``pages.extract_details``, from the listing that ``decode_pages`` finds, which is the receipt too."""
    found = decode_pages(pages, ["listing_id", *keep], whole=False)
    return extract_details(found, keep=keep, listing="listing")

"""Benchmark passages in documents: a prefix-filtered containment join.

Each item is cut into windows of ``width`` consecutive words (an item of fewer words is one
window), and each window is a set of word shingles. Shingles are ordered by rarity, the number
of places in the documents where they occur. A window that a document contains as a whole has
all its shingles there, so one of them is prefix enough: the rarest. The documents' shingles are
joined with these prefix tokens. The token's place in the window says where the window would
begin (positional bound) and whether enough words follow (length bound); then the window's
words are compared with the document's, as words and not as hashes.

Rarity takes a pass over the documents of its own: each task counts, in its slices of the
texts, the shingles that pass a bitmap of all shingles of the items, and Spark adds the counts
up. A window with a shingle that occurs nowhere cannot occur and is left out. The second pass
keeps only places of prefix tokens, with the words around them. The bitmap has ``2 ** MAP_BITS``
bits whatever the items hold; more items let more chance places through, which the join drops.

Tokens that stand at a large share of the places are dealt over ``SALTS`` tasks. Words that are
hit are bits of 64-word blocks, which are united before the shuffle, so a long document is not
a group in one task. Documents are told apart by a row number of their own: null, repeated and
shared ids do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import bound_batches, slices, stored
from lotwise.llm.word_spans import Words

BATCH_BYTES = 2 << 20
MAP_BITS = 24
HEAVY_PARTS = 1000
SALTS = 32


class Found(NamedTuple):
    """``rows``: row, id, n_words of each document; ``spans``: row, start, length, window, items_of of each
    occurrence of a window; ``item_lists``: items_of and the sorted ids of the items with such a window."""

    rows: DataFrame
    spans: DataFrame
    item_lists: DataFrame


def windows(items: DataFrame, key: str, text: str, width: int, shingle: int) -> DataFrame:
    """(window, length, shingle, tokens, items): each distinct window once, with the ids of its items as strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", BATCH_BYTES)):
            out: list[tuple] = []
            with np.errstate(over="ignore"):
                words = Words(batch.column("text"))
                hashes = words.hashes()
                for item, (low, high) in zip(
                    batch.column("item").to_pylist(), zip(words.first, words.first[1:], strict=False), strict=True
                ):
                    for start in range(low, max(high - width, low) + 1) if high > low else ():
                        stop = min(start + width, high)
                        size = min(shingle, stop - start)
                        _, tokens = _whole(words, hashes[start:stop], size)
                        text = words.text(start, stop).decode("utf-8", "replace")
                        out.append((item, text, int(stop - start), size, tokens))
            names = ("item", "window", "length", "shingle", "tokens")
            types = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
            columns = list(zip(*out, strict=True)) if out else [[]] * len(names)
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, list(names))

    source = items.select(F.col(key).cast("string").alias("item"), F.col(text).alias("text"))
    schema = "item string, window string, length int, shingle int, tokens array<long>"
    grouped = bound_batches(source).mapInArrow(run, schema).groupBy("window", "length", "shingle")
    return grouped.agg(F.first("tokens").alias("tokens"), F.sort_array(F.collect_set("item")).alias("items"))


def _whole(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, list[int]]:
    """Shingles of one window, as signed integers."""
    alone = Words.__new__(Words)
    alone.first = np.array([0, len(hashes)])
    at, tokens = alone.runs(hashes, size)
    return at, tokens.view(np.int64).tolist()


def token_bitmap(tokens: DataFrame, token: str = "token") -> np.ndarray:
    """Bitmap with two bits for each token, as 2^(MAP_BITS - 6) words that Spark unites."""
    places = [F.col(token).bitwiseAND((1 << MAP_BITS) - 1), F.shiftrightunsigned(token, 64 - MAP_BITS)]
    spots = tokens.select(F.explode(F.array(*places)).alias("spot"))
    bit = F.expr("shiftleft(1L, cast(spot & 63 AS int))")
    united = spots.groupBy(F.shiftright("spot", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    out = np.zeros(1 << (MAP_BITS - 6), np.int64)
    for batch in united.toArrow().to_batches():
        out[batch.column("word").to_numpy()] = batch.column("bits").to_numpy()
    return out.view(np.uint64)


def _passes(bitmap: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Which tokens have both their bits in the bitmap."""

    def probe(spots: np.ndarray) -> np.ndarray:
        return (bitmap[spots >> np.uint64(6)] >> (spots & np.uint64(63))) & np.uint64(1) == 1

    first = np.flatnonzero(probe(tokens & np.uint64((1 << MAP_BITS) - 1)))
    return first[probe(tokens[first] >> np.uint64(64 - MAP_BITS))]


def _counts(docs: DataFrame, bitmap: np.ndarray, sizes: Sequence[int]) -> DataFrame:
    """(token, places): in how many places of the documents a shingle occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", BATCH_BYTES)):
            with np.errstate(over="ignore"):
                words = Words(batch.column("text"))
                hashes = words.hashes()
                found = [words.runs(hashes, size)[1] for size in sizes]
            found = np.concatenate([tokens[_passes(bitmap, tokens)] for tokens in found])
            tokens, places = np.unique(found, return_counts=True)
            arrays = [pa.array(tokens.view(np.int64)), pa.array(places.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, ["token", "places"])

    counted = docs.select("text").mapInArrow(run, "token long, places long")
    return counted.groupBy("token").agg(F.sum("places").alias("places"))


def _places(docs: DataFrame, bitmap: np.ndarray, sizes: Sequence[int], width: int) -> DataFrame:
    """(id, n_words, hits) of each document; a hit is a token, its place and the words around it."""
    kind = docs.schema["id"].dataType.simpleString()
    hit = pa.struct([("token", pa.int64()), ("at", pa.int64()), ("left", pa.int32()), ("near", pa.string())])

    def hits(words: Words) -> Iterator[tuple[int, int, int, int, bytes]]:
        """(text, token, place in the text, words kept before it, words around it), by place."""
        hashes = words.hashes()
        text_of = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
        packed, places = None, None
        for size in sizes:
            at, tokens = words.runs(hashes, size)
            chosen = _passes(bitmap, tokens)
            if len(chosen) and packed is None:
                packed, places = words.compact()
            for word, token in zip(at[chosen].tolist(), tokens[chosen].view(np.int64).tolist(), strict=True):
                owner = int(text_of[word])
                start, stop = int(words.first[owner]), int(words.first[owner + 1])
                low, high = max(start, word - (width - size)), min(stop, word + width)
                near = packed[places[low] : places[high] - 1].tobytes()
                yield owner, token, word - start, word - low, near

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, "text", BATCH_BYTES)):
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            with np.errstate(over="ignore"):
                words = Words(batch.column("text"))
                for owner, token, at, left, near in hits(words):
                    near = near.decode("utf-8", "replace")
                    found[owner].append({"token": token, "at": at, "left": left, "near": near})
            numbers = pa.array(np.diff(words.first).astype(np.int64))
            arrays = [batch.column("id"), numbers, pa.array(found, pa.list_(hit))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n_words", "hits"])

    schema = f"id {kind}, n_words long, hits array<struct<token: long, at: long, left: int, near: string>>"
    return docs.select("id", "text").mapInArrow(run, schema)


def find(
    docs: DataFrame, items: DataFrame, key: str, text: str, item_key: str, item_text: str, width: int = 10, shingle: int = 5
) -> Found:
    """All occurrences of the items' windows in the documents.

    Upper-case A-Z count as lower case; words are runs of digits, letters and characters beyond
    ASCII. A null or empty text has no words and no windows. Each row of ``docs`` is a document of its
    own, whatever its id; repeated items and ids count once, and windows of an item without an id
    are found but listed under no item. No rows, no items: no spans. Other columns are ignored.
    """
    docs = bound_batches(docs.select(F.col(key).alias("id"), F.col(text).alias("text")))
    wanted = stored(windows(items, item_key, item_text, width, shingle), "benchmark-windows")
    sizes = sorted(row.shingle for row in wanted.select("shingle").distinct().collect())  # at most `shingle` rows
    if not sizes:
        sizes = [shingle]
    counts = _counts(docs, token_bitmap(wanted.select(F.explode("tokens").alias("token"))), sizes)
    each = wanted.select("*", F.posexplode("tokens").alias("offset", "token")).drop("tokens")
    rarest = F.min(F.struct("places", "token", "offset")).alias("rarest")
    # the inner join and the count drop windows with a shingle that no document has
    prefix = each.join(counts, "token").groupBy("window", "length", "shingle", "items").agg(rarest, F.count("*").alias("n"))
    prefix = prefix.where(F.col("n") == F.col("length") - F.col("shingle") + 1)
    lists = F.sha2(F.to_json("items"), 256).alias("items_of")
    prefix = stored(prefix.select("window", "length", "items", lists, "rarest.*"), "benchmark-prefixes")

    found = _places(docs, token_bitmap(prefix.select("token")), sizes, width)
    found = stored(found.withColumn("row", F.monotonically_increasing_id()), "benchmark-places")
    keys = prefix.groupBy("token").agg(F.first("places").alias("places"))
    total = keys.agg(F.coalesce(F.sum("places"), F.lit(0)).alias("all")).first()["all"]  # one number
    # fewer than HEAVY_PARTS tokens can have more than this share of all places
    heavy = keys.where(F.col("places") * HEAVY_PARTS > total).select("token", F.lit(SALTS).alias("salts"))
    salts = F.coalesce("salts", F.lit(1))
    left = found.select("row", F.explode("hits").alias("hit")).select("row", "hit.*")
    left = left.join(F.broadcast(heavy), "token", "left").withColumn("salt", F.pmod(F.hash("row", "at"), salts)).drop("salts")
    right = prefix.join(F.broadcast(heavy), "token", "left")
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    met = left.join(right.select("token", "salt", "offset", "window", "length", "items_of"), ["token", "salt"])
    begin = F.col("left") - F.col("offset")
    words = F.array_join(F.slice(F.split("near", " "), begin + 1, F.col("length")), " ")
    spans = met.where((begin >= 0) & (words == F.col("window")))
    spans = spans.select("row", (F.col("at") - F.col("offset")).alias("start"), "length", "window", "items_of")
    return Found(
        found.select("row", "id", "n_words"),
        stored(spans, "benchmark-spans"),
        prefix.select("items_of", "items").dropDuplicates(["items_of"]),
    )


def _bits(start: Column, length: Column, block: Column) -> Column:
    """Bits of a 64-word block that a span covers."""
    low = F.greatest(start - block * 64, F.lit(0)).cast("int")
    high = F.least(start + length - block * 64, F.lit(64)).cast("int")
    ones = F.lit(-1).cast("long")
    return F.call_function("shiftleft", ones, low).bitwiseAND(F.call_function("shiftrightunsigned", ones, 64 - high))


def contamination(found: Found) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated): one row for each document.

    ``n_hit`` words lie inside an occurrence of a window; ``items_sha256`` digests the ids of the items
    found, sorted as strings and joined by commas (of nothing, where none is found).
    """
    spans = found.spans.select("row", "start", "length", "items_of")
    blocks = F.sequence(F.floor(F.col("start") / 64), F.floor((F.col("start") + F.col("length") - 1) / 64))
    hit = spans.select("row", "start", "length", F.explode(blocks).alias("block")).distinct()
    bits = F.bit_or(_bits(F.col("start"), F.col("length"), F.col("block")))
    hit = hit.groupBy("row", "block").agg(bits.alias("bits")).groupBy("row").agg(F.sum(F.bit_count("bits")).alias("n_hit"))
    # documents with the same lists of items share one digest; only distinct lists are put together
    kinds = spans.groupBy("row").agg(F.sort_array(F.collect_set("items_of")).alias("kinds"))
    each = kinds.select("kinds").distinct().withColumn("items_of", F.explode("kinds")).join(found.item_lists, "items_of")
    names = F.sort_array(F.array_distinct(F.flatten(F.collect_list("items"))))
    digests = each.groupBy("kinds").agg(names.alias("names"))
    digests = digests.select(
        "kinds", F.size("names").cast("long").alias("n_items"), F.sha2(F.array_join("names", ","), 256).alias("digest")
    )
    marks = hit.join(kinds, "row").join(digests, "kinds").drop("kinds")
    return found.rows.join(marks, "row", "left").select(
        "id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )

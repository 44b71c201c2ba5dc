"""Compression of vectors to codes of their parts, with Orchard's search for the nearest entry.

Vectors become whole numbers, floor(scale * x), and are cut into equal consecutive parts, each
with a codebook of its own. For every entry of a codebook a list holds all its entries by rising
distance from it. A search starts at some entry c and goes down c's list: each entry that is not
yet marked as visited is compared, and a nearer one (or an equally near one of lower index)
takes over, with its own list from the start. Entries farther from c than twice the distance of
the vector to c cannot be nearer, by the triangle inequality, so the search stops there. All
vectors and parts of a batch take their steps side by side.

Distances are exact: 64-bit integers where no square can overflow, Python integers otherwise. Each
round is one pass over a written table. Tasks add up the parts of each entry themselves and send
one row for each entry and component; sums travel as 24-bit digits, so they cannot overflow
however many or large the components are. The driver holds the codebooks only, whose size is set
by the parameters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import stored
from lotwise.operators.joins import salted_lookup

BATCH_ROWS = 4096
DIGIT_BITS = 24
MOST_LONG = (1 << 63) - 1


def whole(values: np.ndarray) -> np.ndarray:
    """Floored values as integers: int64 where squares of differences fit, Python integers otherwise."""
    floored = np.floor(values)
    if np.abs(floored).max(initial=0.0) < float(1 << 27):
        return floored.astype(np.int64)
    return np.array([int(value) for value in floored.ravel().tolist()], object).reshape(floored.shape)


def digits(value: int) -> list[int]:
    """An integer as digits of 24 bits, the lowest first; the last one has the sign."""
    out = []
    while abs(value) >= 1 << DIGIT_BITS:
        out.append(value & ((1 << DIGIT_BITS) - 1))
        value >>= DIGIT_BITS
    return [*out, value]


class Codebooks:
    """Entries of each part, ``entries[part, entry, position]``, with the distances and lists that searches need."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        difference = entries[:, :, None, :] - entries[:, None, :, :]
        gaps = (difference * difference).sum(3)
        if gaps.dtype == object:
            ranks = [[sorted(range(len(row)), key=lambda i, row=row: (row[i], i)) for row in part] for part in gaps]
            self.lists = np.array(ranks, np.int64).reshape(gaps.shape)
        else:
            self.lists = np.argsort(gaps, axis=2, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.lists, axis=2)
        self.compared = 0

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and squared distance of each part of ``vectors[row, part, position]``."""
        rows, parts, _ = vectors.shape
        many = self.entries.shape[1]
        points = vectors.reshape(rows * parts, -1)
        part = np.tile(np.arange(parts), rows)
        entry = np.zeros(rows * parts, np.int64)
        apart = points - self.entries[part, entry]
        distance = (apart * apart).sum(1)
        visited = np.zeros((rows * parts, many), bool)
        visited[:, 0] = True
        self.compared += len(points)
        place = np.zeros(rows * parts, np.int64)
        active = np.arange(rows * parts)
        while len(active):
            own, at, spot = part[active], entry[active], place[active]
            going = (self.gaps[own, at, spot] <= 4 * distance[active]).astype(bool)
            active, own, at, spot = active[going], own[going], at[going], spot[going]
            other = self.lists[own, at, spot]
            place[active] += 1
            fresh = ~visited[active, other]
            lanes, own, other = active[fresh], own[fresh], other[fresh]
            visited[lanes, other] = True
            self.compared += len(lanes)
            apart = points[lanes] - self.entries[own, other]
            new, old = (apart * apart).sum(1), distance[lanes]
            better = ((new < old) | ((new == old) & (other < entry[lanes]))).astype(bool)
            lanes = lanes[better]
            entry[lanes], distance[lanes], place[lanes] = other[better], new[better], 0
            active = active[place[active] < many]
        return entry.reshape(rows, parts), distance.reshape(rows, parts)


def usable(vectors: DataFrame, key: str, vector: str, *others: str) -> DataFrame:
    """(id, v array<double>, others): rows whose vector holds finite numbers only, and at least one."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    rows = vectors.select(
        F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"), *[F.col(name) for name in others]
    )
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", finite))


def _matrix(batch: pa.RecordBatch, scale: float, parts: int) -> np.ndarray:
    flat = batch.column("v").flatten().to_numpy()
    return whole(flat * scale).reshape(batch.num_rows, parts, -1)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined or cut to ``BATCH_ROWS`` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(start, BATCH_ROWS)


def _sums(rows: DataFrame, entries: np.ndarray, scale: float) -> DataFrame:
    """(part, entry, position, digit, n): the sum of the parts of each entry, by digits; position -1 counts them."""
    parts, many, length = entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = Codebooks(entries)
        total = np.zeros((parts, many, length + 1), object)
        for batch in _batches(batches):
            vectors = _matrix(batch, scale, parts)
            found, _ = books.nearest(vectors)
            spot = (found + np.arange(parts) * many).ravel()
            for position in range(length + 1):
                values = vectors[:, :, position].ravel() if position < length else np.ones(spot.size, np.int64)
                partial = np.zeros(parts * many, values.dtype)
                np.add.at(partial, spot, values)
                total[:, :, position] += partial.reshape(parts, many).astype(object)
        out = []
        for part, entry in zip(*np.nonzero(total[:, :, length]), strict=True):
            for position, value in enumerate(total[part, entry].tolist()):
                at = -1 if position == length else position
                out += [(part, entry, at, digit, n) for digit, n in enumerate(digits(value))]
        names = ("part", "entry", "position", "digit", "n")
        columns = list(zip(*out, strict=True)) if out else [[]] * len(names)
        arrays = [pa.array([int(x) for x in c], pa.int64()) for c in columns]
        yield pa.RecordBatch.from_arrays(arrays, list(names))

    sums = rows.select("v").mapInArrow(run, "part long, entry long, position long, digit long, n long")
    return sums.groupBy("part", "entry", "position", "digit").agg(F.sum("n").alias("n"))


def _updated(entries: np.ndarray, sums: DataFrame) -> np.ndarray:
    """Entries replaced by the floored means of their parts; unused entries stay.

    The driver gets some numbers for each component of the codebooks, whatever the number of vectors.
    """
    length = entries.shape[2]
    total: dict[tuple[int, int, int], int] = {}
    for row in sums.collect():
        spot = (row.part, row.entry, length if row.position < 0 else row.position)
        total[spot] = total.get(spot, 0) + (row.n << (DIGIT_BITS * row.digit))
    new = entries.astype(object)
    for part, entry, position in total:
        if position < length:
            new[part, entry, position] = total[part, entry, position] // total[part, entry, length]
    return _fitting(new)


def _fitting(entries: np.ndarray) -> np.ndarray:
    """Entries as int64 where squares of differences fit."""
    small = all(abs(value) < 1 << 27 for value in entries.ravel().tolist())
    return entries.astype(np.int64) if small else entries


def digest(entries: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, as decimal numbers joined by commas."""
    return hashlib.sha256(",".join(str(value) for value in entries.ravel().tolist()).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    key: str,
    vector: str,
    label: str,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: float = 256.0,
) -> tuple[DataFrame, np.ndarray | None]:
    """(id, code, error, label_error, codebooks_sha256) of each usable vector, and the final codebooks.

    Left out are vectors that are null, empty, or hold null or non-finite components, and those of another
    length than the first one (by id, nulls last, then by vector). That length must be a
    multiple of ``parts``. The first ``entries`` vectors start the codebooks (all, if there are fewer); repeated
    rows count as often as they occur. ``code`` has two hex digits for each part. Errors beyond
    a long are given as the largest long. Without usable vectors there are no rows and no codebooks.
    ``label_error`` adds up errors over equal labels, nulls together. Other columns are ignored.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits for each part: 1 to 256 entries")
    rows = usable(vectors.select(F.col(key).alias("_id"), F.col(vector).alias("_v"), F.col(label).alias("label")), "_id", "_v", "label")
    order = [F.asc_nulls_last("id"), F.asc("v")]
    start = rows.orderBy(*order).limit(1).select(F.size("v").alias("n")).collect()
    length = start[0].n if start else parts
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    rows = stored(rows.where(F.size("v") == length), "code-vectors")
    first = [row.v for row in rows.select("v", "id").orderBy(*order).limit(entries).collect()]  # at most `entries` rows
    kind = rows.schema["id"].dataType.simpleString()
    of = rows.schema["label"].dataType.simpleString()
    schema = f"id {kind}, label {of}, code string, error long"
    if not first:
        none = rows.select("id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return none.select("*", F.col("error").alias("label_error"), F.lit("").alias("codebooks_sha256")), None
    books = whole(np.array(first) * scale).reshape(len(first), parts, -1).transpose(1, 0, 2)
    books = _fitting(np.ascontiguousarray(books).astype(object))
    for _ in range(rounds):
        books = _updated(books, _sums(rows, books, scale))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = Codebooks(books)
        for batch in _batches(batches):
            found, away = last.nearest(_matrix(batch, scale, parts))
            codes = [row.tobytes().hex() for row in found.astype(np.uint8)]
            errors = [min(int(error), MOST_LONG) for error in away.astype(object).sum(1)]
            arrays = [batch.column("id"), batch.column("label"), pa.array(codes), pa.array(errors, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "label", "code", "error"])

    coded = stored(rows.select("id", "label", "v").mapInArrow(run, schema), "codes")
    known = [F.col("label").isNull().alias("_none"), F.coalesce("label", F.lit(0).cast(of)).alias("_label")]
    coded = coded.select("id", "code", "error", *known, F.monotonically_increasing_id().alias("_row"))
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(MOST_LONG).cast("decimal(38,0)"))
    errors = coded.groupBy("_none", "_label").agg(total.cast("long").alias("label_error"))
    done = salted_lookup(coded, errors, ["_none", "_label"], "_row")
    done = done.select("id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
    return done, books

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lotwise.session import scratch_dir


LARGE_GROUP = 1 << 20


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Whether a row is kept out of training; a null id is never trained on."""
    fold = F.crc32(doc_id.cast("string").cast("binary")) % modulus
    return F.coalesce(fold == remainder, F.lit(True))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: computed once, no lineage."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sort_joined(df: DataFrame) -> DataFrame:
    """One side of a join that rounds repeat: joined by sorting.

    It would be broadcast otherwise, and the driver would hold every round's copies until they
    are collected.
    """
    return df.hint("merge")


def extended(df: DataFrame, ddl: str) -> StructType:
    """Schema of ``df`` followed by more columns."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])


def bound_batches(df: DataFrame, rows: int = 1024) -> DataFrame:
    """Let tasks get at most ``rows`` rows at once from now on in this session.

    Rows hold whole texts; Spark's own limit of 10,000 rows could be gigabytes of them.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= rows:
        conf.set(name, str(rows))
    return df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(column: pa.Array) -> list[str]:
    """Texts of an Arrow column; null is the empty text."""
    return ["" if value is None else value for value in column.to_pylist()]


def word_lists(column: pa.Array) -> pa.ListArray:
    """ASCII-lower-cased runs of ``[^\\x20\\x09-\\x0D]`` of each text; null has none."""
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    filled = pa.concat_arrays([filled, filled.slice(0, 0)])  # ascii_lower needs offsets that start at 0
    parts = pc.ascii_split_whitespace(pc.ascii_lower(filled))
    flat = parts.flatten()
    full = pc.not_equal(flat, "")
    if pc.all(full).as_py() in (True, None):
        return parts
    offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    before = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return pa.LargeListArray.from_arrays(pa.array(before[offsets]), flat.filter(full))


def slices(batch: pa.RecordBatch, column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most_bytes`` of text each; a single row is never cut."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def gathered(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches joined, or cut, to about ``most_bytes`` of text and at most ``rows`` rows."""
    kept: list[pa.RecordBatch] = []
    size = count = 0
    for batch in batches:
        for part in slices(batch, column, most_bytes):
            for start in range(0, part.num_rows, rows):
                piece = part.slice(start, rows)
                length = pc.sum(pc.binary_length(piece.column(column))).as_py() or 0
                if kept and (size + length > most_bytes or count + piece.num_rows > rows):
                    yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
                    kept, size, count = [], 0, 0
                kept.append(piece)
                size, count = size + length, count + piece.num_rows
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]


def _give_back() -> None:
    """Return freed memory to the system, as workers live on between tasks with all they have ever held."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)


Batches = Iterator[pa.RecordBatch]


def giving_back(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``; the memory it has freed is returned at the end of the task."""

    def whole(batches: Batches) -> Batches:
        yield from run(batches)
        _give_back()

    return whole


def giving_back_group(run: Callable[[tuple, pa.Table], pa.Table]) -> Callable[[tuple, pa.Table], pa.Table]:
    """``run`` for ``applyInArrow``; the memory it has freed is returned after each group of some size."""

    def whole(key: tuple, group: pa.Table) -> pa.Table:
        large = group.nbytes > LARGE_GROUP
        found = run(key, group)
        del group
        if large:
            _give_back()
        return found

    return whole


def segments(keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(key, start, stop) of the runs of a sorted array."""
    cuts = np.flatnonzero(np.diff(keys)) + 1
    starts, stops = np.append(0, cuts), np.append(cuts, len(keys))
    for start, stop in zip(starts.tolist(), stops.tolist(), strict=True):
        if stop > start:
            yield int(keys[start]), start, stop


def squeezed(data: bytes) -> bytes:
    """Compressed, after its length; messages are written, shuffled and read more than once."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True) if data else b""


def expanded(cell: bytes) -> bytes:
    size = int.from_bytes(cell[:8], "little")
    return pa.decompress(cell[8:], size, codec="zstd", asbytes=True) if size else b""


def mix64(values: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser: well-spread 64-bit hashes of 64-bit integers."""
    z = values.astype(np.uint64, copy=True)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def string_hashes(values: pa.Array, seed: int = 0) -> np.ndarray:
    """64-bit hashes of texts, the same on every machine."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    raw = values.cast(pa.large_binary()).to_pylist()
    return np.fromiter((digest(value, seed) for value in raw), np.uint64, len(raw))

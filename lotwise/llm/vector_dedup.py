"""Near-duplicate vectors: random-hyperplane sign hashing, exact cosines, connected components.

Vectors with equal bytes are collapsed to one representative first, so that any number of
exact copies costs one row. Representatives meet in the buckets of several hash tables.
A bucket is cut into blocks, and block pairs are compared as matrices: a task holds two
blocks however large the bucket is, and returns link counts and a spanning forest, not the
pairs. A pair that meets in several tables is counted in the first of them.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import extended, sort_joined, stored
from lotwise.llm.components import components

BLOCK = 1024
SEED = 20_240_229


def table_shape(rows: int, cosine: float, recall: float) -> tuple[int, int]:
    """Bits per code and number of tables.

    Bits grow with the number of vectors, which keeps buckets of unrelated vectors at about
    64; tables follow from the recall wanted for a pair at exactly ``cosine``.
    """
    bits = min(30, max(6, math.ceil(math.log2(max(rows, 1) / 64 + 1))))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(1 - recall) / math.log1p(-meet)))


def _prepared(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, digest, v): digest is null for vectors that link with nothing."""
    source = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = []
            for row in batch.column("v"):
                numbers = None
                if row.is_valid and len(row.values) and row.values.null_count == 0:
                    numbers = row.values.to_numpy(zero_copy_only=False) + 0.0
                    if not np.isfinite(numbers).all() or not numbers.any():
                        numbers = None
                digests.append(None if numbers is None else hashlib.blake2b(numbers, digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())], ["id", "v", "digest"])

    return source.mapInArrow(run, extended(source, "digest binary"))


def _hashed(reps: DataFrame, bits: int, tables: int) -> DataFrame:
    """Add ``dim`` and ``codes``, one code for each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            codes, dims = [], []
            for row in batch.column("v"):
                numbers = row.values.to_numpy(zero_copy_only=False)
                dim = len(numbers)
                if dim not in planes:
                    planes[dim] = np.random.default_rng(SEED + dim).standard_normal((tables * bits, dim))
                signs = (planes[dim] @ (numbers / np.abs(numbers).max()) > 0).reshape(tables, bits)
                codes.append((signs @ weights).astype(np.int32))
                dims.append(dim)
            flat = np.concatenate(codes) if codes else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1) * tables, pa.int32()), pa.array(flat))
            arrays = [*batch.columns, pa.array(dims, pa.int32()), lists]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, "dim", "codes"])

    return reps.mapInArrow(run, extended(reps, "dim int, codes array<int>"))


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, root) of a spanning forest of a symmetric boolean matrix."""
    root = np.full(len(linked), -1)
    for node in range(len(linked)):
        if root[node] >= 0 or not linked[node].any():
            continue
        root[node], queue = node, [node]
        while queue:
            fresh = np.flatnonzero(linked[queue.pop()] & (root < 0))
            root[fresh] = node
            queue.extend(fresh.tolist())
    child = np.flatnonzero((root >= 0) & (root != np.arange(len(root))))
    return child, root[child]


def _compare(cosine: float):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        table, low, high = key[0].as_py(), key[3].as_py(), key[4].as_py()
        n = group.num_rows
        rows = group.column("v").combine_chunks().flatten().to_numpy().reshape(n, -1)
        rows = rows / np.abs(rows).max(1, keepdims=True)
        unit = rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
        codes = group.column("codes").combine_chunks().flatten().to_numpy().reshape(n, -1)
        block = group.column("block").to_numpy()
        ids, copies = group.column("rep").to_numpy(), group.column("copies").to_numpy()
        linked = unit @ unit.T >= cosine
        np.fill_diagonal(linked, False)
        if low != high:  # pairs within one block belong to that block's own task
            linked &= block[:, None] != block[None, :]
        a, b = np.nonzero(np.triu(linked, 1))
        first = (codes[a, :table] == codes[b, :table]).any(1) if table else np.zeros(len(a), bool)
        linked[a[first], b[first]] = linked[b[first], a[first]] = False
        child, root = forest(linked)
        links = linked @ copies
        own = np.flatnonzero(links)
        none = pa.nulls(len(own), pa.int64())
        return pa.table(
            {
                "rep": pa.array(np.concatenate([ids[own], ids[child]]), pa.int64()),
                "other": pa.chunked_array([none, pa.array(ids[root], pa.int64())]),
                "links": pa.array(np.concatenate([links[own], np.zeros(len(child))]).astype(np.int64)),
            }
        )

    return run


def near_duplicates(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.9, recall: float = 0.9995
) -> DataFrame:
    """(id, n_links, component_id, kept), one row for each input row.

    ``n_links`` counts the other rows found with at least ``cosine``, ``component_id`` is the
    smallest id reachable by links and ``kept`` marks the rows that carry it. Links come from
    pairs that share a bucket, verified in double precision; a pair at exactly ``cosine`` is
    found with probability ``recall``, a closer one with a higher probability, equal vectors
    always. Vectors that are null, empty, zero, or hold null or non-finite components link
    with nothing, and vectors of different lengths do not link. Vectors that share their
    smallest id are one node, whose links are added; a row with a null id is kept out of the links.
    """
    rows = stored(_prepared(vectors, key, vector), "vectors")
    usable = rows.where(F.col("digest").isNotNull() & F.col("id").isNotNull())
    reps = usable.groupBy("digest").agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v")
    )
    bits, tables = table_shape(usable.count(), cosine, recall)
    reps = stored(_hashed(reps, bits, tables), "representatives")
    met = reps.select("rep", "copies", "v", "codes", "dim", F.posexplode("codes").alias("place", "code"))
    sizes = met.groupBy("place", "dim", "code").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = sizes.select(F.col("place").alias("p"), F.col("dim").alias("d"), F.col("code").alias("c"), "size")
    # sizes, links and classes grow with the vectors, and Spark sizes them by compressed files: none is broadcast
    bucket = (F.col("place") == F.col("p")) & (F.col("dim") == F.col("d")) & (F.col("code") == F.col("c"))
    met = met.join(sort_joined(sizes), bucket)
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    met = met.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
    met = met.withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
    met = met.withColumn("low", F.least("block", "with")).withColumn("high", F.greatest("block", "with"))
    found = stored(
        met.select("place", "dim", "code", "low", "high", "rep", "copies", "v", "codes", "block")
        .groupBy("place", "dim", "code", "low", "high")
        .applyInArrow(_compare(cosine), "rep long, other long, links long"),
        "links",
    )
    near = found.groupBy("rep").agg(F.sum("links").alias("near"))
    roots = components(found.where("other is not null").select("rep", "other"))
    classes = (
        reps.select("digest", "rep", "copies")
        .join(sort_joined(near), "rep", "left")
        .join(sort_joined(roots.withColumnRenamed("node", "rep")), "rep", "left")
        .select(
            "digest",
            (F.coalesce("near", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    usable_digest = F.when(F.col("id").isNotNull(), F.col("digest"))
    return (
        rows.select("id", usable_digest.alias("digest"))
        .join(sort_joined(classes), "digest", "left")
        .select(
            "id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
    )

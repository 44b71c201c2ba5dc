"""Resampling of documents towards a target, by hashed n-gram features.

Features are the runs of one to ``longest`` words. Separators collapse to single spaces, and one
pattern for each length, held to word boundaries by look-arounds, is scanned over the bytes with
overlapping matches: each match is the span of a feature, whose CRC-32 modulo ``buckets`` is counted.
A bucket's gain is the floored log ratio of its smoothed shares in the target and in all
documents; a document's weight is the sum of the gains of its features, and Gumbel noise drawn
from a digest of its id turns the best weights into a sample without replacement.

Texts are scanned once: a table keeps the bucket numbers of each document (two bytes for each
feature, four beyond 65,536 buckets), which the counts and the weights are then read from. The
driver gets one count for each bucket. Ranks over all documents come from a partitioning by
ranges, whose sizes (one number for each partition) say where each partition's ranks begin.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from operator import itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import bound_batches, shuffle_partitions, slices, stored

BATCH_BYTES = 4 << 20
SEPARATORS = rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def feature_pattern(words: int) -> regex.Pattern:
    """Runs of ``words`` words in a text whose words are parted by single spaces."""
    return regex.compile(rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % (words - 1))


def _code(buckets: int) -> type:
    return np.uint16 if buckets <= 1 << 16 else np.uint32


def features(docs: DataFrame, key: str, text: str, longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """(id, n_words, n_features, codes): the buckets of all features, repeats included, as packed integers.

    Only A-Z are lower-cased. A null or empty text has no words and no features; each row of
    ``docs`` gives one row. Other columns are ignored.
    """
    source = bound_batches(docs.select(F.col(key).alias("id"), F.col(text).alias("text")))
    kind = source.schema["id"].dataType.simpleString()
    code = _code(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        separators = regex.compile(SEPARATORS)
        patterns = [feature_pattern(words) for words in range(1, longest + 1)]
        span = itemgetter(0)
        for batch in (part for whole in batches for part in slices(whole, "text", BATCH_BYTES)):
            words, counts, codes = [], [], []
            for value in batch.column("text"):
                raw = value.as_py()
                plain = separators.sub(b" ", raw.encode("utf-8").lower()).strip(b" ") if raw else b""
                found = [
                    np.fromiter(map(crc32, map(span, pattern.finditer(plain, overlapped=True))), np.uint32)
                    for pattern in patterns
                ]
                words.append(len(found[0]))
                counts.append(sum(map(len, found)))
                codes.append((np.concatenate(found) % np.uint32(buckets)).astype(code).tobytes())
            numbers = [pa.array(words, pa.int64()), pa.array(counts, pa.int64()), pa.array(codes, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *numbers], ["id", "n_words", "n_features", "codes"]
            )

    return source.mapInArrow(run, f"id {kind}, n_words long, n_features long, codes binary")


def bucket_counts(found: DataFrame, buckets: int) -> np.ndarray:
    """How many features of all documents lie in each bucket; tasks send one row for each bucket they met."""
    code = _code(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column("codes"):
                total += np.bincount(np.frombuffer(packed.as_buffer(), code), minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["bucket", "n"])

    parts = found.select("codes").mapInArrow(run, "bucket long, n long")
    counts = np.zeros(buckets, np.int64)
    for batch in parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow().to_batches():
        counts[batch.column("bucket").to_numpy()] = batch.column("n").to_numpy()
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln ratio) of each bucket's share in the target to that in the source, add-one smoothed."""
    many = len(source)
    all_source, all_target = float(source.sum()) + many, float(target.sum()) + many
    ratios = [(t + 1.0) * all_source / ((s + 1.0) * all_target) for s, t in zip(source.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000.0 * math.log(ratio)) for ratio in ratios], np.int64)


def noise(seed: str, key: object) -> int:
    """Gumbel noise of a key, floored to thousandths; a null key counts as the empty text."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return math.floor(-1000.0 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296.0)))


def scores(found: DataFrame, gain: np.ndarray, seed: str) -> DataFrame:
    """``found`` with weight and score instead of codes."""
    code, kind = _code(len(gain)), found.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = np.array(
                [gain[np.frombuffer(packed.as_buffer(), code)].sum() for packed in batch.column("codes")], np.int64
            )
            extra = np.array([noise(seed, key) for key in batch.column("id").to_pylist()], np.int64)
            kept = [batch.column(name) for name in ("id", "n_words", "n_features")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(weights), pa.array(weights + extra)],
                ["id", "n_words", "n_features", "weight", "score"],
            )

    return found.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long, score long")


def ranked(rows: DataFrame, percent: int) -> DataFrame:
    """(row, rank) of the best floor(percent * N / 100) of N rows by score, then id, then row; nulls last.

    No task gets more than a range of the order, and equal rows are parted by their row number.
    """
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    ranges = rows.select("row", "id", "score").repartitionByRange(shuffle_partitions(rows.sparkSession), *order)
    ranges = stored(ranges.withColumn("part", F.spark_partition_id()), "importance-ranges")
    sizes = ranges.groupBy("part").agg(F.count("*").alias("n"), F.max("score").alias("top"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))  # one row a partition
    placed = ranges.join(F.broadcast(sizes), "part")
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    placed = placed.select("row", (F.col("before") + within).alias("rank"))
    drawn = ranges.count() * percent // 100
    return placed.where(F.col("rank") <= drawn)


def resample(
    docs: DataFrame,
    target: DataFrame,
    key: str,
    text: str,
    target_text: str,
    longest: int = 1,
    buckets: int = 10_000,
    seed: str = "2024",
    least_words: int = 20,
    percent: int = 10,
) -> DataFrame:
    """(id, n_features, weight, score, rank): every document, with a rank where it is drawn.

    Of the N documents with at least ``least_words`` words the floor(percent * N / 100) highest
    scores are drawn; ties go to the smaller id, nulls last. Each row of ``docs`` is a document of its own,
    also where ids or whole rows repeat. An empty ``target`` or empty ``docs`` has no features; gains
    then come from the smoothing alone.
    """
    found = stored(features(docs, key, text, longest, buckets), "importance-features")
    wanted = features(target.select(F.col(target_text).alias("text"), F.lit(0).alias("id")), "id", "text", longest, buckets)
    gain = gains(bucket_counts(found, buckets), bucket_counts(wanted, buckets))
    scored = scores(found, gain, seed).withColumn("row", F.monotonically_increasing_id())
    scored = stored(scored, "importance-scores")
    drawn = ranked(scored.where(F.col("n_words") >= least_words), percent)
    columns = ("id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))
    return scored.join(drawn, "row", "left").select(*columns)

"""Bigram language model in sharded Elias-Fano tries, learned and applied to whole texts.

    p(w | h) = max(c(h w) - D, 0) / c(h) + D * distinct(h) / c(h) * p1(w)
    p1(w)    = (c(w) + 0.1) / (N + 0.1 * (V + 1))

Occurrences (h, w, document) are dealt to shards by their context h. A shard counts its
training bigrams, builds their trie and looks up all its occurrences, so a model of any size
fits: no table of words or bigrams is sent to every task. A context with a large share of
the tokens is dealt over several shards by a hash of w. There are at most 4 * shards such
contexts; their distinct(h) is counted over all parts first and holds in each part, so scores
do not depend on the number of shards.

p1 of a frequent word comes from a list of at most ``FREQUENT`` words, those with at least
1/FREQUENT of the tokens each. The occurrences of other words travel once more, to the shard
of w, with the two quantised numbers that their probability is made of.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import (
    bound_batches,
    expanded,
    gathered,
    giving_back,
    giving_back_group,
    mix64,
    segments,
    shuffle_partitions,
    squeezed,
    stored,
    string_hashes,
    word_lists,
)
from lotwise.llm.elias_fano import Trie, quantise, restore

FREQUENT = (1 << 20) - 1
SLICE_BYTES = 5 << 20
SLICE_ROWS = 65_535
STEPS = 8  # a shard's contexts are worked off in so many steps
SHARD_TOKENS = 2_000_000
WAITING = 500_000  # words of several slices that a task counts together
SENT_ROWS = 1 << 16
MOST_PARTS = 1 << 24
WORD_BITS = 42  # of a word's hash, in the numbers that distinct successors are counted by
DISCOUNT = 0.75
END = xxhash.xxh64_intdigest(b"", 0)  # words are never empty
BEGIN = xxhash.xxh64_intdigest(b"", 1)
MESSAGE = "kind int, shard int, a binary, b binary, c binary, d binary, e binary"
NAMES = [part.split()[0] for part in MESSAGE.split(", ")]
SCORES, RARE, ROWS, COUNTS = 0, 1, 2, 3


@dataclass(frozen=True)
class Tokens:
    """Tokens of several texts, each closed by the end token."""

    hashes: np.ndarray  # distinct words, then end and begin
    word: np.ndarray  # place in hashes
    context: np.ndarray
    doc: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> Tokens:
        lists = word_lists(column)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        coded = lists.flatten().dictionary_encode()
        known = len(coded.dictionary)
        hashes = np.append(string_hashes(coded.dictionary), np.array([END, BEGIN], np.uint64))
        sizes = np.diff(offsets)
        doc = np.repeat(np.arange(len(sizes)), sizes + 1)
        word = np.full(len(doc), known, np.int64)
        word[np.arange(offsets[-1]) + np.repeat(np.arange(len(sizes)), sizes)] = coded.indices.to_numpy()
        context = np.empty(len(doc), np.int64)
        context[1:] = word[:-1]
        context[offsets[:-1] + np.arange(len(sizes))] = known + 1
        return cls(hashes, word, context, doc)


def _source(docs: DataFrame, key: str, text: str, held: Column) -> DataFrame:
    return bound_batches(docs).select(
        F.col(key).alias("id"),
        F.col(text).cast("string").alias("text"),
        held.alias("held"),
        F.monotonically_increasing_id().alias("row"),
    )


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unigrams(source: DataFrame) -> DataFrame:
    """(hash, n) of the training tokens, the end token among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0

        def flush() -> Iterator[pa.RecordBatch]:
            hashes, counts = (np.concatenate(part) for part in zip(*kept, strict=True))
            kept.clear()
            order = np.argsort(hashes)
            hashes, counts = hashes[order], counts[order]
            starts = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
            hashes, counts = hashes[starts].view(np.int64), np.add.reduceat(counts, starts)
            # small batches, as the JVM holds each whole beside its heap
            for at in range(0, len(hashes), SENT_ROWS):
                own = slice(at, at + SENT_ROWS)
                yield pa.RecordBatch.from_arrays([pa.array(hashes[own]), pa.array(counts[own])], ["hash", "n"])

        for batch in gathered(batches, "text", SLICE_BYTES, SLICE_ROWS):
            tokens = Tokens.of(batch.column("text"))
            counts = np.bincount(tokens.word, minlength=len(tokens.hashes))
            kept.append((tokens.hashes[counts > 0], counts[counts > 0]))
            waiting += int((counts > 0).sum())
            if waiting > WAITING:
                yield from flush()
                waiting = 0
        if kept:
            yield from flush()

    train = source.where(~F.col("held")).select("text")
    return train.mapInArrow(giving_back(run), "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Vocabulary:
    """Totals, frequent words, and the contexts that are dealt in parts with their distinct successors."""

    tokens: int
    distinct: int
    documents: int
    hashes: np.ndarray
    counts: np.ndarray
    shards: int
    split: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    kinds: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def whole(self) -> float:
        return self.tokens + 0.1 * (self.distinct + 1)

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.1) / self.whole

    def frequent(self, hashes: np.ndarray) -> np.ndarray:
        """Place among the frequent words, or FREQUENT for any other word."""
        if len(self.hashes) == 0:
            return np.full(len(hashes), FREQUENT)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, at, FREQUENT)

    def context_counts(self, hashes: np.ndarray) -> np.ndarray:
        """Count of each frequent context and of the beginning; 0 for any other."""
        counts = np.append(self.counts, 0)[np.minimum(self.frequent(hashes), len(self.counts))]
        return np.where(hashes == np.uint64(BEGIN), self.documents, counts)

    def parts(self, hashes: np.ndarray) -> np.ndarray:
        """Into how many parts (a power of two) each context is dealt."""
        share = self.context_counts(hashes) * (4.0 * self.shards / max(self.tokens, 1))
        return np.minimum(2 ** np.ceil(np.log2(np.maximum(share, 1.0))).astype(np.int64), MOST_PARTS)

    def dealt(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each context is dealt in parts."""
        if len(self.split) == 0:
            return np.zeros(len(hashes), bool)
        return self.split[np.minimum(np.searchsorted(self.split, hashes), len(self.split) - 1)] == hashes

    def split_kinds(self, hashes: np.ndarray) -> np.ndarray:
        """Number of distinct successors of contexts that are dealt in parts; 0 for any other."""
        if len(self.split) == 0:
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.split, hashes), len(self.split) - 1)
        return np.where(self.split[at] == hashes, self.kinds[at], 0)


def _vocabulary(unigrams: DataFrame, documents: int, partitions: int) -> Vocabulary:
    total, distinct = unigrams.agg(F.sum("n"), F.count(F.lit(1))).first()
    total = int(total or 0)
    shards = max(partitions, total // SHARD_TOKENS + 1)
    # fewer than FREQUENT by their shares, 16 bytes each
    frequent = unigrams.where(F.col("n") * FREQUENT > total).select("hash", "n").toArrow()
    hashes = frequent.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    counts = frequent.column("n").to_numpy()[order]
    return Vocabulary(total, int(distinct), documents, hashes[order], counts, shards)


def _successors(vocabulary: Vocabulary, split: np.ndarray, source: DataFrame) -> DataFrame:
    """Messages (shard, codes) of the distinct successors that a task met of each context of ``split``.

    A code is the context's place and the low bits of the word's hash. A context's codes are dealt over as many
    shards as it has parts; a code is always sent to the same shard.
    """
    parts = vocabulary.parts(split)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        waiting = 0
        for batch in gathered(batches, "text", SLICE_BYTES, SLICE_ROWS):
            tokens = Tokens.of(batch.column("text"))
            at = np.minimum(np.searchsorted(split, tokens.hashes), len(split) - 1)
            own = (split[at] == tokens.hashes)[tokens.context]
            low = tokens.hashes[tokens.word[own]] & np.uint64((1 << WORD_BITS) - 1)
            kept.append(np.unique(at[tokens.context[own]].astype(np.uint64) << np.uint64(WORD_BITS) | low))
            waiting += len(kept[-1])
            if waiting > 2_000_000:
                yield deal(np.unique(np.concatenate(kept)))
                kept, waiting = [], 0
        if waiting:
            yield deal(np.unique(np.concatenate(kept)))

    def deal(codes: np.ndarray) -> pa.RecordBatch:
        place = (codes >> np.uint64(WORD_BITS)).astype(np.int64)
        part = (codes >> np.uint64(24)).astype(np.int64) & (np.minimum(parts[place], 1 << WORD_BITS - 24) - 1)
        with np.errstate(over="ignore"):
            mixed = mix64(split[place] + part.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        shard = (mixed % np.uint64(vocabulary.shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cells = [
            (number, squeezed(np.diff(codes[order[a:b]], prepend=np.uint64(0)).tobytes()))
            for number, a, b in segments(shard[order])
        ]
        numbers, packed = zip(*cells, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(packed, pa.binary())], ["shard", "codes"])

    return source.where(~F.col("held")).select("text").mapInArrow(giving_back(run), "shard int, codes binary")


def _with_kinds(vocabulary: Vocabulary, source: DataFrame) -> Vocabulary:
    """The vocabulary with the distinct successors of each context that is dealt in parts.

    Each successor is counted once, in the one shard it is sent to. Only the counts of the contexts, at most
    4 * shards, are collected.
    """
    contexts = np.append(vocabulary.hashes, np.uint64(BEGIN))
    split = np.unique(contexts[vocabulary.parts(contexts) > 1])
    if len(split) == 0:
        return vocabulary

    def count(table: pa.Table) -> pa.Table:
        codes = [np.cumsum(np.frombuffer(expanded(cell), np.uint64)) for cell in table.column("codes").to_pylist()]
        places, times = np.unique(np.unique(np.concatenate(codes)) >> np.uint64(WORD_BITS), return_counts=True)
        return pa.table({"place": places.astype(np.int32), "n": times.astype(np.int64)})

    counts = _successors(vocabulary, split, source).groupBy("shard").applyInArrow(count, "place int, n long")
    counted = counts.groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    kinds = np.zeros(len(split), np.int64)
    kinds[counted.column("place").to_numpy()] = counted.column("n").to_numpy()
    return replace(vocabulary, split=split, kinds=kinds)


def _pack_places(places: np.ndarray) -> np.ndarray:
    """Three bytes for each place among the frequent words."""
    return np.ascontiguousarray(places.astype(np.uint32).view(np.uint8).reshape(-1, 4)[:, :3])


def _unpack_places(packed: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(packed) // 3, 4), np.uint8)
    wide[:, :3] = packed.reshape(-1, 3)
    return wide.view(np.uint32).ravel().astype(np.int64)


def _message(kind: int, shard: int, *columns: np.ndarray) -> tuple:
    filled = [squeezed(c.tobytes()) for c in columns]
    return (kind, shard, *filled, *[b""] * (5 - len(filled)))


def _batch(messages: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
    columns = list(zip(*messages, strict=True)) if messages else [[] for _ in NAMES]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], NAMES)


def _occurrences(source: DataFrame, vocabulary: Vocabulary, row_shards: int) -> DataFrame:
    """Messages to the shards of contexts, and one for the rows of each slice.

    Kind ROWS: a row numbers, b document tokens, c known frequent tokens, d their base sums,
    e ids and folds.
    Otherwise: a contexts with the number of their bigrams, b frequent words, c other words,
    d number of occurrences and training occurrences, e first row of the slice and place in it
    of each occurrence.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in gathered(batches, "text", SLICE_BYTES, SLICE_ROWS):
                yield _batch(list(deal(batch)))

    def deal(batch: pa.RecordBatch) -> Iterator[tuple]:
        tokens = Tokens.of(batch.column("text"))
        rows = batch.column("row").to_numpy()
        held = batch.column("held").to_numpy(zero_copy_only=False)
        size = batch.num_rows
        place = vocabulary.frequent(tokens.hashes)
        is_frequent = place < FREQUENT
        counts = np.append(vocabulary.counts, 0)[np.minimum(place, len(vocabulary.counts))]
        base = np.where(is_frequent, np.log10(counts + 0.1), 0.0)
        row_shard = (mix64(rows) % np.uint64(row_shards)).astype(np.int64)
        sums = (
            np.bincount(tokens.doc, minlength=size),
            np.bincount(tokens.doc, is_frequent[tokens.word], size).astype(np.int64),
            np.bincount(tokens.doc, base[tokens.word], size),
        )
        order = np.argsort(row_shard, kind="stable")
        for shard, start, stop in segments(row_shard[order]):
            own = order[start:stop]
            names = batch.select(["id", "held"]).take(pa.array(own))
            yield (*_message(ROWS, shard, rows[own], *(column[own] for column in sums))[:6], squeezed(_packed(names)))
        # (shard, context, word) in one number: places fit 21 bits, as a slice has fewer words
        parts = vocabulary.parts(tokens.hashes)[tokens.context]
        part = (tokens.hashes[tokens.word] >> np.uint64(40)).astype(np.int64) & (parts - 1)
        mixed = mix64(tokens.hashes[tokens.context] + part.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        shard = (mixed % np.uint64(vocabulary.shards)).astype(np.int64)
        wide = max(1, int(len(tokens.hashes)).bit_length())
        key = (shard << (2 * wide)) | (tokens.context << wide) | tokens.word
        order = np.argsort(key, kind="stable")
        key, doc = key[order], tokens.doc[order]
        fresh = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
        starts = np.flatnonzero(fresh)
        times = np.diff(np.append(starts, len(key)))
        pair = key[starts]
        mask = (1 << wide) - 1
        word, context = pair & mask, (pair >> wide) & mask
        trained = np.add.reduceat(~held[doc], starts, dtype=np.int64) if len(starts) else starts
        for number, a, b in segments(pair >> (2 * wide)):
            begin, end = starts[a], starts[b - 1] + times[b - 1]
            new = np.flatnonzero(np.append(True, np.diff(context[a:b]) != 0))
            own, listed = word[a:b], place[word[a:b]]
            yield _message(
                SCORES,
                number,
                np.stack([tokens.hashes[context[a:b][new]].view(np.int64), np.diff(np.append(new, b - a))]),
                _pack_places(listed),
                tokens.hashes[own[listed == FREQUENT]],
                np.stack([times[a:b], trained[a:b]]).astype(np.uint32),
                np.append(rows[:1].view(np.uint16), doc[begin:end].astype(np.uint16)),
            )

    return source.mapInArrow(giving_back(run), MESSAGE)


def _sum_rows(rows: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    own, place = np.unique(rows, return_inverse=True)
    return own, *(np.bincount(place, value, len(own)) for value in values)


def _by_row_shard(kind: int, row_shards: int, rows: np.ndarray, *values: np.ndarray) -> Iterator[tuple]:
    """Messages to the shards of sorted rows; rows are sent as differences."""
    shard = (mix64(rows) % np.uint64(row_shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    for number, a, b in segments(shard[order]):
        own = order[a:b]
        yield _message(kind, number, np.diff(rows[own], prepend=0), *(value[own] for value in values))


def _rows_of(table: pa.Table) -> np.ndarray:
    parts = [np.cumsum(np.frombuffer(expanded(a), np.int64)) for a in table.column("a").to_pylist()]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _column(table: pa.Table, name: str, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(map(expanded, table.column(name).to_pylist())), dtype)


def _look_up(
    vocabulary: Vocabulary, discount: float, context: np.ndarray, word: np.ndarray, trained: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Discounted probability and back-off weight of each entry, from the trie of all of them."""
    # one context's parts are separate contexts
    part = np.zeros(len(context), np.int64)
    in_parts = np.flatnonzero(vocabulary.dealt(context))
    part[in_parts] = (word[in_parts] >> np.uint64(40)).astype(np.int64) & (vocabulary.parts(context[in_parts]) - 1)
    level, owner = np.unique(context ^ mix64(part.astype(np.uint64)), return_inverse=True)
    del part, in_parts
    low = word & np.uint64(0xFFFFFFFF)
    pair, place = np.unique(owner.astype(np.uint64) << np.uint64(32) | low, return_inverse=True)
    count = np.bincount(place, trained, len(pair))
    of = (pair >> np.uint64(32)).astype(np.int64)
    first = np.zeros(len(level), np.int64)
    first[owner] = np.arange(len(owner))
    own = np.bincount(of, count, len(level))
    dealt = vocabulary.dealt(context[first])
    whole = np.where(dealt, vocabulary.context_counts(context[first]), own)
    seen = count > 0
    kinds = np.bincount(of[seen], minlength=len(level))
    kinds = np.where(dealt, vocabulary.split_kinds(context[first]), kinds)
    # an unknown context leaves the unigram
    backoff = np.where(whole > 0, discount * kinds / np.maximum(whole, 1), 1.0)
    trie = Trie.build(
        level,
        of[seen],
        (pair[seen] & np.uint64(0xFFFFFFFF)).astype(np.uint32),
        (count[seen] - discount) / whole[of[seen]],
        backoff,
    ).mapped()
    chance, weight = trie.find(of, pair & np.uint64(0xFFFFFFFF))
    return chance[place], weight[place]


def _score_shard(vocabulary: Vocabulary, row_shards: int, discount: float):
    """Build the trie of one shard and look up all its occurrences."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        kind = key[1].as_py()
        if kind == ROWS:
            return table.select(NAMES)
        with np.errstate(over="ignore"):
            messages = list(answer(table))
        return pa.Table.from_batches([_batch(messages)])

    def answer(table: pa.Table) -> Iterator[tuple]:
        contexts, times, trained, rows = [], [], [], []
        for a, d, e in zip(*(table.column(c).to_pylist() for c in "ade"), strict=True):
            hashes, runs = np.frombuffer(expanded(a), np.int64).reshape(2, -1)
            contexts.append(np.repeat(hashes, runs))
            pair = np.frombuffer(expanded(d), np.uint32).reshape(2, -1)
            times.append(pair[0])
            trained.append(pair[1])
            places = np.frombuffer(expanded(e), np.uint16)
            rows.append(places[4:] + places[:4].view(np.int64)[0])
        # a shard has millions of tokens: its arrays go as soon as they have been used
        context = np.concatenate(contexts).view(np.uint64)
        del contexts
        times, trained, rows = np.concatenate(times), np.concatenate(trained), np.concatenate(rows)
        listed = _unpack_places(_column(table, "b", np.uint8))
        rare = listed == FREQUENT
        word = np.empty(len(listed), np.uint64)
        word[~rare] = vocabulary.hashes[listed[~rare]]
        word[rare] = _column(table, "c", np.uint64)
        chance, weight = np.zeros(len(word)), np.zeros(len(word))
        step = ((context >> np.uint64(32)) % np.uint64(STEPS)).astype(np.uint8)
        for number in range(STEPS):
            own = np.flatnonzero(step == number)
            if len(own):
                chance[own], weight[own] = _look_up(vocabulary, discount, context[own], word[own], trained[own])
        del context, trained, step
        plain = ~rare
        score = np.log10(chance[plain] + weight[plain] * vocabulary.unigram(vocabulary.counts[listed[plain]]))
        del listed
        sums = _sum_rows(rows[np.repeat(plain, times)], np.repeat(score, times[plain]))
        del score
        yield from _by_row_shard(SCORES, row_shards, *sums)
        del sums
        left = np.flatnonzero(rare)
        if len(left) == 0:
            return
        times = times.astype(np.int64)
        ends = np.cumsum(times)
        to = word[left].view(np.int64) % vocabulary.shards  # as pmod does
        order = left[np.argsort(to, kind="stable")]
        for number, a, b in segments(np.sort(to)):
            entry = order[a:b]
            sizes = times[entry]
            picks = np.arange(sizes.sum()) + np.repeat(ends[entry] - sizes - np.cumsum(sizes) + sizes, sizes)
            yield _message(
                RARE,
                number,
                word[entry],
                quantise(np.maximum(chance[entry], 1e-13)),
                quantise(weight[entry]),
                sizes.astype(np.uint32),
                rows[picks],
            )

    return run


def _score_rare(vocabulary: Vocabulary, row_shards: int):
    """Finish the occurrences of words that are not in the frequent list, by their counts."""

    def run(key: tuple, table: pa.Table, counts: pa.Table) -> pa.Table:
        messages: list[tuple] = []
        if table.num_rows:
            word = _column(table, "a", np.uint64)
            chance, weight = restore(_column(table, "b", np.uint16)), restore(_column(table, "c", np.uint16))
            times, rows = _column(table, "d", np.uint32).astype(np.int64), _column(table, "e", np.int64)
            hashes = counts.column("hash").to_numpy().view(np.uint64)
            order = np.argsort(hashes)
            hashes, numbers = hashes[order], np.append(counts.column("n").to_numpy()[order], 0)
            at = np.searchsorted(hashes, word)
            same = np.zeros(len(word), bool)
            inside = at < len(hashes)
            same[inside] = hashes[at[inside]] == word[inside]
            count = np.where(same, numbers[at], 0)
            chance[chance <= 1.0001e-13] = 0.0
            score = np.log10(chance + weight * vocabulary.unigram(count))
            own, scores, known, base = _sum_rows(
                rows, *(np.repeat(v, times) for v in (score, count > 0, np.log10(count + 0.1)))
            )
            with np.errstate(over="ignore"):
                messages = [
                    *_by_row_shard(SCORES, row_shards, own, scores),
                    *_by_row_shard(COUNTS, row_shards, own, known, base),
                ]
        return pa.Table.from_batches([_batch(messages)])

    return run


def _finish(key: tuple, table: pa.Table) -> pa.Table:
    """Add up the parts of each row."""
    kind = table.column("kind").to_numpy()
    base, scores, counts = (table.filter(pa.array(kind == k)) for k in (ROWS, SCORES, COUNTS))
    rows = _column(base, "a", np.int64)
    order = np.argsort(rows)
    rows = rows[order]
    score = np.bincount(np.searchsorted(rows, _rows_of(scores)), _column(scores, "b", np.float64), len(rows))
    at = np.searchsorted(rows, _rows_of(counts))
    known, sums = (np.bincount(at, _column(counts, name, np.float64), len(rows)) for name in ("b", "c"))
    names = pa.concat_tables([pa.ipc.open_stream(expanded(e)).read_all() for e in base.column("e").to_pylist()])
    columns = {
        "n_tokens": _column(base, "b", np.int64)[order],
        "n_known": (known + _column(base, "c", np.int64)[order]).astype(np.int64),
        "base": sums + _column(base, "d", np.float64)[order],
        "score": score,
    }
    names = names.take(pa.array(order))
    return pa.table({"id": names.column("id"), "held_out": names.column("held"), **columns})


def score(
    docs: DataFrame, held: Column, key: str = "doc_id", text: str = "text", discount: float = DISCOUNT
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row for each input row.

    Learns from the rows that are not ``held`` and scores all. Tokens are the ASCII-lower-cased
    words ``[^\\x20\\x09-\\x0D]+`` and one end token; a null or empty text has the end token
    alone. ``base_score`` is the unigram sum of the module's formula, ``score`` the bigram
    model's log10 probability of the text. Without training rows every token has
    probability 1. Words are 64-bit hashes; within one context, words are told apart by 32 bits.
    """
    spark = docs.sparkSession
    partitions = shuffle_partitions(spark)
    source = _source(docs, key, text, held)
    unigrams = stored(_unigrams(source), "unigrams")
    documents = unigrams.where(F.col("hash") == F.lit(int(np.uint64(END).view(np.int64)))).select("n").first()
    vocabulary = _vocabulary(unigrams, documents.n if documents else 0, partitions)
    vocabulary = _with_kinds(vocabulary, source)
    messages = _occurrences(source, vocabulary, partitions)
    group = ("shard", "kind")
    answers = stored(
        messages.groupBy(*group).applyInArrow(giving_back_group(_score_shard(vocabulary, partitions, discount)), MESSAGE), "answers"
    )
    counts = unigrams.withColumn("shard", F.pmod("hash", F.lit(vocabulary.shards)).cast("int"))
    rare = answers.where(F.col("kind") == RARE).groupBy("shard")
    finished = rare.cogroup(counts.groupBy("shard")).applyInArrow(_score_rare(vocabulary, partitions), MESSAGE)
    kind = source.schema["id"].dataType.simpleString()
    sums = (
        answers.where(F.col("kind") != RARE)
        .union(finished)
        .groupBy("shard")
        .applyInArrow(giving_back_group(_finish), f"id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double")
    )
    whole = float(np.log10(vocabulary.whole))
    return sums.select(
        "id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * whole).alias("base_score"),
        "score",
    )

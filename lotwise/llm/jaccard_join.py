"""N-gram Jaccard join by prefix filters under several global token orders.

Two sets with Jaccard similarity t or more share a token among the first
n - ceil(t n) + 1 tokens of each, under any global order of all tokens. Each order here puts
tokens that are frequent in the corpus last (by a counting sketch) and the others in the
order of a hash of their own, so chance pairs that share a few tokens meet under one order
but rarely under another. Candidates of small token groups must meet under every order; if
both stand in large groups of the second order, that counts as met. Members of the first
order's large groups (over ``SMALL_GROUP`` nodes) go to the bitmap filter without it.

Documents with equal sets are one node. Candidates then pass a bitmap filter: a bit that
one set has and the other lacks is a token that they do not share, which bounds the
intersection from above. What is left joins into candidate groups, a node's text goes to the
tasks of its group, and there blocks of sets are compared as matrices.

No task emits the pairs of a group. A prefix token that many nodes share, or several tokens that
about the same nodes share, send their bitmaps to block tasks, and these as well as the final comparison return spanning forests only, which
is all that the classes need.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import (
    bound_batches,
    expanded,
    giving_back,
    giving_back_group,
    mix64,
    segments,
    shuffle_partitions,
    slices,
    squeezed,
    stored,
    string_hashes,
    word_lists,
)
from lotwise.llm.components import components
from lotwise.llm.vector_dedup import forest

BATCH_BYTES = 4 << 20
SKETCH_BITS = 20
CHUNK_BITS = 14
SMALL_GROUP = 16
BLOCK = 512
COLUMNS = 8192
POSTINGS = 1 << 20  # of each order, dealt to their shards at once
SENT_BYTES = 4 << 20
MAP_BITS = 23
ORDERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def shingle_sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles; fewer words make one shingle."""
    words = word_lists(column)
    flat = words.flatten()
    offsets = words.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    coded = flat.dictionary_encode()
    hashes = string_hashes(coded.dictionary)[coded.indices.to_numpy()] if len(flat) else np.zeros(0, np.uint64)
    rolled = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for k in range(width):
        rolled = mix64(rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + len(rolled)])
    for start, stop in zip(offsets[:-1], offsets[1:], strict=True):
        if stop - start >= width:
            yield np.unique(rolled[start : stop - width + 1])
        elif stop > start:
            whole = np.uint64(stop - start)
            for value in hashes[start:stop]:
                whole = mix64(np.array([whole * np.uint64(0xD6E8FEB86659FD93) + value], np.uint64))[0]
            yield np.array([whole], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def _node(tokens: np.ndarray) -> int:
    """Number of a set: 64 bits of a digest of its tokens."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _nodes(column: pa.Array, width: int) -> Iterator[tuple[int | None, np.ndarray]]:
    with np.errstate(over="ignore"):
        for tokens in shingle_sets(column, width):
            yield (_node(tokens) if len(tokens) else None), tokens


def _spot(tokens: np.ndarray) -> np.ndarray:
    """Place of a token in the sketch."""
    return (tokens & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)


def bitmap(tokens: np.ndarray) -> bytes:
    """Two to four bits for each token of a set, a power of two in all."""
    bits = max(64, 1 << (2 * len(tokens) - 1).bit_length())
    flags = np.zeros(bits, np.uint8)
    flags[(tokens >> np.uint64(20)).astype(np.int64) & (bits - 1)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def _may_link(size_a, size_b, bits_a, bits_b, common, percent: int):
    """Whether sets can reach the similarity, given their bits and the bits they share."""
    least = -(-percent * (size_a + size_b) // (100 + percent))
    return (size_a - (bits_a - common) >= least) & (size_b - (bits_b - common) >= least)


def _scanned(source: DataFrame, width: int) -> DataFrame:
    """(id, size, node, bits) of each document, and rows (piece, counts) of each task's counting sketch.

    Documents with equal sets have the same node; an empty set has none. ``bits`` is the set's
    bitmap, given once for each node and task.
    """
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.uint32)
        met: set[int] = set()
        names = ["id", "size", "node", "bits", "piece", "counts"]
        of = None
        for batch in (part for whole in batches for part in slices(whole, "text", BATCH_BYTES)):
            of = batch.column("id").type
            sizes, nodes, maps = [], [], []
            for node, tokens in _nodes(batch.column("text"), width):
                sizes.append(len(tokens))
                nodes.append(node)
                maps.append(None)
                if node is not None and node not in met:
                    met.add(node)
                    np.add.at(total, _spot(tokens), 1)
                    maps[-1] = bitmap(tokens)
            rest = [pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.binary())]
            numbers = [pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())]
            arrays = [batch.column("id"), *numbers, pa.array(maps, pa.binary()), *rest]
            yield pa.RecordBatch.from_arrays(arrays, names)
        if met:
            parts = [squeezed(part.tobytes()) for part in total.reshape(-1, 1 << CHUNK_BITS)]
            empty = [pa.nulls(len(parts), kind) for kind in (of, pa.int64(), pa.int64(), pa.binary())]
            arrays = [*empty, pa.array(range(len(parts)), pa.int32()), pa.array(parts)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return source.mapInArrow(giving_back(run), f"id {kind}, size long, node long, bits binary, piece int, counts binary")


def frequency_classes(scanned: DataFrame) -> np.ndarray:
    """Class of each place of a counting sketch: 0 for up to twice the mean count, then by powers of two.

    The sketch has 2^20 counters whatever the corpus holds; partial sketches are added up in
    Spark, piece by piece, and the driver receives one number for each counter.
    """
    chunk = 1 << CHUNK_BITS

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(chunk, np.int64)
        for batch in batches:
            for counts in batch.column("counts"):
                total += np.frombuffer(expanded(counts.as_py()), np.uint32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["piece", "counts"]
        )

    counts = np.zeros(1 << SKETCH_BITS)
    parts = scanned.where("piece is not null").select("piece", "counts")
    for row in parts.groupBy("piece").applyInArrow(add, "piece int, counts binary").toLocalIterator():
        counts[row.piece * chunk : (row.piece + 1) * chunk] = np.frombuffer(row.counts, np.int64)
    return np.log2(np.maximum(counts / max(counts.mean(), 1e-9), 1.0)).astype(np.uint8)


def _postings(
    source: DataFrame, classes: np.ndarray, width: int, percent: int, orders: Sequence[int], shards: int
) -> DataFrame:
    """Messages (shard, place, token, node, size) of each set's prefix under each order, once in a task.

    A cell holds the numbers of many postings, tokens as differences. Within a shard, 32 bits
    tell tokens apart; two that agree only add candidates.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        kept: list[list[tuple[np.ndarray, int, int]]] = [[] for _ in orders]
        waiting = 0
        for batch in (part for whole in batches for part in slices(whole, "text", BATCH_BYTES)):
            for node, found in _nodes(batch.column("text"), width):
                if node is None or node in met:
                    continue
                met.add(node)
                late = classes[_spot(found)].astype(np.uint64) << np.uint64(58)
                length = len(found) - -(-percent * len(found) // 100) + 1
                for own, seed in zip(kept, orders, strict=True):
                    ranked = late | (mix64(found ^ np.uint64(seed)) >> np.uint64(6))
                    own.append((np.partition(ranked, length - 1)[:length].copy(), node, len(found)))
                waiting += length
                if waiting >= POSTINGS:
                    yield from deal(kept)
                    kept, waiting = [[] for _ in orders], 0
        if waiting:
            yield from deal(kept)

    def deal(kept: list[list[tuple[np.ndarray, int, int]]]) -> Iterator[pa.RecordBatch]:
        messages, held = [], 0
        for place, sets in enumerate(kept):
            lengths = [len(first) for first, _, _ in sets]
            token = mix64(np.concatenate([first for first, _, _ in sets]))
            key = token % np.uint64(shards) << np.uint64(32) | token >> np.uint64(32)
            order = np.argsort(key)
            key = key[order]
            node = np.repeat(np.array([node for _, node, _ in sets], np.int64), lengths)[order]
            size = np.repeat(np.array([size for _, _, size in sets], np.int32), lengths)[order]
            for shard, start, stop in segments(key >> np.uint64(32)):
                tokens = np.diff(key[start:stop] & np.uint64(0xFFFFFFFF), prepend=np.uint64(0)).astype(np.uint32)
                cells = [squeezed(x.tobytes()) for x in (tokens, node[start:stop], size[start:stop])]
                messages.append((shard, place, *cells))
                held += sum(map(len, cells))
                if held >= SENT_BYTES:  # the JVM holds each batch whole beside its heap
                    yield batch_of(messages)
                    messages, held = [], 0
        if messages:
            yield batch_of(messages)

    def batch_of(messages: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 3]
        arrays = [pa.array(c, k) for c, k in zip(zip(*messages, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["shard", "place", "token", "node", "size"])

    return source.select("text").mapInArrow(
        giving_back(run), "shard int, place int, token binary, node binary, size binary"
    )


def _meet(percent: int):
    """Pairs (kind 0) of small groups; token, node and least node (kind 1) of each member of a large one."""

    def run(key: tuple, group: pa.Table) -> pa.Table:
        cells = {name: [expanded(cell) for cell in group.column(name).to_pylist()] for name in ("token", "node", "size")}
        token = np.concatenate([np.cumsum(np.frombuffer(cell, np.uint32), dtype=np.uint32) for cell in cells["token"]])
        node, size = np.frombuffer(b"".join(cells["node"]), np.int64), np.frombuffer(b"".join(cells["size"]), np.int32)
        order = np.lexsort((node, token))
        token, node, size = token[order], node[order], size[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])  # one node may come from several tasks
        token, node, size = token[new], node[new], size[new]
        starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        counts = np.diff(np.append(starts, len(token)))
        pairs, links = [], []
        for count in np.unique(counts[(counts > 1) & (counts <= SMALL_GROUP)]):
            rows = starts[counts == count][:, None] + np.arange(count)
            a, b = np.triu_indices(count, 1)
            low, high = rows[:, a].ravel(), rows[:, b].ravel()
            near = np.minimum(size[low], size[high]) * 100 >= percent * np.maximum(size[low], size[high])
            pairs.append(np.stack([node[low[near]], node[high[near]]], 1))
        for start, count in zip(starts[counts > SMALL_GROUP], counts[counts > SMALL_GROUP], strict=True):
            own = node[start : start + count]
            name = key[0].as_py() << 32 | int(token[start])
            links.append(np.stack([np.full(count, name), own, np.full(count, own[0])], 1))
        near = np.unique(np.concatenate(pairs), axis=0) if pairs else np.zeros((0, 2), np.int64)
        large = np.concatenate(links) if links else np.zeros((0, 3), np.int64)
        a, b = np.append(near[:, 0], large[:, 0]), np.append(near[:, 1], large[:, 1])
        kind = np.repeat(np.array([0, 1], np.int32), [len(near), len(large)])
        place = np.full(len(kind), key[1].as_py(), np.int32)
        least = pa.array(np.append(np.zeros(len(near), np.int64), large[:, 2]), mask=kind == 0)
        return pa.table({"place": place, "kind": kind, "a": a, "b": b, "least": least})

    return run


def _met(postings: DataFrame, percent: int, orders: int) -> tuple[DataFrame, DataFrame]:
    """Pairs that meet under all orders, and members (token, node, least) of the first order's large groups.

    A pair counts as met under an order if it shares a token of a small group, or if both
    nodes stand in large groups of that order.
    """
    schema = "place int, kind int, a long, b long, least long"
    met = stored(postings.groupBy("shard", "place").applyInArrow(giving_back_group(_meet(percent)), schema), "met")
    members = met.where("kind = 1")
    pairs = met.where("kind = 0 and place = 0").select("a", "b").distinct()
    for place in range(1, orders):
        other = met.where((F.col("kind") == 0) & (F.col("place") == place)).select("a", "b").distinct()
        large = members.where(F.col("place") == place).select("b").distinct()
        pairs = (
            pairs.join(other.withColumn("met", F.lit(True)), ["a", "b"], "left")
            .join(large.select(F.col("b").alias("a"), F.lit(True).alias("hot_a")), "a", "left")
            .join(large.select("b", F.lit(True).alias("hot_b")), "b", "left")
            .where(F.col("met") | (F.col("hot_a") & F.col("hot_b")))
            .select("a", "b")
        )
    first = members.where("place = 0")
    return pairs, first.select(F.col("a").alias("token"), F.col("b").alias("node"), "least")


def _merged_groups(members: DataFrame) -> DataFrame:
    """(grp, node, n): members of large groups and the size of their group, groups of about the same nodes as one.

    The copies of one text share most of their prefixes, so that each of them lies in dozens of groups of
    nearly the same nodes. Groups with the same least node become one if together they have at most twice the
    nodes of the largest of them. All pairs of a group stay in one group.
    """
    tokens = members.groupBy("token").agg(F.first("least").alias("least"), F.count(F.lit(1)).alias("n"))
    largest = tokens.groupBy("least").agg(F.max("n").alias("largest"))
    together = members.select("least", "node").distinct().groupBy("least").agg(F.count(F.lit(1)).alias("all"))
    joined = together.join(largest, "least").where(F.col("all") <= 2 * F.col("largest")).select("least", "all")
    group = F.when(F.col("all").isNull(), F.col("token")).otherwise(F.col("least")).alias("grp")
    names = tokens.join(joined, "least", "left").select("token", group, F.coalesce("all", "n").alias("n"))
    return members.select("token", "node").join(names, "token").select("grp", "node", "n").distinct()


def _filter_pairs(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """Pairs whose bitmaps allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("size_a", "size_b", "bits_a", "bits_b")
            kept = []
            for m, n, x, y in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                width = min(len(x), len(y))
                x, y = (np.bitwise_or.reduce(np.frombuffer(z, np.uint8).reshape(-1, width)) for z in (x, y))
                common = int(np.bitwise_count(x & y).sum(dtype=np.int64))
                of_x, of_y = (int(np.bitwise_count(z).sum(dtype=np.int64)) for z in (x, y))
                kept.append(_may_link(m, n, of_x, of_y, common, percent))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    def side(name: str) -> DataFrame:
        return maps.select(F.col("node").alias(name), F.col("size").alias(f"size_{name}"), F.col("bits").alias(f"bits_{name}"))

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(giving_back(run), "a long, b long")


def _filter_members(members: DataFrame, maps: DataFrame, percent: int, tasks: int) -> DataFrame:
    """Forest of the pairs of each large group whose bitmaps allow the similarity, by blocks."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        crossing = key[1].as_py() != key[2].as_py()
        rows = rows.sort_by("grp")
        group, node, size, block = (rows.column(c).to_numpy() for c in ("grp", "node", "size", "block"))
        maps = [np.frombuffer(b, np.uint8) for b in rows.column("bits").to_pylist()]
        width = np.array([len(m) for m in maps])
        cuts = np.flatnonzero(np.diff(group)) + 1
        out = []
        for start, stop in zip(np.append(0, cuts), np.append(cuts, len(group)), strict=True):
            for wide in np.unique(width[start:stop]):  # widths of sizes that can link differ by one step at most
                at = width[start:stop]
                own = start + np.flatnonzero((at == wide) | (at == 2 * wide))
                if len(own) < 2:
                    continue
                folded = [np.bitwise_or.reduce(maps[i].reshape(-1, wide)) for i in own.tolist()]
                bits = np.unpackbits(np.array(folded), axis=1).astype(np.float32)
                common, count = (bits @ bits.T).astype(np.int64), bits.sum(1).astype(np.int64)
                m = size[own]
                near = _may_link(m[:, None], m[None, :], count[:, None], count[None, :], common, percent)
                np.fill_diagonal(near, False)
                near &= (width[own] == wide)[:, None] | (width[own] == wide)[None, :]
                if crossing:
                    near &= block[own, None] != block[None, own]
                child, root = forest(near)
                out.append(np.stack([node[own][child], node[own][root]], 1))
        found = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    placed = _merged_groups(members).withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    # groups of one block share tasks, by the hash of their name
    task = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("grp"), F.lit(tasks))).otherwise(F.col("grp"))
    low, high = F.least("block", "with").alias("low"), F.greatest("block", "with").alias("high")
    placed = placed.select("grp", "node", "block", task.alias("task"), low, high)
    joined = placed.join(maps, "node").groupBy("task", "low", "high")
    return joined.applyInArrow(giving_back_group(run), "a long, b long")


def overlaps(sets: Sequence[np.ndarray]) -> np.ndarray:
    """Matrix of intersection sizes, added up over column blocks of a 0/1 matrix."""
    n = len(sets)
    total = np.zeros((n, n), np.float32)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    if len(column) == 0:
        return total
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for low in range(0, int(column[-1]) + 1, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((n, COLUMNS), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        total += part @ part.T
    return total


def _verify(width: int, percent: int):
    """Spanning forest of the links of each candidate group among the rows of a task."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        crossing = key[1].as_py() != key[2].as_py()
        node, group, block = (rows.column(c).to_numpy() for c in ("node", "grp", "block"))
        sets = list(_nodes(rows.column("text").combine_chunks(), width))
        own = np.flatnonzero([found == wanted for (found, _), wanted in zip(sets, node.tolist(), strict=True)])
        _, first = np.unique(node[own], return_index=True)  # an id may have several texts, a text several rows
        first = own[first]
        first = first[np.argsort(group[first], kind="stable")]
        node, group, block = node[first], group[first], block[first]
        tokens = [sets[i][1] for i in first.tolist()]
        size = np.array([len(t) for t in tokens], np.int64)
        cuts = np.flatnonzero(np.diff(group)) + 1
        out = []
        for start, stop in zip(np.append(0, cuts), np.append(cuts, len(group)), strict=True):
            if stop - start < 2:
                continue
            common = overlaps(tokens[start:stop]).astype(np.int64)
            own = size[start:stop]
            linked = 100 * common >= percent * (own[:, None] + own[None, :] - common)
            np.fill_diagonal(linked, False)
            if crossing:
                linked &= block[start:stop, None] != block[None, start:stop]
            child, root = forest(linked)
            out.append(np.stack([node[start:stop][child], node[start:stop][root]], 1))
        found = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return run


def _likely(source: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is in ``ids``, and few others while those are few.

    The filter is a bitmap of 2^23 bits, however many ids there are. It only keeps texts
    that cannot match out of the shuffle of the exact join that follows.
    """
    spot = F.pmod(F.xxhash64("id"), F.lit(1 << MAP_BITS)) + 1
    bits = ids.groupBy(F.bitmap_bucket_number(spot).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bits")
    )
    pieces = {row.piece: np.frombuffer(row.bits, np.uint8) for row in bits.collect()}  # 2^23 bits at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.zeros((1 << MAP_BITS) + 1, bool)
        for piece, packed in pieces.items():
            flags[(piece - 1) * 32768 + 1 : piece * 32768 + 1] = np.unpackbits(packed, bitorder="little")
        for batch in batches:
            yield batch.filter(pa.array(flags[batch.column("spot").to_numpy()])).select(["id", "text"])

    return source.withColumn("spot", spot).mapInArrow(giving_back(run), source.schema)


def jaccard_classes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 4,
    percent: int = 85,
    orders: Sequence[int] = ORDERS,
) -> DataFrame:
    """(id, n_shingles, component_id), one row for each input row.

    A document's set has the distinct ``width``-word shingles of its ASCII-lower-cased words
    ``[^\\x20\\x09-\\x0D]+``; fewer words make one shingle of all of them. Documents link when
    100 * intersection >= ``percent`` * union. A null or empty text, or one without words, has
    an empty set and links with nothing. ``component_id`` is the smallest id reachable by links,
    the own id without links. Rows that repeat an id belong to all classes their texts belong
    to, and get the smallest of them for each text; a row with a null id keeps its links, but
    null is never the smallest id of a class that has another.

    No pair is left out: prefixes are exact under every order, and every pair inside a
    candidate group is verified. Tokens are 64-bit hashes of shingles.
    """
    spark = docs.sparkSession
    source = bound_batches(docs).select(F.col(key).alias("id"), F.col(text).cast("string").alias("text"))
    scanned = stored(_scanned(source, width), "sets")
    rows = scanned.where("piece is null").select("id", "size", "node")
    classes = frequency_classes(scanned)
    # about a million prefix tokens a shard
    volume = rows.agg(F.sum("size")).first()[0] or 0
    shards = max(shuffle_partitions(spark), int(volume * (100 - percent) // 100) // 1_000_000 + 1)
    pairs, members = _met(_postings(source, classes, width, percent, orders, shards), percent, len(orders))
    # a node comes from as many tasks as hold a copy; any of its bitmaps will do
    maps = scanned.where("bits is not null").select("node", "size", "bits").dropDuplicates(["node"])
    edges = _filter_pairs(pairs, maps, percent).union(_filter_members(members, maps, percent, 8 * shards))
    groups = stored(components(edges).select("node", F.col("component").alias("grp")), "candidate-groups")
    counts = groups.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    first = rows.where("node is not null").groupBy("node").agg(F.min("id").alias("_id"))
    placed = groups.join(counts, "grp").join(first, "node")
    placed = stored(placed.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")), "placed")
    task = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("grp"), F.lit(8 * shards))).otherwise(F.col("grp"))
    placed_blocks = placed.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    wanted = _likely(source, placed.select(F.col("_id").alias("id")))
    located = wanted.join(placed_blocks, F.col("id").eqNullSafe(F.col("_id")))
    spread = located.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    links = (
        spread.select(
            "text",
            "node",
            "grp",
            "block",
            task.alias("task"),
            F.least("block", "with").alias("low"),
            F.greatest("block", "with").alias("high"),
        )
        .groupBy("task", "low", "high")
        .applyInArrow(giving_back_group(_verify(width, percent)), "a long, b long")
    )
    linked = components(links).select("node", F.col("component").alias("cls"))
    members = rows.join(linked, "node", "left")
    members = stored(members.select("id", "size", F.coalesce("cls", "node").alias("cls")), "classes")
    lowest = members.where("cls is not null").groupBy("cls").agg(F.min("id").alias("lowest"))
    return members.join(lowest, "cls", "left").select(
        "id", F.col("size").alias("n_shingles"), F.coalesce("lowest", "id").alias("component_id")
    )

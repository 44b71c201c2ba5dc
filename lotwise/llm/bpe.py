"""Byte-level BPE encoding and decoding as a monoid tree reduction.

A piece (one match of the split pattern) is halved until a part is short, each part is
encoded alone, and neighbours are joined on the way up. A join re-encodes a window around
the seam and widens it until the tokens left and right of the window provably stay: a token
sequence is the encoding of its bytes exactly if every two neighbours are, so it suffices
that the window's first and last token are compatible with the token next to them.
Decoding concatenates the token bytes, which needs no window.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lotwise.llm.common import bound_batches, extended, giving_back, slices, texts

LEAF_BYTES = 24
CACHED_PIECES = 1 << 18
BATCH_BYTES = 8 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    """Encodes byte strings by merge ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        self.pairs: dict[tuple[int, int], bool] = {}

    def merge(self, data: bytes) -> list[int]:
        """Merge the neighbours of lowest rank, leftmost first, until none is left."""
        import heapq

        ranks, size = self.ranks, len(data)
        after = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        end = list(range(1, size + 1))
        queue = [(ranks[data[i : i + 2]], i, i + 2) for i in range(size - 1) if data[i : i + 2] in ranks]
        heapq.heapify(queue)
        while queue:
            _, i, stop = heapq.heappop(queue)
            j = after[i] if end[i] else size
            if not end[i] or j >= size or end[j] != stop:
                continue
            end[i], end[j] = stop, 0
            after[i] = after[j]
            if after[j] < size:
                before[after[j]] = i
                longer = data[i : end[after[j]]]
                if longer in ranks:
                    heapq.heappush(queue, (ranks[longer], i, end[after[j]]))
            if before[i] >= 0:
                longer = data[before[i] : stop]
                if longer in ranks:
                    heapq.heappush(queue, (ranks[longer], before[i], stop))
        found, i = [], 0
        while i < size:
            found.append(ranks[data[i : end[i]]])
            i = after[i]
        return found

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens are the encoding of their joined bytes."""
        pair = (left, right)
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= CACHED_PIECES:
                self.pairs.clear()
            known = self.merge(self.token_bytes[left] + self.token_bytes[right]) == [left, right]
            self.pairs[pair] = known
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of the bytes of ``left`` followed by those of ``right``."""
        if not left or not right or self.compatible(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = left[-i:] + right[:j]
            middle = self.merge(b"".join(map(self.token_bytes.__getitem__, window)))
            left_holds = i == len(left) or self.compatible(left[-i - 1], middle[0])
            right_holds = j == len(right) or self.compatible(middle[-1], right[j])
            if left_holds and right_holds:
                return left[:-i] + middle + right[j:]
            i = i if left_holds else min(2 * i, len(left))
            j = j if right_holds else min(2 * j, len(right))

    def reduce(self, piece: bytes) -> list[int]:
        if len(piece) <= LEAF_BYTES:
            return self.merge(piece)
        half = len(piece) // 2
        return self.join(self.reduce(piece[:half]), self.reduce(piece[half:]))

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        return self.reduce(piece) if whole is None else [whole]


class _Pieces(dict):
    """Packed token ids of the pieces met so far.

    When it is full, the pieces become the older ones, and those before them are forgotten. A
    piece that is met again comes back from the older ones, so frequent pieces are encoded once.
    """

    def __init__(self, encoder: Encoder):
        super().__init__()
        self.encoder = encoder
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHED_PIECES:
            self.older = dict(self)
            self.clear()
        found = self.older.get(piece)
        if found is None:
            found = array("i", self.encoder.encode(piece.encode())).tobytes()
        self[piece] = found
        return found


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids array<int>``: the token ids of each whole text.

    A null or empty text has no ids. Columns other than ``text`` pass unchanged, except one
    named ``ids``, which is replaced. Text travels through no shuffle; a task keeps at most
    twice ``CACHED_PIECES`` encoded pieces.
    """
    docs = bound_batches(docs)
    kept = [c for c in docs.columns if c != ids]
    schema = extended(docs.select(*kept), f"`{ids}` array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        known = _Pieces(Encoder(ranks))
        matches = regex.compile(pattern).findall
        for batch in (part for whole in batches for part in slices(whole, text, BATCH_BYTES)):
            rows = [b"".join(map(known.__getitem__, matches(value))) for value in texts(batch.column(text))]
            ends = np.cumsum([0, *map(len, rows)]) // 4
            flat = np.frombuffer(b"".join(rows), np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, ids])

    return docs.select(*kept).mapInArrow(giving_back(run), schema)


def decode(docs: DataFrame, ranks: dict[bytes, int], ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add ``decoded binary``: the joined bytes of the token ids; null ids give no bytes."""
    docs = bound_batches(docs)
    kept = [c for c in docs.columns if c != decoded]
    schema = extended(docs.select(*kept), f"`{decoded}` binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            vocabulary[rank] = token
        vocabulary = pa.array(vocabulary, pa.large_binary())
        for batch in batches:
            column = batch.column(ids)
            column = pc.if_else(column.is_null(), pa.scalar([], column.type), column) if column.null_count else column
            pieces = vocabulary.take(column.flatten())
            offsets = pa.array(column.offsets.to_numpy() - column.offsets[0].as_py(), pa.int32())
            joined = pc.binary_join(pa.ListArray.from_arrays(offsets, pieces), pa.scalar(b"", pa.large_binary()))
            arrays = [*batch.columns, joined.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names, decoded])

    return docs.select(*kept).mapInArrow(giving_back(run), schema)

"""Words of texts as spans of bytes, and hashes of runs of words, without a list of words.

A word is a maximal run of digits, lower-cased letters A-Z and characters beyond ASCII.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lotwise.llm.common import mix64

HASH_BYTES = 1 << 20
LONGEST = 1 << 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[ord("0") : ord("9") + 1] = _IN_WORD[ord("a") : ord("z") + 1] = _IN_WORD[128:] = True
with np.errstate(over="ignore"):
    _VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * _IN_WORD
    _PLACE = mix64(np.arange(1, LONGEST + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


class Words:
    """Words of a column of texts: ``data[starts[i]:ends[i]]``; text t has words ``first[t]`` to ``first[t + 1]``."""

    def __init__(self, column: pa.Array):
        filled = pc.fill_null(column.cast(pa.large_string()), "")
        edges = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
        raw = filled.buffers()[2]
        raw = np.frombuffer(raw, np.uint8)[edges[0] : edges[-1]] if raw is not None else np.zeros(0, np.uint8)
        edges = edges - edges[0]
        self.data = _LOWER[raw]
        inside = _IN_WORD[self.data]
        before, after = np.zeros_like(inside), np.zeros_like(inside)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[edges[:-1][edges[:-1] < len(inside)]] = False
        after[edges[1:][edges[1:] > 0] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, edges)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, computed for about a megabyte of text at a time."""
        out = np.empty(len(self.starts), np.uint64)
        low = 0
        while low < len(out):
            base = self.starts[low]
            high = max(low + 1, int(np.searchsorted(self.ends, base + HASH_BYTES, side="right")))
            starts = self.starts[low:high] - base
            size = self.ends[high - 1] - base
            inside = np.arange(size) - np.repeat(starts, np.diff(starts, append=size))
            values = _VALUE[self.data[base : base + size]] * _PLACE[np.minimum(inside, LONGEST - 1)]
            out[low:high] = mix64(np.add.reduceat(values, starts))
            low = high
        return out

    def runs(self, hashes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all runs of ``width`` words that lie within one text."""
        left = np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(hashes))
        at = np.flatnonzero(left >= width)
        total = np.full(len(at), width, np.uint64)
        for step in range(width):
            total = total * _STEP + hashes[at + step]
        return at, mix64(total)

    def text(self, start: int, stop: int) -> bytes:
        """Words ``start`` to ``stop``, joined by one space."""
        spans = zip(self.starts[start:stop].tolist(), self.ends[start:stop].tolist(), strict=True)
        return b" ".join(self.data[a:b].tobytes() for a, b in spans)

    def compact(self) -> tuple[np.ndarray, np.ndarray]:
        """All words, each followed by one space, and where each begins (one more at the end)."""
        lengths = self.ends - self.starts
        places = np.concatenate([[0], np.cumsum(lengths + 1)])
        keep = _IN_WORD[self.data]
        out = np.full(places[-1], ord(" "), np.uint8)
        spot = np.ones(places[-1], bool)
        spot[places[1:] - 1] = False
        out[spot] = self.data[keep]
        return out, places

"""Elias-Fano sequences and a two-level n-gram trie on top of them, searched in bulk."""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

CHUNK = 1 << 16
# place of each byte's first, second, ... bit that is set; 8 if there are fewer
SET_BITS = np.full((256, 8), 8, np.uint8)
for _byte in range(256):
    _set = [bit for bit in range(8) if _byte >> bit & 1]
    SET_BITS[_byte, : len(_set)] = _set


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """Low ``bits`` of each value, one after the other, in 64-bit words."""
    words = np.zeros((len(values) * bits + 63) // 64 + 1, np.uint64)
    if bits and len(values):
        at = np.arange(len(values), dtype=np.uint64) * np.uint64(bits)
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        values = values & np.uint64((1 << bits) - 1)
        np.bitwise_or.at(words, word, values << shift)
        over = shift + np.uint64(bits) > 64
        np.bitwise_or.at(words, word[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
    return words


def _unpack(words: np.ndarray, bits: int, index: np.ndarray) -> np.ndarray:
    if not bits:
        return np.zeros(len(index), np.uint64)
    at = index.astype(np.uint64) * np.uint64(bits)
    word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    low = words[word] >> shift
    high = np.where(shift > 0, words[word + 1] << ((np.uint64(64) - shift) & np.uint64(63)), np.uint64(0))
    return (low | high) & np.uint64((1 << bits) - 1)


class EliasFano:
    """A monotone sequence: low bits packed, high parts in unary.

    About 2 + log2(universe / length) bits a value, plus half a bit of directory a high bit.
    """

    def __init__(self, low_bits: int, size: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.low_bits, self.size = low_bits, size
        self.low, self.high, self.ones = low, high, ones

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        size = len(values)
        top = int(values[-1]) if size else 0
        bits = max(0, (top // max(size, 1)).bit_length() - 1)
        high = (values >> np.uint64(bits)).astype(np.int64)
        set_at = high + np.arange(size)
        length = (int(set_at[-1]) if size else 0) + 2
        flags = np.zeros((length + 63) // 64 * 64, np.uint8)
        flags[set_at] = 1
        words = np.packbits(flags, bitorder="little").view(np.uint64)
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.uint32)]).astype(np.uint32)
        return cls(bits, size, _pack(values, bits), words, ones)

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.low_bits, self.size], np.uint64), self.low, self.high, self.ones]

    @classmethod
    def of(cls, arrays: list[np.ndarray]) -> EliasFano:
        head, low, high, ones = arrays
        return cls(int(head[0]), int(head[1]), low, high, ones)

    def _place(self, rank: np.ndarray, before: np.ndarray, word: np.ndarray, want_one: bool) -> np.ndarray:
        """Position of the bit with ``rank`` given the count before its word."""
        octets = (self.high[word] if want_one else ~self.high[word]).view(np.uint8).reshape(-1, 8)
        through = np.cumsum(np.bitwise_count(octets), axis=1, dtype=np.uint8)
        left = (rank - before).astype(np.uint8)
        octet = np.minimum((through <= left[:, None]).sum(1), 7)
        row = np.arange(len(word))
        left -= np.where(octet > 0, through[row, octet - 1], np.uint8(0))
        return word * 64 + octet * 8 + SET_BITS[octets[row, octet], np.minimum(left, 7)]

    def _select_one(self, rank: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, rank, side="right") - 1
        return self._place(rank, self.ones[word].astype(np.int64), word, True)

    def _select_zero(self, rank: np.ndarray) -> np.ndarray:
        zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        word = np.minimum(np.searchsorted(zeros, rank, side="right") - 1, len(self.high) - 1)
        return self._place(rank, zeros[word], word, False)

    def access(self, index: np.ndarray) -> np.ndarray:
        out = np.empty(len(index), np.uint64)
        for start in range(0, len(index), CHUNK):
            part = index[start : start + CHUNK].astype(np.int64)
            high = (self._select_one(part) - part).astype(np.uint64)
            out[start : start + CHUNK] = high << np.uint64(self.low_bits) | _unpack(self.low, self.low_bits, part)
        return out

    def successor(self, low: np.ndarray, stop: np.ndarray, values: np.ndarray) -> np.ndarray:
        """First index in [low, stop) whose value is at least the wanted one; ``stop`` if there is none.

        The high part names a run of indices between two zeros of the unary part; only that
        run, cut to the given range, is searched by halving.
        """
        out = np.empty(len(values), np.int64)
        top = len(self.high) * 64 - int(self.ones[-1]) - 1  # number of the last zero
        for start in range(0, len(values), CHUNK):
            want = values[start : start + CHUNK]
            high = np.minimum(want >> np.uint64(self.low_bits), np.uint64(top)).astype(np.int64)
            begin = np.where(high > 0, self._select_zero(np.maximum(high - 1, 0)) - np.maximum(high - 1, 0), 0)
            end = self._select_zero(high) - high
            a = np.clip(begin, low[start : start + CHUNK], stop[start : start + CHUNK])
            b = np.clip(end, low[start : start + CHUNK], stop[start : start + CHUNK])
            while (active := np.flatnonzero(a < b)).size:
                middle = (a[active] + b[active]) >> 1
                less = self.access(middle) < want[active]
                a[active] = np.where(less, middle + 1, a[active])
                b[active] = np.where(less, b[active], middle)
            out[start : start + CHUNK] = a
        return out


STEP = 4000.0
TOP = 3.0


def quantise(values: np.ndarray) -> np.ndarray:
    """16-bit codes of positive numbers: steps of 1/4000 of a decade from 10^3 down to 10^-13."""
    return np.clip(np.rint((TOP - np.log10(np.maximum(values, 1e-13))) * STEP), 0, 65535).astype(np.uint16)


def restore(codes: np.ndarray) -> np.ndarray:
    return 10.0 ** (TOP - codes / STEP)


class Trie:
    """Contexts, their successors, and quantised probabilities.

    Level one has the sorted contexts, each with a quantised back-off weight and a monotone
    pointer to its first successor. Level two has the successors, made monotone by adding
    2^32 times the number of their context, with a quantised discounted probability each.
    """

    def __init__(self, contexts: np.ndarray, pointers: EliasFano, successors: EliasFano, chance, backoff):
        self.contexts, self.pointers, self.successors = contexts, pointers, successors
        self.chance, self.backoff = chance, backoff

    @classmethod
    def build(cls, contexts: np.ndarray, owner: np.ndarray, word: np.ndarray, chance, backoff) -> Trie:
        """``owner`` (number of the context) and ``word`` (32 bits) are sorted together."""
        starts = np.searchsorted(owner, np.arange(len(contexts) + 1)).astype(np.uint64)
        keys = owner.astype(np.uint64) << np.uint64(32) | word.astype(np.uint64)
        return cls(contexts, EliasFano.build(starts), EliasFano.build(keys), quantise(chance), quantise(backoff))

    def mapped(self) -> Trie:
        """The same trie with its levels in an unnamed file, mapped into memory.

        The file has no name and goes with the task, so nothing stays on the executor.
        """
        arrays = [self.contexts, self.chance, self.backoff, *self.pointers.arrays(), *self.successors.arrays()]
        file = tempfile.TemporaryFile()
        places = []
        for array in arrays:
            file.write(b"\0" * (-file.tell() % 8))
            places.append(file.tell())
            file.write(np.ascontiguousarray(array).tobytes())
        file.write(b"\0" * 8)
        file.flush()
        view = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        file.close()
        levels = [
            np.frombuffer(view, array.dtype, len(array), place) for array, place in zip(arrays, places, strict=True)
        ]
        contexts, chance, backoff = levels[:3]
        return Trie(contexts, EliasFano.of(levels[3:7]), EliasFano.of(levels[7:11]), chance, backoff)

    def find(self, owner: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probability of each word after its context, 0 if unseen; back-off weight of the context)."""
        if len(owner) > len(self.contexts):
            bounds = self.pointers.access(np.arange(len(self.contexts) + 1)).astype(np.int64)
            first, stop = bounds[owner], bounds[owner + 1]
        else:
            first, stop = (self.pointers.access(at).astype(np.int64) for at in (owner, owner + 1))
        keys = owner.astype(np.uint64) << np.uint64(32) | word.astype(np.uint64)
        at = self.successors.successor(first, stop, keys)
        found = at < stop
        found[found] = self.successors.access(at[found]) == keys[found]
        chance = np.zeros(len(owner))
        chance[found] = restore(self.chance[at[found]])
        return chance, restore(self.backoff[owner])

"""Greedy word-piece token counts with a linear longest-match automaton.

The vocabulary is a byte trie. Every node has a failure link, the node to go on from when
the next byte does not fit, and the number of pieces that leaving it pops. Both are computed
once, so a word is read byte by byte without going back and without building its pieces.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from lotwise.llm.common import bound_batches, extended, slices, texts

CACHED_WORDS = 1 << 17
BATCH_BYTES = 8 << 20


class Automaton:
    """Longest-match automaton of a set of byte strings."""

    def __init__(self, vocabulary: Iterable[bytes]):
        self.step: dict[int, int] = {}
        self.fail = [-1]
        self.popped = [0]
        entry = [False]
        for piece in vocabulary:
            if not piece:
                continue
            node = 0
            for byte in piece:
                key = node << 8 | byte
                child = self.step.get(key)
                if child is None:
                    child = self.step[key] = len(entry)
                    entry.append(False)
                node = child
            entry[node] = True
        self.fail += [-1] * (len(entry) - 1)
        self.popped += [0] * (len(entry) - 1)
        self._link(entry)

    def _link(self, entry: list[bool]) -> None:
        """Failure links and popped counts, parents before children."""
        below: list[list[tuple[int, int]]] = [[] for _ in entry]
        for key, child in self.step.items():
            below[key >> 8].append((key & 255, child))
        level = [0]
        while level:
            following = []
            for node in level:
                for byte, child in below[node]:
                    following.append(child)
                    if entry[child]:
                        self.fail[child], self.popped[child] = 0, 1
                        continue
                    count, back = self.popped[node], self.fail[node]
                    while back >= 0 and (back << 8 | byte) not in self.step:
                        count += self.popped[back]
                        back = self.fail[back]
                    if back >= 0:
                        self.fail[child] = self.step[back << 8 | byte]
                        self.popped[child] = count
            level = following

    def count(self, word: bytes) -> int | None:
        """Number of greedy longest-match pieces; None if the vocabulary cannot cover the word."""
        step, fail, popped = self.step, self.fail, self.popped
        node = total = 0
        for byte in word:
            found = step.get(node << 8 | byte)
            while found is None:
                back = fail[node]
                if back < 0:
                    return None
                total += popped[node]
                node = back
                found = step.get(node << 8 | byte)
            node = found
        while node:
            if fail[node] < 0:
                return None
            total += popped[node]
            node = fail[node]
        return total


class _Counts(dict):
    """Counts of words met so far; a word that cannot be covered is one unknown token."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        found = self.automaton.count(word.encode())
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found = 1 if found is None else found
        return found


def count_tokens(docs: DataFrame, vocabulary: Iterable[bytes], pattern: str, text: str = "text") -> DataFrame:
    """Add ``n_words`` and ``n_tokens`` (long) of each whole text to its row.

    Words are the matches of ``pattern``. A null or empty text has neither words nor tokens.
    Columns named ``n_words`` or ``n_tokens`` are replaced, others pass unchanged.
    """
    added = ("n_words", "n_tokens")
    docs = bound_batches(docs)
    kept = [c for c in docs.columns if c not in added]
    pieces = sorted(set(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        matches = regex.compile(pattern).findall
        counts = _Counts(Automaton(pieces))
        for batch in (part for whole in batches for part in slices(whole, text, BATCH_BYTES)):
            words, tokens = [], []
            for value in texts(batch.column(text)):
                found = matches(value)
                words.append(len(found))
                tokens.append(sum(map(counts.__getitem__, found)))
            arrays = [*batch.columns, pa.array(words, pa.int64()), pa.array(tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, *added])

    source = docs.select(*kept)
    return source.mapInArrow(run, extended(source, "n_words long, n_tokens long"))

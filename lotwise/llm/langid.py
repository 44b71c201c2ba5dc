"""Language spans: script ranges, character n-gram scores per word, Viterbi with a switching penalty.

Learned from labelled text: smoothed log-shares of hashed character bigrams and trigrams
for each language, and the scripts each language is written in. A word can only be in a
language that uses its script. The best path over the words of a text pays a penalty for
each change of language; runs of equal language are its spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import bound_batches, extended, giving_back, slices, texts

BUCKETS = 1 << 15
BATCH_BYTES = 1 << 20
SWITCH = 8.0
LEAST_SHARE = 1e-3
FORBIDDEN = -1e6

# First code point of each run of one script (0: any other character).
SCRIPTS = (
    (0x0000, 1),  # Latin
    (0x0370, 2),  # Greek
    (0x0400, 3),  # Cyrillic
    (0x0530, 4),  # Armenian
    (0x0590, 5),  # Hebrew
    (0x0600, 6),  # Arabic
    (0x0700, 0),
    (0x0900, 7),  # Devanagari
    (0x0980, 8),  # Bengali
    (0x0A00, 9),  # other scripts of India
    (0x0E00, 10),  # Thai
    (0x0E80, 0),
    (0x10A0, 11),  # Georgian
    (0x1100, 12),  # Hangul
    (0x1200, 13),  # Ethiopic
    (0x1380, 0),
    (0x1E00, 1),
    (0x1F00, 2),
    (0x2000, 0),
    (0x2C60, 1),
    (0x2C80, 0),
    (0x3040, 14),  # Kana
    (0x3100, 0),
    (0x3130, 12),
    (0x3190, 0),
    (0x3400, 15),  # Han
    (0xA000, 0),
    (0xAC00, 12),
    (0xD7B0, 0),
    (0xF900, 15),
    (0xFB00, 1),
    (0xFB1D, 5),
    (0xFB50, 6),
    (0xFE00, 0),
    (0xFF21, 1),
    (0xFF66, 14),
    (0xFFA0, 0),
    (0x20000, 15),
    (0x30000, 0),
)
N_SCRIPTS = 16


def letter_table() -> np.ndarray:
    """One flag per code point: whether it is a letter."""
    return np.frombuffer(bytes(chr(c).isalpha() for c in range(0x110000)), np.uint8).astype(bool)


@dataclass
class Words:
    """Words (runs of letters) of several texts: owner, place, script and n-gram buckets."""

    owner: np.ndarray
    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    grams: np.ndarray  # buckets, in order of words
    first: np.ndarray  # offset of each word's first gram; one more at the end


def split_words(values: list[str], letters: np.ndarray) -> Words:
    """``start`` and ``end`` count characters of the own text; n-grams include word borders."""
    lowered = [v if len(v) != len(v.lower()) else v.lower() for v in values]
    codes = np.frombuffer("\n".join(lowered).encode("utf-32-le", "replace"), np.uint32)
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
    offset = np.concatenate([[0], np.cumsum(sizes)])
    mask = np.zeros(len(codes) + 2, bool)
    mask[1:-1] = letters[codes]
    edge = np.flatnonzero(mask[1:] != mask[:-1])
    start, end = edge[::2], edge[1::2]
    owner = np.searchsorted(offset, start, side="right") - 1
    starts_of = np.array([s for s, _ in SCRIPTS], np.uint32)
    kinds = np.array([k for _, k in SCRIPTS], np.int8)
    script = kinds[np.searchsorted(starts_of, codes[start], side="right") - 1]
    # every position of a word and its right border gives a trigram (two before, one before, own)
    lengths = end - start
    first = np.concatenate([[0], np.cumsum(lengths + 1)])
    at = np.arange(first[-1]) - np.repeat(first[:-1] - start, lengths + 1)
    inside = np.append(np.where(mask[1:-1], codes, 0), 0).astype(np.uint32)
    a, b = inside[at], np.where(at > 0, inside[at - 1], 0)
    c = np.where((at > 1) & (b > 0), inside[at - 2], 0)
    mixed = a * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA6B) ^ c * np.uint32(0xC2B2AE35)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    grams = (mixed >> np.uint32(17)).astype(np.int32)
    return Words(owner, start - offset[owner], end - offset[owner], script, grams, first)


@dataclass(frozen=True)
class Model:
    """Log-scores (language x bucket) and allowed languages by script."""

    languages: tuple[str, ...]
    table: np.ndarray
    allowed: np.ndarray
    switch: float = SWITCH

    def word_scores(self, words: Words) -> np.ndarray:
        """Log-likelihood of each word in each language; forbidden scripts score very low."""
        if len(words.start) == 0:
            return np.zeros((0, len(self.languages)))
        scores = np.empty((len(words.start), len(self.languages)))
        for k, row in enumerate(self.table):
            total = np.concatenate([[0.0], np.cumsum(row[words.grams], dtype=np.float64)])
            scores[:, k] = np.diff(total[words.first])
        return scores + np.where(self.allowed[words.script], 0.0, FORBIDDEN)

    def path(self, scores: np.ndarray) -> np.ndarray:
        """Best language of each word of one text under the switching penalty."""
        total = scores.sum(0)
        best = int(total.argmax())
        # One language throughout is optimal if no other path gains more than its switches cost. A run of
        # another language pays for one switch, so no run may gain more than that; of a path without the best
        # language, first and last run share one.
        apart = scores - scores[:, [best]]
        gain = np.concatenate([np.zeros((1, scores.shape[1])), np.cumsum(apart, axis=0)])
        run = (gain - np.minimum.accumulate(gain, axis=0)).max()
        if run <= self.switch and gain.max() + (gain[-1] - gain).max() <= self.switch:
            return np.full(len(scores), best)
        rows = scores.tolist()
        value, back = rows[0], []
        for row in rows[1:]:
            top = max(value)
            place, floor = value.index(top), top - self.switch
            back.append([k if v >= floor else place for k, v in enumerate(value)])
            value = [(v if v >= floor else floor) + own for v, own in zip(value, row, strict=True)]
        path = [value.index(max(value))]
        for step in reversed(back):
            path.append(step[path[-1]])
        return np.array(path[::-1])


def _gram_rows(languages: list[str], docs: DataFrame, text: str, lang: str) -> DataFrame:
    """Counts of (language, bucket) and, as buckets from ``BUCKETS`` on, letters by script."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table()
        place = {name: i for i, name in enumerate(languages)}
        width = BUCKETS + N_SCRIPTS
        counts = np.zeros((len(languages), width), np.int64)
        for batch in (part for whole in batches for part in slices(whole, text, BATCH_BYTES)):
            label = np.array([place[name] for name in batch.column(lang).to_pylist()], np.int64)
            words = split_words(texts(batch.column(text)), letters)
            of = label[words.owner]
            sizes = np.diff(words.first)
            cell = np.repeat(of, sizes) * width + words.grams
            counts += np.bincount(cell, minlength=counts.size).reshape(counts.shape)
            cell = of * width + BUCKETS + words.script
            counts += np.bincount(cell, sizes - 1, counts.size).astype(np.int64).reshape(counts.shape)
        k, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(k.astype(np.int32)), pa.array(bucket.astype(np.int32)), pa.array(counts[k, bucket])],
            ["k", "bucket", "n"],
        )

    return docs.mapInArrow(giving_back(run), "k int, bucket int, n long").groupBy("k", "bucket").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learn from all rows with a text and a language.

    The driver receives the set of languages and one count per language and bucket, which
    does not grow with the documents.
    """
    labelled = bound_batches(docs).where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(text, lang)
    languages = sorted(row[0] for row in labelled.select(lang).distinct().collect())
    if not languages:
        return Model((), np.zeros((0, BUCKETS), np.float32), np.zeros((N_SCRIPTS, 0), bool))
    counts = np.zeros((len(languages), BUCKETS + N_SCRIPTS))
    table = _gram_rows(languages, labelled, text, lang).toPandas()
    counts[table.k.to_numpy(), table.bucket.to_numpy()] = table.n.to_numpy()
    grams = counts[:, :BUCKETS] + 0.5
    table = np.log(grams / grams.sum(1, keepdims=True)).astype(np.float32)
    scripts = counts[:, BUCKETS:]
    allowed = (scripts >= LEAST_SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)).T & (scripts.T > 0)
    allowed[~allowed.any(1)] = True  # a script never seen says nothing
    return Model(tuple(languages), table, allowed)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``spans``, ``lang_pred`` and ``lang_score`` to each row.

    ``spans`` has the runs of one language (start, end in characters, lang). ``lang_pred`` is
    the language with most letters in them; a tie goes to the likelier language, then to the
    smaller name. ``lang_score`` is its share of the letters. A null text, a text without a
    letter, and a model without languages give ``und``, no spans and score 0.
    """
    added = ("spans", "lang_pred", "lang_score")
    docs = bound_batches(docs)
    kept = [c for c in docs.columns if c not in added]
    schema = extended(
        docs.select(*kept),
        "spans array<struct<start:int,end:int,lang:string>>, lang_pred string, lang_score double",
    )
    of = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, names = letter_table(), model.languages
        for batch in (part for whole in batches for part in slices(whole, text, BATCH_BYTES)):
            words = split_words(texts(batch.column(text)), letters)
            scores = model.word_scores(words)
            sizes = words.end - words.start
            bounds = np.searchsorted(words.owner, np.arange(batch.num_rows + 1))
            spans, predicted, shares = [], [], []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if a == b or not names:
                    spans.append([])
                    predicted.append("und")
                    shares.append(0.0)
                    continue
                path = model.path(scores[a:b])
                mass = np.bincount(path, sizes[a:b], len(names))
                top = np.flatnonzero(mass == mass.max())
                best = int(top[scores[a:b][:, top].sum(0).argmax()])
                cut = np.flatnonzero(np.diff(path)) + 1
                begin, stop = a + np.concatenate([[0], cut]), a + np.concatenate([cut, [b - a]]) - 1
                spans.append(
                    [
                        {"start": int(words.start[i]), "end": int(words.end[j]), "lang": names[path[i - a]]}
                        for i, j in zip(begin, stop, strict=True)
                    ]
                )
                predicted.append(names[best])
                shares.append(float(mass[best] / mass.sum()))
            arrays = [*batch.columns, pa.array(spans, of), pa.array(predicted, pa.string()), pa.array(shares)]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, *added])

    return docs.select(*kept).mapInArrow(giving_back(run), schema)

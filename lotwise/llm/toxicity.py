"""Toxicity by a lexicon trie, Levenshtein automata and context windows.

The lexicon is learned from labels: words, and word beginnings, that are far more frequent
in documents marked toxic. Text words run through the product of the lexicon trie with the
Levenshtein automaton, determinised on demand: a state is the set of (trie node, errors)
that the characters read so far can reach. Most words end in the dead state after a few
characters. Each hit is looked at in its context window: hits inside quotation marks or
after a reporting word count as quotation, others as abuse. How likely each kind of hit
marks a toxic document is measured on the training documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.llm.common import bound_batches, extended, giving_back, slices, texts

# A word may begin with one character that stands for a letter.
WORD = re.compile(r"[*@$0-9]?[^\W\d_]+(?:['’*@$0-9][^\W\d_]+)*")
STAND_INS = frozenset("*@$0123456789")
BEGINNINGS = (4, 5)
WINDOW = 6
CACHED_WORDS = 1 << 17
BATCH_BYTES = 8 << 20
MOST_TERMS = 20_000
TRAINING_ROWS = 50_000

# Words that report speech, and quotation marks.
REPORTING = frozenset("said says quoted quote called calls word term wrote asked reported titled".split())
QUOTES = frozenset("\"“”„«»‘‹›")

# Kinds of hits: (exact, stem, misspelled) x (abuse, quotation), then misspelled beginnings x the same.
# These have a chance of their own, as more common words match by chance.
KINDS = 8


@dataclass(frozen=True)
class Lexicon:
    """Terms that must match a whole word, and stems that must match its beginning."""

    terms: tuple[str, ...]
    stems: tuple[str, ...] = ()


class Matcher:
    """Lazily determinised product of the lexicon trie and the Levenshtein automaton.

    One error (insertion, deletion, substitution) is allowed for terms of at least
    ``least_length`` characters; shorter terms must match exactly. The error may be in the
    first character too, unless ``first_right``.
    """

    def __init__(self, lexicon: Lexicon, least_length: int = 5, errors: int = 1, first_right: bool = True):
        self.errors = errors
        self.first_right = first_right
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[bool] = [False]
        self.fuzzy: list[bool] = [False]
        self.stems = frozenset(lexicon.stems)
        for term in lexicon.terms:
            node = 0
            for character in term:
                node = self._child(node, character)
                self.fuzzy[node] |= len(term) >= least_length
            self.ends[node] = True
        self.least_length = least_length
        self.long_ends = {self._find(t): t[0] for t in lexicon.terms if len(t) >= least_length}
        self.fuzzy[0] = bool(self.long_ends) and not first_right
        self.start = self._close({(0, 0)})
        self.steps: dict[tuple[frozenset, str], frozenset] = {}

    def _child(self, node: int, character: str) -> int:
        found = self.children[node].get(character)
        if found is None:
            found = self.children[node][character] = len(self.children)
            self.children.append({})
            self.ends.append(False)
            self.fuzzy.append(False)
        return found

    def _find(self, term: str) -> int:
        node = 0
        for character in term:
            node = self.children[node][character]
        return node

    def _close(self, states: set[tuple[int, int]]) -> frozenset:
        """Add the states that skipping lexicon characters reaches; drop dominated ones."""
        queue = list(states)
        while queue:
            node, errors = queue.pop()
            if (node or not self.first_right) and errors < self.errors:
                for child in self.children[node].values():
                    state = (child, errors + 1)
                    if self.fuzzy[child] and state not in states:
                        states.add(state)
                        queue.append(state)
        return frozenset((n, e) for n, e in states if not any((n, less) in states for less in range(e)))

    def step(self, state: frozenset, character: str) -> frozenset:
        key = (state, character)
        found = self.steps.get(key)
        if found is None:
            reached: set[tuple[int, int]] = set()
            for node, errors in state:
                child = self.children[node].get(character)
                if child is not None:
                    reached.add((child, errors))
                if (node or not self.first_right) and errors < self.errors:
                    reached.add((node, errors + 1)) if self.fuzzy[node] else None
                    for other, below in self.children[node].items():
                        if other != character and self.fuzzy[below]:
                            reached.add((below, errors + 1))
            if len(self.steps) >= CACHED_WORDS:
                self.steps.clear()
            found = self.steps[key] = self._close(reached)
        return found

    def match(self, word: str) -> int:
        """0: no hit, 1: a term, 2: a stem, 3: a misspelled term, 4: one whose first character is wrong."""
        best, state = 0, self.start
        for size, character in enumerate(word, 1):
            state = self.step(state, character)
            if not state:
                break
            if size in BEGINNINGS and word[:size] in self.stems:
                best = 2
        else:
            for node, errors in state:
                if self.ends[node] and errors == 0:
                    return 1
                if node in self.long_ends and best in (0, 4):
                    best = 3 if self.long_ends[node] == word[:1] else 4
        if best == 0 and any(word[:size] in self.stems for size in BEGINNINGS):
            best = 2
        return best


def training_texts(
    docs: DataFrame, labels: DataFrame, label: str, key: str = "doc_id", text: str = "text", most: int = TRAINING_ROWS
) -> DataFrame:
    """(text, label) of at most ``most`` labelled rows, those with the smallest hash of their key.

    The labels, whose number is bounded that way, are sent to the documents, so that no text
    is shuffled. Labels other than 0 and 1 and null keys are left out.
    """
    marks = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    marks = marks.select(F.col(key).alias("_key"), F.col(label).alias("_label"))
    marks = marks.orderBy(F.xxhash64("_key"), "_key", "_label").limit(most)
    joined = docs.select(key, text).join(F.broadcast(marks), F.col(key) == F.col("_key"))
    return joined.select(text, F.col("_label").alias(label))


def _bare(word: str) -> str:
    """The word without a stand-in before its first letter."""
    return word[1:] if word[0] in STAND_INS else word


def _word_rows(values: list[str]) -> Iterator[set[str]]:
    for value in values:
        words = {_bare(word) for word in WORD.findall(value.lower())}
        yield words | {w[:size] + "*" for w in words for size in BEGINNINGS if len(w) > size}


def learn_lexicon(
    docs: DataFrame, label: str, text: str = "text", least_docs: int = 5, least_odds: float = 3.5
) -> Lexicon:
    """Terms and stems from the rows of ``docs`` with label 0 or 1, all of them.

    A term is kept if at least ``least_docs`` toxic documents hold it and its smoothed
    log-odds are at least ``least_odds``. At most ``MOST_TERMS`` of the strongest are kept,
    which bounds the model; counts are taken over all labelled rows by Spark.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(list(counts), pa.string())]
            for i in (0, 1):
                arrays.append(pa.array([pair[i] for pair in counts.values()], pa.int64()))
            counts.clear()
            return pa.RecordBatch.from_arrays(arrays, ["term", "clean", "toxic"])

        for batch in batches:
            marks = batch.column(label).to_pylist()
            for mark, words in zip(marks, _word_rows(texts(batch.column(text))), strict=True):
                for word in words:
                    pair = counts.get(word)
                    if pair is None:
                        pair = counts[word] = [0, 0]
                    pair[mark] += 1
                if len(counts) > 4 * CACHED_WORDS:
                    yield flush()
        yield flush()

    labelled = bound_batches(docs).where(F.col(label).isin(0, 1)).select(text, label)
    sizes = {row[0]: row[1] for row in labelled.groupBy(label).count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    strongest = (
        labelled.mapInArrow(giving_back(run), "term string, clean long, toxic long")
        .groupBy("term")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where((F.col("toxic") >= least_docs) & (F.col("toxic") >= toxic / 2000) & (odds >= least_odds))
        .select("term", odds.alias("odds"))
        .orderBy(F.desc("odds"), "term")
        .limit(MOST_TERMS)
        .collect()
    )
    found = [row.term for row in strongest]
    stems = tuple(t[:-1] for t in found if t.endswith("*"))
    return Lexicon(tuple(t for t in found if not t.endswith("*")), stems)


def _kind(word: str, matcher: Matcher) -> tuple[int, int]:
    """Kind of a word, and 1 if it is found without the stand-in before it, else 0."""
    bare = _bare(word)
    kind = matcher.match(bare)
    if bare != word and kind in (0, 3, 4):  # a stand-in for the first letter, or a mark before the word
        whole = matcher.match(word)
        if whole and kind != 3:
            return whole, 0
    return kind, int(bare != word)


def _hits(value: str, matcher: Matcher, cache: dict[str, tuple[int, int]]) -> list[tuple[int, int, int, bool]]:
    """(kind 1..4, start, end, quoted) of each hit in a text."""
    known = {}
    for word in set(WORD.findall(value.lower())):
        kind = cache.get(word)
        if kind is None:
            if len(cache) >= CACHED_WORDS:
                cache.clear()
            kind = cache[word] = _kind(word, matcher)
        if kind[0]:
            known[word] = kind
    if not known:
        return []
    found = []
    for m in WORD.finditer(value):
        kind, skipped = known.get(m.group().lower(), (0, 0))
        if kind:
            start = m.start() + skipped
            found.append((kind, start, m.end(), _quoted(value, start, m.end())))
    return found


def _quoted(value: str, start: int, end: int) -> bool:
    """Whether the window around a word marks it as quotation."""
    before = value[max(0, start - 12 * WINDOW) : start]
    after = value[end : end + 12 * WINDOW]
    left, right = before.split()[-WINDOW:], after.split()[:WINDOW]
    opened = any(c in QUOTES for c in "".join(left)) or before[-1:] in QUOTES
    closed = any(c in QUOTES for c in "".join(right))
    reported = any(w.strip(".,:;!?").lower() in REPORTING for w in left)
    return (opened and closed) or reported


def hits(docs: DataFrame, lexicon: Lexicon, text: str = "text", name: str = "hits") -> DataFrame:
    """Add ``hits array<struct<kind:int,start:int,end:int,quoted:boolean>>`` for each whole text.

    Kinds: 1 a lexicon term, 2 a stem, 3 a misspelled term, 4 one whose first character is
    wrong, missing or after another. A null or empty text has none.
    """
    docs = bound_batches(docs)
    kept = [c for c in docs.columns if c != name]
    schema = extended(
        docs.select(*kept), f"`{name}` array<struct<kind:int,start:int,end:int,quoted:boolean>>"
    )
    of = pa.list_(
        pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("quoted", pa.bool_())])
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, cache = Matcher(lexicon, first_right=False), {}
        fields = ("kind", "start", "end", "quoted")
        for batch in (part for whole in batches for part in slices(whole, text, BATCH_BYTES)):
            rows = [
                [dict(zip(fields, hit, strict=True)) for hit in _hits(value, matcher, cache)]
                for value in texts(batch.column(text))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, of)], [*kept, name])

    return docs.select(*kept).mapInArrow(giving_back(run), schema)


def kind_counts(found: Column) -> list[Column]:
    """Number of hits: term, stem, misspelled; the same as quotation; misspelled beginning, and as quotation."""

    def count(kind: int, quoted: bool) -> Column:
        return F.size(F.filter(found, lambda hit: (hit["kind"] == kind) & (hit["quoted"] == quoted)))

    usual = [count(kind, quoted) for quoted in (False, True) for kind in (1, 2, 3)]
    return [*usual, count(4, False), count(4, True)]


@dataclass(frozen=True)
class Model:
    """Lexicon, and for each kind of hit the chance that it stands in a toxic document."""

    lexicon: Lexicon
    chances: tuple[float, ...] = field(default=(0.9, 0.9, 0.5, 0.3, 0.3, 0.2, 0.5, 0.2))
    floor: float = 0.01

    def score(self, found: Column) -> Column:
        """1 - (1 - floor) * product of (1 - chance) over all hits; ``floor`` without hits."""
        counts = kind_counts(found)
        miss = F.lit(float(np.log1p(-self.floor)))
        for count, chance in zip(counts, self.chances, strict=True):
            miss = miss + count * float(np.log1p(-chance))
        return F.lit(1.0) - F.exp(miss)


def fit(docs: DataFrame, label: str, text: str = "text") -> Model:
    """Learn lexicon and chances from the rows of ``docs`` with label 0 or 1.

    The chance of a kind is its smoothed share of toxic documents, over documents whose
    strongest kind it is. Quotation starts from a weaker prior than abuse. Without any
    labelled row the lexicon is empty and every text gets the floor.
    """
    lexicon = learn_lexicon(docs, label, text)
    labelled = docs.where(F.col(label).isin(0, 1)).select(text, label)
    found = hits(labelled, lexicon, text)
    strongest = F.coalesce(*[F.when(c > 0, i) for i, c in enumerate(kind_counts(F.col("hits")))], F.lit(KINDS))
    table = found.groupBy(strongest.alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label)).alias("toxic")
    )
    counts = {row.kind: (row.n, row.toxic) for row in table.collect()}
    prior = ((1.8, 2.0), (1.8, 2.0), (1.0, 2.0), (0.6, 2.0), (0.6, 2.0), (0.4, 2.0), (1.0, 2.0), (0.4, 2.0))
    chances = []
    for kind, (a, n) in enumerate(prior):
        seen, toxic = counts.get(kind, (0, 0))
        chances.append(min(0.995, (toxic + a) / (seen + n)))
    rest, missed = counts.get(KINDS, (0, 0))
    return Model(lexicon, tuple(chances), min(0.5, (missed + 0.01) / (rest + 1.0)))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``hits`` and ``score double`` (0 to 1, higher is more toxic) to each row."""
    return hits(docs, model.lexicon, text).withColumn("score", model.score(F.col("hits")))



"""Byte-level BPE and word-piece counts against other implementations."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from lotwise.llm import bpe, token_counts

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
ENCODER = bpe.Encoder(RANKS)
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={}
)
AUTOMATON = token_counts.Automaton(RANKS)
LONGEST = max(map(len, RANKS))


def encode(text):
    return [i for piece in regex.findall(public_tokenizers.PATTERN, text) for i in ENCODER.encode(piece.encode())]


def greedy(word, vocabulary, longest):
    count = at = 0
    while at < len(word):
        for size in range(min(longest, len(word) - at), 0, -1):
            if word[at : at + size] in vocabulary:
                break
        else:
            return None
        at, count = at + size, count + 1
    return count


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=120))
def test_encoding_equals_the_library(text):
    assert encode(text) == LIBRARY.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 3000, " " * 2000, "ab" * 1500, "=-" * 900, "é" * 700, "\n" * 500 + "x"])
def test_long_pieces_equal_the_library(text):
    assert encode(text) == LIBRARY.encode_ordinary(text)


def test_joins_at_every_cut():
    word = "internationalisationally".encode() * 3
    whole = ENCODER.merge(word)
    for cut in range(1, len(word)):
        assert ENCODER.join(ENCODER.merge(word[:cut]), ENCODER.merge(word[cut:])) == whole


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=60))
def test_counts_equal_greedy_matching(word):
    assert AUTOMATON.count(word) == greedy(word, RANKS, LONGEST)


def test_counts_with_gaps_in_the_vocabulary():
    random.seed(3)
    vocabulary = {bytes(random.choices(b"abc", k=random.randint(1, 5))) for _ in range(25)} | {b"a"}
    automaton = token_counts.Automaton(vocabulary)
    for _ in range(3000):
        word = bytes(random.choices(b"abc", k=random.randint(0, 14)))
        assert automaton.count(word) == greedy(word, vocabulary, 5)


def test_encode_and_decode_odd_documents(odd_documents):
    encoded = bpe.encode(odd_documents, RANKS, public_tokenizers.PATTERN)
    rows = bpe.decode(encoded, RANKS).collect()
    assert len(rows) == odd_documents.count()
    for row in rows:
        text = row.text or ""
        assert row.ids == LIBRARY.encode_ordinary(text) and bytes(row.decoded) == text.encode()
        assert row.lang is None or row.lang in ("en", "fr")


def test_count_odd_documents(odd_documents, no_documents):
    rows = token_counts.count_tokens(odd_documents, RANKS, public_tokenizers.PATTERN).collect()
    for row in rows:
        words = regex.findall(public_tokenizers.PATTERN, row.text or "")
        assert row.n_words == len(words)
        assert row.n_tokens == sum(greedy(w.encode(), RANKS, LONGEST) for w in words)
    assert token_counts.count_tokens(no_documents, RANKS, public_tokenizers.PATTERN).count() == 0
    assert bpe.encode(no_documents, RANKS, public_tokenizers.PATTERN).count() == 0


def test_unknown_words_are_one_token(spark):
    docs = spark.createDataFrame([(1, "ab ax")], "doc_id long, text string")
    row = token_counts.count_tokens(docs, [b"a", b"b", b" "], public_tokenizers.PATTERN).first()
    assert (row.n_words, row.n_tokens) == (2, 3)


def test_pieces_that_were_pushed_out_come_back(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 3)
    known = bpe._Pieces(bpe.Encoder(RANKS))
    for piece in "one two three four one five six one seven two two eight nine".split() * 3:
        assert np.frombuffer(known[piece], np.int32).tolist() == LIBRARY.encode_ordinary(piece)
        assert len(known) <= 3 and len(known.older) <= 3

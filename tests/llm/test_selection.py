"""Decontamination, importance resampling and vector codes against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from lotwise.llm import decontamination, importance, vector_codes
from lotwise.llm.word_spans import Words

ITEMS = "item_id string, text string, score int, row string, token long"


def plain_words(text):
    lowered = (text or "").translate({c: c + 32 for c in range(ord("A"), ord("Z") + 1)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("texts", [[], [None], ["", " .", None], ["A b-C", None, "ñÉ x1 ", "zz"], ["one", "two\x00three  four"]])
def test_words_of_a_column(texts):
    column = pa.array(["left out", *texts], pa.string()).slice(1)
    words = Words(column)
    found = [words.data[a:b].tobytes().decode() for a, b in zip(words.starts, words.ends, strict=True)]
    expected = [plain_words(text) for text in texts]
    assert found == sum(expected, [])
    assert words.first.tolist() == np.cumsum([0, *map(len, expected)]).tolist()
    packed, places = words.compact()
    assert packed.tobytes().decode() == "".join(word + " " for word in found) and places[-1] == len(packed)
    with np.errstate(over="ignore"):
        hashes = words.hashes()
        at, pairs = words.runs(hashes, 2)
    assert len(set(found)) == len(set(hashes.tolist())) == len(set(zip(found, hashes.tolist(), strict=True)))
    assert at.tolist() == [i for t in range(len(texts)) for i in range(words.first[t], words.first[t + 1] - 1)]
    assert len(pairs) == len(at)


def contaminated(text, items, width):
    """(n_words, n_hit, n_items, digest) by comparing every window at every place."""
    words = plain_words(text)
    hit, ids = set(), set()
    for item, item_text in items:
        whole = plain_words(item_text)
        size = min(width, len(whole))
        for window in {tuple(whole[i : i + size]) for i in range(len(whole) - size + 1)} if size else ():
            for start in range(len(words) - size + 1):
                if tuple(words[start : start + size]) == window:
                    hit |= set(range(start, start + size))
                    ids |= {item} - {None}
    return len(words), len(hit), len(ids), sha(",".join(sorted(ids)))


def planted_corpus(seed):
    """Documents over a few words, with passages of the items inside, cut, changed and repeated."""
    rng = random.Random(seed)
    vocabulary = ["a", "b", "Cc", "d1", "é", "the", "ж"]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [(str(i), prose(rng.choice([0, 1, 3, 6, 9, 25]))) for i in range(12)]
    items += [("x", items[3][1]), ("x", items[4][1]), (None, prose(8)), ("n", None), ("w", "only here"), items[5]]
    docs = [(i, prose(rng.randrange(60))) for i in range(25)]
    docs += [(100 + i, f"{prose(3)}!? {text.upper()}, {prose(4)}") for i, (_, text) in enumerate(items) if text]
    docs += [(None, docs[-1][1]), (None, None), (7, ""), (7, docs[3][1]), (7, docs[3][1]), (8, prose(3000))]
    return items, docs


@pytest.mark.parametrize(("width", "shingle", "salts"), [(6, 3, 32), (4, 4, 1), (5, 1, 3)])
def test_windows_found_equal_all_windows(spark, monkeypatch, width, shingle, salts):
    monkeypatch.setattr(decontamination, "SALTS", salts)
    monkeypatch.setattr(decontamination, "BATCH_BYTES", 2_000)
    items, docs = planted_corpus(width)
    table = spark.createDataFrame([(*item, 1, "r", 2) for item in items], ITEMS)
    texts = spark.createDataFrame([(i, t, 3, "x", 5) for i, t in docs], "doc_id long, text string, row int, hits string, token int")
    found = decontamination.find(texts.repartition(3), table, "doc_id", "text", "item_id", "text", width, shingle)
    rows = decontamination.contamination(found).collect()
    got = Counter((r.id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in rows)
    want = []
    for i, text in docs:
        expected = contaminated(text, items, width)
        want.append((i, *expected, expected[1] > 0))
    assert got == Counter(want)
    spans = found.rows.join(found.spans, "row").collect()
    by_text = {(i, n): text for i, text in docs for n in [len(plain_words(text))]}
    for r in spans:
        assert " ".join(plain_words(by_text[r.id, r.n_words])[r.start : r.start + r.length]) == r.window


def test_windows_of_odd_tables(spark, odd_documents, no_documents):
    items = spark.createDataFrame([("1", "the SAME text, twice over"), ("2", None), ("3", "")], "item_id string, text string")
    for docs in (odd_documents, no_documents):
        for table in (items, items.where("false"), items.where("text is null")):
            found = decontamination.find(docs, table, "doc_id", "text", "item_id", "text", 5, 2)
            rows = decontamination.contamination(found).collect()
            listed = [(r.item_id, r.text) for r in table.collect()]
            want = Counter((r.doc_id, *contaminated(r.text, listed, 5)) for r in docs.collect())
            assert Counter((r.id, r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in rows) == want


def test_a_bitmap_full_of_chance_hits_changes_nothing(spark, monkeypatch):
    items, docs = planted_corpus(1)
    monkeypatch.setattr(decontamination, "_passes", lambda bitmap, tokens: np.arange(len(tokens)))
    texts = spark.createDataFrame(docs, "doc_id long, text string")
    table = spark.createDataFrame([(*item, 1, "r", 2) for item in items], ITEMS)
    rows = decontamination.contamination(decontamination.find(texts, table, "doc_id", "text", "item_id", "text", 6, 3)).collect()
    assert Counter((r.id, r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in rows) == Counter(
        (i, *contaminated(text, items, 6)) for i, text in docs
    )


def runs(text, longest):
    words = plain_words(text)
    return [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def resampled(docs, target, longest, buckets, least, percent):
    def codes(text):
        return [crc32(run.encode()) % buckets for run in runs(text, longest)]

    s = Counter(code for _, text in docs for code in codes(text))
    t = Counter(code for text in target for code in codes(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)
    }
    rows = []
    for key, text in docs:
        weight = sum(gain[code] for code in codes(text))
        h = int(sha(f"2024:{'' if key is None else key}")[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(codes(text)), weight, score, len(plain_words(text))])
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = [tuple(r[:4]) for r in able[: len(able) * percent // 100]]
    return Counter(tuple(r[:4]) for r in rows), drawn


@pytest.mark.parametrize(("longest", "buckets", "least", "percent"), [(1, 97, 2, 40), (3, 70_000, 0, 100), (2, 10, 5, 0)])
def test_resampling_equals_brute_force(spark, longest, buckets, least, percent):
    items, docs = planted_corpus(longest)
    target = [text for _, text in items]
    texts = spark.createDataFrame([(i, t, 3, 4) for i, t in docs], "doc_id long, text string, score int, rank int").repartition(3)
    wanted = spark.createDataFrame([(t, 1) for t in target], "text string, id int")
    rows = importance.resample(texts, wanted, "doc_id", "text", "text", longest, buckets, "2024", least, percent).collect()
    want, drawn = resampled(docs, target, longest, buckets, least, percent)
    assert Counter((r.id, r.n_features, r.weight, r.score) for r in rows) == want
    chosen = sorted((r for r in rows if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in chosen] == list(range(1, len(drawn) + 1))
    assert [(r.id, r.n_features, r.weight, r.score) for r in chosen] == drawn


def test_resampling_of_odd_tables(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        for target in (odd_documents, no_documents):
            rows = importance.resample(docs, target, "doc_id", "text", "text", 2, 1000, "2024", 1, 50).collect()
            plain = [(r.doc_id, r.text) for r in docs.collect()]
            want, drawn = resampled(plain, [r.text for r in target.collect()], 2, 1000, 1, 50)
            assert Counter((r.id, r.n_features, r.weight, r.score) for r in rows) == want
            assert sum(r["rank"] is not None for r in rows) == len(drawn)


def test_features_are_spans_of_the_collapsed_text():
    found = [m[0] for m in importance.feature_pattern(2).finditer(b"a bb c bb", overlapped=True)]
    assert found == [b"a bb", b"bb c", b"c bb"] and not importance.feature_pattern(3).findall(b"a b")


def nearest_by_all(books, vectors):
    gaps = ((vectors[:, :, None, :].astype(object) - books[None].astype(object)) ** 2).sum(3)
    entry = np.array([[min(range(len(row)), key=lambda i, row=row: (row[i], i)) for row in part] for part in gaps])
    away = np.take_along_axis(gaps, entry[:, :, None].astype(np.int64), axis=2)[:, :, 0]
    return entry, away


@pytest.mark.parametrize("spread", [3, 40, 1 << 40])
def test_search_finds_the_nearest_entry(spread):
    rng = np.random.default_rng(spread % 97)
    books = vector_codes._fitting(rng.integers(-spread, spread + 1, (5, 32, 4)).astype(object))
    vectors = rng.integers(-spread, spread + 1, (200, 5, 4)).astype(books.dtype)
    search = vector_codes.Codebooks(books)
    entry, away = search.nearest(vectors)
    want_entry, want_away = nearest_by_all(books, vectors)
    assert (entry == want_entry).all() and (away == want_away).all()
    clusters = rng.integers(-(10**6), 10**6, (5, 32, 4))
    close = vector_codes.Codebooks(clusters)
    picked = rng.integers(0, 32, (200, 5))
    near = clusters[np.arange(5)[None], picked] + rng.integers(-3, 4, (200, 5, 4))
    assert (close.nearest(near)[0] == nearest_by_all(clusters, near)[0]).all()
    assert close.compared < 200 * 5 * 32 * 0.8


def compressed(rows, parts, entries, rounds):
    """Rows, and the digest of the codebooks, in plain Python."""

    def finite(v):
        return v and all(x is not None and math.isfinite(x) for x in v)

    rows = sorted((r for r in rows if finite(r[1])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    rows = [r for r in rows if len(r[1]) == len(rows[0][1])]
    size = len(rows[0][1]) // parts
    whole = [[[math.floor(256 * x) for x in r[1][p * size : p * size + size]] for p in range(parts)] for r in rows]
    books = [[whole[i][p] for i in range(min(entries, len(rows)))] for p in range(parts)]

    def assign():
        def gap(v, e):
            return sum((a - b) ** 2 for a, b in zip(v, e, strict=True))

        return [[min((gap(v[p], e), i) for i, e in enumerate(books[p])) for p in range(parts)] for v in whole]

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for i in range(len(books[p])):
                own = [v[p] for v, f in zip(whole, found, strict=True) if f[p][1] == i]
                if own:
                    books[p][i] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = assign()
    errors = [min(sum(d for d, _ in f), (1 << 63) - 1) for f in found]
    totals = Counter()
    for r, error in zip(rows, errors, strict=True):
        totals[r[2]] += error
    digest = sha(",".join(str(c) for p in books for e in p for c in e))
    codes = ["".join(f"{i:02x}" for _, i in f) for f in found]
    return Counter(
        (r[0], code, error, min(totals[r[2]], (1 << 63) - 1), digest) for r, code, error in zip(rows, codes, errors, strict=True)
    )


def vector_rows(seed, scale):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, scale) for _ in range(6)], rng.choice([0, 1, None])) for i in range(60)]
    rows += [rows[5], (3, rows[9][1], 1), (None, rows[2][1], None), (None, None, 0), (61, [1.0, None] * 3, 1), (62, [], 1)]
    return rows + [(63, [1.0, math.nan] * 3, 0), (64, [math.inf] * 6, 0), (65, [1.0] * 4, 0), (66, [0.0] * 6, None)]


@pytest.mark.parametrize(("scale", "entries", "rounds"), [(1.0, 8, 2), (1.0, 100, 1), (1e12, 8, 2), (1e-4, 8, 3), (1e30, 8, 1)])
def test_codes_equal_plain_python(spark, monkeypatch, scale, entries, rounds):
    monkeypatch.setattr(vector_codes, "BATCH_ROWS", 16)
    rows = vector_rows(entries, scale)
    schema = "vec_id long, embedding array<double>, label int, id string, code int, error int"
    table = spark.createDataFrame([(*r, "i", 1, 2) for r in rows], schema).repartition(3)
    coded, books = vector_codes.compress(table, "vec_id", "embedding", "label", 3, entries, rounds)
    got = Counter((r.id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in coded.collect())
    assert got == compressed(rows, 3, entries, rounds)
    assert books.shape == (3, min(entries, len(list(got.elements()))), 2)


def test_codes_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>, label string"
    none = spark.createDataFrame([(1, None, "a"), (2, [], None)], schema)
    for table in (none, none.where("false")):
        coded, books = vector_codes.compress(table, "vec_id", "embedding", "label", 2)
        assert coded.collect() == [] and books is None
        assert coded.columns == ["id", "code", "error", "label_error", "codebooks_sha256"]
    odd = spark.createDataFrame([(1, [1.0, 2.0, 3.0], "a")], schema)
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.compress(odd, "vec_id", "embedding", "label", 2)
    same = spark.createDataFrame([(i, [0.5, -0.5], "a") for i in range(300)], schema)
    rows = vector_codes.compress(same, "vec_id", "embedding", "label", 2)[0].collect()
    assert len(rows) == 300 and {(r.code, r.error, r.label_error) for r in rows} == {("0000", 0, 0)}


def test_digits_add_up():
    for value in (0, 1, -1, (1 << 24) - 1, 1 << 24, -(1 << 24), 10**40, -(10**40)):
        assert sum(n << (24 * i) for i, n in enumerate(vector_codes.digits(value))) == value
        assert all(abs(n) < 1 << 24 for n in vector_codes.digits(value))

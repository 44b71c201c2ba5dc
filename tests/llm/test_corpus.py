"""Language model, Jaccard join and mixing against brute force."""

from __future__ import annotations

import collections
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lotwise.llm import components as components_of
from lotwise.llm import elias_fano, jaccard_join, ngram_lm, raking
from lotwise.llm.common import held_out


def test_elias_fano_equals_a_sorted_array():
    rng = np.random.default_rng(0)
    for size, top in [(0, 1), (1, 1), (5, 3), (900, 10), (900, 10**6), (20_000, 2**45), (700, 2**60)]:
        values = np.sort(rng.integers(0, top, size).astype(np.uint64))
        sequence = elias_fano.EliasFano.build(values)
        assert (sequence.access(np.arange(size)) == values).all()
        wanted = np.concatenate([rng.integers(0, top + 5, 800).astype(np.uint64), values[:300]])
        low = rng.integers(0, size + 1, len(wanted))
        stop = np.maximum(low, rng.integers(0, size + 1, len(wanted)))
        want = [a + np.searchsorted(values[a:b], v) for a, b, v in zip(low, stop, wanted, strict=True)]
        assert (sequence.successor(low, stop, wanted) == want).all()


def test_quantised_numbers_are_near():
    values = 10.0 ** np.linspace(2, -12, 500)
    assert np.abs(np.log10(elias_fano.restore(elias_fano.quantise(values))) - np.log10(values)).max() < 1.3e-4


def bigram_scores(texts):
    words = {i: (t or "").encode().lower().split() + [None] for i, t in texts.items()}
    train = {i for i in texts if i is not None and zlib.crc32(str(i).encode()) % 10 != 0}
    one, two, after, kinds = (collections.Counter() for _ in range(4))
    for i in train:
        one.update(words[i])
        for pair in zip([""] + words[i][:-1], words[i], strict=True):
            kinds[pair[0]] += two[pair] == 0
            two[pair] += 1
            after[pair[0]] += 1
    total = sum(one.values())
    whole = total + 0.1 * (len(one) + 1)
    out = {}
    for i, own in words.items():
        base = score = 0.0
        for h, w in zip([""] + own[:-1], own, strict=True):
            p = (one[w] + 0.1) / whole
            base += math.log10(p)
            score += math.log10((max(two[h, w] - 0.75, 0) + 0.75 * kinds[h] * p) / after[h] if after[h] else p)
        out[i] = (i not in train, len(own), sum(one[w] > 0 for w in own), total, base, score)
    return out


def check_scores(rows, want, loose):
    for row in rows:
        expected = want[row.id]
        assert tuple(row)[1:5] == expected[:4]
        assert row.base_score == pytest.approx(expected[4], rel=1e-9)
        assert abs(row.score - expected[5]) <= loose * row.n_tokens


def test_model_on_odd_documents(spark, odd_documents, no_documents):
    docs = odd_documents.dropDuplicates(["doc_id", "text"])
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = ngram_lm.score(docs, held_out(F.col("doc_id"), 10, 0)).collect()
    assert len(rows) == len(texts)
    check_scores(rows, bigram_scores(texts), 0.002)
    twice = ngram_lm.score(odd_documents, held_out(F.col("doc_id"), 10, 0))
    assert twice.count() == odd_documents.count()
    assert ngram_lm.score(no_documents, F.lit(False)).count() == 0
    untrained = ngram_lm.score(docs, F.lit(True)).collect()
    assert {(r.train_tokens, r.base_score, r.score) for r in untrained} == {(0, 0.0, 0.0)}


@pytest.mark.parametrize("frequent", [65_535, 40])
def test_model_equals_counting(spark, small_sf, monkeypatch, frequent):
    monkeypatch.setattr(ngram_lm, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_lm, "shuffle_partitions", lambda spark: 1)
    docs = spark.read.parquet(f"{small_sf}/documents.parquet").repartition(3)
    rows = ngram_lm.score(docs, held_out(F.col("doc_id"), 10, 0)).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    check_scores(rows, bigram_scores(texts), 0.002)
    new = [r for r in rows if r.held_out]
    assert sum(r.score for r in new) > sum(r.base_score for r in new)


@pytest.mark.parametrize("shards", [4, 23, 64])
def test_scores_do_not_depend_on_the_shards(spark, monkeypatch, shards):
    """A passage that a third of the rows copy makes hot contexts of few successors."""
    monkeypatch.setattr(ngram_lm, "shuffle_partitions", lambda spark: shards)
    random.seed(16)
    words = [f"w{i}" for i in range(300)]
    passage = ["hot", "spot", "hot", "dog"] * 5
    rows = [(i, " ".join(random.choices(words, k=30) + (passage if i % 3 == 0 else []))) for i in range(300)]
    rows += [(1000 + i, "hot " + random.choice(words)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = ngram_lm.score(docs, held_out(F.col("doc_id"), 10, 0)).collect()
    assert any(r.held_out and r.id >= 1000 for r in got)
    check_scores(got, bigram_scores(dict(rows)), 0.002)


def test_model_sums_to_one():
    """Over the whole vocabulary and the unknown word, after a context."""
    counts = {1: 3, 2: 1, 3: 2}
    one = {1: 5, 2: 2, 3: 4, 4: 6}
    whole = sum(one.values()) + 0.1 * (len(one) + 1)
    p1 = {w: (n + 0.1) / whole for w, n in one.items()} | {0: 0.1 / whole}
    trie = elias_fano.Trie.build(
        np.array([9], np.uint64),
        np.zeros(3, np.int64),
        np.array(list(counts), np.uint32),
        (np.array(list(counts.values())) - 0.75) / 6,
        np.array([0.75 * 3 / 6]),
    ).mapped()
    chance, weight = trie.find(np.zeros(5, np.int64), np.arange(5))
    assert sum(chance + weight * np.array([p1[w] for w in range(5)])) == pytest.approx(1, abs=1e-3)


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def test_successors_of_split_contexts_travel_in_few_messages(spark):
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(f"hot {word}" for word in words[i::3]) for i in range(3)] * 4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    source = ngram_lm._source(docs, "doc_id", "text", F.lit(False))
    vocabulary = ngram_lm._vocabulary(ngram_lm._unigrams(source), len(texts), 4)
    hot = np.array([xxhash.xxh64_intdigest(b"hot", 0)], np.uint64)
    assert vocabulary.parts(hot)[0] > 1
    sent = ngram_lm._successors(vocabulary, hot, source).collect()
    assert 1 < len(sent) <= 4 * vocabulary.shards  # was one row for each successor and task: 400 or more
    known = ngram_lm._with_kinds(vocabulary, source)
    assert known.split_kinds(hot)[0] == 300


def jaccard_brute(texts, width, percent):
    sets = {i: shingles(t, width) for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(texts)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {i: (len(sets[i]), root(i)) for i in ids}


def mutations():
    random.seed(12)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = random.choices(vocabulary, k=40)
    texts = []
    for _ in range(25):
        base = random.choices(vocabulary, k=random.choice([5, 30, 80, 200]))
        if random.random() < 0.4:
            base = base + passage
        for _ in range(random.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(random.choice([0, 0, 1, 2, 4])):
                copy[random.randrange(len(copy))] = random.choice(vocabulary)
            texts.append(" ".join(copy))
    return texts + ["", "one two", "One  TWO", "one two three", "a a a a a a a a", "a a a a a"]


@pytest.mark.parametrize(("small", "block"), [(64, 512), (3, 512), (3, 4)])
def test_join_equals_all_pairs(spark, monkeypatch, small, block):
    monkeypatch.setattr(jaccard_join, "SMALL_GROUP", small)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    texts = dict(enumerate(mutations()))
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, node int")
    for percent in (85, 60):
        rows = jaccard_join.jaccard_classes(docs.repartition(3), percent=percent).collect()
        assert {r.id: (r.n_shingles, r.component_id) for r in rows} == jaccard_brute(texts, 4, percent)


def test_join_of_one_large_group(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    random.seed(13)
    base = [f"w{i}" for i in range(60)]
    texts = {}
    for i in range(150):
        copy = list(base)
        copy[random.randrange(60)] = f"x{i}"
        texts[i] = " ".join(copy)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows = jaccard_join.jaccard_classes(docs).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in rows} == jaccard_brute(texts, 4, 85)


def near_copies(spark, copies):
    random.seed(14)
    base = [f"w{i}" for i in range(400)]
    texts = []
    for i in range(copies):
        copy = list(base)
        for _ in range(3):
            copy[random.randrange(400)] = f"x{i}"
        texts.append(" ".join(copy))
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(4)


def test_prefixes_travel_in_few_messages(spark):
    docs = near_copies(spark, 60)
    classes = np.zeros(1 << jaccard_join.SKETCH_BITS, np.uint8)
    sent = jaccard_join._postings(docs, classes, 4, 85, jaccard_join.ORDERS, 5).collect()
    assert len(sent) <= 4 * 2 * 5  # was one row for each prefix token: about 7,000


def test_groups_of_the_same_nodes_are_one(spark):
    """A set whose prefix lies in many large groups goes to a few of them, and no pair of a group is lost."""
    docs = near_copies(spark, 60)
    classes = np.zeros(1 << jaccard_join.SKETCH_BITS, np.uint8)
    sent = jaccard_join._postings(docs, classes, 4, 85, jaccard_join.ORDERS, 5)
    _, members = jaccard_join._met(sent, 85, 2)
    tokens, groups = collections.defaultdict(set), collections.defaultdict(set)
    for r in members.collect():
        tokens[r.token].add(r.node)
    for r in jaccard_join._merged_groups(members).collect():
        groups[r.grp].add(r.node)
        assert r.n >= 2
    assert all(any(nodes <= group for group in groups.values()) for nodes in tokens.values())
    # was one bitmap for each token and node
    assert 5 * sum(map(len, groups.values())) < sum(map(len, tokens.values()))


def test_join_of_odd_documents(odd_documents, no_documents):
    rows = jaccard_join.jaccard_classes(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    assert {(r.id, r.component_id) for r in rows if r.n_shingles == 0} == {(0, 0), (1, 1), (2, 2), (77, 77)}
    assert {r.component_id for r in rows if r.id in (5, 6)} == {5}
    assert jaccard_join.jaccard_classes(no_documents).count() == 0


def test_raked_shares_meet_the_targets(spark):
    random.seed(14)
    rows = [
        (i, random.choice("aaab"), random.choice(["x", "y", "y", None]), random.randint(1, 90)) for i in range(3000)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, tokens long")
    wanted = {
        "source": spark.createDataFrame([("a", 1.0), ("b", 3.0), ("none", 5.0)], "value string, share double"),
        "lang": spark.createDataFrame(
            [("x", 0.5), ("y", 0.25), (raking.MISSING, 0.25)], "value string, share double"
        ),
    }
    out = raking.sample(docs, ("source", "lang"), "tokens", "doc_id", targets=wanted).collect()
    mass = sum(r.probability * r.tokens for r in out)

    def share(test):
        return sum(r.probability * r.tokens for r in out if test(r)) / mass

    assert share(lambda r: r.source == "b") == pytest.approx(0.75, abs=1e-5)
    assert share(lambda r: r.lang == "x") == pytest.approx(0.5, abs=1e-5)
    assert share(lambda r: r.lang is None) == pytest.approx(0.25, abs=1e-5)
    assert max(r.probability for r in out) == pytest.approx(1)
    drawn = sum(r.tokens for r in out if r.sampled)
    assert drawn == pytest.approx(mass, rel=0.1)


def test_raking_equals_plain_fitting(spark):
    table = np.array([[30.0, 5, 10], [4, 40, 3]])
    cells = spark.createDataFrame(
        [(a, b, float(table[i, j])) for i, a in enumerate("pq") for j, b in enumerate("uvw")],
        "_d string, _e string, tokens double",
    )
    goal = {"d": [0.3, 0.7], "e": [0.2, 0.2, 0.6]}
    targets = {
        name: spark.createDataFrame(list(zip(values, goal[name], strict=True)), "value string, share double")
        for name, values in (("d", "pq"), ("e", "uvw"))
    }
    got = {(r._d, r._e): r.weight for r in raking.rake(cells, targets).collect()}
    for _ in range(200):
        table *= (np.array(goal["d"]) / table.sum(1))[:, None]
        table *= np.array(goal["e"]) / table.sum(0)
    for i, a in enumerate("pq"):
        for j, b in enumerate("uvw"):
            assert got[a, b] == pytest.approx(table[i, j], abs=1e-5)


def test_mixing_of_odd_documents(odd_documents, no_documents):
    def run(docs):
        counted = docs.withColumn("tokens", raking.tokens(F.col("text")))
        return raking.sample(counted, ("source", "lang"), "tokens", "doc_id").collect()

    rows = run(odd_documents)
    assert len(rows) == odd_documents.count()
    for r in rows:
        assert 0 <= r.probability <= 1
        assert r.probability > 0 or r.doc_id is None or not (r.text or "").split()
    assert run(no_documents) == []


def bounded_brute(tokens, goals, kept):
    """Tokens to keep of each cell, by bisection for every factor."""
    tokens = np.array(tokens)

    def solve(f, low=0.0, high=1e9):
        for _ in range(200):
            middle = (low * high) ** 0.5 if low else high / 2 if high > 1e-12 else 0.0
            low, high = (middle, high) if f(middle) < 0 else (low, middle)
        return high

    factors = np.ones_like(tokens)
    wanted = []
    for axis, share in goals.items():
        has = tokens.sum(1 - axis)
        level = solve(lambda x, h=has, s=share: np.minimum(h, x * s).sum() - kept * (1 - 1e-12))
        wanted.append((axis, np.minimum(has, level * share)))
    for _ in range(300):
        for axis, want in wanted:
            for v, goal in enumerate(want):
                at = (v, slice(None)) if axis == 0 else (slice(None), v)
                own, now = tokens[at], factors[at]
                now *= solve(lambda x, t=own, n=now, g=goal: np.minimum(t, t * n * x).sum() - g * (1 - 1e-12))
    return np.minimum(tokens, tokens * factors)


def test_bounded_raking_equals_plain_fitting(spark):
    tokens = np.array([[300.0, 50, 100], [40, 400, 30], [2, 1, 3]])
    cells = spark.createDataFrame(
        [(a, b, float(tokens[i, j])) for i, a in enumerate("pqr") for j, b in enumerate("uvw")],
        "_d string, _e string, tokens double",
    )
    goal = {0: np.array([1.0, 1.0, 1.0]), 1: np.array([0.2, 0.2, 0.3])}
    targets = {
        name: spark.createDataFrame(
            [(v, float(x)) for v, x in zip(values, share, strict=True)], "value string, share double"
        )
        for (name, values), share in zip((("d", "pqr"), ("e", "uvw")), goal.values(), strict=True)
    }
    want = bounded_brute(tokens, goal, 0.4 * tokens.sum())
    got = {(r._d, r._e): r.weight for r in raking.rake_bounded(cells, targets, 0.4).collect()}
    assert want.sum() == pytest.approx(0.4 * tokens.sum(), rel=1e-4)
    for i, a in enumerate("pqr"):
        for j, b in enumerate("uvw"):
            assert got[a, b] == pytest.approx(want[i, j], abs=0.05), (a, b)
    everything = raking.rake_bounded(cells, targets, 1.0).collect()
    assert all(r.weight == pytest.approx(r.tokens) for r in everything)


def test_a_rare_document_does_not_shrink_the_sample(spark):
    random.seed(15)
    rows = [(i, random.choice("aaab"), random.choice("xyy"), random.randint(1, 90)) for i in range(2000)]
    schema = "doc_id long, source string, lang string, tokens long"

    def kept(rows):
        docs = spark.createDataFrame(rows, schema)
        out = raking.sample(docs, ("source", "lang"), "tokens", "doc_id", rate=0.5).collect()
        mass = sum(r.probability * r.tokens for r in out)
        assert mass == pytest.approx(0.5 * sum(r.tokens for r in out), rel=1e-5)
        return {r.doc_id: r.probability for r in out}

    before = kept(rows)
    for rare in [(9999, "a", "new", 1), (9999, "new", "new", 100)]:
        after = kept([*rows, rare])
        assert after[9999] == pytest.approx(1)
        assert max(abs(after[i] - p) for i, p in before.items()) < 0.01


def test_rounds_of_raking_have_small_plans(spark, monkeypatch):
    rows = [(f"a{i % 2}", f"b{i % 3}", f"c{i % 4}", float(i + 1)) for i in range(12)]
    cell_table = spark.createDataFrame(rows, "_a string, _b string, _c string, tokens double")
    targets = {
        d: spark.createDataFrame([(f"{d}{i}", 1.0 / n) for i in range(n)], "value string, share double")
        for d, n in (("a", 2), ("b", 3), ("c", 4))
    }
    leaves, stored = [], raking.stored

    def counted(df, label):
        leaves.append(df._jdf.queryExecution().analyzed().collectLeaves().size())
        return stored(df, label)

    monkeypatch.setattr(raking, "stored", counted)
    raking.rake_bounded(cell_table, targets, 0.5, rounds=1)
    assert max(leaves) <= 4  # was 15: doubled by each dimension


def test_a_round_of_raking_has_few_shuffles(spark, monkeypatch):
    rows = [(f"a{i % 2}", f"b{i % 3}", f"c{i % 4}", float(i + 1)) for i in range(12)]
    cell_table = spark.createDataFrame(rows, "_a string, _b string, _c string, tokens double")
    targets = {
        d: spark.createDataFrame([(f"{d}{i}", 1.0 / n) for i in range(n)], "value string, share double")
        for d, n in (("a", 2), ("b", 3), ("c", 4))
    }
    shuffles, stored = [], raking.stored

    def counted(df, label):
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles.append(plan.count("Exchange hashpartitioning") if "factor" in plan else 0)
        return stored(df, label)

    monkeypatch.setattr(raking, "stored", counted)
    raking.rake_bounded(cell_table, targets, 0.5, rounds=1)
    assert 0 < sum(shuffles) <= 6  # two for each dimension; the goals took a third


def test_rounds_of_components_broadcast_nothing(spark, monkeypatch):
    plans, stored = [], components_of.stored

    def kept(df, label):
        plans.append(df._jdf.queryExecution())
        return stored(df, label)

    monkeypatch.setattr(components_of, "stored", kept)
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 9)], "x long, y long")
    found = {r.node: r.component for r in components_of.components(edges).collect()}
    assert found == {i: 1 for i in range(1, 10)}
    joins = [line for plan in plans for line in plan.executedPlan().toString().splitlines() if "Join" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)

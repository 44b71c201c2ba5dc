"""Vector near-duplicates, exact top-k and components against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from lotwise.llm import mtree, vector_dedup
from lotwise.llm.components import components


def classes(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    random.seed(8)
    edges = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(500, i) for i in range(120)] + [(7, 7), (500, 3)],
        "random": [(random.randint(0, 200), random.randint(0, 200)) for _ in range(130)],
        "none": [],
    }[shape]
    rows = spark.createDataFrame([*edges, (None, 4)], "a long, b long")
    got = {r.node: r.component for r in components(rows).collect()}
    want = {k: v for k, v in classes(e for e in edges if e[0] != e[1]).items()}
    assert got == want


def vectors(count, dim, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(count // 4, dim))
    near = base[rng.integers(0, len(base), count // 4)] + 0.12 * rng.normal(size=(count // 4, dim))
    copies = base[rng.integers(0, 5, count // 4)]
    return np.concatenate([base, near, copies, 3 * base[:5], rng.normal(size=(count // 4 - 5, dim))])


ODD = [None, [], [0.0] * 8, [1.0, None, *[0.0] * 6], [float("nan")] + [1.0] * 7, [float("inf")] + [1.0] * 7]


@pytest.mark.parametrize("block", [1024, 16])
def test_near_duplicates_equal_all_pairs(spark, block, monkeypatch):
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    data = vectors(240, 8, 9)
    rows = [(1000 + i, v.tolist(), 1, "x") for i, v in enumerate(data)]
    rows += [(i, v, 1, "x") for i, v in enumerate(ODD)] + [(900, [1.0, 2.0], 0, None), (901, [2.0, 4.0], 0, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int, digest string")
    found = {r.id: r for r in vector_dedup.near_duplicates(df.repartition(3), recall=0.99999).collect()}
    assert len(found) == len(rows)
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    want = classes((1000 + a, 1000 + b) for a, b in zip(*np.nonzero(linked), strict=True))
    for i in range(len(data)):
        row = found[1000 + i]
        assert (row.n_links, row.component_id) == (linked[i].sum(), want.get(1000 + i, 1000 + i))
        assert row.kept == (row.component_id == row.id)
    for i in range(len(ODD)):
        assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)
    assert found[901].component_id == 900 and not found[901].kept


def test_near_duplicates_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vector_dedup.near_duplicates(empty).count() == 0
    odd = spark.createDataFrame([(None, [1.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0])], "vec_id long, embedding array<float>")
    rows = {(r.id, r.n_links, r.kept) for r in vector_dedup.near_duplicates(odd).collect()}
    assert rows == {(None, 0, False), (3, 1, True)}


def test_nothing_that_grows_with_the_vectors_is_broadcast(spark, monkeypatch):
    plans, write = [], vector_dedup.stored

    def noted(df, label):
        plans.append(df)
        return write(df, label)

    monkeypatch.setattr(vector_dedup, "stored", noted)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors(80, 8, 9))]
    found = vector_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert found.count() == 80
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in [*plans, found]]
    assert len(plans) == 4 and sum("SortMergeJoin" in plan for plan in plans) == 2
    assert not any("Broadcast" in plan for plan in plans)


def test_tables_follow_the_recall():
    bits, tables = vector_dedup.table_shape(1 << 20, 0.9, 0.999)
    meet = (1 - np.arccos(0.9) / np.pi) ** bits
    assert 1 - (1 - meet) ** tables >= 0.999 and bits >= 14


def test_tree_search_equals_brute_force_and_prunes():
    rng = np.random.default_rng(10)
    centres = rng.normal(size=(12, 6)) * 800
    data = np.floor(centres[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 6)) * 20)
    data[100:200] = data[100]
    tree = mtree.Tree(data, np.arange(3000))
    for q in [*range(0, 3000, 211), 100, 150]:
        scores = sorted((-int(row @ data[q]), i) for i, row in enumerate(data) if i != q)
        assert tree.top(data[q], 5, q) == [(-s, i) for s, i in scores[:5]]
    assert tree.computed < 0.8 * 3000 * 17


def test_top_k_with_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(mtree, "SHARD_ROWS", 40)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(11)
    data = rng.normal(size=(150, 8))
    rows = [(i, v.tolist(), 3) for i, v in enumerate(data)] + [(0, data[0].tolist(), 3)]
    rows += [(200 + i, v, None) for i, v in enumerate(ODD)] + [(None, [1.0] * 8, 1), (300, [1.0, 1.0], 1), (301, [2.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    whole = mtree.whole_vectors(df, "vec_id", "embedding")
    found = mtree.top_k(whole, whole.where("id % 50 = 0"), 4).collect()
    numbers = {i: np.floor(256 * np.array(v)).astype(int) for i, v, _ in rows if i is not None and i < 200}
    numbers[202] = np.zeros(8, int)
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {0, 50, 100, 300}
    for q in (0, 50, 100):
        scores = sorted((-int(v @ numbers[q]), i) for i, v in numbers.items() if i != q)[:4]
        assert sorted(got[q]) == [(n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    assert got[300] == [(1, 301, 256 * 512 + 256 * 256)]
    assert mtree.top_k(whole.where("false"), whole, 4).count() == 0

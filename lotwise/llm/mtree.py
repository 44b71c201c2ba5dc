"""Exact top-k by inner product with M-trees and best-first search.

Vectors are lifted to a sphere, x -> (x, sqrt(R^2 - |x|^2)), where a larger inner product is
a smaller Euclidean distance, so a metric tree applies. The rows are cut into shards; a task
bulk-loads one shard into an M-tree of pages (routing object, covering radius, distance to
the parent's routing object) and searches it for one block of queries. The bounds of the
triangle inequality skip pages, and entries of a page, without computing their distance.
Every inner product that is computed is exact; pruning keeps ties.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.common import stored

PAGE = 64
SHARD_ROWS = 8192
QUERY_BLOCK = 2048
EXACT = float(1 << 53)


class Page:
    """A node: its routing object, radius, and entries with their distances to the routing object."""

    __slots__ = ("centre", "radius", "rows", "children", "distances")

    def __init__(self, centre, radius, rows, children, distances):
        self.centre, self.radius = centre, radius
        self.rows, self.children, self.distances = rows, children, distances


class Tree:
    """M-tree over the rows of a float64 matrix of whole numbers."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray):
        self.rows, self.ids = rows, ids
        self.exact = rows if np.abs(rows).max(initial=0.0) ** 2 * rows.shape[1] < EXACT else rows.astype(np.int64)
        norms = np.einsum("ij,ij->i", rows, rows)
        self.bound = float(norms.max(initial=0.0))
        self.lifted = np.column_stack([rows, np.sqrt(np.maximum(self.bound - norms, 0.0))])
        self.slack = 1e-6 * (1.0 + math.sqrt(self.bound))
        self.computed = 0
        self.root = self._load(np.arange(len(rows)))

    def _load(self, members: np.ndarray) -> Page:
        points = self.lifted[members]
        middle = points.mean(0) if len(members) else np.zeros(self.lifted.shape[1])
        away = np.sqrt(((points - middle) ** 2).sum(1))
        centre = points[away.argmin()] if len(members) else middle
        distances = np.sqrt(((points - centre) ** 2).sum(1))
        radius = float(distances.max(initial=0.0))
        if len(members) <= PAGE or radius == 0.0:
            order = np.argsort(distances, kind="stable")
            return Page(centre, radius, members[order], None, distances[order])
        # up to PAGE routing objects, spread over the members; each member joins the nearest
        count = min(PAGE, math.ceil(len(members) / PAGE) + 1)
        picked = [int(distances.argmax())]
        nearest = np.sqrt(((points - points[picked[0]]) ** 2).sum(1))
        owner = np.zeros(len(members), np.int64)
        while len(picked) < count and nearest.max() > 0:
            fresh = int(nearest.argmax())
            gap = np.sqrt(((points - points[fresh]) ** 2).sum(1))
            owner[gap < nearest] = len(picked)
            nearest = np.minimum(nearest, gap)
            picked.append(fresh)
        parts = [members[owner == i] for i in range(len(picked))]
        children = [self._load(part) for part in parts if len(part)]
        to_parent = np.array([math.dist(child.centre, centre) for child in children])
        return Page(centre, radius, None, children, to_parent)

    def top(self, query: np.ndarray, k: int, skip: int) -> list[tuple[int, int]]:
        """The ``k`` largest (score, id), best first; ties go to the smaller id. ``skip`` takes no part."""
        lifted = np.append(query, 0.0)
        norm = float(query @ query)
        whole = query if self.exact is self.rows and np.abs(query).max(initial=0.0) < 1e6 else query.astype(np.int64)
        best: list[tuple[int, int]] = []  # heap of (score, -id), worst first

        def limit() -> float:
            """Largest distance that can still matter."""
            if len(best) < k:
                return math.inf
            return math.sqrt(max(0.0, self.bound + norm - 2.0 * best[0][0])) + self.slack

        start = math.dist(lifted, self.root.centre)
        queue = [(max(0.0, start - self.root.radius), 0, start, self.root)]
        pushed = 0
        while queue:
            low, _, distance, page = heapq.heappop(queue)
            if low > limit():
                break
            near = np.abs(distance - page.distances)
            if page.children is None:
                rows = page.rows[near <= limit()]
                self.computed += len(rows)
                scores = self.exact[rows] @ whole
                if len(best) == k:
                    passing = scores >= best[0][0]
                    rows, scores = rows[passing], scores[passing]
                elif len(rows) > k:
                    passing = scores >= np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
                    rows, scores = rows[passing], scores[passing]
                for row, score in zip(rows.tolist(), scores.tolist(), strict=True):
                    entry = (int(score), -int(self.ids[row]))
                    if -entry[1] == skip:
                        continue
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
                continue
            reach = limit()
            for bound, child in zip(near, page.children, strict=True):
                if bound - child.radius > reach:
                    continue
                away = math.dist(lifted, child.centre)
                if away - child.radius <= reach:
                    pushed += 1
                    heapq.heappush(queue, (max(0.0, away - child.radius), pushed, away, child))
        return [(score, -negative) for score, negative in sorted(best, reverse=True)]


def whole_vectors(vectors: DataFrame, key: str, vector: str, scale: float = 256.0) -> DataFrame:
    """(id, v array<double>): floor(scale * x) of the vectors that take part.

    Left out: null ids, null vectors, vectors holding null or non-finite components.
    """

    def usable(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    source = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    source = source.where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", usable))
    return source.select("id", F.transform("v", lambda x: F.floor(x * scale).cast("double")).alias("v"))


def _search(k: int):
    def run(key: tuple, data: pa.Table, queries: pa.Table) -> pa.Table:
        def matrix(table: pa.Table) -> np.ndarray:
            return table.column("v").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)

        out: list[tuple[int, int, int]] = []
        if data.num_rows and queries.num_rows:
            tree = Tree(matrix(data), data.column("id").to_numpy())
            for own, query in zip(queries.column("id").to_pylist(), matrix(queries), strict=True):
                out += [(own, other, score) for score, other in tree.top(query, k, own)]
        columns = list(zip(*out, strict=True)) if out else [[], [], []]
        names = ("query_id", "vec_id", "score")
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns, strict=True)})

    return run


def top_k(data: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of ``data`` for each query.

    Both tables have ``id`` and ``v`` (whole numbers as double). A query is never its own
    result; vectors of another length take no part in its search; fewer than ``k`` rows give
    all of them. Rows that repeat an id and a vector count once. Each pair of a shard and a
    block of queries is one task, and a shard keeps ``k`` rows for each query.
    """
    data = stored(data.dropDuplicates(["id", "v"]), "search-rows")
    queries = stored(queries.dropDuplicates(["id", "v"]), "search-queries")
    shards = max(1, math.ceil(data.count() / SHARD_ROWS))
    blocks = max(1, math.ceil(queries.count() / QUERY_BLOCK))

    def placed(df: DataFrame, own: str, count: int, other: str, others: int) -> DataFrame:
        df = df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")).withColumn("dim", F.size("v"))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    left = placed(data, "shard", shards, "block", blocks).groupBy("shard", "block", "dim")
    right = placed(queries, "block", blocks, "shard", shards).groupBy("shard", "block", "dim")
    found = left.cogroup(right).applyInArrow(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

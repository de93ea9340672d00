"""Approximate nearest neighbours by a forest of random-projection trees.

Each tree splits a bounded sample of the vectors by hyperplanes halfway
(in rank) along the difference of two random members, down to small
leaves.  Every vector of the table is then routed to its leaf in each tree.
A query walks all trees through one shared priority queue: the branch with
the largest margin goes first, whichever tree it belongs to, until the
leaves it has reached hold enough candidates.  Leaf by leaf the candidates
are reranked by their exact cosine in double precision.

Only the forest (bounded by the sample) and the sizes of its leaves travel
to all tasks.  Leaves that hold many vectors are split into parts.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabletrust.llm.common import cut_lineage
from tabletrust.llm.vectors import distinct_vectors, of_one_length, ranked_answers, usable


class Tree:
    """Inner node i splits at ``planes[i] . x <= offsets[i]`` into
    ``left[i]`` or ``right[i]``; a negative child is leaf ``-1 - child``."""

    def __init__(self, sample: np.ndarray, leaf: int, rng: np.random.Generator):
        self.left, self.right, planes, offsets, self.leaves = [], [], [], [], 0

        def grow(rows: np.ndarray) -> int:
            split = self._split(sample, rows, rng) if len(rows) > leaf else None
            if split is None:
                self.leaves += 1
                return -self.leaves
            plane, offset, low = split
            at = len(planes)
            planes.append(plane)
            offsets.append(offset)
            self.left.append(0)
            self.right.append(0)
            self.left[at] = grow(rows[low])
            self.right[at] = grow(rows[~low])
            return at

        self.root = grow(np.arange(len(sample)))
        self.planes = np.array(planes).reshape(-1, sample.shape[1])
        self.offsets = np.array(offsets)

    @staticmethod
    def _split(sample, rows, rng):
        for _ in range(8):
            a, b = rng.choice(rows, 2, replace=False)
            plane = sample[a] - sample[b]
            norm = np.linalg.norm(plane)
            if norm < 1e-12:
                continue
            along = sample[rows] @ (plane / norm)
            offset = np.median(along)
            low = along <= offset
            if 0 < low.sum() < len(rows):
                return plane / norm, float(offset), low
        return None  # (nearly) equal vectors: one leaf

    def route(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out, todo = np.zeros(len(x), np.int64), [(self.root, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -1 - node
            elif len(rows):
                low = x[rows] @ self.planes[node] <= self.offsets[node]
                todo += [(self.left[node], rows[low]), (self.right[node], rows[~low])]
        return out


def search(trees: list[Tree], sizes: list[np.ndarray], x: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """(tree, leaf) pairs in the order of the shared queue, until their
    leaves hold ``enough`` vectors (a vector counts in each tree)."""
    margins = [t.planes @ x - t.offsets for t in trees]
    queue = [(-np.inf, i, t.root) for i, t in enumerate(trees)]
    out, held = [], 0
    while queue and held < enough:
        worst, i, node = heapq.heappop(queue)
        if node < 0:
            out.append((i, -1 - node))
            held += int(sizes[i][-1 - node])
        else:
            m = float(margins[i][node])
            heapq.heappush(queue, (max(worst, m), i, trees[i].left[node]))
            heapq.heappush(queue, (max(worst, -m), i, trees[i].right[node]))
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at unit length; scaled first, so that squares stay finite."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, trees: int = 8, leaf: int = 32, sample: int = 8192, share: float = 0.72,
            least: int = 2000, part: int = 4096, query_part: int = 16384, seed: int = 7, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): for each row where
    ``is_query`` holds (a condition on the column ``id``) the ``k`` nearest
    other rows found, by cosine, ties to the smaller vec_id.

    About ``sample`` distinct vectors (the bound on what the forest learns
    from) shape ``trees`` trees with leaves of at most ``leaf`` of them;
    every row is indexed.  A query stops when its leaves hold ``share`` of
    all distinct vectors, but at least ``least``.

    Vectors that are NULL, empty, zero or hold a NULL or non-finite
    component take no part, nor do rows with a NULL vec_id or, where lengths
    differ, of another than the most frequent one (ties: the longer).  Equal vectors are indexed once; rows that repeat
    a vec_id count once each, never for a query of that vec_id.  An empty
    table gives no rows.
    """
    spark = vectors.sparkSession
    rows = cut_lineage(
        vectors.where(F.col(vec_id).isNotNull() & usable(F.col(vector)) & F.exists(F.col(vector), lambda c: c != 0))
        .select(F.col(vec_id).cast("bigint").alias("id"), F.transform(F.col(vector), lambda c: c.cast("double")).alias("v")))
    rows = of_one_length(rows)
    queries = rows.where(is_query).distinct()
    classes = cut_lineage(distinct_vectors(rows, k + 1))
    asked = cut_lineage(queries.select("v").distinct())
    n, n_asked = classes.count(), asked.count()
    drawn = classes.where(F.pmod(F.xxhash64(F.lit(seed), "v"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample / max(1, n))))
    learned = sorted(tuple(r["v"]) for r in drawn.select("v").collect())
    if not learned:
        learned = [tuple(r["v"]) for r in classes.select("v").limit(1).collect()] or [(1.0,)]
    rng = np.random.default_rng(seed)
    forest = spark.sparkContext.broadcast([Tree(unit(np.array(learned)), leaf, rng) for _ in range(trees)])

    def leaf_counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in frames:
            x = unit(np.stack(some["v"]))
            for i, tree in enumerate(forest.value):
                at, count = np.unique(tree.route(x), return_counts=True)
                yield pd.DataFrame({"tree": i, "leaf": at, "n": count})

    sizes = [np.zeros(t.leaves, np.int64) for t in forest.value]
    for r in classes.select("v").mapInPandas(leaf_counts, "tree int, leaf long, n long").groupBy("tree", "leaf").agg(F.sum("n").alias("n")).collect():
        sizes[r["tree"]][r["leaf"]] = r["n"]  # as many rows as the forest has leaves
    parts = [np.maximum(1, -(-s // part)) for s in sizes]
    query_parts = max(1, -(-n_asked // query_part))
    enough = max(least, int(np.ceil(share * n)))

    array = T.ArrayType(T.DoubleType())
    cell = [T.StructField("cell", T.LongType()), T.StructField("part", T.LongType())]

    def index(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in frames:
            x = unit(np.stack(some["v"]))
            salt = np.array([ids[0] for ids in some["ids"]])
            for i, tree in enumerate(forest.value):
                at = tree.route(x)
                yield pd.DataFrame({"cell": i * (1 << 32) + at, "part": salt % parts[i][at], "v": some["v"].to_numpy(), "ids": some["ids"].to_numpy()})

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in frames:
            for v, x in zip(some["v"], unit(np.stack(some["v"])), strict=True):
                at = [(i * (1 << 32) + j, p) for i, j in search(forest.value, sizes, x, enough) for p in range(parts[i][j])]
                yield pd.DataFrame({"cell": [c for c, _ in at], "part": [p for _, p in at], "v": [v] * len(at)})

    out = T.StructType([T.StructField("v", array), T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("score", T.DoubleType())])

    def rerank(probes: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        if not len(probes) or not len(some):
            return pd.DataFrame({"v": [], "ids": [], "score": []}).astype({"v": object, "ids": object, "score": "float64"})
        q, x, ids = unit(np.stack(probes["v"])), unit(np.stack(some["v"])), some["ids"].to_numpy()
        first = np.array([i[0] for i in ids])
        answers = []
        for at in range(0, len(q), 512):
            near = q[at: at + 512] @ x.T
            for row, cosines in enumerate(near, at):
                # All that may be among the best k + 1: rounding differs, and ties go to the smaller id.
                best = np.arange(len(x)) if len(x) <= k + 1 else np.flatnonzero(cosines >= np.partition(cosines, -(k + 1))[-(k + 1)] - 1e-12)
                # The sum of one pair alone does not depend on its block.
                exact = (q[row] * x[best]).sum(axis=1)
                best = best[np.lexsort((first[best], -exact))[: k + 1]]
                answers += [(probes["v"].iat[row], ids[i], float((q[row] * x[i]).sum())) for i in best]
        return pd.DataFrame(answers, columns=["v", "ids", "score"])

    cells = ["cell", "part", "query_part"]
    indexed = classes.mapInPandas(index, T.StructType([*cell, T.StructField("v", array), T.StructField("ids", T.ArrayType(T.LongType()))]))
    probes = asked.mapInPandas(walk, T.StructType([*cell, T.StructField("v", array)]))
    found = (
        probes.withColumn("query_part", F.pmod(F.xxhash64("v"), F.lit(query_parts)).cast("int")).groupBy(*cells)
        .cogroup(indexed.withColumn("query_part", F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1)))).groupBy(*cells))
        .applyInPandas(rerank, out)
    )
    return ranked_answers(found, queries, k)

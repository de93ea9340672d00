"""Exact top-k by inner product with multi-resolution segment statistics.

A vector cut into segments is known by each segment's mean and standard
deviation.  They bound distances from below,

    |x - y|^2 >= sum of m * ((mean_x - mean_y)^2 + (dev_x - dev_y)^2)

over segments of m components, and so bound inner products from above.
Bounds go from coarse (one segment) to fine; only candidates that survive
the finest are scored exactly, on integers.  Queries meet all candidates in
blocks of bounded size: no pair of rows is ever written out, and each block
gives its best few only.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabletrust.llm.common import cut_lineage
from tabletrust.llm.vectors import distinct_vectors, ranked_answers, usable

LEVELS = (1, 4, 16)


def segment_stats(x: np.ndarray, segments: int) -> np.ndarray:
    """Per row, sqrt(m) * mean and sqrt(m) * deviation of each segment:
    the inner product of two rows' statistics is the upper bound."""
    out = []
    for part in np.array_split(x, min(segments, x.shape[1]), axis=1):
        root = np.sqrt(part.shape[1])
        out += [part.mean(axis=1) * root, part.std(axis=1) * root]
    return np.stack(out, axis=1)


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products of ``q`` with the rows of ``x``."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * len(q)
    if top < 2.0**53:  # every partial sum is exact in doubles
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return (x.astype(object) @ q.astype(object)) if top >= 2.0**63 else x @ q


def best_of(q: np.ndarray, x: np.ndarray, first_ids: np.ndarray, stats: list[tuple[np.ndarray, np.ndarray]], row: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of ``x``, scores) of the ``k`` largest scores of query ``row``,
    ties to the smaller first id."""
    slack = 1e-9 * (1 + float(np.linalg.norm(q.astype(float))) * float(stats[-1][2]))
    bound = stats[0][1] @ stats[0][0][row]
    if len(x) > 4 * k:
        # Score the most promising first: their k-th best is a floor.
        hope = np.argpartition(-(stats[-1][1] @ stats[-1][0][row]), 4 * k)[: 4 * k]
        floor = np.sort(exact_scores(q, x[hope]))[-k]
        alive = np.flatnonzero(bound >= floor - slack)
        for fine in stats[1:]:
            alive = alive[fine[1][alive] @ fine[0][row] >= floor - slack]
    else:
        alive = np.arange(len(x))
    scores = exact_scores(q, x[alive])
    order = np.lexsort((first_ids[alive], -scores))[:k]
    return alive[order], scores[order]


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, chunk: int = 4096, query_chunk: int = 1024,
          vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): for each row where
    ``is_query`` holds (a condition on the column ``id``), the ``k`` other
    rows with the largest inner products of the integer vectors
    floor(``scale`` * component), ties to the smaller vec_id.

    Vectors that are NULL, empty or hold a NULL or non-finite component take
    no part, nor do rows with a NULL vec_id; vectors of different lengths
    never meet.  Equal vectors are compared once.  Rows that repeat a vec_id
    count once each as candidates, never for a query of that vec_id.  Fewer
    than ``k`` candidates: all of them.  Scores must fit a long.
    """
    v = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * F.lit(float(scale))))
    rows = cut_lineage(vectors.where(F.col(vec_id).isNotNull() & usable(F.col(vector))).select(F.col(vec_id).cast("bigint").alias("id"), v.alias("v")))
    queries = rows.where(is_query).distinct()
    classes = cut_lineage(distinct_vectors(rows, k + 1))
    asked = cut_lineage(queries.select("v").distinct())
    chunks, query_chunks = -(-classes.count() // chunk), -(-asked.count() // query_chunk)

    def dealt(df: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        return df.withColumn("dim", F.size("v")).withColumn(own, F.pmod(F.xxhash64("v"), F.lit(max(1, n))).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(max(1, m) - 1))))

    out = T.StructType([T.StructField("v", T.ArrayType(T.LongType())), T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("score", T.LongType())])

    def block(some_queries: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        if not len(some_queries) or not len(some):
            return pd.DataFrame({"v": [], "ids": [], "score": []}).astype({"v": object, "ids": object, "score": "int64"})
        q, x = np.stack(some_queries["v"]), np.stack(some["v"])
        first_ids = np.array([ids[0] for ids in some["ids"]])
        longest = np.linalg.norm(x.astype(float), axis=1).max()
        stats = [(segment_stats(q.astype(float), s), segment_stats(x.astype(float), s), longest) for s in LEVELS]
        ids, answers = some["ids"].to_numpy(), []
        for row in range(len(q)):
            at, scores = best_of(q[row], x, first_ids, stats, row, k + 1)
            answers += [(some_queries["v"].iat[row], ids[i], int(s)) for i, s in zip(at, scores, strict=True)]
        return pd.DataFrame(answers, columns=["v", "ids", "score"])

    cells = ["dim", "part", "query_part"]
    found = (
        dealt(asked, "query_part", query_chunks, "part", chunks).groupBy(*cells)
        .cogroup(dealt(classes, "part", chunks, "query_part", query_chunks).groupBy(*cells))
        .applyInPandas(block, out)
    )
    return ranked_answers(found, queries, k)

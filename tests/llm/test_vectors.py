"""The vector searches against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabletrust.llm import ann, topk

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(700, 16)).astype(np.float32).tolist()
    x[100:400] = [x[0]] * 300  # equal vectors over a third of the rows
    x[400:420] = [[2 * c for c in x[5]]] * 20
    out = [(i, v, 0) for i, v in enumerate(x)]
    nan, inf = float("nan"), float("inf")
    return out + [(1000, None, 1), (1050, [], 1), (1100, [0.0] * 16, 1), (1150, [nan] + [1.0] * 15, 1), (1200, [inf] + [1.0] * 15, 1),
                  (1250, [None] + [1.0] * 15, 1), (None, [1.0] * 16, 1), (50, x[50], 0)]


def brute(rows, step, k, score, usable):
    good = [(i, v) for i, v, _ in rows if i is not None and v and all(c is not None and math.isfinite(c) for c in v) and usable(v)]
    m = score(good)
    out = {}
    for q in {i for i, _ in good if i % step == 0}:
        row = m(next(v for i, v in good if i == q))
        best = sorted(((-s, i) for (i, _), s in zip(good, row, strict=True) if i != q))[:k]
        out[q] = [(i, -s) for s, i in best]
    return out


def integer_scores(good):
    x = np.floor(1024 * np.array([v for _, v in good], float)).astype(np.int64)
    return lambda v: x @ np.floor(1024 * np.array(v, float)).astype(np.int64)


def test_top_k_is_exact(spark, rows):
    got = {}
    for r in topk.top_k(spark.createDataFrame(rows, SCHEMA).withColumn("v", F.lit(1)), F.col("id") % 100 == 0, chunk=64, query_chunk=3).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    want = brute([r for r in rows if r[0] != 50 or r is rows[50]], 100, 10, integer_scores, lambda v: True)
    assert {q: [a[i] for i in range(1, len(a) + 1)] for q, a in got.items()} == want


def test_segment_bounds_hold():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(50, 37)), rng.normal(size=(40, 37)) * 3
    last = None
    for s in topk.LEVELS:
        bound = topk.segment_stats(x, s) @ topk.segment_stats(y, s).T
        assert (bound >= x @ y.T - 1e-9).all()
        assert last is None or (bound <= last + 1e-9).all() or s % 4
        last = bound


def test_large_components_stay_exact():
    q, x = np.array([3 * 10**9, 5]), np.array([[3 * 10**9, 1], [-(10**9), 7]])
    assert topk.exact_scores(q, x).tolist() == [9 * 10**18 + 5, -3 * 10**18 + 35]


def cosines(good):
    x = ann.unit(np.array([v for _, v in good], float))
    return lambda v: x @ ann.unit(np.array([v], float))[0]


def test_forest_search_recall_and_scores(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute([r for r in rows if r[0] != 50 or r is rows[50]], 50, 5, cosines, any)
    exact = {}
    for r in ann.nearest(df, F.col("id") % 50 == 0, least=10**6, part=50, query_part=4).collect():
        exact.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(exact) == set(want)
    for q, a in exact.items():
        assert [s for _, s in (a[i] for i in range(1, len(a) + 1))] == pytest.approx([s for _, s in want[q]], abs=1e-12)
    hits = total = 0
    found = {}
    for r in ann.nearest(df, F.col("id") % 50 == 0, least=0, leaf=8).collect():
        found.setdefault(r.query_id, []).append(r.score)
    for q, a in want.items():
        floor = a[-1][1] - 1e-9
        hits += sum(s >= floor for s in found[q])
        total += len(a)
    assert hits >= 0.9 * total


@pytest.mark.parametrize("run", [lambda d: topk.top_k(d, F.col("id") % 100 == 0), lambda d: ann.nearest(d, F.col("id") % 50 == 0)])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], SCHEMA)).collect() == []
    assert run(spark.createDataFrame([(0, [1.0, 2.0], 1)], SCHEMA)).collect() == []


def test_ties_go_to_the_smaller_id(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=16).astype(np.float32)
    rows = [(801 + i, (base * 2.0 ** (i - 100)).tolist()) for i in range(200)] + [(5000, base.tolist())]
    rows += [(i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(1, 400)] + [(2000 + i, [1.0] * 5) for i in range(20)]
    out = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("id") == 5000, share=1.0).collect()
    assert [(r.rank, r.vec_id) for r in sorted(out, key=lambda r: r["rank"])] == [(i + 1, 801 + i) for i in range(5)]

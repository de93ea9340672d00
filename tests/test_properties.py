"""Property tests: the tolerance rule against a plain-Python statement of
it on random values (NaN, infinities, NULL, signed zero, huge and tiny
numbers), and keyed-state invariants."""

import math
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabletrust.functions import approx as A
from tabletrust.operators import keyed as K


def near_py(a, e, rel, abs_, nan_ok):
    """The rule, written independently for the test."""
    if a is None or e is None:
        return a is None and e is None
    if math.isnan(e):
        return nan_ok and math.isnan(a)
    if math.isnan(a):
        return False
    if a == e:
        return True
    if math.isinf(e):
        return False
    if rel is None and abs_ is not None:
        tol = abs_
    else:
        tol = max((1e-6 if rel is None else rel) * abs(e), 1e-12 if abs_ is None else abs_)
    return abs(e - a) <= tol


VALUES = [None, float("nan"), float("inf"), -float("inf"), 0.0, -0.0, 1.0, 1.0 + 1e-7, 1.0 + 1e-5, 1e-13, 1e-11,
          -1.0, 1e300, 1e-300, 123456.789]


def test_rule_matches_python_on_random_values(spark):
    rng = random.Random(11)
    rows = []
    for _ in range(3000):
        a = rng.choice(VALUES + [rng.uniform(-10, 10)])
        e = rng.choice(VALUES + [None if a is None else (a * (1 + rng.uniform(-1e-5, 1e-5)) if a == a else a)])
        rel = rng.choice([None, 0.0, 1e-9, 1e-6, 1e-3, 0.5])
        abs_ = rng.choice([None, 0.0, 1e-12, 1e-6, 0.5])
        nan_ok = rng.random() < 0.5
        rows.append((a, e, rel, abs_, nan_ok))
    df = spark.createDataFrame(rows, "a double, e double, rel double, abs double, nan_ok boolean")
    got = df.select(A.near(F.col("a"), F.col("e"), rel=F.col("rel"), abs=F.col("abs"), nan_ok=F.col("nan_ok"))).collect()
    bad = [(r, g[0]) for r, g in zip(rows, got) if g[0] is not near_py(*r)]
    assert not bad, bad[:5]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcde"), st.integers(0, 5), st.integers(0, 100)), min_size=1, max_size=30))
def test_upsert_is_idempotent_and_last_wins(spark, writes):
    df = spark.createDataFrame(writes, "key string, ver int, value int")
    empty = df.limit(0)
    once = K.upsert(empty, df, ["key"], order=["ver", "value"])
    twice = K.upsert(once, df, ["key"], order=["ver", "value"])
    want = {}
    for k, v, x in writes:
        if k not in want or (v, x) > want[k]:
            want[k] = (v, x)
    assert {r["key"]: (r["ver"], r["value"]) for r in once.collect()} == want
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))

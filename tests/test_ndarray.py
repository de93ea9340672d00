"""Mismatches of n-d arrays against numpy."""

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabletrust.operators import compare

SCHEMA = "id int, a array<double>, a_shape array<int>, e array<double>, e_shape array<int>"


def mismatches(spark, rows, schema=SCHEMA, **kw):
    df = spark.createDataFrame(rows, schema)
    out = compare.ndarray_mismatches(df, ["id"], F.col("a"), F.col("a_shape"), F.col("e"), F.col("e_shape"), **kw).collect()
    return [(r.id, r.message, None if r["index"] is None else tuple(r["index"]), r.obtained, r.expected) for r in out]


def test_indices_match_numpy(spark):
    rng = np.random.default_rng(5)
    rows, want = [], []
    for n, shape in enumerate([(), (5,), (2, 3), (3, 1, 4), (2, 2, 2, 2), (0, 3)]):
        e = rng.normal(size=shape)
        a = np.array(e + np.where(rng.random(shape) < 0.5, 0.1, 0.0))
        rows.append((n, a.ravel().tolist(), list(shape), e.ravel().tolist(), list(shape)))
        want += [(n, None, tuple(map(int, i)), float(a[tuple(i)]), float(e[tuple(i)])) for i in np.argwhere(np.abs(a - e) > 0.01)]
    assert len(want) > 10 and sorted(mismatches(spark, rows, abs=0.01)) == sorted(want)


def test_messages(spark):
    v = [1.0, 2.0]
    rows = [
        (0, v, [2], v, [2]), (1, v, [2], v, [1, 2]), (2, v, [2], None, None), (3, None, None, None, None), (4, v, None, [1.0, 3.0], None),
        (5, v, [3], v, [3]), (6, [1.0, None], [2], [1.0, 2.0], [2]), (7, [], [0], [], [0]), (8, v, [2], v, None),
    ]
    assert mismatches(spark, rows) == [
        (1, "Impossible to compare arrays with different shapes. Shapes: (1, 2) and (2,)", None, None, None),
        (2, compare.ONE_IS_NULL, None, None, None),
        (4, None, (1,), 2.0, 3.0),
        (5, compare.NOT_FILLED, None, None, None),
        (6, None, (1,), None, 2.0),
        (8, "Impossible to compare arrays with different shapes. Shapes: NULL and (2,)", None, None, None),
    ]


def test_elements_of_a_type(spark):
    schema = "id int, a array<string>, a_shape array<int>, e array<string>, e_shape array<int>"
    rows = [(0, ["x", "1.0", None, "y"], [2, 2], ["x", "1", None, "z"], [2, 2])]
    assert mismatches(spark, rows, schema, element=T.StringType()) == [(0, None, (0, 1), "1.0", "1"), (0, None, (1, 1), "y", "z")]
    assert mismatches(spark, [], schema, element=T.StringType()) == []

"""Approximate comparison: the scalar cases, containers, decimals, tables."""

import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabletrust.functions import approx as A
from tabletrust.operators import compare as CMP

NAN, INF = float("nan"), float("inf")

# (actual, expected, rel, abs, nan_ok, ok) -- hand-derived from the rule.
SCALAR_CASES = [
    (0.1 + 0.2, 0.3, None, None, False, True),
    (1.0001, 1.0, None, None, False, False),
    (1.0001, 1.0, 1e-3, None, False, True),
    (1.0001, 1.0, None, 1e-3, False, True),
    (1 + 1e-8, 1.0, None, None, False, True),
    (1 + 1e-8, 1.0, None, 1e-12, False, False),
    (1 + 1e-8, 1.0, 1e-6, 1e-12, False, True),
    (None, None, None, None, False, True),
    (None, 1.0, None, None, False, False),
    (NAN, NAN, None, None, False, False),
    (NAN, NAN, None, None, True, True),
    (NAN, 1.0, None, None, False, False),
    (INF, INF, None, None, False, True),
    (1.0, INF, None, None, False, False),
    (INF, 1.0, None, None, False, False),
    (1e-13, 0.0, None, None, False, True),
    (1e-11, 0.0, None, None, False, False),
]


@pytest.mark.parametrize("a,e,rel,abs_,nan_ok,ok", SCALAR_CASES)
def test_scalar_rule(spark, a, e, rel, abs_, nan_ok, ok):
    df = spark.createDataFrame([(a, e)], "a double, e double")
    got = df.select(A.near(F.col("a"), F.col("e"), rel=rel, abs=abs_, nan_ok=nan_ok).alias("ok")).first()["ok"]
    assert got is ok


def test_per_row_tolerances(spark):
    rows = [(a, e, rel, abs_, nan_ok, ok) for a, e, rel, abs_, nan_ok, ok in SCALAR_CASES]
    df = spark.createDataFrame(rows, "a double, e double, rel double, abs double, nan_ok boolean, ok boolean")
    got = df.select(A.near(F.col("a"), F.col("e"), rel=F.col("rel"), abs=F.col("abs"), nan_ok=F.col("nan_ok"))
                    .alias("got"), "ok").collect()
    assert all(r["got"] == r["ok"] for r in got)


@pytest.mark.parametrize("bad", [-1.0, NAN])
def test_bad_tolerance_raises(spark, bad):
    with pytest.raises(ValueError):
        A.near(F.lit(1.0), F.lit(1.0), abs=bad)
    with pytest.raises(ValueError):
        A.near(F.lit(1.0), F.lit(1.0), rel=bad)


def test_bad_tolerance_column_raises_at_run_time(spark):
    df = spark.createDataFrame([(1.0, 2.0, -1.0)], "a double, e double, t double")
    with pytest.raises(Exception):
        df.select(A.near(F.col("a"), F.col("e"), abs=F.col("t"))).collect()


def test_arrays_scalar_sides_and_length(spark):
    df = spark.createDataFrame(
        [([0.1 + 0.2, 0.2 + 0.4], [0.3, 0.6]), ([1.0, 2.0], [1.0, 2.0, 3.0]), (None, None), ([1.0], None)],
        "a array<double>, e array<double>")
    got = [r[0] for r in df.select(A.near_array(F.col("a"), F.col("e"))).collect()]
    assert got == [True, False, True, False]
    one = spark.createDataFrame([([1.0, 1.0 + 1e-9],)], "a array<double>")
    assert one.select(A.near_array_scalar(F.col("a"), F.lit(1.0))).first()[0] is True
    assert one.select(A.near_scalar_array(F.lit(1.0), F.col("a"))).first()[0] is True
    assert one.select(A.near_array_scalar(F.col("a"), F.lit(2.0))).first()[0] is False


def test_shapes(spark):
    df = spark.createDataFrame([([1.0] * 4,)], "a array<double>")
    a = F.col("a")
    s22, s4 = F.array(F.lit(2), F.lit(2)), F.array(F.lit(4))
    assert df.select(A.near_ndarray(a, s22, a, s22)).first()[0] is True
    assert df.select(A.near_ndarray(a, s22, a, s4)).first()[0] is False


def test_maps(spark):
    df = spark.createDataFrame(
        [({"a": 0.1 + 0.2, "b": 0.2 + 0.4}, {"a": 0.3, "b": 0.6}), ({"a": 1.0}, {"b": 1.0}), (None, None)],
        "a map<string,double>, e map<string,double>")
    assert [r[0] for r in df.select(A.near_map(F.col("a"), F.col("e"))).collect()] == [True, False, True]


def test_strings_strict_in_compare(spark):
    a = spark.createDataFrame([(1, "foo", 1.0000005)], "k int, s string, x double")
    e = spark.createDataFrame([(1, None, 1.0)], "k int, s string, x double")
    cells = {r["column"]: r["ok"] for r in CMP.compare_tables(a, e, ["k"]).collect()}
    assert cells == {"s": False, "x": True}


def test_nested_refused():
    with pytest.raises(TypeError):
        A.near_for_type(F.col("a"), F.col("e"), T.ArrayType(T.ArrayType(T.DoubleType())))


def test_decimal_keeps_scale(spark):
    df = spark.createDataFrame([(Decimal("1.000000"), Decimal("1.000001")), (Decimal("100000.000000"), Decimal("100000.100000"))],
                               "a decimal(18,6), e decimal(18,6)")
    got = [r[0] for r in df.select(A.near_decimal(F.col("a"), F.col("e"))).collect()]
    # 1e-6 relative of 1.000001 is just above 1e-6: equal; 1e-6 of 100000.1 is 0.1000001 > 0.1: equal.
    assert got == [True, True]
    tight = df.select(A.near_decimal(F.col("a"), F.col("e"), abs=0.0000005)).collect()
    assert [r[0] for r in tight] == [False, False]


def test_compare_tables_self_has_no_mismatch(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").groupBy("l_partkey", "l_suppkey").agg(
        F.sum("l_extendedprice").alias("p"), F.sum("l_quantity").alias("q"))
    summary = CMP.mismatch_summary(CMP.compare_tables(df, df, ["l_partkey", "l_suppkey"])).collect()
    assert all(r["n_mismatched"] == 0 and r["max_abs_diff"] is None for r in summary)


def test_summary_relative_rule(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 5.0)], "k int, x double")
    e = spark.createDataFrame([(1, 0.0), (2, 4.0)], "k int, x double")
    s = CMP.mismatch_summary(CMP.compare_tables(a, e, ["k"])).first()
    assert s["n_mismatched"] == 2 and s["max_abs_diff"] == 1.0 and math.isinf(s["max_rel_diff"])


def test_tolerance_text_matches_python(spark):
    df = spark.createDataFrame([(905.0,), (INF,), (0.3,)], "e double")
    got = [r[0] for r in df.select(A.tolerance_text(F.col("e"))).collect()]
    assert got == [f"905.0 ± {905.0 * 1e-6:.1e}", "inf", f"0.3 ± {0.3 * 1e-6:.1e}"]


def test_snapshot_delta_counts(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", None)], "k int, s string, x double")
    new = spark.createDataFrame([(1, "a", 1.5), (2, "B", 2.0), (4, "d", 0.0), (3, "c", None)], "k int, s string, x double")
    rows = sorted((r["k"], r["change"], r["column"], r["delta"]) for r in CMP.snapshot_delta(old, new, ["k"]).collect())
    assert rows == [(1, "changed", "x", 0.5), (2, "changed", "s", None), (4, "added", None, None)]


def test_array_mismatch_summary_divides_by_obtained(spark):
    df = spark.createDataFrame([([1.0, 0.0, 3.0], [1.0, 0.5, 2.0])], "a array<double>, e array<double>")
    s = df.select(CMP.array_mismatch_summary(F.col("a"), F.col("e"), lambda x, y: A.near(x, y))).first()[0]
    assert s["n_mismatched"] == 2 and s["n_total"] == 3
    assert s["max_abs_diff"] == 1.0 and math.isinf(s["max_rel_diff"])  # obtained 0 -> infinite


def test_duplicate_keys_never_pair_up(spark):
    # 50 copies of key 1 on each side would be 2,500 pairs; it must stay one key
    a = spark.createDataFrame([(1, float(i)) for i in range(50)] + [(2, 1.0)], "k int, x double")
    e = spark.createDataFrame([(1, float(i)) for i in range(50)] + [(2, 1.0)], "k int, x double")
    cells = CMP.compare_tables(a, e, ["k"]).collect()
    assert sorted((r["k"], r["status"], r["ok"]) for r in cells) == [(1, "duplicate_key", False), (2, "matched", True)]
    delta = CMP.snapshot_delta(a, e, ["k"]).collect()
    assert [(r["k"], r["change"]) for r in delta] == [(1, "duplicate_key")]


def test_compare_tables_with_containers(spark):
    a = spark.createDataFrame([(1, [0.1 + 0.2, 1.0], {"x": 0.1 + 0.2}), (2, [1.0], {"x": 1.0})],
                              "k int, v array<double>, m map<string,double>")
    e = spark.createDataFrame([(1, [0.3, 1.0], {"x": 0.3}), (2, [1.0, 2.0], {"y": 1.0})],
                              "k int, v array<double>, m map<string,double>")
    cells = {(r["k"], r["column"]): (r["ok"], r["expected"]) for r in CMP.compare_tables(a, e, ["k"]).collect()}
    assert cells[(1, "v")][0] is True and cells[(1, "m")][0] is True
    assert cells[(2, "v")] == (False, "[1.0,2.0]") and cells[(2, "m")] == (False, '{"y":1.0}')

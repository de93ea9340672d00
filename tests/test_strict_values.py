"""Text and dates under the comparison rules, rounding and casts that keep
digits, NULL keys, table fingerprints and glob classes."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabletrust.contract import Col, TableContract
from tabletrust.functions import approx as A
from tabletrust.functions import scalar as S
from tabletrust.operators import checks
from tabletrust.operators import compare as CMP
from tabletrust.operators import keyed as K


def test_text_compares_strictly(spark):
    df = spark.sql("""SELECT * FROM VALUES (array('a', 'b'), array('a', 'b'), map('k', 'foo'), map('k', 'foo'), 'foo', 'foo', true),
        (array('a', '1'), array('a', '1.0'), map('k', '1'), map('k', '1.0'), '1', '1.0', false), (array('a', NULL), array('a', NULL), map('k', NULL), map('k', NULL), NULL, NULL, true),
        (array('a', NULL), array('a', 'b'), map('k', NULL), map('k', 'b'), NULL, 'x', false) AS t(aa, ea, am, em, a, e, want)""")
    for rule, x, y in ((A.near_array, "aa", "ea"), (A.near_map, "am", "em"), (A.near, "a", "e")):
        assert all(r[0] == r[1] for r in df.select(rule(F.col(x), F.col(y)), "want").collect())
    mixed = spark.sql("SELECT 'abc' AS t, 1.0D AS x, array('1') AS ts, array(1.0D) AS xs")
    assert tuple(mixed.select(A.near(F.col("t"), F.col("x")), A.near(F.col("x"), F.col("t")), A.near_array(F.col("ts"), F.col("xs"))).first()) == (False, False, False)


def test_tables_with_containers_of_text_dates_and_decimals(spark):
    a = spark.sql("SELECT 1 AS k, array('x', 'y') AS t, map('a', 'b') AS m, array(date'2024-01-01') AS d, array(1.000000000001BD) AS n")
    e = spark.sql("SELECT 1 AS k, array('x', 'z') AS t, map('a', 'b') AS m, array(date'2024-01-01') AS d, array(1.000000000002BD) AS n")
    got = {r.column: r.ok for r in CMP.compare_tables(a, e, ["k"], rel=0.0, abs=1e-13).collect()}
    assert got == {"t": False, "m": True, "d": True, "n": False}
    assert {r.column: r.ok for r in CMP.compare_tables(a, e, ["k"]).collect()}["n"]


def test_rounding_keeps_the_digits_of_a_decimal(spark):
    wide = T.DecimalType(38, 12)
    df = spark.createDataFrame([(Decimal("1.123456789012"), d) for d in range(-30, 45)], T.StructType([T.StructField("v", wide), T.StructField("d", T.IntegerType())]))
    out = df.select("d", S.round_to(F.col("v"), F.col("d"), wide).alias("r"))
    assert out.schema["r"].dataType == wide
    for r in out.collect():
        want = Decimal("1.123456789012") if r.d >= 12 else Decimal("1.123456789012").quantize(Decimal(1).scaleb(-r.d), "ROUND_HALF_UP")
        assert r.r == want, r


def test_text_that_loses_digits_is_rejected(spark):
    c = TableContract("t", (Col("a", "decimal(10,2)"), Col("x", "double", lo=0)))
    rows = [("1.23", "1"), ("1.230", "1"), ("1.239", "1"), (" -7 ", "0"), ("1e-3", "1"), ("1.5e1", "1"), ("x", "1"), (None, None), ("2", "NaN"), ("3", "-1")]
    good, bad = checks.safe_cast(spark.createDataFrame(rows, "a string, x string"), c)
    assert sorted(map(str, (r.a for r in good.collect()))) == sorted(["1.23", "1.23", "-7.00", "15.00", "None"])
    assert {r.a: r.reasons for r in bad.collect()} == {"1.239": ["a:lossy"], "1e-3": ["a:lossy"], "x": ["a:unconvertible"], "2": ["x:out_of_range"], "3": ["x:out_of_range"]}


def test_null_keys_are_deleted(spark):
    t = spark.createDataFrame([(None, "a"), (1, "b"), (2, "c")], "k int, v string")
    gone = spark.createDataFrame([(None,), (1,)], "k int")
    assert [tuple(r) for r in K.delete_keys(t, gone, ["k"], strict=True).collect()] == [(2, "c")]
    with pytest.raises(KeyError):
        K.delete_keys(t.where("k is not null"), gone, ["k"], strict=True)


def test_fingerprints_are_of_multisets(spark):
    base = "SELECT * FROM VALUES (map('a', 1, 'b', 2), array(1, NULL), struct('x' AS s, 0.0D AS d)), (map('c', 3), array(NULL, 1), struct(NULL AS s, 1.0D AS d)) AS t(m, a, s)"
    t = spark.sql(base)
    turned = spark.sql("SELECT * FROM VALUES (map('c', 3), array(NULL, 1), struct(NULL AS s, 1.0D AS d)), (map('b', 2, 'a', 1), array(1, NULL), struct('x' AS s, -0.0D AS d)) AS t(m, a, s)")
    assert K.same_rows(t, turned) and not K.same_rows(t, t.union(t)) and not K.same_rows(t, t.limit(1))
    for other in (base.replace("array(1, NULL)", "array(NULL, 1)"), base.replace("struct('x'", "struct(NULL"), base.replace("'b', 2", "'b', 3"), base.replace("array(NULL, 1)", "array(1)")):
        assert not K.same_rows(t, spark.sql(other))
    halves = [K.table_fingerprint(t.where(c)) for c in ("a[0] = 1", "a[0] is null")]
    added = halves[0].union(halves[1]).agg(F.sum("n_rows"), F.sum("sum_a"), F.sum("sum_b")).first()
    assert tuple(added) == tuple(K.table_fingerprint(t).first())
    empty = t.where("false")
    assert K.same_rows(empty, empty) and not K.same_rows(empty, t) and K.same_rows(spark.sql("SELECT 1 AS a"), spark.sql("SELECT 1L AS b"))


def test_glob_classes(spark):
    state = spark.createDataFrame([(k, "1") for k in ("a", "b", "^", "-", "&", "x/a")], "key string, value string")
    found = lambda p: sorted(r.key for r in K.kv_list(state, p).collect())
    assert found("[^a]") == ["^", "a", "x/a"] and found("[!^a]") == ["&", "-", "b"] and found("[a&&b]") == ["&", "a", "b", "x/a"] and found("[a-b]") == ["a", "b", "x/a"]

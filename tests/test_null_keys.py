"""NULL is a key like any other: nothing differs from itself."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabletrust.functions import approx as A
from tabletrust.functions import scalar as S
from tabletrust.operators import checks as C
from tabletrust.operators import compare as CMP
from tabletrust.operators import keyed as K
from tabletrust.operators import retention as RT


@pytest.fixture(scope="module")
def x(spark):
    return spark.createDataFrame([(None, "a", 1.0), (1, None, 2.0), (None, None, 3.0), (2, "b", None)], "k int, g string, v double")


def test_self_comparisons_are_empty(x):
    assert CMP.compare_tables(x, x, ["k", "g"]).where("not ok").isEmpty()
    assert CMP.snapshot_delta(x, x, ["k", "g"]).isEmpty()
    assert tuple(K.keyset_diff(x, x, ["k", "g"]).first()) == (0, 0, True)
    assert C.reconcile(x, x, ["k", "g"], "v", "v").isEmpty()


def test_changes_of_null_keyed_rows_are_found(spark, x):
    y = x.withColumn("v", F.when(F.col("k").isNull() & (F.col("g") == "a"), 9.0).otherwise(F.col("v")))
    assert [tuple(r) for r in CMP.snapshot_delta(x, y, ["k", "g"]).collect()] == [(None, "a", "changed", "v", 8.0)]
    stamped = x.withColumn("s", F.lit("old"))
    out = CMP.touch_on_change(stamped, y.withColumn("s", F.lit("?")), ["k", "g"], "s", now=F.lit("new"))
    assert sorted((r["k"] is None, r["g"] or "", r["s"], r["touched"]) for r in out.collect()) == [
        (False, "", "old", False), (False, "b", "old", False), (True, "", "old", False), (True, "a", "new", True)]
    diff = C.reconcile(x.where("k is null"), y.where("k is not null"), ["k", "g"], "v", "v")
    assert sorted((r["k"] is None, r["g"] or "", r["stored"], r["actual"]) for r in diff.collect()) == [
        (False, "", 0, 2), (True, "", 3, 0), (True, "a", 1, 0)]


def test_numbers_go_on_after_a_null_prefix(spark):
    old = spark.createDataFrame([(None, 4), ("p", 7)], "prefix string, n int")
    new = spark.createDataFrame([(None, 1), (None, 2), ("p", 3), ("q", 4)], "prefix string, id int")
    got = sorted((r["prefix"] or "", r["id"], r["number"]) for r in RT.next_numbers(old, new, "prefix", "n", ["id"]).collect())
    assert got == [("", 1, 5), ("", 2, 6), ("p", 3, 8), ("q", 4, 0)]


def test_columns_with_underscores_stay(spark):
    t = spark.createDataFrame([(1, "x", "y")], "k int, __a string, __src string")
    u = spark.createDataFrame([(1, "z", "w"), (2, "v", "u")], t.schema)
    assert sorted(tuple(r) for r in K.upsert(t, u, ["k"]).select("k", "__a", "__src").collect()) == [(1, "z", "w"), (2, "v", "u")]
    assert sorted(tuple(r) for r in K.insert_if_absent(t, u, ["k"]).select("k", "__a", "__src").collect()) == [(1, "x", "y"), (2, "v", "u")]


def test_path_patterns(spark):
    keys = ["lastfailed", "cache/lastfailed", "a/b", "a/b/c", "x/a/b", "a.b", "d/e1", "d/e12", "d[1]/x"]
    state = spark.createDataFrame([(k, "1") for k in keys], "key string, value string")

    def hits(pattern):
        return [r["key"] for r in K.kv_list(state, pattern).collect()]

    assert hits("lastfailed") == ["cache/lastfailed", "lastfailed"]
    assert hits("a/*") == ["a/b", "x/a/b"]
    assert hits("*") == sorted(keys)
    assert hits("a/**/c") == ["a/b/c"] and hits("a/**") == ["a/b", "a/b/c", "x/a/b"]
    assert hits("e?") == ["d/e1"] and hits("[de]/e[!2]") == ["d/e1"] and hits("a.b") == ["a.b"]


def test_integers_compare_exactly(spark):
    df = spark.createDataFrame([(9007199254740993, 9007199254740992), (-(2**63), 2**63 - 1), (5, 5), (7, 6)], "a bigint, e bigint")
    got = [tuple(r) for r in df.select(A.near(F.col("a"), F.col("e"), abs=0), A.near(F.col("a"), F.col("e"), abs=1)).collect()]
    assert got == [(False, True), (False, False), (True, True), (False, True)]


def near_rule(a, e, rel, abs_):
    rel = None if rel is None else Decimal(str(rel))
    least = Decimal(str(1e-12 if abs_ is None else abs_))
    tol = least if rel is None and abs_ is not None else max((Decimal("0.000001") if rel is None else rel) * abs(e), least)
    return abs(e - a) <= tol


TOLERANCES = [(None, None), (1, None), (None, 1), (1e-7, None), (0, 0), (None, 2.5), (0.25, 0.5), ("0.000000001", 0)]
NARROW = [(t, T.DecimalType(*p)) for t in TOLERANCES for p in ((18, 6), (26, 13))]
WIDE = [((None, None), T.DecimalType(38, 12)), ((1e-7, 2.5), T.DecimalType(38, 12)), ((None, 1), T.DecimalType(38, 0)), (("0.000000001", 0), T.DecimalType(38, 17))]


@pytest.mark.parametrize("tolerances,dtype", NARROW + WIDE)
def test_decimals_compare_exactly(spark, tolerances, dtype):
    import decimal
    import random

    decimal.getcontext().prec = 120
    rel, abs_ = tolerances
    rel = Decimal(rel) if isinstance(rel, str) else rel
    rng, unit = random.Random(1), Decimal(1).scaleb(-dtype.scale)
    values = [Decimal(n) for n in (0, 1, -1, 10**13, 1000000, -1000000, 99)] + [unit, -unit, 4 * Decimal(10) ** (dtype.precision - dtype.scale - 1) - unit]
    pairs = [(a, e) for a in values for e in values]
    for _ in range(150):
        e = Decimal(rng.randrange(-10**14, 10**14)).scaleb(-rng.randrange(0, dtype.scale + 1)).quantize(unit)
        share = Decimal(str(rel if rel is not None else 1e-6))
        edge = (abs(e) * share).quantize(unit, rounding=decimal.ROUND_FLOOR)
        pairs += [(e + edge, e), (e + edge + unit, e), (e - edge, e), (e - edge - unit, e), (e + 1, e)]
    limit = Decimal(10) ** (dtype.precision - dtype.scale)
    pairs = [(a.quantize(unit), e.quantize(unit)) for a, e in pairs if abs(a) < limit and abs(e) < limit]
    schema = T.StructType([T.StructField("a", dtype), T.StructField("e", dtype)])
    got = [r[0] for r in spark.createDataFrame(pairs, schema).select(A.near_decimal(F.col("a"), F.col("e"), rel, abs_, dtype)).collect()]
    assert got == [near_rule(a, e, rel, abs_) for a, e in pairs]


def test_decimals_that_do_not_fit_raise(spark):
    df = spark.sql("SELECT CAST('0.00000000000001' AS decimal(38,20)) AS a, CAST(0 AS decimal(38,20)) AS e")
    with pytest.raises(Exception, match="not a decimal"):
        df.select(A.near_decimal(F.col("a"), F.col("e"))).collect()
    small = T.DecimalType(26, 20)
    assert df.select(A.near_decimal(F.col("a").cast(small), F.col("e").cast(small), dtype=small)).first()[0] is True
    with pytest.raises(ValueError):
        A.near_decimal(F.col("a"), F.col("e"), rel=1e-13)
    with pytest.raises(ValueError):
        A.near_decimal(F.col("a"), F.col("e"), dtype=T.DecimalType(38, 38))
    tiny = spark.sql("SELECT 0.0000004BD AS a, 0BD AS e")
    assert tiny.select(A.near_decimal(F.col("a"), F.col("e"))).first()[0] is False


def test_round_to_any_digits(spark):
    df = spark.createDataFrame([(2.5, 0), (1234.5678, 2), (1234.5678, -2), (1.23e-20, 22), (1.5, 20), (1.5, 400), (1234.0, -9), (None, 1), (1.5, None)], "v double, d int")
    got = [r[0] for r in df.select(S.round_to(F.col("v"), F.col("d"))).collect()]
    assert got == [3.0, 1234.57, 1200.0, 1.23e-20, 1.5, 1.5, 0.0, None, None]
    with pytest.raises(Exception, match="so few decimals"):
        spark.sql("SELECT 1.0D AS v, -10 AS d").select(S.round_to(F.col("v"), F.col("d"))).collect()

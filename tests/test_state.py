"""Keyed state, retention and numbering."""

import pytest
from pyspark.sql import functions as F

from tabletrust.operators import keyed as K
from tabletrust.operators import retention as RT
from tabletrust.operators.numbering import number_rows


def test_upsert_last_write_wins_and_is_idempotent(spark):
    t = spark.createDataFrame([("a", "1", 1), ("b", "2", 1)], "key string, value string, ver int")
    u = spark.createDataFrame([("a", "9", 2), ("c", "3", 2), ("b", "old", 0)], "key string, value string, ver int")
    once = K.upsert(t, u, ["key"], order="ver")
    twice = K.upsert(once, u, ["key"], order="ver")
    want = [("a", "9", 2), ("b", "2", 1), ("c", "3", 2)]
    assert sorted(tuple(r) for r in once.collect()) == want
    assert sorted(tuple(r) for r in twice.collect()) == want


def test_insert_if_absent_keeps_existing(spark):
    t = spark.createDataFrame([("a", "1", 1)], "key string, value string, ver int")
    u = spark.createDataFrame([("a", "9", 2), ("c", "3", 5), ("c", "4", 3)], "key string, value string, ver int")
    got = sorted(tuple(r) for r in K.insert_if_absent(t, u, ["key"], order="ver").collect())
    assert got == [("a", "1", 1), ("c", "4", 3)]


def test_delete_strict(spark):
    t = spark.createDataFrame([("a", "1")], "key string, value string")
    gone = spark.createDataFrame([("zz",)], "key string")
    assert K.delete_keys(t, gone, ["key"]).count() == 1
    with pytest.raises(KeyError):
        K.delete_keys(t, gone, ["key"], strict=True)


def test_kv_get_defaults_and_list(spark):
    s = spark.createDataFrame([("cache/a", '{"x": 1}'), ("cache/b", "{broken"), ("other", "[]")], "key string, value string")
    keys = spark.createDataFrame([("cache/a",), ("cache/b",), ("cache/c",)], "key string")
    got = {r["key"]: (r["found"], r["readable"], r["value"]) for r in K.kv_get(keys, s, default="{}").collect()}
    assert got == {"cache/a": (True, True, '{"x": 1}'), "cache/b": (True, False, "{}"), "cache/c": (False, False, "{}")}
    listed = K.kv_list(s, "cache/*").collect()
    assert [(r["key"], r["readable"]) for r in listed] == [("cache/a", True), ("cache/b", False)]
    assert [r["key"] for r in K.kv_list(s).collect()] == ["cache/a", "cache/b", "other"]


def test_keep_newest_policies(spark):
    df = spark.createDataFrame([("g", i, i % 2 == 0) for i in range(6)], "g string, t int, passed boolean")
    assert [r["t"] for r in RT.keep_newest(df, "g", "t", n=3).orderBy("rank").collect()] == [5, 4, 3]
    assert [r["t"] for r in RT.keep_newest(df, "g", "t", n=2, policy="failed", passed=F.col("passed")).collect()] == [5, 3]
    assert RT.keep_newest(df, "g", "t", n=3, policy="none").count() == 0
    with pytest.raises(ValueError):
        RT.keep_newest(df, "g", "t", n=-1)
    with pytest.raises(ValueError):
        RT.keep_newest(df, "g", "t", policy="some")


def test_number_rows_hot_group_matches_pandas(spark):
    # one group holds most rows: the numbering must still be exact
    rows = [("hot", i) for i in range(3000)] + [("cold%d" % (i % 7), i) for i in range(200)] + [(None, i) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, o int").repartition(5)
    out = number_rows(df, ["o"], ["g"], partitions=6).collect()
    by = {}
    for r in out:
        by.setdefault(r["g"], []).append((r["o"], r["rn"]))
    for g, pairs in by.items():
        pairs.sort()
        assert [rn for _, rn in pairs] == list(range(1, len(pairs) + 1)), g


def test_next_numbers_and_assign_keys(spark):
    existing = spark.createDataFrame([("foo-", 0), ("foo-", 3)], "prefix string, n int")
    new = spark.createDataFrame([("foo-", "x"), ("foo-", "y"), ("bar-", "z")], "prefix string, item string")
    got = sorted((r["prefix"], r["item"], r["number"]) for r in RT.next_numbers(existing, new, "prefix", "n", ["item"]).collect())
    assert got == [("bar-", "z", 0), ("foo-", "x", 4), ("foo-", "y", 5)]
    keyed = spark.createDataFrame([(0, "a"), (5, "b"), (None, "c"), (None, "d")], "id long, v string")
    got = sorted((r["v"], r["id"]) for r in RT.assign_keys(keyed, "id", ["v"]).collect())
    assert got == [("a", 0), ("b", 5), ("c", 6), ("d", 7)]


def test_latest_and_first_per_key(spark):
    df = spark.createDataFrame([("k", 1, "x"), ("k", 3, "y"), ("k", 2, "z")], "k string, t int, v string")
    assert RT.latest_per_key(df, ["k"], ["t"]).first()["v"] == "y"
    assert RT.first_per_key(df, ["k"], ["t"]).first()["v"] == "x"


def test_keyset_diff(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,), (3,)], "k int")
    r = K.keyset_diff(a, b).first()
    assert (r["only_before"], r["only_after"], r["equal"]) == (1, 1, False)


def test_write_if_changed(spark):
    from tabletrust.session import scratch_path

    path = scratch_path(spark, "publish")
    a = spark.createDataFrame([("k", True)], "node_id string, failing boolean")
    assert K.write_if_changed(a, None, path) is True
    old = spark.read.parquet(path)
    assert K.write_if_changed(spark.createDataFrame([("k", True)], a.schema), old, path) is False
    assert K.write_if_changed(spark.createDataFrame([("k", False)], a.schema), old, path + "-v2") is True


def test_escaped_preview_and_map_get(spark):
    from tabletrust.functions.scalar import escaped, escaped_text, map_get

    df = spark.createDataFrame([("a\tbé\x0e",), (None,)], "t string")
    got = [r[0] for r in df.select(escaped(F.col("t"))).collect()]
    assert got == ["a\\tb\\xe9\\x0e", None] and escaped_text("〨") == "\\u3028"
    m = spark.createDataFrame([({"a": 1, "b": None},)], "m map<string,int>")
    row = m.select(map_get(F.col("m"), "a", -1), map_get(F.col("m"), "b", -1), map_get(F.col("m"), "c", -1)).first()
    assert tuple(row) == (1, None, -1)


def test_run_level_removal(spark):
    runs = spark.createDataFrame([(1, 0, False), (2, 1, False), (3, 0, True), (4, 0, None)],
                                 "run int, exit_status int, given_base boolean")
    assert sorted(r["run"] for r in RT.runs_to_remove(runs, "failed").collect()) == [1, 4]
    assert RT.runs_to_remove(runs, "all").count() == 0
    with pytest.raises(ValueError):
        RT.runs_to_remove(runs, "bogus")


def test_drop_passed_uses_call_phase(spark):
    df = spark.createDataFrame([("a", {"setup": True, "call": True}), ("b", {"setup": True, "call": False}),
                                ("c", {"setup": False}), ("d", {"call": None})], "node string, phases map<string,boolean>")
    assert [r["node"] for r in RT.drop_passed(df).collect()] == ["b"]


def test_lookup_without_broadcast_and_self_reference(spark):
    from tabletrust.operators import lookup as L

    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "code int, v string")
    codes = spark.createDataFrame([(1, "one"), (2, "two"), (2, "zwei")], "k int, name string")
    got = sorted((r["code"], r["name"]) for r in L.lookup(df, codes, "code", "k", "name").collect())
    assert got == [(1, "one"), (2, "two"), (3, None)]
    rows = spark.createDataFrame([(1, None, 10), (2, 1, 20), (2, 1, 21), (3, 2, 30)], "id int, ref int, amount int")
    out = sorted((r["id"], r["src_amount"]) for r in L.imputation_source(rows, ["id"], ["ref"], ["amount"], order=["amount"]).collect())
    # id 2 is duplicated: its source row is reduced to one (lowest amount), nothing multiplies
    assert out == [(1, None), (2, 10), (2, 10), (3, 20)]

"""INSERT dump reading: the shapes found in dump files."""

import pytest

from tabletrust.contract import Col, TableContract
from tabletrust.session import scratch_path
from tabletrust.sources import dump as D

T2 = TableContract("t", (Col("id", "int", False), Col("name", "string"), Col("n", "bigint")), primary_key=("id",))

DUMP = (
    "-- comment only line\n"
    "/*!40101 SET NAMES utf8 */;\n"
    "INSERT INTO `t` VALUES ('1', 'plain', '7');\n"
    "INSERT INTO `t` VALUES\n(2,'multi',8),\n(3,'line',NULL);\n"
    "INSERT INTO `other` VALUES (9,'skip',1);\n"
    "INSERT INTO `t` VALUES (4,'it\\'s \"quoted\"',1),(5,'semi; colon',2),(6,'back\\\\slash\\nnl',3);\n"
    "INSERT INTO `t` VALUES (NULL);\n"
    "INSERT INTO `t` VALUES (7,'broken,1);\n"
)


def tuples(text, table="t"):
    return [(vals, error) for _, _, vals, error in D.read_tuples(text, table)]


def test_read_tuples_unit():
    rows = tuples("INSERT INTO t VALUES (1,'a\\'b',NULL),( 2 , \"x\" , '')")
    assert rows == [(["1", "a'b", None], None), (["2", "x", ""], None)]
    (vals, error), = tuples("INSERT INTO t VALUES (1,'open)")
    assert vals is None and "unbalanced quote in tuple 0 at offset 21" in error


@pytest.mark.parametrize("text,good,bad", [
    ("INSERT INTO `t` VALUES (1,'a');\r\nINSERT INTO `t` VALUES (2,'b');\r\n", ["1", "2"], 0),
    ("INSERT INTO t VALUES (1,'a'); INSERT INTO t VALUES (2,'b;c');INSERT INTO u VALUES (3,'x'); INSERT INTO t VALUES (4,'d')", ["1", "2", "4"], 0),
    ("/* INSERT INTO t VALUES (0,'z'); */ -- x;\nINSERT INTO db.t VALUES (1,'it''s'),(2,'b') ;", ["1", "2"], 0),
    ("INSERT INTO t VALUES (1,'x'),(2,'y'),(3,'broken,1),(4,'z'),(5,'w');", ["1", "2", "4", "5"], 1),
    ("INSERT INTO t VALUES (1,'x'),(2 'y'),(,),(4,'z') junk (5,'w');\nINSERT INTO t VALUES (6,'v');", ["1", "4", "6"], 3),
    ("INSERT INTO t SELECT 1;INSERT INTO t VALUES (1,'a');", ["1"], 1),
])
def test_everything_is_read_or_rejected(text, good, bad):
    rows = tuples(text)
    assert [vals[0] for vals, error in rows if error is None] == good
    assert sum(error is not None for _, error in rows) == bad


def test_column_lists_and_lengths(spark):
    path = scratch_path(spark, "dump-cols")
    text = ("INSERT INTO t (name, id) VALUES ('7','8'),('x','9');\nINSERT INTO t (`ID`,`n`) VALUES (10,5);\n"
            "INSERT INTO t (id, nope) VALUES (11,1);\nINSERT INTO t (id) VALUES (12,1);\n")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    good, bad = D.read_insert_dump(spark, path, "t", T2)
    assert sorted((r["id"], r["name"], r["n"]) for r in good.collect()) == [(8, "7", None), (9, "x", None), (10, None, 5)]
    assert sorted(r["reasons"][0] for r in bad.collect()) == ["expected 1 values, got 2", "unknown column nope"]


def test_microseconds_survive_the_round_trip(spark):
    when = TableContract("t", (Col("id", "int", False), Col("at", "timestamp_ntz")))
    df = spark.sql("SELECT 1 AS id, timestamp_ntz'2024-01-02 10:00:00.123456' AS at UNION ALL SELECT 2, timestamp_ntz'2024-01-02 10:00:00'")
    path = scratch_path(spark, "dump-us")
    D.write_insert_dump(df, path, "t")
    good, bad = D.read_insert_dump(spark, path, "t", when)
    assert bad.isEmpty() and sorted(good.select("id", "at").collect()) == sorted(df.collect())


def test_refresh_needs_every_rule_checked(spark):
    base = scratch_path(spark, "refresh-unchecked")
    published, report = D.full_refresh(spark.sql("SELECT 1 AS id, 5L AS n"), f"{base}/t", TableContract(
        "t", (Col("id", "int", False), Col("name", "string", False), Col("n", "bigint", lo=0))), f"{base}/staging")
    assert not published and [r["n_violations"] for r in report.where("col = 'name'").collect()] == [None]


def test_read_dump(spark):
    path = scratch_path(spark, "dump-test")
    spark.createDataFrame([(DUMP,)], "value string").coalesce(1).write.text(path)
    # the text writer adds a trailing newline after the last statement
    good, bad = D.read_insert_dump(spark, path, "t", T2)
    g = sorted((r["id"], r["name"], r["n"]) for r in good.collect())
    assert g == [(1, "plain", 7), (2, "multi", 8), (3, "line", None), (4, "it's \"quoted\"", 1),
                 (5, "semi; colon", 2), (6, "back\\slash\nnl", 3)]
    reasons = sorted(r["reasons"][0] for r in bad.collect())
    assert len(reasons) == 2
    assert any("expected 3 values" in r for r in reasons)
    assert any("unbalanced" in r or "unterminated" in r for r in reasons)


def test_write_then_read_round_trip(spark):
    df = spark.createDataFrame([(1, "a'b\\c\nd", 5), (2, None, None)], "id int, name string, n bigint")
    path = scratch_path(spark, "dump-rt")
    D.write_insert_dump(df, path, "t", tuples_per_statement=1)
    good, bad = D.read_insert_dump(spark, path, "t", T2)
    assert bad.count() == 0
    assert sorted(tuple(r) for r in good.select("id", "name", "n").collect()) == [(1, "a'b\\c\nd", 5), (2, None, None)]


def test_full_refresh_refuses_broken_contract(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "id int, name string, n bigint")
    base = scratch_path(spark, "refresh")
    published, report = D.full_refresh(df, f"{base}/t", T2, f"{base}/staging")
    assert not published
    assert report.where("rule = 'primary_key'").first()["n_violations"] == 1
    with pytest.raises(Exception):
        spark.read.parquet(f"{base}/t").count()

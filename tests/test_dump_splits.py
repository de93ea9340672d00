"""Dumps read in splits, against the serial reader on the whole text."""

import random

import pytest

from tabletrust.contract import Col, TableContract
from tabletrust.session import scratch_path
from tabletrust.sources import dump as D
from tabletrust.sources import dump_splits as S

T3 = TableContract("t", (Col("id", "bigint", False), Col("name", "string"), Col("n", "bigint")), primary_key=("id",))


@pytest.fixture
def small_splits(spark):
    """Splits of some hundred bytes, so that a short text is many of them."""
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "4"}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def put(spark, *texts):
    path = scratch_path(spark, "dump-splits")
    for i, text in enumerate(texts):
        # One file of exactly this text: rows end with what the text source writes last.
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\x00").text(f"{path}/{i}")
    return [f"{path}/{i}" for i in range(len(texts))]


def value(rng):
    return rng.choice([
        "NULL", str(rng.randint(-9, 10**6)), "'plain'", "'a),(b'", "'it\\'s; (1,2),('", "'x''y),('", "'-- no comment'", "'/* nor this'", "'semi;\nINSERT INTO t VALUES (1,2,3);\n'",
        "'back\\\\'", "'line\nbreak)'", "\"double ' quote\"", "'" + "long ) text " * rng.randint(1, 90) + "'", "'é漢)('", "''"])


def statement(rng, table="t"):
    head = rng.choice(["INSERT INTO `{}` VALUES", "insert into db.{} (id, name, n) values", "INSERT LOW_PRIORITY INTO {} VALUES\n", "REPLACE INTO {} VALUES", "INSERT HIGH_PRIORITY IGNORE INTO `{}` VALUES "])
    tuples = [f"({rng.randint(1, 10**9)},{value(rng)},{rng.choice(['NULL', '7', str(rng.randint(0, 99))])})" for _ in range(rng.randint(1, 60))]
    return head.format(table) + rng.choice([" ", "\n"]) + rng.choice([",", ", ", ",\n", " ,\n  "]).join(tuples) + rng.choice([";", " ;\n", ";\n", ";\r\n"])


def dump(rng):
    out = []
    for _ in range(rng.randint(1, 14)):
        out.append(rng.choice([
            statement(rng), statement(rng), statement(rng), statement(rng, "other"), "-- don't (open, a quote),(\n", "/* it's (1),(2); */\n", "/*!40101 SET NAMES utf8 */;\n",
            "CREATE TABLE t (id int(10) DEFAULT '(0)', name varchar(5), PRIMARY KEY (id));\n", "LOCK TABLES `t` WRITE;\n", "# (a),(b)'\n", "\n"]))
    return "".join(out)


def serial(text):
    return sorted(((c, v, e is not None) for _, c, v, e in D.read_tuples(text, "t")), key=repr)


@pytest.mark.parametrize("seed", range(9))
def test_splits_read_as_the_whole(spark, small_splits, seed):
    rng = random.Random(seed)
    texts = [dump(rng) for _ in range(2)]
    for path, text in zip(put(spark, *texts), texts, strict=True):
        got = S.split_tuples(spark, path, "t").collect()
        text += "\x00"
        assert sorted(((r.cols, r.vals, r.error is not None) for r in got), key=repr) == serial(text)


def test_one_statement_is_read_by_many_tasks(spark, small_splits):
    rng = random.Random(9)
    text = "INSERT INTO t (id, name, n) VALUES " + ",".join(f"({i},'v;\n{'x' * rng.randint(0, 40)}),({i}',{i})" for i in range(2000)) + ";\n"
    path, = put(spark, text)
    tuples = S.split_tuples(spark, path, "t")
    assert S._records(spark, path).rdd.getNumPartitions() > 50
    assert sorted(int(r.vals[0]) for r in tuples.collect()) == list(range(2000))
    assert tuples.select("stmt_id").distinct().count() > 50
    good, bad = D.read_insert_dump(spark, path, "t", T3, record_end=None)
    assert bad.isEmpty() and good.count() == 2000 and good.where("name not like 'v;\n%'").isEmpty()


@pytest.mark.parametrize("end", ["", ")", ";", ");", ",(8,'cut", ",(8,'cut','", ",(8,'cut',1"])
def test_files_that_end_early(spark, small_splits, end):
    text = "INSERT INTO t VALUES " + ",".join(f"({i},'{'y' * 30}',{i})" for i in range(40)) + end
    path = scratch_path(spark, "dump-end")
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.option("lineSep", "\n").text(path)
    got = S.split_tuples(spark, path, "t").collect()
    assert sorted(((r.cols, r.vals, r.error is not None) for r in got), key=repr) == serial(text + "\n")


def test_modifiers_and_unreadable_statements():
    text = ("INSERT LOW_PRIORITY INTO t VALUES (1,'a');INSERT HIGH_PRIORITY IGNORE INTO t VALUES (2,'b');REPLACE DELAYED INTO t (x) VALUES (3);"
            "INSERT t VALUES (4,'d');INSERT DELAYED INTO t SELECT 5;")
    rows = [(v, e) for _, _, v, e in D.read_tuples(text, "t")]
    assert [v[0] for v, e in rows if e is None] == ["1", "2", "3", "4"] and sum(e is not None for _, e in rows) == 1


def test_statement_files_round_trip(spark, small_splits):
    df = spark.range(500).selectExpr("id", "concat('a;\n', repeat('z', int(id % 50)), '\\'),(') AS name", "id * 2 AS n")
    path = scratch_path(spark, "dump-statements")
    D.write_statement_files(df.repartition(3), path, "t")
    good, bad = D.read_insert_dump(spark, path, "t", T3, record_end=None)
    assert bad.isEmpty() and sorted(map(tuple, good.select("id", "name", "n").collect())) == sorted(map(tuple, df.collect()))

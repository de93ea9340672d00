"""C11 by files: the merged report is the report of all rows, and files that
the state knows are not read again."""

from tabletrust.contract import Col, ForeignKey, Implies, TableContract
from tabletrust.operators import checks, incremental

ORDERS = TableContract(
    "orders",
    (Col("id", "bigint", False), Col("name", "string", max_length=5, ci=True), Col("price", "double", lo=0), Col("cust", "int")),
    primary_key=("id",),
    unique=(("name",),),
    foreign_keys=(ForeignKey(("cust",), "customer", ("c_id",)),),
    implies=(Implies("priced", "cust IS NOT NULL", "price IS NOT NULL"),),
)
SCHEMA = "id bigint, name string, price double, cust int"
FILES = {
    "a": [(1, "Ann", 1.0, 1), (2, "bob", -2.0, 2), (2, None, None, 9)],
    "b": [(1, "ANN", 3.0, None), (None, "é", float("nan"), 9)],
    "c": [(7, "É", 1.0, 1), (None, "longer", 0.0, 8), (3, None, None, None)],
}


def write(spark, base, name, rows=None):
    path = f"{base}/{name}"
    spark.createDataFrame(FILES[name] if rows is None else rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def report(df):
    return sorted((r.tbl, r.rule, r.col, r.n_violations) for r in df.collect())


def test_report_by_files_is_the_full_report(spark, tmp_path):
    customer = spark.createDataFrame([(1,), (2,), (2,)], "c_id int")
    parents = {"customer": customer}
    state = str(tmp_path / "state")

    def check(paths):
        got = report(incremental.incremental_report(spark, paths, ORDERS, state, parents))
        assert got == report(checks.contract_report(spark.read.parquet(*paths), ORDERS, parents))
        return spark.read.parquet(state).count()

    a, b = write(spark, tmp_path, "a"), write(spark, tmp_path, "b")
    first = check([a, b])
    assert check([a, b]) == first  # nothing is read twice
    c = write(spark, tmp_path, "c")
    second = check([a, b, c])
    assert second > first
    assert check([b, c]) == check([c]) == second  # removed files
    write(spark, tmp_path, "b", [(7, "new", -1.0, 5)])  # a rewritten file
    assert check([a, b, c]) > second


def test_references_without_table_and_missing_columns(spark, tmp_path):
    a = write(spark, tmp_path, "a")
    got = report(incremental.incremental_report(spark, [a], ORDERS, str(tmp_path / "s1"), {}))
    assert got == report(checks.contract_report(spark.read.parquet(a), ORDERS, {}))
    fewer = f"{tmp_path}/fewer"
    spark.createDataFrame([(1, 2.0)], "id bigint, price double").coalesce(1).write.parquet(fewer)
    got = report(incremental.incremental_report(spark, [fewer], ORDERS, str(tmp_path / "s2"), {}))
    assert {r[3] for r in got if r[2] in ("name", "priced", "cust->customer(c_id)")} == {None}
    assert ("orders", "primary_key", "id", 0) in got and ("orders", "range", "price", 0) in got


def test_no_rows_and_known_files_stay_unread(spark, tmp_path):
    path = write(spark, tmp_path, "a", [])
    got = report(incremental.incremental_report(spark, [path], ORDERS, str(tmp_path / "s"), {"customer": spark.createDataFrame([], "c_id int")}))
    assert got and {r[3] for r in got} == {0}
    # A key with a part's end inside differs from its neighbour.
    pair = TableContract("t", (Col("x", "string"), Col("y", "string")), primary_key=("x", "y"))
    df = spark.createDataFrame([("a1:", "b"), ("a", "1:b")], "x string, y string")
    assert df.select(incremental.key_fingerprint(pair, ("x", "y"))).distinct().count() == 2


def test_state_is_narrow_and_not_shuffled_by_file(spark, tmp_path):
    a, state = write(spark, tmp_path, "a"), str(tmp_path / "s")
    got = incremental.incremental_report(spark, [a], ORDERS, state, {"customer": spark.createDataFrame([(1,)], "c_id int")})
    assert "hashpartitioning(file" not in got._jdf.queryExecution().toString()
    rows = spark.read.parquet(state).collect()
    assert {len(r.file) for r in rows} == {16}
    assert {bytes(r.key) for r in rows if r.rule == "primary_key"} == {b"1:1", b"1:2"}
    wide = TableContract("t", (Col("x", "string"),), primary_key=("x",))
    keys = spark.createDataFrame([("y" * 40,), ("y" * 41,), (None,)], "x string").select(incremental.key_fingerprint(wide, ("x",)).alias("k")).collect()
    assert sorted(len(r.k) for r in keys) == [1, 16, 16] and len({bytes(r.k) for r in keys}) == 3

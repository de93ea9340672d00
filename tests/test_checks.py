"""Contract checks, defaults and casts on hand-made frames with the
intake traps of the account and nutrient tables."""

from datetime import datetime

from pyspark.sql import functions as F

from tabletrust.contract import CURRENT_TIMESTAMP, Col, ForeignKey, Implies, Ordered, TableContract, unsigned
from tabletrust.operators import checks as C

ACCOUNT = TableContract(
    "account",
    (
        unsigned("id", 32, nullable=False),
        Col("username", "string", False, max_length=32, ci=True),
        Col("gmlevel", "smallint", False, lo=0, hi=255, has_default=True, default=0),
        Col("joindate", "timestamp", False, has_default=True, default=CURRENT_TIMESTAMP),
        Col("last_login", "timestamp", False),
    ),
    primary_key=("id",),
    unique=(("username",),),
)


def test_primary_key_duplicates_and_nulls(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (2, None), (3, 1)], "a int, b int")
    rows = sorted((r["a"], r["b"], r["n_rows"], r["reason"]) for r in C.check_primary_key(df, ["a", "b"]).collect())
    assert rows == [(1, 1, 2, "duplicate"), (2, None, 1, "null_key")]


def test_unique_case_insensitive_and_null_exempt(spark):
    df = spark.createDataFrame([("ADMIN",), ("admin",), (None,), (None,), ("Player",)], "username string")
    rows = C.check_unique(df, ["username"], ci=["username"]).collect()
    assert [(r["username"], r["n_rows"]) for r in rows] == [("admin", 2)]


def test_not_null_empty_string_is_not_null(spark):
    df = spark.createDataFrame([(1, ""), (2, None)], "id int, name string")
    assert [r["id"] for r in C.check_not_null(df, ["name"], ["id"]).collect()] == [2]


def test_foreign_key_null_passes(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 11), (4, 11)], "id int, fk int")
    parent = spark.createDataFrame([(10,)], "pk int")
    rows = C.check_foreign_key(child, ["fk"], parent, ["pk"]).collect()
    assert [(r["fk"], r["n_rows"]) for r in rows] == [(11, 2)]


def test_range_nan_fails_null_passes(spark):
    df = spark.createDataFrame([(1, 0.5), (2, float("nan")), (3, None), (4, -1.0), (5, 4294967296.0)],
                               "id int, v double")
    got = sorted(r["id"] for r in C.check_range(df, "v", 0, 4294967295, ["id"]).collect())
    assert got == [2, 4, 5]


def test_length_counts_characters(spark):
    df = spark.createDataFrame([(1, "é" * 32), (2, "x" * 33)], "id int, name string")
    assert [r["id"] for r in C.check_length(df, "name", 32, ["id"]).collect()] == [2]


def test_domain_implies_ordered(spark):
    fn = spark.createDataFrame(
        [(1, "D", "203", 1, 2, 3), (2, "X", None, 5, 4, 3), (3, "N", None, None, 1, 2), (4, None, None, 1, 1, 1)],
        "id int, footnt_typ string, nutr_no string, lo int, mid int, hi int")
    assert [r["id"] for r in C.check_domain(fn, "footnt_typ", ["D", "M", "N"], ["id"]).collect()] == [2]
    imp = C.check_implies(fn, "footnt_typ = 'N'", "nutr_no IS NOT NULL", ["id"]).collect()
    assert [r["id"] for r in imp] == [3]
    assert [r["id"] for r in C.check_ordered(fn, "lo", "mid", "hi", ["id"]).collect()] == [2]


def test_contract_report_includes_zero_rows(spark):
    contract = TableContract(
        "t", (Col("id", "int", False), Col("fk", "int"), Col("v", "double", lo=0), Col("s", "string", domain=("a",))),
        primary_key=("id",), foreign_keys=(ForeignKey(("fk",), "p", ("pk",)),),
        implies=(Implies("v_needs_s", "v > 1", "s IS NOT NULL"),), ordered=(Ordered("o", "0", "v", "10"),))
    df = spark.createDataFrame([(1, 1, 0.5, "a"), (1, 2, -1.0, "b"), (None, None, 2.0, None)], "id int, fk int, v double, s string")
    parent = spark.createDataFrame([(1,)], "pk int")
    rep = {(r["rule"], r["col"]): r["n_violations"] for r in C.contract_report(df, contract, {"p": parent}).collect()}
    assert rep[("not_null", "id")] == 1
    assert rep[("primary_key", "id")] == 2
    assert rep[("range", "v")] == 1
    assert rep[("domain", "s")] == 1
    assert rep[("implies", "v_needs_s")] == 1
    assert rep[("ordered", "o")] == 1
    assert rep[("foreign_key", "fk->p(pk)")] == 1


def test_defaults_fill_omitted_only(spark):
    df = spark.createDataFrame([(1, "a", None, datetime(2006, 4, 25))], "id bigint, username string, gmlevel smallint, last_login timestamp")
    out = C.apply_defaults(df, ACCOUNT).first()
    assert out["gmlevel"] is None  # explicit NULL stays
    assert out["joindate"] is not None  # omitted column gets CURRENT_TIMESTAMP


def test_safe_cast_zero_date_overflow_and_bad_values(spark):
    rows = [
        ("1", "ADMINISTRATOR", "3", "2006-04-25 10:18:56", "0000-00-00 00:00:00"),
        ("4294967296", "x", "0", "2006-04-25 10:18:56", "2006-04-25 10:18:56"),
        ("-1", "y", "0", "2006-04-25 10:18:56", "2006-04-25 10:18:56"),
        ("5", "z", "many", "2006-04-25 10:18:56", "2006-04-25 10:18:56"),
    ]
    df = spark.createDataFrame(rows, "id string, username string, gmlevel string, joindate string, last_login string")
    good, bad = C.safe_cast(df, ACCOUNT)
    g = good.collect()
    assert [r["id"] for r in g] == [1]
    assert g[0]["last_login"] is None and g[0]["notes"] == ["last_login:zero_date"]
    reasons = {r["id"]: r["reasons"] for r in bad.collect()}
    assert reasons == {"4294967296": ["id:out_of_range"], "-1": ["id:out_of_range"], "5": ["gmlevel:unconvertible"]}


def test_schema_diff(spark):
    df = spark.createDataFrame([(1, 5, 2)], "id bigint, username int, extra int")
    got = {(r["column"], r["change"]) for r in C.schema_diff(df, ACCOUNT).collect()}
    assert ("username", "retyped") in got and ("extra", "extra") in got and ("gmlevel", "missing") in got


def test_reconcile_missing_group_counts_zero(spark):
    stored = spark.createDataFrame([(1, 2), (2, 1)], "realmid int, numchars int")
    actual = spark.createDataFrame([(1, 2), (3, 4)], "realmid int, n int")
    rows = sorted((r["realmid"], r["stored"], r["actual"]) for r in
                  C.reconcile(stored, actual, ["realmid"], "numchars", "n").collect())
    assert rows == [(2, 1, 0), (3, 0, 4)]


def test_driver_table_facts(spark):
    from tabletrust.plans import REGISTRY

    sf = "/root/testdata/sf0.01"
    assert REGISTRY["pk_violations"].build(spark, sf).where("tbl = 'lineitem'").count() == 11785
    fk = REGISTRY["fk_orphans"].build(spark, sf)
    assert fk.where(F.col("reference") == "documents.doc_id->labels").count() == 601
    assert fk.where(F.col("reference") != "documents.doc_id->labels").count() == 0


def test_read_with_contract_text_source(spark):
    from tabletrust.plans.reference_contracts import FOODS
    from tabletrust.session import scratch_path
    from tabletrust.sources.tables import read_with_contract

    path = scratch_path(spark, "foods-csv")
    rows = ["01001,0100,Butter,BUTTER,,,,,0,,6.38,,,", "01002,0100,Cheese,CHEESE,,,,,lots,,6.38,,,"]
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.text(path)
    typed, rejected = read_with_contract(spark, path, FOODS, fmt="csv")
    assert [r["ndb_no"] for r in typed.collect()] == ["01001"]  # text code keeps its leading zero
    assert [(r["ndb_no"], r["reasons"]) for r in rejected.collect()] == [("01002", ["refuse:unconvertible"])]


def test_rule_over_missing_column_is_reported_unchecked(spark):
    contract = TableContract("t", (Col("a", "int"), Col("b", "int")),
                             ordered=(Ordered("a_le_b", "a", "a", "b"),), implies=(Implies("a_then_b", "a > 0", "b > 0"),))
    df = spark.createDataFrame([(1,)], "a int")
    rep = {(r["rule"], r["col"]): r["n_violations"] for r in C.contract_report(df, contract).collect()}
    assert rep == {("ordered", "a_le_b"): None, ("implies", "a_then_b"): None}

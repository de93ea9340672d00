"""Contract queries over the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabletrust.contract import CURRENT_TIMESTAMP, Col, TableContract
from tabletrust.operators import checks as C
from tabletrust.operators.incremental import incremental_report
from tabletrust.plans.catalog import Tables, query
from tabletrust.plans.driver_contracts import CUSTOMER, DRIVER_CONTRACTS, LINEITEM, ORDERS
from tabletrust.session import scratch_path
from tabletrust.sources.tables import read_with_contract


# -------------------------------------------------------------- oracle SQL text
def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def contract_report_sql(contract: TableContract, table: str | None = None) -> str:
    """The DuckDB statement of ``contract_report`` for one table."""
    t = table or contract.name
    parts = []

    def add(rule, col, count_sql):
        parts.append(f"SELECT '{rule}' AS rule, '{col}' AS col, ({count_sql}) AS n_violations")

    for c in contract.not_null():
        add("not_null", c, f"SELECT count(*) FROM {t} WHERE {c} IS NULL")
    for c in contract.columns:
        conds = []
        if c.lo is not None or c.hi is not None:
            if c.lo is not None:
                conds.append(f"{c.name} < {_sql_lit(c.lo)}")
            if c.hi is not None:
                conds.append(f"{c.name} > {_sql_lit(c.hi)}")
            if c.dtype in ("double", "float"):
                conds.append(f"isnan({c.name})")
            add("range", c.name, f"SELECT count(*) FROM {t} WHERE coalesce({' OR '.join(conds)}, false)")
        if c.max_length is not None:
            add("length", c.name, f"SELECT count(*) FROM {t} WHERE coalesce(length({c.name}) > {c.max_length}, false)")
        if c.domain is not None:
            vals = ", ".join(_sql_lit(v) for v in c.domain)
            add("domain", c.name, f"SELECT count(*) FROM {t} WHERE {c.name} IS NOT NULL AND {c.name} NOT IN ({vals})")
    for r in contract.implies:
        add("implies", r.name, f"SELECT count(*) FROM {t} WHERE coalesce({r.if_}, false) AND NOT coalesce({r.then_}, false)")
    for r in contract.ordered:
        add("ordered", r.name, f"SELECT count(*) FROM {t} WHERE coalesce(NOT ({r.lo} <= {r.mid} AND {r.mid} <= {r.hi}), false)")
    if contract.primary_key:
        k = ", ".join(contract.primary_key)
        nulls = " OR ".join(f"{c} IS NULL" for c in contract.primary_key)
        add("primary_key", ",".join(contract.primary_key),
            f"SELECT count(*) FROM (SELECT 1 FROM {t} GROUP BY {k} HAVING count(*) > 1 OR {nulls})")
    for fk in contract.foreign_keys:
        nn = " AND ".join(f"c.{c} IS NOT NULL" for c in fk.cols)
        on = " AND ".join(f"p.{p} = c.{c}" for c, p in zip(fk.cols, fk.parent_cols))
        add("foreign_key", fk.name,
            f"SELECT count(*) FROM {t} c WHERE {nn} AND NOT EXISTS (SELECT 1 FROM {fk.parent} p WHERE {on})")
    body = "\nUNION ALL\n".join(parts)
    return f"SELECT '{contract.name}' AS tbl, rule, col, CAST(n_violations AS BIGINT) AS n_violations FROM (\n{body}\n)"


def _parents(t: Tables, contract: TableContract) -> dict[str, DataFrame]:
    return {fk.parent: getattr(t, fk.parent) for fk in contract.foreign_keys}


# -------------------------------------------------------------- C11 flagship
def lineitem_report(spark, sf_dir) -> DataFrame:
    t = Tables(spark, sf_dir)
    return C.contract_report(t.lineitem, LINEITEM, _parents(t, LINEITEM))


query("contract_lineitem", ("C1", "C3", "C4", "C5", "C7", "C8", "C11"), contract_report_sql(LINEITEM))(lineitem_report)


@query(
    "contract_summary",
    ("C11", "C1", "C3", "C4", "C5", "C6", "C7"),
    "\nUNION ALL\n".join(contract_report_sql(c) for c in (ORDERS, CUSTOMER, LINEITEM)),
)
def contract_summary(spark, sf_dir):
    t = Tables(spark, sf_dir)
    reports = [C.contract_report(getattr(t, c.name), c, _parents(t, c)) for c in (ORDERS, CUSTOMER, LINEITEM)]
    return reduce(DataFrame.unionByName, reports)


@query("contract_incremental", ("C11", "C1", "C4"), contract_report_sql(LINEITEM))
def contract_incremental(spark, sf_dir):
    """``lineitem`` in files: some that stay, one that is replaced after the
    first report and one that comes later."""
    t = Tables(spark, sf_dir)
    base, state = scratch_path(spark, "lineitem-files"), scratch_path(spark, "lineitem-state")
    t.lineitem.withColumn("part", F.pmod("l_orderkey", F.lit(3))).write.partitionBy("part").parquet(base)
    stale = t.lineitem.withColumn("l_quantity", -F.col("l_quantity")).withColumn("l_partkey", F.lit(-1).cast("bigint"))
    stale.write.parquet(f"{base}/part=9")
    stay, old, new = [f"{base}/part=0", f"{base}/part=1"], f"{base}/part=9", f"{base}/part=2"
    incremental_report(spark, [*stay, old], LINEITEM, state, _parents(t, LINEITEM))
    return incremental_report(spark, [*stay, new], LINEITEM, state, _parents(t, LINEITEM))


# -------------------------------------------------------------- C1, G7
@query(
    "pk_violations",
    ("C1", "G7"),
    """
    SELECT 'lineitem' AS tbl,
           concat_ws('|', coalesce(CAST(l_orderkey AS VARCHAR), 'NULL'), coalesce(CAST(l_linenumber AS VARCHAR), 'NULL')) AS key,
           count(*) AS n_rows,
           CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'null_key' ELSE 'duplicate' END AS reason
    FROM lineitem GROUP BY l_orderkey, l_linenumber
    HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
    UNION ALL
    SELECT 'orders', coalesce(CAST(o_orderkey AS VARCHAR), 'NULL'), count(*),
           CASE WHEN o_orderkey IS NULL THEN 'null_key' ELSE 'duplicate' END
    FROM orders GROUP BY o_orderkey HAVING count(*) > 1 OR o_orderkey IS NULL
    """,
)
def pk_violations(spark, sf_dir):
    t = Tables(spark, sf_dir)
    out = []
    for name, df, key in (("lineitem", t.lineitem, LINEITEM.primary_key), ("orders", t.orders, ORDERS.primary_key)):
        v = C.check_primary_key(df, key)
        out.append(v.select(F.lit(name).alias("tbl"), C.key_string(key).alias("key"), "n_rows", "reason"))
    return reduce(DataFrame.unionByName, out)


# -------------------------------------------------------------- C2
@query(
    "unique_ci",
    ("C2",),
    """
    SELECT lower(p_name) AS p_name, count(*) AS n_rows FROM part
    WHERE p_name IS NOT NULL GROUP BY lower(p_name) HAVING count(*) > 1
    """,
)
def unique_ci(spark, sf_dir):
    return C.check_unique(Tables(spark, sf_dir).part, ["p_name"], ci=["p_name"])


# -------------------------------------------------------------- C4, J1
_FK_CHECKS = (
    ("lineitem.l_orderkey->orders", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem.l_partkey->part", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem.l_suppkey->supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders.o_custkey->customer", "orders", "o_custkey", "customer", "c_custkey"),
    ("labels.doc_id->documents", "labels", "doc_id", "documents", "doc_id"),
    ("documents.doc_id->labels", "documents", "doc_id", "labels", "doc_id"),
)


@query(
    "fk_orphans",
    ("C4", "J1"),
    "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS reference, CAST(c.{ccol} AS VARCHAR) AS key, count(*) AS n_rows
        FROM {child} c WHERE c.{ccol} IS NOT NULL
          AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{ccol})
        GROUP BY c.{ccol}"""
        for name, child, ccol, parent, pcol in _FK_CHECKS
    ),
)
def fk_orphans(spark, sf_dir):
    t = Tables(spark, sf_dir)
    out = []
    for name, child, ccol, parent, pcol in _FK_CHECKS:
        o = C.check_foreign_key(getattr(t, child), [ccol], getattr(t, parent), [pcol])
        out.append(o.select(F.lit(name).alias("reference"), F.col(ccol).cast("string").alias("key"), "n_rows"))
    return reduce(DataFrame.unionByName, out)


# -------------------------------------------------------------- C5, C6, C7
@query(
    "range_len_domain",
    ("C5", "C6", "C7"),
    """
    SELECT 'range' AS rule, 'customer' AS tbl, CAST(c_custkey AS VARCHAR) AS key, 'c_acctbal' AS col,
           c_acctbal AS num_value, CAST(NULL AS VARCHAR) AS str_value
    FROM customer WHERE coalesce(c_acctbal < 0 OR isnan(c_acctbal), false)
    UNION ALL
    SELECT 'length', 'part', CAST(p_partkey AS VARCHAR), 'p_name', NULL, p_name
    FROM part WHERE coalesce(length(p_name) > 10, false)
    UNION ALL
    SELECT 'domain', 'orders', CAST(o_orderkey AS VARCHAR), 'o_orderstatus', NULL, o_orderstatus
    FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('O', 'F')
    """,
)
def range_len_domain(spark, sf_dir):
    t = Tables(spark, sf_dir)
    num, txt = F.lit(None).cast("double"), F.lit(None).cast("string")
    r = C.check_range(t.customer, "c_acctbal", lo=0, key=["c_custkey"]).select(
        F.lit("range").alias("rule"), F.lit("customer").alias("tbl"), F.col("c_custkey").cast("string").alias("key"),
        F.lit("c_acctbal").alias("col"), F.col("c_acctbal").alias("num_value"), txt.alias("str_value"))
    ln = C.check_length(t.part, "p_name", 10, key=["p_partkey"]).select(
        F.lit("length"), F.lit("part"), F.col("p_partkey").cast("string"), F.lit("p_name"), num, F.col("p_name"))
    d = C.check_domain(t.orders, "o_orderstatus", ["O", "F"], key=["o_orderkey"]).select(
        F.lit("domain"), F.lit("orders"), F.col("o_orderkey").cast("string"), F.lit("o_orderstatus"), num,
        F.col("o_orderstatus"))
    return r.union(ln).union(d)


# -------------------------------------------------------------- C8
@query(
    "implication",
    ("C8",),
    """
    SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem
    WHERE coalesce(l_returnflag = 'R', false) AND NOT coalesce(l_linestatus = 'F', false)
    """,
)
def implication(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return C.check_implies(li, "l_returnflag = 'R'", "l_linestatus = 'F'").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")


# -------------------------------------------------------------- C9
@query(
    "ordered_bounds",
    ("C9",),
    """
    SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem
    WHERE coalesce(NOT (0 <= l_discount AND l_discount <= l_tax), false)
    """,
)
def ordered_bounds(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    return C.check_ordered(li, F.lit(0.0), F.col("l_discount"), F.col("l_tax")).select(
        "l_orderkey", "l_linenumber", "l_discount", "l_tax")


# -------------------------------------------------------------- C12
@query(
    "reconcile_counts",
    ("C12",),
    """
    WITH stored AS (SELECT o_custkey AS c_custkey, count(*) AS n FROM orders GROUP BY o_custkey),
         actual AS (SELECT o.o_custkey AS c_custkey, count(*) AS n
                    FROM (SELECT DISTINCT l_orderkey FROM lineitem) l JOIN orders o ON o.o_orderkey = l.l_orderkey
                    GROUP BY o.o_custkey)
    SELECT coalesce(s.c_custkey, a.c_custkey) AS c_custkey,
           CAST(coalesce(s.n, 0) AS BIGINT) AS stored, CAST(coalesce(a.n, 0) AS BIGINT) AS actual
    FROM stored s FULL OUTER JOIN actual a ON s.c_custkey = a.c_custkey
    WHERE coalesce(s.n, 0) <> coalesce(a.n, 0)
    """,
)
def reconcile_counts(spark, sf_dir):
    """Orders per customer as stored in ``orders`` against orders that
    actually carry line items (an order without lines is a broken header)."""
    t = Tables(spark, sf_dir)
    stored = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    lines = t.lineitem.select("l_orderkey").distinct()
    actual = (
        lines.join(t.orders.select("o_orderkey", "o_custkey"), lines.l_orderkey == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return C.reconcile(stored, actual, ["c_custkey"], "n", "n")


@query(
    "reconcile_nchars",
    ("C12",),
    """
    SELECT coalesce(s.lang, a.lang) AS lang, coalesce(s.source, a.source) AS source, coalesce(s.stored, 0) AS stored, coalesce(a.actual, 0) AS actual
    FROM (SELECT lang, source, CAST(sum(n_chars) AS BIGINT) AS stored FROM documents GROUP BY lang, source) s
    FULL OUTER JOIN
      (SELECT lang, source, CAST(sum(length(text)) AS BIGINT) AS actual FROM documents
       WHERE doc_id IN (SELECT doc_id FROM labels) GROUP BY lang, source) a
    ON s.lang = a.lang AND s.source = a.source
    WHERE coalesce(s.stored, 0) <> coalesce(a.actual, 0)
    """,
)
def reconcile_nchars(spark, sf_dir):
    """Stored character counts per language and source against the texts of
    the labelled documents: groups with unlabelled documents disagree."""
    t = Tables(spark, sf_dir)
    by = ["lang", "source"]
    stored = t.documents.groupBy(*by).agg(F.sum("n_chars").alias("chars"))
    labelled = t.documents.join(t.labels.select("doc_id"), "doc_id", "left_semi")
    counted = labelled.groupBy(*by).agg(F.sum(F.char_length("text")).alias("chars"))
    return C.reconcile(stored, counted, by, "chars", "chars")


# -------------------------------------------------------------- C3
@query(
    "not_null",
    ("C3", "J1"),
    """
    SELECT d.doc_id, 'quality' AS col FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.quality IS NULL
    UNION ALL
    SELECT d.doc_id, 'toxic' FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.toxic IS NULL
    """,
)
def not_null(spark, sf_dir):
    t = Tables(spark, sf_dir)
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return C.check_not_null(joined, ["quality", "toxic"], ["doc_id"])


# -------------------------------------------------------------- S1
#: Tables whose text copies are scanned, and the number that is spelled out
#: in every 37th row (by key) of the copy.
TEXT_COPIES = {"orders": ("o_orderkey", "o_totalprice"), "customer": ("c_custkey", "c_acctbal"),
               "lineitem": ("l_orderkey", "l_quantity"), "events": ("event_id", "user_id")}


def _typed_scan_sql(name: str) -> str:
    key = TEXT_COPIES[name][0]
    good = f"FILTER (WHERE {key} % 37 <> 0)"
    values = " + ".join(f"count({c}) {good}" for c in DRIVER_CONTRACTS[name].names)
    return (f"SELECT '{name}' AS tbl, count(*) {good} AS n_rows, count(*) FILTER (WHERE {key} % 37 = 0) AS n_rejected, "
            f"CAST({values} AS BIGINT) AS n_values FROM {name}")


@query("typed_scan", ("S1", "P2"), "\nUNION ALL\n".join(map(_typed_scan_sql, TEXT_COPIES)))
def typed_scan(spark, sf_dir):
    """Text copies with bad rows, read back under the tables' contracts:
    rows that fit, rows rejected, and the values of the rows that fit."""
    out = []
    for name, (key, number) in TEXT_COPIES.items():
        contract = DRIVER_CONTRACTS[name]
        table = getattr(Tables(spark, sf_dir), name).select(*contract.names)
        text = table.select(*[F.col(c).cast("string").alias(c) for c in contract.names])
        spelled = F.when(F.col(key).cast("bigint") % 37 == 0, F.concat(F.lit("about "), F.col(number))).otherwise(F.col(number))
        path = scratch_path(spark, f"text-{name}")
        text.withColumn(number, spelled).write.option("escape", '"').csv(path)
        good, rejected = read_with_contract(spark, path, contract, "csv", escape='"')
        values = reduce(lambda a, b: a + b, [F.count(c) for c in contract.names])
        fits = good.agg(F.count(F.lit(1)).alias("n_rows"), values.alias("n_values")).withColumn("n_rejected", F.lit(0).cast("bigint"))
        fails = rejected.agg(F.count(F.lit(1)).alias("n_rejected")).withColumns({"n_rows": F.lit(0).cast("bigint"), "n_values": F.lit(0).cast("bigint")})
        out.append(fits.unionByName(fails).withColumn("tbl", F.lit(name)))
    return reduce(DataFrame.unionByName, out).groupBy("tbl").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_rejected").alias("n_rejected"), F.sum("n_values").alias("n_values"))


# -------------------------------------------------------------- C10
_DECLARED = ", ".join(f"('{c.name}', '{c.dtype}')" for c in ORDERS.columns)


@query("schema_drift", ("C10",), f"""
    WITH found AS (
      SELECT column_name AS "column",
             CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
                  WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END AS found
      FROM (DESCRIBE orders) WHERE column_name <> 'o_orderpriority'
      UNION ALL SELECT 'o_comment', 'string'),
    drifted AS (
      SELECT "column", CASE WHEN "column" = 'o_totalprice' THEN 'decimal(12,2)' ELSE found END AS found FROM found),
    declared("column", declared) AS (VALUES {_DECLARED})
    SELECT coalesce(d."column", f."column") AS "column",
           CASE WHEN f."column" IS NULL THEN 'missing' WHEN d."column" IS NULL THEN 'extra' ELSE 'retyped' END AS change,
           d.declared, f.found,
           CASE f."column" WHEN 'o_comment' THEN (SELECT count(*) FROM orders) WHEN 'o_totalprice' THEN (SELECT count(o_totalprice) FROM orders) END
             AS n_values
    FROM declared d FULL OUTER JOIN drifted f ON d."column" = f."column"
    WHERE d.declared IS DISTINCT FROM f.found""")
def schema_drift(spark, sf_dir):
    """``orders`` with one column dropped, one added and one retyped."""
    o = Tables(spark, sf_dir).orders
    drifted = o.drop("o_orderpriority").withColumn("o_comment", F.lit("")).withColumn(
        "o_totalprice", F.col("o_totalprice").cast("decimal(12,2)"))
    # How many values each column that differs holds.
    held = drifted.agg(*[F.count(c).alias(c) for c in drifted.columns]).select(F.inline(F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_values")) for c in drifted.columns])))
    return C.schema_diff(drifted, ORDERS).join(held, "column", "left")


# -------------------------------------------------------------- P1, P2
ORDERS_INTAKE = TableContract(
    "orders_intake",
    ORDERS.columns + (Col("o_clerk", "string", default="unassigned", has_default=True),
                      Col("o_loaded_at", "timestamp", default=CURRENT_TIMESTAMP, has_default=True)),
    primary_key=ORDERS.primary_key,
)


def orders_as_text(orders: DataFrame) -> DataFrame:
    """A text copy of ``orders`` as a dump would deliver it: zero dates for
    low-priority orders and an unreadable price on urgent pending ones."""
    return orders.select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.col("o_custkey").cast("string").alias("o_custkey"),
        "o_orderstatus",
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"), F.lit("n/a"))
        .otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(C.ZERO_DATE))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("o_orderdate"),
        "o_orderpriority",
    )


@query(
    "defaults_and_casts",
    ("P1", "P2"),
    """
    WITH raw AS (
      SELECT o_orderkey, o_orderstatus, o_orderpriority,
             (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') AS bad_price,
             (o_orderpriority = '5-LOW') AS zero_date
      FROM orders)
    SELECT o_orderkey,
           CASE WHEN bad_price THEN 'rejected' ELSE 'good' END AS status,
           CASE WHEN bad_price THEN 'o_totalprice:unconvertible' ELSE '' END AS reasons,
           CASE WHEN zero_date THEN 'o_orderdate:zero_date' ELSE '' END AS notes,
           'unassigned' AS o_clerk,
           NOT zero_date AS has_date
    FROM raw
    """,
)
def defaults_and_casts(spark, sf_dir):
    text = orders_as_text(Tables(spark, sf_dir).orders)
    filled = C.apply_defaults(text, ORDERS_INTAKE)
    staged = C.cast_with_reasons(filled, ORDERS_INTAKE)
    return staged.select(
        "o_orderkey",
        F.when(F.size("reasons") > 0, F.lit("rejected")).otherwise(F.lit("good")).alias("status"),
        F.array_join("reasons", ",").alias("reasons"),
        F.array_join("notes", ",").alias("notes"),
        "o_clerk",
        F.col("o_orderdate").isNotNull().alias("has_date"),
    )

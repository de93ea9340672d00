"""Approximate comparison queries.

The compared pairs are derived from the driver tables: line items summed
per (part, supplier) against a copy whose price is scaled by a small
per-supplier factor; orders as decimals against a copy shifted by
micro-units; embeddings against an offset copy; per-user event maps of
the first and second half of the month; orders against an edited copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabletrust.functions import approx as A
from tabletrust.operators import compare as CMP
from tabletrust.plans.catalog import Tables, query

# --------------------------------------------------------------- shared frames
_PAIR_SQL = """
WITH actual AS (
  SELECT l_partkey, l_suppkey,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price,
         CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty
  FROM lineitem GROUP BY l_partkey, l_suppkey),
expected AS (
  SELECT l_partkey, l_suppkey,
         price * (1 + 1e-7 * ((l_suppkey % 20) + 0.5)) AS price, qty
  FROM actual WHERE qty <= 45)
"""


def _pair(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    li = Tables(spark, sf_dir).lineitem
    actual = li.groupBy("l_partkey", "l_suppkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("price"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).cast("double").alias("qty"),
    )
    factor = F.lit(1.0) + F.lit(1e-7) * ((F.col("l_suppkey") % 20) + F.lit(0.5))
    expected = actual.where(F.col("qty") <= 45).select(
        "l_partkey", "l_suppkey", (F.col("price") * factor).alias("price"), "qty")
    return actual, expected


def _near_sql(a: str, e: str, tol: str, nan_ok: str = "false") -> str:
    """The scalar rule as a DuckDB CASE chain."""
    return (
        f"CASE WHEN {a} IS NULL OR {e} IS NULL THEN ({a} IS NOT DISTINCT FROM {e}) "
        f"WHEN isnan({e}) THEN ({nan_ok} AND isnan({a})) "
        f"WHEN isnan({a}) THEN false "
        f"WHEN {a} = {e} THEN true "
        f"WHEN abs({e}) = 'inf'::DOUBLE THEN false "
        f"ELSE abs({e} - {a}) <= {tol} END"
    )


def _default_tol(e: str) -> str:
    return f"greatest(1e-6 * abs({e}), 1e-12)"


# --------------------------------------------------------------- A1, A2
@query(
    "near_scalar",
    ("A1", "A2", "J5"),
    _PAIR_SQL + f"""
    SELECT a.l_partkey, a.l_suppkey,
           {_near_sql('a.price', 'e.price', _default_tol('e.price'))} AS ok_default,
           {_near_sql('a.price', 'e.price', 'greatest(1e-5 * abs(e.price), 1e-12)')} AS ok_rel,
           {_near_sql('a.price', 'e.price', '0.5')} AS ok_abs
    FROM actual a JOIN expected e USING (l_partkey, l_suppkey)
    """,
)
def near_scalar(spark, sf_dir):
    actual, expected = _pair(spark, sf_dir)
    j = actual.alias("a").join(expected.alias("e"), ["l_partkey", "l_suppkey"])
    a, e = F.col("a.price"), F.col("e.price")
    return j.select(
        "l_partkey", "l_suppkey",
        A.near(a, e).alias("ok_default"),
        A.near(a, e, rel=1e-5).alias("ok_rel"),
        A.near(a, e, abs=0.5).alias("ok_abs"),
    )


# --------------------------------------------------------------- A8
_CELLS_SQL = _PAIR_SQL + f"""
, joined AS (
  SELECT coalesce(a.l_partkey, e.l_partkey) AS l_partkey, coalesce(a.l_suppkey, e.l_suppkey) AS l_suppkey,
         CASE WHEN a.l_partkey IS NULL THEN 'missing_actual' WHEN e.l_partkey IS NULL THEN 'missing_expected'
              ELSE 'matched' END AS status,
         a.price AS a_price, e.price AS e_price, a.qty AS a_qty, e.qty AS e_qty
  FROM actual a FULL OUTER JOIN expected e ON a.l_partkey = e.l_partkey AND a.l_suppkey = e.l_suppkey),
cells AS (
  SELECT l_partkey, l_suppkey, status, 'price' AS "column", a_price AS obtained, e_price AS expected,
         {_default_tol('e_price')} AS tolerance,
         CASE WHEN status <> 'matched' THEN false ELSE {_near_sql('a_price', 'e_price', _default_tol('e_price'))} END AS ok
  FROM joined
  UNION ALL
  SELECT l_partkey, l_suppkey, status, 'qty', a_qty, e_qty, {_default_tol('e_qty')},
         CASE WHEN status <> 'matched' THEN false ELSE {_near_sql('a_qty', 'e_qty', _default_tol('e_qty'))} END
  FROM joined)
"""


@query("near_cells", ("A8", "J5"), _CELLS_SQL + "SELECT * FROM cells")
def near_cells(spark, sf_dir):
    actual, expected = _pair(spark, sf_dir)
    return CMP.compare_tables(actual, expected, ["l_partkey", "l_suppkey"])


# --------------------------------------------------------------- A9, G8
@query(
    "near_summary",
    ("A9", "G8"),
    _CELLS_SQL + """
    SELECT "column", count(*) AS n_total, count(*) FILTER (WHERE NOT ok) AS n_mismatched,
           max(CASE WHEN NOT ok THEN abs(expected - obtained) END) AS max_abs_diff,
           max(CASE WHEN NOT ok AND obtained IS NOT NULL AND expected IS NOT NULL THEN
                 CASE WHEN expected = 0 THEN 'inf'::DOUBLE ELSE abs((expected - obtained) / expected) END END)
             AS max_rel_diff
    FROM cells GROUP BY "column"
    """,
)
def near_summary(spark, sf_dir):
    return CMP.mismatch_summary(near_cells(spark, sf_dir))


# --------------------------------------------------------------- A10
@query(
    "near_mismatches",
    ("A10",),
    _CELLS_SQL + """
    SELECT l_partkey, l_suppkey, status, "column", obtained, expected,
           CASE WHEN expected IS NULL THEN NULL
                ELSE printf('%s ± %.1e', CAST(expected AS VARCHAR), greatest(1e-6 * abs(expected), 1e-12)) END
             AS expected_text
    FROM cells WHERE NOT ok
    """,
)
def near_mismatches(spark, sf_dir):
    return CMP.mismatch_rows(near_cells(spark, sf_dir), ["l_partkey", "l_suppkey"])


# --------------------------------------------------------------- F11
@query(
    "tolerance_text",
    ("F11", "A10"),
    """
    SELECT p_partkey, printf('%s ± %.1e', CAST(p_retailprice AS VARCHAR), greatest(1e-6 * abs(p_retailprice), 1e-12))
           AS expected_text
    FROM part
    """,
)
def tolerance_text(spark, sf_dir):
    p = Tables(spark, sf_dir).part
    return p.select("p_partkey", A.tolerance_text(F.col("p_retailprice")).alias("expected_text"))


# --------------------------------------------------------------- A3
@query(
    "near_decimal",
    ("A3",),
    """
    WITH d AS (
      SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,6)) AS a,
             CAST(CAST(o_totalprice AS DECIMAL(18,6)) + CAST(0.000001 AS DECIMAL(18,6)) * (o_orderkey % 4)
                  AS DECIMAL(18,6)) AS e
      FROM orders)
    SELECT o_orderkey,
           CASE WHEN a = e THEN true
                ELSE abs(e - a) <= greatest(CAST(0.000001 AS DECIMAL(6,6)) * abs(e), CAST(1e-12 AS DECIMAL(12,12))) END
             AS ok_default,
           CASE WHEN a = e THEN true ELSE abs(e - a) <= CAST(0.000002 AS DECIMAL(12,12)) END AS ok_abs,
           CAST(e - a AS DOUBLE) AS diff
    FROM d
    """,
)
def near_decimal(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    dtype = T.DecimalType(18, 6)
    a = F.col("o_totalprice").cast(dtype)
    step = F.lit("0.000001").cast(dtype)
    e = (a + step * (F.col("o_orderkey") % 4)).cast(dtype)
    d = o.select("o_orderkey", a.alias("a"), e.alias("e"))
    return d.select(
        "o_orderkey",
        A.near_decimal(F.col("a"), F.col("e"), dtype=dtype).alias("ok_default"),
        A.near_decimal(F.col("a"), F.col("e"), abs=0.000002, dtype=dtype).alias("ok_abs"),
        (F.col("e") - F.col("a")).cast("double").alias("diff"),
    )


# --------------------------------------------------------------- A4, A5, A6
_VEC_ELEM = """
WITH elems AS (
  SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS a FROM embeddings),
pairs AS (SELECT vec_id, label, a, a + 0.001 * label AS e FROM elems)
"""


@query(
    "near_vectors",
    ("A4", "A5", "A6"),
    _VEC_ELEM + f"""
    SELECT vec_id,
           bool_and({_near_sql('a', 'e', '0.0045')}) AS ok_abs,
           bool_and({_near_sql('a', 'e', _default_tol('e'))}) AS ok_default,
           bool_and({_near_sql('a', '0.0', '0.5')}) AS ok_scalar,
           bool_and({_near_sql('a', '0.05::DOUBLE', 'greatest(9.5::DOUBLE * abs(0.05::DOUBLE), 1e-12)')})
             AS ok_scalar_rel,
           bool_and({_near_sql('0.05::DOUBLE', 'a', 'greatest(1.0::DOUBLE * abs(a), 0.45::DOUBLE)')})
             AS ok_scalar_actual,
           (label % 2 = 0) AND bool_and({_near_sql('a', 'e', '0.0045')}) AS ok_shaped
    FROM pairs GROUP BY vec_id, label
    """,
)
def near_vectors(spark, sf_dir):
    emb = Tables(spark, sf_dir).embeddings
    a = F.transform("embedding", lambda x: x.cast("double"))
    e = F.transform("embedding", lambda x: x.cast("double") + F.lit(0.001) * F.col("label"))
    # The actual side is stored as an 8x8 matrix; the expected side is 8x8
    # for even labels and flat otherwise, so odd labels fail on shape.
    a_shape = F.array(F.lit(8), F.lit(8))
    e_shape = F.when(F.col("label") % 2 == 0, F.array(F.lit(8), F.lit(8))).otherwise(F.array(F.lit(64)))
    return emb.select(
        "vec_id",
        A.near_array(a, e, abs=0.0045).alias("ok_abs"),
        A.near_array(a, e).alias("ok_default"),
        A.near_array_scalar(a, F.lit(0.0), abs=0.5).alias("ok_scalar"),
        # the tolerance follows the expected side: the scalar, or each element
        A.near_array_scalar(a, F.lit(0.05), rel=9.5).alias("ok_scalar_rel"),
        A.near_scalar_array(F.lit(0.05), a, rel=1.0, abs=0.45).alias("ok_scalar_actual"),
        A.near_ndarray(a, a_shape, e, e_shape, abs=0.0045).alias("ok_shaped"),
    )


@query(
    "ndarray_mismatches",
    ("A6", "A9"),
    f"""
    WITH elems AS (
      SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS a, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings),
    pairs AS (SELECT vec_id, label, pos, a, a + 0.001::DOUBLE * label * (pos % 7) AS e FROM elems)
    SELECT vec_id, CAST(NULL AS VARCHAR) AS message, concat_ws(',', pos // 16, pos // 4 % 4, pos % 4) AS index, a AS obtained, e AS expected
    FROM pairs WHERE label % 3 <> 0 AND NOT {_near_sql('a', 'e', '0.0145')}
    UNION ALL
    SELECT vec_id, 'Impossible to compare arrays with different shapes. Shapes: (64,) and (4, 4, 4)', NULL, NULL, NULL
    FROM embeddings WHERE label % 3 = 0
    """,
)
def ndarray_mismatches(spark, sf_dir):
    """Vectors as 4x4x4 arrays; the expected side is flat for every third label."""
    emb = Tables(spark, sf_dir).embeddings
    a = F.transform("embedding", lambda x: x.cast("double"))
    e = F.transform("embedding", lambda x, i: x.cast("double") + F.lit(0.001) * F.col("label") * (i % 7))
    cube = F.array(F.lit(4), F.lit(4), F.lit(4))
    e_shape = F.when(F.col("label") % 3 != 0, cube).otherwise(F.array(F.lit(64)))
    rows = emb.select("vec_id", a.alias("a"), e.alias("e"), cube.alias("a_shape"), e_shape.alias("e_shape"))
    out = CMP.ndarray_mismatches(rows, ["vec_id"], F.col("a"), F.col("a_shape"), F.col("e"), F.col("e_shape"), abs=0.0145)
    return out.withColumn("index", F.when(F.col("index").isNotNull(), F.concat_ws(",", F.col("index").cast("array<string>"))))


# --------------------------------------------------------------- A7
_HALF_SQL = """
WITH sums AS (
  SELECT user_id, event_type, ts < TIMESTAMP '2024-01-16' AS first_half,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS v
  FROM events GROUP BY ALL),
a AS (SELECT user_id, event_type, v FROM sums WHERE first_half),
e AS (SELECT user_id, event_type, v FROM sums WHERE NOT first_half),
j AS (SELECT coalesce(a.user_id, e.user_id) AS user_id, a.v AS av, e.v AS ev,
             a.user_id IS NOT NULL AND e.user_id IS NOT NULL AS both_sides
      FROM a FULL OUTER JOIN e ON a.user_id = e.user_id AND a.event_type = e.event_type)
"""


@query(
    "near_maps",
    ("A7",),
    _HALF_SQL + f"""
    SELECT user_id, bool_and(both_sides) AS same_keys,
           bool_and(both_sides) AND bool_and({_near_sql('av', 'ev', 'greatest(0.5 * abs(ev), 1e-12)')}) AS ok
    FROM j GROUP BY user_id
    """,
)
def near_maps(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    first = F.col("ts") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    sums = ev.groupBy("user_id", "event_type", first.alias("first_half")).agg(
        F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("v"))
    # One map per user and half; at most one entry per event type.
    maps = sums.groupBy("user_id", "first_half").agg(
        F.map_from_entries(F.collect_list(F.struct("event_type", "v"))).alias("m"))
    a = maps.where("first_half").select("user_id", F.col("m").alias("am"))
    e = maps.where("NOT first_half").select("user_id", F.col("m").alias("em"))
    j = a.join(e, "user_id", "full_outer")
    same = F.coalesce(F.array_sort(F.map_keys("am")) == F.array_sort(F.map_keys("em")), F.lit(False))
    return j.select("user_id", same.alias("same_keys"),
                    A.near_map(F.col("am"), F.col("em"), rel=0.5).alias("ok"))


# --------------------------------------------------------------- A11
_EDIT_SQL = """
WITH old AS (SELECT * FROM orders),
new AS (
  SELECT o_orderkey, o_custkey,
         CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'P' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1.0 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate < TIMESTAMP '2001-06-01'
  UNION ALL
  SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
  FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01')
"""


def edited_orders(orders: DataFrame) -> DataFrame:
    """A later version of ``orders``: late orders re-keyed (removed and
    added), urgent prices raised by 1, high-priority pending orders final."""
    late = F.col("o_orderdate") >= F.lit("2001-06-01 00:00:00").cast("timestamp_ntz")
    kept = orders.where(~late).select(
        "o_orderkey", "o_custkey",
        F.when((F.col("o_orderpriority") == "2-HIGH") & (F.col("o_orderstatus") == "P"), F.lit("F"))
        .otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1.0)
        .otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate", "o_orderpriority",
    )
    moved = orders.where(late).withColumn("o_orderkey", F.col("o_orderkey") + 1000000000)
    return kept.unionByName(moved)


@query(
    "snapshot_delta",
    ("A11", "J5"),
    _EDIT_SQL + """
    SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, 'added' AS change, CAST(NULL AS VARCHAR) AS "column",
           CAST(NULL AS DOUBLE) AS delta
    FROM new n LEFT JOIN old o USING (o_orderkey) WHERE o.o_orderkey IS NULL
    UNION ALL
    SELECT o.o_orderkey, 'removed', NULL, NULL FROM old o LEFT JOIN new n USING (o_orderkey) WHERE n.o_orderkey IS NULL
    UNION ALL
    SELECT o_orderkey, 'changed', "column", delta FROM (
      SELECT o.o_orderkey,
             unnest([
               CASE WHEN o.o_custkey IS DISTINCT FROM n.o_custkey THEN {'column': 'o_custkey', 'delta': CAST(n.o_custkey - o.o_custkey AS DOUBLE)} END,
               CASE WHEN o.o_orderstatus IS DISTINCT FROM n.o_orderstatus THEN {'column': 'o_orderstatus', 'delta': NULL::DOUBLE} END,
               CASE WHEN o.o_totalprice IS DISTINCT FROM n.o_totalprice THEN {'column': 'o_totalprice', 'delta': n.o_totalprice - o.o_totalprice} END,
               CASE WHEN o.o_orderdate IS DISTINCT FROM n.o_orderdate THEN {'column': 'o_orderdate', 'delta': NULL::DOUBLE} END,
               CASE WHEN o.o_orderpriority IS DISTINCT FROM n.o_orderpriority THEN {'column': 'o_orderpriority', 'delta': NULL::DOUBLE} END
             ], recursive := true)
      FROM old o JOIN new n USING (o_orderkey))
    WHERE "column" IS NOT NULL
    """,
)
def snapshot_delta(spark, sf_dir):
    o = Tables(spark, sf_dir).orders
    return CMP.snapshot_delta(o, edited_orders(o), ["o_orderkey"])


# --------------------------------------------------------------- M4
@query(
    "touch_on_change",
    ("M4",),
    _EDIT_SQL + """
    SELECT n.o_orderkey,
           o.o_orderkey IS NULL
             OR o.o_custkey IS DISTINCT FROM n.o_custkey OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus
             OR o.o_totalprice IS DISTINCT FROM n.o_totalprice OR o.o_orderpriority IS DISTINCT FROM n.o_orderpriority
             AS touched,
           CASE WHEN o.o_orderkey IS NULL
             OR o.o_custkey IS DISTINCT FROM n.o_custkey OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus
             OR o.o_totalprice IS DISTINCT FROM n.o_totalprice OR o.o_orderpriority IS DISTINCT FROM n.o_orderpriority
             THEN DATE '2013-02-17' ELSE CAST(n.o_orderdate AS DATE) END AS stamped_on
    FROM new n LEFT JOIN old o USING (o_orderkey)
    """,
)
def touch_on_change(spark, sf_dir):
    """The edited copy re-stamped: ``o_orderdate`` plays the last-change
    stamp and moves to a fixed load day only where a row really changed."""
    o = Tables(spark, sf_dir).orders
    touched = CMP.touch_on_change(o, edited_orders(o), ["o_orderkey"], "o_orderdate",
                                  now=F.lit("2013-02-17 00:00:00").cast("timestamp_ntz"))
    return touched.select("o_orderkey", "touched", F.col("o_orderdate").cast("date").alias("stamped_on"))


# ------------------------------------------------------------------ A4, A7 of text
@query("near_text", ("A1", "A4", "A7"), """
    SELECT p_partkey, p_size <= 25 OR upper(p_type) = p_type AS ok_array, p_size % 7 <> 0 OR p_brand = 'x' AS ok_map, p_size % 3 <> 0 AS ok_scalar, false AS ok_mixed
    FROM part""")
def near_text(spark, sf_dir):
    """Arrays, maps and columns of text compare strictly, element by element."""
    p = Tables(spark, sf_dir).part
    brand, kind, size = F.col("p_brand"), F.col("p_type"), F.col("p_size")
    text, texts, names = T.StringType(), T.ArrayType(T.StringType()), T.MapType(T.StringType(), T.StringType())
    typed = F.when(size > 25, F.upper(kind)).otherwise(kind)
    return p.select(
        "p_partkey",
        A.near_for_type(F.array(brand, kind, F.lit(None)), F.array(brand, typed, F.lit(None)), texts).alias("ok_array"),
        A.near_for_type(F.create_map(F.lit("b"), brand, F.lit("t"), kind),
                        F.create_map(F.lit("t"), kind, F.lit("b"), F.when(size % 7 == 0, F.lit("x")).otherwise(brand)), names).alias("ok_map"),
        A.near_for_type(kind, F.when(size % 3 == 0, F.concat(kind, F.lit(" "))).otherwise(kind), text).alias("ok_scalar"),
        A.near(kind, size).alias("ok_mixed"))

"""Text, flag, time and lookup queries."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabletrust.functions import scalar as S
from tabletrust.operators import lookup as L
from tabletrust.plans.catalog import Tables, query


# ------------------------------------------------------------------ F2
@query("safe_name", ("F2",), """
    SELECT doc_id, substring(regexp_replace(text, '[^\\p{L}\\p{N}_]', '_', 'g'), 1, 30) AS name FROM documents""")
def safe_name(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return d.select("doc_id", S.safe_name(F.col("text")).alias("name"))


# ------------------------------------------------------------------ F3
def _rx_count(pattern: str) -> str:
    return f"CAST(len(regexp_extract_all(text, '{pattern}')) AS BIGINT)"


@query("text_hygiene", ("F3",), f"""
    SELECT lang, count(*) AS n_docs,
           count(*) FILTER (WHERE regexp_matches(text, '{S.OUTSIDE_PRINTABLE}')) AS n_docs_unprintable,
           CAST(sum({_rx_count(r'\t')}) AS BIGINT) AS n_tab, CAST(sum({_rx_count(r'\r')}) AS BIGINT) AS n_cr,
           CAST(sum({_rx_count(r'\n')}) AS BIGINT) AS n_lf,
           CAST(sum({_rx_count(S.OTHER_CONTROL)}) AS BIGINT) AS n_control,
           CAST(sum({_rx_count(S.NON_ASCII)}) AS BIGINT) AS n_non_ascii
    FROM documents GROUP BY lang""")
def text_hygiene(spark, sf_dir):
    """Non-printable and non-ASCII profile of whole document texts, per
    language, in one aggregate pass."""
    return S.hygiene_profile(Tables(spark, sf_dir).documents, "text", "lang")


# ------------------------------------------------------------------ P3
@query("search", ("P3",), """
    SELECT doc_id, source FROM documents WHERE regexp_matches(text, '(?i)licen[cs]e|copyright')""")
def search(spark, sf_dir):
    d = Tables(spark, sf_dir).documents
    return d.where(S.search(F.col("text"), "(?i)licen[cs]e|copyright")).select("doc_id", "source")


# ------------------------------------------------------------------ F4
@query("name_check", ("F4",), """
    SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+/([^?#]*)', 1) AS name,
           NOT contains(regexp_extract(url, '^[a-z]+://[^/]+/([^?#]*)', 1), '/') AS valid
    FROM pages""")
def name_check(spark, sf_dir):
    """The path of each page URL used as a single name: valid only without
    a separator."""
    p = Tables(spark, sf_dir).pages
    name = F.regexp_extract("url", r"^[a-z]+://[^/]+/([^?#]*)", 1)
    return p.select("page_id", name.alias("name"), S.single_segment(name).alias("valid"))


# ------------------------------------------------------------------ F5
@query("epoch", ("F5",), """
    SELECT event_id, date_diff('second', TIMESTAMP '1970-01-01', ts) AS epoch_s,
           TIMESTAMP '1970-01-01' + to_seconds(date_diff('second', TIMESTAMP '1970-01-01', ts)) = date_trunc('second', ts)
             AS round_trip
    FROM events""")
def epoch(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    secs = S.epoch_seconds(F.col("ts"))
    back = S.from_epoch_seconds(secs)
    return ev.select("event_id", secs.alias("epoch_s"),
                     (back == F.date_trunc("second", F.col("ts")).cast("timestamp_ntz")).alias("round_trip"))


# ------------------------------------------------------------------ F6
@query("round_digits", ("F6",), """
    SELECT l_orderkey, l_linenumber, l_linenumber % 4 AS digits,
           CAST(CASE l_linenumber % 4
                  WHEN 0 THEN round(CAST(l_extendedprice AS DECIMAL(18,2)), 0)
                  WHEN 1 THEN round(CAST(l_extendedprice AS DECIMAL(18,2)), 1)
                  WHEN 2 THEN round(CAST(l_extendedprice AS DECIMAL(18,2)), 2)
                  WHEN 3 THEN round(CAST(l_extendedprice AS DECIMAL(18,2)), 3) END AS DOUBLE) AS rounded
    FROM lineitem""")
def round_digits(spark, sf_dir):
    """Prices rounded to a number of decimals that comes from the data."""
    li = Tables(spark, sf_dir).lineitem
    digits = F.col("l_linenumber") % 4
    value = F.col("l_extendedprice").cast("decimal(18,2)")
    return li.select("l_orderkey", "l_linenumber", digits.alias("digits"),
                     S.round_to(value, digits, T.DecimalType(18, 2)).cast("double").alias("rounded"))


# ------------------------------------------------------------------ F10
@query("imputed", ("F10",), """
    SELECT p.p_partkey, count(l.l_partkey) AS n_points, count(l.l_partkey) = 0 AS imputed
    FROM part p LEFT JOIN lineitem l ON l.l_partkey = p.p_partkey GROUP BY p.p_partkey""")
def imputed(spark, sf_dir):
    """A part price with no line item behind it counts as imputed."""
    t = Tables(spark, sf_dir)
    points = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count(F.lit(1)).alias("n_points"))
    j = t.part.select("p_partkey").join(points, "p_partkey", "left")
    n = F.coalesce("n_points", F.lit(0)).cast("bigint")
    return j.select("p_partkey", n.alias("n_points"), S.imputed(n).alias("imputed"))


# ------------------------------------------------------------------ P4
@query("flags", ("P4",), """
    SELECT p_partkey,
           list_filter([CASE WHEN p_size & 1 <> 0 THEN 'invalid' END, CASE WHEN p_size & 2 <> 0 THEN 'offline' END,
                        CASE WHEN p_size & 4 <> 0 THEN 'show_version' END, CASE WHEN p_size & 32 <> 0 THEN 'new_players' END,
                        CASE WHEN p_size & 64 <> 0 THEN 'recommended' END], lambda x: x IS NOT NULL) AS labels,
           p_size & ~(1 | 2 | 4 | 32 | 64) AS unknown_bits
    FROM part""")
def flags(spark, sf_dir):
    """Part sizes read as realm flag masks."""
    p = Tables(spark, sf_dir).part
    labels, unknown = S.decode_flags(F.col("p_size"))
    return p.select("p_partkey", labels.alias("labels"), unknown.alias("unknown_bits"))


# ------------------------------------------------------------------ J3
@query("lookup", ("J3",), """
    SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""")
def lookup(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return L.lookup(t.nation, t.region, "n_regionkey", "r_regionkey", "r_name").select("n_nationkey", "n_name", "r_name")


# ------------------------------------------------------------------ J4
@query("imputation_source", ("J4",), """
    SELECT o.o_orderkey, p.o_custkey AS src_o_custkey
    FROM orders o LEFT JOIN orders p ON p.o_orderkey = o.o_orderkey - 1""")
def imputation_source(spark, sf_dir):
    """Each order points at the previous order number; take that order's
    customer (a self reference, as an imputed value names its source)."""
    o = Tables(spark, sf_dir).orders.withColumn("o_prevkey", F.col("o_orderkey") - 1)
    out = L.imputation_source(o, ["o_orderkey"], ["o_prevkey"], ["o_custkey"])
    return out.select("o_orderkey", "src_o_custkey")


# ------------------------------------------------------------------ O4
@query("report_order", ("O4", "J3"), """
    SELECT n.n_name, r.r_name, row_number() OVER (ORDER BY r.r_regionkey, n.n_name) AS report_order
    FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey""")
def report_order(spark, sf_dir):
    t = Tables(spark, sf_dir)
    j = L.lookup(t.nation, t.region.select("r_regionkey", "r_name", F.col("r_regionkey").alias("r_order")),
                 "n_regionkey", "r_regionkey", ["r_name", "r_order"])
    return L.report_order(j, ["r_order", "n_name"]).select("n_name", "r_name", "report_order")


@query("conversation_hygiene", ("F3",), f"""
    SELECT role, count(*) AS n_docs,
           count(*) FILTER (WHERE regexp_matches(text, '{S.OUTSIDE_PRINTABLE}')) AS n_docs_unprintable,
           CAST(sum({_rx_count(r'\t')}) AS BIGINT) AS n_tab, CAST(sum({_rx_count(r'\r')}) AS BIGINT) AS n_cr,
           CAST(sum({_rx_count(r'\n')}) AS BIGINT) AS n_lf,
           CAST(sum({_rx_count(S.OTHER_CONTROL)}) AS BIGINT) AS n_control,
           CAST(sum({_rx_count(S.NON_ASCII)}) AS BIGINT) AS n_non_ascii
    FROM conversations GROUP BY role""")
def conversation_hygiene(spark, sf_dir):
    """The same profile over conversation turns, per speaker role."""
    return S.hygiene_profile(Tables(spark, sf_dir).conversations, "text", "role")


@query("round_wide", ("F6",), """
    SELECT o_orderkey, o_orderkey % 16 AS digits,
           CAST(CASE o_orderkey % 16 """ + " ".join(f"WHEN {d} THEN CAST(round(v, {d}) AS DECIMAL(38,12))" for d in range(12)) + """ ELSE v END AS VARCHAR) AS rounded
    FROM (SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,12)) + CAST(o_orderkey % 997 AS DECIMAL(38,12)) * CAST(0.001002003004 AS DECIMAL(13,12)) AS v
          FROM orders)""")
def round_wide(spark, sf_dir):
    """Decimals of 12 digits after the point keep them, whatever the number
    to round to is."""
    wide = T.DecimalType(38, 12)
    part = (F.col("o_orderkey") % 997).cast("decimal(10,0)") * F.lit(Decimal("0.001002003004"))
    value = (F.col("o_totalprice").cast("decimal(18,2)") + part).cast(wide)
    digits = F.col("o_orderkey") % 16
    return Tables(spark, sf_dir).orders.select("o_orderkey", digits.alias("digits"), S.round_to(value, digits, wide).cast("string").alias("rounded"))

"""Keyed state and retention queries.

Key-value state is built from ``events``: key ``user/<id>``, value the
event's ``props`` JSON, ordered by ``(ts, event_id)``.  Props of events
with a value above 300 are delivered truncated (unreadable JSON).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabletrust.operators import keyed as K
from tabletrust.operators import retention as RT
from tabletrust.plans.catalog import Tables, query
from tabletrust.plans.q_runstate import CUT, REPORTS_SQL, reports

_KV_SQL = f"""
WITH writes AS (
  SELECT 'user/' || user_id AS key,
         CASE WHEN value > 300 THEN substr(props, 1, length(props) - 1) ELSE props END AS value,
         ts, event_id
  FROM events),
state AS (
  SELECT key, arg_max(value, (ts, event_id)) AS value, max((ts, event_id)) AS ver
  FROM writes WHERE ts < TIMESTAMP '{CUT}' GROUP BY key),
upserted AS (
  SELECT key, arg_max(value, (ts, event_id)) AS value FROM writes GROUP BY key)
"""


def _writes(spark, sf_dir) -> DataFrame:
    ev = Tables(spark, sf_dir).events
    value = F.when(F.col("value") > 300, F.expr("substr(props, 1, length(props) - 1)")).otherwise(F.col("props"))
    return ev.select(F.concat(F.lit("user/"), F.col("user_id").cast("string")).alias("key"), value.alias("value"),
                     "ts", "event_id")


def _state_and_updates(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    w = _writes(spark, sf_dir)
    cut = F.col("ts") < F.lit(CUT).cast("timestamp_ntz")
    state = RT.latest_per_key(w.where(cut), ["key"], ["ts", "event_id"])
    return state, w.where(~cut)


# ------------------------------------------------------------------ M1, S4
@query("kv_upsert", ("S4", "M1"), _KV_SQL + "SELECT key, value FROM upserted")
def kv_upsert(spark, sf_dir):
    state, updates = _state_and_updates(spark, sf_dir)
    return K.upsert(state, updates, ["key"], order=["ts", "event_id"]).select("key", "value")


# ------------------------------------------------------------------ S4 get, F7, F8
@query(
    "kv_get_default",
    ("S4", "F7", "F8", "J3"),
    _KV_SQL + """
    , wanted AS (SELECT DISTINCT 'user/' || o_custkey AS key FROM orders)
    SELECT w.key, s.value IS NOT NULL AS found, coalesce(json_valid(s.value), false) AS readable,
           CASE WHEN json_valid(s.value) THEN CAST(json_extract(s.value, '$.k') AS INTEGER) ELSE -1 END AS k
    FROM wanted w LEFT JOIN upserted s USING (key)
    """,
)
def kv_get_default(spark, sf_dir):
    """Look up every ordering customer's key; unknown keys and unreadable
    values fall back to the default ``{"k": -1}``."""
    state, updates = _state_and_updates(spark, sf_dir)
    current = K.upsert(state, updates, ["key"], order=["ts", "event_id"])
    wanted = Tables(spark, sf_dir).orders.select(
        F.concat(F.lit("user/"), F.col("o_custkey").cast("string")).alias("key")).distinct()
    got = K.kv_get(wanted, current.select("key", "value"), default='{"k": -1}')
    k = F.try_variant_get(F.parse_json(F.col("value")), "$.k", "int")
    return got.select("key", "found", "readable", k.alias("k"))


# ------------------------------------------------------------------ S5
_LIST_SQL = """
WITH state AS (
  SELECT source || '/' || lang AS key, '{"n":' || count(*) || '}' AS value FROM documents GROUP BY source, lang)
"""


@query("kv_list", ("S5",), _LIST_SQL + """
    SELECT key, json_valid(value) AS readable, value FROM state WHERE regexp_full_match(key, 'src1.*/e.')""")
def kv_list(spark, sf_dir):
    """Per (source, language) document counts kept as JSON state, listed by
    the glob ``src1*/e?``."""
    d = Tables(spark, sf_dir).documents
    state = d.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n")).select(
        F.concat_ws("/", "source", "lang").alias("key"), F.to_json(F.struct("n")).alias("value"))
    return K.kv_list(state, "src1*/e?")


# ------------------------------------------------------------------ M2
@query("insert_if_absent", ("M2", "W2"), _KV_SQL + """
    , first_new AS (SELECT key, arg_min(value, (ts, event_id)) AS value FROM writes
                    WHERE ts >= TIMESTAMP '2024-01-16' AND key NOT IN (SELECT key FROM state) GROUP BY key)
    SELECT key, value FROM state UNION ALL SELECT key, value FROM first_new""")
def insert_if_absent(spark, sf_dir):
    state, updates = _state_and_updates(spark, sf_dir)
    return K.insert_if_absent(state, updates, ["key"], order=["ts", "event_id"]).select("key", "value")


# ------------------------------------------------------------------ M3
@query("delete_keys", ("M3",), _KV_SQL + """
    SELECT key, value FROM upserted WHERE key NOT IN (
      SELECT DISTINCT 'user/' || user_id FROM events WHERE event_type = 'error' AND value > 250)""")
def delete_keys(spark, sf_dir):
    """Forget users who hit a severe error (value above 250)."""
    state, updates = _state_and_updates(spark, sf_dir)
    current = K.upsert(state, updates, ["key"], order=["ts", "event_id"]).select("key", "value")
    ev = Tables(spark, sf_dir).events
    doomed = ev.where((F.col("event_type") == "error") & (F.col("value") > 250)).select(
        F.concat(F.lit("user/"), F.col("user_id").cast("string")).alias("key")).distinct()
    return K.delete_keys(current, doomed, ["key"])


# ------------------------------------------------------------------ M5
@query("clear_state", ("M5",), _KV_SQL + """
    SELECT count(*) AS n_before, count(*) FILTER (WHERE false) AS n_after FROM upserted""")
def clear_state(spark, sf_dir):
    state, updates = _state_and_updates(spark, sf_dir)
    """Entries before and after clearing the state."""
    kept = K.upsert(state, updates, ["key"], order=["ts", "event_id"]).select("key", "value")
    count = F.count(F.lit(1))
    both = kept.agg(count.alias("n_before")).withColumn("n_after", F.lit(0).cast("bigint")).unionByName(
        K.clear_state(kept).agg(count.alias("n_after")).withColumn("n_before", F.lit(0).cast("bigint")))
    return both.agg(F.sum("n_before").alias("n_before"), F.sum("n_after").alias("n_after"))


# ------------------------------------------------------------------ W1, W2
@query("latest_per_key", ("W1",), """
    SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type,
           arg_max(value, (ts, event_id)) AS value
    FROM events GROUP BY user_id""")
def latest_per_key(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select("user_id", "ts", "event_id", "event_type", "value")
    return RT.latest_per_key(ev, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query("first_per_key", ("W2",), """
    SELECT user_id, arg_min(event_id, (ts, event_id)) AS event_id, arg_min(event_type, (ts, event_id)) AS event_type,
           arg_min(value, (ts, event_id)) AS value
    FROM events GROUP BY user_id""")
def first_per_key(spark, sf_dir):
    ev = Tables(spark, sf_dir).events.select("user_id", "ts", "event_id", "event_type", "value")
    return RT.first_per_key(ev, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


# ------------------------------------------------------------------ W3, W4, O5
@query("retention", ("W3", "W4", "O5"), REPORTS_SQL + """
    , calls AS (SELECT *, CASE WHEN phase = 'call' THEN outcome = 'passed' END AS passed FROM reports)
    SELECT seq_id AS event_id, user_id, event_type, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY seq_ts DESC, seq_id DESC) AS rank
      FROM calls WHERE NOT coalesce(passed, true))
    WHERE rank <= 3""")
def retention(spark, sf_dir):
    """Keep the 3 newest runs per (user, event type) under policy
    ``failed``: runs whose call passed, or that have no call result, go."""
    rep = reports(spark, sf_dir)
    passed = F.when(F.col("phase") == "call", F.col("outcome") == "passed")
    kept = RT.keep_newest(rep, ["user_id", "event_type"], ["seq_ts", "seq_id"], n=3, policy="failed", passed=passed)
    return kept.select(F.col("seq_id").alias("event_id"), "user_id", "event_type", "rank")


@query("retention_all", ("W3", "O5"), """
    SELECT event_id, user_id, event_type, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rank
      FROM events)
    WHERE rank <= 3""")
def retention_all(spark, sf_dir):
    ev = Tables(spark, sf_dir).events
    kept = RT.keep_newest(ev, ["user_id", "event_type"], ["ts", "event_id"], n=3, policy="all")
    return kept.select("event_id", "user_id", "event_type", "rank")


# ------------------------------------------------------------------ W5
@query("numbering", ("W5",), """
    WITH existing AS (SELECT source, max(doc_id) AS top FROM documents WHERE lang = 'en' GROUP BY source),
    new AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn
            FROM documents WHERE lang <> 'en')
    SELECT n.doc_id, n.source || '-' || (coalesce(e.top, -1) + n.rn) AS new_name
    FROM new n LEFT JOIN existing e USING (source)""")
def numbering(spark, sf_dir):
    """English documents are the existing numbered entries ``<source>-<doc_id>``;
    the others get the next numbers of their source, in doc_id order."""
    d = Tables(spark, sf_dir).documents
    existing = d.where(F.col("lang") == "en").select("source", F.col("doc_id").alias("suffix"))
    new = d.where(F.col("lang") != "en").select("doc_id", "source")
    out = RT.next_numbers(existing, new, "source", "suffix", ["doc_id"])
    return out.select("doc_id", F.concat_ws("-", "source", F.col("number").cast("string")).alias("new_name"))


# ------------------------------------------------------------------ W6
@query("assign_keys", ("W6",), """
    WITH keyed AS (SELECT doc_id AS old_id, CASE WHEN lang = 'de' THEN NULL ELSE doc_id END AS k FROM documents),
    top AS (SELECT greatest(max(k) + 1, 1) AS base FROM keyed)
    SELECT old_id, k AS doc_key FROM keyed WHERE k IS NOT NULL
    UNION ALL
    SELECT old_id, (SELECT base FROM top) - 1 + row_number() OVER (ORDER BY old_id) FROM keyed WHERE k IS NULL""")
def assign_keys(spark, sf_dir):
    """German documents arrive without a key and get generated ones, in
    arrival (old id) order, above the largest key in use."""
    d = Tables(spark, sf_dir).documents
    keyed = d.select(F.col("doc_id").alias("old_id"),
                     F.when(F.col("lang") == "de", F.lit(None)).otherwise(F.col("doc_id")).alias("doc_key"))
    return RT.assign_keys(keyed, "doc_key", ["old_id"], start=1)


# ------------------------------------------------------------------ S6, U3
@query("table_fingerprints", ("S6", "U3"), """
    WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders),
    copies AS (
      SELECT 'same' AS copy, * FROM o
      UNION ALL SELECT 'one value' AS copy, o_orderkey, CASE WHEN o_orderkey = (SELECT min(o_orderkey) FROM o) THEN o_custkey + 1 ELSE o_custkey END, o_orderstatus FROM o
      UNION ALL SELECT 'one null' AS copy, o_orderkey, o_custkey, CASE WHEN o_orderkey = (SELECT min(o_orderkey) FROM o) THEN NULL ELSE o_orderstatus END FROM o
      UNION ALL SELECT 'one twice' AS copy, * FROM o
      UNION ALL SELECT 'one twice' AS copy, * FROM o WHERE o_orderkey = (SELECT min(o_orderkey) FROM o)),
    names AS (SELECT DISTINCT copy FROM copies)
    SELECT n.copy, (SELECT count(*) FROM copies c WHERE c.copy = n.copy) AS n_rows,
           (SELECT count(*) FROM (SELECT o_orderkey, o_custkey, o_orderstatus FROM copies c WHERE c.copy = n.copy EXCEPT ALL SELECT * FROM o))
           + (SELECT count(*) FROM (SELECT * FROM o EXCEPT ALL SELECT o_orderkey, o_custkey, o_orderstatus FROM copies c WHERE c.copy = n.copy)) = 0 AS same
    FROM names n""")
def table_fingerprints(spark, sf_dir):
    """Copies of ``orders``, with a map and a nested column, against the
    table itself: one aggregate a copy tells whether the rows are the same."""
    o = Tables(spark, sf_dir).orders
    lowest = F.broadcast(o.agg(F.min("o_orderkey").alias("lowest")))  # one row

    def shaped(df):
        return df.select(F.create_map(F.lit("key"), "o_orderkey", F.lit("customer"), "o_custkey").alias("m"),
                         F.struct(F.array("o_orderstatus").alias("s"), "o_orderkey").alias("n"))

    own = shaped(o)
    first = F.col("o_orderkey") == F.col("lowest")
    marked = o.crossJoin(lowest)  # with one row
    copies = {
        "same": shaped(o.repartition(3, "o_custkey")),
        "one value": shaped(marked.withColumn("o_custkey", F.when(first, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")))),
        "one null": shaped(marked.withColumn("o_orderstatus", F.when(~first, F.col("o_orderstatus")))),
        "one twice": own.unionByName(shaped(marked.where(first))),
    }
    of = K.table_fingerprint(own).select(F.struct("n_rows", "sum_a", "sum_b").alias("own"))
    each = [K.table_fingerprint(df).select(F.lit(name).alias("copy"), "n_rows", F.struct("n_rows", "sum_a", "sum_b").alias("it")) for name, df in copies.items()]
    rows = reduce(DataFrame.unionByName, each)
    return rows.crossJoin(F.broadcast(of)).select("copy", "n_rows", (F.col("it") == F.col("own")).alias("same"))

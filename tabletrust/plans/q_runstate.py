"""Run-history queries over outcome reports derived from ``events``.

Reports (fixed derivation): ``seq = (ts, event_id)``;
``node_id = 'pkg<u%5>/mod<u%20>.py::case<u>'`` for user ``u``; outcome
error -> failed, purchase -> passed, view -> skipped, click and signup ->
passed; phase click and signup -> setup, otherwise call; session = day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabletrust.operators import runstate as R
from tabletrust.operators.numbering import number_rows
from tabletrust.plans.catalog import Tables, query

CUT = "2024-01-16 00:00:00"

REPORTS_SQL = """
WITH reports AS (
  SELECT ts AS seq_ts, event_id AS seq_id, user_id,
         'pkg' || (user_id % 5) || '/mod' || (user_id % 20) || '.py::case' || user_id AS node_id,
         CASE WHEN event_type IN ('click', 'signup') THEN 'setup' ELSE 'call' END AS phase,
         CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'skipped' ELSE 'passed' END AS outcome,
         CAST(ts AS DATE) AS session, event_type, value
  FROM events),
relevant AS (
  SELECT * FROM reports
  WHERE (phase = 'call' AND outcome = 'passed') OR outcome = 'skipped' OR outcome = 'failed'),
last_rel AS (
  SELECT node_id, arg_max(outcome = 'failed', (seq_ts, seq_id)) AS failing FROM relevant GROUP BY node_id),
failing AS (SELECT node_id FROM last_rel WHERE failing),
items AS (
  SELECT node_id, split_part(node_id, '::', 1) AS path, max(seq_ts) AS mtime, min(user_id) AS pos
  FROM reports GROUP BY node_id)
"""


def reports(spark, sf_dir) -> DataFrame:
    return as_reports(Tables(spark, sf_dir).events)


def as_reports(ev: DataFrame) -> DataFrame:
    u = F.col("user_id")
    node = F.concat(F.lit("pkg"), (u % 5).cast("string"), F.lit("/mod"), (u % 20).cast("string"),
                    F.lit(".py::case"), u.cast("string"))
    et = F.col("event_type")
    return ev.select(
        F.col("ts").alias("seq_ts"), F.col("event_id").alias("seq_id"), "user_id",
        node.alias("node_id"),
        F.when(et.isin("click", "signup"), F.lit("setup")).otherwise(F.lit("call")).alias("phase"),
        F.when(et == "error", F.lit("failed")).when(et == "view", F.lit("skipped"))
        .otherwise(F.lit("passed")).alias("outcome"),
        F.col("ts").cast("date").alias("session"), "event_type", "value",
    )


def items(rep: DataFrame) -> DataFrame:
    """Item inventory: one row per node with its file, newest report time
    as ``mtime`` and the case number as collection position."""
    return rep.groupBy("node_id").agg(
        F.max("seq_ts").alias("mtime"), F.min("user_id").alias("pos")
    ).withColumn("path", R.file_part(F.col("node_id")))


# ------------------------------------------------------------------ G1
@query("last_failed", ("G1",), REPORTS_SQL + "SELECT node_id FROM failing")
def last_failed(spark, sf_dir):
    return R.last_failed(reports(spark, sf_dir))


# ------------------------------------------------------------------ O1, J2
@query(
    "failed_first",
    ("O1", "J2"),
    REPORTS_SQL + """
    SELECT i.node_id, f.node_id IS NOT NULL AS failed, i.pos,
           row_number() OVER (ORDER BY (f.node_id IS NULL), i.pos) AS run_order
    FROM items i LEFT JOIN failing f USING (node_id)
    """,
)
def failed_first(spark, sf_dir):
    rep = reports(spark, sf_dir)
    marked = R.mark_known(items(rep), R.last_failed(rep))
    ranked = number_rows(marked, [F.when(F.col("failed"), 0).otherwise(1), F.col("pos")], name="run_order")
    return ranked.select("node_id", "failed", "pos", "run_order")


# ------------------------------------------------------------------ P5, P6
@query(
    "rerun_or_all",
    ("P5", "P6", "J2"),
    REPORTS_SQL + """
    SELECT i.node_id FROM items i
    WHERE i.node_id IN (SELECT node_id FROM failing)
       OR NOT EXISTS (SELECT 1 FROM items i2 JOIN failing f USING (node_id))
    """,
)
def rerun_or_all(spark, sf_dir):
    rep = reports(spark, sf_dir)
    return R.select_known(items(rep), R.last_failed(rep)).select("node_id")


@query(
    "rerun_by_file",
    ("P5",),
    REPORTS_SQL + """
    , marked AS (SELECT i.node_id, i.path, f.node_id IS NOT NULL AS failed FROM items i LEFT JOIN failing f USING (node_id)),
    per_file AS (SELECT path, bool_or(failed) AS any_failed FROM marked GROUP BY path)
    SELECT m.node_id, m.path FROM marked m JOIN per_file p USING (path) WHERE m.failed OR NOT p.any_failed
    """,
)
def rerun_by_file(spark, sf_dir):
    rep = reports(spark, sf_dir)
    marked = R.mark_known(items(rep), R.last_failed(rep))
    return R.filter_or_all(marked, F.col("failed"), group="path").select("node_id", "path")


@query("deselect_passed", ("J2", "P6"), REPORTS_SQL + """
    SELECT node_id FROM items WHERE node_id NOT IN (SELECT node_id FROM failing)""")
def deselect_passed(spark, sf_dir):
    rep = reports(spark, sf_dir)
    return R.deselect_known(items(rep), R.last_failed(rep)).select("node_id")


# ------------------------------------------------------------------ U4
_PATHS_SQL = """
, inventory AS (
  SELECT DISTINCT array_to_string(parts[1:i], '/') AS path
  FROM (SELECT string_split(path, '/') AS parts FROM items) t, range(1, len(parts) + 1) r(i)),
closure AS (
  SELECT DISTINCT array_to_string(parts[1:i], '/') AS path
  FROM (SELECT string_split(split_part(node_id, '::', 1), '/') AS parts FROM failing) t, range(1, len(parts) + 1) r(i))
"""


@query("path_closure", ("U4", "F1"), REPORTS_SQL + _PATHS_SQL + """
    SELECT path FROM closure WHERE path IN (SELECT path FROM inventory)""")
def path_closure(spark, sf_dir):
    rep = reports(spark, sf_dir)
    inv = R.path_inventory(items(rep))
    return R.failing_paths(R.last_failed(rep), inv)


# ------------------------------------------------------------------ P7, P8
_FILES_SQL = REPORTS_SQL + """
, saved AS (
  SELECT node_id FROM failing WHERE CAST(regexp_extract(node_id, 'case([0-9]+)', 1) AS BIGINT) % 20 IN (7, 12, 13)
  UNION SELECT 'pkg1/mod1.py::gone'),
inventory AS (
  SELECT DISTINCT array_to_string(parts[1:i], '/') AS path
  FROM (SELECT string_split(path, '/') AS parts FROM items) t, range(1, len(parts) + 1) r(i)),
closure AS (
  SELECT DISTINCT array_to_string(parts[1:i], '/') AS path
  FROM (SELECT string_split(split_part(node_id, '::', 1), '/') AS parts FROM saved) t, range(1, len(parts) + 1) r(i)
  WHERE array_to_string(parts[1:i], '/') IN (SELECT path FROM inventory)),
marked AS (
  SELECT i.node_id, i.path, i.node_id IN (SELECT node_id FROM saved) AS failed, i.path IN (SELECT path FROM closure) AS in_lf
  FROM items i),
levels AS (
  SELECT path, i, array_to_string(parts[1:i], '/') AS above
  FROM (SELECT DISTINCT path, string_split(path, '/') AS parts FROM items) t, range(1, len(parts) + 1) r(i)),
collected AS (
  SELECT l.path, list({'late': c.path IS NULL, 'above': l.above} ORDER BY l.i) AS place
  FROM levels l LEFT JOIN closure c ON c.path = l.above GROUP BY l.path),
first_hit AS (SELECT min(place) AS place FROM collected WHERE path IN (SELECT path FROM marked WHERE failed AND in_lf)),
decided AS (
  SELECT m.*, coalesce(c.place < (SELECT place FROM first_hit), true) AS before FROM marked m JOIN collected c USING (path))
"""


def saved_failures(rep: DataFrame) -> DataFrame:
    """The failures known from a run that covered the modules 7, 12 and 13
    only, and one of a case that is gone since: other modules are clean,
    and one file with a known failure no longer shows it."""
    module = F.regexp_extract("node_id", "case([0-9]+)", 1).cast("bigint") % 20
    known = R.last_failed(rep).where(module.isin(7, 12, 13))
    return known.unionByName(rep.sparkSession.createDataFrame([("pkg1/mod1.py::gone",)], "node_id string"))


@query("select_in_files", ("P7",), _FILES_SQL + """
    SELECT node_id, path, before OR (in_lf AND failed) AS kept FROM decided""")
def select_in_files(spark, sf_dir):
    rep = reports(spark, sf_dir)
    it = items(rep)
    failing = saved_failures(rep)
    lf = R.failing_paths(failing, R.path_inventory(it))
    kept, _ = R.select_in_files(it, failing, lf)
    return kept.select("node_id", "path", "kept")


@query("file_prune", ("P8",), _FILES_SQL + """
    SELECT path, bool_or(NOT before AND NOT in_lf) AS skipped FROM decided GROUP BY path""")
def file_prune(spark, sf_dir):
    rep = reports(spark, sf_dir)
    it = items(rep)
    failing = saved_failures(rep)
    lf = R.failing_paths(failing, R.path_inventory(it))
    _, files = R.select_in_files(it, failing, lf)
    return files


# ------------------------------------------------------------------ G6
@query("status_line", ("G6",), _FILES_SQL + """
    , counts AS (
      SELECT (SELECT count(*) FROM saved) AS known,
             (SELECT count(*) FROM items WHERE node_id IN (SELECT node_id FROM saved)) AS rerun,
             (SELECT count(*) FROM (SELECT path FROM decided GROUP BY path HAVING bool_or(NOT before AND NOT in_lf)))
               AS skipped_files)
    SELECT known, rerun, skipped_files,
           -- Fixed values: the sentences of the status line.
           CASE WHEN known = 0 THEN 'no previously failed tests, not deselecting items.'
                ELSE CASE WHEN rerun = 0 THEN printf('%d known failures not in selected tests', known)
                          ELSE printf('rerun previous %d ', rerun) || CASE WHEN rerun = 1 THEN 'failure' ELSE 'failures' END END
                     || CASE WHEN skipped_files > 0 THEN printf(' (skipped %d %s)', skipped_files,
                          CASE WHEN skipped_files = 1 THEN 'file' ELSE 'files' END) ELSE '' END
           END AS status
    FROM counts""")
def status_line(spark, sf_dir):
    rep = reports(spark, sf_dir)
    it = items(rep)
    failing = saved_failures(rep)
    lf = R.failing_paths(failing, R.path_inventory(it))
    _, files = R.select_in_files(it, failing, lf)
    return R.status_line(it, failing, files)


# ------------------------------------------------------------------ O3
@query("paths_first", ("O3",), REPORTS_SQL + _PATHS_SQL + """
    , files AS (SELECT DISTINCT path FROM items)
    SELECT path, path IN (SELECT path FROM closure) AS first,
           row_number() OVER (ORDER BY path NOT IN (SELECT path FROM closure), path) AS run_order
    FROM files""")
def paths_first(spark, sf_dir):
    rep = reports(spark, sf_dir)
    it = items(rep)
    lf = R.failing_paths(R.last_failed(rep), R.path_inventory(it))
    files = it.select("path").distinct()
    hit = lf.withColumn("__h", F.lit(True))
    marked = files.join(hit, "path", "left").withColumn("first", F.coalesce("__h", F.lit(False))).drop("__h")
    return number_rows(marked, [F.when(F.col("first"), 0).otherwise(1), F.col("path")], name="run_order")


# ------------------------------------------------------------------ O2
_NEW_SQL = REPORTS_SQL + f"""
, before AS (SELECT DISTINCT node_id FROM reports WHERE seq_ts < TIMESTAMP '{CUT}'),
after AS (
  SELECT node_id, min(seq_id) AS pos, arg_max(seq_ts, seq_id) AS mtime
  FROM reports WHERE seq_ts >= TIMESTAMP '{CUT}' GROUP BY node_id)
"""


@query("new_first", ("O2",), _NEW_SQL + """
    SELECT a.node_id, b.node_id IS NULL AS is_new, a.pos,
           row_number() OVER (ORDER BY (b.node_id IS NOT NULL), a.mtime DESC, a.pos) AS run_order
    FROM after a LEFT JOIN before b USING (node_id)""")
def new_first(spark, sf_dir):
    rep = reports(spark, sf_dir)
    cut = F.col("seq_ts") < F.lit(CUT).cast("timestamp_ntz")
    known = rep.where(cut).select("node_id")
    after = rep.where(~cut).select("node_id", F.col("seq_ts").alias("mtime"), F.col("seq_id").alias("pos"))
    ordered = R.new_first(after, known)
    return number_rows(
        ordered, [F.when(F.col("is_new"), 0).otherwise(1), F.col("mtime").desc(), F.col("pos")], name="run_order"
    ).select("node_id", "is_new", "pos", "run_order")


# ------------------------------------------------------------------ G5, U1
@query("known_union", ("G5", "U1"), _NEW_SQL + """
    SELECT node_id FROM before UNION SELECT node_id FROM after""")
def known_union(spark, sf_dir):
    rep = reports(spark, sf_dir)
    cut = F.col("seq_ts") < F.lit(CUT).cast("timestamp_ntz")
    return rep.where(cut).select("node_id").union(rep.where(~cut).select("node_id")).distinct()


@query("first_seen", ("U1", "W2"), REPORTS_SQL + """
    SELECT node_id, arg_min(seq_id, (seq_ts, seq_id)) AS first_id, CAST(min(seq_ts) AS DATE) AS first_day
    FROM reports GROUP BY node_id""")
def first_seen(spark, sf_dir):
    rep = reports(spark, sf_dir)
    return rep.groupBy("node_id").agg(
        F.min_by("seq_id", R.seq_struct()).alias("first_id"), F.min("seq_ts").cast("date").alias("first_day"))


# ------------------------------------------------------------------ U2, U3, S6
@query("keysets_equal", ("U2",), _NEW_SQL + """
    SELECT only_before, only_after, only_before = 0 AND only_after = 0 AS equal FROM (
      SELECT (SELECT count(*) FROM (SELECT node_id FROM before EXCEPT SELECT node_id FROM after)) AS only_before,
             (SELECT count(*) FROM (SELECT node_id FROM after EXCEPT SELECT node_id FROM before)) AS only_after)""")
def keysets_equal(spark, sf_dir):
    from tabletrust.operators.keyed import keyset_diff

    rep = reports(spark, sf_dir)
    cut = F.col("seq_ts") < F.lit(CUT).cast("timestamp_ntz")
    return keyset_diff(rep.where(cut).select("node_id"), rep.where(~cut).select("node_id"))


@query("state_changed", ("U3", "S6"), REPORTS_SQL + f"""
    , old_rel AS (SELECT node_id, arg_max(outcome = 'failed', (seq_ts, seq_id)) AS failing FROM relevant
                  WHERE seq_ts < TIMESTAMP '{CUT}' GROUP BY node_id),
    old_failing AS (SELECT node_id FROM old_rel WHERE failing)
    SELECT only_before, only_after, only_before = 0 AND only_after = 0 AS equal FROM (
      SELECT (SELECT count(*) FROM (SELECT node_id FROM failing EXCEPT SELECT node_id FROM old_failing)) AS only_before,
             (SELECT count(*) FROM (SELECT node_id FROM old_failing EXCEPT SELECT node_id FROM failing)) AS only_after)""")
def state_changed(spark, sf_dir):
    """Failing set after the whole month against the set saved mid-month:
    would the session-end write happen?"""
    from tabletrust.operators.keyed import keyset_diff

    rep = reports(spark, sf_dir)
    cut = F.col("seq_ts") < F.lit(CUT).cast("timestamp_ntz")
    return keyset_diff(R.last_failed(rep), R.last_failed(rep.where(cut)))


# ------------------------------------------------------------------ G4
@query("phase_map", ("G4", "W1"), REPORTS_SQL + """
    , per_phase AS (SELECT node_id, phase, arg_max(outcome = 'passed', (seq_ts, seq_id)) AS passed
                    FROM reports GROUP BY node_id, phase)
    SELECT node_id, max(CASE WHEN phase = 'setup' THEN passed END) AS setup_passed,
           max(CASE WHEN phase = 'call' THEN passed END) AS call_passed
    FROM per_phase GROUP BY node_id""")
def phase_map(spark, sf_dir):
    from tabletrust.functions.scalar import map_get

    pm = R.phase_map(reports(spark, sf_dir))
    return pm.select("node_id", map_get(F.col("phases"), "setup").cast("boolean").alias("setup_passed"),
                     map_get(F.col("phases"), "call").cast("boolean").alias("call_passed"))


# ------------------------------------------------------------------ G3
@query("first_error", ("G3",), REPORTS_SQL + """
    SELECT node_id, arg_min(seq_id, (seq_ts, seq_id)) AS first_error, count(*) AS n_errors
    FROM reports WHERE event_type = 'error' GROUP BY node_id""")
def first_error(spark, sf_dir):
    rep = reports(spark, sf_dir).withColumn(
        "error", F.when(F.col("event_type") == "error", F.col("seq_id")))
    return R.first_error(rep)


# ------------------------------------------------------------------ F9
@query("outcome_norm", ("F9",), """
    SELECT event_id,
           CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'passed' WHEN 'view' THEN 'skipped'
                           WHEN 'click' THEN 'xfailed' WHEN 'signup' THEN 'failed' END AS outcome,
           CASE WHEN event_type = 'signup' THEN 'Unexpected success' END AS message
    FROM events""")
def outcome_norm(spark, sf_dir):
    """Events read as unit-test results: error, success (purchase), skip
    (view), expected failure (click), unexpected success (signup)."""
    ev = Tables(spark, sf_dir).events
    raw = (F.when(F.col("event_type") == "error", F.lit("error"))
           .when(F.col("event_type") == "purchase", F.lit("success"))
           .when(F.col("event_type") == "view", F.lit("skip"))
           .when(F.col("event_type") == "click", F.lit("expected failure"))
           .when(F.col("event_type") == "signup", F.lit("unexpected success")))
    outcome, message = R.normalize_outcome(raw)
    return ev.select("event_id", outcome.alias("outcome"), message.alias("message"))


# ------------------------------------------------------------------ J6
@query("inherited_flag", ("J6",), REPORTS_SQL + """
    , own AS (SELECT node_id, split_part(node_id, '::', 1) AS path,
                     bool_or(event_type = 'view' AND value > 250) AS skip FROM reports GROUP BY node_id),
    files AS (SELECT path, bool_or(event_type = 'view' AND value > 300) AS skip
              FROM (SELECT split_part(node_id, '::', 1) AS path, event_type, value FROM reports) GROUP BY path)
    SELECT o.node_id, o.skip AS own_skip, coalesce(o.skip, false) OR coalesce(f.skip, false) AS inherited
    FROM own o LEFT JOIN files f USING (path)""")
def inherited_flag(spark, sf_dir):
    """A skip marker on a module (a rare high-value view in it)
    applies to all of its cases; a case may also carry its own."""
    rep = reports(spark, sf_dir).withColumn("path", R.file_part(F.col("node_id")))
    own = rep.groupBy("node_id", "path").agg(
        F.max((F.col("event_type") == "view") & (F.col("value") > 250)).alias("own_skip"))
    files = rep.groupBy("path").agg(F.max((F.col("event_type") == "view") & (F.col("value") > 300)).alias("skip"))
    out = R.inherited_flag(own, files, "path", "path", "own_skip", "skip")
    return out.select("node_id", "own_skip", "inherited")


# ------------------------------------------------------------------ G2, W7
# The run starts from the state saved at the cut: the items that failed, and
# the modules that did not collect on their last day.  Its rows come first.
_COLLECT_SQL = REPORTS_SQL + f"""
, all_mods AS (
  SELECT split_part(node_id, '::', 1) AS node_id, CAST(CAST(seq_ts AS DATE) AS TIMESTAMP) AS seq_ts,
         CAST(-1 AS BIGINT) AS seq_id,
         CASE WHEN bool_or(event_type = 'error' AND value > 150) THEN 'set' ELSE 'pass' END AS kind
  FROM reports GROUP BY 1, 2),
mod_reports AS (
  SELECT * FROM all_mods WHERE seq_ts >= TIMESTAMP '{CUT}'
  UNION ALL SELECT node_id, TIMESTAMP '1900-01-01', 0, 'set'
  FROM (SELECT node_id, arg_max(kind = 'set', seq_ts) AS bad FROM all_mods WHERE seq_ts < TIMESTAMP '{CUT}' GROUP BY 1) WHERE bad),
pkg_reports AS (
  SELECT split_part(node_id, '/', 1) AS node_id, CAST(CAST(seq_ts AS DATE) AS TIMESTAMP) AS seq_ts,
         CAST(-2 AS BIGINT) AS seq_id,
         CASE WHEN bool_or(event_type = 'error' AND value > 250) THEN 'set' ELSE 'pass' END AS kind
  FROM reports WHERE seq_ts >= TIMESTAMP '{CUT}' GROUP BY 1, 2),
pkg_kids AS (SELECT DISTINCT split_part(node_id, '/', 1) AS parent, split_part(node_id, '::', 1) AS child FROM reports),
mod_kids AS (SELECT DISTINCT split_part(node_id, '::', 1) AS parent, node_id AS child FROM reports),
pkg_ev AS (SELECT *, lag(kind) OVER (PARTITION BY node_id ORDER BY seq_ts, seq_id, kind DESC) AS prev FROM pkg_reports),
mod_marks AS (
  SELECT k.child AS node_id, e.seq_ts, e.seq_id, 'set' AS kind
  FROM pkg_ev e JOIN pkg_kids k ON k.parent = e.node_id WHERE e.kind = 'pass' AND e.prev = 'set'),
mod_ev AS (
  SELECT *, lag(kind) OVER (PARTITION BY node_id ORDER BY seq_ts, seq_id, kind DESC) AS prev
  FROM (SELECT * FROM mod_reports UNION ALL SELECT * FROM mod_marks)),
item_marks AS (
  SELECT k.child AS node_id, e.seq_ts, e.seq_id, 'set' AS kind
  FROM mod_ev e JOIN mod_kids k ON k.parent = e.node_id WHERE e.kind = 'pass' AND e.prev = 'set'),
item_ev AS (
  SELECT node_id, TIMESTAMP '1900-01-01' AS seq_ts, 0 AS seq_id, 'set' AS kind
  FROM (SELECT node_id, arg_max(outcome = 'failed', (seq_ts, seq_id)) AS bad FROM relevant
        WHERE seq_ts < TIMESTAMP '{CUT}' GROUP BY 1) WHERE bad
  UNION ALL
  SELECT node_id, seq_ts, seq_id, CASE WHEN outcome = 'failed' THEN 'set' ELSE 'pass' END AS kind
  FROM relevant WHERE seq_ts >= TIMESTAMP '{CUT}'
  UNION ALL SELECT * FROM item_marks),
final AS (
  SELECT node_id, arg_max(kind = 'set', (seq_ts, seq_id, kind)) AS failing FROM item_ev GROUP BY node_id
  UNION ALL SELECT node_id, arg_max(kind = 'set', (seq_ts, seq_id)) FROM mod_ev GROUP BY node_id
  UNION ALL SELECT node_id, arg_max(kind = 'set', (seq_ts, seq_id)) FROM pkg_ev GROUP BY node_id)
"""


def collector_reports(rep: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Daily collection reports: a module fails to collect on a day when
    one of its cases logs an error above 150, a package when one above
    250.  Collection runs at the start of the day, packages first."""
    day = F.col("seq_ts").cast("date").cast("timestamp_ntz")
    module = R.file_part(F.col("node_id"))
    package = F.split(F.col("node_id"), "/").getItem(0)

    def daily(node, seq_id, limit):
        bad = (F.col("event_type") == "error") & (F.col("value") > limit)
        return rep.groupBy(node.alias("node_id"), day.alias("seq_ts")).agg(
            F.max(bad).alias("bad")).select(
            "node_id", "seq_ts", F.lit(seq_id).cast("bigint").alias("seq_id"),
            F.when(F.col("bad"), F.lit("failed")).otherwise(F.lit("passed")).alias("outcome"))

    reports_ = daily(package, -2, 250).unionByName(daily(module, -1, 150))
    children = rep.select(package.alias("parent"), module.alias("child")).unionByName(
        rep.select(module.alias("parent"), F.col("node_id").alias("child"))).distinct()
    return reports_, children


@query("collector_expand", ("G2", "W7"), _COLLECT_SQL + "SELECT DISTINCT node_id FROM final WHERE failing")
def collector_expand(spark, sf_dir):
    rep = reports(spark, sf_dir)
    start, after, collect, children = from_saved_state(rep)
    return R.expand_collectors(after, collect, children, start=start)


def from_saved_state(rep: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(state at the cut, item reports, collect reports and tree after it)."""
    old = F.col("seq_ts") < F.lit(CUT).cast("timestamp_ntz")
    collect, children = collector_reports(rep)
    modules = collect.where(old & (F.col("seq_id") == -1)).groupBy("node_id").agg(
        F.max_by(F.col("outcome") == "failed", "seq_ts").alias("bad")).where("bad").select("node_id")
    return R.last_failed(rep.where(old)).unionByName(modules), rep.where(~old), collect.where(~old), children


# ------------------------------------------------------------------ W7
@query("state_transitions", ("W7",), """
    WITH e AS (SELECT event_id, event_type, user_id % 3 = 0 AS busy, CASE WHEN user_id % 3 = 0 THEN -1 ELSE user_id END AS who, ts FROM events),
    p AS (SELECT *, lag(event_type) OVER (PARTITION BY who ORDER BY ts, event_id) AS was FROM e)
    SELECT event_id, was, event_type AS now FROM p WHERE was IS NULL OR was <> event_type""")
def state_transitions(spark, sf_dir):
    """Where the kind of a user's events changes; a third of all users are
    one, whose events spread over many tasks."""
    from tabletrust.operators.transitions import transitions

    ev = Tables(spark, sf_dir).events
    who = F.when(F.col("user_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    rows = ev.select("event_id", "event_type", "ts", who.alias("who"))
    return transitions(rows, "event_type", ["ts", "event_id"], ["who"]).select("event_id", "was", "now")

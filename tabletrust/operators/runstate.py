"""Run-history state over outcome reports.

Reports are rows ``(node_id, seq_ts, seq_id, phase, outcome)``; ``seq``
= ``(seq_ts, seq_id)`` orders them, so replays and out-of-order arrival
fold to the same state.  Folding is an aggregation (``max_by`` over the
sequence), which Spark combines map-side: a node that carries a third of
all reports is reduced in every map task before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabletrust.operators.transitions import previous_value

SEQ = ("seq_ts", "seq_id")


def seq_struct(seq=SEQ) -> Column:
    return F.struct(*[F.col(c) for c in seq])


# ------------------------------------------------------------------ F1
def file_part(node: Column) -> Column:
    """Text before the first ``::`` of a node id."""
    return F.substring_index(node, "::", 1)


# ------------------------------------------------------------------ G1
def relevant(phase: Column, outcome: Column) -> Column:
    """Reports that change the failing state: a passed *call*, any skip
    (clear) and any failure (set).  Passed setup/teardown change nothing."""
    return ((phase == "call") & (outcome == "passed")) | (outcome == "skipped") | (outcome == "failed")


def last_state(reports: DataFrame, node="node_id", seq=SEQ) -> DataFrame:
    """Per node the last relevant report: ``node, last_seq, failing``.

    This is also the persisted state: folding new reports into it is a
    union with the old state followed by the same aggregation (see
    ``merge_state``)."""
    r = reports.where(relevant(F.col("phase"), F.col("outcome")))
    return r.groupBy(node).agg(
        F.max_by(F.col("outcome") == "failed", seq_struct(seq)).alias("failing"),
        F.max(seq_struct(seq)).alias("last_seq"),
    )


def merge_state(state: DataFrame, update: DataFrame, node="node_id") -> DataFrame:
    """Fold a newer ``last_state`` into an older one: newest sequence wins."""
    both = state.select(node, "last_seq", "failing").unionByName(update.select(node, "last_seq", "failing"))
    return both.groupBy(node).agg(
        F.max_by("failing", "last_seq").alias("failing"), F.max("last_seq").alias("last_seq")
    )


def last_failed(reports: DataFrame, node="node_id", seq=SEQ) -> DataFrame:
    """G1: the nodes currently failing."""
    return last_state(reports, node, seq).where("failing").select(node)


# ------------------------------------------------------------------ G2, W7
def expand_collectors(item_reports: DataFrame, collect_reports: DataFrame, children: DataFrame | None = None,
                      node="node_id", seq=SEQ, start: DataFrame | None = None) -> DataFrame:
    """Failing state with collector reports.

    A failed collector report marks the collector failing.  When a
    collector that is failing reports passed or skipped, it leaves the
    failing set and *all its children* become failing until they run.
    ``children(parent, child)`` lists what each collector yields; without
    it, each collect report carries its own ``children`` array (what that
    collection yielded), and an expansion uses the array of the report
    that triggered it -- only those arrays are exploded.  A child may
    itself be a collector.  The state of a collector depends on its
    parent's expansions, so the plan walks the tree one depth level per
    round (each collector event looks back at the one before, by slices, so
    that a collector of any size spreads over tasks; as many
    rounds as the reporting collectors are deep, and an error if one comes
    up twice: a cycle or a child of two levels); expansion events of each level are checkpointed to the
    shared folder so the plan does not grow with the depth.  Item state is
    then the last of its own relevant reports and its inherited marks.

    ``start`` (``node_id``) are the nodes that failed before any of these
    reports.  A collector whose parent never reports is a root.

    Returns the failing nodes (items and collectors): ``node_id``.
    """
    seq = list(seq)
    before = None
    if start is not None:  # NULL sequences sort before all others
        before = start.select(node, *[F.lit(None).cast(collect_reports.schema[c].dataType).alias(c) for c in seq], F.lit("set").alias("kind")).distinct()
    ev_cols = [node, *seq, "kind"]
    # Collector reports and the tree are read by every level: materialise
    # them once (both are far smaller than the item reports).
    own = collect_reports.select(
        node, *seq,
        F.when(F.col("outcome") == "failed", F.lit("set")).otherwise(F.lit("pass")).alias("kind"),
    ).checkpoint(eager=True)
    collectors = own.select(node).distinct().checkpoint(eager=True)
    per_report = children is None
    if per_report:
        # the tree (who can be whose child) from all reports, for the levels
        children = collect_reports.select(F.col(node).alias("parent"), F.explode("children").alias("child")).distinct()
        listed = collect_reports.select(node, *seq, "children")
    kids = children.select(F.col("parent"), F.col("child")).checkpoint(eager=True)
    if before is not None:
        own = own.unionByName(before.join(collectors, node, "left_semi")).checkpoint(eager=True)
    reporting = collectors.select(F.col(node).alias("parent"))
    is_child = kids.join(reporting, "parent", "left_semi").select(F.col("child").alias(node)).distinct()
    level = collectors.join(is_child, node, "left_anti").checkpoint(eager=True)
    inherited = None  # 'set' events handed down to the current level
    collector_final = []
    item_marks = []
    seen = level
    while not level.isEmpty():
        events = own.join(level, node, "left_semi")
        if inherited is not None:
            events = events.unionByName(inherited.join(level, node, "left_semi"))
        events = previous_value(events, "kind", [*seq, F.col("kind").desc()], [node])
        collector_final.append(
            events.groupBy(node).agg(F.max_by(F.col("kind") == "set", seq_struct(seq)).alias("failing"))
        )
        opened = events.where((F.col("kind") == "pass") & (F.col("prev") == "set")).select(node, *seq)
        if per_report:
            marks = opened.join(listed, [node, *seq]).select(
                F.explode("children").alias(node), *seq, F.lit("set").alias("kind"))
        else:
            marks = opened.join(kids, opened[node] == kids["parent"]).select(
                F.col("child").alias(node), *seq, F.lit("set").alias("kind"))
        marks = marks.checkpoint(eager=True)
        item_marks.append(marks)
        inherited = marks if inherited is None else inherited.unionByName(marks)
        nxt = kids.join(level, kids["parent"] == level[node], "left_semi").select(F.col("child").alias(node))
        level = nxt.join(collectors, node, "left_semi").distinct().checkpoint(eager=True)
        if not level.join(seen, node, "left_semi").isEmpty():
            raise ValueError("the collectors are not a tree: one is its own ancestor or on two levels")
        seen = seen.union(level).checkpoint(eager=True)
    if not collectors.join(seen, node, "left_anti").isEmpty():
        raise ValueError("the collectors are not a tree: some are only reached from each other")
    items = item_reports.where(relevant(F.col("phase"), F.col("outcome"))).select(
        node, *seq, F.when(F.col("outcome") == "failed", F.lit("set")).otherwise(F.lit("pass")).alias("kind")
    )
    if before is not None:
        items = items.unionByName(before.join(collectors, node, "left_anti"))
    if not item_marks:  # no collector reported
        return items.groupBy(node).agg(F.max_by(F.col("kind") == "set", F.struct(*seq, "kind")).alias("failing")).where("failing").select(node)
    all_marks = reduce(DataFrame.unionByName, item_marks).join(collectors, node, "left_anti")
    item_state = items.unionByName(all_marks.select(*ev_cols)).groupBy(node).agg(
        F.max_by(F.col("kind") == "set", F.struct(*[F.col(c) for c in seq], F.col("kind"))).alias("failing")
    )
    col_state = reduce(DataFrame.unionByName, collector_final)
    return item_state.unionByName(col_state).where("failing").select(node).distinct()


# ------------------------------------------------------------------ G3
def first_error(events: DataFrame, node="node_id", error="error", seq=SEQ) -> DataFrame:
    """Errors queue per item; the first recorded is reported first."""
    return events.where(F.col(error).isNotNull()).groupBy(node).agg(
        F.min_by(error, seq_struct(seq)).alias("first_error"),
        F.count(F.lit(1)).alias("n_errors"),
    )


def nth_error(events: DataFrame, n: int, node="node_id", error="error", seq=SEQ) -> DataFrame:
    """The ``n``-th recorded error per item (1 = first), numbered in
    sequence order by the skew-proof ``number_rows``."""
    from tabletrust.operators.numbering import number_rows

    if n < 1:
        raise ValueError("n counts from 1")
    errs = events.where(F.col(error).isNotNull()).select(node, *seq, error)
    numbered = number_rows(errs, list(seq), [node], name="__k")
    return numbered.where(F.col("__k") == n).select(node, error)


# ------------------------------------------------------------------ G4
def phase_map(reports: DataFrame, node="node_id", seq=SEQ) -> DataFrame:
    """Per node: map phase -> passed, the later report of a phase winning.
    At most one entry per phase after the dedup, so the map stays tiny."""
    last = reports.groupBy(node, "phase").agg(
        F.max_by(F.col("outcome") == "passed", seq_struct(seq)).alias("passed")
    )
    return last.groupBy(node).agg(F.map_from_entries(F.collect_list(F.struct("phase", "passed"))).alias("phases"))


# ------------------------------------------------------------------ P5
def filter_or_all(df: DataFrame, predicate: Column, group=None) -> DataFrame:
    """Keep the rows matching ``predicate``; a group (or, without ``group``,
    the whole frame) with no match at all is kept whole."""
    flagged = df.withColumn("__hit", F.coalesce(predicate, F.lit(False)))
    if group is None:
        if flagged.where("__hit").isEmpty():
            return df
        return flagged.where("__hit").drop("__hit")
    group = [group] if isinstance(group, str) else list(group)
    # Group flags are an aggregate (map-side combined), joined back on the
    # group key -- no window holding a whole group in one task.
    hits = flagged.groupBy(*group).agg(F.max("__hit").alias("__any"))
    j = flagged.join(hits, on=group, how="left")
    return j.where(F.col("__hit") | ~F.col("__any")).drop("__hit", "__any")


# ------------------------------------------------------------------ P6, J2
def mark_known(items: DataFrame, failing: DataFrame, node="node_id") -> DataFrame:
    """Items with a ``failed`` flag from the failing set (left join on the
    node id; Spark broadcasts the failing set when it is measured small)."""
    f = failing.select(node).distinct().withColumn("__f", F.lit(True))
    return items.join(f, node, "left").withColumn("failed", F.coalesce("__f", F.lit(False))).drop("__f")


def select_known(items: DataFrame, failing: DataFrame, node="node_id", no_failures="all") -> DataFrame:
    """Run only the previously failing items.

    Without any known failure, keep everything (``no_failures='all'``) or
    nothing (``'none'``); with known failures none of which is among the
    items, keep everything."""
    if no_failures not in ("all", "none"):
        raise ValueError("no_failures must be 'all' or 'none'")
    if failing.isEmpty():
        return items.limit(0) if no_failures == "none" else items
    return filter_or_all(mark_known(items, failing, node), F.col("failed")).drop("failed")


def deselect_known(items: DataFrame, failing: DataFrame, node="node_id") -> DataFrame:
    """Complement of the selection: items not in the failing set."""
    return items.join(failing.select(node), node, "left_anti")


# ------------------------------------------------------------------ O1, O3
def failed_first(items: DataFrame, failing: DataFrame, pos="pos", node="node_id") -> DataFrame:
    """Failing items first, then the rest; input order (``pos``) inside
    each block.  A range-partitioned sort, never a single-task window."""
    return mark_known(items, failing, node).orderBy(F.col("failed").desc(), F.col(pos).asc())


def paths_first(files: DataFrame, paths: DataFrame, path="path", pos="pos") -> DataFrame:
    """O3: stable sort with the given paths first."""
    p = paths.select(path).distinct().withColumn("__hit", F.lit(True))
    j = files.join(p, path, "left").withColumn("first", F.coalesce("__hit", F.lit(False))).drop("__hit")
    return j.orderBy(F.col("first").desc(), F.col(pos).asc())


# ------------------------------------------------------------------ O2
def new_first(items: DataFrame, known: DataFrame, node="node_id", mtime="mtime", pos="pos") -> DataFrame:
    """Unseen items first; newest ``mtime`` first inside each block, ties in
    input order.  Duplicate ids collapse to one: the first position is
    kept with the data of the last occurrence."""
    cols = [c for c in items.columns if c not in (node, pos)]
    dedup = items.groupBy(node).agg(
        F.min(pos).alias(pos),
        *[F.max_by(c, F.col(pos)).alias(c) for c in cols],
    )
    k = known.select(node).distinct().withColumn("__k", F.lit(True))
    j = dedup.join(k, node, "left").withColumn("is_new", F.col("__k").isNull()).drop("__k")
    return j.orderBy(F.col("is_new").desc(), F.col(mtime).desc(), F.col(pos).asc())


# ------------------------------------------------------------------ U4
def ancestor_paths(path: Column) -> Column:
    """All prefixes of a ``/`` path, itself included."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))


def failing_paths(failing: DataFrame, existing: DataFrame, node="node_id", path="path") -> DataFrame:
    """U4: files of failing nodes and all their parents, limited to the
    paths that exist."""
    files = failing.select(file_part(F.col(node)).alias("__file"))
    closure = files.select(F.explode(ancestor_paths(F.col("__file"))).alias(path)).distinct()
    return closure.join(existing.select(path), path, "left_semi")


def path_inventory(items: DataFrame, node="node_id", path="path") -> DataFrame:
    """Every file and directory named by the items' node ids."""
    return items.select(F.explode(ancestor_paths(file_part(F.col(node)))).alias(path)).distinct()


# ------------------------------------------------------------------ P7, P8
def collection_order(files: DataFrame, lf_paths: DataFrame, path="path") -> DataFrame:
    """(``path``, ``in_lf``, ``order``) of distinct files: at each level of
    the tree the entries among ``lf_paths`` come first, then by name.
    ``order`` compares as the files are collected."""
    lf = lf_paths.select(F.col(path).alias("__above")).distinct().withColumn("__lf", F.lit(True))
    levels = files.select(path).distinct().select(path, F.posexplode(ancestor_paths(F.col(path))).alias("__level", "__above"))
    flagged = levels.join(lf, "__above", "left").withColumn("__late", F.col("__lf").isNull())
    entry = F.struct("__level", "__late", "__above")
    return flagged.groupBy(path).agg(
        F.sort_array(F.collect_list(entry)).alias("order"),  # as many entries as the path has parts
        F.max(F.coalesce(F.col("__lf"), F.lit(False)) & (F.col("__above") == F.col(path))).alias("in_lf"))


def select_in_files(items: DataFrame, failing: DataFrame, lf_paths: DataFrame, init_paths=(),
                    node="node_id", path="path", collector: str | None = None) -> tuple[DataFrame, DataFrame]:
    """P7 + P8: file-level selection in collection order, in which paths
    with known failures go first (:func:`collection_order`).

    Files before the first one that holds a known failure are collected
    whole.  From that file on, a file among ``lf_paths`` keeps only its
    known failures, items under explicitly given paths and (with a
    ``collector`` flag column) its non-leaf nodes; any other file is
    skipped whole.  Returns ``(items with kept flag, files with skipped
    flag)``."""
    marked = mark_known(items, failing, node)
    order = collection_order(items, lf_paths, path)
    per_file = marked.groupBy(path).agg(F.max("failed").alias("__hit"))
    files = order.join(per_file, path)
    # The first file that is filtered: one row, a scalar subquery.
    first = files.where(F.col("__hit") & F.col("in_lf")).agg(F.min("order").alias("first")).scalar()
    files = files.withColumn("__first", first).withColumn(
        "__before", F.col("__first").isNull() | (F.col("order") < F.col("__first")))
    given = F.lit(False)
    for p in init_paths:
        given = given | (F.col(path) == p) | F.col(path).startswith(p.rstrip("/") + "/")
    inner = F.col("failed") | given
    if collector is not None:  # non-leaf nodes inside a failing file are kept
        inner = inner | F.coalesce(F.col(collector), F.lit(False))
    out = marked.join(files.select(path, "in_lf", "__before"), path).withColumn(
        "kept", F.col("__before") | (F.col("in_lf") & inner)).drop("in_lf", "__before")
    return out.select(*marked.columns, "kept"), files.select(path, (~F.col("__before") & ~F.col("in_lf")).alias("skipped"))


def prune_files(items: DataFrame, failing: DataFrame, lf_paths: DataFrame, node="node_id",
                path="path") -> tuple[DataFrame, DataFrame]:
    """Files skipped whole during a rerun, and their count (one row).
    Directories (packages) are never skipped: only item files are listed."""
    _, files = select_in_files(items, failing, lf_paths, node=node, path=path)
    skipped = files.where("skipped")
    return skipped.select(path), skipped.agg(F.count(F.lit(1)).alias("skipped_files"))


# ------------------------------------------------------------------ G5, U1
def known_keys(old: DataFrame, current: DataFrame, node="node_id") -> DataFrame:
    """The set of ids seen before or now (distinct), ordered ascending."""
    return old.select(node).union(current.select(node)).distinct().orderBy(node)


# ------------------------------------------------------------------ G6
def status_line(items: DataFrame, failing: DataFrame, skipped_files: DataFrame | None = None,
                node="node_id", failed_first_mode=False, no_failures="all") -> DataFrame:
    """One row: ``known, rerun, skipped_files, status`` with singular/plural
    text.  All counts come from one aggregate each."""
    # One aggregate over a tagged union: no join, one row out.
    tagged = failing.select(F.lit("known").alias("__t")).unionByName(
        items.join(failing.select(node).distinct(), node, "left_semi").select(F.lit("rerun").alias("__t")))
    if skipped_files is not None:
        tagged = tagged.unionByName(skipped_files.where("skipped").select(F.lit("skip").alias("__t")))
    row = tagged.agg(
        F.count_if(F.col("__t") == "known").alias("known"),
        F.count_if(F.col("__t") == "rerun").alias("rerun"),
        F.count_if(F.col("__t") == "skip").alias("skipped_files"),
    )
    # The sentences of the status line.
    noun = F.when(F.col("rerun") == 1, F.lit("failure")).otherwise(F.lit("failures"))
    suffix = F.lit(" first") if failed_first_mode else F.lit("")
    files = F.when(F.col("skipped_files") > 0, F.format_string(
        " (skipped %d %s)", F.col("skipped_files"),
        F.when(F.col("skipped_files") == 1, F.lit("file")).otherwise(F.lit("files")))).otherwise(F.lit(""))
    none_text = ("no previously failed tests, deselecting all items." if no_failures == "none"
                 else "no previously failed tests, not deselecting items.")
    status = (
        F.when(F.col("known") == 0, F.lit(none_text))
        .when(F.col("rerun") == 0, F.concat(F.format_string("%d known failures not in selected tests", F.col("known")), files))
        .otherwise(F.concat(F.format_string("rerun previous %d ", F.col("rerun")), noun, suffix, files))
    )
    return row.select("known", "rerun", "skipped_files", status.alias("status"))


# ------------------------------------------------------------------ F9
def normalize_outcome(raw: Column) -> tuple[Column, Column]:
    """Unit-test outcomes to report outcomes, and the message.

    error, failure -> failed; skip -> skipped; expected failure -> xfailed;
    unexpected success -> failed ("Unexpected success"); success -> passed.
    """
    outcome = (
        F.when(raw.isin("error", "failure"), F.lit("failed"))
        .when(raw == "skip", F.lit("skipped"))
        .when(raw == "expected failure", F.lit("xfailed"))
        .when(raw == "unexpected success", F.lit("failed"))
        .when(raw == "success", F.lit("passed"))
    )
    message = F.when(raw == "unexpected success", F.lit("Unexpected success"))
    return outcome, message


# ------------------------------------------------------------------ J6
def inherited_flag(items: DataFrame, parents: DataFrame, key: str, parent_key: str, flag: str,
                   parent_flag: str | None = None) -> DataFrame:
    """Own flag OR the parent's flag (a skip marker on a class applies to
    its methods)."""
    p = parents.select(F.col(parent_key).alias("__pk"), F.col(parent_flag or flag).alias("__pflag"))
    j = items.join(p, items[key] == p["__pk"], "left")
    return j.withColumn("inherited", F.coalesce(F.col(flag), F.lit(False)) | F.coalesce("__pflag", F.lit(False))).drop(
        "__pk", "__pflag")

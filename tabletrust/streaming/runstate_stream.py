"""Run state kept by Structured Streaming.

T1: per node the newest relevant report decides, a native streaming
aggregation (``max_by`` over the sequence): combined before the shuffle,
so a node with a third of all reports needs no task of its own, and kept in
the state store, so a micro-batch costs what it brings and not what is
known.  Sequences are compared, not arrival order: files out of order give
the same state.  ``last_failed_stateful`` appends the changes of each
micro-batch; with a TTL, idle nodes are forgotten
(``applyInPandasWithState``, since native aggregations have no timeout).

T3: ``last_failed_stream`` publishes the failing set when it changes.  It
is kept in two slots.  A batch reads the newest slot, writes the other one
and then, last, that slot's pointer; readers follow the newest pointer.
Publications have numbers of their own, so a query that starts again with a
new checkpoint, whose epochs start from 0, goes on from the published set.
An empty set is seen, old versions go, a batch that fails half-way leaves
the published set as it was, and a repeated batch (of the same query and
epoch) finds itself published and does nothing.

T2 ``first_seen_stream``: streaming ``dropDuplicates`` on the node id (the
seen set is the state), optionally bounded by a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tabletrust.operators.runstate import relevant

SLOTS = (0, 1)


POINTER = "version long, run string, epoch long"


def _published(spark: SparkSession, path: str) -> tuple[int, str | None, int, int] | None:
    """(version, run, epoch, slot) of the newest pointer; None if there is
    none.  (A pointer of an epoch alone counts that as its version.)"""
    found = []
    for slot in SLOTS:
        try:
            rows = spark.read.schema(POINTER).parquet(f"{path}/pointer_{slot}").collect()  # one row
        except AnalysisException:
            continue
        found += [(r["epoch"] if r["version"] is None else r["version"], r["run"], r["epoch"], slot) for r in rows]
    return max(found, key=lambda p: p[0], default=None)


def published_set(spark: SparkSession, path: str) -> DataFrame | None:
    """The failing set published last, or None before the first one."""
    path = path.rstrip("/")
    now = _published(spark, path)
    return None if now is None else spark.read.schema("node_id string").parquet(f"{path}/set_{now[3]}")


def publish_changes(spark: SparkSession, changed: DataFrame, epoch: int, path: str, run: str | None = None) -> bool:
    """Apply one batch of (``node_id``, ``failing``), one row per node, to
    the failing set; publish it if that changes it, and the first time.
    ``run`` names the query that counts the epochs.  Returns whether it was
    published."""
    path = path.rstrip("/")
    prev = _published(spark, path)
    if prev is not None and prev[1:3] == (run, epoch):
        return False  # a repeated batch
    # Read several times below: kept in a folder that the next batch reuses.
    changed.select("node_id", "failing").write.mode("overwrite").parquet(f"{path}/batch")
    changed = spark.read.schema("node_id string, failing boolean").parquet(f"{path}/batch")
    failing = changed.where("failing").select("node_id")
    if prev is None:
        new, slot = failing, SLOTS[0]
    else:
        old, slot = spark.read.schema("node_id string").parquet(f"{path}/set_{prev[3]}"), 1 - prev[3]
        appeared = failing.join(old, "node_id", "left_anti")
        gone = changed.where("not failing").join(old, "node_id", "left_semi").select("node_id")
        if appeared.union(gone).isEmpty():
            return False
        new = old.join(changed, "node_id", "left_anti").union(failing)
    new.write.mode("overwrite").parquet(f"{path}/set_{slot}")
    version = 0 if prev is None else prev[0] + 1
    pointer = spark.range(1).select(F.lit(version).cast("bigint").alias("version"), F.lit(run).cast("string").alias("run"), F.lit(epoch).cast("bigint").alias("epoch"))
    pointer.coalesce(1).write.mode("overwrite").parquet(f"{path}/pointer_{slot}")
    return True


def newest_reports(reports: DataFrame) -> DataFrame:
    """Per node its newest relevant report: ``node_id, failing, seq_ts,
    seq_id``; the same for a stream (in update mode) and a table."""
    seq = F.struct("seq_ts", "seq_id")
    newest = reports.where(relevant(F.col("phase"), F.col("outcome"))).groupBy("node_id").agg(
        F.max_by(F.col("outcome") == "failed", seq).alias("failing"), F.max(seq).alias("seq"))
    return newest.select("node_id", "failing", "seq.seq_ts", "seq.seq_id")


def _start(writer, checkpoint_path: str, available_now: bool):
    w = writer.option("checkpointLocation", checkpoint_path)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")).start()


def last_failed_stream(spark: SparkSession, reports_stream: DataFrame, publish_path: str, checkpoint_path: str,
                       available_now: bool = True):
    """Start the T1/T3 query; returns the ``StreamingQuery``.  With
    ``available_now`` it processes what is there and stops.  Read the
    published set with :func:`published_set`."""

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        # The query's id, which it keeps in its checkpoint.
        run = spark.read.text(f"{checkpoint_path.rstrip('/')}/metadata").first()[0]
        publish_changes(spark, batch, epoch_id, publish_path, run)

    return _start(newest_reports(reports_stream).writeStream.outputMode("update").foreachBatch(on_batch), checkpoint_path, available_now)


def first_seen_stream(reports_stream: DataFrame, sink_path: str, checkpoint_path: str,
                      watermark: str | None = None, available_now: bool = True):
    """Start the T2 query: every node id once, at its first arrival.
    With ``watermark`` the seen-set state is bounded
    (``dropDuplicatesWithinWatermark`` on the sequence time)."""
    s = reports_stream.select("node_id", "seq_ts", "seq_id")
    if watermark:
        # Watermarks need a TIMESTAMP event time; wall-clock TIMESTAMP_NTZ
        # sequences get a TIMESTAMP twin (only lateness differences matter).
        event_time = F.col("seq_ts").cast("timestamp")
        s = (s.withColumn("__event_time", event_time)
             .withWatermark("__event_time", watermark)
             .dropDuplicatesWithinWatermark(["node_id"])
             .drop("__event_time"))
    else:
        s = s.dropDuplicates(["node_id"])
    return _start(s.writeStream.format("parquet").option("path", sink_path).outputMode("append"), checkpoint_path, available_now)


# ------------------------------------------------------------------ T1, changes
STATE_SCHEMA = "ts_us long, seq_id long, failing boolean"
CHANGE_SCHEMA = "node_id string, failing boolean, ts_us long, seq_id long"


def _fold_node(ttl_ms):
    import numpy as np
    import pandas as pd

    def fold(key, pdfs, state):
        node = key[0]
        if state.hasTimedOut:
            ts_us, seq_id, _ = state.get
            state.remove()
            # Forgotten: no longer failing, recorded just after the last report.
            yield pd.DataFrame({"node_id": [node], "failing": [False], "ts_us": [ts_us + 1], "seq_id": [seq_id]})
            return
        start = state.get if state.exists else None
        best = start
        for pdf in pdfs:
            rel = pdf[((pdf["phase"] == "call") & (pdf["outcome"] == "passed")) | pdf["outcome"].isin(["skipped", "failed"])]
            if rel.empty:
                continue
            ts = rel["seq_ts"].to_numpy().astype("datetime64[us]").astype("int64")
            ids = rel["seq_id"].to_numpy().astype("int64")
            i = int(np.lexsort((ids, ts))[-1])
            cand = (int(ts[i]), int(ids[i]), bool(rel["outcome"].iloc[i] == "failed"))
            if best is None or cand[:2] > best[:2]:
                best = cand
        if best is not None and best != start:
            state.update(best)
            yield pd.DataFrame({"node_id": [node], "failing": [best[2]], "ts_us": [best[0]], "seq_id": [best[1]]})
        if ttl_ms:
            state.setTimeoutDuration(ttl_ms)

    return fold


def last_failed_stateful(reports_stream: DataFrame, changes_path: str, checkpoint_path: str,
                         ttl_ms: int | None = None, available_now: bool = True):
    """T1 as a table of changes: each micro-batch writes the nodes it has
    relevant reports of, with their newest state, to a folder of its epoch
    (a repeated batch replaces its folder).  The current state is the
    newest change per node (``current_from_changes``).  With ``ttl_ms`` (on
    a continuously running query) a node not reported for that long is
    forgotten (state removed, recorded as not failing), which bounds the
    state."""
    if ttl_ms and available_now:
        # Timeouts are driven by no-data batches, which keep an
        # available-now query from ever finishing: a TTL needs a running query.
        raise ValueError("ttl_ms needs a continuously running query (available_now=False)")
    if ttl_ms:
        changes = reports_stream.select("node_id", "seq_ts", "seq_id", "phase", "outcome").groupBy("node_id") \
            .applyInPandasWithState(_fold_node(ttl_ms), CHANGE_SCHEMA, STATE_SCHEMA, "append", "ProcessingTimeTimeout")
        return _start(changes.writeStream.format("parquet").option("path", changes_path).outputMode("append"), checkpoint_path, available_now)

    def on_batch(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes_path.rstrip('/')}/epoch={int(epoch_id)}")

    changes = newest_reports(reports_stream).withColumn("ts_us", F.unix_micros(F.col("seq_ts").cast("timestamp"))).select(
        "node_id", "failing", "ts_us", "seq_id")
    return _start(changes.writeStream.outputMode("update").foreachBatch(on_batch), checkpoint_path, available_now)


def current_from_changes(changes: DataFrame) -> DataFrame:
    """Newest change per node (combined map-side)."""
    return changes.groupBy("node_id").agg(
        F.max_by("failing", F.struct("ts_us", "seq_id")).alias("failing"))

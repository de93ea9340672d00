"""Streaming queries (T1-T3): the table's own files are the stream, as
many to a micro-batch as the file source's limits allow."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabletrust.plans.catalog import query
from tabletrust.plans.q_runstate import REPORTS_SQL, as_reports
from tabletrust.session import scratch_path
from tabletrust.streaming import runstate_stream as ST

#: A micro-batch takes about so much input.
BATCH_BYTES = 16 << 30


def report_stream(spark, sf_dir):
    """The reports of ``events`` as a stream over the table's files (a
    pattern, since a stream's plain path must be a folder)."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    schema = spark.read.parquet(path).schema
    return as_reports(spark.readStream.schema(schema).option("maxBytesPerTrigger", BATCH_BYTES).parquet(path[:-1] + "[t]"))


@query("last_failed_stream", ("T1", "T3"), REPORTS_SQL + "SELECT node_id FROM failing")
def last_failed_stream(spark, sf_dir):
    base = scratch_path(spark, "last-failed-stream")
    q = ST.last_failed_stream(spark, report_stream(spark, sf_dir), f"{base}/published", f"{base}/checkpoint")
    q.awaitTermination()
    return ST.published_set(spark, f"{base}/published")


@query("first_seen_stream", ("T2",), REPORTS_SQL + "SELECT DISTINCT node_id FROM reports")
def first_seen_stream(spark, sf_dir):
    base = scratch_path(spark, "first-seen-stream")
    q = ST.first_seen_stream(report_stream(spark, sf_dir), f"{base}/seen", f"{base}/checkpoint")
    q.awaitTermination()
    return spark.read.parquet(f"{base}/seen").select(F.col("node_id"))


@query("last_failed_stateful", ("T1",), REPORTS_SQL + "SELECT node_id FROM failing")
def last_failed_stateful(spark, sf_dir):
    """T1 as a table of changes."""
    base = scratch_path(spark, "last-failed-stateful")
    q = ST.last_failed_stateful(report_stream(spark, sf_dir), f"{base}/changes", f"{base}/checkpoint")
    q.awaitTermination()
    current = ST.current_from_changes(spark.read.parquet(f"{base}/changes"))
    return current.where("failing").select("node_id")

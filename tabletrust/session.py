"""Session construction and the shared checkpoint folder.

The library never invents a machine-local folder: lineage cuts and
intermediate tables go below the folder the cluster names in
``spark.checkpoint.dir``.  Only tests and the bench (which own their
session) may supply a fallback when the setting is absent.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins from runtime sizes
# (a shuffle side that turns out small becomes a broadcast), splits skewed
# join partitions and coalesces tiny shuffle partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Runtime broadcast only below a measured size (AQE reads real
    # shuffle statistics, so this is a checked bound, not a guess).
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Keyed streaming state (dedup sets, per-node fold state) lives in
    # RocksDB: it spills to local disk instead of the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app: str = "tabletrust",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Session for tests and the bench.  On a cluster, pass no master and
    let the submitter's configuration win."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Reads ``spark.checkpoint.dir`` (or a folder already set on the
    context) and registers it with the context, so ``DataFrame.checkpoint``
    writes there.  Raises if the cluster names none.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder for "
            "checkpoints and intermediate tables"
        )
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """For sessions we own (tests, bench, smoke runs): keep the configured
    folder if there is one, else use ``fallback``."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    target = conf or fallback
    if not conf:
        os.makedirs(target, exist_ok=True)
        spark.conf.set("spark.checkpoint.dir", target)
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tabletrust/{name}-{uuid.uuid4().hex}"

"""Skew check: run the key-group operators on synthetic reports where one
node holds a third of all rows, and print one JSON line of timings plus
exactness checks.  Manual tool (not collected by pytest).

    python tools/skew_check.py [rows] [cpus]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tabletrust.operators import checks as C  # noqa: E402
from tabletrust.operators import retention as RT  # noqa: E402
from tabletrust.operators import runstate as R  # noqa: E402
from tabletrust.operators.numbering import number_rows  # noqa: E402
from tabletrust.session import build_session, ensure_checkpoint_dir, scratch_path  # noqa: E402


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 12_000_000
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    spark = build_session(app="tabletrust-skew", master=f"local[{cpus}]", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": "16g"})
    ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="tt-skew-ckpt-", dir="/tmp"))
    i = F.col("id")
    reports = spark.range(n).select(
        i.alias("seq_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), (i / 100).cast("int"))).alias("seq_ts"),
        F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("n"), (i % 100000).cast("string"))).alias("node_id"),
        F.when(i % 2 == 0, F.lit("call")).otherwise(F.lit("setup")).alias("phase"),
        F.when(i % 7 == 0, F.lit("failed")).when(i % 11 == 0, F.lit("skipped")).otherwise(F.lit("passed"))
        .alias("outcome"),
    )
    path = scratch_path(spark, "skew-reports")
    reports.write.parquet(path)
    rep = spark.read.parquet(path)
    out: dict[str, object] = {"rows": n, "hot_share": round(1 / 3, 3)}

    def timed(name, df):
        t0 = time.time()
        df.write.format("noop").mode("overwrite").save()
        out[name] = round(time.time() - t0, 2)

    timed("last_failed_struct_seq", R.last_failed(rep))
    timed("last_failed_long_seq", R.last_failed(rep, seq=("seq_id",)))
    timed("keep_newest_3", RT.keep_newest(rep, ["node_id"], ["seq_ts", "seq_id"], n=3))
    timed("latest_per_key", RT.latest_per_key(rep.select("node_id", "seq_id", "outcome"), ["node_id"], ["seq_id"]))
    timed("primary_key_check", C.check_primary_key(rep, ["node_id", "phase"]))
    parents = spark.range(0, 50000).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("node_id"))
    timed("foreign_key_check", C.check_foreign_key(rep, ["node_id"], parents, ["node_id"]))
    t0 = time.time()
    hot_max = number_rows(rep.select("node_id", "seq_id"), ["seq_id"], ["node_id"]).where("node_id = 'hot'") \
        .agg(F.max("rn").alias("m"), F.count(F.lit(1)).alias("c")).first()
    out["number_rows"] = round(time.time() - t0, 2)
    out["number_rows_exact"] = hot_max["m"] == hot_max["c"] == (n + 2) // 3
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

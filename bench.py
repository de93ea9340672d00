"""Bench: run every registered query on one scale and time it.

Env: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_QUERIES`` (comma list, default all), ``BENCH_WARM``
(``1`` adds a second, warm pass reported under ``warm``),
``BENCH_SHUFFLE_PARTITIONS`` (default twice the CPUs, at least 8).  Each query is
executed in full with the ``noop`` sink (no collect to the driver).
Prints one JSON line: total seconds plus per-query seconds.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tabletrust.plans import REGISTRY
    from tabletrust.session import build_session, ensure_checkpoint_dir

    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, cpus * 2)))
    spark = build_session(app="tabletrust-bench", master=f"local[{cpus}]", shuffle_partitions=partitions,
                          extra={"spark.driver.memory": "16g"})
    ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="tt-bench-ckpt-", dir="/tmp"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or sorted(REGISTRY)
    # Untimed JVM warm-up (class loading, codegen caches), so the first
    # timed query is not charged for starting the engine.
    spark.read.parquet(f"{sf_dir.rstrip('/')}/region.parquet").groupBy("r_regionkey").count().collect()
    def run_pass() -> tuple[dict[str, float], dict[str, str]]:
        times: dict[str, float] = {}
        failed: dict[str, str] = {}
        for name in names:
            t0 = time.time()
            try:
                REGISTRY[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
                times[name] = round(time.time() - t0, 3)
            except Exception as e:  # keep going; report the failure
                failed[name] = repr(e)[:200]
        return times, failed

    times, failed = run_pass()
    warm = run_pass()[0] if os.environ.get("BENCH_WARM", "0") == "1" else None
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf, "cpus": cpus}
    if warm is not None:
        out["warm"] = warm
        out["value_warm"] = round(sum(warm.values()), 3)
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

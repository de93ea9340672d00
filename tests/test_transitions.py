"""Previous values by slices against a serial walk."""

import random

import pytest
from pyspark.sql import functions as F

from tabletrust.operators.transitions import previous_value, transitions


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_previous_value_matches_a_walk(spark, partitions):
    rng = random.Random(partitions)
    rows = [(rng.choice([None, "a", "a", "a", "b", f"g{rng.randrange(40)}"]), i, rng.choice([None, "x", "y"]), "kept") for i in range(900)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, i int, v string, `prev.x` string").repartition(5)
    got = {r.i: r.prev for r in previous_value(df, "v", ["i"], ["g"], partitions=partitions).collect()}
    last, want = {}, {}
    for g, i, v, _ in sorted(rows, key=lambda r: r[1]):
        want[i] = last.get(g)
        last[g] = v
    assert got == want
    down = {r.i: r.prev for r in previous_value(df, F.upper("v"), [F.col("i").desc()], ["g"], partitions=partitions).collect()}
    last = {}
    for g, i, v, _ in sorted(rows, key=lambda r: -r[1]):
        assert down[i] == (last.get(g) and last[g].upper())
        last[g] = v


def test_a_hot_group_spreads_over_tasks(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id")).alias("g"), "id", (F.col("id") % 10 < 5).alias("up"))
    out = transitions(df, "up", ["id"], ["g"])
    hot = [r.id for r in out.where("g = 0").orderBy("id").collect()]
    want, last = [], None
    for i in range(40_000):
        if i % 3 or i == 0:
            if last is None or (i % 10 < 5) != last:
                want.append(i)
            last = i % 10 < 5
    assert hot == want
    # Small partitions are not put together for this.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = [r["count"] for r in previous_value(df, "up", ["id"], ["g"]).where("g = 0").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(parts) > 3 and max(parts) < 0.5 * sum(parts)
    assert transitions(df.limit(0), "up", ["id"], ["g"]).collect() == []

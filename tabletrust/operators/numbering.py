"""Skew-proof row numbering (W5, W6, explicit order positions for O1-O3).

``row_number().over(Window.partitionBy(g).orderBy(o))`` sends a whole
group to one task; a group holding a third of the rows would then be
sorted by a single task.  Here the rows are range-partitioned on
``(group, order)`` instead, so a large group spreads over many
partitions; each partition numbers its own slice, and the slice offsets
come from per-(group, partition) counts -- a small table -- summed in
partition order.  The range-partitioned layout is checkpointed to the
shared checkpoint folder so the counting pass and the numbering pass see
exactly the same partitions (and a lost executor cannot re-sample them).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabletrust.session import checkpoint_dir


def number_rows(df: DataFrame, order_cols, group_cols=(), name: str = "rn", start: int = 1,
                partitions: int | None = None, after: DataFrame | None = None, after_col: str = "after") -> DataFrame:
    """Add ``name`` = 1-based (or ``start``-based) position of each row in
    ``order_cols`` order within ``group_cols``.  ``order_cols`` should make
    the order total (add a unique tie-breaker), else ties number arbitrarily.
    ``after`` (one row per group) gives the number that a group's first row
    follows (``after_col``); it joins the small table of slice offsets, not
    the rows.
    """
    group_cols = list(group_cols)
    order_cols = [c if isinstance(c, Column) else F.col(c) for c in order_cols]
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(n, *[F.col(c) for c in group_cols], *order_cols)
        .withColumn("__pid", F.spark_partition_id())
        .checkpoint(eager=True)
    )
    counts = ranged.groupBy(*group_cols, "__pid").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group_cols).orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*group_cols, "__pid", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    if after is not None:
        known = after.select(*[F.col(c).alias(f"__a_{c}") for c in group_cols], F.col(after_col).alias("__after"))
        met = reduce(lambda x, y: x & y, [offsets[c].eqNullSafe(known[f"__a_{c}"]) for c in group_cols])
        offsets = offsets.join(known, met, "left").select(
            *group_cols, "__pid", (F.col("__off") + F.coalesce(F.col("__after") + F.lit(1 - start), F.lit(0))).alias("__off"))
    local = Window.partitionBy(*group_cols, "__pid").orderBy(*order_cols)
    numbered = ranged.withColumn("__lrn", F.row_number().over(local))
    # Null-safe on the group columns: a NULL group is a group too.
    o = offsets.select(*[F.col(c).alias(f"__o_{c}") for c in group_cols], F.col("__pid").alias("__o_pid"), "__off")
    cond = numbered["__pid"] == o["__o_pid"]
    for c in group_cols:
        cond = cond & numbered[c].eqNullSafe(o[f"__o_{c}"])
    out = numbered.join(o, cond, "inner").drop(*[f"__o_{c}" for c in group_cols], "__o_pid")
    return out.withColumn(name, (F.col("__off") + F.col("__lrn") + F.lit(start - 1)).cast("bigint")).drop(
        "__pid", "__off", "__lrn"
    )

"""Previous values and state transitions inside groups of any size.

``lag`` over ``partitionBy(group)`` sends a whole group to one task.  Here
the rows are range-partitioned on ``(group, order)``, so a big group spreads
over many partitions.  Each slice of a group looks back inside itself, and
only its first row needs what the slice before ended with: one value per
slice, a table of at most groups times partitions rows, chained by a window
over the slices of a group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabletrust.session import checkpoint_dir


def previous_value(df: DataFrame, value, order_cols, group_cols, name: str = "prev", partitions: int | None = None) -> DataFrame:
    """Add ``name``: the ``value`` (a column or its name) of the row before
    in ``order_cols`` order within ``group_cols``; NULL for a group's first
    row.  The order should be total: ties come in any order.  NULL is a
    group, and a NULL value is handed on like any other.  No rows give no
    rows."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    group_cols = list(group_cols)
    order = [c if isinstance(c, Column) else F.col(c) for c in order_cols]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Checkpointed, so that both passes see the same slices.
    ranged = (
        df.withColumn("__v", F.struct((F.col(value) if isinstance(value, str) else value).alias("v")))
        .repartitionByRange(n, *[F.col(c) for c in group_cols], *order)
        .withColumn("__pid", F.spark_partition_id()).checkpoint(eager=True)
    )
    local = Window.partitionBy(*group_cols, "__pid").orderBy(*order)
    ranged = ranged.withColumn("__p", F.lag("__v").over(local))
    # A slice ends with the row that no other one looks back at.
    ends = ranged.withColumn("__next", F.lead(F.lit(1)).over(local)).where(F.col("__next").isNull()).select(*group_cols, "__pid", "__v")
    chained = ends.withColumn("__carry", F.lag("__v").over(Window.partitionBy(*group_cols).orderBy("__pid"))).where(F.col("__carry").isNotNull())
    other = chained.select(*[F.col(c).alias(f"__o_{c}") for c in group_cols], F.col("__pid").alias("__o_pid"), "__carry")
    met = reduce(lambda x, y: x & y, [ranged[c].eqNullSafe(other[f"__o_{c}"]) for c in group_cols], ranged["__pid"] == other["__o_pid"])
    out = ranged.join(other, met & ranged["__p"].isNull(), "left")
    return out.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("__p", "__carry")["v"].alias(name))


def transitions(df: DataFrame, state, order_cols, group_cols) -> DataFrame:
    """The rows at which the state of a group changes, with the state before
    as ``was`` (NULL for a group's first row, which is a change) and the
    row's own as ``now``."""
    both = previous_value(df.withColumn("now", F.col(state) if isinstance(state, str) else state), "now", order_cols, group_cols, "was")
    first = F.col("was").isNull()
    return both.where(first | ~F.col("was").eqNullSafe(F.col("now")))

"""Connected components of an edge table, as joins and aggregates.

Every node takes the smallest root among its neighbours' roots, then its
root's root, until nothing changes: paths shorten by pointer jumping, so
the rounds grow with the logarithm of the longest chain.  Minima are
combined before each shuffle and joins can be split by AQE, so a node with
a third of all edges needs no task of its own.  Lineage is cut each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabletrust.llm.common import cut_lineage


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(``id``, ``root``) for every node of an edge; ``root`` is the
    smallest node of its component.  Self loops, repeated and reversed
    edges are harmless; edges with a NULL end are ignored; no edges give no
    rows."""
    one = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("id"), F.col(b).alias("to"))
    both = cut_lineage(one.union(one.select(F.col("to").alias("id"), F.col("id").alias("to"))).distinct())
    roots = cut_lineage(both.groupBy("id").agg(F.min("to").alias("to")).select("id", F.least("id", "to").alias("root")))
    while True:
        near = both.join(roots.select(F.col("id").alias("to"), "root"), "to").groupBy("id").agg(F.min("root").alias("near"))
        hooked = roots.join(near, "id").select("id", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jumped = cut_lineage(
            hooked.join(roots.select(F.col("id").alias("root"), F.col("root").alias("up")), "root")
            .select("id", "old", F.least("root", "up").alias("root")))
        roots = jumped.select("id", "root")
        if jumped.where(F.col("old") != F.col("root")).isEmpty():
            return roots

"""Sharding by a hierarchical weighted hash tree.

A cluster is a tree: regions hold racks, racks hold weighted shards, and a
node weighs what its shards weigh.  A key descends from the root; at each
level every child draws ``-ln(u) / weight`` with ``u`` a hash of (seed,
child, key), and the smallest draw wins, so a child gets keys in
proportion to its weight.  The draw of a child whose weight stays does not
change: raising one weight pulls keys only into that child, and every
movement stays inside the subtrees whose weights change.  A shard added as
a region of its own (``grow``) therefore takes keys only into itself, and
:func:`uniform_tree` adds all shards beyond its first ones so.

Everything is a DataFrame expression: no join and no shuffle for the
assignment; only the gapless slots need exchanges of narrow rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabletrust.llm.common import cut_lineage, hash60

#: region name -> rack name -> shard number -> weight
Tree = dict[str, dict[str, dict[int, float]]]

#: Slots are numbered in this many hash slices per shard, so that no shard
#: is numbered by one task.  Fixed: slots depend on the rows alone.
SLICES = 1024
#: Rows that are equal in all that counts are numbered in this many parts.
PARTS = 64


def uniform_tree(shards: int, per_rack: int = 4, racks_per_region: int = 2, first: int = 24) -> Tree:
    """The tree of ``shards`` shards of weight 1: the ``first`` ones, with
    which the cluster starts, are filled rack by rack, and each later one is
    a region of its own.  The number of shards alone decides the tree, and
    from ``first`` on one more shard takes keys only into itself."""
    tree: Tree = {}
    for s in range(min(shards, first)):
        rack = s // per_rack
        tree.setdefault(f"region{rack // racks_per_region}", {}).setdefault(f"rack{rack}", {})[s] = 1.0
    for _ in range(first, shards):
        tree = grow(tree)
    return tree


def grow(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard, in a region of its own."""
    new = 1 + max((s for racks in tree.values() for rack in racks.values() for s in rack), default=-1)
    return {**tree, f"own{new}": {f"own{new}": {new: weight}}}


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else float(node)


def _children(tree: Tree) -> Column:
    """The tree as data: path of a node -> its children with a positive
    weight.  It is as large as the cluster's layout, not as its data."""
    levels: dict[str, list[tuple[str, float]]] = {}

    def walk(node, path: str) -> None:
        live = [(str(name), child) for name, child in node.items() if _weight(child) > 0]
        if not live:
            raise ValueError(f"no shard with a positive weight below {path or 'the root'}")
        levels[path] = [(name, _weight(child)) for name, child in live]
        for name, child in live:
            if isinstance(child, dict):
                walk(child, f"{path}/{name}")

    walk(tree, "")
    pairs = []
    for path, live in levels.items():
        pairs += [F.lit(path), F.array(*[F.struct(F.lit(n).alias("name"), F.lit(w).alias("weight")) for n, w in live])]
    return F.create_map(*pairs)


def place(rows: DataFrame, key: str, tree: Tree, out: str, seed: str = "tree") -> DataFrame:
    """Adds ``out``, the shard of the column ``key``: region, rack and
    shard are drawn one after the other.  A NULL key is a key like any
    other.  A tree without weight is an error."""
    rows = rows.withColumn(out, F.lit(""))
    for _ in ("region", "rack", "shard"):
        def draw(child: Column) -> Column:
            u = (hash60(seed, F.col(out), child["name"], F.col(key)) + F.lit(0.5)) / F.lit(float(1 << 60))
            return F.struct((-F.log(u) / child["weight"]).alias("draw"), child["name"].alias("name"))

        won = F.array_min(F.transform(F.element_at(_children(tree), F.col(out)), draw))["name"]
        rows = rows.withColumn(out, F.concat(F.col(out), F.lit("/"), won))
    return rows.withColumn(out, F.substring_index(F.col(out), "/", -1).cast("int"))


def assign_shards(docs: DataFrame, tree: Tree, key: str = "doc_id", text: str = "text", seed: str = "tree") -> DataFrame:
    """One row per row of ``docs``: ``key``, ``size`` (UTF-8 bytes of the
    text plus 8), ``text_crc32`` (of the UTF-8 bytes), ``shard``, ``slot``
    (0, 1, ... without gaps in each shard) and ``grown_shard`` (the shard
    in the tree with one more).

    NULL text counts as empty.  A NULL key is placed like any other; rows
    with equal keys share a shard, and repeated rows get slots of their
    own (which of them gets which does not show).  An empty table gives no
    rows; other columns are ignored.
    """
    bytes_ = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    rows = docs.select(F.col(key).alias("_key"), (F.length(bytes_).cast("bigint") + 8).alias("_size"), F.crc32(bytes_).alias("_crc"))
    rows = place(place(rows, "_key", tree, "_shard", seed), "_key", grow(tree), "_grown", seed)
    # A hot key spreads over slices by its texts, a hot row over its parts.
    # The parts are as the rows lie, so they are drawn once.
    placed = cut_lineage(
        rows.withColumn("_hash", hash60(seed, "slot", F.col("_key"), F.col("_size"), F.col("_crc")))
        .withColumn("_slice", (F.col("_hash") % SLICES).cast("int"))
        .withColumn("_part", F.monotonically_increasing_id() % PARTS))
    run = ["_shard", "_slice", "_hash", "_part"]
    counts = placed.groupBy(*run).agg(F.count(F.lit(1)).alias("_n"))

    def before(by: list[str], order: list[str]) -> Column:
        window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(window), F.lit(0))

    # At most shards x SLICES rows.
    slices = counts.groupBy("_shard", "_slice").agg(F.sum("_n").alias("_n"))
    slices = slices.select("_shard", "_slice", before(["_shard"], ["_slice"]).alias("_first"))
    starts = counts.select(*run, before(["_shard", "_slice"], ["_hash", "_part"]).alias("_before")).join(slices, ["_shard", "_slice"])
    inside = Window.partitionBy(*run).orderBy("_key", "_crc", "_size")
    return (
        placed.withColumn("_at", F.row_number().over(inside))
        .join(starts, run)
        .select(
            F.col("_key").alias(key), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
            F.col("_shard").alias("shard"), (F.col("_first") + F.col("_before") + F.col("_at") - 1).cast("bigint").alias("slot"),
            F.col("_grown").alias("grown_shard"),
        )
    )

"""Mixing sources to target weights by Sainte-Lague apportionment.

Every source's documents are laid out in seeded order on hash shards, and
the token stream of each (source, shard) cell is cut into blocks of nearly
equal token counts.  Blocks are seats: the whole mix is apportioned to the
sources by highest quotients ``votes / (seat + 1/2)``, and every source's
seats to its shards in the same way, so each cell gets an integer quota.  A
quota of full passes takes the whole cell again and again; the rest of the
quota is a run of blocks from a seeded start (the documents already stand
in seeded order), so at most a few documents of a cell are cut.

Only DataFrame functions are used.  Cells, not documents, take part in the
apportionment: at most sources x shards rows.  A source with a third of
all documents is spread over all shards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabletrust.llm.common import WORD, cut_lineage, group_key, hash60, packed, unpacked


def source_targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: float = 3.0, share: float = 1.0) -> DataFrame:
    """Targets of the sources: (``source``, ``source_size``) plus ``target``.

    Sources in code point order, NULL last, weigh ``weights``, repeating.
    They share ``share`` of all tokens by weight; a target stops at ``cap``
    times its source's size and the excess goes to the others by weight
    until no target is above.  ``sizes`` has one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.withColumn("_rank", F.row_number().over(by_name)).withColumn(
        "_w", F.element_at(cycle, ((F.col("_rank") - 1) % len(weights) + 1).cast("int")))
    # In the order in which growing targets reach their caps, the first
    # source that stays below its cap fixes the level of all that follow.
    filling = Window.orderBy("_full_at", "_rank")
    earlier = filling.rowsBetween(Window.unboundedPreceding, -1)
    leveled = (
        ranked.withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
        .withColumn("_full_at", F.col("_cap") / F.col("_w"))
        .withColumn("_total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("_left", F.col("_total") - F.coalesce(F.sum("_cap").over(earlier), F.lit(0.0)))
        .withColumn("_w_left", F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(earlier), F.lit(0.0)))
        .withColumn("_level", F.col("_left") / F.col("_w_left"))
        .withColumn("_below", F.col("_level") * F.col("_w") < F.col("_cap"))
        .withColumn("_first", F.min(F.when(F.col("_below"), F.struct("_full_at", "_rank", "_level"))).over(everything)["_level"])
    )
    open_ = F.col("_first").isNotNull() & (F.col("_full_at") > F.col("_first"))
    return leveled.select("source", "source_size", F.when(open_, F.col("_first") * F.col("_w")).otherwise(F.col("_cap")).alias("target"))


def sainte_lague(rows: DataFrame, group: Sequence[str], key: Sequence[str], votes: str, seats: str, most: str) -> DataFrame:
    """Apportion the ``seats`` of each group to its rows by highest
    quotients, no row above ``most``; adds ``quota``.

    The rounded share of a row differs from its seats by little, so only
    the quotients near it are ranked: their number grows with the rows, not
    with the seats.  Equal quotients go to the smaller ``key``.  ``key``
    (with the group) names a row; a row without votes gets nothing.
    """
    all_ = Window.partitionBy(*group)
    v, s = F.col(votes).cast("double"), F.col(seats)
    near = (
        rows.withColumn("_v_all", F.sum(v).over(all_))
        .withColumn("_rows", F.count(F.lit(1)).over(all_))
        .withColumn("_share", F.when(F.col("_v_all") > 0, v * s / F.col("_v_all")).otherwise(F.lit(0.0)))
        .withColumn("_reach", F.when(F.col("_v_all") > 0, F.ceil(v * 3 * F.col("_rows") / F.col("_v_all")) + 3).otherwise(F.lit(0)))
        .withColumn("_base", F.greatest(F.lit(0), F.least(F.col(most), F.floor(F.col("_share") + 0.5) - F.col("_reach"))).cast("bigint"))
        .withColumn("_top", F.least(F.col(most), F.floor(F.col("_share") + 0.5) + F.col("_reach")).cast("bigint"))
        .withColumn("_free", s - F.sum("_base").over(all_))
    )
    seat = near.withColumn("_seat", F.explode_outer(
        F.when((v > 0) & (F.col("_top") > F.col("_base")), F.sequence(F.col("_base"), F.col("_top") - 1))))
    cost = Window.partitionBy(*group).orderBy(F.asc_nulls_last("_cost"), *key)
    won = seat.withColumn("_cost", (F.col("_seat") + 0.5) / v).withColumn(
        "_won", F.col("_seat").isNotNull() & (F.row_number().over(cost) <= F.col("_free")))
    return won.groupBy(*rows.columns).agg(
        (F.first("_base") + F.sum(F.col("_won").cast("bigint"))).cast("bigint").alias("quota"))


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), cap: int = 3, share: float = 1.0, block_tokens: int = 16,
        shards: int = 64, seed: str = "mix", doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix, one row per row of ``docs``: ``doc_id``, ``source``,
    ``size`` (words), ``source_size``, ``target`` (its source's), ``passes``
    (times the whole document is taken), ``parts`` (word ranges [start,
    end) taken once more, at most two) and ``taken`` (words, repeats
    counted).

    NULL text has no words; documents without words are never taken but
    keep their row.  NULL is a source of its own, last in order.  Repeated
    rows are separate documents.  An empty table gives no rows; other
    columns are ignored.  ``cap`` must be an integer: a document is taken at
    most ``cap`` times.
    """
    sized = cut_lineage(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), group_key(F.col(source)).alias("_s"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        (hash60(seed, "shard", F.col(doc_id)) % shards).cast("int").alias("_shard"),
        hash60(seed, "order", F.col(doc_id)).alias("_order"),
    ))
    cells = sized.groupBy("source", "_s", "_shard").agg(F.sum("size").alias("_tokens")).withColumn(
        "_blocks", F.when(F.col("_tokens") > 0, F.greatest(F.lit(1), F.round(F.col("_tokens") / block_tokens))).otherwise(F.lit(0)).cast("bigint"))
    by_source = cells.groupBy("source", "_s").agg(F.sum("_tokens").alias("source_size"), F.sum("_blocks").alias("_blocks"))
    targets = source_targets(by_source.select("source", "source_size"), weights, cap, share)
    # Votes of a source: the blocks of its own mean size that its target needs.
    voted = (
        by_source.drop("source_size").join(targets.withColumn("_s", group_key(F.col("source"))).drop("source"), "_s")
        .withColumn("_votes", F.when(F.col("source_size") > 0, F.col("target") * F.col("_blocks") / F.col("source_size")).otherwise(F.lit(0.0)))
        .withColumn("_one", F.lit(1))
        .withColumn("_seats", F.round(F.sum("_votes").over(Window.partitionBy("_one"))).cast("bigint"))
        .withColumn("_most", F.col("_blocks") * cap)
    )
    source_quota = sainte_lague(voted, ["_one"], ["_s"], "_votes", "_seats", "_most").select(
        "_s", "source_size", "target", F.col("quota").alias("_source_quota"))
    cell_rows = cells.join(source_quota, "_s").withColumn("_most", F.col("_blocks") * cap)
    quotas = sainte_lague(cell_rows, ["_s"], ["_shard"], "_blocks", "_source_quota", "_most").select(
        "_s", "_shard", "source_size", "target", "_tokens", "_blocks", "quota",
        F.when(F.col("_blocks") > 0, hash60(seed, "start", F.col("_s"), F.col("_shard")) % F.col("_blocks")).otherwise(F.lit(0)).alias("_first"))
    laid = Window.partitionBy("_s", "_shard").orderBy("_order", "doc_id", "size")
    at = (
        sized.withColumn("_end", F.sum("size").over(laid.rowsBetween(Window.unboundedPreceding, 0)))
        .join(quotas, ["_s", "_shard"])
        .withColumn("_start", F.col("_end") - F.col("size"))
        .withColumn("passes", F.when(F.col("_blocks") > 0, F.expr("quota div _blocks")).otherwise(F.lit(0)).cast("bigint"))
        .withColumn("_rest", F.when(F.col("_blocks") > 0, F.expr("quota % _blocks")).otherwise(F.lit(0)).cast("bigint"))
        # Block k starts at token k * (tokens div blocks) + least(k, tokens % blocks).
        .withColumn("_b", F.greatest(F.col("_blocks"), F.lit(1)))
        .withColumn("_last", F.col("_first") + F.col("_rest"))
    )

    def start_of(block: str) -> str:
        return f"({block} * (_tokens div _b) + least({block}, _tokens % _b))"

    # The run of blocks [first, last) may wrap around the end of the cell.
    run = at.withColumn("_from", F.expr(start_of("_first"))).withColumn(
        "_to", F.expr(start_of("least(_last, _blocks)"))).withColumn("_wrap", F.expr(start_of("greatest(_last - _blocks, 0L)")))
    part = "named_struct('start', greatest({lo}, _start) - _start, 'end', least({hi}, _end) - _start)"
    parts = F.expr(
        f"filter(array({part.format(lo='0L', hi='_wrap')}, {part.format(lo='_from', hi='_to')}), p -> p.end > p.start)")
    return run.withColumn("parts", parts).withColumn(
        "taken", (F.col("size") * F.col("passes") + F.expr("aggregate(parts, 0L, (n, p) -> n + p.end - p.start)")).cast("bigint")
    ).select("doc_id", "source", "size", "source_size", "target", "passes", "parts", "taken")


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """The documents of the mix themselves, with the columns of ``docs``:
    a row for each whole pass and one for each word range taken besides,
    whose text is cut at words.  Rows that the mix leaves out are dropped.

    ``doc_id`` names a row; rows that repeat one are taken as one document
    each with the same plan.  ``n_chars``, where there is one, follows the
    text.
    """
    plan = mix(docs, **params).select(
        group_key(F.col("doc_id")).alias("_id"), "size", "passes", "parts").dropDuplicates(["_id", "size"])
    words = F.regexp_extract_all(F.col("_text"), F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    whole = F.array_repeat(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("_plan.size").alias("end")), F.col("_plan.passes").cast("int"))
    taken = (
        docs.select(packed(docs), group_key(F.col("doc_id")).alias("_id"), F.col("text").alias("_text"),
                    F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("bigint").alias("_size"))
        .join(plan.select(F.col("_id").alias("_plan_id"), F.col("size").alias("_plan_size"), F.struct("size", "passes", "parts").alias("_plan")),
              (F.col("_id") == F.col("_plan_id")) & (F.col("_size") == F.col("_plan_size")))
        .withColumn("_part", F.explode(F.concat(whole, F.col("_plan.parts"))))
    )
    cut = F.rtrim(F.array_join(F.slice(words, (F.col("_part.start") + 1).cast("int"), (F.col("_part.end") - F.col("_part.start")).cast("int")), ""))
    is_whole = (F.col("_part.start") == 0) & (F.col("_part.end") == F.col("_plan.size"))
    return unpacked(taken.withColumn("_text", F.when(is_whole, F.col("_text")).otherwise(cut)), docs, "_text")

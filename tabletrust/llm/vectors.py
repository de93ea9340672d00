"""What the vector searches share: usable vectors, their copies, and the
ranking of what the tasks found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Neither NULL nor empty, and without NULL or non-finite components."""
    def finite(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))

    return F.coalesce(F.forall(vector, finite), F.lit(False)) & (F.size(vector) > 0)


def of_one_length(rows: DataFrame) -> DataFrame:
    """The rows whose vector ``v`` has the most frequent length (ties: the
    longer one)."""
    lengths = rows.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    return rows.where(F.size("v") == (lengths[0]["dims"] if lengths else 0))


def distinct_vectors(rows: DataFrame, most: int) -> DataFrame:
    """(``v``, ``ids``): the distinct vectors of ``rows`` (``id``, ``v``)
    with their ``most`` smallest ids, ascending.

    Ties go to the smaller id, so no other members of a group of equal
    vectors can be among a query's ``most - 1`` answers: nothing is lost.
    Groups are salted, and ranks end before each shuffle, so no group meets
    in one task."""
    salted = rows.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(64)).alias("salt"))
    ranked = salted.withColumn("r", F.row_number().over(Window.partitionBy("v", "salt").orderBy("id"))).where(F.col("r") <= most)
    return ranked.groupBy("v").agg(F.slice(F.array_sort(F.collect_list("id")), 1, most).alias("ids"))


def ranked_answers(found: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): for each query
    (``id``, ``v``) its ``k`` best of ``found`` (``v`` of the query, the
    ``ids`` of equal candidates, ``score``), without itself; ties to the
    smaller id."""
    best = found.groupBy("v", "ids").agg(F.max("score").alias("score"))
    answers = best.select("v", "score", F.explode("ids").alias("vec_id"))
    both = queries.select(F.col("id").alias("query_id"), "v").join(answers, "v").where(F.col("vec_id") != F.col("query_id"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

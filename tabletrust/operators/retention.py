"""Latest/first per key, keep-newest retention, numbering, generated keys
(W1-W6, O5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabletrust.operators.numbering import number_rows

POLICIES = ("all", "failed", "none")


def _order_struct(order) -> Column:
    order = [order] if isinstance(order, (str, Column)) else list(order)
    return F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])


# ------------------------------------------------------------------ W1
def latest_per_key(df: DataFrame, keys, order) -> DataFrame:
    """Last write wins: the row with the greatest ``order`` per key.
    ``max_by`` is combined map-side, so a hot key costs one row per task."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), _order_struct(order)).alias("__r")).select(
        *keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


# ------------------------------------------------------------------ W2
def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """The existing (earliest) row per key is kept."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), _order_struct(order)).alias("__r")).select(
        *keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


# ------------------------------------------------------------------ W3, W4, O5
def keep_newest(df: DataFrame, group, order, n: int = 3, policy: str = "all",
                passed: Column | None = None) -> DataFrame:
    """Retention: the ``n`` newest rows per group (``order`` descending).

    ``policy='failed'`` first drops rows whose call phase passed or that
    have no call result (``passed`` NULL counts as passed); ``'none'``
    keeps nothing.  ``row_number() <= n`` lets Spark insert a partial
    per-partition group limit before the shuffle, so a hot group sends at
    most ``n`` rows per map task.
    """
    if not isinstance(n, int) or n < 0:
        raise ValueError(f"cannot keep {n!r} entries: give a whole number, 0 or more")
    if policy not in POLICIES:
        raise ValueError(f"unknown retention policy {policy!r}: choose one of {', '.join(POLICIES)}")
    group = [group] if isinstance(group, str) else list(group)
    order = [order] if isinstance(order, (str, Column)) else list(order)
    if policy == "none":
        n = 0
    if policy == "failed":
        if passed is None:
            raise ValueError("policy 'failed' needs the passed column")
        df = df.where(~F.coalesce(passed, F.lit(True)))
    desc = [(F.col(c) if isinstance(c, str) else c).desc() for c in order]
    w = Window.partitionBy(*group).orderBy(*desc)
    ranked = df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


# ------------------------------------------------------------------ W4
def drop_passed(df: DataFrame, phases: str = "phases") -> DataFrame:
    """Policy ``failed`` per item: remove items whose call phase passed or
    that have no call result (a missing call entry counts as passed)."""
    from tabletrust.functions.scalar import map_get

    passed = map_get(F.col(phases), "call", True)
    return df.where(~F.coalesce(passed, F.lit(True)))


# ------------------------------------------------------------------ W5
def next_numbers(existing: DataFrame, new: DataFrame, prefix: str, number: str, order, name="number") -> DataFrame:
    """Number new entries per prefix after the greatest existing number
    (no gap filling).  Existing numbers are one aggregate; the new rows
    are numbered by the skew-proof ``number_rows``."""
    top = existing.groupBy(prefix).agg(F.max(number).alias("after"))
    return number_rows(new, order, group_cols=[prefix], name=name, start=0, after=top)


# ------------------------------------------------------------------ W6
def assign_keys(df: DataFrame, key: str, order, start: int = 1) -> DataFrame:
    """Fill NULL keys from the next value up (``max(key) + 1`` or
    ``start``, whichever is larger); a literal 0 stays as it is.  Only the
    rows to fill are numbered."""
    top = df.agg(F.max(key).alias("m")).first()["m"]
    base = max(int(top) + 1 if top is not None else start, start)
    missing = df.where(F.col(key).isNull())
    present = df.where(F.col(key).isNotNull())
    filled = number_rows(missing, order, name="__rn").withColumn(
        key, (F.lit(base - 1) + F.col("__rn")).cast(df.schema[key].dataType)).drop("__rn")
    return present.unionByName(filled.select(*df.columns))


# ------------------------------------------------------------------ W4 (run level)
def runs_to_remove(runs: DataFrame, policy: str, exit_status: str = "exit_status",
                   given_base: str = "given_base") -> DataFrame:
    """Whole runs whose folder goes: only under policy ``failed``, only
    when the run exited 0 and its base folder was not given by the user."""
    if policy not in POLICIES:
        raise ValueError(f"unknown retention policy {policy!r}: choose one of {', '.join(POLICIES)}")
    if policy != "failed":
        return runs.where(F.lit(False))
    return runs.where((F.col(exit_status) == 0) & ~F.coalesce(F.col(given_base), F.lit(False)))

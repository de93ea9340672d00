"""Keyed state: upsert, get with default, list, delete, clear.

State is a table ``(key..., value..., order...)``.  Upserts are a union
followed by ``max_by`` per key -- a partially aggregated plan, so a key
that receives a third of all writes is reduced map-side -- never a
whole-table rewrite on the driver.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Which side a row of an upsert comes from; no column of a table has it.
_SIDE = "__tabletrust_side"


def _pick(df: DataFrame, keys, order: Column, agg=F.max_by) -> DataFrame:
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c != _SIDE]
    picked = df.groupBy(*keys).agg(agg(F.struct(*[F.col(f"`{c}`") for c in rest]), order).alias(_SIDE))
    return picked.select(*keys, *[F.col(f"{_SIDE}.`{c}`").alias(c) for c in rest])


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str) -> DataFrame:
    """Join on ``keys`` with NULL equal to NULL; one set of key columns."""
    keys = list(keys)
    r = right.select(F.lit(True).alias("__in_right"), *[F.col(f"`{c}`").alias(f"__key_{c}" if c in keys else c) for c in right.columns])
    cond = reduce(lambda x, y: x & y, [left[k].eqNullSafe(r[f"__key_{k}"]) for k in keys])
    j = left.withColumn("__in_left", F.lit(True)).join(r, cond, how)
    if how in ("left_semi", "left_anti"):
        return j.drop("__in_left")
    out = [F.when(F.col("__in_left").isNotNull(), F.col(k)).otherwise(F.col(f"__key_{k}")).alias(k) for k in keys]
    rest = [c for c in left.columns if c not in keys] + [c for c in right.columns if c not in keys]
    return j.select(*out, *[F.col(f"`{c}`") for c in rest])


# ------------------------------------------------------------------ M1, S4
def upsert(target: DataFrame, updates: DataFrame, keys, order=None) -> DataFrame:
    """Last write wins.  With ``order`` columns the newest version by that
    order wins (replays are harmless); without, updates beat the target
    (duplicate keys inside ``updates`` then need an order)."""
    keys = list(keys)
    order = [order] if isinstance(order, str) else list(order or [])
    t = target.withColumn(_SIDE, F.lit(0))
    u = updates.select(*target.columns).withColumn(_SIDE, F.lit(1))
    rank = F.struct(*[F.col(c) for c in order], F.col(_SIDE))
    return _pick(t.unionByName(u), keys, rank)


kv_set = upsert


# ------------------------------------------------------------------ M2, W2
def insert_if_absent(target: DataFrame, updates: DataFrame, keys, order=None) -> DataFrame:
    """Existing values are kept; among new keys the first update wins."""
    keys = list(keys)
    order = [order] if isinstance(order, str) else list(order or [])
    t = target.withColumn(_SIDE, F.lit(0))
    u = updates.select(*target.columns).withColumn(_SIDE, F.lit(1))
    rank = F.struct(F.col(_SIDE), *[F.col(c) for c in order])
    return _pick(t.unionByName(u), keys, rank, agg=F.min_by)


# ------------------------------------------------------------------ M3
def delete_keys(target: DataFrame, keys_df: DataFrame, keys, strict: bool = False) -> DataFrame:
    """Remove keys.  ``strict`` raises ``KeyError`` when a key to delete is
    absent (a small anti join counted on the executors).  A NULL key is a
    key like any other."""
    keys = list(keys)
    if strict:
        missing = null_safe_join(keys_df.select(*keys), target.select(*keys), keys, "left_anti")
        if not missing.isEmpty():
            raise KeyError(f"{missing.count()} key(s) to delete are not present")
    return null_safe_join(target, keys_df.select(*keys), keys, "left_anti")


# ------------------------------------------------------------------ M5
def clear_state(state: DataFrame) -> DataFrame:
    """Empty state with the same schema (write it to replace the table)."""
    return state.where(F.lit(False))


# ------------------------------------------------------------------ S4 get, F7, F8
def kv_get(keys_df: DataFrame, state: DataFrame, key="key", value="value", default=None) -> DataFrame:
    """Look keys up; a missing key or an unreadable JSON value gives the
    default, never an error.  Adds ``found`` and ``readable``."""
    s = state.select(F.col(key), F.col(value).alias("__v"))
    j = keys_df.join(s, key, "left")
    readable = F.try_parse_json(F.col("__v")).isNotNull()
    d = F.lit(default).cast("string")
    return j.select(
        *keys_df.columns,
        F.col("__v").isNotNull().alias("found"),
        F.coalesce(readable, F.lit(False)).alias("readable"),
        F.when(readable, F.col("__v")).otherwise(d).alias(value),
    )


# ------------------------------------------------------------------ S5
def glob_regex(pattern: str) -> str:
    """A relative path pattern as a regex: its components match the last
    components of a path, ``*`` and ``?`` stay within one, ``**`` stands for
    any number of them."""
    out = []
    for part in pattern.strip("/").split("/"):
        if part == "**":
            out.append("(?:[^/]+/)*")
            continue
        rx, i = "", 0
        while i < len(part):
            c, close = part[i], part.find("]", i + 2)
            if c == "*":
                rx += "[^/]*"
            elif c == "?":
                rx += "[^/]"
            elif c == "[" and close > 0:
                inner = part[i + 1: close]
                inside = re.sub(r"([\\\[^&])", r"\\\1", inner.removeprefix("!"))
                rx += f"[^{inside}]" if inner[0] == "!" else f"[{inside}]"
                i = close
            else:
                rx += re.escape(c)
            i += 1
        out.append(rx + "/")
    body = "".join(out)
    return "^(?:.*/)?" + (body[:-1] if body.endswith("/") else body + "[^/]+") + "$"


def kv_list(state: DataFrame, pattern: str = "*", key="key", value="value") -> DataFrame:
    """Keys whose last path components match a pattern, ascending, with an unreadable-value flag
    (unreadable entries are reported, not dropped)."""
    hit = state.where(F.col(key).rlike(glob_regex(pattern)))
    readable = F.coalesce(F.try_parse_json(F.col(value)).isNotNull(), F.lit(False))
    return hit.select(key, readable.alias("readable"), value).orderBy(key)


# ------------------------------------------------------------------ U2, U3
def keyset_diff(before: DataFrame, after: DataFrame, keys=None) -> DataFrame:
    """One row: keys only before, only after, and whether the sets agree.
    Distinct keys meet in one full outer join; counts are aggregated."""
    keys = list(keys or before.columns)
    b = before.select(*keys).distinct().withColumn("__b", F.lit(True))
    a = after.select(*keys).distinct().withColumn("__a", F.lit(True))
    j = null_safe_join(b, a, keys, "full_outer")
    return j.agg(
        F.count_if(F.col("__a").isNull()).alias("only_before"),
        F.count_if(F.col("__b").isNull()).alias("only_after"),
    ).withColumn("equal", (F.col("only_before") == 0) & (F.col("only_after") == 0))


# ------------------------------------------------------------------ S6, U3
def _distinct_form(value: Column, dtype: T.DataType) -> Column:
    """The value in a form whose hash tells NULLs apart and does not depend
    on the order of map entries."""
    if isinstance(dtype, T.ArrayType):
        inner = F.transform(value, lambda x: _distinct_form(x, dtype.elementType))
    elif isinstance(dtype, T.MapType):
        inner = F.array_sort(F.transform(F.map_entries(value), lambda e: F.struct(
            _distinct_form(e["key"], dtype.keyType).alias("k"), _distinct_form(e["value"], dtype.valueType).alias("v"))))
    elif isinstance(dtype, T.StructType):
        inner = F.struct(*[_distinct_form(value[f.name], f.dataType).alias(f"f{i}") for i, f in enumerate(dtype.fields)])
    else:
        inner = value
    return F.struct(value.isNull().cast("tinyint").alias("n"), inner.alias("v"))


def table_fingerprint(df: DataFrame) -> DataFrame:
    """One row that two frames share if they hold the same rows the same
    number of times, in any order: ``n_rows`` and the sums of two 64-bit
    hashes of the rows, ``sum_a`` and ``sum_b``.  Maps and nested columns
    count by their values.  Fingerprints of parts add up to that of the
    whole.  Frames that differ share one with a chance of about 2**-120.
    One aggregate, combined before the shuffle."""
    row = [_distinct_form(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    a, b = F.xxhash64(*row), F.xxhash64(F.lit("second"), *reversed(row))
    wide = "decimal(38,0)"
    return df.select(a.cast(wide).alias("a"), b.cast(wide).alias("b")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("a"), F.lit(0).cast(wide)).alias("sum_a"), F.coalesce(F.sum("b"), F.lit(0).cast(wide)).alias("sum_b"))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Multiset equality of two frames by their fingerprints; columns are
    paired by position and compared in their common type."""
    if len(a.columns) != len(b.columns):
        return False
    names = [f"c{i}" for i in range(len(a.columns))]
    a, b = a.toDF(*names), b.toDF(*names)
    common = a.limit(0).union(b.limit(0)).schema
    left, right = (table_fingerprint(d.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in common.fields])) for d in (a, b))
    return left.exceptAll(right).isEmpty()


def write_if_changed(new: DataFrame, old: DataFrame | None, path: str, fmt: str = "parquet") -> bool:
    """Publish ``new`` to ``path`` only when it differs from ``old``.
    Returns whether a write happened."""
    if old is not None and same_rows(new, old):
        return False
    new.write.mode("overwrite").format(fmt).save(path)
    return True

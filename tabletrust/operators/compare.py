"""Keyed table comparison under tolerance.

``compare_tables`` is one full outer join on the keys followed by one
``inline`` that turns each compared row into one cell per column; all
per-column decisions are made on the joined row before the unpivot, so
the plan has a single shuffle (the join) whatever the column count.
Each side is first reduced to one row per key (with its row count), so
a key repeated on both sides never pairs every copy with every copy;
such keys come out with status ``duplicate_key``.  The reduction is
combined map-side and hash-partitions by the keys, which the join then
reuses, so it adds no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabletrust.functions.approx import INF, near, near_for_type, tolerance, tolerance_text
from tabletrust.operators.keyed import null_safe_join

# Fixed value: the report of arrays of different shapes (expected, obtained).
SHAPES_DIFFER = "Impossible to compare arrays with different shapes. Shapes: %s and %s"
ONE_IS_NULL = "one of the arrays is NULL"
NOT_FILLED = "the values do not fill the shape"
MATCHED, ONLY_ACTUAL, ONLY_EXPECTED, DUPLICATE = "matched", "missing_expected", "missing_actual", "duplicate_key"


def _one_per_key(df: DataFrame, keys, columns, prefix: str, flag: str) -> DataFrame:
    """``keys``, prefixed value columns of one row per key, the key's row
    count as ``<flag>_n`` and ``flag`` = true."""
    picked = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(f"{flag}_n"),
        # Any row does where the key is unique; of several, the smallest
        # text, so that repeated runs show the same one.
        F.min_by(F.struct(*[F.col(c) for c in columns]), F.to_json(F.struct(*[F.col(c) for c in columns]))).alias("__v"),
    )
    return picked.select(*keys, *[F.col(f"__v.{c}").alias(f"{prefix}{c}") for c in columns], f"{flag}_n",
                         F.lit(True).alias(flag))


def _is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType) and not isinstance(dtype, T.BooleanType)


def _as_text(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(col)
    return col.cast("string")


def compare_tables(
    actual: DataFrame,
    expected: DataFrame,
    keys,
    columns=None,
    rel=None,
    abs=None,  # noqa: A002
    nan_ok: bool = False,
) -> DataFrame:
    """One row per (key, column): ``status, column, obtained, expected,
    tolerance, ok``.

    Numbers compare under tolerance, decimals exactly within it, arrays and
    maps element-wise, everything else strictly.  A key found on one side
    only yields cells with ``ok = false`` and status ``missing_actual`` or
    ``missing_expected``.  When every compared column is numeric the values
    stay doubles, otherwise they are rendered as text.
    """
    keys = list(keys)
    columns = list(columns or [c for c in expected.columns if c not in keys])
    types = {c: expected.schema[c].dataType for c in columns}
    numeric = all(_is_number(t) for t in types.values())

    a = _one_per_key(actual, keys, columns, "a__", "__in_a")
    e = _one_per_key(expected, keys, columns, "e__", "__in_e")
    j = null_safe_join(a, e, keys, "full_outer")
    status = (
        F.when((F.coalesce("__in_a_n", F.lit(0)) > 1) | (F.coalesce("__in_e_n", F.lit(0)) > 1), F.lit(DUPLICATE))
        .when(F.col("__in_a").isNull(), F.lit(ONLY_EXPECTED))
        .when(F.col("__in_e").isNull(), F.lit(ONLY_ACTUAL))
        .otherwise(F.lit(MATCHED))
    )
    j = j.withColumn("status", status)

    cells = []
    for c in columns:
        av, ev, t = F.col(f"a__{c}"), F.col(f"e__{c}"), types[c]
        ok = F.when(F.col("status") != MATCHED, F.lit(False)).otherwise(near_for_type(av, ev, t, rel, abs, nan_ok))
        if numeric:
            ov, xv = av.cast("double"), ev.cast("double")
        else:
            ov, xv = _as_text(av, t), _as_text(ev, t)
        tol = tolerance(ev, rel, abs) if _is_number(t) else F.lit(None).cast("double")
        cells.append(
            F.struct(
                F.lit(c).alias("column"),
                ov.alias("obtained"),
                xv.alias("expected"),
                tol.alias("tolerance"),
                ok.alias("ok"),
            )
        )
    return j.select(*keys, "status", F.inline(F.array(*cells)))


def mismatch_summary(cells: DataFrame) -> DataFrame:
    """Per column ``n_total, n_mismatched, max_abs_diff, max_rel_diff``.

    Differences are taken over mismatched numeric cells only and are NULL
    when nothing differs.  The relative difference divides by the expected
    value (infinite when it is 0), the rule of the mapping report.
    """
    o, x = F.col("obtained").cast("double"), F.col("expected").cast("double")
    bad = ~F.col("ok")
    diff = F.abs(x - o)
    rel = F.when(x == 0, F.lit(INF)).otherwise(F.abs((x - o) / x))
    return cells.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(bad).alias("n_mismatched"),
        F.max(F.when(bad, diff)).alias("max_abs_diff"),
        F.max(F.when(bad & o.isNotNull() & x.isNotNull(), rel)).alias("max_rel_diff"),
    )


def array_mismatch_summary(actual: Column, expected: Column, ok_elem) -> Column:
    """A9 for arrays: struct of mismatched count, total, max absolute and
    max relative difference, dividing by |obtained| (infinite when 0) as
    the sequence report does."""
    pairs = F.zip_with(actual, expected, lambda a, e: F.struct(a.cast("double").alias("a"), e.cast("double").alias("e")))
    bad = F.filter(pairs, lambda p: ~ok_elem(p["a"], p["e"]))
    absd = F.transform(bad, lambda p: F.abs(p["e"] - p["a"]))
    reld = F.transform(bad, lambda p: F.when(p["a"] == 0, F.lit(INF)).otherwise(F.abs((p["e"] - p["a"]) / p["a"])))
    return F.struct(
        F.size(bad).alias("n_mismatched"),
        F.size(pairs).alias("n_total"),
        F.array_max(absd).alias("max_abs_diff"),
        F.array_max(reld).alias("max_rel_diff"),
    )


def shape_text(shape: Column) -> Column:
    """A shape as ``(2, 3)``, of one dimension as ``(2,)``."""
    inner = F.concat_ws(", ", shape.cast("array<string>"))
    text = F.concat(F.lit("("), inner, F.when(F.size(shape) == 1, F.lit(",)")).otherwise(F.lit(")")))
    return F.when(shape.isNotNull(), text)


def ndarray_index(position: Column, shape: Column) -> Column:
    """The index, one number for each dimension, of a position (from 0) in
    values that are stored flat, the last dimension running fastest."""
    start = F.struct(F.array().cast("array<bigint>").alias("index"), position.cast("bigint").alias("rest"))

    def outer(acc: Column, n: Column) -> Column:
        inside = acc["rest"] % n.cast("bigint")
        return F.struct(F.concat(F.array(inside), acc["index"]).alias("index"), ((acc["rest"] - inside) / n).cast("bigint").alias("rest"))

    return F.aggregate(F.reverse(shape), start, outer, lambda acc: acc["index"])


def ndarray_mismatches(df: DataFrame, keys, actual: Column, actual_shape: Column, expected: Column, expected_shape: Column,
                       rel=None, abs=None, nan_ok: bool = False, element: T.DataType | None = None) -> DataFrame:  # noqa: A002
    """The mismatches of n-d arrays that are stored flat with a shape.

    ``keys``, ``message``, ``index``, ``obtained``, ``expected``: one row per
    differing element with its index; arrays that cannot be compared element
    by element (other shapes, one of them NULL, a shape that its values do
    not fill) give one row with the ``message`` alone.  Arrays that are near
    give none, as do two that are NULL; arrays without shapes are of one
    dimension.  ``element``, if given, is the elements' type, by whose rule
    they are compared.
    """

    def differ(a: Column, x: Column) -> Column:
        return ~(near(a, x, rel, abs, nan_ok) if element is None else near_for_type(a, x, element, rel, abs, nan_ok))

    shape = F.coalesce(expected_shape, F.array(F.size(expected)))
    room = F.aggregate(shape, F.lit(1).cast("bigint"), lambda n, d: n * d)
    message = (
        F.when(actual.isNull() != expected.isNull(), F.lit(ONE_IS_NULL))
        .when(actual.isNull(), F.lit(None).cast("string"))
        .when(~actual_shape.eqNullSafe(expected_shape), F.format_string(
            SHAPES_DIFFER, *[F.coalesce(shape_text(s), F.lit("NULL")) for s in (expected_shape, actual_shape)]))
        .when((F.size(actual) != F.size(expected)) | (F.size(expected) != room), F.lit(NOT_FILLED))
    )
    pairs = F.zip_with(actual, expected, lambda a, x: F.struct(a.alias("obtained"), x.alias("expected")))
    placed = F.transform(pairs, lambda p, i: F.struct(i.alias("at"), p["obtained"].alias("obtained"), p["expected"].alias("expected")))
    cells = F.transform(
        F.filter(placed, lambda p: differ(p["obtained"], p["expected"])),
        lambda p: F.struct(F.lit(None).cast("string").alias("message"), ndarray_index(p["at"], shape).alias("index"),
                           p["obtained"].alias("obtained"), p["expected"].alias("expected")))
    whole = F.transform(F.array(message), lambda m: F.struct(
        m.alias("message"), F.lit(None).cast("array<bigint>").alias("index"),
        F.get(actual, F.lit(-1)).alias("obtained"), F.get(expected, F.lit(-1)).alias("expected")))
    return df.select(*keys, F.inline(F.when(message.isNotNull(), whole).otherwise(cells)))


def mismatch_rows(cells: DataFrame, keys, rel=None, abs=None) -> DataFrame:  # noqa: A002
    """A10: mismatched cells only, with ``expected ± tolerance`` text."""
    keys = list(keys)
    return cells.where(~F.col("ok")).select(
        *keys, "status", "column", "obtained", "expected",
        tolerance_text(F.col("expected"), rel, abs).alias("expected_text"),
    )


def snapshot_delta(old: DataFrame, new: DataFrame, keys, columns=None) -> DataFrame:
    """Exact keyed difference of two versions of a table.

    Returns ``keys, change, column, delta``: ``added`` / ``removed`` rows
    (``column`` NULL) and one ``changed`` row per differing column,
    compared null-safely; ``delta`` is ``new - old`` for numeric columns.
    A key repeated on either side is reported once as ``duplicate_key``.
    """
    keys = list(keys)
    columns = list(columns or [c for c in old.columns if c not in keys])
    types = {c: old.schema[c].dataType for c in columns}
    o = _one_per_key(old, keys, columns, "o__", "__in_o")
    n = _one_per_key(new, keys, columns, "n__", "__in_n")
    j = null_safe_join(o, n, keys, "full_outer")
    entries = []
    for c in columns:
        ov, nv = F.col(f"o__{c}"), F.col(f"n__{c}")
        delta = (nv.cast("double") - ov.cast("double")) if _is_number(types[c]) else F.lit(None).cast("double")
        entries.append(F.when(~ov.eqNullSafe(nv), F.struct(F.lit(c).alias("column"), delta.alias("delta"))))
    changed = F.filter(F.array(*entries), lambda s: s.isNotNull())
    whole = F.array(F.struct(F.lit(None).cast("string").alias("column"), F.lit(None).cast("double").alias("delta")))
    change = (
        F.when((F.coalesce("__in_o_n", F.lit(0)) > 1) | (F.coalesce("__in_n_n", F.lit(0)) > 1), F.lit(DUPLICATE))
        .when(F.col("__in_o").isNull(), F.lit("added"))
        .when(F.col("__in_n").isNull(), F.lit("removed"))
        .otherwise(F.lit("changed"))
    )
    rows = j.select(*keys, change.alias("change"),
                    F.when(change == "changed", changed).otherwise(whole).alias("__cells"))
    return rows.where(F.size("__cells") > 0).select(*keys, "change", F.inline("__cells"))


def touch_on_change(old: DataFrame, new: DataFrame, keys, stamp_col: str, now: Column | None = None,
                    columns=None) -> DataFrame:
    """M4: the new version of a table whose ``stamp_col`` is refreshed only
    on rows whose other columns really changed (new rows are stamped too).
    ``touched`` says which rows got the new stamp."""
    keys = list(keys)
    now = now if now is not None else F.current_timestamp()
    columns = list(columns or [c for c in new.columns if c not in keys and c != stamp_col])
    o = _one_per_key(old.withColumnRenamed(stamp_col, "__old_stamp"), keys, columns + ["__old_stamp"], "", "__in_o")
    o = o.select(*keys, *[F.col(c).alias(f"o__{c}") for c in columns], "__old_stamp", "__in_o")
    j = null_safe_join(new, o, keys, "left")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"o__{c}"))
    touched = F.col("__in_o").isNull() | ~same
    stamp_type = new.schema[stamp_col].dataType
    return j.select(
        *[c for c in new.columns if c != stamp_col],
        F.when(touched, now.cast(stamp_type)).otherwise(F.col("__old_stamp")).alias(stamp_col),
        touched.alias("touched"),
    )

"""Contract checks (C1-C12), defaults and safe casts.

Every check is a plain DataFrame plan.  Checks that need a whole key
group (primary key, unique, references) aggregate first, so a key that
holds a third of the rows collapses to one row per map task before any
shuffle (partial aggregation), and the reference check joins distinct
child keys rather than child rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tabletrust.contract import CURRENT_TIMESTAMP, TableContract

FLOAT_TYPES = (T.FloatType, T.DoubleType)


def _any(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds) if conds else F.lit(False)


def _all(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def _is_float(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, FLOAT_TYPES)


def bound(v) -> Column:
    """Literal for a range bound; integers beyond BIGINT (unsigned 64-bit
    maxima) become exact decimals."""
    if isinstance(v, int) and not isinstance(v, bool) and not (-(1 << 63) <= v < (1 << 63)):
        from decimal import Decimal

        return F.lit(Decimal(v))
    return F.lit(v)


def key_string(cols) -> Column:
    """Composite key as text, for reports that mix tables."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in cols])


# ---------------------------------------------------------------- C1, G7
def check_primary_key(df: DataFrame, cols) -> DataFrame:
    """Key groups that break a primary key: duplicated, or with a NULL part.

    Returns the key columns, ``n_rows`` and ``reason``.
    """
    cols = list(cols)
    null_part = _any([F.col(c).isNull() for c in cols])
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))
    return groups.where((F.col("n_rows") > 1) | null_part).withColumn(
        "reason", F.when(null_part, F.lit("null_key")).otherwise(F.lit("duplicate"))
    )


# ---------------------------------------------------------------- C2
def check_unique(df: DataFrame, cols, ci=()) -> DataFrame:
    """Duplicated keys of a UNIQUE constraint.

    Keys with a NULL part never collide.  Columns named in ``ci`` compare
    case-insensitively (``utf8_general_ci``) and are reported lower-cased.
    """
    cols = list(cols)
    keyed = df.where(_all([F.col(c).isNotNull() for c in cols])).select(
        *[F.lower(F.col(c)).alias(c) if c in ci else F.col(c) for c in cols]
    )
    return keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


# ---------------------------------------------------------------- C3
def check_not_null(df: DataFrame, cols, key) -> DataFrame:
    """One row per NULL cell in a NOT NULL column: key columns and ``col``.
    An empty string is not NULL."""
    cols, key = list(cols), list(key)
    flagged = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return (
        df.where(_any([F.col(c).isNull() for c in cols]))
        .select(*key, F.explode(F.filter(flagged, lambda x: x.isNotNull())).alias("col"))
    )


# ---------------------------------------------------------------- C4, J1
def check_foreign_key(child: DataFrame, cols, parent: DataFrame, parent_cols) -> DataFrame:
    """Child keys without a parent row, with the number of child rows.

    NULL child keys pass.  Child keys are aggregated before the anti join,
    so the join sees each key once however skewed the child is.
    """
    cols, parent_cols = list(cols), list(parent_cols)
    child_keys = (
        child.where(_all([F.col(c).isNotNull() for c in cols]))
        .groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    parent_keys = parent.select(*[F.col(p).alias(c) for p, c in zip(parent_cols, cols)])
    return child_keys.join(parent_keys, on=cols, how="left_anti")


# ---------------------------------------------------------------- C5
def range_violation(df: DataFrame, col: str, lo=None, hi=None) -> Column:
    c = F.col(col)
    conds = []
    if lo is not None:
        conds.append(c < bound(lo))
    if hi is not None:
        conds.append(c > bound(hi))
    if _is_float(df, col):
        # NaN sorts above everything in Spark, so ``NaN >= 0`` holds: guard
        # it.  (This keeps float checks out of Parquet pushdown on purpose:
        # row-group statistics ignore NaN and could skip the offending rows.)
        conds.append(F.isnan(c))
    # NULL for a NULL value: ``where`` drops it, ``count_if`` ignores it, and
    # a plain comparison pushes down to the Parquet reader, where min/max
    # statistics skip row groups without violations.
    return _any(conds)


def check_range(df: DataFrame, col: str, lo=None, hi=None, key=()) -> DataFrame:
    """Rows whose value lies outside ``[lo, hi]`` (inclusive); NaN fails,
    NULL passes."""
    return df.where(range_violation(df, col, lo, hi)).select(*key, col)


# ---------------------------------------------------------------- C6
def length_violation(col: str, n: int) -> Column:
    return F.char_length(F.col(col)) > F.lit(n)


def check_length(df: DataFrame, col: str, n: int, key=()) -> DataFrame:
    """Rows whose text is longer than ``n`` characters (not bytes)."""
    return df.where(length_violation(col, n)).select(*key, col)


# ---------------------------------------------------------------- C7
def domain_violation(col: str, values) -> Column:
    c = F.col(col)
    return c.isNotNull() & ~c.isin(list(values))


def check_domain(df: DataFrame, col: str, values, key=()) -> DataFrame:
    """Rows whose value is not one of ``values``; NULL passes."""
    return df.where(domain_violation(col, values)).select(*key, col)


# ---------------------------------------------------------------- C8
def implies_violation(if_, then_) -> Column:
    if_ = F.expr(if_) if isinstance(if_, str) else if_
    then_ = F.expr(then_) if isinstance(then_, str) else then_
    return F.coalesce(if_, F.lit(False)) & ~F.coalesce(then_, F.lit(False))


def check_implies(df: DataFrame, if_, then_, key=()) -> DataFrame:
    """Rows where the condition holds but the consequence does not.  A NULL
    condition is not triggered."""
    return df.where(implies_violation(if_, then_)).select(*key) if key else df.where(
        implies_violation(if_, then_)
    )


# ---------------------------------------------------------------- C9
def ordered_violation(lo, mid, hi) -> Column:
    lo, mid, hi = (F.expr(x) if isinstance(x, str) else x for x in (lo, mid, hi))
    # Comparisons with a NULL part are NULL, which ``coalesce`` turns into
    # "not violated": the rule applies only where all three are present.
    return F.coalesce(~((lo <= mid) & (mid <= hi)), F.lit(False))


def check_ordered(df: DataFrame, lo, mid, hi, key=()) -> DataFrame:
    """Rows breaking ``lo <= mid <= hi``."""
    out = df.where(ordered_violation(lo, mid, hi))
    return out.select(*key) if key else out


# ---------------------------------------------------------------- C10
def schema_diff(df: DataFrame, contract: TableContract, nullability: bool = False) -> DataFrame:
    """Missing, extra, retyped (and, if asked, re-nullabled) columns
    against a contract.  Parquet marks every column nullable, so
    nullability differences are only reported on request.

    Schemas are metadata of a few hundred entries at most; the difference
    is built on the driver and returned as a small DataFrame.
    """
    spark = df.sparkSession
    have = {f.name: f for f in df.schema.fields}
    want = {c.name: c for c in contract.columns}
    rows = []
    for name, c in want.items():
        if name not in have:
            rows.append((name, "missing", c.spark_type().simpleString(), None))
            continue
        got = have[name].dataType.simpleString()
        if got != c.spark_type().simpleString():
            rows.append((name, "retyped", c.spark_type().simpleString(), got))
        if nullability and not c.nullable and have[name].nullable:
            rows.append((name, "nullable", "not null", "null"))
    for name, f in have.items():
        if name not in want:
            rows.append((name, "extra", None, f.dataType.simpleString()))
    schema = "column string, change string, declared string, found string"
    return spark.createDataFrame(rows, schema)


# ---------------------------------------------------------------- C11
def row_rules(df: DataFrame, contract: TableContract) -> tuple[list[tuple[str, str, Column]], list[tuple[str, str]]]:
    """The rules that look at one row, as (rule, column, violated), and
    those that cannot be checked since ``df`` lacks their columns."""
    have = set(df.columns)
    single: list[tuple[str, str, Column]] = []
    # Rules over columns the frame lacks cannot be checked: they are
    # reported with a NULL count, never left out.
    unchecked: list[tuple[str, str]] = []
    for c in contract.not_null():
        if c in have:
            single.append(("not_null", c, F.col(c).isNull()))
        else:
            unchecked.append(("not_null", c))
    for c in contract.columns:
        here = c.name in have
        if c.lo is not None or c.hi is not None:
            if here:
                single.append(("range", c.name, range_violation(df, c.name, c.lo, c.hi)))
            else:
                unchecked.append(("range", c.name))
        if c.max_length is not None:
            if here:
                single.append(("length", c.name, length_violation(c.name, c.max_length)))
            else:
                unchecked.append(("length", c.name))
        if c.domain is not None:
            if here:
                single.append(("domain", c.name, domain_violation(c.name, c.domain)))
            else:
                unchecked.append(("domain", c.name))

    def add_rule(kind: str, name: str, cond: Column) -> None:
        # A documented rule over a column the frame lacks cannot be checked:
        # report it with a NULL count instead of failing the whole report.
        try:
            df.select(cond)
        except AnalysisException:
            unchecked.append((kind, name))
            return
        single.append((kind, name, cond))

    for rule in contract.implies:
        add_rule("implies", rule.name, implies_violation(rule.if_, rule.then_))
    for rule in contract.ordered:
        add_rule("ordered", rule.name, ordered_violation(rule.lo, rule.mid, rule.hi))
    return single, unchecked


def contract_report(
    df: DataFrame, contract: TableContract, parents: dict[str, DataFrame] | None = None
) -> DataFrame:
    """One row per rule (``tbl, rule, col, n_violations``), zero rows included.

    All row-local rules (NOT NULL, range, length, domain, implication,
    ordering) share a single aggregate pass; the key rules add one
    aggregate each; references add one anti join each over distinct keys.
    Column pruning keeps each pass to the columns it needs.
    """
    parents = parents or {}
    have = set(df.columns)
    single, unchecked = row_rules(df, contract)

    keys = [("primary_key", tuple(contract.primary_key))] if contract.primary_key else []
    keys += [("unique", tuple(u)) for u in contract.unique]
    unchecked += [(kind, ",".join(cols)) for kind, cols in keys if not have.issuperset(cols)]
    parts: list[DataFrame] = []
    for kind, name in unchecked:
        parts.append(df.sparkSession.range(1).select(
            F.lit(kind).alias("rule"), F.lit(name).alias("col"), F.lit(None).cast("bigint").alias("n_violations")))
    if single:
        aggs = [F.count_if(cond).alias(f"v{i}") for i, (_, _, cond) in enumerate(single)]
        entries = [
            F.struct(
                F.lit(rule).alias("rule"), F.lit(col).alias("col"), F.col(f"v{i}").alias("n_violations")
            )
            for i, (rule, col, _) in enumerate(single)
        ]
        parts.append(df.agg(*aggs).select(F.inline(F.array(*entries))))

    def counted(frame: DataFrame, rule: str, col: str) -> DataFrame:
        return frame.agg(F.count(F.lit(1)).alias("n_violations")).select(
            F.lit(rule).alias("rule"), F.lit(col).alias("col"), "n_violations"
        )

    if contract.primary_key and have.issuperset(contract.primary_key):
        parts.append(
            counted(check_primary_key(df, contract.primary_key), "primary_key", ",".join(contract.primary_key))
        )
    for ukey in contract.unique:
        if not have.issuperset(ukey):
            continue
        ci = [c for c in ukey if contract.column(c).ci]
        parts.append(counted(check_unique(df, ukey, ci), "unique", ",".join(ukey)))
    for fk in contract.foreign_keys:
        if fk.parent not in parents or not have.issuperset(fk.cols):
            # Not checked (parent table not supplied): say so with a NULL count.
            parts.append(df.sparkSession.range(1).select(
                F.lit("foreign_key").alias("rule"), F.lit(fk.name).alias("col"),
                F.lit(None).cast("bigint").alias("n_violations")))
            continue
        orphans = check_foreign_key(df, fk.cols, parents[fk.parent], fk.parent_cols)
        parts.append(
            orphans.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("n_violations")).select(
                F.lit("foreign_key").alias("rule"), F.lit(fk.name).alias("col"), "n_violations"
            )
        )
    if not parts:  # a contract without any rule: an empty report
        return df.sparkSession.createDataFrame([], "tbl string, rule string, col string, n_violations bigint")
    out = reduce(DataFrame.unionByName, parts)
    return out.select(F.lit(contract.name).alias("tbl"), "rule", "col", F.col("n_violations").cast("bigint"))


# ---------------------------------------------------------------- C12
def reconcile(stored: DataFrame, recomputed: DataFrame, keys, stored_col: str, actual_col: str) -> DataFrame:
    """Stored counters against recomputed ones; a missing group counts 0.

    Returns keys, ``stored``, ``actual`` for groups that disagree.
    """
    keys = list(keys)
    s = stored.select(*keys, F.col(stored_col).alias("stored"))
    a = recomputed.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col(actual_col).alias("actual"), F.lit(True).alias("__in_a"))
    # Null-safe: a NULL group on both sides is one group.
    cond = reduce(lambda x, y: x & y, [s[k].eqNullSafe(a[f"__k_{k}"]) for k in keys])
    j = s.withColumn("__in_s", F.lit(True)).join(a, cond, "full_outer")
    j = j.select(
        *[F.when(F.col("__in_s").isNotNull(), F.col(k)).otherwise(F.col(f"__k_{k}")).alias(k) for k in keys],
        F.coalesce("stored", F.lit(0)).cast("bigint").alias("stored"),
        F.coalesce("actual", F.lit(0)).cast("bigint").alias("actual"),
    )
    return j.where(F.col("stored") != F.col("actual"))


# ---------------------------------------------------------------- P1
def apply_defaults(df: DataFrame, contract: TableContract) -> DataFrame:
    """Fill *omitted* columns: the declared default, or NULL for a column
    without one (as an INSERT that leaves the column out).  Explicit NULLs
    in present columns stay NULL."""
    out = df
    for c in contract.columns:
        if c.name in df.columns:
            continue
        if c.has_default and c.default == CURRENT_TIMESTAMP:
            val = F.current_timestamp()
        elif c.has_default:
            val = bound(c.default) if isinstance(c.default, int) else F.lit(c.default)
        else:
            val = F.lit(None)
        out = out.withColumn(c.name, val.cast(c.spark_type()))
    return out


# ---------------------------------------------------------------- P2
ZERO_DATE = "0000-00-00 00:00:00"


def _cast_one(col: str, src: T.DataType, dst: T.DataType) -> Column:
    c = F.col(col)
    if isinstance(dst, (T.TimestampType, T.TimestampNTZType)) and isinstance(src, T.StringType):
        # try_to_timestamp gives NULL for the zero date instead of raising.
        parsed = F.try_to_timestamp(c)
        return parsed.cast(dst) if isinstance(dst, T.TimestampNTZType) else parsed
    if src == dst:
        return c
    return c.try_cast(dst)


def _present(items: list[Column]) -> Column:
    if not items:
        return F.array().cast("array<string>")
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def cast_with_reasons(df: DataFrame, contract: TableContract) -> DataFrame:
    """One projection that casts every contract column of ``df`` and
    records why a row would be rejected (``reasons``) or annotated
    (``notes``).  Raw values are kept as ``__raw_<name>``."""
    casted, reasons, notes = [], [], []
    for c in contract.columns:
        if c.name not in df.columns:
            continue
        src = df.schema[c.name].dataType
        dst = c.spark_type()
        typed = _cast_one(c.name, src, dst)
        raw = F.col(c.name)
        # Only a real conversion can lose a value; a column already of the
        # declared type adds no test, so the scan can prune it entirely.
        if src != dst:
            timestamp_from_text = isinstance(src, T.StringType) and isinstance(
                dst, (T.TimestampType, T.TimestampNTZType))
            is_zero = (F.coalesce(raw == F.lit(ZERO_DATE), F.lit(False)) if timestamp_from_text
                       else F.lit(False))
            lost = raw.isNotNull() & typed.isNull() & ~is_zero
            reasons.append(F.when(lost, F.lit(f"{c.name}:unconvertible")))
            if isinstance(src, T.NumericType) and isinstance(dst, T.NumericType):
                # 1.7 as an integer, or more decimals than the column keeps.
                back = typed.try_cast(src)
                reasons.append(F.when(typed.isNotNull() & ~F.coalesce(back == raw, F.lit(False)), F.lit(f"{c.name}:lossy")))
            if isinstance(src, T.StringType) and isinstance(dst, T.DecimalType):
                # Digits after the point that the column does not keep; other spellings (1e-3) by value.
                plain = raw.rlike(r"^\s*[+-]?\d*\.?\d*\s*$")
                digits = F.length(F.rtrim(F.regexp_extract(raw, r"\.(\d*)", 1), F.lit("0")))
                other = ~F.coalesce(raw.try_cast("double") == typed.cast("double"), F.lit(False))
                reasons.append(F.when(typed.isNotNull() & F.when(plain, digits > dst.scale).otherwise(other), F.lit(f"{c.name}:lossy")))
            if timestamp_from_text:
                notes.append(F.when(is_zero, F.lit(f"{c.name}:zero_date")))
        if c.max_length is not None and isinstance(dst, T.StringType):
            reasons.append(F.when(F.length(typed) > c.max_length, F.lit(f"{c.name}:too_long")))
        if c.lo is not None or c.hi is not None:
            out_of = F.lit(False)
            if c.lo is not None:
                out_of = out_of | (typed < bound(c.lo))
            if c.hi is not None:
                out_of = out_of | (typed > bound(c.hi))
            if isinstance(dst, (T.FloatType, T.DoubleType)):
                out_of = out_of | F.isnan(typed)
            reasons.append(F.when(F.coalesce(out_of, F.lit(False)), F.lit(f"{c.name}:out_of_range")))
        casted.append(typed.alias(c.name))
    extra = [F.col(c) for c in df.columns if c not in contract.names]
    return df.select(
        *[F.col(c).alias(f"__raw_{c}") for c in df.columns],
        *casted,
        *extra,
        _present(reasons).alias("reasons"),
        _present(notes).alias("notes"),
    )


def safe_cast(df: DataFrame, contract: TableContract) -> tuple[DataFrame, DataFrame]:
    """Cast text input to the contract types without raising (ANSI mode).

    Returns ``(good, rejected)``.  ``good`` holds the typed rows.  A value
    that was present but did not convert, lost digits on the way, is too long for
    its column or lies outside the declared range rejects its row; ``rejected`` keeps the original text plus a
    ``reasons`` array.  The zero date becomes NULL with its own reason code
    (in ``notes``) and does not reject the row.  Both frames come from one
    projection; persist the input when both are consumed.
    """
    staged = cast_with_reasons(df, contract)
    good = staged.where(F.size("reasons") == 0).select(
        *[c.name for c in contract.columns if c.name in df.columns],
        *[c for c in df.columns if c not in contract.names],
        "notes",
    )
    rejected = staged.where(F.size("reasons") > 0).select(
        *[F.col(f"__raw_{c}").alias(c) for c in df.columns], "reasons"
    )
    return good, rejected

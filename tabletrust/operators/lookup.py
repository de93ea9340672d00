"""Code lookups along declared references.

Whether a lookup table is broadcast is left to Spark, which knows its
measured size in bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabletrust.operators.numbering import number_rows


def lookup(df: DataFrame, codes: DataFrame, key: str, code_key: str, take) -> DataFrame:
    """Code -> description; unmatched rows are kept with NULLs.  A code
    listed more than once counts once (its smallest entry), so no row is
    multiplied."""
    take = [take] if isinstance(take, str) else list(take)
    c = codes.groupBy(F.col(code_key).alias("__code")).agg(F.min(F.struct(*take)).alias("__taken"))
    c = c.select("__code", *[F.col(f"__taken.{t}").alias(t) for t in take])
    return df.join(c, df[key] == F.col("__code"), "left").drop("__code")


def imputation_source(df: DataFrame, key, ref, take, order=None) -> DataFrame:
    """Join each row to the row its reference columns point at (same
    table).  The referenced side is reduced to one row per key first, so
    a duplicated key can never multiply rows."""
    key, ref = list(key), list(ref)
    take = [take] if isinstance(take, str) else list(take)
    order_col = F.struct(*[F.col(c) for c in (order or key)])
    src = df.groupBy(*key).agg(F.min_by(F.struct(*take), order_col).alias("__src"))
    src = src.select(*[F.col(k).alias(f"__k_{k}") for k in key], *[F.col(f"__src.{t}").alias(f"src_{t}") for t in take])
    cond = None
    for k, r in zip(key, ref):
        c = df[r] == src[f"__k_{k}"]
        cond = c if cond is None else cond & c
    return df.join(src, cond, "left").drop(*[f"__k_{k}" for k in key])


def report_order(df: DataFrame, order_cols, name: str = "report_order") -> DataFrame:
    """The report position from the numeric order columns of a lookup."""
    return number_rows(df, order_cols, name=name)

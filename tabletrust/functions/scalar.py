"""Scalar column functions.

All native expressions except ``escaped``, a small Arrow-batched text
helper used for previews.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ------------------------------------------------------------------ F2
# Python's ``\W`` on text is "not a letter, digit or underscore" in the
# Unicode sense; the explicit classes behave the same in Java and RE2
# (Java's plain ``\W`` would be ASCII-only and replace ``é``).
NON_WORD = r"[^\p{L}\p{N}_]"


def safe_name(col: Column, n: int = 30) -> Column:
    """Each non-word character of the first ``n`` becomes ``_`` (Unicode
    word characters stay).  One character gives one, so the cut comes
    first."""
    return F.regexp_replace(F.substring(col, 1, n), NON_WORD, "_")


# ------------------------------------------------------------------ F4
def single_segment(col: Column) -> Column:
    """A name must not contain a path separator."""
    return ~col.contains("/")


# ------------------------------------------------------------------ F3
# Control characters are 0-31 and 127; tab, carriage return
# and line feed are named apart.
OTHER_CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
NON_ASCII = r"[^\x00-\x7f]"
OUTSIDE_PRINTABLE = r"[^\x20-\x7e]"


def hygiene_counts(text: Column) -> dict[str, Column]:
    """Per-row character counts of a text column."""
    return {
        "n_tab": F.regexp_count(text, F.lit(r"\t")),
        "n_cr": F.regexp_count(text, F.lit(r"\r")),
        "n_lf": F.regexp_count(text, F.lit(r"\n")),
        "n_control": F.regexp_count(text, F.lit(OTHER_CONTROL)),
        "n_non_ascii": F.regexp_count(text, F.lit(NON_ASCII)),
    }


def hygiene_profile(df: DataFrame, text: str, by) -> DataFrame:
    """per group, documents, documents with any character outside
    printable ASCII, and tab / CR / LF / other control / non-ASCII counts,
    in one aggregate pass over whole texts."""
    by = [by] if isinstance(by, str) else list(by)
    counts = hygiene_counts(F.col(text))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(F.col(text).rlike(OUTSIDE_PRINTABLE)).alias("n_docs_unprintable"),
        *[F.sum(c).cast("bigint").alias(name) for name, c in counts.items()],
    )


def escaped_text(value: str | None) -> str | None:
    """Escape a text the way test reports show it: non-ASCII as ``\\x``,
    ``\\u``, ``\\U`` codes, control characters as ``\\xNN`` or ``\\t \\r \\n``."""
    if value is None:
        return None
    return value.encode("unicode_escape").decode("ascii")


@F.pandas_udf(T.StringType())
def escaped(text: pd.Series) -> pd.Series:
    """Arrow-batched preview column built from ``escaped_text``."""
    return text.map(escaped_text, na_action="ignore")


# ------------------------------------------------------------------ P3
def search(col: Column, pattern: str) -> Column:
    """Unanchored regular-expression search on the text form (not a full
    match)."""
    return col.cast("string").rlike(pattern)


# ------------------------------------------------------------------ P4
# The realm flag masks and their meanings.
REALM_FLAGS = {
    0x1: "invalid",
    0x2: "offline",
    0x4: "show_version",
    0x20: "new_players",
    0x40: "recommended",
}


def decode_flags(col: Column, masks: dict[int, str] = REALM_FLAGS) -> tuple[Column, Column]:
    """Labels of the set bits (in mask order) and the bits no label covers."""
    known = 0
    labels = []
    for mask, label in sorted(masks.items()):
        known |= mask
        labels.append(F.when(col.bitwiseAND(F.lit(mask)) != 0, F.lit(label)))
    names = F.filter(F.array(*labels), lambda x: x.isNotNull())
    unknown = col.bitwiseAND(F.lit(~known))
    return names, unknown


# ------------------------------------------------------------------ F5
EPOCH = "1970-01-01 00:00:00"


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a wall-clock (UTC) timestamp.

    Built from wall-clock fields (day number and time of day), which do
    not depend on the session time zone; ``timestamp_diff`` would first
    cast a TIMESTAMP_NTZ to the session zone and shift across DST."""
    w = ts.cast("timestamp_ntz")
    days = F.datediff(w.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(w) * 3600 + F.minute(w) * 60 + F.second(w)


def from_epoch_seconds(seconds: Column) -> Column:
    """UNIX seconds to a UTC wall-clock timestamp (TIMESTAMP_NTZ), by
    interval arithmetic on a TIMESTAMP_NTZ (no time-zone conversion)."""
    days = F.floor(seconds / 86400).cast("int")
    rest = (seconds - days.cast("bigint") * 86400).cast("int")
    return F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(days, F.lit(0), F.lit(0), rest)


# ------------------------------------------------------------------ F6
def round_to(value: Column, digits: Column, dtype: T.DataType | None = None) -> Column:
    """Round (half up) to a number of decimals taken from the data; a
    negative number rounds to tens, hundreds and so on.

    ``round(v, col)`` needs a constant scale, so the digits pick one of the
    constant-scale roundings, which keep decimals exact.  Give a decimal's
    type as ``dtype``: the result then has that type and all its digits
    (a number that rounds beyond it raises), whatever the digits are, and
    there are only the roundings that the type can have.  Without it more
    than 38 decimals leave a value as it is, and fewer than -9 are an error:
    such roundings would widen a decimal's type and cost it its own
    decimals."""
    if isinstance(dtype, T.DecimalType):
        whole = dtype.precision - dtype.scale
        out = F.when(digits >= dtype.scale, value.cast(dtype)).when(digits < -whole, F.lit(0).cast(dtype))
        for d in range(dtype.scale - 1, -whole - 1, -1):
            out = out.when(digits == d, F.round(value, d).cast(dtype))
        return out
    low = F.raise_error(F.concat(F.lit("cannot round to so few decimals: "), digits.cast("string")))
    out = F.when(digits > 38, value).when(digits < -9, low)
    for d in range(-9, 39):
        out = out.when(digits == d, F.round(value, d))
    return out


# ------------------------------------------------------------------ F10
def imputed(n_points: Column) -> Column:
    """No data points behind a value: it was calculated or imputed."""
    return F.coalesce(n_points, F.lit(0)) == 0


# ------------------------------------------------------------------ F8
def map_get(m: Column, key, default=None) -> Column:
    """Value for ``key``; ``default`` only when the key is absent (a key
    present with a NULL value stays NULL)."""
    k = F.lit(key) if not isinstance(key, Column) else key
    return F.when(F.map_contains_key(m, k), F.try_element_at(m, k)).otherwise(F.lit(default))

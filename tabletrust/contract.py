"""Declared table contracts.

A contract carries what a database would enforce for a table: column
types, NOT NULL, defaults, primary and unique keys (optionally
case-insensitive), references to other tables, inclusive value ranges,
character lengths, value domains and documented cross-column rules.
Spark enforces none of this, so ``tabletrust.operators.checks`` turns a
contract into DataFrame checks.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import types as T

CURRENT_TIMESTAMP = "CURRENT_TIMESTAMP"


@lru_cache(maxsize=None)
def parse_type(dtype: str) -> T.DataType:
    """Spark type of a type name (parsed once per name)."""
    return T.DataType.fromDDL(dtype)


@dataclass(frozen=True)
class Col:
    """One declared column.

    ``dtype`` is a Spark SQL type name (``bigint``, ``decimal(20,0)``, ...).
    ``lo``/``hi`` are inclusive bounds (unsigned and width types),
    ``max_length`` counts characters (``varchar(n)``), ``domain`` lists
    the allowed values (NULL passes), ``ci`` marks a case-insensitive
    collation for keys on this column.  ``default`` fills a column that is
    *omitted* from the input, never an explicit NULL.
    """

    name: str
    dtype: str
    nullable: bool = True
    default: object = None
    has_default: bool = False
    max_length: int | None = None
    lo: float | int | None = None
    hi: float | int | None = None
    domain: tuple | None = None
    ci: bool = False

    def spark_type(self) -> T.DataType:
        return parse_type(self.dtype)


def unsigned(name: str, bits: int = 32, **kw) -> Col:
    """``int unsigned`` and friends: widened Spark type plus a range rule.

    Fixed values: the unsigned maxima 255, 65535, 16777215, 4294967295 and
    18446744073709551615 for 8, 16, 24, 32 and 64 bits.
    """
    hi = (1 << bits) - 1
    dtype = {8: "smallint", 16: "int", 24: "int", 32: "bigint", 64: "decimal(20,0)"}[bits]
    return Col(name, dtype, lo=0, hi=hi, **kw)


@dataclass(frozen=True)
class ForeignKey:
    cols: tuple[str, ...]
    parent: str
    parent_cols: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"{','.join(self.cols)}->{self.parent}({','.join(self.parent_cols)})"


@dataclass(frozen=True)
class Implies:
    """Documented rule ``if_ => then_`` as SQL boolean expressions."""

    name: str
    if_: str
    then_: str


@dataclass(frozen=True)
class Ordered:
    """``lo <= mid <= hi`` where all three are present (SQL expressions)."""

    name: str
    lo: str
    mid: str
    hi: str


@dataclass(frozen=True)
class TableContract:
    name: str
    columns: tuple[Col, ...]
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    implies: tuple[Implies, ...] = ()
    ordered: tuple[Ordered, ...] = ()
    generated_key: str | None = None
    notes: dict = field(default_factory=dict, compare=False, hash=False)

    def schema(self) -> T.StructType:
        """Spark schema.  Nullability is kept loose on purpose: NOT NULL is
        a rule (C3) reported with the offending key, not a read failure."""
        return T.StructType([T.StructField(c.name, c.spark_type(), True) for c in self.columns])

    def column(self, name: str) -> Col:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(f"{self.name} has no column {name}")

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def not_null(self) -> list[str]:
        """Declared NOT NULL plus primary-key parts (a key implies NOT NULL)."""
        out = [c.name for c in self.columns if not c.nullable]
        out += [k for k in self.primary_key if k not in out]
        return out

    def row_key(self) -> tuple[str, ...]:
        """Columns that identify a row in reports."""
        if self.primary_key:
            return self.primary_key
        if self.unique:
            return self.unique[0]
        return tuple(self.names)

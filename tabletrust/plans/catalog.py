"""Registry of named queries: a Spark plan plus an equivalent DuckDB SQL.

Each query reads the driver tables below ``sf_dir`` (or tables Spark
derives from them) and returns a DataFrame; ``sql`` is the oracle the
correctness gate runs on the same parquet files, with identical column
names.  ``sql=None`` marks plans that are not SQL-expressible (iterative
or streaming); those are tested against brute force instead.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tabletrust.sources.tables import read_table


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ops: tuple[str, ...]


REGISTRY: dict[str, Query] = {}


def query(name: str, ops: tuple[str, ...] = (), sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql.strip() if sql else None, ops)
        return fn

    return deco


class Tables:
    """Lazy access to the driver tables of one scale directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

"""Typed table scans.

Parquet scans are lazy: Catalyst prunes columns and pushes filters into
the reader, so callers just select what they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tabletrust.contract import TableContract
from tabletrust.operators.checks import safe_cast

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A lazy scan of one table, of the files it has now."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_with_contract(
    spark: SparkSession, path: str, contract: TableContract, fmt: str = "parquet", **options
) -> tuple[DataFrame, DataFrame]:
    """Scan a table under its contract: ``(typed, rejected)``.

    Text formats are read with every declared column as a string (so a
    code such as ``01001`` keeps its leading zero and nothing is inferred),
    then cast by the contract; values that do not convert go to the
    rejected frame instead of silently becoming NULL.  Parquet keeps its
    stored types and is cast only where they differ from the contract.
    """
    if fmt == "parquet":
        raw = spark.read.options(**options).parquet(path)
    else:
        text_schema = T.StructType([T.StructField(c, T.StringType(), True) for c in contract.names])
        raw = spark.read.schema(text_schema).options(**options).format(fmt).load(path)
    keep = [c for c in raw.columns if c in contract.names]
    typed, rejected = safe_cast(raw.select(*keep), contract)
    return typed.drop("notes"), rejected

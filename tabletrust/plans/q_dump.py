"""Dump round trip (S2, S3): ``part`` written as extended-INSERT text
below the shared checkpoint folder, read back through the dump reader
under the ``part`` contract, and published by a staged full refresh."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabletrust.plans.catalog import Tables, query
from tabletrust.plans.driver_contracts import PART
from tabletrust.session import scratch_path
from tabletrust.sources import dump as D


@query("dump_roundtrip", ("S2", "S3", "P2"), "SELECT * FROM part")
def dump_roundtrip(spark, sf_dir):
    base = scratch_path(spark, "dump-roundtrip")
    D.write_insert_dump(Tables(spark, sf_dir).part, f"{base}/dump", "part", tuples_per_statement=200)
    good, rejected = D.read_insert_dump(spark, f"{base}/dump", "part", PART)
    if not rejected.isEmpty():
        raise RuntimeError(f"{rejected.count()} dump tuples rejected")
    published, _ = D.full_refresh(good.drop("notes"), f"{base}/table", PART, f"{base}/staging")
    if not published:
        raise RuntimeError("part breaks its contract; not published")
    return spark.read.parquet(f"{base}/table").select(*[F.col(c) for c in PART.names])


@query("dump_rejects", ("S2", "P2"), """
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, 'p_size:unconvertible' AS reason FROM part WHERE p_size > 40""")
def dump_rejects(spark, sf_dir):
    """Large parts are dumped with their size spelled as text; the reader
    must reject exactly those tuples (a value that does not convert)."""
    base = scratch_path(spark, "dump-rejects")
    p = Tables(spark, sf_dir).part
    spelled = p.withColumn("p_size", F.when(F.col("p_size") > 40, F.concat(F.lit("size "), F.col("p_size")))
                           .otherwise(F.col("p_size").cast("string")))
    D.write_insert_dump(spelled, f"{base}/dump", "part", tuples_per_statement=200)
    _, rejected = D.read_insert_dump(spark, f"{base}/dump", "part", PART)
    return rejected.select(F.get("vals", F.lit(0)).alias("p_partkey"), F.explode("reasons").alias("reason"))


@query("dump_in_splits", ("S2",), """
    SELECT p_partkey, p_name || ';' || chr(10) || '),(' || p_brand AS p_name, p_size FROM part""")
def dump_in_splits(spark, sf_dir):
    """A file is one statement, with ends of lines and of tuples inside its
    values; it is read in whatever splits the files have."""
    base = scratch_path(spark, "dump-splits")
    p = Tables(spark, sf_dir).part
    named = p.withColumn("p_name", F.concat("p_name", F.lit(";\n),("), "p_brand"))
    D.write_statement_files(named.select(*PART.names), base, "part")
    good, rejected = D.read_insert_dump(spark, base, "part", PART, record_end=None)
    if not rejected.isEmpty():
        raise RuntimeError(f"{rejected.count()} dump tuples rejected")
    return good.select("p_partkey", "p_name", "p_size")

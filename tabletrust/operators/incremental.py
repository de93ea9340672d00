"""C11 over growing tables: a contract report that reads new files only.

Of each data file the state keeps its number of violations of every rule
that looks at one row, and for key rules and references the fingerprints
of the file's keys with their numbers of rows.  Both merge by addition, so
a report is an aggregate of the state of the files that are there now:
files that came since are read and added, and what a removed or rewritten
file had brought no longer counts.

Keys that should be unique are stored row by row, without a shuffle; a
report shuffles them once, by the key alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tabletrust.contract import TableContract
from tabletrust.operators.checks import row_rules

STATE = "file binary, rule string, col string, key binary, null_part boolean, n bigint"
KEY_RULES = ("primary_key", "unique", "foreign_key")


def key_fingerprint(contract: TableContract, cols, names=None, ci=()) -> Column:
    """A composite key in the contract's types as bytes: its text below 16
    bytes, else the text's MD5; NULL parts, and where one part ends, are told
    apart.  ``names`` are the columns that hold it, if they are called
    otherwise (a referenced table's)."""
    parts = []
    for col, name in zip(cols, names or cols, strict=True):
        dtype = contract.column(col).spark_type()
        value = F.col(f"`{name}`").cast(dtype)
        if dtype.typeName() in ("float", "double"):
            value = value + F.lit(0.0).cast(dtype)  # -0.0 is 0.0
        elif dtype.typeName() == "timestamp":
            value = F.unix_micros(value)  # whatever the session's zone
        text = value.cast("string")
        text = F.lower(text) if col in ci else text
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("n")))
    whole = F.concat(*parts).cast("binary")
    return F.when(F.octet_length(whole) < 16, whole).otherwise(F.unhex(F.md5(whole)))


def _keys(contract: TableContract) -> list[tuple[str, str, tuple[str, ...], list[str]]]:
    keys = [("primary_key", ",".join(contract.primary_key), tuple(contract.primary_key), [])] if contract.primary_key else []
    keys += [("unique", ",".join(u), tuple(u), [c for c in u if contract.column(c).ci]) for u in contract.unique]
    return keys + [("foreign_key", fk.name, tuple(fk.cols), []) for fk in contract.foreign_keys]


def file_state(df: DataFrame, contract: TableContract, file: Column) -> DataFrame:
    """The state of the rows of ``df``, per ``file``.

    Rules whose columns ``df`` lacks have a NULL count.  NULL keys count
    for the primary key only.  No rows give no state.
    """
    have = set(df.columns)
    df = df.withColumn("__file", file)
    single, unchecked = row_rules(df, contract)
    unchecked += [(rule, name) for rule, name, cols, _ in _keys(contract) if not have.issuperset(cols)]
    none = [F.lit(None).cast("binary").alias("key"), F.lit(None).cast("boolean").alias("null_part")]
    entries = [F.struct(F.lit(rule).alias("rule"), F.lit(name).alias("col"), *none, F.col(f"v{i}").alias("n")) for i, (rule, name, _) in enumerate(single)]
    entries += [F.struct(F.lit(rule).alias("rule"), F.lit(name).alias("col"), *none, F.lit(None).cast("bigint").alias("n")) for rule, name in unchecked]
    parts = []
    if entries:
        counts = df.groupBy("__file").agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(cond).alias(f"v{i}") for i, (_, _, cond) in enumerate(single)])
        parts.append(counts.select(F.col("__file").alias("file"), F.inline(F.array(*entries))))
    for rule, name, cols, ci in _keys(contract):
        if not have.issuperset(cols):
            continue
        null_part = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in cols])
        rows = df if rule == "primary_key" else df.where(~null_part)
        rows = rows.select(F.col("__file").alias("file"), key_fingerprint(contract, cols, ci=ci).alias("key"), null_part.alias("null_part"))
        if rule == "foreign_key":  # few keys, many rows
            rows = rows.groupBy("file", "key").agg(F.count(F.lit(1)).alias("n")).withColumn("null_part", F.lit(False))
        else:
            rows = rows.withColumn("n", F.lit(1).cast("bigint"))
        parts.append(rows.select("file", F.lit(rule).alias("rule"), F.lit(name).alias("col"), "key", "null_part", "n"))
    if not parts:
        return df.sparkSession.createDataFrame([], STATE)
    return reduce(DataFrame.unionByName, parts)


def merged_report(state: DataFrame, contract: TableContract, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """The rows of :func:`checks.contract_report` from the state of all
    files: rules that some file could not be checked for, and references
    without their table, have a NULL count."""
    spark, parents = state.sparkSession, parents or {}
    # The rules are those of the contract, whatever the files hold.
    no_rows = spark.createDataFrame([], ", ".join(f"`{c.name}` {c.dtype}" for c in contract.columns))
    single, unchecked = row_rules(no_rows, contract)
    rules = [(rule, name) for rule, name, _ in single] + unchecked + [(rule, name) for rule, name, _, _ in _keys(contract)]
    if not rules:
        return spark.createDataFrame([], "tbl string, rule string, col string, n_violations bigint")
    fks = {fk.name: fk for fk in contract.foreign_keys}
    rows = state.where(~F.col("rule").isin(*KEY_RULES) | F.col("n").isNull())
    found = [rows.groupBy("rule", "col").agg(F.sum("n").alias("n"), F.count_if(F.col("n").isNull()).alias("unknown"))]
    missing = [name for name, fk in fks.items() if fk.parent not in parents]
    for rule, name in dict.fromkeys((rule, name) for rule, name, _, _ in _keys(contract) if name not in missing):
        # Grouped by the key alone: the join with a parent needs no other shuffle.
        own = (F.col("rule") == rule) & (F.col("col") == name) & F.col("n").isNotNull()
        keyed = state.where(own).groupBy("key").agg(F.sum("n").alias("n"), F.max("null_part").alias("null_part"))
        if rule == "foreign_key":
            fk = fks[name]
            known = parents[fk.parent].select(key_fingerprint(contract, fk.cols, fk.parent_cols).alias("key"))
            broken = keyed.join(known, "key", "left_anti").agg(F.sum("n").alias("n"))
        else:
            broken = keyed.agg(F.count_if((F.col("n") > 1) | F.col("null_part")).alias("n"))
        found.append(broken.select(F.lit(rule).alias("rule"), F.lit(name).alias("col"), "n", F.lit(0).cast("bigint").alias("unknown")))
    counts = reduce(DataFrame.unionByName, found).groupBy("rule", "col").agg(F.sum("n").alias("n"), F.sum("unknown").alias("unknown"))
    lacks = [(rule, name) in unchecked or name in missing for rule, name in rules]
    all_ = spark.createDataFrame([(rule, name, lack) for (rule, name), lack in zip(rules, lacks, strict=True)], "rule string, col string, lacks boolean")
    n = F.when(F.col("lacks") | (F.coalesce("unknown", F.lit(0)) > 0), F.lit(None)).otherwise(F.coalesce("n", F.lit(0)))
    return all_.join(counts, ["rule", "col"], "left").select(F.lit(contract.name).alias("tbl"), "rule", "col", n.cast("bigint").alias("n_violations"))


def _file() -> Column:
    """A file by its path, time and size, as their MD5: a rewritten one is
    another, and rows that name their file stay narrow."""
    m = F.col("_metadata")
    name = F.concat_ws("|", m["file_path"], F.unix_micros(m["file_modification_time"]).cast("string"), m["file_size"].cast("string"))
    return F.unhex(F.md5(name.cast("binary")))


def _state(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(STATE).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STATE)


def incremental_report(spark: SparkSession, paths: list[str], contract: TableContract, state_path: str,
                       parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """:func:`checks.contract_report` of the Parquet files below ``paths``,
    of which only those are read that the state at ``state_path`` lacks;
    what they bring is appended to it.

    The files of one call share a schema; a file without rows is read again
    each time.  References are checked against ``parents`` as they are now.  One state
    belongs to one contract and one writer: a second run of the same files
    adds nothing.  The lists of files pass through the driver, as they do
    whenever Spark lists a table; rows and keys do not.
    """
    here = spark.read.format("binaryFile").load(paths).select("path", _file().alias("file"))
    new = [r.path for r in here.join(_state(spark, state_path).select("file").distinct(), "file", "left_anti").collect()]
    if new:
        rows = spark.read.parquet(*new)
        file_state(rows, contract, _file()).write.mode("append").parquet(state_path)
    # The state stays where it is: the list of files goes to all tasks.
    state = _state(spark, state_path).join(F.broadcast(here.select("file")), "file", "left_semi")
    return merged_report(state, contract, parents)

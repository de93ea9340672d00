"""Extended-INSERT dump files as tables (S2), written back (for round
trips and fixtures), and staged full refresh (S3).

Reading: the text source splits the files at ``;\\n`` (``record_end``), so
files split across tasks like any text input.  A record usually is one
statement, but may be several, or a whole file whose lines end otherwise
(give ``;\\r\\n`` for such dumps, so that they split too): every record is
read to its end.  Statements that are ``INSERT INTO <t> [(columns)] VALUES``
(or REPLACE, with any of the usual modifiers) for the wanted table give one row per ``(v, v, ...)`` tuple, in batches of
bounded size; other statements and comments are skipped.  Values are kept
as text and cast by the table contract afterwards (``safe_cast``), so a
quoted integer ``'1'`` becomes 1, the zero date becomes NULL with a note,
and anything unconvertible is rejected with its statement and tuple
position.  A broken tuple is rejected with its offset in the record, and
reading goes on at the next tuple or statement; nothing is dropped.
Dump writers escape newlines inside values, so ``;\\n`` never occurs
inside a value; one record must fit in a task.  For dumps where either does
not hold there is ``record_end=None``: see :mod:`dump_splits`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabletrust.contract import TableContract
from tabletrust.operators.checks import contract_report, safe_cast
from tabletrust.session import checkpoint_dir

# MySQL string escapes inside quoted dump values.
ESCAPES = {"0": "\0", "b": "\b", "n": "\n", "r": "\r", "t": "\t", "Z": "\x1a", "\\": "\\", "'": "'", '"': '"'}

#: Rows handed on at a time.
CHUNK = 4096

TUPLES_SCHEMA = T.StructType([
    T.StructField("stmt_id", T.LongType()),
    T.StructField("tuple_idx", T.IntegerType()),
    T.StructField("cols", T.ArrayType(T.StringType())),
    T.StructField("vals", T.ArrayType(T.StringType())),
    T.StructField("error", T.StringType()),
])

# Pieces of the dump language; possessive, so a match costs linear time.
_BLANK = re.compile(r"(?:\s++|--[^\n]*+|\#[^\n]*+|/\*.*?\*/)*+", re.S)
_INTO = r"(?:INSERT|REPLACE)\s+(?:(?:LOW_PRIORITY|DELAYED|HIGH_PRIORITY|IGNORE)\s+)*(?:INTO\s+)?(?:`?\w+`?\s*\.\s*)?"
_HEAD = re.compile(_INTO + r"`?(\w+)`?\s*(?:\(([^()]*)\)\s*)?VALUES?\b\s*", re.I)
_QUOTED = re.compile(r"'((?:[^'\\]++|\\.|'')*+)'|\"((?:[^\"\\]++|\\.|\"\")*+)\"", re.S)
_BARE = re.compile(r"[^,()'\";]*+")
_ESCAPE = re.compile(r"\\(.)|''|\"\"", re.S)
_OTHER = re.compile(r"(?:[^;'\"`\-/\#]++|'(?:[^'\\]++|\\.|'')*+'|\"(?:[^\"\\]++|\\.|\"\")*+\"|`[^`]*+`|--[^\n]*+|/\*.*?\*/|\#[^\n]*+|[^;])*+", re.S)
_SPACE = re.compile(r"\s*+")
_NEXT = re.compile(r"\)\s*+,\s*+(?=\()|\)?\s*+;\s*+(?=INSERT\b|REPLACE\b|$)", re.I)


def _unescape(text: str, quote: str) -> str:
    if "\\" not in text and quote * 2 not in text:
        return text
    return _ESCAPE.sub(lambda m: ESCAPES.get(m[1], m[1]) if m[1] else m[0][0] if m[0][0] == quote else m[0], text)


def _value(text: str, at: int) -> tuple[str | None, int]:
    """The value at ``at`` and where it ends."""
    m = _QUOTED.match(text, at)
    if m:
        return (_unescape(m[1], "'") if m[1] is not None else _unescape(m[2], '"')), m.end()
    if at < len(text) and text[at] in "'\"":
        raise ValueError("unbalanced quote")
    m = _BARE.match(text, at)
    bare = m[0].strip()
    if not bare:
        raise ValueError("missing value")
    return (None if bare.upper() == "NULL" else bare), m.end()


def _tuple(text: str, at: int) -> tuple[list[str | None], int]:
    """The tuple that opens at ``at`` and where it ends."""
    row: list[str | None] = []
    at += 1
    while True:
        v, at = _value(text, _SPACE.match(text, at).end())
        row.append(v)
        at = _SPACE.match(text, at).end()
        if at >= len(text):
            raise ValueError("unterminated tuple")
        if text[at] == ")":
            return row, at + 1
        if text[at] != ",":
            raise ValueError("expected ',' or ')'")
        at += 1


def read_tuples(text: str, table: str) -> Iterator[tuple[int | None, list[str] | None, list[str | None] | None, str | None]]:
    """(tuple index in its statement, listed columns, values, error) of the
    table's tuples in a record of statements."""
    at = 0
    while True:
        at = _BLANK.match(text, at).end()
        if at >= len(text):
            return
        if text[at] == ";":
            at += 1
            continue
        head = _HEAD.match(text, at)
        if not head or head[1].lower() != table.lower():
            if not head and re.match(_INTO + "`?" + re.escape(table) + r"`?[\s(]", text[at: at + 4096], re.I):
                yield None, None, None, f"unreadable INSERT at offset {at}"
            at = max(at + 1, _OTHER.match(text, at).end())
            continue
        cols = [c.strip().strip("`") for c in head[2].split(",")] if head[2] is not None else None
        at, k = head.end(), 0
        while True:
            at = _BLANK.match(text, at).end()
            if at >= len(text) or text[at] == ";":
                break
            if text[at] == "," and k:
                at += 1
                continue
            start = at
            try:
                if text[at] != "(":
                    raise ValueError("expected '('")
                row, at = _tuple(text, at)
                yield k, cols, row, None
            except ValueError as e:
                yield k, cols, None, f"{e} in tuple {k} at offset {start}"
                # Go on at the next tuple of this statement, or after it.
                nxt = _NEXT.search(text, start)
                at = nxt.end() if nxt else len(text)
                if nxt and ";" in nxt[0]:
                    break
            k += 1


def read_records(spark: SparkSession, path: str, record_end: str = ";\n") -> DataFrame:
    """``stmt_id, text`` for every record that may hold an INSERT."""
    raw = spark.read.option("lineSep", record_end).text(path)
    return raw.where(F.col("value").rlike(r"(?i)(INSERT|REPLACE)\s")).select(
        F.monotonically_increasing_id().alias("stmt_id"), F.col("value").alias("text"))


def _listed(name: str, i: int) -> Column:
    """The value of contract column ``name``, the ``i``-th of the table."""
    at = F.array_position(F.transform("cols", lambda c: F.lower(c)), name.lower())
    return F.when(F.col("cols").isNull(), F.get("vals", F.lit(i))).when(at > 0, F.get("vals", (at - 1).cast("int")))


def read_insert_dump(spark: SparkSession, path: str, table: str, contract: TableContract,
                     record_end: str | None = ";\n", stage: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)`` rows of ``table`` from dump files.

    ``good`` has the contract's columns and types (plus ``notes``); a
    column that a statement's column list leaves out is NULL.
    ``rejected`` has ``stmt_id, tuple_idx, vals, reasons`` for tuples that
    could not be read, had the wrong arity, name an unknown column or
    failed a cast.  Every tuple of the table is in one of the two.

    With ``stage`` (default) the tuples are written once to the shared
    checkpoint folder, so the good and rejected frames (and their repeated
    use) do not read the text again.

    With ``record_end=None`` the files are read in the splits Spark gives
    them, wherever statements end: one statement of any size is read by many
    tasks, and ``;\\n`` inside a quoted value is data.  ``stmt_id`` then is
    the place in its file of the stretch that a tuple was read with, and
    ``tuple_idx`` counts in it."""

    def tokenize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []

        def frame() -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=TUPLES_SCHEMA.fieldNames()).astype(object)
            out["stmt_id"] = out["stmt_id"].astype("int64")
            out["tuple_idx"] = out["tuple_idx"].astype("Int32")
            rows.clear()
            return out

        for pdf in batches:
            for sid, text in zip(pdf["stmt_id"], pdf["text"], strict=True):
                for found in read_tuples(text, table):
                    rows.append((sid, *found))
                    if len(rows) >= CHUNK:
                        yield frame()
        if rows:
            yield frame()

    if record_end is None:
        from tabletrust.sources.dump_splits import split_tuples

        tuples, stage = split_tuples(spark, path, table), False
    else:
        tuples = read_records(spark, path, record_end).mapInPandas(tokenize, TUPLES_SCHEMA)
    if stage:
        checkpoint_dir(spark)
        tuples = tuples.checkpoint(eager=True)
    names = [c.name.lower() for c in contract.columns]
    expected = F.when(F.col("cols").isNull(), F.lit(len(names))).otherwise(F.size("cols"))
    unknown = F.coalesce(F.filter("cols", lambda c: ~F.lower(c).isin(names)), F.array().cast("array<string>"))
    arity_ok = F.size("vals") == expected
    fits = F.col("error").isNull() & arity_ok & (F.size(unknown) == 0)
    broken = tuples.where(~fits).select(
        "stmt_id", "tuple_idx", "vals",
        F.array(F.coalesce(
            F.col("error"),
            F.when(~arity_ok, F.format_string("expected %d values, got %d", expected, F.size("vals"))),
            F.concat(F.lit("unknown column "), F.array_join(unknown, ", ")))).alias("reasons"))
    text = tuples.where(fits).select("stmt_id", "tuple_idx", "vals",
                                     *[_listed(c.name, i).alias(c.name) for i, c in enumerate(contract.columns)])
    good, bad = safe_cast(text, contract)
    bad = bad.select("stmt_id", "tuple_idx", "vals", "reasons")
    return good.drop("stmt_id", "tuple_idx", "vals"), broken.unionByName(bad)


# ------------------------------------------------------------------ writer
def _sql_value(col: F.Column, dtype: T.DataType) -> F.Column:
    if isinstance(dtype, (T.StringType,)):
        esc = F.regexp_replace(col, r"\\", r"\\\\")
        esc = F.regexp_replace(esc, "'", "\\\\'")
        esc = F.regexp_replace(esc, "\n", "\\\\n")
        esc = F.regexp_replace(esc, "\r", "\\\\r")
        text = F.concat(F.lit("'"), esc, F.lit("'"))
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        whole = F.regexp_replace(F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.000000$", "")
        text = F.concat(F.lit("'"), whole, F.lit("'"))
    elif isinstance(dtype, T.DateType):
        text = F.concat(F.lit("'"), col.cast("string"), F.lit("'"))
    else:
        text = col.cast("string")
    return F.coalesce(text, F.lit("NULL"))


def write_insert_dump(df: DataFrame, path: str, table: str, tuples_per_statement: int = 500) -> None:
    """Write a DataFrame as extended-INSERT statements, at most
    ``tuples_per_statement`` tuples each, statements grouped inside each
    partition (a bounded group, never the whole table).  With one tuple
    per statement the rows stream straight to text without a shuffle."""
    tup = F.concat(F.lit("("), F.concat_ws(",", *[_sql_value(F.col(f.name), f.dataType) for f in df.schema.fields]),
                   F.lit(")"))
    head = f"INSERT INTO `{table}` VALUES "
    if tuples_per_statement == 1:  # one statement per row: no grouping, no shuffle
        df.select(F.concat(F.lit(head), tup, F.lit(";")).alias("value")).write.mode("overwrite").text(path)
        return
    local = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    chunk = F.floor(local / F.lit(tuples_per_statement))
    staged = df.select(F.spark_partition_id().alias("__p"), chunk.alias("__c"), tup.alias("__t"))
    stmts = staged.groupBy("__p", "__c").agg(F.concat_ws(",", F.collect_list("__t")).alias("__v"))
    stmts.select(F.concat(F.lit(head), F.col("__v"), F.lit(";")).alias("value")) \
        .write.mode("overwrite").text(path)


def write_statement_files(df: DataFrame, path: str, table: str) -> None:
    """Write a DataFrame as one extended-INSERT statement per file, a line
    per row, however many rows a file has: rows stream to text, nothing is
    grouped.  Newlines inside values are written as they are."""
    raw = [F.replace(_sql_value(F.col(f"`{f.name}`"), f.dataType), F.lit("\\n"), F.lit("\n")) if isinstance(f.dataType, T.StringType)
           else _sql_value(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    head = f"INSERT INTO `{table}` VALUES"

    def lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in frames:
            tuples = frame["value"].tolist()
            if not tuples:
                continue
            yield pd.DataFrame({"value": ([head] if held is None else [held + ","]) + [t + "," for t in tuples[:-1]]})
            held = tuples[-1]
        if held is not None:
            yield pd.DataFrame({"value": [held + ";"]})

    df.select(F.concat(F.lit("("), F.concat_ws(",", *raw), F.lit(")")).alias("value")).mapInPandas(lines, "value string").write.mode("overwrite").text(path)


# ------------------------------------------------------------------ S3
def full_refresh(df: DataFrame, target: str, contract: TableContract, staging: str,
                 parents: dict[str, DataFrame] | None = None) -> tuple[bool, DataFrame]:
    """Load into ``staging`` first, check the contract there, and replace
    ``target`` only when every rule was checked and none is broken (checks
    run after the load, as a dump disables them while loading).  A rule
    that could not be checked (absent column, missing parent table) keeps
    the table from being published.  Returns ``(published, report)``, the
    report materialised from the staged copy.  The staged copy stays, so a
    publish that was cut off can be repeated from it."""
    df.write.mode("overwrite").parquet(staging)
    staged = df.sparkSession.read.parquet(staging)
    report = contract_report(staged, contract, parents)
    rows = report.collect()  # one row per rule: bounded by the contract size
    report_df = df.sparkSession.createDataFrame(rows, report.schema)
    if any(r["n_violations"] != 0 for r in rows):  # NULL: not checked
        return False, report_df
    staged.write.mode("overwrite").parquet(target)
    return True, report_df

"""Small helpers the operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabletrust.session import checkpoint_dir, scratch_path

#: A word: a maximal run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder of the cluster."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and
    reread: long narrow rows take a fraction of a checkpoint's bytes."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hash60(*parts: Column | str) -> Column:
    """A 60-bit non-negative hash of the parts' text, the same in any SQL
    engine that has md5.  NULL parts count as the text ``null``."""
    text = F.concat_ws("|", *[F.coalesce((F.lit(p) if isinstance(p, str) else p).cast("string"), F.lit("null"))
                              for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def group_key(col: Column) -> Column:
    """A non-null text key that tells NULL from every value, so that
    grouping and joins treat NULL as a value of its own."""
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit("null"))


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct ``_row``, out of the way of the
    names that an operator adds."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")


def unpacked(df: DataFrame, like: DataFrame, text: str | None = None) -> DataFrame:
    """The columns of ``like`` out of ``_row``; with ``text``, the column
    of that name is the new text and ``n_chars``, if any, its length."""
    def out(c: str) -> Column:
        if text and c == "text":
            return F.col(text).alias(c)
        if text and c == "n_chars":
            return F.length(text).cast(like.schema[c].dataType).alias(c)
        return F.col(f"_row.`{c}`").alias(c)

    return df.select(*[out(c) for c in like.columns])


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Python workers get batches of at most ``rows`` texts, unless the
    session asks for fewer: long texts must fit."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


#: Keys of fixed width are broadcast up to this many (some tens of MB).
MOST_KEYS = 400_000


def with_keys(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The rows whose ``on`` columns are among ``keys`` (materialised,
    distinct, of fixed width, not NULL).  Up to MOST_KEYS of them go to all
    tasks, so that wide rows stay where they are; more are joined by a
    shuffle.  The result is the same."""
    few = keys.limit(MOST_KEYS + 1).count() <= MOST_KEYS
    return rows.join(F.broadcast(keys) if few else keys, on, "left_semi")


#: Bits of a piece of a bitmap (8 kB).
PIECE = 1 << 16


def bitmap(keyed: DataFrame, bits: int) -> np.ndarray:
    """The bitmap of 2**bits bits of the first bits of column ``key``:
    gathered as pieces that tasks put together, so it never exceeds its
    size on the way, and the driver holds no row for each of its words."""
    at = F.shiftrightunsigned("key", 64 - bits)
    words = keyed.select(F.shiftright(at, 6).alias("at"), F.expr("1L").alias("one"), at.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    words = words.groupBy("at").agg(F.bit_or(F.call_function("shiftleft", "one", "bit")).alias("bits"))
    wide = min(PIECE, 1 << bits) // 64

    def piece(rows: pa.Table) -> pa.Table:
        where, out = rows.column("at").to_numpy(), np.zeros(wide, np.int64)
        out[where % wide] = rows.column("bits").to_numpy()
        return pa.table({"piece": [int(where[0]) // wide], "data": [out.tobytes()]})

    pieces = words.groupBy(F.shiftright("at", wide.bit_length() - 1)).applyInArrow(piece, "piece long, data binary")
    out = np.zeros((1 << bits) // 64, np.int64)
    for row in pieces.collect():
        out[row["piece"] * wide: (row["piece"] + 1) * wide] = np.frombuffer(row["data"], np.int64)
    return out.view(np.uint8)

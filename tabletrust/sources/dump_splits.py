"""INSERT dumps read in splits, whatever the size of a statement.

The text source cuts the files at every ``)``, in the splits that Spark
plans, so a split starts behind some ``)`` and one statement of many
gigabytes is many splits.  Whether such a place lies in a value, in a
comment or between two tuples depends on all the text before it, so:

1. every split is scanned once for each lexical state that it may start in
   (plain, in one of three quotes, in one of two comments; most of these
   runs soon agree): the state it ends in, and how the last statement that
   starts in it opens;
2. the splits of a file are chained in order, one small row each: the first
   starts plain, each next one as the one before it ended, and with the
   statement that is open there;
3. every split reads its tuples, from its first boundary between two tuples
   to its last.  What lies between the last boundary of one split and the
   first of the next one (usually nothing) is put together and read then.

Only the chained rows, one per split, as many as the driver plans for the
scan, go to all tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabletrust.session import checkpoint_dir
from tabletrust.sources.dump import _BLANK, _HEAD, CHUNK, read_tuples

#: The states: plain, the quotes, a comment to the end of its line, a block comment.
PLAIN, STATES = "n", "n'\"`-/"
_OPEN = re.compile(rb"['\"`;]|--|#|/\*|\)(?=\s*+,\s*+\()")
_CLOSE = {"'": re.compile(rb"(?:[^'\\]++|\\.|'')*+'", re.S), '"': re.compile(rb'(?:[^"\\]++|\\.|"")*+"', re.S),
          "`": re.compile(rb"[^`]*+`"), "-": re.compile(rb"[^\n]*+\n"), "/": re.compile(rb".*?\*/", re.S)}
#: A split that starts like this, and plain, starts between two tuples.
_NEXT_TUPLE = re.compile(rb"\s*+(?:,\s*+\(|;|$)")
_AFTER = re.compile(rb"\s*+,\s*+")
#: The longest opening of a statement, up to its VALUES.
OPENING = 1 << 20
_VALUES = re.compile(rb"\bVALUES?\b\s*", re.I)

_SCANNED = "file long, split long, bytes long, size long, clean boolean, first binary, ends string, opens array<binary>"
_CHAINED = "file long, split long, state string, opening string, clean boolean, next_clean boolean, cut_last boolean"
_READ = "stmt_id long, tuple_idx int, cols array<string>, vals array<string>, error string, file long, split long, part int, opening string, text string"


def runs(text: bytes, state: str) -> tuple[str, int | None, int | None, int | None]:
    """(state at the end, behind the last plain ``;``, behind the first and
    the last boundary of two tuples) of a text that starts in a state."""
    at, last, first_cut, last_cut = 0, None, None, None
    while True:
        if state != PLAIN:
            m = _CLOSE[state].match(text, at)
            if not m:
                return state, last, first_cut, last_cut
            at, state = m.end(), PLAIN
        m = _OPEN.search(text, at)
        if not m:
            return state, last, first_cut, last_cut
        what, at = m[0], m.end()
        if what == b";":
            last = at
        elif what == b")":
            at = _AFTER.match(text, at).end()
        else:
            state = {b"--": "-", b"#": "-", b"/*": "/"}.get(what) or what.decode()
            continue
        first_cut, last_cut = at if first_cut is None else first_cut, at


def _records(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("lineSep", ")").text(path)
    return raw.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                      F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("value"))


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, bytes]]:
    """(file, split, file size, text) in order; a split comes in stretches."""
    for batch in batches:
        files, splits, sizes = (batch.column(c).to_pylist() for c in ("file", "split", "size"))
        values = batch.column("value").to_pylist()
        at = 0
        for i in range(1, len(files) + 1):
            if i == len(files) or (files[i], splits[i]) != (files[at], splits[at]):
                yield files[at], splits[at], sizes[at], b")".join(values[at:i]) + b")"
                at = i


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def row() -> pa.RecordBatch:
        starts = [PLAIN if s is None else s for s in STATES]
        return pa.RecordBatch.from_arrays([
            pa.array([key[0]]), pa.array([key[1]]), pa.array([total]), pa.array([size]), pa.array([bool(_NEXT_TUPLE.match(first))]),
            pa.array([first[: m.end()] if (m := _VALUES.search(first)) else b"" if key[1] else first], pa.binary()),
            pa.array(["".join(now[s] for s in starts)]), pa.array([[opens[s] for s in starts]], pa.list_(pa.binary()))],
            names=["file", "split", "bytes", "size", "clean", "first", "ends", "opens"])

    key, size, total, first, now, opens = None, 0, 0, b"", {}, {}
    for file, split, file_size, text in _by_split(batches):
        if (file, split) != key:
            if key is not None:
                yield row()
            key, size, total, first = (file, split), file_size, 0, b""
            now, opens = {s: s for s in STATES}, dict.fromkeys(STATES)
        total += len(text)
        if len(first) < OPENING:
            first += text[: OPENING - len(first)]
        done = {s: runs(text, s) for s in set(now.values())}
        for s in STATES:
            state, last, _, _ = done[now[s]]
            if last is not None:
                opens[s] = text[last: last + OPENING]
            elif opens[s] is not None and len(opens[s]) < OPENING:
                opens[s] += text[: OPENING - len(opens[s])]
            now[s] = state
    if key is not None:
        yield row()


def _prefix(opening: str, table: str) -> str:
    """What makes a stretch from the middle of a statement, which opens like
    this, readable by itself."""
    start = _BLANK.match(opening).end()
    if start == len(opening):
        return ""  # no statement is open
    m = _HEAD.match(opening, start)
    return opening[start: m.end()] if m and m[1].lower() == table.lower() else "OTHER "


def _chained(table: str):
    """How each split of a file starts."""

    def chain(some: pd.DataFrame) -> pd.DataFrame:
        some = some.sort_values("split").reset_index(drop=True)
        state, opening, out = PLAIN, "", []
        for i, r in enumerate(some.itertuples(index=False)):
            if i and len(opening) < OPENING and not _HEAD.match(opening, _BLANK.match(opening).end()):
                # The statement that opened before may get its VALUES here.
                opening += bytes(r.first).decode("utf-8", "replace")
            # A file starts with a boundary; a later split if it is plain there and a tuple follows.
            out.append([r.file, r.split, state, _prefix(opening, table), i == 0 or (state == PLAIN and bool(r.clean)), False, False])
            which = STATES.index(state)
            if r.opens[which] is not None:
                opening = bytes(r.opens[which]).decode("utf-8", "replace")
            elif not i:  # the first statement is still open
                opening = bytes(r.first).decode("utf-8", "replace")
            state = r.ends[which]
        for here, after in zip(out, out[1:], strict=False):
            here[5] = after[4]
        out[-1][5] = True
        # The last text had no ``)`` behind it, unless all of the file is accounted for (a byte order mark is not read).
        out[-1][6] = int(some["bytes"].sum()) - int(some["size"].iloc[0]) not in (0, -3)
        return pd.DataFrame(out, columns=[c.split()[0] for c in _CHAINED.split(", ")])

    return chain


def split_tuples(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The tuples of ``table`` in the dump files at ``path``: ``stmt_id``
    (about where in its file the stretch starts), ``tuple_idx``, ``cols``, ``vals``, ``error`` as the reader by records
    gives them, materialised in the checkpoint folder.

    An unbalanced quote reaches to the next quote, as it would for the
    database; a file is taken as UTF-8.  The files must not change meanwhile.
    """
    checkpoint_dir(spark)
    records = _records(spark, path)
    chained = records.mapInArrow(_scan, _SCANNED).groupBy("file").applyInPandas(_chained(table), _CHAINED)
    plan = spark.sparkContext.broadcast({(r["file"], r["split"]): tuple(r)[2:] for r in chained.collect()})  # one row per split

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        schema = pa.schema([("stmt_id", pa.int64()), ("tuple_idx", pa.int32()), ("cols", pa.list_(pa.string())), ("vals", pa.list_(pa.string())), ("error", pa.string()),
                            ("file", pa.int64()), ("split", pa.int64()), ("part", pa.int32()), ("opening", pa.string()), ("text", pa.string())])

        def handed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
            rows.clear()
            return out

        key, place, carry, state, prefix, cut_yet = None, 0, b"", PLAIN, "", False

        def tuples(text: bytes) -> Iterator[pa.RecordBatch]:
            for found in read_tuples(prefix + text.decode("utf-8", "replace"), table):
                rows.append((place, *found, None, None, None, None, None))
                if len(rows) >= CHUNK:
                    yield handed()

        def rest() -> Iterator[pa.RecordBatch]:
            """What the split has behind its last boundary."""
            _, _, _, next_clean, cut_last = plan.value[key]
            text = carry[:-1] if cut_last else carry
            if cut_yet and next_clean:
                yield from tuples(text)
            else:  # part 0: no boundary in the whole split; 1: behind the last one
                rows.append((place, None, None, None, None, *key, int(cut_yet), prefix, text.decode("utf-8", "replace")))

        for file, split, _, text in _by_split(batches):
            if (file, split) != key:
                if key is not None:
                    yield from rest()
                key = file, split
                if key not in plan.value:
                    raise RuntimeError("the splits changed between two scans; set spark.sql.files.minPartitionNum")
                state, prefix, cut_yet = plan.value[key][:3]
                place, carry = split, b""
                if cut_yet and prefix and (m := _AFTER.match(text)):
                    text = text[m.end():]
            state, last, first_cut, last_cut = runs(text, state)
            if last_cut is None:
                carry += text
                continue
            if not cut_yet:
                # Up to the first boundary it belongs to the split before.
                rows.append((place, None, None, None, None, *key, -1, prefix, (carry + text[:first_cut]).decode("utf-8", "replace")))
                place += len(carry) + first_cut
                if text[first_cut - 1: first_cut] == b";":
                    prefix = ""
                cut_yet, piece = True, text[first_cut:last_cut]
            else:
                piece = carry + text[:last_cut]
            yield from tuples(piece)
            place += len(piece)
            carry = text[last_cut:]
            if last is not None and last >= (first_cut or 0):
                prefix = _prefix(text[last:last_cut].decode("utf-8", "replace"), table)
            elif not prefix:  # the statement opened in this piece
                prefix = _prefix(piece.decode("utf-8", "replace"), table)
        if key is not None:
            yield from rest()
        if rows:
            yield handed()

    found = records.mapInArrow(read, _READ).checkpoint(eager=True)
    whole = found.where(F.col("part").isNull()).select("stmt_id", "tuple_idx", "cols", "vals", "error")
    # Pieces between two boundaries: from the end of a split over whole ones to the start of another.
    pieces = found.where(F.col("part").isNotNull())
    order = Window.partitionBy("file").orderBy("split", "part")
    pieces = pieces.withColumn("owner", F.count_if(F.col("part") == 1).over(order))
    joined = pieces.groupBy("file", "owner").agg(
        F.min("stmt_id").alias("stmt_id"), F.min_by("opening", F.struct("split", "part")).alias("opening"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("split", "part", "text"))), lambda p: p["text"]), "").alias("text"))

    def put_together(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["stmt_id", "tuple_idx", "cols", "vals", "error"]
        for some in frames:
            out = [(i, *t) for i, opening, text in zip(some["stmt_id"], some["opening"], some["text"], strict=True) for t in read_tuples(opening + text, table)]
            frame = pd.DataFrame(out, columns=names).astype(object)
            frame["stmt_id"], frame["tuple_idx"] = frame["stmt_id"].astype("int64"), frame["tuple_idx"].astype("Int32")
            yield frame

    stitched = joined.select("stmt_id", "opening", "text").mapInPandas(put_together, "stmt_id long, tuple_idx int, cols array<string>, vals array<string>, error string")
    return whole.unionByName(stitched)

"""Verified links between the members of shared buckets.

Candidate generation by bands or blocks puts each item into several
buckets; two items are candidates when they share one.  A bucket may hold a
third of all items, and a pair may share many buckets, so pairs are never
written out as rows.  Instead:

1. buckets are counted; buckets of one go.  Where a bucket is a band and
   32 bits, members are packed for that: a few bytes for each of theirs;
2. a bucket of more than ``chunk`` members is cut into chunks by hash, and
   every two chunks meet in a block of its own, so each task sees at most
   ``2 * chunk`` members of a bucket at a time;
3. a first pass compares only signatures and keeps, per block, the members
   of a pair whose *first* shared bucket this is: each pair is looked at
   once, and the wide payloads travel to the blocks that need them only;
4. a second pass verifies those pairs on the payloads and gives, per block
   and linked member, its number of links and a spanning edge.  No link is
   lost and rows grow with members, not with pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabletrust.llm.common import cut_lineage, staged

BLOCK = ["bucket", "left", "right"]
#: Pairs of signatures are compared so many at a time.
PAIRS = 1 << 18
#: Rows whose pairs are verified at a time, at most, and bytes of payloads.
ROWS, BYTES = 1 << 13, 1 << 22
#: Members of buckets that a task packs together, and that a row takes.
HELD, PACKED = 1 << 21, 1 << 12


def narrow(a: np.ndarray) -> bytes:
    """Unsigned 64-bit numbers in as few bytes each as the largest needs:
    all first bytes, then all second ones and so on."""
    wide = max(1, (int(a.max()).bit_length() + 7) // 8)
    return a.astype("<u8").view(np.uint8).reshape(len(a), 8).T[:wide].tobytes()


def widened(data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of :func:`narrow`."""
    planes = np.frombuffer(data, np.uint8).reshape(-1, n)
    out = np.zeros((n, 8), np.uint8)
    out[:, : len(planes)] = planes.T
    return out.reshape(-1).view("<u8")


def shared_buckets(members: DataFrame) -> DataFrame:
    """(``id``, ``bucket``, ``n``): each member's buckets that others are in
    too, with their numbers of members.  ``members``: (``buckets`` array of
    longs, ``id`` long); a bucket is ``band << 32`` plus a 32-bit key.

    A slot is a range of buckets.  A row of the shuffle holds some members
    of a slot: the steps between their buckets, ascending, and their ids
    above the least.  A task counts one slot at a time and holds a few
    bytes for each of its members.
    """
    bits = min(20, max(4, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")).bit_length() - 1))
    below = 32 - bits

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def rows() -> pa.RecordBatch:
            bucket, name = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            order = np.argsort(bucket, kind="stable")
            bucket, name = bucket[order], name[order]
            slot = bucket >> below
            starts = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
            spans = [(a, min(a + PACKED, hi)) for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(slot)], strict=True) for a in range(lo, hi, PACKED)]
            least = [int(name[a:b].min()) for a, b in spans]
            low = (bucket & ((1 << below) - 1)).astype(np.uint64)
            return pa.RecordBatch.from_arrays([
                pa.array([int(slot[a]) for a, _ in spans], pa.int64()), pa.array([b - a for a, b in spans], pa.int32()), pa.array(least, pa.int64()),
                pa.array([narrow(np.diff(low[a:b], prepend=np.uint64(0))) for a, b in spans], pa.binary()),
                pa.array([narrow((name[a:b] - m).astype(np.uint64)) for (a, b), m in zip(spans, least, strict=True)], pa.binary())], names=["slot", "members", "least", "keys", "ids"])

        size = 0
        for batch in batches:
            lists = batch.column("buckets")
            bucket = lists.flatten().to_numpy(zero_copy_only=False)
            held.append((bucket, np.repeat(batch.column("id").to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False))))
            size += len(bucket)
            if size > HELD:
                yield rows()
                size = 0
        if size:
            yield rows()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shared(slot: int, rows: list[tuple[np.ndarray, int, bytes]]) -> Iterator[pa.RecordBatch]:
            keys, n, new, size = np.empty(0, np.uint32), np.empty(0, np.int64), [], 0
            for i, (some, _, _) in enumerate(rows, 1):
                new.append(some)
                size += len(some)
                if size > HELD or i == len(rows):
                    more, times = np.unique(np.concatenate(new), return_counts=True)
                    keys, at = np.unique(np.r_[keys, more], return_inverse=True)
                    n = np.bincount(at, weights=np.r_[n, times], minlength=len(keys)).astype(np.int64)
                    new, size = [], 0
            keys, n = keys[n > 1], n[n > 1]
            if not len(keys):
                return
            for lo in range(0, len(rows), 64):
                out = []
                for some, least, ids in rows[lo: lo + 64]:
                    at = np.minimum(np.searchsorted(keys, some), len(keys) - 1)
                    mine = keys[at] == some
                    if mine.any():
                        out.append((widened(ids, len(some))[mine].astype(np.int64) + least, some[mine].astype(np.int64) + (slot << below), n[at[mine]]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["id", "bucket", "n"])

        last, rows = None, []
        for batch in batches:
            for slot, members, least, keys, ids in zip(*[batch.column(c).to_pylist() for c in ("slot", "members", "least", "keys", "ids")], strict=True):
                if slot != last and rows:
                    yield from shared(last, rows)
                    rows = []
                last = slot
                rows.append((np.cumsum(widened(keys, members)).astype(np.uint32), least, ids))
        if rows:
            yield from shared(last, rows)

    packed = members.select("buckets", "id").mapInArrow(pack, "slot long, members int, least long, keys binary, ids binary")
    return packed.repartition("slot").sortWithinPartitions("slot").mapInArrow(count, "id long, bucket long, n long")


def together(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The frames, some at a time: up to ROWS rows or BYTES of payloads
    and a frame."""
    held, rows, size = [], 0, 0
    for frame in frames:
        held.append(frame)
        rows, size = rows + len(frame), size + int(frame["payload"].map(len).sum())
        if rows >= ROWS or size >= BYTES:
            yield pd.concat(held, ignore_index=True)
            held, rows, size = [], 0, 0
    if held:
        yield pd.concat(held, ignore_index=True)


def runs(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    """(frame, starts of its blocks and its end) with whole blocks only, of
    frames sorted by block."""
    rest = None
    for frame in frames:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        if not len(frame):
            continue
        key = frame[BLOCK].to_numpy()
        starts = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
        rest = frame.iloc[starts[-1]:].reset_index(drop=True)
        if len(starts) > 1:
            yield frame, starts
    if rest is not None and len(rest):
        yield rest, np.array([0, len(rest)])


def all_pairs(starts: np.ndarray) -> Iterator[np.ndarray]:
    """All pairs (i < j) of rows of the same block, in slices."""
    sizes = np.diff(starts)
    for m in np.unique(sizes[sizes > 1]):
        inside = np.stack(np.triu_indices(m, 1), axis=1)
        at = starts[:-1][sizes == m]
        step = max(1, PAIRS // len(inside))
        for lo in range(0, len(at), step):
            yield (at[lo: lo + step, None, None] + inside[None]).reshape(-1, 2)


def keys_by_band(shared: list[np.ndarray]) -> np.ndarray:
    """A column for each band with the rows' buckets; where a row has none,
    a number that no other row has."""
    flat = np.concatenate(shared)
    keys = np.repeat(-1 - np.arange(len(shared))[:, None], 1 + int(flat.max() >> 32), axis=1)
    keys[np.repeat(np.arange(len(shared)), list(map(len, shared))), flat >> 32] = flat
    return keys


def candidates(frame: pd.DataFrame, starts: np.ndarray, buckets: Callable | None, near: Callable | None) -> np.ndarray:
    """The pairs of rows of each block whose first shared bucket it is."""
    if buckets is None:
        keys, sigs = keys_by_band(frame["sig"].tolist()), frame["id"].to_numpy()
    else:
        width = max(map(len, frame["sig"]))
        sigs = np.frombuffer(b"".join([s.ljust(width, b"\0") for s in frame["sig"]]), np.uint64).reshape(len(frame), -1)
        keys = buckets(sigs)
    own, part = frame["bucket"].to_numpy(), frame["part"].to_numpy()
    cross = (frame["left"] != frame["right"]).to_numpy()
    out = [np.empty((0, 2), np.int64)]
    for pairs in all_pairs(starts):
        i, j = pairs.T
        pairs = pairs[~cross[i] | (part[i] != part[j])]
        i, j = pairs.T
        first = (keys[i] == keys[j]).argmax(axis=1)
        mine = keys[i, first] == own[i]
        if near is not None:
            mine &= near(sigs[i], sigs[j])
        out.append(pairs[mine])
    return np.concatenate(out)


def links(members: DataFrame, sigs: DataFrame | None, payloads: Callable[[DataFrame], DataFrame], buckets: Callable | None, verify: Callable | None,
          near: Callable | None = None, chunk: int = 192, before: Callable | None = None) -> DataFrame:
    """Verified links: (``id``, ``links``, ``other``), one row per block and
    linked member: how many of its links were found there, and a member
    that the block connects it with (NULL for the block's root).

    ``members``: (``bucket`` long, ``id``), or (``buckets`` array of longs,
    ``id``) if ``sigs`` is None, without repeats; ``sigs``:
    (``id``, ``sig`` binary of unsigned 64-bit words; shorter ones are filled
    with zeros), one row per id;
    ``buckets(sigs)``: a signature's buckets, one column for each band.
    Both may be None if a bucket is ``band << 32`` plus a 32-bit key and ids
    are longs: then members carry the buckets that they share, and nothing
    else.
    ``near(a, b)``, if given, says which pairs of signatures, or of ids
    where there are none, are candidates at all.  ``payloads(ids)`` gives (``id``, ``payload``), one row for each
    row of ``ids``.  ``verify(payloads, pairs)`` yields the index pairs that
    are links; it may leave out pairs that those it gave connect already,
    if numbers of links do not matter.  ``before(payloads, pairs)``, if
    given, sees those of many blocks at once and returns the payloads that
    ``verify`` gets and the pairs that may be links; that are links, if
    ``verify`` is None.
    """
    id_type = members.schema["id"].dataType
    if sigs is not None:
        counts = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        shared = members.join(counts, "bucket").join(sigs, "id")
    else:
        # As many as there are bands at most.
        shared = shared_buckets(members if "buckets" in members.columns else members.select(F.array("bucket").alias("buckets"), "id"))
        own = shared.groupBy("id").agg(F.collect_list(F.struct("bucket", "n")).alias("own"))
        shared = own.select("id", F.col("own.bucket").alias("sig"), F.explode("own").alias("at")).select("id", "sig", "at.bucket", "at.n")
    chunks = F.ceil(F.col("n") / F.lit(chunk)).cast("int")
    blocks = (
        shared.withColumn("part", F.pmod(F.xxhash64("id"), chunks).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), chunks - 1)))
        .select("bucket", F.least("part", "with").alias("left"), F.greatest("part", "with").alias("right"), "part", "id", "sig")
    )

    def needed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts in runs(frames):
            yield frame.iloc[np.unique(candidates(frame, starts, buckets, near))]

    def verified(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame, starts in runs(frames if before is None else together(frames)):
            ids, found, others = [], [], []
            pairs, payload = candidates(frame, starts, buckets, near), list(frame["payload"])
            if before is not None:
                payload, pairs = before(payload, pairs)
            block = np.searchsorted(starts, pairs[:, 0], side="right") - 1
            order = np.argsort(block, kind="stable")
            pairs, block = pairs[order], block[order]
            name = frame["id"].to_numpy()
            cuts = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True]) if len(pairs) else np.empty(0, np.int64)
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                lo, hi = starts[block[a]], starts[block[a] + 1]
                root, degree = list(range(hi - lo)), [0] * (hi - lo)
                for i, j in (pairs[a:b] - lo).tolist() if verify is None else verify(payload[lo:hi], pairs[a:b] - lo):
                    degree[i] += 1
                    degree[j] += 1
                    i, j = find(root, i), find(root, j)
                    root[max(i, j)] = min(i, j)
                for i, d in enumerate(degree):
                    if d:
                        up = find(root, i)
                        ids.append(name[lo + i])
                        found.append(d)
                        others.append(None if up == i else name[lo + up])
            if ids:
                yield pd.DataFrame({"id": ids, "links": found, "other": others})

    def by_block(df: DataFrame) -> DataFrame:
        # By id within a block: its roots are the smallest ids.
        return df.repartition(*BLOCK).sortWithinPartitions(*BLOCK, "id")

    wanted = staged(by_block(blocks).mapInPandas(needed, blocks.schema), "pairs")
    out = T.StructType([T.StructField("id", id_type), T.StructField("links", T.LongType()), T.StructField("other", id_type)])
    found = payloads(wanted.select("id").distinct())
    return by_block(wanted.join(found, "id")).mapInPandas(verified, out)


def spanning(found: DataFrame) -> DataFrame:
    """Edges (``id``, ``other``) that connect what the rows of :func:`links`
    connect.  A member of many blocks has a root in each: it keeps the
    smallest, and its other roots, which a group's members share, are tied
    to that one.  So the edges of a group grow with its members, not with
    its blocks."""
    # Cut off: it is read twice, and pairs are verified to compute it.
    roots = cut_lineage(found.where(F.col("other").isNotNull()).groupBy("id").agg(F.min("other").alias("least"), F.collect_set("other").alias("roots")))
    tied = roots.select(F.explode("roots").alias("id"), F.col("least").alias("other")).where(F.col("id") != F.col("other")).distinct()
    return roots.select("id", F.col("least").alias("other")).union(tied)


def find(root: list[int], i: int) -> int:
    """The root of ``i``, with its path halved."""
    while root[i] != i:
        root[i] = root[root[i]]
        i = root[i]
    return i

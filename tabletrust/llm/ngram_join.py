"""Near-duplicate join on word n-gram Jaccard similarity by MinHash banding.

Equal texts are one class and take part once.  Every class signs its
n-gram set with MinHash; signatures are cut into bands, the numbers of
bands and of rows in a band chosen for a target recall at the threshold.
Classes that share a band are verified on their full n-gram sets
(``pairs``), so there are no false links, and a link is missed only with
the chosen probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabletrust.llm.common import cut_lineage, packed, small_batches, unpacked, with_keys
from tabletrust.llm.components import components
from tabletrust.llm.pairs import links, spanning
from tabletrust.llm.shingles import min_hashes, mixed, ngram_set


def banding(threshold: float, recall: float, hashes: int) -> tuple[int, int]:
    """(bands, rows): the most rows in a band, and with them the fewest
    false candidates, such that a pair at the threshold shares a band with
    at least the probability ``recall`` within ``hashes`` hashes."""
    best = None
    for rows in range(1, hashes + 1):
        p = threshold**rows
        bands = 1 if p >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-p)) if p > 1e-12 else hashes + 1
        if bands * rows <= hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError(f"{hashes} hashes cannot reach a recall of {recall} at {threshold}")
    return best


def text_key(text: Column) -> Column:
    """The class of a text: its MD5.  NULL counts as the empty text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def ngram_links(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.999, hashes: int = 144,
                seed: int = 11, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text_key``, ``text_id``
    (smallest doc_id with an equal text), ``n_copies`` (rows with an equal
    text), ``n_links`` (different texts linked with this one), ``class_id``
    (smallest doc_id of all texts connected by links) and ``class_key``
    (the text_key of that document).

    NULL and empty texts are one class without links; a text of fewer than
    ``n`` words has one gram.  NULL doc_ids do not name a class unless it
    has no other.  Repeated rows are copies.  No rows give no rows.
    """
    small_batches(docs.sparkSession)
    bands, rows = banding(threshold, recall, hashes)
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    b = rng.integers(0, 1 << 32, bands * rows, dtype=np.uint32)
    weights = rng.integers(1, 1 << 62, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def sign(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in texts:
            out = []
            for t in some:
                grams = ngram_set(t, n)
                if not len(grams):
                    out.append(None)
                    continue
                sig = min_hashes(grams, a, b).reshape(bands, rows).astype(np.uint64)
                out.append(mixed((sig * weights).sum(axis=1, dtype=np.uint64) + np.arange(bands, dtype=np.uint64)).tobytes())
            yield pd.Series(out, dtype=object)

    signer = F.pandas_udf(sign, "binary")
    signed = cut_lineage(docs.select(F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("id"), signer(F.col(text)).alias("sig")))
    classes = signed.groupBy("id").agg(F.min("doc_id").alias("text_id"), F.count(F.lit(1)).alias("n_copies"), F.first("sig").alias("sig"))
    sigs = classes.where(F.col("sig").isNotNull()).select("id", "sig")
    word = F.substring(F.col("sig"), F.col("band") * 8 + 1, F.lit(8))
    members = sigs.withColumn("band", F.explode(F.sequence(F.lit(0), F.lit(bands - 1)))).select(
        F.conv(F.hex(word), 16, -10).cast("bigint").alias("bucket"), "id")

    def buckets(s: np.ndarray) -> np.ndarray:
        return s.byteswap().view(np.int64)  # a bucket is the word read byte by byte

    def verify(payloads: list, pairs: np.ndarray) -> Iterator[tuple[int, int]]:
        sets = [ngram_set(t, n) for t in payloads]
        sizes = np.array([len(s) for s in sets])
        both = overlaps(sets, pairs)
        i, j = pairs[:, 0], pairs[:, 1]
        for p in np.flatnonzero(both >= threshold * (sizes[i] + sizes[j] - both) - 1e-9):
            yield int(i[p]), int(j[p])

    def payloads(ids: DataFrame) -> DataFrame:
        # One row per class: that of its smallest doc_id.
        chosen = cut_lineage(classes.select("id", "text_id").join(ids, "id"))
        texts = docs.select(text_key(F.col(text)).alias("id"), F.col(doc_id).alias("_doc"), F.col(text).alias("payload"))
        same = with_keys(texts, chosen.select("id"), ["id"]).join(chosen, "id").where(F.col("_doc").eqNullSafe(F.col("text_id")))
        return same.select("id", "payload").dropDuplicates(["id"])

    found = cut_lineage(links(members, sigs, payloads, buckets, verify))
    groups = components(spanning(found), "id", "other")
    degrees = found.groupBy("id").agg(F.sum("links").alias("n_links"))
    named = (
        classes.select("id", "text_id", "n_copies").join(degrees, "id", "left").join(groups, "id", "left")
        .withColumn("root", F.coalesce("root", "id"))
    )
    # Cut off, so that the join with a large group's texts can be split.
    named = cut_lineage(named)
    first = cut_lineage(named.groupBy("root").agg(F.min(F.struct(F.col("text_id").isNull(), "text_id", "id")).alias("kept")))
    return (
        signed.select("doc_id", "id").join(named.join(first, "root"), "id")
        .select("doc_id", F.col("id").alias("text_key"), "text_id", "n_copies", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                F.col("kept.text_id").alias("class_id"), F.col("kept.id").alias("class_key"))
    )


def overlaps(sets: list[np.ndarray], pairs: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the paired sets."""
    if len(pairs) <= 4 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in pairs], np.int64)
    # Many pairs: count common members of all at once, column block by
    # column block.
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    grams, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    for at in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(column, (at, at + width))
        dense = np.zeros((len(sets), width), np.float32)
        dense[owner[lo:hi], column[lo:hi] - at] = 1
        both += dense @ dense.T
    return both[pairs[:, 0], pairs[:, 1]].astype(np.int64)


def one_per_class(docs: DataFrame, **params) -> DataFrame:
    """``docs`` with one row of each class: that of the smallest doc_id.
    Rows that repeat its doc_id and text count as that row."""
    classes = ngram_links(docs, **params)
    kept = classes.select(F.col("class_key").alias("_key"), F.col("class_id").alias("_doc")).distinct()
    rows = docs.select(packed(docs), text_key(F.col("text")).alias("_key"), F.col("doc_id").alias("_id"))
    chosen = rows.join(kept, "_key").where(F.col("_id").eqNullSafe(F.col("_doc")))
    return unpacked(chosen.dropDuplicates(["_key"]), docs)

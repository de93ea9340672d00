"""Phrase collocation mining after Toivonen.

A sample proposes: words, then phrases one word longer at a time, that are
frequent in the sample at a lowered threshold.  A full pass over all
documents counts what was proposed and its negative border: the phrases that
were not proposed although both of their parts that are one word shorter
were.  Border phrases that turn out frequent were missed, and so were the
longer ones that they open: they join the proposals, and a further pass
counts those.  The mining is closed when no border phrase is frequent.

Proposed phrases are counted by their words.  The border, which is most of
the work and hardly ever frequent, is counted by keys of 34 bits or more; phrases that
share a key only make it look more frequent, and a key that reaches the
threshold is counted by its words in the next pass.  So the numbers of the
result are exact whatever the sample was.  Proposals travel as bitmaps of a
fixed size, set by their keys: a phrase whose bit is set by another is
counted for nothing, and nothing is lost.

Tasks work on stretches of text in numpy.  What they count goes to buckets
by key, as arrays, and the buckets are summed one by one: no task holds more
than its dictionaries of bounded size and one bucket.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabletrust.llm.common import bitmap, cut_lineage, small_batches
from tabletrust.llm.shingles import mixed, span_hashes

#: Lower-cases A-Z, makes every end of a piece a line feed and a tab a space.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?\n\v\f\r" else 32 if c == 9 else c for c in range(256))
#: Bytes of text that a task looks at together.
STRETCH = 1 << 20
#: Keys of border phrases, and named phrases, that a task holds.
HELD, HELD_NAMES = 1 << 21, 300_000
#: Bits of a border key that follow its bucket's: with 10 or more of those
#: they tell 2**34 keys apart, and steps between them take two bytes.
BORDER = 24
#: Named phrases have 2**WIDER times fewer buckets.
WIDER = 3
#: Phrases with a longer word are compared as text: hashes of sums of powers are weak there.
LONG_WORD = 64
#: What a byte adds to the sum that phrases of one key must share.
_ADDS = np.random.default_rng(13).integers(0, 1 << 63, 256, dtype=np.uint64)
_ADDS[32] = 0
_TIMES = np.uint64(0x9E3779B97F4A7C15)
_SENT = "words int, bucket int, lang string, names binary, keys binary, counts binary"
_SUMS = "lang string, words int, phrase string, key long, n long"


def stretches(text: bytes, longest: int) -> Iterator[tuple[bytes, int]]:
    """(part of the text, where in it the phrases of the next part start):
    parts end at ends of pieces or, inside a long piece, between words, and
    then have so many more words that every phrase is whole in one part."""
    at = 0
    more = re.compile(rb" *+(?:[^ \n]++ *+){0,%d}" % (longest - 1))
    while len(text) - at > STRETCH:
        cut = text.rfind(b"\n", at, at + STRETCH)
        if cut < at:
            cut = text.rfind(b" ", at, at + STRETCH)
        if cut < at:
            found = re.compile(rb"[ \n]").search(text, at + STRETCH)
            cut = found.start() if found else len(text)
        end = more.match(text, cut).end() if text[cut: cut + 1] == b" " else cut
        yield text[at:end], cut - at
        at = cut
    yield text[at:], len(text) - at


def _bits(bitmap: np.ndarray | None, keys: np.ndarray) -> np.ndarray:
    if bitmap is None:
        return np.zeros(len(keys), bool)
    at = keys >> np.uint64(64 - (len(bitmap).bit_length() + 2))
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def _chained(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Keys of phrases one word longer."""
    return mixed(keys[:-1] * _TIMES + words[len(words) - len(keys) + 1:])


def _steps(keys: np.ndarray, bits: int, more: int = 32) -> bytes:
    """Ascending keys that share their first ``bits`` bits: the steps
    between the ``more`` bits that follow those, 4 bytes a key."""
    low = ((keys << np.uint64(bits)) >> np.uint64(64 - more)).astype(np.uint32)
    return _planes(np.diff(low, prepend=np.uint32(0)))


def _from_steps(data: np.ndarray, bucket: int, bits: int, more: int = 32) -> np.ndarray:
    """The keys of a bucket, without the bits that were not sent."""
    low = np.cumsum(_from_planes(data, np.uint32), dtype=np.uint64)
    return (np.uint64(bucket) << np.uint64(64 - bits)) | (low << np.uint64(64 - more - bits))


def _planes(a: np.ndarray) -> bytes:
    """The numbers' first bytes, then their second ones and so on: shuffle
    files are compressed, and the high bytes of small numbers are equal."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes()


def _from_planes(data: np.ndarray, dtype: type) -> np.ndarray:
    return np.ascontiguousarray(data.reshape(np.dtype(dtype).itemsize, -1).T).reshape(-1).view(dtype)


class Words:
    """The words of a stretch of text and the keys of its phrases."""

    def __init__(self, text: bytes, own: int, salt: np.uint64):
        self.text, self.data = text, np.frombuffer(text, np.uint8)
        apart = (self.data == 32) | (self.data == 10)
        ends = np.flatnonzero(apart)
        starts, ends = np.r_[0, ends + 1], np.r_[ends, len(text)]
        real = ends > starts
        # Between two words of a piece there are blanks alone.
        line_ends = np.flatnonzero(self.data == 10)
        self.starts, self.ends = starts[real], ends[real]
        self.own = int(np.searchsorted(self.starts, own))
        piece = np.searchsorted(line_ends, self.starts)
        self.joined = piece[1:] == piece[:-1]
        self.keys = mixed(span_hashes(self.data, self.starts, self.ends) + salt)

    @cached_property
    def sums(self) -> np.ndarray:
        out = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_ADDS[self.data], out=out[1:])
        return out

    @cached_property
    def long(self) -> np.ndarray:
        return np.r_[0, np.cumsum(self.ends - self.starts > LONG_WORD)]

    def named(self, at: np.ndarray, m: int, keys: np.ndarray) -> Iterator[tuple[bytes, int, int]]:
        """(phrase, key, count) of the phrases of ``m`` words at ``at``."""
        lo, hi, text = self.starts[at], self.ends[at + m - 1], self.text
        key, first, which, n = np.unique(keys[at], return_index=True, return_inverse=True, return_counts=True)
        check = self.sums[hi] - self.sums[lo]
        if (check != check[first][which]).any() or (self.long[at + m] > self.long[at]).any():
            counts = Counter((b" ".join(text[a:b].split()), k) for a, b, k in zip(lo.tolist(), hi.tolist(), keys[at].tolist(), strict=True))
            return ((p, k, c) for (p, k), c in counts.items())
        spans = zip(lo[first].tolist(), hi[first].tolist(), strict=True)
        names = (text[a:b] for a, b in spans) if m == 1 else (b" ".join(text[a:b].split()) for a, b in spans)
        return zip(names, key.tolist(), n.tolist(), strict=True)


def _counted(docs: DataFrame, levels: range, now: dict[int, np.ndarray], before: dict[int, np.ndarray], named: bool, least: int) -> DataFrame:
    """(``lang``, ``words``, ``phrase``, ``key``, ``n``): the phrases of
    ``levels`` words that ``now`` proposes, and those of the border with a
    NULL phrase, if they occur ``least`` times or more, but for those that
    ``before`` had so already; with ``words`` 0 the number of words of each
    language.  All words count as proposed.  Without ``named`` no phrase
    gets a name.  ``docs`` has ``lang`` and ``text`` (binary)."""
    top = levels[-1]
    spark = docs.sparkSession
    bits = min(30, max(10, int(spark.conf.get("spark.sql.shuffle.partitions")).bit_length() + 2))

    def rows(m: int, keys: np.ndarray, n: np.ndarray, lang: str | None = None, names: list[bytes] | None = None) -> pa.RecordBatch:
        """A row per bucket of some ascending keys.  Names are few: they go
        to every 2**WIDER-th bucket, so that rows are not shorter than what
        each of them costs."""
        own, more = (bits, BORDER) if names is None else (bits - WIDER, 32)
        cuts = np.flatnonzero(np.diff(keys >> np.uint64(64 - own), prepend=np.uint64(1 << own))).tolist() + [len(keys)]
        spans = list(zip(cuts[:-1], cuts[1:], strict=True))
        return pa.RecordBatch.from_arrays([
            pa.array([m] * len(spans), pa.int32()), pa.array([int(keys[a]) >> (64 - own) << (bits - own) for a, _ in spans], pa.int32()), pa.array([lang] * len(spans), pa.string()),
            pa.array([b"\n".join(names[a:b]) if names is not None else None for a, b in spans], pa.binary()), pa.array([_steps(keys[a:b], own, more) for a, b in spans], pa.binary()),
            pa.array([_planes(n[a:b].astype(np.int64)) if (n[a:b] > 1).any() else None for a, b in spans], pa.binary())], names=["words", "bucket", "lang", "names", "keys", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        border: dict[int, list[np.ndarray]] = {m: [] for m in levels}
        names: dict[tuple[str, int], tuple[dict[bytes, int], dict[bytes, int]]] = {}
        totals: Counter = Counter()

        def border_rows(m: int) -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(border[m]), return_counts=True)
            border[m].clear()
            return rows(m, keys, n)

        def named_rows() -> Iterator[pa.RecordBatch]:
            for (lang, m), (counts, key_of) in names.items():
                phrases = list(counts)
                keys = np.fromiter(key_of.values(), np.uint64, len(phrases))
                order = np.argsort(keys, kind="stable")
                yield rows(m, keys[order], np.fromiter(counts.values(), np.int64, len(phrases))[order], lang, [phrases[i] for i in order.tolist()])
            names.clear()

        def looked_at(lang: str, text: bytes, own: int) -> Iterator[pa.RecordBatch]:
            w = Words(text, own, mixed(np.array([zlib.crc32(lang.encode())], np.uint64))[0])
            totals[lang] += w.own
            keys = w.keys
            for m in range(1, top + 1):
                if m == 1:
                    open_now, open_before = np.ones(len(keys), bool), np.full(len(keys), bool(before))
                else:
                    open_now, open_before = (e[:-1] & e[1:] & (w.joined if m == 2 else True) for e in (in_now, in_before))
                    if not open_now.any():
                        return
                    keys = _chained(keys, w.keys)
                in_now, in_before = open_now & _bits(now.get(m), keys), open_before & _bits(before.get(m), keys)
                if m not in levels:
                    continue
                # Words are all counted by name: few are rare, and their later naming would be a pass of its own.
                name_now, name_before = (open_now, open_before) if m == 1 else (in_now, in_before)
                if not named:
                    name_now = name_before = np.zeros(len(keys), bool)
                fresh = np.flatnonzero((open_now & ~name_now & ~open_before)[: w.own])
                if len(fresh):
                    border[m].append(keys[fresh])
                    if sum(map(len, border[m])) > HELD:
                        yield border_rows(m)
                at = np.flatnonzero((name_now & ~name_before)[: w.own])
                if len(at):
                    counts, key_of = names.setdefault((lang, m), ({}, {}))
                    for phrase, key, n in w.named(at, m, keys):
                        counts[phrase] = counts.get(phrase, 0) + n
                        key_of[phrase] = key
            if sum(len(counts) for counts, _ in names.values()) > HELD_NAMES:
                yield from named_rows()

        held: dict[str, list[bytes]] = {}
        size = 0

        def all_held() -> Iterator[pa.RecordBatch]:
            for lang, texts in held.items():
                for text, own in stretches(b"\n".join(texts).translate(_PLAIN), top):
                    yield from looked_at(lang, text, own)
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                text = text.as_py()
                if text:
                    held.setdefault(lang.as_py(), []).append(text)
                    size += len(text)
                if size > STRETCH:
                    yield from all_held()
                    size = 0
        yield from all_held()
        yield from named_rows()
        for m in levels:
            if border[m]:
                yield border_rows(m)
        if named and not before:
            for lang, n in totals.items():
                yield rows(0, np.zeros(1, np.uint64), np.array([n]), lang, [b""])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sums(m: int, keys: list[np.ndarray], counts: list[np.ndarray], names: dict[str, tuple[dict[bytes, int], dict[bytes, int]]]) -> pa.RecordBatch:
            out = [(lang, m, p.decode(), key_of[p], n) for lang, (own, key_of) in names.items() for p, n in own.items() if n >= least or m == 0]
            if keys:
                all_, n = np.concatenate(keys), np.concatenate(counts)
                order = np.argsort(all_)
                all_, n = all_[order], n[order]
                starts = np.flatnonzero(np.r_[True, all_[1:] != all_[:-1]])
                n = np.add.reduceat(n, starts)
                often = n >= least
                out += [(None, m, None, k, c) for k, c in zip(all_[starts][often].tolist(), n[often].tolist(), strict=True)]
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.string()),
                                               pa.array(np.array(cols[3], np.uint64).view(np.int64)), pa.array(cols[4], pa.int64())], names=["lang", "words", "phrase", "key", "n"])

        last, keys, counts, names = None, [], [], {}
        for batch in batches:
            columns = [batch.column(c) for c in ("words", "bucket", "lang", "names", "keys", "counts")]
            for words, bucket, lang, text, key, n in zip(*columns, strict=True):
                here = words.as_py(), bucket.as_py()
                if here != last:
                    if last is not None:
                        yield sums(last[0], keys, counts, names)
                    last, keys, counts, names = here, [], [], {}
                own = _from_steps(np.frombuffer(key.as_buffer(), np.uint8), *((here[1] >> WIDER, bits - WIDER) if text.is_valid else (here[1], bits, BORDER)))
                times = _from_planes(np.frombuffer(n.as_buffer(), np.uint8), np.int64) if n.is_valid else np.ones(len(own), np.int64)
                if text.is_valid:
                    seen, key_of = names.setdefault(lang.as_py(), ({}, {}))
                    for p, k, c in zip(text.as_py().split(b"\n"), own.tolist(), times.tolist(), strict=True):
                        seen[p] = seen.get(p, 0) + c
                        key_of[p] = k
                else:
                    keys.append(own)
                    counts.append(times)
        if last is not None:
            yield sums(last[0], keys, counts, names)

    sent = docs.mapInArrow(count, _SENT)
    return sent.repartition("words", "bucket").sortWithinPartitions("words", "bucket").mapInArrow(added, _SUMS)


def frequent_phrases(docs: DataFrame, longest: int = 3, min_count: int = 10, rate: float = 0.25, lowered: float = 0.8, bits: int = 24,
                     lang: str = "lang", text: str = "text") -> DataFrame:
    """(``lang``, ``words``, ``phrase``, ``n``): all phrases of up to
    ``longest`` words that occur at least ``min_count`` times in the texts of
    a language, with their exact numbers, and one row of 0 words for each
    language with its number of words.

    ``rate`` of the documents (by a hash) propose what occurs at least
    ``lowered`` times as often among them as ``min_count`` would; the counts
    do not depend on either.  ``bits``: proposals are bitmaps of 2**bits bits.

    A NULL language is ``und``, a NULL text has no words, as an empty one.
    Repeated rows count each.  No rows, or no words, give no rows.  A task
    holds STRETCH bytes of text, or one word, and one bucket of keys: their
    number grows with ``spark.sql.shuffle.partitions``.
    """
    small_batches(docs.sparkSession)
    if longest < 2 or min_count < 1 or not 0 < rate <= 1 or not 6 <= bits <= 32:
        raise ValueError("phrases need 2 words or more, a count of 1 or more, a rate of 0 to 1 and 6 to 32 bits")
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text"))
    few = rows.where(F.pmod(F.xxhash64(F.lit("sample"), "text"), F.lit(1 << 20)) < int(rate * (1 << 20)))
    least = max(1, int(lowered * rate * min_count))
    now: dict[int, np.ndarray] = {}
    for m in range(1, longest + 1):
        now[m] = bitmap(_counted(few, range(m, m + 1), now, {}, False, least), bits)
    before: dict[int, np.ndarray] = {}
    found: list[DataFrame] = []
    while True:
        found.append(cut_lineage(_counted(rows, range(1, longest + 1), now, before, True, min_count)))
        more = {m: now[m] | bitmap(found[-1].where(F.col("words") == m), bits) for m in now}
        if all((more[m] == now[m]).all() for m in now):
            break
        # Phrases of the border are frequent: they and what they open are counted too.
        before, now = now, more
    return reduce(DataFrame.union, found).where(F.col("phrase").isNotNull()).select("lang", "words", "phrase", "n")


#: floor(1000000 * a * a / (l * r)) on decimals, whose products are exact.
_SCORE = "CAST(1000000 AS decimal(7, 0)) * (CAST(a AS decimal(14, 0)) * CAST(a AS decimal(14, 0))) div (CAST(l AS decimal(14, 0)) * CAST(r AS decimal(14, 0)))"


def collocations(docs: DataFrame, longest: int = 3, min_count: int = 10, top: int = 2000, covered: int = 50, lang: str = "lang", text: str = "text",
                 **mining) -> DataFrame:
    """Each language's ``top`` collocations: ``lang``, ``rank`` (from 1),
    ``phrase``, ``a`` (its occurrences), ``l`` and ``r`` (those of the two
    parts of its lowest-scoring cut, ties to the shorter first part), ``n``
    (words of the language) and ``score`` = floor(1000000 * a * a / (l * r)),
    by falling score, falling ``a`` and phrase.

    Phrases of 2 to ``longest`` words with at least ``min_count``
    occurrences are candidates; one goes if a longer candidate holds it and
    has at least ``covered`` per cent of its occurrences.  Arithmetic is on
    decimals, exact for counts below 10**14.  NULL, empty, repeated and
    absent rows: see :func:`frequent_phrases`.
    """
    counts = frequent_phrases(docs, longest, min_count, lang=lang, text=text, **mining)
    phrases = counts.where(F.col("words") > 1).select("lang", "words", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))

    def part(at: Column | int, size: Column) -> Column:
        return F.array_join(F.slice("w", at, size), " ")

    # Each phrase inside a longer candidate, with the most occurrences of one.
    size, start = F.col("size"), F.col("start")
    inner = (
        phrases.where(F.col("words") > 2)
        .withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
        .withColumn("start", F.explode(F.sequence(F.lit(1), F.col("words") - size + 1)))
        .select("lang", part(start, size).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    )
    kept = phrases.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(covered) * F.col("a")))
    cut = F.col("k")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "a", "k", part(1, cut).alias("first"), part(cut + 1, F.col("words") - cut).alias("rest"))
    parts = counts.where(F.col("words").between(1, longest - 1))
    lefts = parts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    rights = parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scored = cuts.join(lefts, ["lang", "first"]).join(rights, ["lang", "rest"]).withColumn("score", F.expr(_SCORE))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (
        lowest.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    )
    totals = counts.where(F.col("words") == 0).select("lang", "n")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")

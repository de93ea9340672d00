"""Packing into fixed-length training sequences: vector bin packing.

A sequence has three limits at once: tokens, segments (examples or pieces
of them) and loss-bearing tokens.  Sequences are filled one after the
other; the next example is the one with the largest dot product of its
demands with what the sequence has left, weighted by how scarce each limit
is among the waiting examples.  Examples of equal demands are one type, so
a choice is one vector operation over the types.

Each task packs its own rows from a pool of bounded size while it reads
them, so nothing is shuffled and memory does not grow with the input; what
does not fill a sequence waits for the next pool.  Documents may be cut: a
long one gives full sequences and a remainder, and a gap that no waiting
piece fits is filled by cutting one.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabletrust.llm.common import small_batches

#: Texts are tokenised in stretches of about so many characters.
STRETCH = 1 << 16
#: Runs of white space (as Unicode has it) so long that the look-ahead of the
#: pattern may run out of stack; most stretches are shorter.
LONG = 1 << 17
_SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_LONG_RUN = re.compile(f"(?<!{_SPACE}){_SPACE}{{{LONG},}}")
#: What is known of a piece, besides its document.
PIECE = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens")
#: A task packs when so many tokens wait.
POOL = 1 << 21


class Limits(NamedTuple):
    tokens: int = 1024
    segments: int = 64
    loss: int = 1024


class Piece:
    """Tokens [start, start + len(ids)) of an example; ``loss`` of them
    bear loss.  ``ids`` may be any sized object that slices."""

    __slots__ = ("example", "ids", "loss", "start")

    def __init__(self, example, start: int, ids, loss: int):
        self.example, self.start, self.ids, self.loss = example, start, ids, loss


def fill(pieces: list[Piece], limits: Limits, least_cut: int = 0, last: bool = True) -> tuple[list[list[Piece]], list[Piece]]:
    """(sequences, pieces left over).  Every piece must fit an empty
    sequence.  ``least_cut``: the smallest gap that is filled by cutting a
    piece, 0 for none; every token of a cut piece but the ones before its
    loss counts as before.  Unless ``last``, pieces that would leave a
    sequence open are left over."""
    waiting: dict[tuple[int, int], list[Piece]] = defaultdict(list)
    for p in reversed(pieces):
        waiting[len(p.ids), p.loss].append(p)
    types = np.array(sorted(waiting), np.int64).reshape(-1, 2)
    left = np.array([len(waiting[t, n]) for t, n in types.tolist()], np.int64)
    room = np.array(limits, np.float64)
    out: list[list[Piece]] = []
    total = int(left.sum())
    put: dict[tuple[int, int], int] = {(t, n): i for i, (t, n) in enumerate(types.tolist())}
    while total:
        # Scarcity: the share of each limit that the waiting pieces need.
        need = np.array([left @ types[:, 0], total, left @ types[:, 1]]) / room
        scarce = need / need.sum()
        free = np.array(limits)
        now: list[Piece] = []
        while free[0] and free[1] and total:
            able = (left > 0) & (types[:, 0] <= free[0]) & (types[:, 1] <= free[2])
            gain = scarce * free / room / room
            score = np.where(able, types[:, 0] * gain[0] + gain[1] + types[:, 1] * gain[2], -1.0)
            best = int(score.argmax())
            if not able[best]:
                gap = int(min(free[0], free[2]))
                if not least_cut or gap < least_cut:
                    break
                # No piece fits: cut the longest.
                best = int(np.flatnonzero(left)[types[left > 0, 0].argmax()])
                whole = waiting[tuple(types[best].tolist())].pop()
                left[best] -= 1
                quiet = len(whole.ids) - whole.loss
                head = Piece(whole.example, whole.start, whole.ids[:gap], max(0, gap - quiet))
                tail = Piece(whole.example, whole.start + gap, whole.ids[gap:], len(whole.ids) - gap - max(0, quiet - gap))
                now.append(head)
                free -= (gap, 1, head.loss)
                t = (len(tail.ids), tail.loss)
                if t not in put:
                    put[t] = len(types)
                    types = np.vstack([types, t])
                    left = np.append(left, 0)
                waiting[t].append(tail)
                left[put[t]] += 1
                continue
            now.append(waiting[tuple(types[best].tolist())].pop())
            left[best] -= 1
            total -= 1
            free -= (types[best, 0], 1, types[best, 1])
        if not total and not last and free[0] and free[1]:
            return out, now
        out.append(now)
    return out, []


def stretches(text: str) -> Iterator[str]:
    """The text in stretches that a byte-level BPE with the usual pattern
    tokenises as it does the whole: cuts lie before a single space between
    two characters that are not white space."""
    at = 0
    safe = re.compile(r"(?<=\S) (?=\S)")
    while len(text) - at > STRETCH:
        cut = safe.search(text, at + STRETCH)
        if not cut:
            break
        yield text[at: cut.start()]
        at = cut.start()
    yield text[at:]


#: The JSON tokenizers of this Python worker.
_WHOLE: dict = {}


def encoder(path: str | None):
    """Encodes as the byte-level BPE ``byte_bpe_50k.json`` does, whose
    vocabulary the ranks file holds; the reader of ranks is several times
    faster.  A stretch that holds the string of a special token is left to
    the JSON file, which lies beside the ranks."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    known = tiktoken.registry.ENCODINGS  # one per Python worker
    if path not in known:
        with open(path, "rb") as ranks:
            known[path] = tiktoken.Encoding(
                path, pat_str=public_tokenizers.PATTERN, special_tokens={},
                mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks)})
    whole = known[path]
    beside = re.sub(r"\.\w+$", ".json", path)
    with open(beside, encoding="utf-8") as file:
        special = re.compile("|".join(re.escape(t["content"]) for t in json.load(file).get("added_tokens", [])) or r"(?!)")

    def encode(text: str) -> np.ndarray:
        if special.search(text):
            if beside not in _WHOLE:
                _WHOLE[beside] = Tokenizer.from_file(beside)
            return np.array(_WHOLE[beside].encode(text, add_special_tokens=False).ids, np.uint32)
        if len(text) < LONG:
            return whole.encode_to_numpy(text)
        out, at = [], 0
        for run in _LONG_RUN.finditer(text):
            # The pattern takes a run as one, but for the last character before other text.
            end = run.end() - (run.end() < len(text))
            out += [whole.encode_to_numpy(text[at: run.start()]), np.array(whole._encode_single_piece(text[run.start(): end]), np.uint32)]
            at = end
        return np.concatenate([*out, whole.encode_to_numpy(text[at:])])

    return encode


def pack_documents(docs: DataFrame, limits: Limits = Limits(), least_cut: int = 16, end_id: int = 0,
                   vocabulary: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``
    (of its ids as little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id``, ``offset`` and ``loss_tokens``.

    A document is its tokens and then ``end_id``; all but its first token
    bear loss.  Each token lies in one piece.  NULL and empty texts are the
    end id alone.  Repeated rows are packed each on its own; a NULL doc_id
    stays NULL.  No rows give no rows; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    limits = Limits(*limits)

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary)
        task, count = TaskContext.get().partitionId() << 40, 0
        full = min(limits.tokens, limits.loss)
        rows: list[tuple] = []
        pool: list[Piece] = []
        waiting = 0

        def row(piece: tuple, sequence: int, offset: int) -> None:
            (doc, tokens), start, length, crc, loss = piece
            rows.append((doc, start, length, crc, tokens, task + sequence, offset, loss))

        def crc(ids: np.ndarray) -> int:
            return zlib.crc32(ids.astype("<u4").tobytes())

        def frame() -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=["doc_id", *PIECE])
            rows.clear()
            return out

        def pack_pool(last: bool) -> None:
            nonlocal count, waiting
            sequences, pool[:] = fill(pool, limits, least_cut, last)
            waiting = sum(len(p.ids) for p in pool)
            for pieces in sequences:
                offset = 0
                for p in pieces:
                    row((p.example, p.start, len(p.ids), crc(p.ids), p.loss), count, offset)
                    offset += len(p.ids)
                count += 1

        for some in frames:
            for doc, body in zip(some["doc_id"], some["text"], strict=True):
                rest, start, done = np.empty(0, np.uint32), 0, []
                for stretch in stretches(body or ""):
                    rest = np.concatenate([rest, encode(stretch)])
                    while len(rest) > full:  # the end id is still to come
                        done.append((start, full, crc(rest[:full]), full - (start == 0)))
                        start, rest = start + full, rest[full:]
                rest = np.append(rest, np.uint32(end_id)).astype(np.uint32)
                example = (doc, start + len(rest))
                if len(rest) > full:
                    done.append((start, full, crc(rest[:full]), full - (start == 0)))
                    start, rest = start + full, rest[full:]
                for piece in done:
                    row((example, *piece), count, 0)
                    count += 1
                pool.append(Piece(example, start, rest.copy(), len(rest) - (start == 0)))
                waiting += len(rest)
                if waiting >= POOL:
                    pack_pool(last=False)
                if len(rows) >= 20_000:
                    yield frame()
        pack_pool(last=True)
        if rows:
            yield frame()

    # Ids travel as text: pandas would make nullable numbers floats.
    texts = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    packed = texts.mapInPandas(pack, "doc_id string, " + ", ".join(f"{c} long" for c in PIECE))
    return packed.withColumn("doc_id", F.col("doc_id").cast(docs.schema[doc_id].dataType))


def pack_examples(examples: DataFrame, limits: Limits = Limits(), example_id: str = "example_id", tokens: str = "tokens",
                  loss: str = "loss") -> DataFrame:
    """Whole examples: (``example_id``, ``sequence_id``, ``offset``) from
    their numbers of tokens and loss-bearing tokens.  An example that
    exceeds a limit by itself, or has a NULL or negative number, gets no
    sequence (NULL); repeated rows are packed each on its own."""
    limits = Limits(*limits)

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, count, pool = TaskContext.get().partitionId() << 40, 0, []

        def packed(last: bool) -> pd.DataFrame:
            nonlocal count
            sequences, pool[:] = fill(pool, limits, 0, last)
            out = []
            for pieces in sequences:
                offset = 0
                for p in pieces:
                    out.append((p.example, task + count, offset))
                    offset += len(p.ids)
                count += 1
            return pd.DataFrame(out, columns=["example_id", "sequence_id", "offset"])

        for some in frames:
            fits = some["tokens"].between(0, limits.tokens) & some["loss"].between(0, limits.loss)
            yield some.loc[~fits, ["example_id"]].assign(sequence_id=pd.array([pd.NA] * int((~fits).sum()), "Int64"), offset=pd.array([pd.NA] * int((~fits).sum()), "Int64"))
            for name, t, n in zip(*(some.loc[fits, c] for c in ("example_id", "tokens", "loss")), strict=True):
                pool.append(Piece(name, 0, range(int(t)), int(n)))
            if len(pool) >= POOL // 64:
                yield packed(last=False)
        yield packed(last=True)

    demands = examples.select(F.col(example_id).cast("string").alias("example_id"), F.col(tokens).cast("bigint").alias("tokens"), F.col(loss).cast("bigint").alias("loss"))
    packed = demands.mapInPandas(pack, "example_id string, sequence_id long, offset long")
    return packed.withColumn("example_id", F.col("example_id").cast(examples.schema[example_id].dataType))

"""Operator 4: packing by minimum bin slack.

A document's ids, then the end id, are cut at every ``window`` ids.  Full
pieces are sequences of their own; what is left of each document, at most
one piece shorter than a window, is dealt at random into groups of about
``GROUP`` pieces, and each group fills its windows by subset sums: the
longest piece left opens a window, a bitset dynamic programme over the
lengths left (each with its count, split into powers of two) finds the sum
closest to the capacity, and walking back through the bitsets gives how
many of each length to take.  The multiset is used as often as the counts
allow.  (A sequence that ends at a power of two needs no padding; that isn't
sought, the closest sum is always taken.)

Null and empty texts are the end id alone; repeated rows are packed each
(every row is its own document); null doc_ids come back as null; further
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Chunk, chunks, texts_of, written
from quarry.llm.tokens import cuts_are_safe
from quarry.llm.units import BulkMemo

WINDOW = 1024
#: Short pieces that are packed together; each group leaves a window or two
#: that can't be filled, so padding is about one window in GROUP / 2.
GROUP = 20_000
FULL = 1 << 62
#: Bytes of text encoded at a time.
TEXT_BYTES = 4 << 20

_LOADED: dict[str, object] = {}


def load(path: str):
    """A function from a chunk to its ids, flat, and where each text's begin,
    by the tokenizers library."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(path)
        own.no_truncation()
        own.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)

        def encode(texts: list[str]) -> list[bytes]:
            return [array("I", x.ids).tobytes() for x in own.encode_batch_fast(texts, add_special_tokens=False)]

        if cuts_are_safe(spec):
            memo = BulkMemo(encode, {t["content"]: t["id"].to_bytes(4, "little") for t in spec.get("added_tokens", [])})
            _LOADED[path] = lambda chunk: memo.ids(chunk, 2 * TEXT_BYTES)
        else:
            def whole(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
                found = encode([chunk.bytes_of(k).decode() for k in range(chunk.n)])
                return np.frombuffer(b"".join(found), "<u4"), np.append(0, np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4))

            _LOADED[path] = whole
    return _LOADED[path]


def fill(counts: dict[int, int], capacity: int) -> tuple[int, list[tuple[int, int, int]], int]:
    """(sum closest to ``capacity``, the steps that made it: length, how
    many, the bitset before; the bitset of all sums found): stops as soon as
    the capacity is met."""
    sums, mask, steps = 1, (1 << (capacity + 1)) - 1, []
    goal = 1 << capacity
    for length in sorted((x for x in counts if x <= capacity), reverse=True):
        left, take = min(counts[length], capacity // length), 1
        while left and not sums & goal:
            take = min(take, left)
            left -= take
            more = (sums | sums << (length * take)) & mask
            if more != sums:
                steps.append((length, take, sums))
                sums = more
            take *= 2
        if sums & goal:
            break
    return sums.bit_length() - 1, steps, sums


def walk_back(steps: list[tuple[int, int, int]], total: int) -> dict[int, int]:
    """How many of each length make ``total``."""
    used: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            used[length] = used.get(length, 0) + take
    return used


def pack_lengths(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(window number, offset) of each piece; every length is 1 to window."""
    order = np.argsort(lengths, kind="stable")
    values, first, count = np.unique(lengths[order], return_index=True, return_counts=True)
    next_at = dict(zip(values.tolist(), first.tolist(), strict=True))
    counts = dict(zip(values.tolist(), count.tolist(), strict=True))
    window_of, offset_of = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_length, bins = sorted(counts), 0
    while by_length:
        longest = by_length[-1]
        if not counts.get(longest):
            by_length.pop()
            continue
        counts[longest] -= 1
        live = {x: n for x, n in counts.items() if n}
        best, steps, _ = fill(live, window - longest)
        used = walk_back(steps, best)
        counts[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        for _ in range(min(counts[x] // n for x, n in used.items())):
            at = 0
            for x, n in used.items():
                rows = order[next_at[x]:next_at[x] + n]
                window_of[rows], offset_of[rows] = bins, at + x * np.arange(n)
                next_at[x] += n
                counts[x] -= n
                at += x * n
            bins += 1
        counts = {x: n for x, n in counts.items() if n}
    return window_of, offset_of


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, piece (a number of its
    own for each piece), and with ``with_ids`` the ids themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, number = load(tokenizer), TaskContext.get().partitionId() << 32
        for batch in batches:
            for at, stop, chunk in chunks(batch, TEXT_BYTES):
                ids, off = encode(chunk)
                ids = np.insert(ids, off[1:], end_id).astype("<u4")
                off = off + np.arange(len(off))
                size = np.diff(off)
                count = -(-size // window)
                doc = np.repeat(np.arange(chunk.n), count)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * window
                begin, length = off[doc] + start, np.minimum(size[doc] - start, window)
                data = memoryview(ids.tobytes())
                crc = [zlib.crc32(data[a:b]) for a, b in zip((4 * begin).tolist(), (4 * (begin + length)).tolist(), strict=True)]
                columns = [batch.column(0).slice(at, stop - at).take(pa.array(doc)), *(pa.array(x, pa.int64()) for x in (start, length, crc, size[doc], number + np.arange(len(doc))))]
                number += len(doc)
                if with_ids:  # the pieces lie one after another
                    ends = pa.array(np.append(4 * begin, len(data)), pa.int64())
                    columns.append(pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc), [None, ends.buffers()[1], pa.py_buffer(data)]).cast(pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "piece"] + ["ids"] * with_ids)

    return texts_of(docs).mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, piece long" + ", ids binary" * with_ids)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """The pieces of all ``docs`` with sequence_id and offset; with
    ``with_ids`` also the ids of each piece."""
    cut = written(pieces(docs, tokenizer, end_id, window, with_ids), "pieces")
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids
    full = cut.where(F.col("length") == window).select(*keep, (F.lit(FULL) + F.col("piece")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = cut.where(F.col("length") < window)
    groups = max(1, -(-short.count() // GROUP))
    dealt = short.select("piece", "length", F.pmod(F.xxhash64("piece"), F.lit(groups)).alias("dealt"))

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.sort_by("piece")
        number, offset = pack_lengths(group.column("length").to_numpy(), window)
        return pa.table({"piece": group.column("piece"), "sequence_id": pa.array((key[0].as_py() << 32) + number, pa.int64()), "offset": pa.array(offset, pa.int64())})

    placed = dealt.groupBy("dealt").applyInArrow(run, "piece long, sequence_id long, offset long")
    return full.unionByName(short.join(placed, "piece").select(*keep, "sequence_id", "offset"))

"""Operator 12: fill-in-middle transformation by Fenwick trees over blocks.

A text is cut into units (``UNITS``: code points, words or lines; every
byte of the text belongs to one unit).  Its UTF-8 is split into fixed blocks
of ``BLOCK`` bytes, and a Fenwick tree over the blocks holds how many units
and how many code points begin in each.  To cut before unit k, a descent by
powers of two through the tree finds the block in which that unit begins,
with the code points before it; the byte is then looked for in that block
alone.  So a cut reads one block whatever the length of the text.

Cuts, form and order are drawn from a document's own hash: h1 to h4 are the
first four 8-digit groups of the hex SHA-256 of ``salt:doc_id``.  The prefix
ends after the smaller of h1 % (n + 1) and h2 % (n + 1) units, the middle
after the larger; the rest is the suffix.  A text stays plain if it is empty
or holds a marker, or if h3 % 100 >= ``rate``; otherwise it is written
suffix first (spm) if h4 % 100 < ``spm``, else prefix first (psm).  A
marker never begins inside another, nor inside a text without markers, so
``restored`` gives the exact text back.

Null texts are empty, and stay plain; a null doc_id hashes as ``salt:``
alone; rows that repeat a doc_id are each transformed; an empty table gives
an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import chunks, is_space, texts_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RATE, SPM, SALT = 90, 20, "1"
#: Bytes of text counted by one leaf of the tree.
BLOCK = 1024


def code_points(buf: np.ndarray) -> np.ndarray:
    """Whether each byte begins a code point."""
    return (buf & 0xC0) != 0x80


def _words(buf: np.ndarray) -> np.ndarray:
    """A unit is a word and the white space before it; white space at the
    end of a text is a unit too."""
    space = is_space(buf)
    starts = np.zeros(len(buf), bool)
    starts[1:] = space[1:] & ~space[:-1]
    return starts


def _lines(buf: np.ndarray) -> np.ndarray:
    starts = np.zeros(len(buf), bool)
    starts[1:] = buf[:-1] == 10
    return starts


#: Whether each byte of some text begins a unit (the first always does).
UNITS: dict[str, Callable[[np.ndarray], np.ndarray]] = {"code_point": code_points, "word": _words, "line": _lines}


class Fenwick:
    """Sums of several counts (rows of ``counts``) over leaves 0, 1, ..."""

    def __init__(self, counts: np.ndarray):
        self.size = counts.shape[1]
        self.tree = np.concatenate([np.zeros((len(counts), 1), np.int64), counts.astype(np.int64)], 1)
        step = 1
        while 2 * step <= self.size:  # a node takes in the one that ends half its span before it
            self.tree[:, 2 * step::2 * step] += self.tree[:, step:self.size + 1 - step:2 * step]
            step *= 2

    def before(self, k: int) -> tuple[int, list[int]]:
        """The leaf in which the first count passes ``k``, and the sums of
        all counts over the leaves before it."""
        at, sums, step = 0, [0] * len(self.tree), 1 << self.size.bit_length() >> 1
        while step:
            if at + step <= self.size and sums[0] + self.tree[0, at + step] <= k:
                at += step
                sums = [s + int(t) for s, t in zip(sums, self.tree[:, at], strict=True)]
            step >>= 1
        return at, sums


class Cuts:
    """The units of one text (``buf`` and ``starts``, where units begin)."""

    def __init__(self, buf: np.ndarray, starts: np.ndarray):
        self.buf, self.starts, self.points = buf, starts, code_points(buf)
        leaves = np.arange(0, len(buf), BLOCK)
        self.tree = Fenwick(np.stack([np.add.reduceat(x, leaves, dtype=np.int64) if len(buf) else np.zeros(0, np.int64) for x in (starts, self.points)]))
        self.n, self.n_points = int(np.count_nonzero(starts)), int(np.count_nonzero(self.points))

    def before(self, k: int) -> tuple[int, int]:
        """(bytes, code points) before unit ``k``; of all for k = n."""
        if k >= self.n:
            return len(self.buf), self.n_points
        leaf, (units, points) = self.tree.before(k)
        begin = leaf * BLOCK
        inside = int(np.flatnonzero(self.starts[begin:begin + BLOCK])[k - units])
        return begin + inside, points + int(np.count_nonzero(self.points[begin:begin + inside]))


def draws(salt: str, doc_id: int | None) -> tuple[int, int, int, int]:
    digest = sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k:k + 4], "big") for k in (0, 4, 8, 12))


def transformed(docs: DataFrame, unit: str = "code_point", rate: int = RATE, spm: int = SPM, salt: str = SALT,
                prefix: str = PREFIX, suffix: str = SUFFIX, middle: str = MIDDLE) -> DataFrame:
    """Per row: doc_id, n (units), form (plain, psm or spm), prefix_chars and
    middle_chars (code points; null if plain), output."""
    markers = tuple(m.encode() for m in (prefix, suffix, middle))
    p_mark, s_mark, m_mark = markers

    def one(text: bytes, buf: np.ndarray, starts: np.ndarray, doc_id: int | None) -> tuple:
        h1, h2, h3, h4 = draws(salt, doc_id)
        if not text or h3 % 100 >= rate or any(m in text for m in markers):
            return int(np.count_nonzero(starts)), "plain", None, None, text
        cuts = Cuts(buf, starts)
        first, second = h1 % (cuts.n + 1), h2 % (cuts.n + 1)
        (a, a_points), (b, b_points) = cuts.before(min(first, second)), cuts.before(max(first, second))
        if h4 % 100 < spm:
            form, parts = "spm", (s_mark, text[b:], p_mark, text[:a], m_mark, text[a:b])
        else:
            form, parts = "psm", (p_mark, text[:a], s_mark, text[b:], m_mark, text[a:b])
        return cuts.n, form, a_points, b_points - a_points, b"".join(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, chunk in chunks(batch):
                starts = UNITS[unit](chunk.buf)
                starts[chunk.off[:-1][np.diff(chunk.off) > 0]] = True
                ids, off = batch.column(0).slice(at, end - at), chunk.off.tolist()
                rows = [one(chunk.bytes_of(k), chunk.buf[off[k]:off[k + 1]], starts[off[k]:off[k + 1]], i) for k, i in enumerate(ids.to_pylist())]
                n, form, before, inside, output = zip(*rows, strict=True)
                columns = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()), pa.array(inside, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([ids, *columns], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return texts_of(docs).mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, prefix: str = PREFIX, suffix: str = SUFFIX, middle: str = MIDDLE) -> Column:
    """The text that an output of the given form was made from."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        """What follows each of the three markers."""
        rest = F.substr(output, F.lit(len(first) + 1))
        cut = F.instr(rest, second)
        tail = F.substr(rest, cut + len(second))
        last = F.instr(tail, middle)
        return F.substr(rest, F.lit(1), cut - 1), F.substr(tail, F.lit(1), last - 1), F.substr(tail, last + len(middle))

    before, after, inside = parts(prefix, suffix)
    psm = F.concat(before, inside, after)
    after, before, inside = parts(suffix, prefix)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(before, inside, after)).otherwise(output)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    made = transformed(docs)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))

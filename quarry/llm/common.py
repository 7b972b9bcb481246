"""Helpers shared by the operators: written tables, Arrow text chunks and
vectorised byte / word hashing."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled by one vectorised step; bounds a task's memory.
CHUNK_BYTES = 1 << 20

#: Unicode White_Space, spelled out (Python's own \s also holds U+001C-1F).
WHITE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a clear error where it is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return path.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: cuts lineage
    and computes the rows once, whatever executors are lost later."""
    path = f"{shared_dir(df.sparkSession)}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts_of(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string not null); other columns, whatever their names, go."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


class Chunk:
    """Some whole documents: ``ids`` (0 for null), their UTF-8 in ``buf``, ``off`` (n + 1)."""

    def __init__(self, ids: np.ndarray, buf: np.ndarray, off: np.ndarray):
        self.ids, self.buf, self.off, self.n = ids, buf, off, len(off) - 1

    def bytes_of(self, k: int) -> bytes:
        return self.buf[self.off[k]:self.off[k + 1]].tobytes()


def _buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32, count=len(col) + 1 + col.offset)[col.offset:].astype(np.int64)
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf, off


def chunks(batch: pa.RecordBatch, max_bytes: int = CHUNK_BYTES, column: str = "text") -> Iterator[tuple[int, int, Chunk]]:
    """(first row, end row, Chunk) pieces of an Arrow batch of about
    ``max_bytes`` of text each; a longer document is a piece of its own."""
    if not batch.num_rows:
        return
    col = batch.column(batch.schema.get_field_index(column))
    if col.null_count:
        col = col.fill_null("" if not pa.types.is_binary(col.type) else b"")
    buf, off = _buffer(col)
    ids = batch.column(0)
    ids = (ids.fill_null(0) if pa.types.is_integer(ids.type) else ids).to_numpy(zero_copy_only=False)
    at = 0
    while at < len(col):
        end = max(at + 1, int(np.searchsorted(off, off[at] + max_bytes, side="right")) - 1)
        end = min(end, len(col))
        yield at, end, Chunk(ids[at:end], buf[off[at]:off[end]], off[at:end + 1] - off[at])
        at = end


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over an array of uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, 2 * CHUNK_BYTES)
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("up", _BASE), ("down", inverse)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each values[start:end] (bytes or hashes of words)."""
    n = len(values)
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts])


def is_space(buf: np.ndarray) -> np.ndarray:
    """The bytes of [\\x20\\x09-\\x0D]."""
    return (buf == 32) | ((buf >= 9) & (buf <= 13))


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return np.where((buf >= 65) & (buf <= 90), buf | 32, buf).astype(np.uint8)


def word_spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document numbers of the words [^\\x20\\x09-\\x0D]+;
    words never cross documents."""
    word = ~is_space(buf)
    edge = np.zeros(len(buf) + 1, bool)
    if len(buf):
        edge[1:-1] = word[1:] != word[:-1]
        edge[off] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    keep = word[starts] if len(starts) else np.zeros(0, bool)
    starts, ends = starts[keep], ends[keep]
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def per_doc(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between consecutive ``off``."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def occurrences(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: how many equal entries precede it, and how many
    there are in all."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(keys)))
    before, total = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
    before[order] = np.arange(len(keys)) - np.repeat(first, count)
    total[order] = np.repeat(count, count)
    return before, total


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from flat ``values`` and the length of each row."""
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(values, kind))


#: A cut between the two is a boundary between tokens for the byte-level
#: pattern: no token goes on after a character that isn't white space with
#: white space, nor after a letter or digit with a punctuation mark.
SAFE_CUT = re.compile(rf"(?<=[^{WHITE}])(?=[{WHITE}])|(?<=[^\W_])(?=[.,;:!?、。！，？])")


def safe_pieces(text: str, chars: int) -> Iterator[str]:
    """Cut ``text`` into pieces of about ``chars`` characters at safe
    boundaries; a run without any stays whole."""
    at = 0
    while len(text) - at > chars:
        cut = SAFE_CUT.search(text, at + chars)
        if cut is None or cut.start() >= len(text):
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:] if at else text

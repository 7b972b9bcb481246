"""Operator 8: hashed word n-gram logistic regression, trained with
follow-the-regularised-leader updates and scored as sparse dot products.

Tokens are runs of letters, digits and other non-ASCII bytes, or runs of
ASCII punctuation, as written; features are hashes of one and two tokens,
valued by their square-rooted counts and scaled to length one, with an
intercept, three log-scaled length features and the share of repeated
n-grams beside them.  Training reads
at most ``TRAIN_ROWS`` labelled rows (those with the smallest hash of
doc_id; a documented bound), in one task, ``EPOCHS`` times; the weights,
one vector of ``2 ** BITS`` floats, are of fixed size and go to all tasks.

Null and empty texts score from the intercept and length features; repeated
rows score alike; labels that are null or other than 0 and 1 are not used;
with no usable label every score is 0.5; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Chunk, chunks, is_space, mix64, span_hashes, texts_of

BITS = 20
TRAIN_ROWS = 6_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.01, 0.0
EXTRA = 4


def token_spans(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    buf, off = chunk.buf, chunk.off
    space = is_space(buf)
    letter = (buf >= 128) | ((buf | 32) >= 97) & ((buf | 32) <= 122) | (buf >= 48) & (buf <= 57)
    kind = np.where(space, 0, np.where(letter, 1, 2)).astype(np.int8)
    edge = np.zeros(len(buf) + 1, bool)
    if len(buf):
        edge[1:-1] = kind[1:] != kind[:-1]
        edge[off] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    keep = kind[starts] > 0 if len(starts) else np.zeros(0, bool)
    starts, ends = starts[keep], ends[keep]
    return starts, ends, np.searchsorted(off, starts, side="right") - 1


def features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, slot, value) of every feature, ordered by document.  Slots
    0 to EXTRA are the intercept and the length features."""
    starts, ends, doc = token_spans(chunk)
    one = span_hashes(chunk.buf, starts, ends)
    two = mix64(one[:-1] * np.uint64(3) + one[1:]) if len(one) else one
    pair = doc[:-1] == doc[1:] if len(doc) else np.zeros(0, bool)
    slots = np.concatenate([one, two[pair]]) >> np.uint64(64 - BITS)
    docs = np.concatenate([doc, doc[:-1][pair]]) if len(doc) else doc
    key = (docs.astype(np.int64) << BITS) | np.maximum(slots.astype(np.int64), EXTRA + 1)
    key, count = np.unique(key, return_counts=True)
    docs, slots = key >> BITS, key & ((1 << BITS) - 1)
    norm = np.sqrt(np.bincount(docs, weights=count, minlength=chunk.n))
    values = np.sqrt(count) / norm[docs]
    tokens = np.bincount(doc, minlength=chunk.n)
    size = np.diff(chunk.off)
    again = 1 - np.bincount(docs, minlength=chunk.n) / np.maximum(norm ** 2, 1)
    lead = np.stack([np.ones(chunk.n), np.log1p(tokens) / 10, np.log1p(size) / 10, size / (tokens + 1) / 10, again], 1)
    all_docs = np.concatenate([np.repeat(np.arange(chunk.n), EXTRA + 1), docs])
    order = np.argsort(all_docs, kind="stable")
    return all_docs[order], np.concatenate([np.tile(np.arange(EXTRA + 1), chunk.n), slots])[order], np.concatenate([lead.ravel(), values])[order]


class Ftrl:
    """Follow the regularised leader, per coordinate (McMahan et al. 2013)."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def update(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        labels = batch.column(2).to_pylist()
        for at, end, chunk in chunks(batch):
            doc, slot, value = features(chunk)
            cut = np.searchsorted(doc, np.arange(chunk.n + 1))
            rows += [(i, slot[a:b].astype(np.int32), value[a:b].astype(np.float32), y) for i, a, b, y in zip(chunk.ids.tolist(), cut[:-1], cut[1:], labels[at:end], strict=True)]
    rows.sort(key=lambda r: r[0])
    model, order = Ftrl(1 << BITS), np.random.default_rng(0)
    for _ in range(EPOCHS if rows else 0):
        for k in order.permutation(len(rows)):
            model.update(rows[k][1], rows[k][2], rows[k][3])
    yield pa.RecordBatch.from_arrays([pa.array([model.weights(slice(None)).astype("<f4").tobytes()], pa.binary())], ["weights"])


def fold(doc_id: Column, of: int) -> Column:
    return F.crc32(doc_id.cast("string")) % of


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", train_rows: int = TRAIN_ROWS) -> np.ndarray:
    """Weights from the labelled rows outside fold 0 of 5."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")) \
        .where(F.col("label").isin(0, 1) & (fold(F.col("doc_id"), 5) != 0)).dropDuplicates(["doc_id"])
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    rows = texts_of(docs).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "text", "label")
    blob = rows.repartition(1).mapInArrow(_fit, "weights binary").collect()  # a bounded sample in, one vector of fixed size out
    return np.frombuffer(blob[0][0], "<f4") if blob else np.zeros(1 << BITS, np.float32)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, score (0 to 1) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value.astype(np.float64)
        for batch in batches:
            for at, end, chunk in chunks(batch):
                doc, slot, value = features(chunk)
                total = np.bincount(doc, weights=w[slot] * value, minlength=chunk.n)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), pa.array(1 / (1 + np.exp(-np.clip(total, -500, 500))), pa.float64())], ["doc_id", "score"])

    return texts_of(docs).mapInArrow(run, "doc_id long, score double")


#: A document whose score is less is taken for low quality.
THRESHOLD = 0.3


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= THRESHOLD)."""
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))

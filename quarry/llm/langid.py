"""Operator 13: language identification by sparse multinomial logistic
regression on TF-IDF character n-grams.

A text's letters (with their combining marks) are taken in lower case, all
between them is one separator; n-grams are 1 to 3 symbols long, separators
only at their ends, and hashed to ``2 ** BITS`` slots.  A slot's value is
(1 + log count) * idf, scaled to length one over the text; idf comes from
the document frequencies of *all* training texts, one vector of fixed size
summed by Spark.

The weights are learned by follow-the-regularised-leader updates of the
softmax loss, with L1 and L2 penalties, over at most ``TRAIN_ROWS`` training
texts (a documented bound; those whose hash of doc_id lies in their language's
share, about as many of each language), in one task, ``EPOCHS`` times.  Every ``CALIBRATE``-th of those is
not trained on: the temperature that divides all scores is the one of least
log loss there.  A text's score is the probability of its language.  Only
slots with a weight are kept, and all vectors are of fixed size.

Training texts are those whose lang isn't null and whose crc32(doc_id) mod 3
isn't 1.  Null texts and texts without a letter are ``und`` with score 0, as
are all texts where there is nothing to learn from; a null doc_id is neither
learned from nor held out; rows that repeat a doc_id are predicted each; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import CHUNK_BYTES, Chunk, chunks, mix64, texts_of

BITS = 18
TRAIN_ROWS, EPOCHS, CALIBRATE = 6_000, 2, 5
ALPHA, BETA, L1, L2 = 1.0, 0.5, 0.02, 0.01
UNKNOWN = "und"
SEPARATOR = 32

_TABLES: list[np.ndarray] = []


def symbol_tables() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: its symbol, and whether it is a letter."""
    if not _TABLES:
        symbol, letter = np.full(sys.maxunicode + 1, SEPARATOR, np.uint32), np.zeros(sys.maxunicode + 1, bool)
        for c in range(sys.maxunicode + 1):
            kind = unicodedata.category(x := chr(c))[0]
            if kind == "L":
                low = x.lower()
                symbol[c], letter[c] = ord(low) if len(low) == 1 else c, True
            elif kind == "M":
                symbol[c] = c
        _TABLES.extend((symbol, letter))
    return _TABLES[0], _TABLES[1]


def _runs(symbol: np.ndarray, before: int) -> np.ndarray:
    """Which symbols stay when separators in a row are one."""
    other = symbol != SEPARATOR
    keep = other.copy()
    keep[1:] |= other[:-1]
    if len(keep):
        keep[0] |= before != SEPARATOR
    return keep


def gram_slots(symbol: np.ndarray, known: int) -> tuple[np.ndarray, np.ndarray]:
    """(slot, place) of the n-grams that end at ``known`` or later; the place
    is that of a letter of the n-gram."""
    s = symbol.astype(np.uint64)
    other = symbol != SEPARATOR
    at = known + np.flatnonzero(other[known:])
    two = np.arange(max(known, 1), len(s))
    three = np.arange(max(known, 2), len(s))
    three = three[other[three - 1]]
    code = np.concatenate([s[at], s[two - 1] | s[two] << np.uint64(21), s[three - 2] | s[three - 1] << np.uint64(21) | s[three] << np.uint64(42)])
    place = np.concatenate([at, np.where(other[two], two, two - 1), three - 1])
    return mix64(code + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS), place


def _code_points(buf: np.ndarray) -> np.ndarray:
    return np.frombuffer(buf.tobytes().decode().encode("utf-32-le"), "<u4")


def _counted_long(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """(slots, counts, whether there is a letter) of one text, read in pieces."""
    symbols, letters = symbol_tables()
    total, lettered = np.zeros(1 << BITS, np.int64), False
    held, at = np.array([SEPARATOR], np.uint32), 0
    while at < len(buf):
        end = min(at + CHUNK_BYTES, len(buf))
        while end < len(buf) and buf[end] & 0xC0 == 0x80:
            end += 1
        points = _code_points(buf[at:end])
        lettered = lettered or bool(letters[points].any())
        new = symbols[points]
        if end == len(buf):
            new = np.append(new, np.uint32(SEPARATOR))
        line = np.concatenate([held, new[_runs(new, int(held[-1]))]])
        total += np.bincount(gram_slots(line, len(held))[0].astype(np.int64), minlength=1 << BITS)
        held, at = line[-2:], end
    slots = np.flatnonzero(total)
    return slots, total[slots], lettered


def counted(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, slot, count) of the n-grams, ordered by document and slot,
    and whether each document has a letter."""
    if chunk.n == 1 and len(chunk.buf) > 2 * CHUNK_BYTES:
        slots, count, lettered = _counted_long(chunk.buf)
        return np.zeros(len(slots), np.int64), slots, count, np.array([lettered])
    symbols, letters = symbol_tables()
    points = _code_points(chunk.buf)
    passed = np.zeros(len(chunk.buf) + 1, np.int64)
    np.cumsum((chunk.buf & 0xC0) != 0x80, out=passed[1:])
    off = passed[chunk.off]
    size = np.diff(off)
    lettered = np.bincount(np.repeat(np.arange(chunk.n), size), letters[points], chunk.n) > 0
    line = np.insert(symbols[points], off, SEPARATOR)  # before each document and after the last
    doc = np.insert(np.repeat(np.arange(chunk.n), size), off, 0)
    keep = _runs(line, SEPARATOR)
    keep[0] = True
    line, doc = line[keep], doc[keep]
    slots, place = gram_slots(line, 1)
    key = np.sort(doc[place].astype(np.uint64) << np.uint64(BITS) | slots)
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(key)))
    key = key[first].astype(np.int64)
    return key >> BITS, key & ((1 << BITS) - 1), count, lettered


def weighted(doc: np.ndarray, slot: np.ndarray, count: np.ndarray, n: int, idf: np.ndarray) -> np.ndarray:
    """The values of the counted slots, of length one in each document."""
    value = (1 + np.log(count)) * idf[slot]
    norm = np.sqrt(np.bincount(doc, value * value, n))
    return value / norm[doc]


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """(number of texts, texts that hold each slot)"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << BITS) + 1, np.int64)  # the last counts texts
        for batch in batches:
            for _, _, chunk in chunks(batch):
                total[:-1] += np.bincount(counted(chunk)[1], minlength=1 << BITS)
                total[-1] += chunk.n
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], ["slot", "n"])

    out = np.zeros((1 << BITS) + 1, np.int64)
    for r in texts_of(docs).mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():  # 2 ** BITS + 1 rows at most
        out[r["slot"]] = r["n"]
    return int(out[-1]), out[:-1]


@dataclass
class Model:
    """Weights of the slots that have any (``row`` of a slot, 0 for none),
    a last row for the intercept, and the temperature."""

    langs: list[str] = field(default_factory=list)
    idf: np.ndarray = field(default_factory=lambda: np.ones(1 << BITS, np.float32))
    row: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS, np.int32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((2, 0), np.float32))
    temperature: float = 1.0

    def predict(self, chunk: Chunk) -> tuple[list[str], np.ndarray]:
        """Language and score of each document."""
        doc, slot, count, lettered = counted(chunk)
        lang, score = [UNKNOWN] * chunk.n, np.zeros(chunk.n)
        if self.langs:
            value = weighted(doc, slot, count, chunk.n, self.idf)
            row = self.row[slot]
            some = np.flatnonzero(row)
            logits = np.stack([np.bincount(doc[some], value[some] * w[row[some]], chunk.n) for w in self.weights.T], 1) + self.weights[-1]
            p = softmax(logits / self.temperature)
            best = p.argmax(1)
            for k in np.flatnonzero(lettered).tolist():
                lang[k], score[k] = self.langs[best[k]], p[k, best[k]]
        return lang, score


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Ftrl:
    """Follow the regularised leader for ``classes`` softmax outputs, per
    coordinate, with elastic-net penalties."""

    def __init__(self, size: int, classes: int, l1: float = L1, l2: float = L2):
        self.z, self.n, self.l1, self.l2 = np.zeros((size, classes)), np.zeros((size, classes)), l1, l2

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((BETA + np.sqrt(n)) / ALPHA + self.l2))

    def update(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        error = softmax(x @ w)
        error[label] -= 1
        g, n = x[:, None] * error, self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def log_loss(logits: np.ndarray, labels: np.ndarray, temperature: float) -> float:
    """Mean log loss, with one row's weight spread over all languages, so
    that rows which are all right don't ask for a temperature of zero."""
    loss = -np.log(np.maximum(softmax(logits / temperature), 1e-300))
    spread = 1 / (len(labels) + 1)
    return float((1 - spread) * loss[np.arange(len(labels)), labels].mean() + spread * loss.mean())


def calibrated(logits: np.ndarray, labels: np.ndarray, low: float = 0.05, high: float = 20.0) -> float:
    """The temperature of least log loss (1 without rows): golden section
    over its logarithm."""
    if not len(labels):
        return 1.0
    a, b, ratio = np.log(low), np.log(high), (np.sqrt(5) - 1) / 2
    while b - a > 1e-3:
        x, y = b - ratio * (b - a), a + ratio * (b - a)
        if log_loss(logits, labels, np.exp(x)) <= log_loss(logits, labels, np.exp(y)):
            b = y
        else:
            a = x
    return float(np.exp((a + b) / 2))


def fitted(rows: list[tuple[np.ndarray, np.ndarray, int]], langs: list[str], idf: np.ndarray) -> Model:
    """The model of ``rows`` (slots, values, number of the language)."""
    used = np.unique(np.concatenate([s for s, _, _ in rows]))
    row = np.zeros(1 << BITS, np.int32)
    row[used] = np.arange(1, len(used) + 1)
    rows = [(np.append(row[s], len(used) + 1), np.append(v, 1.0), y) for s, v, y in rows]
    train, rest = [r for k, r in enumerate(rows) if (k + 1) % CALIBRATE], rows[CALIBRATE - 1::CALIBRATE]
    model, order = Ftrl(len(used) + 2, len(langs)), np.random.default_rng(0)
    for _ in range(EPOCHS):
        for k in order.permutation(len(train)):
            model.update(*train[k])
    w = model.weights(slice(None))
    temperature = calibrated(np.array([v @ w[s] for s, v, _ in rest]).reshape(-1, len(langs)), np.array([y for *_, y in rest], np.int64))
    some = np.flatnonzero(w[1:-1].any(1)) + 1
    row = np.zeros(1 << BITS, np.int32)
    row[used[some - 1]] = np.arange(1, len(some) + 1)
    return Model(langs, idf, row, np.concatenate([np.zeros((1, len(langs))), w[some], w[-1:]]).astype(np.float32), temperature)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def sampled(known: DataFrame, rows: int) -> DataFrame:
    """The doc_id of ``rows`` at most, about as many of each language: those
    whose hash lies in the share of its rows that a language gives."""
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    langs = max(1, sizes.count())
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)).alias("place")
    shares = sizes.select("lang", (F.lit(float(1 << 40)) * max(1, rows // langs) / F.col("n")).alias("below"))
    return known.select("doc_id", "lang", place).join(shares, "lang").where("place < below").select("doc_id", "place").distinct() \
        .orderBy("place", "doc_id").limit(rows).select("doc_id")


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """The model of the training texts of ``docs``."""
    doc_id = F.col("doc_id").cast("long")
    known = docs.select(doc_id.alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")) \
        .where("doc_id IS NOT NULL AND lang IS NOT NULL").where(~held_out(F.col("doc_id")))
    rows = known.where("text IS NOT NULL")
    total, frequency = document_frequencies(rows)
    if not total:
        return Model()
    idf = (np.log((1 + total) / (1 + frequency)) + 1).astype(np.float32)
    sample = rows.join(F.broadcast(sampled(known, train_rows)), "doc_id", "left_semi").dropDuplicates(["doc_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            label = batch.column(2).to_pylist()
            ids = batch.column(0).to_pylist()
            for at, _, chunk in chunks(batch):
                doc, slot, count, _ = counted(chunk)
                value = weighted(doc, slot, count, chunk.n, idf).astype(np.float32)
                cut = np.searchsorted(doc, np.arange(chunk.n + 1)).tolist()
                found += [(ids[at + k], slot[a:b].astype(np.int32), value[a:b], label[at + k]) for k, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if a < b]
        if found:
            found.sort(key=lambda r: r[0])  # the same model whatever the order of the rows
            names = sorted({r[3] for r in found})
            number = {name: k for k, name in enumerate(names)}
            model = fitted([(s, v, number[y]) for _, s, v, y in found], names, idf)
            yield pa.RecordBatch.from_arrays([pa.array([names], pa.list_(pa.string())), pa.array([model.row.astype("<i4").tobytes()], pa.binary()), pa.array([model.weights.astype("<f4").tobytes()], pa.binary()), pa.array([model.temperature])], ["langs", "row", "weights", "temperature"])

    out = sample.select("doc_id", "text", "lang").repartition(1).mapInArrow(run, "langs array<string>, row binary, weights binary, temperature double").collect()  # a bounded sample in, one model out
    if not out:
        return Model()
    names = list(out[0]["langs"])
    return Model(names, idf, np.frombuffer(out[0]["row"], "<i4"), np.frombuffer(out[0]["weights"], "<f4").reshape(-1, len(names)), out[0]["temperature"])


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, chunk in chunks(batch):
                lang, score = shared.value.predict(chunk)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    return texts_of(docs).mapInArrow(run, "doc_id long, lang_pred string, score double")


def languages(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row."""
    return predicted(docs, train(docs, train_rows)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")

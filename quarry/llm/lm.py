"""Operator 3: scoring with a gated recurrent language model.

Text in lower case A-Z is split into words ``[^\\x20\\x09-\\x0D]+``; one end
token follows.  Training documents (crc32 of doc_id mod 7 other than 2) are
counted whole; the ``VOCABULARY`` most frequent words are the network's, and
all others are its one rare word.

The network is a minimal gated unit of ``HIDDEN`` cells.  Its output is
factored: a softmax over classes (runs of words of similar frequency, and
the rare class), then a softmax over the words of the class.  A word of the
rare class has its smoothed share (c + 1) / (sum of (c + 1) over rare words
+ 1) of it, so every word, unseen ones included, has a probability.  Every
task trains a copy on its own training documents, all of them, by
backpropagation truncated to ``WINDOW`` steps and Adagrad, with the state
carried from window to window; the copies are averaged with their tokens as
weights, parameter block by parameter block.  Scoring reads every document
whole, many side by side, with the state carried through each one.

Counts of the ``KNOWN`` most frequent words (a documented bound) go to all
tasks; those of the other words are joined.  Nothing else is broadcast but
the parameters, whose size is fixed.

Null and empty texts are the end token alone; repeated rows are scored
each; with no training document the network is its uniform start; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import chunks, texts_of, written

FOLDS, HELD_OUT = 7, 2
VOCABULARY, KNOWN = 4096, 1 << 19
HIDDEN, CLASSES, WINDOW = 16, 48, 32
#: Documents side by side, in training and scoring.
TRAIN_LANES, SCORE_LANES = 512, 512
#: Steps whose outputs are scored together.
SCORE_STEPS = 64
RATE = 0.1
#: Updates that a chunk of text is to give, where its size allows.
STEPS = 250
#: Bytes of text that are trained on or scored together.
TEXT_BYTES = 24 << 20
#: The end token: no word holds a space.
END = b" "
BLOCK = 4096


def words_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, flat, in Arrow, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.binary()).view(pa.string())))
    words, sizes = lists.flatten(), np.diff(lists.offsets.to_numpy())
    some = pc.greater(pc.binary_length(words), 0)  # white space at an end leaves an empty one
    first = np.append(0, np.cumsum(some.to_numpy(zero_copy_only=False)))
    end = np.cumsum(sizes)
    return words.filter(some).view(pa.binary()), first[end] - first[end - sizes]


class Shape:
    """The model's words in order of frequency, and their classes."""

    def __init__(self, counts: np.ndarray, rare: float):
        """``counts``: of the model's words, falling; ``rare``: of all others."""
        self.n = len(counts)
        share = np.sqrt(counts + 1.0)
        cut = np.minimum((np.cumsum(share) - share / 2) / share.sum() * CLASSES, CLASSES - 1).astype(np.int64)
        _, first = np.unique(cut, return_index=True)
        self.first = np.append(first, self.n)
        self.class_of = np.repeat(np.arange(len(first)), np.diff(self.first))
        self.rare_class = len(first)
        self.class_of = np.append(self.class_of, self.rare_class)
        self.counts, self.rare = counts, rare
        self.sizes = {"inputs": (self.n + 2, 2 * HIDDEN), "recur": (HIDDEN, 2 * HIDDEN), "class_w": (HIDDEN, self.rare_class + 1),
                      "class_b": (self.rare_class + 1,), "word_w": (self.n, HIDDEN), "word_b": (self.n,)}

    def start(self) -> dict[str, np.ndarray]:
        """Parameters that give each word its frequency."""
        r = np.random.default_rng(7)
        spread = {"inputs": 0.3, "recur": 0.1}
        p = {k: (r.standard_normal(s) * spread.get(k, 0.0)).astype(np.float32) for k, s in self.sizes.items()}
        mass = np.append(np.add.reduceat(self.counts + 1.0, self.first[:-1]), self.rare + 1.0)
        p["class_b"] = np.log(mass / mass.sum()).astype(np.float32)
        p["word_b"] = np.log((self.counts + 1.0) / mass[self.class_of[:-1]]).astype(np.float32)
        p["inputs"][:, :HIDDEN] += 1.0  # gates start open to the past
        return p

    def flat(self, p: dict[str, np.ndarray]) -> np.ndarray:
        return np.concatenate([p[k].ravel() for k in self.sizes])

    def unflat(self, x: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for k, s in self.sizes.items():
            n = int(np.prod(s))
            out[k] = x[at:at + n].reshape(s).astype(np.float32)
            at += n
        return out


class Lanes:
    """Documents dealt to lanes of about equal length, longest lane first;
    flat arrays hold lane after lane."""

    def __init__(self, lengths: np.ndarray, n: int):
        order = np.argsort(-lengths, kind="stable")
        heap = [(0, k) for k in range(min(n, len(lengths)))]
        lane = np.zeros(len(lengths), np.int64)
        total = np.zeros(len(heap), np.int64)
        for d in order.tolist():
            load, k = heapq.heappop(heap)
            lane[d] = k
            heapq.heappush(heap, (load + int(lengths[d]), k))
        np.add.at(total, lane, lengths)
        by_load = np.argsort(-total, kind="stable")
        rank = np.empty_like(by_load)
        rank[by_load] = np.arange(len(by_load))
        self.order = np.argsort(rank[lane], kind="stable")  # documents in lane order
        self.total = total[by_load]
        self.start = np.cumsum(self.total) - self.total
        self.steps = int(self.total.max()) if len(total) else 0

    def active(self, t: np.ndarray) -> np.ndarray:
        return np.searchsorted(-self.total, -t, side="left")


def _exponentials(x: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """The sums of exponentials of the rows of ``x``, which become those, and
    their logs; no x is above ``bound``."""
    top = x.max() if bound > 60 else 0  # else no sum overflows
    if top > 60:
        x -= top
    else:
        top = np.float32(0)
    np.exp(x, out=x)
    total = np.maximum(x @ np.ones(x.shape[1], x.dtype), np.float32(1e-37))
    return total, np.log(total) + top


class Network:
    """States are columns, so that gates and candidates are whole rows; a last
    1 in each state stands for the biases of the outputs."""

    def __init__(self, shape: Shape, p: dict[str, np.ndarray]):
        self.shape, self.p = shape, dict(p)
        self.classes = np.concatenate([p["class_w"], p["class_b"][None]])
        self.words = np.concatenate([p["word_w"], p["word_b"][:, None]], 1)
        self.p["class_w"], self.p["class_b"] = self.classes[:HIDDEN], self.classes[HIDDEN]
        self.p["word_w"], self.p["word_b"] = self.words[:, :HIDDEN], self.words[:, HIDDEN]
        self.sums = {k: np.full_like(v, 1e-3) for k, v in p.items()}

    def run(self, inputs: np.ndarray, targets: np.ndarray, lanes: Lanes, learn: bool) -> np.ndarray:
        """Log-probability (natural) of each target; ``inputs`` and
        ``targets`` are lane after lane, the last input id starts a text."""
        out = np.zeros(len(targets))
        kind = self.p["recur"].dtype
        state, begin = np.zeros((HIDDEN, len(lanes.total)), kind), self.shape.n + 1
        span = WINDOW if learn else SCORE_STEPS
        for t0 in range(0, lanes.steps, span):
            times = np.arange(t0, min(t0 + span, lanes.steps))
            active = lanes.active(times).tolist()
            cut = [0, *np.cumsum(active).tolist()]
            where = np.concatenate([lanes.start[:n] + t for n, t in zip(active, times, strict=True)])
            word = inputs[where]
            x = np.ascontiguousarray(self.p["inputs"][word].T)
            starts = word == begin
            recur = np.ascontiguousarray(self.p["recur"].T)
            rows, steps = np.ones((len(where), HIDDEN + 1), kind), []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                h, fresh = state[:, :b - a], starts[a:b]
                if fresh.any():
                    h = h * ~fresh
                else:
                    fresh = None
                g = recur @ h
                gate = g[:HIDDEN]
                gate += x[:HIDDEN, a:b]
                np.negative(gate, out=gate)
                np.exp(gate, out=gate)
                gate += 1
                np.reciprocal(gate, out=gate)
                new = gate * g[HIDDEN:]
                new += x[HIDDEN:, a:b]
                np.tanh(new, out=new)
                after = h - new
                after *= gate
                after += new
                if learn:
                    steps.append((h, fresh, g[HIDDEN:], gate, new))
                rows[a:b, :HIDDEN] = after.T
                state = after
            lp, dh, grads = self._output(rows, targets[where], learn)
            out[where] = lp
            if learn:
                self._backward(steps, cut, word, np.ascontiguousarray(dh.T), grads)
        return out

    def _output(self, h: np.ndarray, target: np.ndarray, learn: bool):
        s = self.shape
        kind = s.class_of[target].astype(np.int16)
        order = np.argsort(kind, kind="stable")  # by class
        h, target, kind = h[order], target[order], kind[order]
        cut = np.searchsorted(kind, np.arange(s.rare_class + 1)).tolist()
        rows = np.arange(len(h))
        # no state is above 1
        bound = float(np.abs(self.classes).sum(0).max())
        scores = h @ self.classes
        lp = scores[rows, kind].astype(np.float64)
        total, log_sum = _exponentials(scores, bound)
        lp -= log_sum
        dh, grads = None, None
        scale = np.float32(1 / np.sqrt(len(h)))
        if learn:
            scores *= (scale / total)[:, None]
            scores[rows, kind] -= scale
            dh = scores @ self.classes[:HIDDEN].T
            classes, words = h.T @ scores, np.zeros_like(self.words)
        bound = float(np.abs(self.words).sum(1).max(initial=0))
        for c in range(s.rare_class):
            a, b = s.first[c], s.first[c + 1]
            i, j = cut[c], cut[c + 1]
            if i == j or b - a == 1:
                continue
            hc, w, r = h[i:j], target[i:j] - a, rows[:j - i]
            scores = hc @ self.words[a:b].T
            lp[i:j] += scores[r, w]
            total, log_sum = _exponentials(scores, bound)
            lp[i:j] -= log_sum
            if learn:
                scores *= (scale / total)[:, None]
                scores[r, w] -= scale
                np.matmul(scores.T, hc, out=words[a:b])
                dh[i:j] += scores @ self.words[a:b, :HIDDEN]
        back = np.empty_like(order)
        back[order] = rows
        if learn:
            dh = dh[back]
            grads = {"class_w": classes[:HIDDEN], "class_b": classes[HIDDEN], "word_w": words[:, :HIDDEN], "word_b": words[:, HIDDEN]}
        return lp[back], dh, grads

    def _backward(self, steps, cut, word, dh, grads) -> None:
        later = dh[:, :0]
        d_in, d_rec = np.empty((2 * HIDDEN, len(word)), dh.dtype), np.empty((2 * HIDDEN, len(word)), dh.dtype)
        for k in range(len(steps) - 1, -1, -1):
            h, fresh, hn, gate, new = steps[k]
            a, b = cut[k], cut[k + 1]
            d = dh[:, a:b]
            d[:, :later.shape[1]] += later
            shut = 1 - gate
            d_new = new * new
            np.subtract(1, d_new, out=d_new)
            d_new *= d
            d_new *= shut
            d_gate = h - new
            d_gate *= d
            d_gate += d_new * hn
            shut *= gate
            d_gate *= shut
            d_in[:HIDDEN, a:b], d_in[HIDDEN:, a:b] = d_gate, d_new
            d_rec[:HIDDEN, a:b] = d_gate
            np.multiply(d_new, gate, out=d_rec[HIDDEN:, a:b])
            later = self.p["recur"] @ d_rec[:, a:b]
            later += d * gate
            if fresh is not None:
                later *= ~fresh
        grads["recur"] = np.concatenate([x[0] for x in steps], 1) @ d_rec.T
        order = np.argsort(word.astype(np.int16 if self.shape.n < 32000 else np.int32), kind="stable")
        by_word = word[order]
        first = np.flatnonzero(np.append(True, by_word[1:] != by_word[:-1]))
        self._step("inputs", by_word[first], np.add.reduceat(np.ascontiguousarray(d_in.T)[order], first))
        for k in ("recur", "class_w", "class_b", "word_w", "word_b"):
            self._step(k, slice(None), grads[k])

    def _step(self, name: str, rows, g: np.ndarray) -> None:
        s = self.sums[name][rows] + g * g
        self.sums[name][rows] = s
        self.p[name][rows] -= RATE * g / np.sqrt(s)


def train_lanes(tokens: int) -> int:
    """As many lanes as leave some ``STEPS`` updates, 8 to TRAIN_LANES."""
    return min(max(tokens // (WINDOW * STEPS), 8), TRAIN_LANES)


class Words:
    """Ids of words: below ``shape.n`` the model's own, then other words
    whose counts are known; -1 for all the rest."""

    def __init__(self, words: list[bytes], counts: np.ndarray, shape: Shape):
        self.words = pa.array(words, pa.binary())
        self.end = words.index(END) if END in words else -1
        self.counts, self.shape = counts, shape

    def read(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Ids of all texts' words and ends, flat; tokens of each text; the
        lists of its words without an id."""
        words, sizes = words_of(texts)
        found = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False)
        lengths = sizes + 1
        ids = np.full(int(lengths.sum()), self.end, np.int32)
        inner = np.ones(len(ids), bool)
        inner[np.cumsum(lengths) - 1] = False
        ids[inner] = found
        lost = found < 0
        offsets = np.append(0, np.cumsum(lost))[np.append(0, np.cumsum(sizes))].astype(np.int32)
        return ids, lengths, pa.ListArray.from_arrays(offsets, words.filter(pa.array(lost)))

    def run(self, network: Network, ids: np.ndarray, lengths: np.ndarray, n_lanes: int, learn: bool) -> np.ndarray:
        """Log-probability of each token, in the order of ``ids``."""
        n = self.shape.n
        target = np.where((ids < 0) | (ids >= n), n, ids)
        lanes = Lanes(lengths, n_lanes)
        first = np.cumsum(lengths) - lengths
        size = lengths[lanes.order]
        place = np.repeat(first[lanes.order] - (np.cumsum(size) - size), size) + np.arange(len(ids))
        flat = target[place]
        before = np.empty_like(flat)
        before[1:] = flat[:-1]
        before[np.cumsum(size) - size] = n + 1
        out = np.empty(len(ids))
        out[place] = network.run(before, flat, lanes, learn)
        return out


def _bytes(chunk) -> list[bytes]:
    return [chunk.bytes_of(k) for k in range(chunk.n)]


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def count_words(docs: DataFrame) -> DataFrame:
    """word (binary), c: of all texts of ``docs`` and their ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, chunk in chunks(batch, TEXT_BYTES):
                seen = pc.value_counts(words_of(_bytes(chunk))[0])
                words = pa.concat_arrays([seen.field("values"), pa.array([END], pa.binary())])
                yield pa.RecordBatch.from_arrays([words, pa.concat_arrays([seen.field("counts"), pa.array([chunk.n], pa.int64())])], ["word", "c"])

    return texts_of(docs).mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def most_frequent(counts: DataFrame, limit: int) -> tuple[list[bytes], np.ndarray]:
    """The words of the highest counts, as many whole counts as ``limit``
    words allow, and their counts, falling.  The number of different counts
    is below the root of twice all tokens, so no task sorts all words."""
    levels = counts.groupBy("c").agg(F.count(F.lit(1)).alias("n")).toArrow()
    levels = sorted(zip(levels.column("c").to_pylist(), levels.column("n").to_pylist(), strict=True), reverse=True)
    least, room = None, limit
    for c, n in levels:
        room -= n
        if room < 0:
            break
        least = c
    if least is None:
        return [], np.zeros(0, np.int64)
    top = counts.where(F.col("c") >= least).toArrow()
    rows = sorted(zip(top.column("c").to_pylist(), top.column("word").to_pylist(), strict=True), key=lambda r: (-r[0], r[1]))
    return [w for _, w in rows], np.array([c for c, _ in rows], np.int64)


def _sums(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    """One row of the sum of a block's copies."""
    values = np.zeros(0)
    for blob in group.column("values"):
        part = np.frombuffer(blob.as_buffer(), "<f4").astype(np.float64)
        values = part if not len(values) else values + part
    return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "weight": pa.array([sum(group.column("weight").to_pylist())], pa.float64()), "values": pa.array([values.astype("<f4").tobytes()], pa.binary())})


def train(docs: DataFrame, shared) -> np.ndarray:
    """The averaged parameters of the copies that every task trains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(*shared.value)
        network, seen = Network(words.shape, words.shape.start()), 0
        for batch in batches:
            for _, _, chunk in chunks(batch, TEXT_BYTES):
                ids, lengths, _ = words.read(_bytes(chunk))
                words.run(network, ids, lengths, train_lanes(len(ids)), True)
                seen += len(ids)
        if seen:
            flat = words.shape.flat(network.p) * np.float32(seen)
            parts = [flat[k:k + BLOCK].astype("<f4").tobytes() for k in range(0, len(flat), BLOCK)]
            pid = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array(range(len(parts)), pa.int64()), pa.array([pid % 64] * len(parts), pa.int64()), pa.array([float(seen)] * len(parts), pa.float64()), pa.array(parts, pa.binary())], ["block", "part", "weight", "values"])

    kind = "block long, weight double, values binary"
    copies = texts_of(docs).mapInArrow(run, "block long, part long, weight double, values binary")
    blocks = copies.groupBy("block", "part").applyInArrow(_sums, kind).groupBy("block").applyInArrow(_sums, kind).collect()  # of fixed size
    if not blocks:
        return np.zeros(0, np.float32)
    return np.concatenate([np.frombuffer(b["values"], "<f4") / b["weight"] for b in sorted(blocks, key=lambda b: b["block"])]).astype(np.float32)


def score(docs: DataFrame, vocabulary: int = VOCABULARY, known: int = KNOWN) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score
    (add-one unigram) and score (the network's), log10."""
    spark = docs.sparkSession
    is_held = fold(F.col("doc_id").cast("long")) == HELD_OUT
    training = docs.where(F.coalesce(~is_held, F.lit(True)))
    counts = written(count_words(training), "counts")
    total, types = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    words, c = most_frequent(counts, known)
    if END not in words[:vocabulary]:  # the network always has the end token
        at = words.index(END) if END in words else len(words)
        c = np.insert(np.delete(c, at) if at < len(words) else c, 0, c[at] if at < len(words) else 0)
        words = [END, *(w for w in words if w != END)]
    n = min(vocabulary, len(words))
    shape = Shape(c[:n], float(total - c[:n].sum()))
    rare_total = float(total - c[:n].sum() + max(types - n, 0) + 1)
    shared = spark.sparkContext.broadcast((words, c, shape))
    trained = train(training, shared)
    weights = spark.sparkContext.broadcast(trained if len(trained) else shape.flat(shape.start()))
    log_rare, log_base = np.log10(rare_total), np.log10(total + types + 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Words(*shared.value)
        network = Network(own.shape, own.shape.unflat(weights.value))
        row = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at, end, chunk in chunks(batch, TEXT_BYTES):
                ids, lengths, unknown = own.read(_bytes(chunk))
                first = np.cumsum(lengths) - lengths
                lp = own.run(network, ids, lengths, SCORE_LANES, False) / np.log(10)
                has = ids >= 0
                log_c = np.where(has, np.log10(own.counts[np.maximum(ids, 0)] + 1.0), 0.0)
                lp += np.where((ids >= own.shape.n) | ~has, log_c - log_rare, 0.0)
                in_counts = has & (own.counts[np.maximum(ids, 0)] > 0)
                sums = [np.add.reduceat(x, first) for x in (in_counts.astype(np.int64), log_c - log_base, lp)]
                columns = [pa.array(row + np.arange(chunk.n), pa.int64()), batch.column(0).slice(at, end - at), pa.array(lengths, pa.int64()), *map(pa.array, sums), unknown]
                row += chunk.n
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_tokens", "n_known", "base_score", "score", "unknown"])

    scored = written(texts_of(docs).mapInArrow(run, "row long, doc_id long, n_tokens long, n_known long, base_score double, score double, unknown array<binary>"), "scored")
    others = scored.select("row", F.explode("unknown").alias("word")).join(counts, "word", "left").groupBy("row") \
        .agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("more"), F.count("c").alias("known_more"))
    more = F.coalesce("more", F.lit(0.0))
    return scored.join(others, "row", "left").select(
        "doc_id", F.coalesce(is_held, F.lit(False)).alias("held_out"), "n_tokens", (F.col("n_known") + F.coalesce("known_more", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"), (F.col("base_score") + more).alias("base_score"), (F.col("score") + more).alias("score"))

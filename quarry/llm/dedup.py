"""Operator 5: exact removal of repeated strings by suffix arrays.

Each byte of a document that lies in a ``LENGTH``-byte string which also
starts in a document with a smaller doc_id is removed, in four steps over
blocks of documents (written once, bucketed by block, so that texts are
never shuffled):

1. Anchors.  Of the ``K``-byte strings in each ``LENGTH``-byte window the
   one of least hash is an anchor, so equal windows have equal anchors.
   Blocks ask by hash bucket which of their anchors other blocks or two
   documents have; the answer is a bit each.
2. Contexts.  A shared anchor's context is every window that holds it.  For
   equal contexts (by hash) all but the least doc_id are covered whole; an
   anchor with one context only needs no more.
3. Suffix arrays.  Where an anchor has several contexts, the least document
   of each sends the context's bytes.  A task sorts all suffixes of its
   contexts in two stages and computes adjacent common prefixes; runs of
   prefixes of LENGTH bytes or more are equal strings, and each but those
   of the run's least document is covered.  An anchor with more contexts
   than one array holds (``HOT``) is not sorted in one task: its windows
   are compared as rows, aggregated by their 128-bit hash.
4. Cut.  Blocks put covered windows together and remove them.

Strings are bytes of UTF-8 and never cross documents; what is removed is
judged on the input.  Null and empty texts have no bytes; rows that repeat
a doc_id are no smaller than each other, so they cover nothing of one
another; a null doc_id is neither smaller nor larger than any, so its text
stays whole and covers nothing; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import chunks, mix64, occurrences, shared_dir, signed, span_hashes, texts_of, written
from quarry.llm.suffixes import common_prefixes, suffix_array, symbols

LENGTH, K = 50, 24
SIDE = LENGTH - K  # bytes of context on either side of an anchor
BLOCK_BYTES = 1 << 20
#: Text bytes per hash bucket of anchors, and context bytes per suffix array.
BUCKET_BYTES, ARRAY_BYTES = 16 << 20, 3 << 19
#: An anchor with more contexts than one array holds is compared as rows.
HOT = ARRAY_BYTES // (LENGTH + SIDE)


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (least or greatest) over each ``width`` neighbours."""
    n, y = 1, x
    while 2 * n <= width:
        y = pick(y[:-n], y[n:])
        n *= 2
    return pick(y[:len(y) - (width - n)], y[width - n:]) if width > n else y


def anchors(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all windows within documents."""
    n = len(buf)
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    raw = np.concatenate([buf, np.zeros(8, np.uint8)])
    word = np.ndarray((n,), "<u8", raw, 0, (1,))
    m = n - K + 1
    h = word[:m] * np.uint64(0x9E3779B97F4A7C15)
    for j in range(8, K, 8):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + word[j:j + m]
    h = np.maximum(mix64(h), np.uint64(1))
    least = _slide(h, SIDE + 1, np.minimum)  # of each window
    for b in off[1:-1].tolist():  # windows that cross documents have none
        least[max(0, b - LENGTH + 1):b] = 0
    none = np.zeros(SIDE, np.uint64)
    at = np.flatnonzero(_slide(np.concatenate([none, least, none]), SIDE + 1, np.maximum) == h)
    return at, h[at]


def pack(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each value."""
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(data: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


class Block:
    """Documents of a block, and their anchors in all steps the same."""

    def __init__(self, ids: np.ndarray, off: np.ndarray, buf: np.ndarray, buckets: int, null: np.ndarray | None = None):
        self.ids, self.off, self.buf, self.buckets = ids, off, buf, buckets
        self.null = np.zeros(len(ids), bool) if null is None else null
        self.at, self.hash = anchors(buf, off)
        self.doc = np.searchsorted(off, self.at, side="right") - 1
        if self.null.any():  # texts without an id take no part
            mine = ~self.null[self.doc]
            self.at, self.hash, self.doc = self.at[mine], self.hash[mine], self.doc[mine]

    def bucket(self, h: np.ndarray) -> np.ndarray:
        return ((h >> np.uint64(40)) * np.uint64(self.buckets) >> np.uint64(24)).astype(np.int64)

    def asked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct hashes by bucket, where buckets begin, and whether two
        documents of this block share the hash."""
        if not len(self.at):
            return self.hash, np.zeros(self.buckets + 1, np.int64), np.zeros(0, bool)
        order = np.lexsort((self.doc, self.hash))
        h, d = self.hash[order], self.doc[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(h)) - 1
        h, several = h[first], self.ids[d[first]] != self.ids[d[last]]
        return h, np.searchsorted(self.bucket(h), np.arange(self.buckets + 1)), several  # buckets rise with hashes

    def keep_shared(self, answers: dict[int, bytes]) -> None:
        """Keep the anchors that other documents have, with their contexts."""
        h, cut, several = self.asked()
        bits = [np.unpackbits(np.frombuffer(answers[b], np.uint8), count=cut[b + 1] - cut[b]) if b in answers else np.zeros(cut[b + 1] - cut[b], np.uint8) for b in range(self.buckets)]
        shared = h[several | (np.concatenate(bits) > 0)] if bits else h
        mine = np.isin(self.hash, shared)
        self.at, self.hash, self.doc = self.at[mine], self.hash[mine], self.doc[mine]
        self.begin = np.maximum(self.at - SIDE, self.off[self.doc])
        self.end = np.minimum(self.at + K + SIDE, self.off[self.doc + 1])
        around = span_hashes(self.buf, self.begin, self.end) ^ mix64((self.at - self.begin).astype(np.uint64) * np.uint64(1000) + (self.end - self.at).astype(np.uint64))
        self.context = around >> np.uint64(16)
        # entries: distinct (hash, context), each with its least document
        own = self.ids[self.doc]
        order = np.lexsort((own, self.context, self.hash))
        h, c = self.hash[order], self.context[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
        first = np.flatnonzero(new)
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.lead = order[first]  # the anchor that stands for the entry
        self.e_hash, self.e_context, self.e_doc = h[first], c[first], own[order][first]
        self.e_cut = np.searchsorted(self.bucket(self.e_hash), np.arange(self.buckets + 1))


def _blocks(docs: DataFrame, whole: bool) -> DataFrame:
    """block, ids, null, off, data, rest: written, bucketed by block.  ``null``:
    whether a doc_id is null; ``rest``: with ``whole`` all columns but the text, and whether that is null, as an
    Arrow stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            for at, end, chunk in chunks(batch, BLOCK_BYTES):
                rest = b""
                if whole:
                    sink = pa.BufferOutputStream()
                    part = pa.record_batch([batch.column(2).slice(at, end - at)], ["rest"])
                    with pa.ipc.new_stream(sink, part.schema) as out:
                        out.write_batch(part)
                    rest = sink.getvalue().to_pybytes()
                null = batch.column(0).slice(at, end - at).is_null().to_numpy(zero_copy_only=False)
                own = [chunk.ids.astype("<i8").tobytes(), null.astype(np.uint8).tobytes(), chunk.off.astype("<i8").tobytes(), chunk.buf.tobytes(), rest]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *(pa.array([x], pa.binary()) for x in own)], ["block", "ids", "null", "off", "data", "rest"])
                number += 1

    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       *[F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != "text"), F.col("text").isNull()).alias("rest")] * whole)
    name, n = f"llm_blocks_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.mapInArrow(run, "block long, ids binary, null binary, off binary, data binary, rest binary").write.bucketBy(n, "block") \
        .option("path", f"{shared_dir(spark)}/{name}").option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def _read(batch: pa.RecordBatch, buckets: int) -> Iterator[tuple[int, Block, int]]:
    for k in range(batch.num_rows):
        ids, null, off, buf = (np.frombuffer(batch.column(j)[k].as_buffer(), kind) for j, kind in ((1, "<i8"), (2, bool), (3, "<i8"), (4, np.uint8)))
        yield batch.column(0)[k].as_py(), Block(ids, off, buf, buckets, null), k


def _pairs(batch: pa.RecordBatch, name: str, k: int) -> dict:
    value = batch.column(batch.schema.get_field_index(name))[k].as_py()
    return {x["bucket"]: x["answer"] for x in value or ()}


def _answered(blocks: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """Each block with the answers of its buckets; blocks stay where they are."""
    own = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "answer")).alias(name))  # one for each bucket
    return blocks.join(own.hint("shuffle_hash"), "block", "left")


def _ask_anchors(blocks: DataFrame, buckets: int) -> DataFrame:
    """block, bucket, answer: a bit for each hash asked, whether other blocks have it."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, block, _ in _read(batch, buckets):
                h, cut, _ = block.asked()
                parts = [pack(h[a:b], 5) for a, b in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([number] * buckets, pa.int64()), pa.array(range(buckets), pa.int32()), pa.array(parts, pa.binary())], ["block", "bucket", "hashes"])

    def answer(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        parts = [unpack(x.as_py(), 5) for x in group.column("hashes")]
        several = occurrences(np.concatenate(parts))[1] > 1
        bits = [np.packbits(x).tobytes() for x in np.split(several, np.cumsum([len(p) for p in parts])[:-1])]
        return pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "answer": pa.array(bits, pa.binary())})

    return blocks.mapInArrow(ask, "block long, bucket int, hashes binary").groupBy("bucket").applyInArrow(answer, "block long, bucket int, answer binary")


NOTHING, COVERED, SEND, SEND_HOT = range(4)


def _ask_contexts(shared: DataFrame, buckets: int) -> DataFrame:
    """block, bucket, answer: a byte for each entry, what becomes of it."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, block, k in _read(batch, buckets):
                block.keep_shared(_pairs(batch, "shared", k))
                cut = block.e_cut
                rows = [b for b in range(buckets) if cut[b] < cut[b + 1]]
                part = lambda x, w: pa.array([pack(x[cut[b]:cut[b + 1]], w) for b in rows], pa.binary())  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(rows), pa.int64()), pa.array(rows, pa.int32()), part(block.e_hash, 5), part(block.e_context, 6), part(block.e_doc.view(np.uint64) ^ np.uint64(1 << 63), 8)], ["block", "bucket", "hashes", "contexts", "docs"])

    def answer(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        h, c, d = ([unpack(x.as_py(), w) for x in group.column(name)] for name, w in (("hashes", 5), ("contexts", 6), ("docs", 8)))
        size = [len(x) for x in h]
        h, c, d = np.concatenate(h), np.concatenate(c), np.concatenate(d)
        order = np.lexsort((d, c, h))
        hs, cs, ds = h[order], c[order], d[order]
        new_h = np.append(True, hs[1:] != hs[:-1])
        new_c = new_h | np.append(True, cs[1:] != cs[:-1])
        group_c, group_h = np.cumsum(new_c) - 1, np.cumsum(new_h) - 1
        of_h = np.bincount(group_h[new_c])[group_h]  # contexts of the anchor
        what = np.where(ds > ds[new_c][group_c], COVERED, np.where(of_h > HOT, SEND_HOT, np.where(of_h > 1, SEND, NOTHING))).astype(np.uint8)
        out = np.empty(len(order), np.uint8)
        out[order] = what
        return pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "answer": pa.array([x.tobytes() for x in np.split(out, np.cumsum(size)[:-1])], pa.binary())})

    kind = "block long, bucket int, answer binary"
    return shared.mapInArrow(ask, "block long, bucket int, hashes binary, contexts binary, docs binary").groupBy("bucket").applyInArrow(answer, kind)


def _fates(block: Block, answers: dict[int, bytes]) -> np.ndarray:
    return np.concatenate([np.frombuffer(answers[b], np.uint8) if b in answers else np.zeros(block.e_cut[b + 1] - block.e_cut[b], np.uint8) for b in range(block.buckets)])


def _sent(fated: DataFrame, buckets: int) -> DataFrame:
    """block, entry, doc, hash, hot, text: contexts to be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, block, k in _read(batch, buckets):
                block.keep_shared(_pairs(batch, "shared", k))
                fate = _fates(block, _pairs(batch, "fate", k))
                e = np.flatnonzero(fate >= SEND)
                lead = block.lead[e]
                data = block.buf.tobytes()
                text = [data[a:b] for a, b in zip(block.begin[lead].tolist(), block.end[lead].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(e), number), pa.int64()), pa.array(e, pa.int32()), pa.array(block.e_doc[e], pa.int64()), pa.array(signed(block.e_hash[e]), pa.int64()), pa.array(fate[e] == SEND_HOT, pa.bool_()), pa.array(text, pa.binary())], ["block", "entry", "doc", "hash", "hot", "text"])

    return fated.mapInArrow(run, "block long, entry int, doc long, hash long, hot boolean, text binary")


def covered_windows(texts: list[bytes], docs: np.ndarray) -> np.ndarray:
    """For each text a mask of its windows (bit k: that at byte k) which
    equal one of a text with a smaller document."""
    t, begin = symbols(texts)
    sa = suffix_array(t, LENGTH)
    prefix = common_prefixes(t, sa, LENGTH)
    text = np.searchsorted(begin, sa, side="right") - 1
    run = np.flatnonzero(prefix < LENGTH)
    least = np.minimum.reduceat(docs[text], run) if len(run) else docs[:0]
    hit = np.flatnonzero(docs[text] > np.repeat(least, np.diff(np.append(run, len(sa)))))
    masks = np.zeros(len(texts), np.int64)
    np.bitwise_or.at(masks, text[hit], np.int64(1) << (sa[hit] - begin[text[hit]]))
    return masks


def _masks(sent: DataFrame) -> DataFrame:
    """block, entry, mask of covered windows, by suffix arrays."""
    n = sent.where(~F.col("hot")).count()
    groups = max(1, -(-n * (LENGTH + SIDE + 1) // ARRAY_BYTES))

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        masks = covered_windows(group.column("text").to_pylist(), group.column("doc").to_numpy())
        some = np.flatnonzero(masks)
        return pa.table({"block": group.column("block").take(pa.array(some)), "entry": group.column("entry").take(pa.array(some)), "mask": pa.array(masks[some], pa.int64())})

    cold = sent.where(~F.col("hot")).withColumn("task", F.pmod(F.xxhash64("hash"), F.lit(groups)))
    masks = cold.groupBy("task").applyInArrow(run, "block long, entry int, mask long")
    windows = sent.where("hot").select("block", "entry", "doc", F.posexplode(F.transform(F.sequence(F.lit(1), F.octet_length("text") - (LENGTH - 1)), lambda k: F.substring("text", k, LENGTH))).alias("place", "window"))
    windows = windows.select("block", "entry", "doc", "place", F.xxhash64("window").alias("h1"), F.xxhash64(F.reverse(F.hex("window"))).alias("h2"))
    least = windows.groupBy("h1", "h2").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").select("h1", "h2", "least")
    hot = windows.join(least, ["h1", "h2"]).where("doc > least").groupBy("block", "entry").agg(F.expr("bit_or(shiftleft(1L, place))").alias("mask"))
    return masks.unionByName(hot)


def removed_bytes(block: Block, fate: np.ndarray, masks: dict[int, int]) -> np.ndarray:
    """Whether each byte of the block is removed."""
    change = np.zeros(len(block.buf) + 1, np.int64)
    whole = (fate[block.entry] == COVERED) | (block.ids[block.doc] > block.e_doc[block.entry])
    np.add.at(change, block.begin[whole], 1)
    np.add.at(change, block.end[whole], -1)
    if masks:
        of = np.zeros(len(fate), np.int64)
        of[list(masks)] = list(masks.values())
        part = np.flatnonzero(~whole & (of[block.entry] != 0))
        for k in range(SIDE + 1):
            at = block.begin[part[of[block.entry[part]] >> k & 1 == 1]] + k
            np.add.at(change, at, 1)
            np.add.at(change, at + LENGTH, -1)
    return np.cumsum(change[:-1]) > 0


def _judged(docs: DataFrame, whole: bool) -> tuple[DataFrame, int]:
    """Blocks with all answers, and the number of hash buckets."""
    blocks = _blocks(docs, whole)
    total = blocks.agg(F.coalesce(F.sum(F.octet_length("data")), F.lit(0))).first()[0]
    buckets = max(1, -(-total // BUCKET_BYTES))
    asking = blocks.select("block", "ids", "null", "off", "data")
    anchored = written(_ask_anchors(asking, buckets), "anchors")
    shared = _answered(asking, anchored, "shared")
    contexts = written(_ask_contexts(shared, buckets), "contexts")
    masks = written(_masks(written(_sent(_answered(shared, contexts, "fate"), buckets), "sent")), "masks")
    masks = masks.groupBy("block").agg(F.collect_list(F.struct("entry", "mask")).alias("masks"))  # of the block's own anchors
    judged = _answered(_answered(blocks, anchored, "shared"), contexts, "fate")
    return judged.join(masks.hint("shuffle_hash"), "block", "left"), buckets


def _cut(batch: pa.RecordBatch, buckets: int) -> Iterator[tuple[int, Block, np.ndarray]]:
    """(row, block, whether each of its bytes is removed)"""
    for _, block, k in _read(batch, buckets):
        block.keep_shared(_pairs(batch, "shared", k))
        found = {x["entry"]: x["mask"] for x in batch.column(batch.schema.get_field_index("masks"))[k].as_py() or ()}
        yield k, block, removed_bytes(block, _fates(block, _pairs(batch, "fate", k)), found)


def deduplicated(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    judged, buckets = _judged(docs, False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, block, gone in _cut(batch, buckets):
                rows = []
                for d, no, a, b in zip(block.ids.tolist(), block.null.tolist(), block.off[:-1].tolist(), block.off[1:].tolist(), strict=True):
                    g = gone[a:b]
                    spans = int(np.count_nonzero(g[1:] & ~g[:-1]) + g[:1].sum())
                    rows.append((None if no else d, b - a, int(g.sum()), spans, hashlib.sha256(block.buf[a:b][~g].tobytes()).hexdigest()))
                c = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in c[:4]), pa.array(c[4], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return judged.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def rewritten(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with what remains of their texts.
    Of a character that was cut nothing stays; null texts stay null."""
    judged, buckets = _judged(docs, True)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, block, gone in _cut(batch, buckets):
                rest = pa.ipc.open_stream(batch.column(batch.schema.get_field_index("rest"))[k].as_buffer()).read_all().combine_chunks().column("rest").chunk(0)
                *others, null = rest.flatten()
                texts = [None if no else block.buf[a:b][~gone[a:b]].tobytes().decode("utf-8", "ignore")
                         for a, b, no in zip(block.off[:-1].tolist(), block.off[1:].tolist(), null.to_pylist(), strict=True)]
                own = iter(others)
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else next(own) for c in names], names)

    kinds = ", ".join(f"`{f.name}` {'string' if f.name == 'text' else f.dataType.simpleString()}" for f in docs.schema)
    return judged.mapInArrow(run, kinds)

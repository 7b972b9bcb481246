"""Operator 2: near-duplicates by order MinHash.

Words are runs without white space, in lower case A-Z.  A document's k-mers
are its runs of ``K`` words, each labelled with how often it has occurred
in the document before (a shorter document is one k-mer).  Each of
``SKETCHES`` sketches takes the ``PICKED`` labelled k-mers of least hash
under its own permutation and keeps them in text order, so two documents
share a sketch only if they share those k-mers *and* their order: the
chance follows the edit similarity (about s ** PICKED for a share s of
common k-mers).  Documents that share a sketch are candidates; a candidate
pair is a near-duplicate when the edit similarity of its words, 1 -
distance / words of the longer one, is ``SIMILARITY`` or more by a banded
alignment.

Exact copies (equal words) are one class from the start and are sketched
once.  In a bucket of equal sketches each member first meets two centres,
the least doc_id and one picked by hash.  Pairs with a document's least
centre are verified first; the other centres only where the two are not in
one class yet.  Where the other members are of several classes, rounds go
on: ``GROWTH`` times as many of them as before are the round's centres, by
a hash salted with the bucket, and meet all members of other classes, until
the members left are one class or none.  So any two members of a bucket are
compared or in one class already.  A hot bucket's members are dealt out in
pieces of about ``PIECE``, its centres in blocks of as many; each piece meets
each block in a group of its own.

What unlike texts around one common passage share is the bucket alone, so
in the rounds two members are aligned only if nothing cheaper rules them
out.  ``PARITY`` bits tell which hash values of its words, labelled with
their occurrence, a text has an odd number of; a replaced word flips at most
two of them, a word more or less one.  So bits that differ and the difference
of the lengths are together at most twice the edits, and a pair beyond twice
the band is no near-duplicate for certain.  A piece of a bucket's members and
a block of its centres meet in one task and give the pairs that are left,
each in the first bucket alone that it could meet in.  The alignment keeps the band's
vertical differences as bits of two integers and moves down one diagonal a
word.  Classes are connected components of verified links.
Words travel as 32-bit hashes; nothing is collected.

Null and empty texts have no words and are one class; repeated rows have
one doc_id and so one class (of several texts with one doc_id any one is
read); rows with a null doc_id take no part and come back with null class
and copy; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import (Chunk, chunks, list_array, lower_ascii, mix64, occurrences, signed, span_hashes, texts_of,
                               word_spans, written)
from quarry.llm.components import components

K = 5
SIMILARITY = 0.8
SKETCHES, PICKED = 36, 2
#: Factor of a bucket's centres from round to round; members of one piece.
GROWTH, PIECE = 32, 1000
#: Bits of a text's signature.
PARITY = 4096
LAST = np.uint64(0xFFFFFFFFFFFFFFFF)


def sketches(chunk: Chunk, k: int = K, n_sketches: int = SKETCHES, picked: int = PICKED) -> dict[str, np.ndarray]:
    """n_words, two hashes of the words, and the sketches (documents x
    sketches) of each document."""
    starts, ends, doc = word_spans(chunk.buf, chunk.off)
    word = span_hashes(lower_ascii(chunk.buf), starts, ends)
    n_words = np.bincount(doc, minlength=chunk.n)
    first = np.cumsum(n_words) - n_words
    out = {"n_words": n_words, "h1": span_hashes(word, first, first + n_words), "h2": span_hashes(mix64(word ^ np.uint64(77)), first, first + n_words), "word": word}
    # k-mers: one for each document that has words, more for longer ones
    n_kmers = np.where(n_words > 0, np.maximum(n_words - k + 1, 1), 0)
    kmer_doc = np.repeat(np.arange(chunk.n), n_kmers)
    begin = np.cumsum(n_kmers) - n_kmers
    at = np.arange(len(kmer_doc)) - begin[kmer_doc] + first[kmer_doc]
    kmer = span_hashes(word, at, np.minimum(at + k, (first + n_words)[kmer_doc]))
    before, _ = occurrences(kmer ^ mix64(kmer_doc.astype(np.uint64) + np.uint64(1)))
    label = mix64(kmer + before.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    got = np.zeros((chunk.n, n_sketches), np.uint64)
    has = np.flatnonzero(n_kmers)
    if len(has):
        segment, size = begin[has], n_kmers[has]
        place = np.arange(len(label))
        for s in range(n_sketches):
            h = (label ^ mix64(np.uint64([s + 1]))) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
            chosen = []
            for _ in range(picked):
                least = np.minimum.reduceat(h, segment)
                hit = np.flatnonzero(h == np.repeat(least, size))
                where = np.full(len(has), len(label))  # the first place of the least hash; past the end when none is left
                np.minimum.at(where, np.searchsorted(segment, hit, side="right") - 1, place[hit])
                where[least == LAST] = len(label)
                chosen.append(where)
                h[where[where < len(label)]] = LAST
            order = np.sort(np.stack(chosen), axis=0)  # text order
            padded = np.append(label, np.uint64(0))
            value = np.full(len(has), s + 1, np.uint64)
            for row in order:
                value = mix64(value * np.uint64(31) + padded[row])
            got[has, s] = value
    return out | {"sketches": got}


def sketch_table(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, h1, h2, sketches of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, chunk in chunks(batch):
                x = sketches(chunk)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at), pa.array(x["n_words"], pa.int64()), pa.array(signed(x["h1"]), pa.int64()), pa.array(signed(x["h2"]), pa.int64()),
                     list_array(signed(x["sketches"].ravel()), np.full(chunk.n, SKETCHES), pa.int64())], ["doc_id", "n_words", "h1", "h2", "sketches"])

    return texts_of(docs).mapInArrow(run, "doc_id long, n_words long, h1 long, h2 long, sketches array<long>")


def parities(word: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` documents a bit for each value of the hash of an
    occurrence-labelled word: whether it has an odd number of such words."""
    before, _ = occurrences(word ^ mix64(doc.astype(np.uint64) + np.uint64(1)))
    label = mix64(word + before.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    key = np.sort((doc.astype(np.int64) * PARITY) + (label >> np.uint64(64 - PARITY.bit_length() + 1)).astype(np.int64))
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    odd = key[first][np.diff(np.append(first, len(key))) % 2 == 1]
    out = np.zeros((n, PARITY // 64), np.uint64)
    np.bitwise_or.at(out, (odd // PARITY, odd % PARITY // 64), np.uint64(1) << (odd % 64).astype(np.uint64))
    return out


def word_table(docs: DataFrame) -> DataFrame:
    """doc_id, words (the 32-bit hashes of a document's words), parity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, end, chunk in chunks(batch):
                starts, ends, doc = word_spans(chunk.buf, chunk.off)
                word = span_hashes(lower_ascii(chunk.buf), starts, ends)
                flat = (word >> np.uint64(32)).astype("<u4").tobytes()
                cut = np.searchsorted(doc, np.arange(chunk.n + 1)).tolist()
                words = pa.array([flat[4 * a:4 * b] for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())
                parity = list_array(signed(parities(word, doc, chunk.n).ravel()), np.full(chunk.n, PARITY // 64), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), words, parity], ["doc_id", "words", "parity"])

    return texts_of(docs).mapInArrow(run, "doc_id long, words binary, parity array<long>")


def banded_distance(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Edit distance of two sequences if it is at most ``band``, else band + 1.

    Of column j of the table only the rows j - band to j + band are kept, as
    bits (the last row highest) of where a row is one more, or one less, than
    the row above; the value itself is followed along the lowest diagonal,
    then along the last row."""
    if len(a) < len(b):
        a, b = b, a
    m, n, far = len(a), len(b), band + 1
    if m - n > band:
        return far
    if not n:
        return m
    band = min(band, m)
    width = 2 * band + 2
    full, top = (1 << width) - 1, 1 << (width - 1)
    at: dict[int, int] = {}
    for k, x in enumerate(a.tolist()):
        at[x] = at.get(x, 0) | 1 << k
    more, less, value = ((1 << (band + 1)) - 1) << (width - 1 - band), 0, band
    row = top >> 1  # of the last row, once the lowest diagonal has reached it
    for j, x in enumerate(b.tolist(), 1):
        shift = width - j - band
        equal = at.get(x, 0)
        equal = (equal << shift if shift >= 0 else equal >> -shift) & full
        diagonal = ((((equal & more) + more) ^ more) | equal | less) & full
        right_more, right_less = less | (full ^ (diagonal | more)), diagonal & more
        if j <= m - band:
            value += not diagonal & top
            if value > 2 * band + n - m:
                return far
        else:
            value += bool(right_more & row) - bool(right_less & row)
            row >>= 1
        down = diagonal >> 1
        more, less = right_less | (full ^ (down | right_more)), down & right_more
    return min(value, far)


def _anchored(a: np.ndarray, b: np.ndarray, band: int, k: int = K) -> int:
    """An upper bound of the distance: k-mers that occur once in either and
    lie within the band are matched in rising order, the gaps between them
    count their longer side."""
    if min(len(a), len(b)) < k:
        return max(len(a), len(b))
    spans = lambda x: span_hashes(x.astype(np.uint64), np.arange(len(x) - k + 1), np.arange(k, len(x) + 1))
    ka, ia, ca = np.unique(spans(a), return_index=True, return_counts=True)
    kb, ib, cb = np.unique(spans(b), return_index=True, return_counts=True)
    _, pa_, pb = np.intersect1d(ka[ca == 1], kb[cb == 1], assume_unique=True, return_indices=True)
    i, j = ia[ca == 1][pa_], ib[cb == 1][pb]
    near = np.abs(i - j) <= band
    order = np.argsort(i[near], kind="stable")
    i, j = i[near][order], j[near][order]
    if len(j) and (np.diff(j) <= 0).any():
        top = np.maximum.accumulate(j)  # keep a rising part: drop what falls behind or jumps past what follows
        low = np.minimum.accumulate(j[::-1])[::-1]
        keep = (j == top) & (j == low)
        i, j = i[keep], j[keep]
    di, dj = np.append(i, len(a)), np.append(j, len(b))
    # a match covers k words on both sides unless the next one overlaps it
    end_i, end_j = np.append(0, i + k), np.append(0, j + k)
    gap_i, gap_j = di - end_i, dj - end_j
    both = np.minimum(np.minimum(gap_i, gap_j), 0)  # an overlap takes the same words back from both
    return int(np.maximum(gap_i - both, gap_j - both).sum())


def is_near(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether 1 - distance / longer >= similarity."""
    longer = max(len(a), len(b))
    band = int(np.floor((1 - similarity) * longer + 1e-9))
    if abs(len(a) - len(b)) > band:
        return False
    m = min(len(a), len(b))
    differs = np.flatnonzero(a[:m] != b[:m])
    head = int(differs[0]) if len(differs) else m
    a, b = a[head:], b[head:]
    m = min(len(a), len(b))
    differs = np.flatnonzero(a[len(a) - m:][::-1] != b[len(b) - m:][::-1])
    tail = int(differs[0]) if len(differs) else m
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    if max(len(a), len(b)) <= band:
        return True
    # words of one that the other lacks bound the distance from below
    both = np.concatenate([a, b])
    values, at = np.unique(both, return_inverse=True)
    shared = np.minimum(np.bincount(at[:len(a)], minlength=len(values)), np.bincount(at[len(a):], minlength=len(values))).sum()
    if max(len(a), len(b)) - shared > band:
        return False
    if _anchored(a, b, band) <= band:
        return True
    return banded_distance(a, b, band) <= band


def verified(pairs: DataFrame, words: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The (a, b) of ``pairs`` that are near-duplicates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            near = [is_near(np.frombuffer(left[k].as_buffer(), "<u4"), np.frombuffer(right[k].as_buffer(), "<u4"), similarity) for k in range(batch.num_rows)]
            keep = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    own = words.select(F.col("doc_id").alias("a"), F.col("words").alias("left"))
    other = words.select(F.col("doc_id").alias("b"), F.col("words").alias("right"))
    return pairs.join(own, "a").join(other, "b").select("a", "b", "left", "right").mapInArrow(run, "a long, b long")


def near_in_length(one: str, other: str, similarity: float) -> Column:
    return F.least(one, other) >= F.lit(similarity) * F.greatest(one, other) - 1e-6


def room(one: np.ndarray, other: np.ndarray, similarity: float) -> np.ndarray:
    """How many flipped parities and words of difference two texts may have
    together, by their numbers of words; -1 if their lengths rule them out."""
    longer, shorter = np.maximum(one, other), np.minimum(one, other)
    band = 2 * np.floor((1 - similarity) * longer + 1e-9).astype(np.int64) - (longer - shorter)
    return np.where(shorter >= similarity * longer - 1e-6, band, -1)


def meeting(similarity: float):
    """The function that a piece of a bucket's members and a block of its
    centres meet in: (a, b) of those pairs of unlike classes that lengths and
    parities leave room for, in the first bucket alone that holds the member
    and is led by the centre; two centres meet once."""
    empty = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})

    def run(own: pa.Table, led: pa.Table) -> pa.Table:
        if not own.num_rows or not led.num_rows:
            return empty
        of = lambda t, name: t.column(name).combine_chunks().to_numpy(zero_copy_only=False)
        bits = lambda t: t.column("parity").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(t.num_rows, -1)
        here = own.column("bucket")[0].as_py()
        inside, leads = own.column("inside").to_pylist(), [set(x) for x in led.column("leads").to_pylist()]
        ids, words, classes, centre, mine = of(own, "doc_id"), of(own, "n_words"), of(own, "class_id"), of(own, "centre"), bits(own)
        found_a, found_b = [], []
        for j, (c, n, of_class, theirs) in enumerate(zip(of(led, "doc_id"), of(led, "n_words"), of(led, "class_id"), bits(led), strict=True)):
            left = room(words, n, similarity)
            at = np.flatnonzero((left >= 0) & (classes != of_class) & (~centre | (ids > c)))
            at = at[np.bitwise_count(mine[at] ^ theirs).sum(axis=1, dtype=np.int64) <= left[at]]
            for i in at.tolist():
                if min(leads[j].intersection(inside[i])) == here:
                    found_a.append(max(int(ids[i]), int(c)))
                    found_b.append(min(int(ids[i]), int(c)))
        return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    return run


def further_rounds(members: DataFrame, found: DataFrame, words: DataFrame, similarity: float) -> DataFrame:
    """The (node, component) of ``found`` after any two of a bucket's
    ``members`` (bucket, doc_id, n_words) that aren't in one class have been
    compared."""
    centres = GROWTH
    while True:
        now = members.join(found.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left").withColumn("class_id", F.coalesce("component", "doc_id")).drop("component")
        mixed = now.groupBy("bucket").agg(F.min("class_id").alias("low"), F.max("class_id").alias("high"), F.count(F.lit(1)).alias("n")).where("low < high").select("bucket", "n")
        rank = F.pmod(F.xxhash64("bucket", "doc_id"), F.lit(1 << 31))  # uniform, so about ``centres`` of a bucket's members are picked
        leading = (rank * F.col("n") < F.lit(centres << 31)).alias("centre")
        now = now.join(mixed, "bucket").withColumn("place", F.struct("bucket", leading, F.ceil(F.col("n") / PIECE).cast("int").alias("pieces"), F.ceil(F.least("n", F.lit(centres)) / PIECE).cast("int").alias("blocks")))
        # a row for each document, with its places: a sketch each, so ``SKETCHES`` at most
        now = now.groupBy("doc_id", "n_words", "class_id").agg(F.collect_list("place").alias("places"))
        now = written(now.join(words.select("doc_id", "parity"), "doc_id"), "members")
        if now.isEmpty():
            return found
        part = lambda n, salt: F.pmod(F.xxhash64("doc_id", F.lit(salt)), n).cast("int")
        each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        led = F.filter("places", lambda p: p["centre"])
        own = now.select("doc_id", "n_words", "class_id", "parity", F.col("places.bucket").alias("inside"), F.explode("places").alias("place")) \
            .select("*", "place.bucket", "place.centre", part("place.pieces", 1).alias("piece"), each("place.blocks").alias("block")).drop("place")
        picked = now.select("doc_id", "n_words", "class_id", "parity", led["bucket"].alias("leads"), F.explode(led).alias("place")) \
            .select("*", "place.bucket", each("place.pieces").alias("piece"), part("place.blocks", 2).alias("block")).drop("place")
        key = ["bucket", "piece", "block"]
        pairs = own.groupBy(key).cogroup(picked.groupBy(key)).applyInArrow(meeting(similarity), "a long, b long")
        pairs = written(pairs.distinct(), "candidates")
        links = written(verified(pairs, words, similarity), "links")
        if not links.isEmpty():
            found = written(components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(links)), "classes")
        members = now.select("doc_id", "n_words", F.explode(F.filter("places", lambda p: ~p["centre"])).alias("place")).select("place.bucket", "doc_id", "n_words")
        centres *= GROWTH


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (the least doc_id of its class), copy_of (the least
    doc_id with the same words), n_words of every doc_id."""
    null = sketch_table(docs.where("doc_id IS NULL")).select("doc_id", F.lit(None).cast("long").alias("class_id"), F.lit(None).cast("long").alias("copy_of"), "n_words")
    docs = docs.where("doc_id IS NOT NULL")
    base = written(sketch_table(docs).dropDuplicates(["doc_id"]), "sketches")
    copies = base.groupBy("h1", "h2", "n_words").agg(F.min("doc_id").alias("copy_of"))
    member = written(base.select("doc_id", "h1", "h2", "n_words").join(copies, ["h1", "h2", "n_words"]).select("doc_id", "copy_of", "n_words"), "copies")
    single = member.where((F.col("doc_id") == F.col("copy_of")) & (F.col("n_words") > 0)).select("doc_id", "n_words")

    # buckets: each member meets the bucket's least doc_id and one picked by hash
    entries = base.select("doc_id", "sketches").join(single, "doc_id").select("doc_id", "n_words", F.explode("sketches").alias("bucket"))
    picked = F.struct(F.xxhash64("doc_id").alias("h"), "doc_id", "n_words")
    centres = entries.groupBy("bucket").agg(F.min(F.struct("doc_id", "n_words")).alias("first"), F.min(picked).alias("second"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    centres = centres.select("bucket", F.array(F.col("first"), F.struct("second.doc_id", "second.n_words")).alias("centres"))
    shared = written(entries.join(centres, "bucket"), "buckets")
    met = shared.select("doc_id", "n_words", F.explode("centres").alias("c")).where((F.col("doc_id") != F.col("c.doc_id")) & near_in_length("n_words", "c.n_words", similarity))
    pairs = written(met.groupBy("doc_id").agg(F.array_sort(F.collect_set("c.doc_id")).alias("centres")), "candidates")  # at most two a sketch
    others = shared.where(~F.array_contains("centres.doc_id", F.col("doc_id"))).select("bucket", "doc_id", "n_words")

    involved = pairs.select("doc_id").unionByName(pairs.select(F.explode("centres").alias("doc_id"))).unionByName(others.select("doc_id")).distinct()
    words = written(word_table(docs.join(involved.hint("merge"), "doc_id", "left_semi")).dropDuplicates(["doc_id"]), "words")
    links = written(verified(pairs.select(F.col("doc_id").alias("a"), F.col("centres")[0].alias("b")), words, similarity), "links")
    found = written(components(links), "classes")
    rest = pairs.select(F.col("doc_id").alias("a"), F.explode(F.slice("centres", 2, 2 * SKETCHES)).alias("b"))
    rest = rest.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    of = lambda name: found.select(F.col("node").alias(name), F.col("component").alias(f"class_{name}"))
    rest = rest.join(of("a"), "a", "left").join(of("b"), "b", "left")
    rest = rest.where(F.coalesce("class_a", "a") != F.coalesce("class_b", "b")).select("a", "b")
    stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
    found = written(components(stars.unionByName(verified(rest, words, similarity))), "classes")
    found = further_rounds(others, found, words, similarity).select(F.col("node").alias("copy_of"), F.col("component"))
    return member.join(found, "copy_of", "left").select("doc_id", F.coalesce("component", "copy_of").alias("class_id"), "copy_of", "n_words").unionByName(null)

"""Operator 11: vector code compression over lexicographic tries of parts.

Each component x of a vector becomes floor(``SCALE`` * x); a vector is cut
into ``PARTS`` equal consecutive parts.  Each part position has a codebook
of ``ENTRIES`` entries, at first the parts of the least vec_ids.  A round
gives every part its nearest entry (squared distance, ties to the lower
index) and replaces each entry by its parts' floor(sum / count).

Vectors are written once in blocks: for each part position the block's
distinct parts in lexicographic order, their counts, and which of them each
vector has.  The order is that of a depth-first walk through the trie of
the parts, dimension by dimension.  The walk (``nearest``) takes the leaves
``SLICE`` at a time: a node's vector of distances to all entries is its
parent's plus one dimension's, computed once for all parts below it, and
the vectors of the open path are carried into the next slice.  A leaf takes
the least of its vector and adds its part, weighted by its count, to that
entry's sum.  A round moves only such sums, at most ``PARTS * ENTRIES`` rows
a task; the codebooks, ``ENTRIES`` vectors in all, are of fixed size.

A label's error is summed in two steps, by (piece of a block, label) and by
label, and goes back the same way, so rows of a frequent label never meet.

Vectors that are null or empty, hold null, NaN or infinite components, or
components of 2 ** 50 or more, or whose length isn't that of the least
vec_id's vector (the least of a length that ``PARTS`` divides) take no part.
Sums and distances are exact, in integers of any size where 64 bits don't
do; an error that no long holds is null, as is its label's.  Rows that
repeat a vec_id are coded each; among the first entries they follow the
order of their vectors, null vec_ids come last.  Fewer rows than entries
make shorter codebooks; an empty table gives an empty result; a table
without the label column has null labels; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Components of a block (8 bytes each), leaves walked at a time, rows of a piece.
BLOCK_VALUES, SLICE, PIECE = 1 << 20, 1024, 4096
LONG_MAX = (1 << 63) - 1

Codebooks = list[list[list[int]]]


def usable(vectors: DataFrame, parts: int, label: str, vector: str) -> DataFrame:
    """vec_id, label, embedding (doubles) of the rows whose vector counts."""
    fits = lambda x: x.isNotNull() & (F.abs(x) < F.lit(float(1 << 50)))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), (F.col(label) if label in vectors.columns else F.lit(None).cast("int")).alias("label"),
                          F.col(vector).cast("array<double>").alias("embedding"))
    return rows.where((F.size("embedding") > 0) & (F.size("embedding") % parts == 0) & F.forall("embedding", fits))


def first_entries(rows: DataFrame, parts: int, entries: int, scale: int) -> tuple[int, Codebooks]:
    """(length of the vectors, codebooks of the least vec_ids)"""
    least = lambda df: df.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(entries).collect()
    found = least(rows)
    if not found:
        return 0, [[] for _ in range(parts)]
    size = len(found[0][0])
    if any(len(r[0]) != size for r in found):
        found = least(rows.where(F.size("embedding") == size))
    width = size // parts
    whole = np.floor(np.array([r[0] for r in found]) * scale).astype(np.int64)
    return size, [whole[:, p * width:(p + 1) * width].tolist() for p in range(parts)]


def distinct_parts(part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows of ``part`` in lexicographic order, their counts,
    and which of them each row is."""
    order = np.lexsort(part.T[::-1])
    ordered = part[order]
    new = np.ones(len(part), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(1)
    first = np.flatnonzero(new)
    which = np.empty(len(part), np.int32)
    which[order] = np.cumsum(new) - 1
    return ordered[first], np.diff(np.append(first, len(part))), which


def blocks(rows: DataFrame, size: int, parts: int, scale: int) -> DataFrame:
    """block, vec_ids, labels, and for each part position the distinct parts
    (kind: 4 or 8 bytes a component), their counts, and each vector's."""
    width = size // parts
    label = rows.schema["label"].dataType.simpleString()

    def block(number: int, held: list[pa.RecordBatch], schema: pa.Schema) -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).combine_chunks()
        values = whole.column("embedding").chunk(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        values = np.floor(values * scale).astype(np.int64)
        kind = "<i4" if np.abs(values).max() < 1 << 31 else "<i8"
        made = [distinct_parts(values[:, p * width:(p + 1) * width]) for p in range(parts)]
        columns = {"block": [number], "kind": [kind], "parts": [[x.astype(kind).tobytes() for x, _, _ in made]], "counts": [[c.astype("<i4").tobytes() for _, c, _ in made]],
                   "which": [[w.astype("<i4").tobytes() for _, _, w in made]]}
        ends = pa.array([0, len(values)], pa.int32())
        columns |= {f"{name}s": pa.ListArray.from_arrays(ends, whole.column(name).chunk(0)) for name in ("vec_id", "label")}
        return pa.RecordBatch.from_arrays([x if isinstance(x := columns[f.name], pa.Array) else pa.array(x, f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, n = TaskContext.get().partitionId() << 24, [], 0
        for batch in batches:
            binaries = pa.list_(pa.binary())
            schema = pa.schema([("block", pa.int64()), ("vec_ids", pa.list_(pa.int64())), ("labels", pa.list_(batch.schema.field("label").type)), ("kind", pa.string()), ("parts", binaries), ("counts", binaries), ("which", binaries)])
            step = max(1, BLOCK_VALUES // size)
            for at in range(0, batch.num_rows, step):
                held.append(batch.slice(at, step))
                n += held[-1].num_rows
                if n * size >= BLOCK_VALUES:
                    yield block(number, held, schema)
                    number, held, n = number + 1, [], 0
        if held:
            yield block(number, held, schema)

    return rows.mapInArrow(run, f"block long, vec_ids array<long>, labels array<{label}>, kind string, parts array<binary>, counts array<binary>, which array<binary>")


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each of ``parts`` (distinct, in lexicographic
    order) and its squared distance, by a depth-first walk."""
    n, width = parts.shape
    kind = entries.dtype
    fresh = np.zeros(n, np.int64)  # the first dimension in which a leaf leaves the path before it
    if n > 1:
        fresh[1:] = (parts[1:] != parts[:-1]).argmax(1)
    path = np.zeros((width + 1, len(entries)), kind)
    best, distance = np.empty(n, np.int64), np.empty(n, kind)
    for at in range(0, n, SLICE):
        leaves, first = parts[at:at + SLICE], fresh[at:at + SLICE]
        node, below = path[:1], np.zeros(len(leaves), np.int64)  # the nodes of a level, and each leaf's; node 0 is the open path's
        for d in range(width):
            opens = first <= d
            rows = np.flatnonzero(opens)
            step = leaves[rows, d].astype(kind)[:, None] - entries[:, d]
            node = np.concatenate([path[d + 1:d + 2], node[below[rows]] + step * step])
            below = np.cumsum(opens)
            path[d + 1] = node[-1]
        own = node[below]
        best[at:at + SLICE] = own.argmin(1)
        distance[at:at + SLICE] = own.min(1)
    return best, distance


def safe_kind(values: np.ndarray, entries: np.ndarray, rows: int) -> type:
    """int64 where no distance and no sum can overflow, else Python's integers."""
    most = max(int(np.abs(x).max(initial=0)) for x in (values, entries))
    return np.int64 if (2 * most) ** 2 * values.shape[1] <= LONG_MAX and most * rows <= LONG_MAX else object


def _walks(batch: pa.RecordBatch, books: Codebooks) -> Iterator[tuple[int, int, list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]]]:
    """(row, vectors, and for each position: parts, counts, which, nearest
    entry, distance)"""
    column = {name: batch.column(batch.schema.get_field_index(name)) for name in ("vec_ids", "kind", "parts", "counts", "which")}
    for k in range(batch.num_rows):
        out, n = [], len(column["vec_ids"][k])
        for p, book in enumerate(books):
            values = np.frombuffer(column["parts"][k].values[p].as_buffer(), column["kind"][k].as_py()).reshape(-1, len(book[0]))
            counts, which = (np.frombuffer(column[name][k].values[p].as_buffer(), "<i4") for name in ("counts", "which"))
            entries = np.array(book, np.int64)
            kind = safe_kind(values, entries, n)
            out.append((values.astype(kind), counts, which, *nearest(values, entries.astype(kind))))
        yield k, n, out


def part_sums(stored: DataFrame, books: Codebooks) -> DataFrame:
    """position, entry, n, sums: of the parts nearest to each entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, walks in _walks(batch, books):
                rows = []
                for p, (values, counts, _, best, _) in enumerate(walks):
                    sums, n = np.zeros((len(books[p]), values.shape[1]), values.dtype), np.bincount(best, counts, len(books[p])).astype(np.int64)
                    np.add.at(sums, best, values * counts[:, None].astype(values.dtype))
                    rows += [(p, e, int(n[e]), [Decimal(int(x)) for x in sums[e]]) for e in np.flatnonzero(n).tolist()]
                position, entry, n, sums = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(position, pa.int32()), pa.array(entry, pa.int32()), pa.array(n, pa.int64()), pa.array(sums, pa.list_(pa.decimal128(38, 0)))], ["position", "entry", "n", "sums"])

    width = len(books[0][0])
    found = stored.select("vec_ids", "kind", "parts", "counts", "which").mapInArrow(run, "position int, entry int, n long, sums array<decimal(38,0)>")
    return found.groupBy("position", "entry").agg(F.sum("n").alias("n"), F.array(*(F.sum(F.col("sums")[j]) for j in range(width))).alias("sums"))


def trained(stored: DataFrame, books: Codebooks, rounds: int) -> Codebooks:
    for _ in range(rounds):
        after = [[list(e) for e in book] for book in books]
        for r in part_sums(stored, books).collect():  # at most one row for each entry of a codebook
            after[r["position"]][r["entry"]] = [int(s) // r["n"] for s in r["sums"]]
        books = after
    return books


def coded(stored: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, piece, code (hex), error of every vector."""
    label = stored.schema["labels"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, n, walks in _walks(batch, books):
                code = np.stack([best[which] for _, _, which, best, _ in walks], 1).astype(np.uint8).tobytes().hex()
                if all(distance.dtype != object for *_, distance in walks) and max(int(distance.max()) for *_, distance in walks) <= LONG_MAX // len(walks):
                    error = pa.array(sum(distance[which] for _, _, which, _, distance in walks), pa.int64())
                else:
                    total = sum(distance[which].astype(object) for _, _, which, _, distance in walks)
                    error = pa.array([x if x <= LONG_MAX else None for x in total.tolist()], pa.int64())
                piece = (batch.column(0)[k].as_py() << 8) + np.arange(n) // PIECE
                codes = [code[2 * len(walks) * j:2 * len(walks) * (j + 1)] for j in range(n)]
                yield pa.RecordBatch.from_arrays([batch.column(1)[k].values, batch.column(2)[k].values, pa.array(piece, pa.int64()), pa.array(codes, pa.string()), error], ["vec_id", "label", "piece", "code", "error"])

    return stored.mapInArrow(run, f"vec_id long, label {label}, piece long, code string, error long")


def with_label_error(rows: DataFrame) -> DataFrame:
    """``rows`` with label_error, the sum of their label's errors."""
    whole = lambda error: F.when(F.count(error) == F.count(F.lit(1)), F.try_sum(error)).alias("label_error")
    here = rows.groupBy("piece", "label").agg(whole("error"))
    total = here.groupBy("label").agg(whole("label_error")).withColumnRenamed("label", "of")
    back = here.select(F.col("piece").alias("at"), "label").join(total, F.col("label").eqNullSafe(F.col("of"))).select("at", "of", "label_error")
    return rows.join(back, (F.col("piece") == F.col("at")) & F.col("label").eqNullSafe(F.col("of")))


def digest(books: Codebooks) -> str:
    return sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def compressed(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
               label: str = "label", vector: str = "embedding") -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, piece, code, error of every vector that counts; the
    codebooks)."""
    if entries > 256:
        raise ValueError("a code has one byte for each part: at most 256 entries")
    rows = usable(vectors, parts, label, vector)
    size, books = first_entries(rows, parts, entries, scale)
    if not size:
        return rows.where("false").select("vec_id", "label", F.lit(0).cast("long").alias("piece"), F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), books
    stored = written(blocks(rows.where(F.size("embedding") == size), size, parts, scale), "parts")
    books = trained(stored, books, rounds)
    return written(coded(stored, books), "codes"), books


def codes(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256."""
    rows, books = compressed(vectors)
    return with_label_error(rows).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))

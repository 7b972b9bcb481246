"""Operator 6: exact top-k inner products by norm-bucketed retrieval.

Vectors are quantised to integers once.  Query blocks meet slices of the
candidates (both dealt by a hash of the id, so no slice grows with a
length that many share); a task takes its slice's vectors by falling
length in buckets.  For each query the k-th best score so far, over the
bucket's greatest length and the query's, is a local cosine threshold: a
query whose threshold is beyond 1 skips the bucket and all later ones; a
low threshold leaves the prefix of the bucket that is long enough; a high
one prunes by coordinates, for a unit vector with cosine t to the query can
differ only so much in the query's largest coordinates.  What is left is
verified by whole integer products.  Each (query, slice) hands on k rows.

Vectors that are null, or hold null or non-finite components, take no
part; empty vectors and those of zeros score 0; a shorter vector counts as
padded with zeros; rows that repeat id and components count once, and a
query never meets its own id; with fewer candidates than k all are
returned; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import written

SCALE = 256
QUERY_BLOCK, SLICE, BUCKET = 4096, 32_768, 1024
#: Queries scored at a time.
AT_ONCE = 256
#: From this local cosine threshold on, coordinates prune better than length.
COORDINATE_FROM = 0.7
FOCUS = 3
SLACK = 1e-9


def quantised(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, data: floor(256 x) of each component, little-endian int64."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE).astype("<i8")
            raw, size = flat.tobytes(), 8 * np.diff(column.offsets.to_numpy())
            cut = np.concatenate([[0], np.cumsum(size)]).tolist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([raw[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())], ["vec_id", "data"])

    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x")).where(F.col("vec_id").isNotNull() & F.col("x").isNotNull() & ~bad) \
        .mapInArrow(run, "vec_id long, data binary").dropDuplicates(["vec_id", "data"])


def matrix(rows: list[bytes], dim: int) -> np.ndarray:
    out = np.zeros((len(rows), dim), np.int64)
    sizes = {len(r) // 8 for r in rows}
    if sizes == {dim}:
        return np.frombuffer(b"".join(rows), "<i8").reshape(len(rows), dim)
    for k, r in enumerate(rows):
        out[k, :len(r) // 8] = np.frombuffer(r, "<i8")
    return out


class Products:
    """Exact integer products: as doubles where no sum can be inexact."""

    def __init__(self, *parts: np.ndarray):
        most = max((float(np.abs(p).max()) for p in parts if p.size), default=0.0)
        dim = max((p.shape[1] for p in parts), default=0)
        bound = most * most * max(dim, 1)
        if bound >= 2 ** 63:
            raise ValueError("components are too large for integer scores of 64 bits")
        self.kind = np.float64 if bound < 2 ** 53 else np.int64


def search(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query row, id, score) of each query's k best, and the number of
    products computed."""
    kind = Products(queries, vectors).kind
    length = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
    order = np.argsort(-length, kind="stable")
    vectors, ids, length = vectors[order].astype(kind), ids[order], length[order]
    unit = vectors / np.maximum(length, 1e-300)[:, None]
    q_length = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
    q_unit = queries / np.maximum(q_length, 1e-300)[:, None]
    done, products = [], 0
    for start in range(0, len(queries), AT_ONCE):
        q, own = queries[start:start + AT_ONCE].astype(kind), query_ids[start:start + AT_ONCE]
        ql, qu = q_length[start:start + AT_ONCE], q_unit[start:start + AT_ONCE]
        best_row = np.zeros(0, np.int64)
        best_id, best_score = np.zeros(0, np.int64), np.zeros(0, kind)
        floor = np.full(len(q), -np.inf)
        focus = np.argsort(-np.abs(qu), axis=1, kind="stable")[:, :FOCUS]
        for at in range(0, len(vectors), BUCKET):
            top = length[at]
            reach = ql * top
            alive = np.flatnonzero((floor <= reach * (1 + SLACK)) | np.isneginf(floor))
            if not len(alive):
                break  # later buckets are shorter still
            with np.errstate(divide="ignore", invalid="ignore"):
                cosine = np.where(reach > 0, floor / np.maximum(reach, 1e-300), -np.inf)
            found = []
            by_coordinate = alive[cosine[alive] >= COORDINATE_FROM]
            by_length = alive[cosine[alive] < COORDINATE_FROM]
            block, block_ids, size = vectors[at:at + BUCKET], ids[at:at + BUCKET], length[at:at + BUCKET]
            if len(by_length):
                with np.errstate(divide="ignore", invalid="ignore"):
                    need = np.where((floor[by_length] > 0) & (ql[by_length] > 0), floor[by_length] / np.maximum(ql[by_length], 1e-300), 0.0)
                end = int(np.searchsorted(-size, -need.min() * (1 - SLACK), side="right"))
                scores = q[by_length] @ block[:end].T
                products += scores.size
                row, col = np.nonzero((scores >= floor[by_length][:, None]) & (own[by_length][:, None] != block_ids[None, :end]))
                found.append((by_length[row], block_ids[col], scores[row, col]))
            for r in by_coordinate.tolist():
                t = min(cosine[r] * (1 - SLACK), 1.0)
                near = np.ones(len(block), bool)
                for f in focus[r].tolist():
                    mid, width = qu[r, f] * t, np.sqrt(max(0.0, (1 - qu[r, f] ** 2) * (1 - t * t)))
                    low = mid - width - 1e-9
                    high = mid + width + 1e-9 if qu[r, f] < t else np.inf
                    if qu[r, f] < -t:
                        low = -np.inf
                    c = unit[at:at + BUCKET, f]
                    near &= (c >= low) & (c <= high)
                col = np.flatnonzero(near)
                scores = block[col] @ q[r]
                products += len(col)
                keep = (scores >= floor[r]) & (block_ids[col] != own[r])
                found.append((np.full(int(keep.sum()), r), block_ids[col][keep], scores[keep]))
            row = np.concatenate([best_row, *(f[0] for f in found)])
            one, score = np.concatenate([best_id, *(f[1] for f in found)]), np.concatenate([best_score, *(f[2] for f in found)])
            order = np.lexsort((one, -score, row))
            row, one, score = row[order], one[order], score[order]
            rank = np.arange(len(row)) - np.searchsorted(row, row)
            best_row, best_id, best_score = row[rank < k], one[rank < k], score[rank < k]
            last = rank == k - 1
            floor[row[last]] = score[last]
        done.append((best_row + start, best_id, best_score.astype(np.int64)))
    if not done:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    return *(np.concatenate([d[j] for d in done]) for j in range(3)), products


def top_products(vectors: DataFrame, queries_every: int = 50, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of all other rows for
    each row whose id is divisible by ``queries_every``."""
    data = written(quantised(vectors, vec_id, vector), "vectors")
    is_query = F.col("vec_id") % queries_every == 0
    total, asked = data.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    slices, blocks = max(1, -(-total // SLICE)), max(1, -(-asked // QUERY_BLOCK))
    dealt = lambda n: F.pmod(F.xxhash64("vec_id", "data"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = data.where(is_query).select("vec_id", "data", dealt(blocks).alias("block"), each(slices).alias("slice"))
    rows = data.select(F.col("vec_id").alias("other_id"), F.col("data").alias("other"), dealt(slices).alias("in_slice"), each(blocks).alias("for_block"))

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("query_id", "vec_id", "score", "asked")})
        asked, among = left.column("data").to_pylist(), right.column("other").to_pylist()
        dim = max((len(x) // 8 for x in asked + among), default=0)
        own = left.column("vec_id").to_numpy()
        row, one, score, _ = search(matrix(asked, dim), own, matrix(among, dim), right.column("other_id").to_numpy(), k)
        return pa.table({"query_id": pa.array(own[row], pa.int64()), "vec_id": pa.array(one, pa.int64()), "score": pa.array(score, pa.int64()), "asked": pa.array(row, pa.int64())})

    found = queries.groupBy("block", "slice").cogroup(rows.groupBy("for_block", "in_slice")).applyInArrow(run, "query_id long, vec_id long, score long, asked long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.dropDuplicates(["query_id", "vec_id", "score"]).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

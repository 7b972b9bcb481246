"""Retrieval: cosine top-k, keyword search, hybrid answers, back-fill.

Top-k never materialises query × corpus pairs.  Query blocks of fixed size
meet slices of the corpus of fixed size as groups of one cogroup; a task
scores tiles of fixed size with numpy and keeps the best ``k`` of its slice
for each query, and a ranking over ``k`` rows per query and slice picks the
global top ``k``.  Memory is the same whatever the number of queries, and
nothing is collected.

Keyword search meets rows on the keywords' rarest trigrams (``trigrams``);
answers are fetched at the end, for the rows found alone.  Keywords of fewer
than three characters have no trigram: they are joined with all rows of their
brand, in blocks of fixed size, and tested with built-ins; the least ordinal
of each is a partial aggregation.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions import text as T
from ..schema import NO_MATCH
from . import trigrams as TG

# Scores are ranked after rounding to this many digits, so that the
# same vector scored on two paths (or two engines) ties exactly and
# the tie goes to the smaller id.
RANK_DIGITS = 9
# Rows of a query block and a corpus slice, and of a tile of scores.
QUERY_BLOCK, CORPUS_SLICE = 4096, 65_536
TILE_QUERIES, TILE_ROWS = 256, 8192


def _normalise(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    n[n == 0] = 1.0
    return m / n


def _best(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best rows of each query: columns q, qv and id, v."""
    out: dict[str, list] = {"query_id": [], "id": [], "score": []}
    for dim in sorted({len(v) for v in queries["qv"]}):
        mine = queries[queries["qv"].map(len) == dim]
        fit = rows[rows["v"].map(len) == dim]
        if fit.empty:
            continue
        ids = fit["id"].to_numpy()
        x = _normalise(np.stack([np.asarray(v, dtype=np.float64) for v in fit["v"]]))
        for a in range(0, len(mine), TILE_QUERIES):
            part = mine.iloc[a:a + TILE_QUERIES]
            q = _normalise(np.stack([np.asarray(v, dtype=np.float64) for v in part["qv"]]))
            best_i, best_s = [[] for _ in range(len(part))], [[] for _ in range(len(part))]
            for b in range(0, len(ids), TILE_ROWS):
                scores = np.round(q @ x[b:b + TILE_ROWS].T, RANK_DIGITS)
                own = ids[b:b + TILE_ROWS]
                kth = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] > k else np.full(len(part), -np.inf)
                for j in range(len(part)):
                    keep = np.flatnonzero(scores[j] >= kth[j])
                    one, val = [*best_i[j], *own[keep]], np.append(best_s[j], scores[j][keep])
                    order = np.lexsort((np.array(one, dtype=object), -val))[:k]
                    best_i[j], best_s[j] = [one[o] for o in order], val[order].tolist()
            for qid, i, s in zip(part["q"], best_i, best_s, strict=True):
                out["query_id"] += [qid] * len(i)
                out["id"] += i
                out["score"] += s
    return pd.DataFrame(out)


def topk_cosine(corpus: DataFrame, queries: DataFrame, k: int = 2, id_col: str = "id",
                vec_col: str = "embedding", qid_col: str = "query_id",
                qvec_col: str = "embedding") -> DataFrame:
    """Exact cosine top-``k`` corpus rows per query.

    Returns ``query_id, rank, id, score`` (score rounded to 6 digits).
    Rows with a null or wrong-length vector are not candidates; a zero
    vector scores 0.
    """
    schema = StructType([StructField("query_id", queries.schema[qid_col].dataType), StructField("id", corpus.schema[id_col].dataType),
                         StructField("score", DoubleType())])
    asked = queries.where(F.col(qvec_col).isNotNull())
    slices = max(1, -(-corpus.count() // CORPUS_SLICE))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))

    def each(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = asked.select(F.col(qid_col).alias("q"), F.col(qvec_col).alias("qv"),
                        F.pmod(F.xxhash64(qid_col), F.lit(blocks)).cast("int").alias("block"), each(slices).alias("slice"))
    right = corpus.where(F.col(vec_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(vec_col).alias("v"),
        F.pmod(F.xxhash64(id_col), F.lit(slices)).cast("int").alias("in_slice"), each(blocks).alias("for_block"))

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"query_id": [], "id": [], "score": []})
        return _best(a, b, k)

    found = left.groupBy("block", "slice").cogroup(right.groupBy("for_block", "in_slice")).applyInPandas(run, schema)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id").asc())
    return (
        found.withColumn("rank", F.row_number().over(w))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("long").alias("rank"), "id",
                F.round("score", 6).alias("score"))
    )


def keyword_first_match(rows: DataFrame, queries: DataFrame, text_col: str, order_col: str,
                        brand_col: str | None = None, default: str = NO_MATCH,
                        answer_chars: int | None = None) -> DataFrame:
    """Per query (``query_id, keyword[, brand]``): the first row in
    ``order_col`` order whose text contains the keyword
    case-insensitively (``ILIKE '%kw%'`` with the keyword literal), else
    ``default``.  ``order_col`` is unique.  Any number of queries."""
    keyword = F.lower(F.coalesce(F.col("keyword"), F.lit("")))
    brand = F.col(brand_col) if brand_col else F.lit("")
    asked = queries.withColumn("__kw", keyword).withColumn("__brand", brand)
    distinct = asked.select(F.col("__brand").alias("brand"), F.col("__kw").alias("kw")).where(F.col("brand").isNotNull()).distinct()
    src = rows.select((F.col(brand_col) if brand_col else F.lit("")).alias("brand"), F.col(order_col).alias("match_id"), F.lower(F.col(text_col)).alias("low"))
    src = src.where(F.col("match_id").isNotNull() & F.col("low").isNotNull())
    hits, _ = TG.first_hits(src, distinct.where(F.length("kw") >= TG.GRAM))
    short = distinct.where(F.length("kw") < TG.GRAM)
    n_short = short.count()
    if n_short:
        lists = short.withColumn("block", F.pmod(F.xxhash64("kw"), F.lit(-(-n_short // TG.BLOCK)))).groupBy("brand", "block").agg(F.collect_list("kw").alias("kws"))
        # the outer form: else the optimizer tests every keyword twice
        met = src.join(lists, "brand").select("match_id", "brand", F.explode_outer(F.filter("kws", lambda w: F.contains(F.col("low"), w))).alias("kw"))
        hits = hits.unionByName(met.where(F.col("kw").isNotNull()).groupBy("brand", "kw").agg(F.min("match_id").alias("match_id")))
    hits = hits.withColumnsRenamed({"brand": "__brand", "kw": "__kw"})
    found = asked.join(hits, ["__brand", "__kw"], "left").drop("__brand", "__kw")
    text = F.col(text_col) if answer_chars is None else T.truncate(F.col(text_col), answer_chars)
    answers = rows.join(hits.select(F.col("match_id").alias(order_col)).distinct(), order_col, "left_semi") \
        .select(F.col(order_col).alias("match_id"), text.alias("match"))
    return found.join(answers, "match_id", "left").withColumn("answer", F.coalesce("match", F.lit(default)))


def hybrid_answer(vector_part, keyword_part, vec_label: str = "Vector",
                  kw_label: str = "Keyword", cut: int | None = None):
    """Combined answer string of two labelled parts; ``cut`` shortens
    each part and appends '...'."""
    def part(c):
        c = F.coalesce(c, F.lit(NO_MATCH))
        return F.concat(T.truncate(c, cut), F.lit("...")) if cut else c
    return F.concat(F.lit(vec_label + ": "), part(vector_part), F.lit("\n" + kw_label + ": "),
                    part(keyword_part))


def backfill(hits: DataFrame, table: DataFrame, db_id_col: str = "db_id", id_col: str = "id",
             meta_solution: str = "meta_solution", solution_col: str = "solution") -> DataFrame:
    """Recover the full solution for hits whose metadata copy was blanked
    (long texts), by joining back to the table on the carried id."""
    t = table.select(F.col(id_col).alias("__tid"), F.col(solution_col).alias("__full"))
    return (
        hits.join(t, hits[db_id_col] == t["__tid"], "left")
        .withColumn("solution", F.coalesce(F.nullif(F.col(meta_solution), F.lit("")), F.col("__full")))
        .withColumn("backfilled", F.coalesce((F.col(meta_solution) == "") & F.col("__full").isNotNull(),
                                             F.lit(False)))
        .drop("__tid", "__full")
    )


__all__ = ["topk_cosine", "keyword_first_match", "hybrid_answer", "backfill", "RANK_DIGITS"]

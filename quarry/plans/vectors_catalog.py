"""Registered embedding and retrieval queries."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as T
from ..operators import embed as EM
from ..operators import items as I
from ..operators import retrieve as RT
from ..operators import store as S
from ..operators import trigrams as TG
from ..schema import EMBEDDING_DIM, NO_MATCH
from ..session import read_table
from . import oracle as O
from .registry import register

TOPK_TABLE = 3
TOPK_TEXT = 2
CHUNK_TURNS = 50
ANSWER_CUT = 100


def rank_sql(scores: str, k: int) -> str:
    return f"""
SELECT query_id, rank, id, round(score, 6) AS score FROM (
  SELECT query_id, id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, id) AS rank
  FROM {scores}) WHERE rank <= {k}"""


@register("embed_hashed", f"""
SELECT conv_id, turn, bucket, round(weight, 6) AS weight
FROM {O.hashed_vectors('conversations', ['conv_id', 'turn'], 'text', EMBEDDING_DIM)}""")
def embed_hashed(spark, sf):
    conv = read_table(spark, sf, "conversations")
    return EM.embedding_long(EM.embed_hashed(conv, "text"), ["conv_id", "turn"])


def label_centroids(emb):
    """Mean vector per label (partial aggregation per label × index)."""
    cells = emb.select("label", F.posexplode("embedding").alias("i", "x"))
    means = cells.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return means.groupBy("label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("embedding")
    ).withColumnRenamed("label", "query_id")


@register("vector_topk", rank_sql("""
(WITH e AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x,
                   unnest(generate_series(1, len(embedding))) AS i FROM embeddings),
      c AS (SELECT label, i, avg(x) AS m FROM e GROUP BY label, i),
      cn AS (SELECT label, sqrt(sum(m * m)) AS norm FROM c GROUP BY label),
      en AS (SELECT vec_id, sqrt(sum(x * x)) AS norm FROM e GROUP BY vec_id)
 SELECT c.label AS query_id, e.vec_id AS id, sum(e.x * c.m) / (min(en.norm) * min(cn.norm)) AS score
 FROM e JOIN c USING (i) JOIN cn ON cn.label = c.label JOIN en ON en.vec_id = e.vec_id
 GROUP BY c.label, e.vec_id)""", TOPK_TABLE))
def vector_topk(spark, sf):
    """Nearest stored vectors to each label's centroid (cosine, k=3)."""
    emb = read_table(spark, sf, "embeddings")
    corpus = emb.select(F.col("vec_id").alias("id"), "embedding")
    return RT.topk_cosine(corpus, label_centroids(emb), k=TOPK_TABLE)


def text_vectors_sql(table: str, key: str) -> str:
    return O.hashed_vectors(table, [key], "text", EMBEDDING_DIM)


RETRIEVAL_SCORES = f"""
(WITH dv AS {text_vectors_sql('documents', 'doc_id')},
      qv AS {text_vectors_sql('benchmark', 'item_id')}
 SELECT q.item_id AS query_id, d.doc_id AS id, sum(q.weight * d.weight) AS score
 FROM qv q JOIN dv d USING (bucket) GROUP BY q.item_id, d.doc_id)"""


def retrieval(spark, sf, k):
    docs = EM.embed_hashed(read_table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text"),
                           "text").select("id", "embedding")
    queries = EM.embed_hashed(read_table(spark, sf, "benchmark").select(
        F.col("item_id").alias("query_id"), "text"), "text").select("query_id", "embedding")
    return RT.topk_cosine(docs, queries, k=k)


@register("retrieval_check", rank_sql(RETRIEVAL_SCORES, TOPK_TEXT))
def retrieval_check(spark, sf):
    """Batch retrieval check: every benchmark text embedded with the
    corpus provider, top 2 documents by cosine."""
    return retrieval(spark, sf, TOPK_TEXT)


@register("validate_dimension", f"""
SELECT vec_id, len(embedding)::BIGINT AS dim,
       CASE WHEN embedding IS NULL THEN 'missing' WHEN len(embedding) <> {EMBEDDING_DIM} THEN 'wrong_dim'
            ELSE 'ok' END AS vector_status
FROM embeddings""")
def validate_dimension(spark, sf):
    emb = read_table(spark, sf, "embeddings")
    return EM.validate_dimension(emb).select("vec_id", F.size("embedding").cast("long").alias("dim"),
                                             "vector_status")


@register("vector_upsert", """
WITH old AS (SELECT vec_id::VARCHAR AS id, embedding[1]::DOUBLE AS v0 FROM embeddings),
     new AS (SELECT (vec_id * 2)::VARCHAR AS id, -(embedding[1]::DOUBLE) AS v0 FROM embeddings WHERE label = 1)
SELECT id, round(v0, 6) AS v0, 'old' AS origin FROM old WHERE id NOT IN (SELECT id FROM new)
UNION ALL
SELECT id, round(v0, 6), 'new' FROM new""")
def vector_upsert(spark, sf):
    """Upsert a batch (label-1 vectors, re-keyed and negated) into the
    stored vectors: same id replaces, new id inserts."""
    emb = read_table(spark, sf, "embeddings")
    old = emb.select(F.col("vec_id").cast("string").alias("id"), "embedding",
                     F.lit("old").alias("origin"), F.col("vec_id").alias("ordinal"))
    new = emb.where(F.col("label") == 1).select(
        (F.col("vec_id") * 2).cast("string").alias("id"),
        F.transform("embedding", lambda x: -x).alias("embedding"),
        F.lit("new").alias("origin"), F.col("vec_id").alias("ordinal"))
    return S.upsert(old, new, "id", "ordinal").select(
        "id", F.round(F.col("embedding")[0].cast("double"), 6).alias("v0"), "origin")


@register("backfill_solution", f"""
SELECT e.vec_id,
       sha256(coalesce(nullif(CASE WHEN {O.word_count('d.text')} < 100 THEN d.text ELSE '' END, ''), d.text)) AS solution_sha,
       CASE WHEN {O.word_count('d.text')} < 100 THEN false ELSE d.text IS NOT NULL END AS backfilled
FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id""")
def backfill_solution(spark, sf):
    """Hits carry metadata whose long solutions were blanked; the full
    text comes back from the table by the carried id."""
    docs = read_table(spark, sf, "documents")
    stored_meta = docs.select(F.col("doc_id").alias("db_id"), T.word_gate("text").alias("meta_solution"))
    hits = read_table(spark, sf, "embeddings").select("vec_id").join(
        stored_meta, F.col("vec_id") == F.col("db_id"))
    kb = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("solution"))
    return RT.backfill(hits, kb).select("vec_id", F.sha2("solution", 256).alias("solution_sha"),
                                        "backfilled")


@register("hybrid_answer", f"""
WITH top AS ({rank_sql(RETRIEVAL_SCORES, 1)}),
     q AS (SELECT item_id, lower({O.first_token('text')}) AS kw FROM benchmark),
     kw AS (SELECT q.item_id, min(d.doc_id) AS kw_id FROM q JOIN documents d ON contains(lower(d.text), q.kw)
            GROUP BY q.item_id)
SELECT b.item_id, t.id AS vec_id, k.kw_id,
       'Vector: ' || left(coalesce(dv.text, '{NO_MATCH}'), {ANSWER_CUT}) || '...' || chr(10) ||
       'Keyword: ' || left(coalesce(dk.text, '{NO_MATCH}'), {ANSWER_CUT}) || '...' AS answer
FROM benchmark b LEFT JOIN top t ON t.query_id = b.item_id
LEFT JOIN kw k ON k.item_id = b.item_id
LEFT JOIN documents dv ON dv.doc_id = t.id
LEFT JOIN documents dk ON dk.doc_id = k.kw_id""")
def hybrid_answer(spark, sf):
    """Per question: the best vector hit and the first keyword hit,
    combined into one labelled answer ('No match' for a missing part)."""
    docs = read_table(spark, sf, "documents")
    bench = read_table(spark, sf, "benchmark")
    top = retrieval(spark, sf, 1).select(F.col("query_id").alias("item_id"), F.col("id").alias("vec_id"))
    kq = bench.select(F.col("item_id").alias("query_id"), F.lower(T.first_token("text")).alias("keyword"))
    kw = RT.keyword_first_match(docs.select("doc_id", "text"), kq, "text", "doc_id").select(
        F.col("query_id").alias("item_id"), F.col("match_id").alias("kw_id"))
    # short heads alone are moved, of the documents found alone
    wanted = top.select(F.col("vec_id").alias("doc_id")).unionByName(kw.select(F.col("kw_id").alias("doc_id"))).distinct()
    texts = docs.select("doc_id", T.truncate("text", ANSWER_CUT).alias("text")).join(wanted, "doc_id", "left_semi")
    out = (
        bench.select("item_id").join(top, "item_id", "left").join(kw, "item_id", "left")
        .join(texts.withColumnRenamed("doc_id", "vec_id").withColumnRenamed("text", "vec_text"), "vec_id", "left")
        .join(texts.withColumnRenamed("doc_id", "kw_id").withColumnRenamed("text", "kw_text"), "kw_id", "left")
    )
    return out.select("item_id", "vec_id", "kw_id",
                      RT.hybrid_answer(F.col("vec_text"), F.col("kw_text"), cut=ANSWER_CUT).alias("answer"))


@register("keyword_postings", f"""
WITH q AS (SELECT DISTINCT lower({O.first_token('text')}) AS kw FROM benchmark),
     g AS (SELECT kw, substr(kw, i, 3) AS gram FROM q, unnest(range(1, length(kw) - 1)) AS r(i) WHERE length(kw) >= 3),
     n AS (SELECT gram, (SELECT count(*) FROM documents d WHERE contains(lower(d.text), x.gram)) AS n FROM (SELECT DISTINCT gram FROM g) x)
SELECT kw, min(n)::BIGINT AS n_postings, any_value(d.doc_id)::BIGINT AS match_id
FROM g JOIN n USING (gram) JOIN (SELECT kw, min(doc_id) AS doc_id FROM q JOIN documents ON contains(lower(text), kw) GROUP BY kw) d USING (kw) GROUP BY kw""")
def keyword_postings(spark, sf):
    """What the trigram index does for each question's keyword: the rows of
    its rarest trigram, and the first row that holds the keyword."""
    docs = read_table(spark, sf, "documents").select(F.lit("").alias("brand"), F.col("doc_id").alias("match_id"), F.lower("text").alias("low")).where("low IS NOT NULL")
    words = read_table(spark, sf, "benchmark").select(F.lit("").alias("brand"), F.lower(T.first_token("text")).alias("kw")).where(F.length("kw") >= TG.GRAM).distinct()
    hits, candidates = TG.first_hits(docs, words)
    sizes = candidates.groupBy("kw").agg(F.max("n_postings").alias("n_postings"))
    return hits.select("kw", "match_id").join(sizes, "kw").select("kw", "n_postings", "match_id")


@register("collect_ordered", f"""
SELECT conv_id, (turn // {CHUNK_TURNS})::BIGINT AS chunk, count(*)::BIGINT AS n_turns,
       min(turn)::BIGINT AS first_turn,
       sha256(string_agg(role || ': ' || text, chr(10) ORDER BY turn)) AS transcript_sha
FROM conversations GROUP BY conv_id, turn // {CHUNK_TURNS}""")
def collect_ordered(spark, sf):
    """Ordered message lists per conversation, in chunks of at most 50
    turns so that no group (even a conversation with a third of all
    rows) is collected whole into one task."""
    conv = read_table(spark, sf, "conversations")
    lines = conv.select("conv_id", "turn", (F.col("turn") / CHUNK_TURNS).cast("long").alias("chunk"),
                        F.concat(F.col("role"), F.lit(": "), F.col("text")).alias("line"))
    agg = lines.groupBy("conv_id", "chunk").agg(
        F.count(F.lit(1)).alias("n_turns"), F.min("turn").alias("first_turn"),
        F.array_sort(F.collect_list(F.struct("turn", "line"))).alias("msgs"))
    return agg.select("conv_id", F.col("chunk").cast("long").alias("chunk"),
                      F.col("n_turns").cast("long").alias("n_turns"),
                      F.col("first_turn").cast("long").alias("first_turn"),
                      F.sha2(F.array_join(F.transform("msgs", lambda m: m["line"]), "\n"), 256)
                      .alias("transcript_sha"))


@register("union_sources", f"""
SELECT 'documents' AS kind, doc_id AS key, 'https://' || source || '.example.com/doc/' || doc_id::VARCHAR AS url,
       sha256(split_part(text, chr(10), 1)) AS issue_sha, sha256(text) AS solution_sha FROM documents
UNION ALL
SELECT 'pages', page_id, url,
       sha256(coalesce(nullif({O.title('html')}, ''), nullif({O.heading('html')}, ''), 'Untitled')), NULL FROM pages
UNION ALL
SELECT 'conversations', conv_id * 1000000 + turn, NULL, sha256(role), sha256(text) FROM conversations""")
def union_sources(spark, sf):
    """Items from three producers with different fields, unioned by name
    (missing fields null)."""
    docs = I.documents_as_items(read_table(spark, sf, "documents")).select(
        F.lit("documents").alias("kind"), F.col("ordinal").alias("key"), "url", "issue", "solution")
    pages = read_table(spark, sf, "pages").select(
        F.lit("pages").alias("kind"), F.col("page_id").alias("key"), "url",
        F.coalesce(F.nullif(H.title("html"), F.lit("")), F.nullif(H.heading("html"), F.lit("")),
                   F.lit("Untitled")).alias("issue"))
    conv = read_table(spark, sf, "conversations").select(
        F.lit("conversations").alias("kind"), (F.col("conv_id") * 1000000 + F.col("turn")).alias("key"),
        F.col("role").alias("issue"), F.col("text").alias("solution"))
    u = docs.unionByName(pages, allowMissingColumns=True).unionByName(conv, allowMissingColumns=True)
    return u.select("kind", "key", "url", F.sha2("issue", 256).alias("issue_sha"),
                    F.sha2("solution", 256).alias("solution_sha"))


ANN_PLANES, ANN_TABLES = 8, 16


@register("vector_topk_ann")
def vector_topk_ann(spark, sf):
    """Approximate neighbours of each label centroid by random hyperplanes:
    ``ANN_TABLES`` tables of ``ANN_PLANES`` sign bits; a row is a candidate
    of the queries whose bits, or all but one of them, it shares in some
    table.  Candidates are scored exactly; each query's recall against the
    exact search is a column.  Rows-only check."""
    emb = read_table(spark, sf, "embeddings")
    queries = label_centroids(emb)
    planes = np.random.default_rng(7).standard_normal((EMBEDDING_DIM, ANN_TABLES * ANN_PLANES))
    weights = 1 << np.arange(ANN_PLANES)

    @F.pandas_udf("array<long>")
    def codes(vectors: pd.Series) -> pd.Series:
        """One number for each table: its bits."""
        above = (np.stack([np.asarray(v, dtype=np.float64) for v in vectors]) @ planes >= 0) if len(vectors) else np.zeros((0, ANN_TABLES * ANN_PLANES))
        return pd.Series(list((above.reshape(-1, ANN_TABLES, ANN_PLANES) * weights).sum(2)))

    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    wide = F.col("embedding").cast("array<double>")
    corpus = emb.select(F.col("vec_id").alias("id"), wide.alias("v"), F.posexplode_outer(codes(wide)).alias("t", "code"))
    probe = queries.select("query_id", F.col("embedding").alias("qv"), F.posexplode_outer(codes("embedding")).alias("t", "own"))
    flips = F.array(F.lit(0), *[F.lit(1 << b) for b in range(ANN_PLANES)])
    probe = probe.select("query_id", "qv", "t", F.explode(F.transform(flips, lambda f: F.col("own").bitwiseXOR(f))).alias("code"))
    # ids alone meet; vectors follow for the distinct pairs
    pairs = corpus.select("id", "t", "code").join(probe.select("query_id", "t", "code"), ["t", "code"]).select("query_id", "id").distinct()

    def unit(c):
        n = F.sqrt(dot(c, c))
        return F.transform(c, lambda x: F.when(n > 0, x / n).otherwise(0.0))

    scored = pairs.join(emb.select(F.col("vec_id").alias("id"), unit(wide).alias("v")), "id") \
        .join(queries.select("query_id", unit(F.col("embedding")).alias("qv")), "query_id")
    from pyspark.sql import Window
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    best = scored.select("query_id", "id", F.round(dot(F.col("v"), F.col("qv")), 6).alias("score")).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= TOPK_TABLE)
    exact = RT.topk_cosine(emb.select(F.col("vec_id").alias("id"), wide.alias("embedding")), queries, TOPK_TABLE)
    recall = exact.join(best.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left").groupBy("query_id").agg((F.count("hit") / F.count(F.lit(1))).alias("recall"))
    return best.join(recall, "query_id").select("query_id", F.col("rank").cast("long").alias("rank"), "id", "score", "recall")

"""Registered queries over bucketed tables with delta files."""

from __future__ import annotations

import uuid
from dataclasses import asdict

from pyspark.sql import functions as F

from ..operators import delta as DT
from ..operators import items as I
from ..session import checkpoint_dir, read_table
from . import jobs as J
from . import oracle as O
from .docs_catalog import BRANDS, DEFAULT_BRAND, ITEMS_SQL, brand_sql
from .registry import register

VECTOR_BUCKETS = 128
LOAD_BUCKETS = 16
SHORT = 1000


def _root(spark, label):
    return f"{checkpoint_dir(spark).rstrip('/')}/quarry-{label}-{uuid.uuid4().hex}"


def stored_vectors(spark, sf):
    """The stored vectors and a load: label-1 vectors re-keyed and negated,
    some under keys of stored ones."""
    emb = read_table(spark, sf, "embeddings")
    old = emb.select(F.col("vec_id").cast("string").alias("id"), F.col("embedding").cast("array<double>").alias("embedding"),
                     F.lit("old").alias("origin"), F.col("vec_id").alias("ordinal"), "label")
    new = emb.where(F.col("label") == 1).select(
        (F.col("vec_id") * 2).cast("string").alias("id"), F.transform(F.col("embedding").cast("array<double>"), lambda x: -x).alias("embedding"),
        F.lit("new").alias("origin"), F.col("vec_id").alias("ordinal"))
    return old, new


@register("delta_upsert", """
WITH old AS (SELECT vec_id::VARCHAR AS id, embedding, 'old' AS origin FROM embeddings),
     new AS (SELECT (vec_id * 2)::VARCHAR AS id, list_transform(embedding, lambda x: -x) AS embedding, 'new' AS origin FROM embeddings WHERE label = 1),
     all_rows AS (SELECT * FROM old WHERE id NOT IN (SELECT id FROM new) UNION ALL SELECT * FROM new)
SELECT id, origin, len(embedding)::BIGINT AS dim, round(embedding[1]::DOUBLE, 6) AS first_x,
       round(list_sum(list_transform(embedding, lambda x, i: x::DOUBLE * i)), 3) AS weighted FROM all_rows""")
def delta_upsert(spark, sf):
    """Vectors upserted into a bucketed table, the load replayed, the
    touched buckets compacted: same id replaces, new id inserts."""
    old, new = stored_vectors(spark, sf)
    root = _root(spark, "delta-upsert")
    DT.create(spark, root, old.drop("ordinal", "label").schema, "id", VECTOR_BUCKETS)
    DT.upsert(spark, root, old, "ordinal")
    DT.upsert(spark, root, new, "ordinal")
    DT.upsert(spark, root, new, "ordinal")
    DT.compact(spark, root)
    weighted = F.aggregate(F.transform("embedding", lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, x: a + x)
    return DT.read(spark, root).select("id", "origin", F.size("embedding").cast("long").alias("dim"),
                                       F.round(F.col("embedding")[0], 6).alias("first_x"), F.round(weighted, 3).alias("weighted"))


@register("delta_loads", f"""
WITH base AS (SELECT vec_id::VARCHAR AS id FROM embeddings WHERE label IS DISTINCT FROM 1),
     extra AS (SELECT (vec_id * 2)::VARCHAR AS id FROM embeddings WHERE label = 1),
     fresh AS (SELECT id FROM extra WHERE id NOT IN (SELECT id FROM base)),
     k AS (SELECT 'base' AS part, id, ('0x' || left(md5(id), 8))::BIGINT % {VECTOR_BUCKETS} AS b FROM base
           UNION ALL SELECT 'extra', id, ('0x' || left(md5(id), 8))::BIGINT % {VECTOR_BUCKETS} FROM extra
           UNION ALL SELECT 'fresh', id, ('0x' || left(md5(id), 8))::BIGINT % {VECTOR_BUCKETS} FROM fresh),
     t AS (SELECT part, b FROM k GROUP BY ALL),
     hit AS (SELECT part, count(*) AS files FROM t WHERE b IN (SELECT b FROM t WHERE part = 'extra') GROUP BY part),
     n AS (SELECT part, count(*) AS n, count(DISTINCT b) AS b FROM k GROUP BY part),
     v AS (SELECT coalesce(max(n) FILTER (part = 'base'), 0) AS base_n, coalesce(max(b) FILTER (part = 'base'), 0) AS base_b,
                  coalesce(max(n) FILTER (part = 'extra'), 0) AS extra_n, coalesce(max(b) FILTER (part = 'extra'), 0) AS extra_b,
                  coalesce(max(n) FILTER (part = 'fresh'), 0) AS fresh_n, coalesce(max(b) FILTER (part = 'fresh'), 0) AS fresh_b FROM n),
     h AS (SELECT coalesce(max(files) FILTER (part = 'base'), 0) AS base_f, coalesce(max(files) FILTER (part = 'fresh'), 0) AS fresh_f FROM hit)
SELECT 1::BIGINT AS load_no, base_n::BIGINT AS rows_in, base_n::BIGINT AS written, base_b::BIGINT AS buckets_touched, 0::BIGINT AS files_read, 0::BIGINT AS files_total FROM v
UNION ALL SELECT 2, extra_n, fresh_n, extra_b, base_f, base_b FROM v, h
UNION ALL SELECT 3, extra_n, 0, extra_b, base_f + fresh_f, base_b + fresh_b FROM v, h""")
def delta_loads(spark, sf):
    """Insert-if-absent loads of vectors into a bucketed table and what each
    read: all labels but 1, then label 1 under other keys, then that again."""
    old, new = stored_vectors(spark, sf)
    root = _root(spark, "delta-loads")
    DT.create(spark, root, new.drop("ordinal").schema, "id", VECTOR_BUCKETS)
    base = old.where(~F.col("label").eqNullSafe(1))
    reports = [asdict(DT.insert_new(spark, root, batch, "ordinal")) for batch in (base, new, new)]
    names = ("rows_in", "written", "buckets_touched", "files_read", "files_total")
    return spark.createDataFrame([(i + 1, *[r[n] for n in names]) for i, r in enumerate(reports)],
                                 "load_no long, " + ", ".join(f"{n} long" for n in names))


@register("job_load_catalogue", f"""
WITH it AS {ITEMS_SQL}
SELECT row_number() OVER (ORDER BY length(solution) >= {SHORT} OR solution IS NULL, ordinal)::BIGINT AS id, url, product, category,
       sha256(solution) AS solution_sha, sha256(solution) AS meta_solution_sha, 0::BIGINT AS added_again
FROM it""")
def job_load_catalogue(spark, sf):
    """A catalogue loaded into its stored table and vectors three times: the
    items with short solutions, all items, all items again (which adds
    nothing).  Stored rows with their vectors' metadata."""
    items = I.documents_as_items(read_table(spark, sf, "documents"))
    table, vectors = _root(spark, "catalogue"), _root(spark, "catalogue-vectors")
    for part in (items.where(F.length("solution") < SHORT), items, items):
        added, _ = J.load_catalogue(part, table, vectors, buckets=LOAD_BUCKETS)
    meta = DT.read(spark, vectors).select(F.col("metadata.db_id").cast("long").alias("id"), F.sha2("metadata.solution", 256).alias("meta_solution_sha"))
    # hashed before the join: no text is shuffled
    stored = DT.read(spark, table).withColumn("solution_sha", F.sha2("solution", 256)).drop("solution")
    return stored.join(meta, "id", "left").select(
        "id", "url", "product", "category", "solution_sha", "meta_solution_sha", F.lit(added.written).cast("long").alias("added_again"))


@register("job_load_knowledge", f"""
WITH d AS (SELECT 0 AS src, doc_id AS ordinal, 'https://' || source || '.example.com/doc/' || doc_id::VARCHAR AS url,
                  split_part(text, chr(10), 1) AS issue, text AS solution, source AS product, source AS s FROM documents),
p AS (SELECT 1 AS src, page_id AS ordinal, url,
             coalesce(nullif({O.title('html')}, ''), nullif({O.heading('html')}, ''), 'Untitled') AS issue,
             coalesce(nullif(array_to_string(list_filter({O.paragraphs('html')}, lambda x: x <> ''), ' '), ''),
                      'No description available') AS solution,
             'unknown product' AS product, 'page' AS s
      FROM pages WHERE NOT contains(url, 'LogonForm')),
u AS (SELECT *, {brand_sql('s')} AS brand FROM (SELECT * FROM d UNION ALL SELECT * FROM p)),
f AS (SELECT *, row_number() OVER (PARTITION BY brand, url, product, issue, solution ORDER BY src, ordinal) AS rn FROM u)
SELECT row_number() OVER (ORDER BY src, ordinal)::BIGINT AS id, brand, url, sha256(issue) AS issue_sha, sha256(solution) AS solution_sha,
       true AS has_vector, 0::BIGINT AS added_again FROM f WHERE rn = 1""")
def job_load_knowledge(spark, sf):
    """Knowledge loaded into its stored table and vectors three times: the
    documents, documents and pages, both again (which adds nothing)."""
    docs = I.documents_as_items(read_table(spark, sf, "documents")).withColumn("source", F.col("product"))
    pages = J.page_items(read_table(spark, sf, "pages")).select(
        F.col("page_id").alias("ordinal"), "url", F.col("issue").alias("title"),
        F.col("solution").alias("description"), "product", F.lit("page").alias("source"))
    table, vectors = _root(spark, "knowledge"), _root(spark, "knowledge-vectors")
    for sources in ([docs], [docs, pages], [docs, pages]):
        added, _ = J.load_knowledge(sources, BRANDS, DEFAULT_BRAND, table, vectors, buckets=LOAD_BUCKETS)
    has = DT.read(spark, vectors).select(F.col("id").alias("key"), F.lit(True).alias("has_vector"))
    # hashed before the join: no text is shuffled
    stored = DT.read(spark, table).select("key", "id", "brand", "url", F.sha2("issue", 256).alias("issue_sha"), F.sha2("solution", 256).alias("solution_sha"))
    return stored.join(has, "key", "left").select(
        "id", "brand", "url", "issue_sha", "solution_sha",
        F.coalesce("has_vector", F.lit(False)).alias("has_vector"), F.lit(added.written).cast("long").alias("added_again"))

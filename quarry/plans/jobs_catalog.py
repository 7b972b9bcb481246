"""Registered composite jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import items as I
from ..session import read_table
from . import jobs as J
from . import oracle as O
from ..operators import embed as EM
from ..schema import EMBEDDING_DIM
from .docs_catalog import ITEMS_SQL
from .docs_catalog import BRANDS, DEFAULT_BRAND, brand_sql
from .pages_catalog import HARVEST_LINKS_SQL
from .registry import register

FLOW_QUESTION = "lighting issue"
FLOW_KEYWORD = "lighting"

@register("job_harvest", f"""
WITH l AS {HARVEST_LINKS_SQL},
r AS (SELECT page_id, pos, {O.resolve('url', 'href')} AS url,
             coalesce(nullif(text, ''), 'unknown product') AS product,
             coalesce(nullif(lang, ''), 'document') AS category,
             replace(split_part(href, '/', -1), '.pdf', '') AS issue, 0 AS depth
      FROM l WHERE NOT contains(url, 'LogonForm'))
SELECT page_id, pos, url, product, category, issue, depth, '{J.LINK_PREFIX}' || url AS solution
FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id, pos) AS rn FROM r)
WHERE rn = 1""")
def job_harvest(spark, sf):
    """Flagship: stored pages → gate → links → resolved item per distinct
    URL (first in page/position order)."""
    return J.harvest(read_table(spark, sf, "pages")).select(
        "page_id", "pos", "url", "product", "category", "issue", "depth", "solution")


def weighted():
    """Sum of an embedding's weights times their positions, from 1."""
    return F.round(F.aggregate(F.transform("embedding", lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda a, x: a + x), 2)


CATALOGUE_SQL = f"""
WITH it AS {ITEMS_SQL},
t AS (SELECT ordinal, product || ' ' || category || ' ' || issue || ' ' || solution AS txt FROM it),
tok AS (SELECT ordinal, unnest(regexp_extract_all(lower(txt), {O.q(EM.TOKEN_RE)})) AS tok FROM t),
b AS (SELECT ordinal, {O.bucket_of('tok', EMBEDDING_DIM)} AS bucket, count(*)::DOUBLE AS c FROM tok GROUP BY ALL),
nz AS (SELECT ordinal, count(*)::BIGINT AS nnz, sum(c * (bucket + 1)) / sqrt(sum(c * c)) AS weighted FROM b GROUP BY ordinal)
SELECT row_number() OVER (ORDER BY it.ordinal)::BIGINT AS id, it.url, it.product, it.category,
       'doc_' || it.ordinal::VARCHAR AS vector_id, coalesce(nz.nnz, 0)::BIGINT AS nnz, round(nz.weighted, 2) AS weighted,
       sha256(it.solution) AS meta_solution_sha
FROM it LEFT JOIN nz USING (ordinal)"""


@register("job_catalogue", CATALOGUE_SQL)
def job_catalogue(spark, sf):
    """Catalogue load over the documents' items: table rows (dense ids in
    input order) joined with their vector's id and sparsity.  The load
    timestamp stays in the table; it is left out here so the result is
    deterministic."""
    table, vectors = J.catalogue(I.documents_as_items(read_table(spark, sf, "documents")))
    nnz = vectors.select(F.col("metadata.db_id").cast("long").alias("id"), F.col("id").alias("vector_id"),
                         F.size(F.filter("embedding", lambda x: x != 0)).cast("long").alias("nnz"), weighted().alias("weighted"),
                         F.sha2("metadata.solution", 256).alias("meta_solution_sha"))
    return table.join(nnz, "id", "left").select("id", "url", "product", "category", "vector_id", "nnz", "weighted", "meta_solution_sha")


KB_LOAD_SQL = f"""
WITH d AS (SELECT 0 AS src, doc_id AS ordinal,
                  'https://' || source || '.example.com/doc/' || doc_id::VARCHAR AS url,
                  split_part(text, chr(10), 1) AS issue, text AS solution, source AS product, source AS s
           FROM documents),
p AS (SELECT 1 AS src, page_id AS ordinal, url,
             coalesce(nullif({O.title('html')}, ''), nullif({O.heading('html')}, ''), 'Untitled') AS issue,
             coalesce(nullif(array_to_string(list_filter({O.paragraphs('html')}, lambda x: x <> ''), ' '), ''),
                      'No description available') AS solution,
             'unknown product' AS product, 'page' AS s
      FROM pages WHERE NOT contains(url, 'LogonForm')),
u AS (SELECT * FROM d UNION ALL SELECT * FROM p),
k AS (SELECT row_number() OVER (ORDER BY src, ordinal)::BIGINT AS id, {brand_sql('s')} AS brand,
             url, issue, solution, product FROM u),
tok AS (SELECT id, unnest(regexp_extract_all(lower(brand || ' ' || issue || ' ' || solution || ' ' || product), {O.q(EM.TOKEN_RE)})) AS tok FROM k),
b AS (SELECT id, {O.bucket_of('tok', EMBEDDING_DIM)} AS bucket, count(*)::DOUBLE AS c FROM tok GROUP BY ALL),
w AS (SELECT id, round(sum(c * (bucket + 1)) / sqrt(sum(c * c)), 2) AS weighted FROM b GROUP BY id)
SELECT id, brand, url, sha256(issue) AS issue_sha, sha256(solution) AS solution_sha, true AS has_vector, weighted,
       CASE WHEN {O.word_count('solution')} < 100 THEN sha256(solution) ELSE sha256('') END AS meta_solution_sha
FROM k LEFT JOIN w USING (id)"""


@register("job_kb_load", KB_LOAD_SQL)
def job_kb_load(spark, sf):
    """Knowledge load from two sources (documents and page items)."""
    docs = I.documents_as_items(read_table(spark, sf, "documents")).withColumn("source", F.col("product"))
    pages = J.page_items(read_table(spark, sf, "pages")).select(
        F.col("page_id").alias("ordinal"), "url", F.col("issue").alias("title"),
        F.col("solution").alias("description"), "product", F.lit("page").alias("source"))
    kb, vectors = J.kb_load([docs, pages], BRANDS, DEFAULT_BRAND)
    found = vectors.select(F.col("metadata.db_id").cast("long").alias("id"), (F.length("id") == 64).alias("has_vector"),
                           weighted().alias("weighted"), F.sha2("metadata.solution", 256).alias("meta_solution_sha"))
    return kb.join(found, "id", "left").select(
        "id", "brand", "url", F.sha2("issue", 256).alias("issue_sha"), F.sha2("solution", 256).alias("solution_sha"),
        "has_vector", "weighted", "meta_solution_sha")


@register("job_file_load", f"""
WITH it AS {ITEMS_SQL},
f AS (SELECT url, issue, product, solution, left(solution, {J.SOLUTION_CUT}) AS cut FROM it),
tok AS (SELECT url, unnest(regexp_extract_all(lower(issue || ' ' || cut || ' ' || product), {O.q(EM.TOKEN_RE)})) AS tok FROM f),
b AS (SELECT url, {O.bucket_of('tok', EMBEDDING_DIM)} AS bucket, count(*)::DOUBLE AS c FROM tok GROUP BY ALL),
w AS (SELECT url, round(sum(c * (bucket + 1)) / sqrt(sum(c * c)), 2) AS weighted FROM b GROUP BY url)
SELECT url, length(solution) > {J.SOLUTION_CUT} AS truncated, length(solution)::BIGINT AS solution_chars, sha256(cut) AS stored_sha, weighted
FROM f LEFT JOIN w USING (url)""")
def job_file_load(spark, sf):
    """What a single-file load stores of the documents' items: solutions
    cut to 10,000 characters, flagged, and the vector of the cut text."""
    vectors = J.cut_vectors(I.documents_as_items(read_table(spark, sf, "documents")))
    return vectors.select("metadata.url", "truncated", "solution_chars", F.sha2("metadata.solution", 256).alias("stored_sha"), weighted().alias("weighted"))


@register("job_flow")
def job_flow(spark, sf):
    """Scrape → filter → load → query flow over stored pages."""
    return J.flow(read_table(spark, sf, "pages"), FLOW_QUESTION, FLOW_KEYWORD)

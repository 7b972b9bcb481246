"""Registered item queries over ``documents`` (cleaning, routing,
dedupe, ids, stores, sinks, keyword search, relevance, stage counts).

Item view: ``issue`` = first line, ``solution`` = text, ``product`` =
source, ``category`` = lang, ordinal = ``doc_id``.  Long texts leave a
query as SHA-256 digests and lengths.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import dedupe as D
from ..operators import items as I
from ..operators import relevance as R
from ..operators import retrieve as RT
from ..operators import store as S
from ..schema import NO_MATCH
from ..session import read_table
from . import oracle as O
from .registry import register

# Fixed values of the registered queries.
BRANDS = {"src0": "Northwind", "src1": "Contoso", "src2": "Fabrikam", "src3": "Tailspin"}
DEFAULT_BRAND = "generic"
LINK_PREFIX = "Document link: "
# The topics as whole words, written out for the oracle.
RELEVANT = (r"(^|[^\p{L}\p{N}])(home automation|equipment racks|switches|receivers|matrix amps|audio|video|routers|"
            r"tvs|cameras|lighting|automation|integration)([^\p{L}\p{N}]|$)")
SEARCH_KEYWORD = "license"
ANSWER_CHARS = 100
EXISTING_LANG = "en"
CUTS = (40000, 10000, 8192, 2000, 1000, 500, 200, 100, 50)
BATCH = 100


def docs(spark, sf):
    return read_table(spark, sf, "documents")


def items(spark, sf):
    return I.documents_as_items(docs(spark, sf))


ITEMS_SQL = """
  (SELECT doc_id AS ordinal, 'https://' || source || '.example.com/doc/' || doc_id::VARCHAR AS url,
          split_part(text, chr(10), 1) AS issue, text AS solution, source AS product,
          lang AS category, 0 AS depth
   FROM documents)"""


def brand_sql(col: str) -> str:
    whens = " ".join(f"WHEN {col} = {O.q(k)} THEN {O.q(v)}" for k, v in sorted(BRANDS.items()))
    return f"CASE {whens} ELSE {O.q(DEFAULT_BRAND)} END"


@register("trim_fields", f"""
SELECT ordinal AS doc_id, {O.strip_ws('issue')} AS issue, {O.strip_ws('product')} AS product,
       {O.strip_ws('category')} AS category,
       length({O.strip_ws('solution')})::BIGINT AS solution_chars,
       sha256({O.strip_ws('solution')}) AS solution_sha
FROM {ITEMS_SQL}""")
def trim_fields(spark, sf):
    t = I.trim_fields(items(spark, sf))
    return t.select(F.col("ordinal").alias("doc_id"), "issue", "product", "category",
                    F.char_length("solution").cast("long").alias("solution_chars"),
                    F.sha2("solution", 256).alias("solution_sha"))


@register("or_default", f"""
SELECT ordinal AS doc_id, coalesce(nullif(issue, ''), 'unknown') AS issue FROM {ITEMS_SQL}""")
def or_default(spark, sf):
    return items(spark, sf).select(F.col("ordinal").alias("doc_id"),
                                   T.or_default("issue", "unknown").alias("issue"))


@register("project_defaults", """
SELECT d.doc_id, coalesce(l.quality, -1) AS quality, coalesce(l.toxic, -1) AS toxic
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def project_defaults(spark, sf):
    joined = docs(spark, sf).select("doc_id").join(read_table(spark, sf, "labels"), "doc_id", "left")
    return I.project_defaults(joined, {"quality": -1, "toxic": -1})


@register("normalise_keys", """
SELECT doc_id,
       coalesce(CASE WHEN contains(text, chr(10)) THEN split_part(text, chr(10), 1) END, lang) AS issue,
       sha256(coalesce(CASE WHEN lang <> 'en' THEN text END, source)) AS solution_sha
FROM documents""")
def normalise_keys(spark, sf):
    d = docs(spark, sf).select(
        "doc_id",
        F.when(F.col("text").contains("\n"), T.first_line("text")).alias("title"),
        F.when(F.col("lang") != "en", F.col("text")).alias("description"),
        F.col("lang").alias("issue"),
        F.col("source").alias("solution"),
    )
    return I.normalise_keys(d).select("doc_id", "issue", F.sha2("solution", 256).alias("solution_sha"))


@register("fallback_text", """
SELECT doc_id,
       sha256(coalesce(CASE WHEN lang = 'en' THEN text END, concat_ws(' ', doc_id::VARCHAR, lang, source))) AS text_sha
FROM documents""")
def fallback_text(spark, sf):
    d = docs(spark, sf).select("doc_id", "lang", "source",
                               F.when(F.col("lang") == "en", F.col("text")).alias("solution"))
    return I.fallback_text(d).select("doc_id", F.sha2("fallback_text", 256).alias("text_sha"))


@register("first_token", f"""
SELECT ordinal AS doc_id, {O.first_token('issue')} AS token FROM {ITEMS_SQL}""")
def first_token(spark, sf):
    return items(spark, sf).select(F.col("ordinal").alias("doc_id"), T.first_token("issue").alias("token"))


@register("template_text", f"""
SELECT ordinal AS doc_id, {O.q(LINK_PREFIX)} || url AS text FROM {ITEMS_SQL}""")
def template_text(spark, sf):
    return items(spark, sf).select(F.col("ordinal").alias("doc_id"),
                                   T.template(LINK_PREFIX, F.col("url")).alias("text"))


@register("embed_text", f"""
SELECT ordinal AS doc_id,
       sha256(issue || ' ' || solution || ' ' || product) AS kb_sha,
       sha256(product || ' ' || category || ' ' || issue || ' ' || solution) AS catalogue_sha,
       length({O.strip_ws("issue || ' ' || solution || ' ' || product")})::BIGINT AS kb_stripped_chars
FROM {ITEMS_SQL}""")
def embed_text(spark, sf):
    it = items(spark, sf)
    it = I.embed_text(it, "kb", "kb_text")
    it = I.embed_text(it, "catalogue", "catalogue_text")
    it = I.embed_text(it, "kb", "kb_stripped", strip=True)
    return it.select(F.col("ordinal").alias("doc_id"), F.sha2("kb_text", 256).alias("kb_sha"),
                     F.sha2("catalogue_text", 256).alias("catalogue_sha"),
                     F.char_length("kb_stripped").cast("long").alias("kb_stripped_chars"))


@register("truncate_text", "SELECT doc_id, " + ", ".join(
    f"length(left(text, {n}))::BIGINT AS len_{n}, length(text) > {n} AS cut_{n}" for n in CUTS
) + ", left(text, 50) AS head_50, sha256(left(text, 2000)) AS sha_2000 FROM documents")
def truncate_text(spark, sf):
    cols = []
    for n in CUTS:
        cols += [F.char_length(T.truncate("text", n)).cast("long").alias(f"len_{n}"),
                 T.was_truncated("text", n).alias(f"cut_{n}")]
    return docs(spark, sf).select("doc_id", *cols, T.truncate("text", 50).alias("head_50"),
                                  F.sha2(T.truncate("text", 2000), 256).alias("sha_2000"))


@register("word_gate", f"""
SELECT doc_id, {O.word_count('text')}::BIGINT AS word_count,
       sha256(CASE WHEN {O.word_count('text')} < 100 THEN text ELSE '' END) AS gated_sha
FROM documents""")
def word_gate(spark, sf):
    return docs(spark, sf).select("doc_id", T.word_count("text").cast("long").alias("word_count"),
                                  F.sha2(T.word_gate("text"), 256).alias("gated_sha"))


@register("record_id", """
SELECT doc_id, sha256(text) AS content_id, 'doc_' || doc_id::VARCHAR AS ordinal_id FROM documents""")
def record_id(spark, sf):
    return I.record_ids(docs(spark, sf), "text", "doc_id").select("doc_id", "content_id", "ordinal_id")


@register("non_blank", f"SELECT doc_id FROM documents WHERE NOT {O.is_blank('text')}")
def non_blank(spark, sf):
    return I.non_blank(docs(spark, sf), "text").select("doc_id")


@register("route_items", f"""
SELECT ordinal AS doc_id,
       CASE WHEN NOT {O.is_blank('issue')} OR NOT {O.is_blank('solution')} THEN 'kept' ELSE 'discarded' END AS route
FROM {ITEMS_SQL}""")
def route_items(spark, sf):
    return I.route(items(spark, sf), fields=("issue", "solution")).select(
        F.col("ordinal").alias("doc_id"), "route")


@register("brand_by_source", f"SELECT doc_id, source, {brand_sql('source')} AS brand FROM documents")
def brand_by_source(spark, sf):
    return docs(spark, sf).select("doc_id", "source",
                                  I.brand_column(F.col("source"), BRANDS, DEFAULT_BRAND).alias("brand"))


@register("dedupe_first", "SELECT min(doc_id) AS doc_id, sha256(text) AS content_id FROM documents GROUP BY text")
def dedupe_first(spark, sf):
    return D.dedupe_first(docs(spark, sf), "text", "doc_id", digest=True).select(
        "doc_id", F.sha2("text", 256).alias("content_id"))


@register("distinct_keys", """
SELECT count(*)::BIGINT AS n_rows, count(DISTINCT text)::BIGINT AS n_distinct FROM documents""")
def distinct_keys(spark, sf):
    return D.distinct_count(docs(spark, sf), "text")


def keyed_docs(spark, sf):
    return docs(spark, sf).withColumn("text_key", F.sha2("text", 256))


@register("insert_if_absent", f"""
SELECT min(doc_id) AS doc_id FROM documents
WHERE text NOT IN (SELECT text FROM documents WHERE lang = '{EXISTING_LANG}')
GROUP BY text""")
def insert_if_absent(spark, sf):
    d = keyed_docs(spark, sf)
    existing = d.where(F.col("lang") == EXISTING_LANG)
    return S.insert_if_absent(existing, d, "text_key", "doc_id").select("doc_id")


@register("append_narrow", f"""
SELECT doc_id AS id, source AS brand, split_part(text, chr(10), 1) AS issue, source AS product,
       lang AS category, sha256(text) AS solution_sha
FROM documents WHERE lang = '{EXISTING_LANG}'
UNION ALL
SELECT NULL, source, NULL, source, NULL, sha256(text) FROM documents WHERE lang <> '{EXISTING_LANG}'""")
def append_narrow(spark, sf):
    d = docs(spark, sf)
    table = d.where(F.col("lang") == EXISTING_LANG).select(
        F.col("doc_id").alias("id"), F.col("source").alias("brand"), T.first_line("text").alias("issue"),
        F.col("text").alias("solution"), F.col("source").alias("product"),
        F.col("lang").alias("category"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/doc/"),
                 F.col("doc_id").cast("string")).alias("url"))
    narrow = d.where(F.col("lang") != EXISTING_LANG).select(
        F.col("source").alias("brand"), F.col("text").alias("solution"), F.col("source").alias("product"))
    return S.append_narrow(table, narrow).select(
        "id", "brand", "issue", "product", "category", F.sha2("solution", 256).alias("solution_sha"))


@register("assign_ids", """
SELECT doc_id, row_number() OVER (ORDER BY lang, doc_id)::BIGINT AS id FROM documents""")
def assign_ids(spark, sf):
    d = docs(spark, sf).select("doc_id", "lang", F.struct("lang", "doc_id").alias("__ord"))
    return S.assign_ids(d, "__ord").select("doc_id", "id")


@register("batch_ids", f"""
WITH f AS (SELECT min(doc_id) AS doc_id FROM documents GROUP BY text),
     n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id)::BIGINT AS id FROM f)
SELECT doc_id, id, ((id - 1) // {BATCH})::BIGINT AS batch_id FROM n""")
def batch_ids(spark, sf):
    firsts = D.dedupe_first(docs(spark, sf).select("doc_id", "text"), "text", "doc_id", digest=True)
    ided = S.assign_ids(firsts.select("doc_id"), "doc_id")
    return S.batch_ids(ided, size=BATCH).select("doc_id", "id", "batch_id")


@register("sink_jsonl", f"""
SELECT ordinal AS doc_id,
       sha256(to_json({{'url': url, 'issue': issue, 'solution': solution, 'product': product,
                        'category': category, 'depth': depth}})) AS line_sha
FROM {ITEMS_SQL}""")
def sink_jsonl(spark, sf):
    it = items(spark, sf)
    line = F.to_json(F.struct("url", "issue", "solution", "product", "category", "depth"))
    return it.select(F.col("ordinal").alias("doc_id"), F.sha2(line, 256).alias("line_sha"))


@register("vector_metadata", f"""
SELECT ordinal AS doc_id,
       sha256(to_json({{'brand': {brand_sql('product')}, 'issue': issue,
                        'solution': CASE WHEN {O.word_count('solution')} < 100 THEN solution ELSE '' END,
                        'product': product, 'category': category, 'url': url,
                        'db_id': ordinal::VARCHAR}})) AS metadata_sha
FROM {ITEMS_SQL}""")
def vector_metadata(spark, sf):
    it = items(spark, sf)
    meta = I.vector_metadata(I.brand_column(F.col("product"), BRANDS, DEFAULT_BRAND), F.col("issue"),
                             F.col("solution"), F.col("product"), F.col("category"), F.col("url"),
                             F.col("ordinal"))
    return it.select(F.col("ordinal").alias("doc_id"), F.sha2(F.to_json(meta), 256).alias("metadata_sha"))


@register("keyword_search", f"""
WITH q AS (SELECT DISTINCT source FROM documents),
     m AS (SELECT source, min(doc_id) AS match_id FROM documents
           WHERE text ILIKE '%{SEARCH_KEYWORD}%' GROUP BY source)
SELECT q.source, m.match_id, coalesce(left(d.text, {ANSWER_CHARS}), '{NO_MATCH}') AS answer
FROM q LEFT JOIN m USING (source) LEFT JOIN documents d ON d.doc_id = m.match_id""")
def keyword_search(spark, sf):
    d = docs(spark, sf)
    queries = d.select(F.col("source").alias("query_id")).distinct().withColumn(
        "keyword", F.lit(SEARCH_KEYWORD)).withColumn("brand", F.col("query_id"))
    res = RT.keyword_first_match(d.select("doc_id", "text", F.col("source").alias("brand")), queries,
                                 "text", "doc_id", brand_col="brand", answer_chars=ANSWER_CHARS)
    return res.select(F.col("query_id").alias("source"), "match_id", "answer")


@register("stage_counts", f"""
SELECT 'loaded' AS stage, count(*)::BIGINT AS n FROM documents
UNION ALL SELECT 'non_blank', count(*) FILTER (WHERE NOT {O.is_blank('text')}) FROM documents
UNION ALL SELECT 'distinct', count(DISTINCT text) FROM documents
UNION ALL SELECT 'kept', count(*) FILTER (WHERE NOT {O.is_blank('split_part(text, chr(10), 1)')}
                                         OR NOT {O.is_blank('text')}) FROM documents""")
def stage_counts(spark, sf):
    it = I.route(items(spark, sf), fields=("issue", "solution"))
    agg = it.agg(
        F.count(F.lit(1)).alias("loaded"),
        F.count_if(~T.is_blank("solution")).alias("non_blank"),
        F.count_distinct(F.sha2("solution", 256)).alias("distinct"),
        F.count_if(F.col("route") == I.ROUTE_KEPT).alias("kept"),
    )
    return agg.select(F.expr(
        "stack(4, 'loaded', loaded, 'non_blank', non_blank, 'distinct', `distinct`, 'kept', kept) AS (stage, n)"
    )).select("stage", F.col("n").cast("long").alias("n"))


@register("relevance_rule", f"""
SELECT doc_id,
       CASE WHEN coalesce(regexp_matches(lower(text), {O.q(RELEVANT)}), false)
            THEN 'yes' ELSE 'no' END AS verdict
FROM documents""")
def relevance_rule(spark, sf):
    return R.topic_rule(docs(spark, sf), "text").select("doc_id", "verdict")


@register("relevance_model")
def relevance_model(spark, sf):
    """MLlib classifier trained on the labelled documents (quality),
    applied to every document.  Rows-only check."""
    d = docs(spark, sf)
    labelled = d.join(read_table(spark, sf, "labels"), "doc_id").withColumnRenamed("quality", "label")
    model = R.train_model(labelled, "text", "label")
    return R.apply_model(model, d.select("doc_id", "text"), "text").select("doc_id", "verdict", "relevant")

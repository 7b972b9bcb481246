"""Registered page queries (extraction, links, gates, crawl)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import url as U
from ..operators import crawl as C
from ..operators import dedupe as D
from ..operators import pages as P
from ..session import materialize, read_table
from . import oracle as O
from .registry import register

# Parameters of the registered page queries (the pages in the test
# tables have root-relative links, no '.pdf' links and no 'Next' link,
# so the markers below are ones that occur in them).
DOC_MARKER = ".pdf"
SUFFIX = ","
WORD = "the"
KEYWORD = "the"
FIRST_N = 3
NEXT_LABEL = "the"
STEM_SUFFIX = ".html"
MAX_DEPTH = 5


def pages(spark, sf):
    return P.as_pages(read_table(spark, sf, "pages"))


LINKS_SQL = f"""
  (SELECT page_id, url, {O.link_hrefs('html')} AS hrefs, {O.link_texts('html')} AS texts
   FROM pages)"""

# Pages with their links as lists; the language is what job_harvest adds.
LANG_SQL = "regexp_extract(html, '(?i)<html[^>]*\\slang=\"([^\"]*)\"', 1)"
HARVEST_LINKS_SQL = f"""
  (SELECT page_id, url, lang, unnest(generate_series(1, len(hrefs)))::BIGINT AS pos, unnest(hrefs) AS href, unnest(texts) AS text
   FROM (SELECT page_id, url, {LANG_SQL} AS lang, {O.link_hrefs('html')} AS hrefs, {O.link_texts('html')} AS texts FROM pages))"""

EXPLODED_SQL = f"""
  (SELECT page_id, url, unnest(generate_series(1, len(hrefs)))::BIGINT AS pos,
          unnest(hrefs) AS href, unnest(texts) AS text
   FROM {LINKS_SQL})"""


@register("page_scan", """
SELECT page_id, url, 200 AS status, 0 AS depth, length(html)::BIGINT AS html_chars FROM pages""")
def page_scan(spark, sf):
    return pages(spark, sf).select("page_id", "url", "status", "depth",
                                   F.char_length("html").cast("long").alias("html_chars"))


@register("page_title", f"""
SELECT page_id, coalesce(nullif({O.title('html')}, ''), nullif({O.heading('html')}, ''), 'Untitled') AS title
FROM pages""")
def page_title(spark, sf):
    return P.with_title(pages(spark, sf)).select("page_id", "title")


@register("extract_links", f"SELECT page_id, pos, href, text FROM {EXPLODED_SQL}")
def extract_links(spark, sf):
    return P.explode_links(pages(spark, sf)).select(
        "page_id", F.col("pos").cast("long").alias("pos"), "href", "text")


@register("page_link_counts", f"""
SELECT page_id, len(hrefs)::BIGINT AS n_links,
       len(list_filter(hrefs, lambda x: contains(x, '{DOC_MARKER}')))::BIGINT AS n_doc_links
FROM {LINKS_SQL}""")
def page_link_counts(spark, sf):
    return P.link_counts(pages(spark, sf), DOC_MARKER)


@register("filter_doc_links", f"""
SELECT page_id, pos, href,
       contains(href, '{SUFFIX}') AS has_marker,
       ends_with(href, '{SUFFIX}') AS has_suffix,
       ends_with(href, '{SUFFIX}') OR contains(lower(href), '{WORD}') AS suffix_or_word
FROM {EXPLODED_SQL}
WHERE contains(href, '{SUFFIX}') OR ends_with(href, '{SUFFIX}') OR contains(lower(href), '{WORD}')""")
def filter_doc_links(spark, sf):
    h = F.col("href")
    return (
        P.explode_links(pages(spark, sf))
        .select("page_id", F.col("pos").cast("long").alias("pos"), "href",
                P.href_contains(h, SUFFIX).alias("has_marker"),
                P.href_endswith(h, SUFFIX).alias("has_suffix"),
                P.href_endswith_or_word(h, SUFFIX, WORD).alias("suffix_or_word"))
        .where("has_marker OR has_suffix OR suffix_or_word")
    )


@register("keyword_links", f"""
SELECT page_id, pos, href, text FROM {EXPLODED_SQL}
WHERE href <> '' AND (contains(translate(text, '{P.ASCII_UPPER}', '{P.ASCII_LOWER}'), '{KEYWORD}')
                      OR contains(lower(href), '{KEYWORD}'))""")
def keyword_links(spark, sf):
    return (
        P.explode_links(pages(spark, sf))
        .where((F.col("href") != "") & P.keyword_match(F.col("text"), F.col("href"), KEYWORD))
        .select("page_id", F.col("pos").cast("long").alias("pos"), "href", "text")
    )


@register("pages_without_items", f"""
SELECT page_id, url FROM {LINKS_SQL}
WHERE NOT list_bool_or(list_transform(list_zip(hrefs, texts),
      lambda z: contains(translate(z[2], '{P.ASCII_UPPER}', '{P.ASCII_LOWER}'), '{KEYWORD}')
           OR contains(lower(z[1]), '{KEYWORD}')))
   OR len(hrefs) = 0""")
def pages_without_items(spark, sf):
    return P.pages_without_items(pages(spark, sf), KEYWORD)


@register("first_n_links", f"SELECT page_id, pos, href, text FROM {EXPLODED_SQL} WHERE pos <= {FIRST_N}")
def first_n_links(spark, sf):
    return P.first_n_links(pages(spark, sf), FIRST_N).select(
        "page_id", F.col("pos").cast("long").alias("pos"), "href", "text")


@register("next_page", f"""
SELECT page_id,
       {O.resolve('url', f"hrefs[list_position(list_transform(texts, lambda t: lower(trim(t)) = '{NEXT_LABEL}'), true)]")} AS next_url
FROM {LINKS_SQL}""")
def next_page(spark, sf):
    return P.next_page(pages(spark, sf), NEXT_LABEL)


@register("paragraph_text", f"""
SELECT page_id,
       coalesce(nullif(left(array_to_string(list_filter({O.paragraphs('html')}, lambda p: p <> ''), ' '), 1000), ''),
                'No description available') AS text
FROM pages""")
def paragraph_text(spark, sf):
    return P.paragraph_text(pages(spark, sf))


@register("paragraph_rows", f"""
SELECT page_id, pos, text FROM (
  SELECT page_id, unnest(generate_series(1, len(ps)))::BIGINT AS pos, unnest(ps) AS text
  FROM (SELECT page_id, {O.paragraphs('html')} AS ps FROM pages))
WHERE text <> ''""")
def paragraph_rows(spark, sf):
    return P.paragraph_rows(pages(spark, sf)).select(
        "page_id", F.col("pos").cast("long").alias("pos"), "text")


@register("resolve_url", f"""
SELECT page_id, pos, href, {O.resolve('url', 'href')} AS abs_url FROM {EXPLODED_SQL}""")
def resolve_url(spark, sf):
    links = P.explode_links(pages(spark, sf))
    return U.with_resolved(links, "url", "href", "abs_url").select(
        "page_id", F.col("pos").cast("long").alias("pos"), "href", "abs_url")


@register("url_stem", f"""
SELECT page_id, url, replace(split_part(url, '/', -1), '{STEM_SUFFIX}', '') AS stem FROM pages""")
def url_stem(spark, sf):
    return pages(spark, sf).select("page_id", "url", U.url_stem(F.col("url"), STEM_SUFFIX).alias("stem"))


@register("url_fingerprint", f"""
WITH c AS (SELECT page_id, {O.canonical_url('url')} AS canonical_url FROM pages)
SELECT page_id, canonical_url, sha1(canonical_url) AS fingerprint,
       page_id = min(page_id) OVER (PARTITION BY sha1(canonical_url)) AS is_first
FROM c""")
def url_fingerprint(spark, sf):
    fp = D.with_fingerprint(pages(spark, sf).select("page_id", "url"))
    return D.flag_first(fp, "fingerprint", "page_id").select(
        "page_id", "canonical_url", "fingerprint", "is_first")


@register("page_gate", """
SELECT page_id, url,
       CASE WHEN contains(url, 'LogonForm') THEN 'login_form'
            WHEN 200 IN (401, 403) THEN 'status_blocked' END AS gate
FROM pages""")
def page_gate(spark, sf):
    return P.page_gate(pages(spark, sf)).select("page_id", "url", "gate")


@register("seed_urls", """
SELECT page_id, url, page_id = (SELECT min(page_id) FROM pages) AS is_head FROM pages""")
def seed_urls(spark, sf):
    """Seed relation in input order: the head (the first page, which the
    reference handles separately) flagged, the tail as is."""
    p = pages(spark, sf).select("page_id", "url")
    head = p.agg(F.min("page_id")).first()[0]
    return p.withColumn("is_head", F.coalesce(F.col("page_id") == F.lit(head), F.lit(False)))


def link_edges(p):
    """Edges of the stored link graph: a page's links, resolved against its
    url and put in canonical form, joined with the canonical urls of the
    stored pages (the first page of each); loops are no edges."""
    links = P.explode_links(p, keep=("page_id", "url"))
    # written before it is put in canonical form: the resolved url's
    # expression would be repeated for each of its parts
    links = materialize(U.with_resolved(links, "url", "href", "abs_url").select("page_id", "abs_url"), "resolved")
    links = links.select(F.col("page_id").alias("src"), U.canonical_url(F.col("abs_url")).alias("target"))
    stored = p.select("page_id", U.canonical_url(F.col("url")).alias("target")).groupBy("target").agg(F.min("page_id").alias("dst"))
    return links.join(stored, "target").where(F.col("src") != F.col("dst")).select("src", "dst").distinct()


EDGES_SQL = f"""
  (SELECT DISTINCT e.src, s.dst FROM
     (SELECT page_id AS src, {O.canonical_url('abs_url')} AS target FROM
        (SELECT page_id, {O.resolve('url', 'href')} AS abs_url FROM {EXPLODED_SQL})) e
   JOIN (SELECT {O.canonical_url('url')} AS target, min(page_id) AS dst FROM pages GROUP BY 1) s ON s.target = e.target
   WHERE e.src <> s.dst)"""


@register("link_edges", f"SELECT src, dst FROM {EDGES_SQL}")
def stored_link_edges(spark, sf):
    """Links between stored pages, from their hrefs."""
    return link_edges(pages(spark, sf).select("page_id", "url", "html"))


@register("crawl_depth", f"""
WITH RECURSIVE edges AS {EDGES_SQL},
roots AS (SELECT page_id FROM pages WHERE page_id NOT IN (SELECT dst FROM edges)),
walk(node, depth) AS (
  SELECT page_id, 0 FROM roots
  UNION
  SELECT e.dst, w.depth + 1 FROM walk w JOIN edges e ON e.src = w.node WHERE w.depth < {MAX_DEPTH})
SELECT node AS page_id, min(depth)::BIGINT AS depth FROM walk GROUP BY node""")
def crawl_depth(spark, sf):
    """Breadth-first walk from the pages nobody links to, depth ≤ 5."""
    p = pages(spark, sf).select("page_id", "url", "html")
    edges = materialize(link_edges(p), "links")
    roots = p.select(F.col("page_id").alias("node")).join(
        edges.select(F.col("dst").alias("node")), "node", "left_anti")
    return C.bfs(roots, edges, MAX_DEPTH).select(
        F.col("node").alias("page_id"), F.col("depth").cast("long").alias("depth"))


@register("decode_body", """
SELECT page_id, length(html)::BIGINT AS n_chars, sha256(html) AS body_sha FROM pages""")
def decode_body(spark, sf):
    return pages(spark, sf).select(
        "page_id", F.char_length("html").cast("long").alias("n_chars"),
        F.sha2("html", 256).alias("body_sha"))


__all__ = ["pages", "link_edges"]

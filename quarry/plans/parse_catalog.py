"""Registered contextual-extraction queries (HTML node table)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html as H
from ..operators import parse as PR
from ..session import read_table
from . import oracle as O
from .registry import register

MARKER = "results"
SNIPPET_ANCHOR = "h1"
SNIPPET_CHARS = 1000
RESULT_TAG = "li"


def nodes(spark, sf):
    return PR.with_nodes(read_table(spark, sf, "pages").select("page_id", "url", "html"))


LI_RE = r'(?s)<li[^>]*>\s*<a\s[^>]*?href="([^"]*)"[^>]*>([^<]*)</a>'


@register("extract_results", f"""
SELECT page_id, coalesce(nullif(title, ''), 'Untitled') AS title, '' AS description, link,
       NULL::VARCHAR AS doc_link FROM (
  SELECT page_id, unnest(regexp_extract_all({O.drop_scripts('html')}, {O.q(LI_RE)}, 1)) AS link,
         unnest(list_transform(regexp_extract_all({O.drop_scripts('html')}, {O.q(LI_RE)}, 2),
                lambda t: {O.clean_text('t')})) AS title
  FROM pages)""")
def extract_results(spark, sf):
    """Search-result blocks (here: list items of the page navigation):
    title, joined paragraphs, first link, first document link."""
    return PR.extract_results(nodes(spark, sf), container_tag=RESULT_TAG, container_class=None).select(
        "page_id", "title", "description", "link", "doc_link")


@register("links_and_embeds", f"""
SELECT page_id, unnest(generate_series(1, len(h)))::BIGINT AS pos, unnest(h) AS target
FROM (SELECT page_id, {O.link_hrefs('html')} AS h FROM pages)""")
def links_and_embeds(spark, sf):
    n = nodes(spark, sf)
    return n.select("page_id", F.posexplode_outer(PR.links_and_embeds(F.col("nodes"))).alias("p", "target")).where(
        F.col("p").isNotNull()).select(
        "page_id", (F.col("p") + 1).cast("long").alias("pos"), "target")


@register("href_or_src", f"""
SELECT page_id, unnest({O.link_hrefs('html')}) AS target FROM pages""")
def href_or_src(spark, sf):
    n = nodes(spark, sf)
    el = F.filter("nodes", lambda x: x["tag"].isin("a", "embed"))
    return n.select("page_id", F.explode_outer(el).alias("n")).where(F.col("n").isNotNull()).select(
        "page_id", PR.href_or_src(F.col("n")).alias("target")).where(F.col("target").isNotNull())


@register("links_after_marker", f"""
WITH m AS (SELECT page_id, html, regexp_extract(html, '<div[^>]*>[^<]*{MARKER}', 0) AS mk FROM pages)
SELECT page_id, unnest(regexp_extract_all(substr(html, strpos(html, mk) + length(mk)), {O.q(H.LINK_RE)}, 1)) AS href
FROM m WHERE mk <> ''""")
def links_after_marker(spark, sf):
    """Links that follow the first div mentioning 'results'."""
    return PR.links_after_marker(nodes(spark, sf), MARKER).select("page_id", "href")


@register("link_snippet", f"""
SELECT page_id, {O.heading('html')} AS title,
       left(array_to_string(list_filter({O.paragraphs('html')}, lambda p: p <> ''), ' '), {SNIPPET_CHARS}) AS snippet
FROM pages""")
def link_snippet(spark, sf):
    """Text next to each page heading: following sibling paragraphs,
    paragraphs in following sibling divs, enclosing paragraph."""
    return PR.link_snippet(nodes(spark, sf), SNIPPET_ANCHOR, SNIPPET_CHARS).select("page_id", "title", "snippet")


@register("extract_cards")
def extract_cards(spark, sf):
    """Result cards with a document link and a category node, rejects
    with their reason (rows-only)."""
    return PR.extract_cards(nodes(spark, sf)).select(
        "page_id", "card_pos", "href", F.coalesce("product", "link_text").alias("product"), "category", "reason")


@register("attr_or_text", f"""
SELECT page_id, 'unknown' AS sku, coalesce(nullif({O.strip_ws('href')}, ''), 'unknown') AS ref FROM (
  SELECT page_id, unnest(regexp_extract_all({O.drop_scripts('html')}, {O.q(LI_RE)}, 1)) AS href FROM pages)""")
def attr_or_text(spark, sf):
    """Per list item: attribute-or-text lookups with defaults - a
    ``data-sku`` attribute or ``.sku`` text (absent here, so the default),
    and an ``href`` attribute or ``.category`` text."""
    n = nodes(spark, sf)
    items = F.filter("nodes", lambda x: x["tag"] == RESULT_TAG)
    return n.select("page_id", F.explode_outer(F.transform(items, lambda c: F.struct(
        c["pos"].alias("pos"),
        PR.attr_or_text(F.col("nodes"), c, "data-sku", "sku", "unknown").alias("sku"),
        PR.attr_or_text(F.col("nodes"), c, "href", "category", "unknown").alias("ref")))).alias("r")).where(
        F.col("r").isNotNull()).select("page_id", "r.sku", "r.ref")

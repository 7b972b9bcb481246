"""Page-level operators over a table of stored HTML pages.

A page is one row (``page_id, url, html`` plus optional ``status`` and
``depth``).  Everything here is a narrow, per-row transformation: the
link list of a page is an array column, so per-page counts, "first n",
"first match" and "any match" need no shuffle at all.  Only operators
that compare across pages (dedupe, crawl) shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as T
from ..functions import url as U

# Upper and lower case ASCII letters, as the XPath
# translate() call uses them for case folding.
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"

DEFAULT_STATUS = 200
DEFAULT_DEPTH = 0


def as_pages(df: DataFrame) -> DataFrame:
    """Conform a page table to PAGE: ``status``/``depth`` default to
    200/0 when the source has no such columns; the body is decoded to
    valid UTF-8 with invalid bytes ignored."""
    cols = set(df.columns)
    status = F.col("status").cast("int") if "status" in cols else F.lit(DEFAULT_STATUS)
    depth = F.coalesce(F.col("depth").cast("int"), F.lit(DEFAULT_DEPTH)) if "depth" in cols \
        else F.lit(DEFAULT_DEPTH)
    return df.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url"),
        T.decode_body("html").alias("html"),
        status.alias("status"),
        depth.alias("depth"),
    )


# --- gates -------------------------------------------------------------

def gate_reason(url: Column, status: Column, login_marker: str = "LogonForm",
                blocked_status=(401, 403), login_word: str | None = None) -> Column:
    """Why a page is dropped before extraction, or null if it is kept.
    ``login_word``: also drop urls that hold it (a browser check, off)."""
    reason = (
        F.when(url.contains(login_marker), F.lit("login_form"))
        .when(status.isin(*blocked_status), F.lit("status_blocked"))
    )
    if login_word:
        reason = reason.when(F.lower(url).contains(login_word), F.lit("login_url"))
    return reason


def page_gate(pages: DataFrame, **kw) -> DataFrame:
    """Adds ``gate`` (null = kept)."""
    return pages.withColumn("gate", gate_reason(F.col("url"), F.col("status"), **kw))


def passed(pages: DataFrame, **kw) -> DataFrame:
    return page_gate(pages, **kw).where(F.col("gate").isNull()).drop("gate")


# --- page fields -------------------------------------------------------

def with_title(pages: DataFrame, default: str = "Untitled") -> DataFrame:
    """Title with fallbacks: normalised <title> text, else the first
    heading, else ``default``."""
    return pages.withColumn(
        "title",
        F.coalesce(F.nullif(H.title("html"), F.lit("")), F.nullif(H.heading("html"), F.lit("")),
                   F.lit(default)),
    )


def with_links(pages: DataFrame) -> DataFrame:
    """Adds ``links`` = array<struct<href, text>> in document order."""
    return pages.withColumn("links", H.links("html"))


def explode_links(pages: DataFrame, keep=("page_id", "url")) -> DataFrame:
    """One row per anchor: ``pos`` (1-based document order), href, text."""
    base = pages if "links" in pages.columns else with_links(pages)
    # The outer form keeps the optimizer from inferring a size(links) > 0
    # filter and pushing it (a second regex pass) below the scan.
    return base.select(*keep, F.posexplode_outer("links").alias("pos0", "link")).where(
        F.col("link").isNotNull()).select(
        *keep,
        (F.col("pos0") + 1).alias("pos"),
        F.col("link.href").alias("href"),
        F.col("link.text").alias("text"),
    )


# --- link predicates (C2, C7, D5, D9) ---------------------------------

def href_contains(href: Column, marker: str = ".pdf") -> Column:
    return F.coalesce(href.contains(marker), F.lit(False))


def href_endswith(href: Column, suffix: str = ".pdf") -> Column:
    return F.coalesce(href.endswith(suffix), F.lit(False))


def href_endswith_or_word(href: Column, suffix: str = ".pdf", word: str = "video") -> Column:
    return F.coalesce(href.endswith(suffix) | F.lower(href).contains(word.lower()), F.lit(False))


def ascii_fold(col: Column) -> Column:
    """XPath translate() case folding: ASCII letters only."""
    return F.translate(col, ASCII_UPPER, ASCII_LOWER)


def keyword_match(text: Column, href: Column, keyword: str) -> Column:
    """Link text (ASCII-folded) contains the keyword, or the href does."""
    kw = keyword.lower()
    return F.coalesce(ascii_fold(text).contains(kw) | F.lower(href).contains(kw), F.lit(False))


def keyword_or_part_match(text: Column, href: Column, keyword: str, parts=("/article", "/product")) -> Column:
    """Link text (ASCII-folded) contains the keyword, or the href as written
    contains the keyword or one of the path parts."""
    hit = ascii_fold(text).contains(keyword.lower())
    for part in (keyword, *parts):
        hit = F.coalesce(hit, F.lit(False)) | href.contains(part)
    return F.coalesce(hit, F.lit(False))


# --- per-page aggregates without a shuffle ---------------------------

def link_counts(pages: DataFrame, marker: str = ".pdf") -> DataFrame:
    """Per page: number of links and of document links (href contains
    ``marker``); an in-row count over the page's link array."""
    base = pages if "links" in pages.columns else with_links(pages)
    return base.select(
        "page_id",
        F.size("links").cast("long").alias("n_links"),
        F.size(F.filter("links", lambda l: href_contains(l["href"], marker))).cast("long")
        .alias("n_doc_links"),
    )


def first_n_links(pages: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` links of each page (``slice`` in row, no window)."""
    base = pages if "links" in pages.columns else with_links(pages)
    return explode_links(base.withColumn("links", F.slice("links", 1, n)))


def next_page(pages: DataFrame, label: str = "next") -> DataFrame:
    """First link (document order) whose text equals ``label``
    case-insensitively, resolved against the page URL (class and
    aria-label matches: ``parse.next_link_by_label``)."""
    base = pages if "links" in pages.columns else with_links(pages)
    hit = F.filter("links", lambda l: F.lower(F.trim(l["text"])) == F.lit(label.lower()))
    first = base.select("page_id", "url", F.get(hit, 0)["href"].alias("__href"))
    return U.with_resolved(first, "url", "__href", "next_url").select("page_id", "next_url")


def pages_without_items(pages: DataFrame, keyword: str) -> DataFrame:
    """Pages on which no link matches the keyword (the 'no items found'
    report), an in-row ``exists``."""
    base = pages if "links" in pages.columns else with_links(pages)
    any_hit = F.exists("links", lambda l: keyword_match(l["text"], l["href"], keyword))
    return base.where(~any_hit).select("page_id", "url")


# --- paragraphs (C11, C12) -------------------------------------------

def paragraph_text(pages: DataFrame, limit: int | None = 1000,
                   default: str = "No description available") -> DataFrame:
    """All non-blank paragraphs joined by a space, cut to ``limit``
    characters (None: whole), ``default`` when there is none."""
    return pages.select("page_id", joined_paragraphs("html", limit, default).alias("text"))


def joined_paragraphs(html, limit: int | None = None, default: str = "No description available") -> Column:
    joined = F.array_join(F.filter(H.paragraphs(html), lambda p: p != ""), " ")
    return T.or_default(joined if limit is None else T.truncate(joined, limit), default)


def paragraph_rows(pages: DataFrame) -> DataFrame:
    """One row per non-blank paragraph, ``pos`` = 1-based order among
    all paragraphs of the page."""
    return (
        pages.select("page_id", F.posexplode_outer(H.paragraphs("html")).alias("pos0", "text"))
        .where(F.col("text") != "")
        .select("page_id", (F.col("pos0") + 1).alias("pos"), "text")
    )


def first_pages(pages: DataFrame, n: int, order: str = "page_id") -> DataFrame:
    """Page cap (test mode): the first ``n`` pages in arrival order, a
    top-n (partial per partition, then merged), never a full sort."""
    return pages.orderBy(order).limit(n)


def within_depth(pages: DataFrame, max_depth: int = 5) -> DataFrame:
    """Depth limit of the crawl."""
    return pages.where(F.coalesce(F.col("depth"), F.lit(DEFAULT_DEPTH)) <= max_depth)

"""Contextual HTML extraction: one Arrow UDF builds a node table per page.

``node_table(html)`` returns ``array<struct<pos, tag, parent, depth,
path, attrs, text, own_text>>`` in document order, built with the
stdlib tokenizer and the browser's tolerance rules that matter for real
pages (void elements, a new ``<p>``/block closes an open ``<p>``, a new
``<li>`` closes an open ``<li>``, stray end tags ignored, script/style
text dropped).  Everything contextual - "inside this card", "after
that marker", "following sibling" - is then a Spark higher-order
function over the page's own node array: no join, no pair explosion,
work bounded by one page.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import (ArrayType, IntegerType, MapType, StringType, StructField,
                               StructType)

from ..functions import text as T
from ..functions import url as U
from .pages import ascii_fold

NODE = StructType([
    StructField("pos", IntegerType()),
    StructField("tag", StringType()),
    StructField("parent", IntegerType()),
    StructField("depth", IntegerType()),
    StructField("path", ArrayType(IntegerType())),
    StructField("attrs", MapType(StringType(), StringType())),
    StructField("text", StringType()),
    StructField("own_text", StringType()),
])

# HTML void elements, and the block elements that close
# an open paragraph, as the HTML parsing rules list them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
RAW_TEXT = frozenset(("script", "style"))
# Where the search for an open paragraph or list item ends.
P_SCOPE = frozenset("table td th caption button object template".split())
LI_SCOPE = P_SCOPE | {"ul", "ol", "menu"}


_XML_WS = re.compile(r"[ \t\r\n]+")


def _ns(s: str) -> str:
    """XPath normalize-space."""
    return _XML_WS.sub(" ", s).strip(" ")


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes = []      # [pos, tag, parent, depth, path, attrs, text_parts, own_parts]
        self.stack = []      # open element positions
        self.raw = 0

    def _close_until(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.nodes[self.stack[i]][1] == tag:
                del self.stack[i:]
                return

    def _open_within(self, tag, scope):
        for p in reversed(self.stack):
            if self.nodes[p][1] == tag:
                return True
            if self.nodes[p][1] in scope:
                return False
        return False

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P and self._open_within("p", P_SCOPE):
            self._close_until("p")
        if tag == "li" and self._open_within("li", LI_SCOPE):
            self._close_until("li")
        pos = len(self.nodes)
        parent = self.stack[-1] if self.stack else -1
        path = list(self.stack)
        self.nodes.append([pos, tag, parent, len(self.stack), path,
                           {k: (v if v is not None else "") for k, v in attrs}, [], []])
        if tag in RAW_TEXT:
            self.raw += 1
        if tag not in VOID:
            self.stack.append(pos)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack and self.stack[-1] == len(self.nodes) - 1:
            self.stack.pop()
            if tag in RAW_TEXT:
                self.raw -= 1

    def handle_endtag(self, tag):
        if any(self.nodes[p][1] == tag for p in self.stack):
            self._close_until(tag)
            if tag in RAW_TEXT:
                self.raw = max(0, self.raw - 1)

    def handle_data(self, data):
        if self.raw or not self.stack:
            return
        self.nodes[self.stack[-1]][7].append(data)
        for p in self.stack:
            self.nodes[p][6].append(data)


def parse_nodes(html: str | None):
    if html is None:
        return None
    t = _Tree()
    try:
        t.feed(html)
        t.close()
    except Exception:  # noqa: BLE001 - a page that can't be read has no nodes (``unread_pages``)
        return None
    return [
        {"pos": n[0], "tag": n[1], "parent": n[2], "depth": n[3], "path": n[4], "attrs": n[5],
         "text": _ns("".join(n[6])), "own_text": _ns("".join(n[7]))}
        for n in t.nodes
    ]


#: Characters of pages whose nodes are held as Python objects at a time.
CHUNK_CHARS = 1 << 18


def node_chunks(html: pa.Array) -> Iterator[pa.Array]:
    """The node tables of an Arrow batch of pages, some pages at a time: the
    objects of a whole batch's nodes would take hundreds of times its size."""
    kind = to_arrow_type(ArrayType(NODE))
    found, chars = [], 0
    for page in html:
        text = page.as_py()
        nodes = parse_nodes(text)
        found.append(nodes and [n | {"attrs": list(n["attrs"].items())} for n in nodes])
        chars += len(text or "")
        if chars >= CHUNK_CHARS:
            yield pa.array(found, kind)
            found, chars = [], 0
    if found:
        yield pa.array(found, kind)


@arrow_udf(ArrayType(NODE))
def _node_udf(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for html in batches:
        yield from node_chunks(html)


def node_table(html) -> Column:
    c = F.col(html) if isinstance(html, str) else html
    return _node_udf(c)


def with_nodes(pages: DataFrame) -> DataFrame:
    return pages.withColumn("nodes", node_table("html"))


def unread_pages(pages: DataFrame) -> DataFrame:
    """Pages with a body that the tokenizer couldn't read, as rejects."""
    tried = pages if "nodes" in pages.columns else with_nodes(pages)
    return tried.where(F.col("html").isNotNull() & F.col("nodes").isNull()).select("page_id", "url", F.lit("unreadable").alias("reason"))


# --- node predicates ------------------------------------------------------

def has_class(n: Column, cls: str) -> Column:
    return F.coalesce(F.array_contains(F.split(F.element_at(n["attrs"], F.lit("class")), " "), cls),
                      F.lit(False))


def attr(n: Column, name: str) -> Column:
    return F.element_at(n["attrs"], F.lit(name))


def inside(n: Column, container: Column) -> Column:
    return F.array_contains(n["path"], container["pos"])


def first(nodes: Column, pred) -> Column:
    return F.get(F.filter(nodes, pred), 0)


# --- C3 / I2: link targets -------------------------------------------------

def href_or_src(n: Column) -> Column:
    """``href`` if non-empty, else ``src``."""
    return F.coalesce(F.nullif(attr(n, "href"), F.lit("")), attr(n, "src"))


def links_and_embeds(nodes: Column) -> Column:
    """Anchor hrefs followed by embed sources (two lists concatenated)."""
    a = F.transform(F.filter(nodes, lambda n: (n["tag"] == "a") & attr(n, "href").isNotNull()),
                    lambda n: attr(n, "href"))
    e = F.transform(F.filter(nodes, lambda n: (n["tag"] == "embed") & href_or_src(n).isNotNull()),
                    lambda n: href_or_src(n))
    return F.concat(a, e)


# The containers of result links as (tag, attribute, part of its value).
RESULT_CONTAINERS = (("div", "id", "searchResults"), ("ul", "class", "results"), ("li", "class", "result"))


def container_links(pages: DataFrame, containers=RESULT_CONTAINERS, marker: str = ".pdf", suffix: str = ".pdf",
                    word: str = "video", embed_type: str = "application/pdf") -> DataFrame:
    """Document links inside result containers, and embedded documents, in
    document order and once each: anchors whose href contains ``marker``
    under an element whose attribute contains the container's value, and
    ``embed`` elements of ``embed_type``.  Of these, targets (``href``, else
    ``src``) that end with ``suffix`` or contain ``word`` in any case;
    ``url`` is resolved against the page.

    Containers are found first and an anchor asks for its own ancestors among
    them, so a page costs its nodes times their depth."""
    p = pages if "nodes" in pages.columns else with_nodes(pages)
    nodes = F.col("nodes")

    def is_container(n):
        hit = F.lit(False)
        for tag, name, value in containers:
            hit = hit | ((n["tag"] == tag) & F.coalesce(attr(n, name).contains(value), F.lit(False)))
        return hit

    found = F.transform(F.filter(nodes, is_container), lambda n: n["pos"])
    linked = F.filter(nodes, lambda n: ((n["tag"] == "a") & F.coalesce(attr(n, "href").contains(marker), F.lit(False)) & F.arrays_overlap(n["path"], F.col("__found")))
                      | ((n["tag"] == "embed") & F.coalesce(attr(n, "type") == embed_type, F.lit(False))))
    out = p.withColumn("__found", found).select("page_id", F.col("url").alias("page_url"), F.explode_outer(linked).alias("n")).where(F.col("n").isNotNull()).select(
        "page_id", "page_url", F.col("n.pos").alias("pos"), F.col("n.tag").alias("tag"), href_or_src(F.col("n")).alias("href"))
    wanted = F.coalesce((F.col("href") != "") & (F.col("href").endswith(suffix) | F.lower("href").contains(word)), F.lit(False))
    return U.with_resolved(out.where(wanted), "page_url", "href", "url").select("page_id", "pos", "tag", "href", "url")


def link_title(n: Column, default: str = "Untitled") -> Column:
    """A link's own text, else its ``title`` attribute, both with their
    white space normalised, else ``default``."""
    def normal(c):
        return F.nullif(F.trim(F.regexp_replace(c, "[ \\t\\r\\n]+", " ")), F.lit(""))
    return F.coalesce(normal(n["own_text"]), normal(attr(n, "title")), F.lit(default))


# --- C8: links after a marker ----------------------------------------------

def links_after_marker(pages: DataFrame, marker: str = "results", marker_tag: str = "div") -> DataFrame:
    """Anchors that follow (document order) the first ``marker_tag`` whose
    direct text contains ``marker``."""
    p = pages if "nodes" in pages.columns else with_nodes(pages)
    m = first(F.col("nodes"), lambda n: (n["tag"] == marker_tag) & n["own_text"].contains(marker))
    after = F.filter("nodes", lambda n: (n["tag"] == "a") & (n["pos"] > m["pos"]))
    return p.select("page_id", "url", F.explode_outer(after).alias("n")).where(F.col("n").isNotNull()).select(
        "page_id", F.col("n.pos").alias("pos"), attr(F.col("n"), "href").alias("href"),
        F.col("n.text").alias("text"))


# --- C10: snippet next to an anchor element --------------------------------

def link_snippet(pages: DataFrame, anchor_tag: str = "a", limit: int = 1000) -> DataFrame:
    """For each ``anchor_tag`` element: the texts of its following sibling
    ``p`` elements and of ``p`` inside following sibling ``div``s, plus the
    closest ancestor ``p``, non-blank, joined by a space, cut to
    ``limit``."""
    p = pages if "nodes" in pages.columns else with_nodes(pages)
    nodes = F.col("nodes")

    def node_at(pos):
        # nodes are stored in document order, so a position is an index
        return F.element_at(nodes, pos + 1)

    def snippet(a):
        sib_p = F.filter(nodes, lambda n: (n["parent"] == a["parent"]) & (n["pos"] > a["pos"]) & (n["tag"] == "p"))
        # p inside a following sibling div: look the ancestors up by index
        # (work per p is its depth, not the number of divs)
        div_p = F.filter(nodes, lambda n: (n["tag"] == "p") & F.exists(
            n["path"], lambda q: (q > a["pos"]) & (node_at(q)["tag"] == "div")
            & (node_at(q)["parent"] == a["parent"])))
        anc_p = F.transform(F.filter(a["path"], lambda q: node_at(q)["tag"] == "p"), node_at)
        parts = F.filter(F.transform(F.concat(sib_p, div_p, anc_p), lambda n: n["text"]), lambda t: t != "")
        return T.truncate(F.array_join(parts, " "), limit)

    anchors = F.filter(nodes, lambda n: n["tag"] == anchor_tag)
    return p.select("page_id", F.explode_outer(F.transform(anchors, lambda a: F.struct(
        a["pos"].alias("pos"), a["text"].alias("title"), snippet(a).alias("snippet")))).alias("s")).where(
        F.col("s").isNotNull()).select(
        "page_id", "s.pos", "s.title", "s.snippet")


# --- C4 / C5 / C6 / D6: cards and results ----------------------------------

def extract_cards(pages: DataFrame, card_class: str = "attachment-description",
                  category_class: str = "attachment-usage", link_marker: str = ".pdf",
                  default_product: str = "unknown product") -> DataFrame:
    """Result cards: the first link containing ``link_marker`` and the
    first ``category_class`` node inside each ``card_class`` element.
    One pass; ``reason`` is null for a complete card, else 'no_link' /
    'no_category' (``split_cards`` gives the two outputs)."""
    p = pages if "nodes" in pages.columns else with_nodes(pages)
    nodes = F.col("nodes")

    def card(c):
        link = first(nodes, lambda n: inside(n, c) & (n["tag"] == "a") & F.coalesce(attr(n, "href").contains(link_marker), F.lit(False)))
        cat = first(nodes, lambda n: inside(n, c) & has_class(n, category_class))
        return F.struct(c["pos"].alias("card_pos"), attr(link, "href").alias("href"),
                        link["text"].alias("link_text"), cat["text"].alias("category"))

    cards = F.transform(F.filter(nodes, lambda n: has_class(n, card_class)), card)
    ex = p.select("page_id", "url", F.explode_outer(cards).alias("c")).where(F.col("c").isNotNull()) \
        .select("page_id", "url", "c.*")
    return (
        ex.withColumn("reason", F.when(F.col("href").isNull(), F.lit("no_link"))
                      .when(F.col("category").isNull(), F.lit("no_category")))
        .withColumn("product", F.when(F.col("reason").isNull(), T.or_default("link_text", default_product)))
    )


def split_cards(cards: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(complete cards, rejects) of ``extract_cards`` output."""
    return cards.where(F.col("reason").isNull()), cards.where(F.col("reason").isNotNull())


def attr_or_text(nodes: Column, container: Column, attr_name: str, cls: str, default: str) -> Column:
    """``css('::attr(data-x), .x::text').get(default)`` inside ``container``:
    the attribute on the container or a descendant, else the text of the
    first ``cls`` descendant, trimmed, else ``default``."""
    with_attr = first(nodes, lambda n: ((n["pos"] == container["pos"]) | inside(n, container))
                      & attr(n, attr_name).isNotNull())
    with_cls = first(nodes, lambda n: inside(n, container) & has_class(n, cls))
    return T.or_default(T.ustrip(F.coalesce(attr(with_attr, attr_name), with_cls["text"])), default)


def extract_results(pages: DataFrame, container_tag: str = "div", container_class: str | None = "result",
                    title_tags=("h3", "a"), link_marker: str = ".pdf",
                    default_title: str = "Untitled") -> DataFrame:
    """Search results: per container, the title (first heading or anchor
    text), the joined paragraph texts, the first link and the first
    document link (null when absent), both as written in the page."""
    p = pages if "nodes" in pages.columns else with_nodes(pages)
    nodes = F.col("nodes")
    is_container = (lambda n: (n["tag"] == container_tag) & has_class(n, container_class)) if container_class \
        else (lambda n: n["tag"] == container_tag)

    def result(c):
        title = first(nodes, lambda n: inside(n, c) & n["tag"].isin(*title_tags))
        paras = F.transform(F.filter(nodes, lambda n: inside(n, c) & (n["tag"] == "p")), lambda n: n["text"])
        link = first(nodes, lambda n: inside(n, c) & (n["tag"] == "a") & attr(n, "href").isNotNull())
        doc = first(nodes, lambda n: inside(n, c) & (n["tag"] == "a")
                    & F.coalesce(attr(n, "href").contains(link_marker), F.lit(False)))
        return F.struct(c["pos"].alias("pos"), T.or_default(title["text"], default_title).alias("title"),
                        F.array_join(F.filter(paras, lambda t: t != ""), " ").alias("description"),
                        attr(link, "href").alias("link"), attr(doc, "href").alias("doc_link"))

    return p.select("page_id", "url", F.explode_outer(F.transform(F.filter(nodes, is_container), result))
                    .alias("r")).where(F.col("r").isNotNull()).select("page_id", "url", "r.*")


def resolve_results(results: DataFrame) -> DataFrame:
    """``extract_results`` rows with ``link`` and ``doc_link`` resolved
    against the page; a result without a document link keeps null."""
    out = results
    for name in ("link", "doc_link"):
        out = U.with_resolved(out.withColumnRenamed(name, "__written"), "url", "__written", name).drop("__written")
    return out.select(*results.columns)


def next_link_containing(nodes: Column, label: str = "next") -> Column:
    """First anchor whose own text (ASCII-folded) or whose aria-label as
    written contains ``label``, or whose class is ``<label>-page`` or
    ``pagination-<label>``."""
    lab = label.lower()
    return first(nodes, lambda n: (n["tag"] == "a") & (
        ascii_fold(n["own_text"]).contains(lab) | F.coalesce(attr(n, "aria-label").contains(lab), F.lit(False))
        | has_class(n, f"{lab}-page") | has_class(n, f"pagination-{lab}")))


def next_link_by_label(nodes: Column, label: str = "next") -> Column:
    """First anchor whose class, text or aria-label is ``label``
    (case-insensitive) - the pagination link."""
    lab = label.lower()
    return first(nodes, lambda n: (n["tag"] == "a") & (
        (F.lower(n["text"]) == lab) | (F.lower(F.coalesce(attr(n, "aria-label"), F.lit(""))) == lab)
        | has_class(n, lab)))


__all__ = ["node_table", "with_nodes", "links_after_marker", "link_snippet", "extract_cards",
           "extract_results", "attr_or_text", "href_or_src", "links_and_embeds", "next_link_by_label",
           "parse_nodes", "container_links", "link_title", "resolve_results", "next_link_containing"]


def select_any(nodes: Column, *preds) -> Column:
    """Union of several selectors over the node table: each node at most
    once, in document order (one filter with an OR of the predicates)."""
    def any_of(n):
        out = F.lit(False)
        for p in preds:
            out = out | F.coalesce(p(n), F.lit(False))
        return out
    return F.filter(nodes, any_of)

"""Native (JVM) HTML extraction with regular expressions.

Good for the flat shapes: links, title, paragraphs.  Shapes that need
ancestry or document-order context go through ``quarry.operators.parse``
(one Arrow UDF on the stdlib HTML parser).  ``F.xpath`` is not usable:
it needs well-formed XML and real pages have unclosed tags.

Every pattern here reads the same in Java and RE2.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import XML_WS_CLASS, normalize_space, strip_tags, unescape_basic

# The elements that flow inside a line of text (HTML's
# phrasing content and its old relatives), 'a' apart.
PHRASING = (
    "abbr acronym audio b bdi bdo big br button canvas center cite code data datalist del dfn em embed font i iframe "
    "img input ins kbd label map mark math meter noscript object output picture progress q s samp select small span "
    "strike strong sub sup svg template textarea time tt u var video wbr"
).split()
# Inline content: text runs, or tags that do not end a block.  Text runs
# are matched whole ([^<]+) so Java does not recurse per character.
INLINE = r"(?:[^<]+|</?(?:" + "|".join(PHRASING) + r")(?:[\s/][^>]*)?>)*"
# A paragraph goes on through links as well.
INLINE_OR_LINK = r"(?:[^<]+|</?(?:a|" + "|".join(PHRASING) + r")(?:[\s/][^>]*)?>)*"
# Anchors; group 1 = attributes, group 2 = inline body.
LINK_RE = r"""(?is)<a(\s(?:[^>"']+|"[^"]*"|'[^']*')*)>(""" + INLINE + ")"
# An href among attributes: double-quoted, single-quoted or bare.
HREF_RE = r"""(?is)^(?:[^"'=]+(?:=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]*))?)*?\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
TITLE_RE = r"(?is)<title[^>]*>([^<]*)</title>"
H1_RE = r"(?is)<h1[^>]*>(" + INLINE + ")"
PARA_RE = r"(?is)<p(?:\s[^>]*)?>(" + INLINE_OR_LINK + ")"
SCRIPT_RE = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def drop_scripts(html) -> Column:
    """Remove script/style bodies and comments (their text is not content)."""
    return F.regexp_replace(_c(html), SCRIPT_RE, "")


def anchors(html) -> Column:
    """array<string>: every anchor match (opening tag + inline body) in
    document order - the only full scan of the page."""
    return F.regexp_extract_all(drop_scripts(html), F.lit(LINK_RE), 0)


def href_of(attributes) -> Column:
    """The decoded href of a tag's attributes; null without one."""
    a = _c(attributes)
    value = F.concat(*[F.coalesce(F.regexp_extract(a, HREF_RE, k), F.lit("")) for k in (1, 2, 3)])
    return F.when(a.rlike(HREF_RE), unescape_basic(value))


def links(html) -> Column:
    """array<struct<href, text>> of the anchors with an href, in document
    order.  The page is scanned once; each (short) match is then split into
    href and text with the same pattern, which matches it identically."""
    found = F.transform(anchors(html), lambda a: F.struct(
        href_of(F.regexp_extract(a, LINK_RE, 1)).alias("href"),
        clean_text(F.regexp_extract(a, LINK_RE, 2)).alias("text")))
    return F.filter(found, lambda x: x["href"].isNotNull())


def link_hrefs(html) -> Column:
    """array<string> of anchor hrefs in document order."""
    return F.transform(links(html), lambda x: x["href"])


def link_texts(html) -> Column:
    """array<string> of anchor texts (tags stripped, entities decoded,
    whitespace normalised), aligned with ``link_hrefs``."""
    return F.transform(links(html), lambda x: x["text"])


def clean_text(col) -> Column:
    """Markup fragment to text: tags stripped, basic entities decoded,
    whitespace normalised."""
    return normalize_space(unescape_basic(strip_tags(_c(col))))


def title(html) -> Column:
    return clean_text(F.regexp_extract(_c(html), TITLE_RE, 1))


def heading(html) -> Column:
    return clean_text(F.regexp_extract(drop_scripts(html), H1_RE, 1))


def paragraphs(html) -> Column:
    """array<string> of paragraph texts in document order; an unclosed
    ``<p>`` ends where the next block starts, as in a browser."""
    raw = F.regexp_extract_all(drop_scripts(html), F.lit(PARA_RE), 1)
    return F.transform(raw, clean_text)


__all__ = [
    "INLINE", "LINK_RE", "HREF_RE", "TITLE_RE", "PARA_RE", "SCRIPT_RE", "XML_WS_CLASS",
    "drop_scripts", "link_hrefs", "link_texts", "links", "clean_text", "title",
    "heading", "paragraphs",
]

"""SQL fragments for the independent oracle (DuckDB dialect).

They restate the column functions' semantics in plain SQL, with patterns
of their own for markup: a tag is found first, its attributes are taken
apart one by one, and blocks end at any tag that isn't inline.
"""

from __future__ import annotations

from ..functions import text as T
from ..operators.embed import TOKEN_RE


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


SCRIPTS = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
INLINE_TAGS = ("abbr|acronym|audio|b|bdi|bdo|big|br|button|canvas|center|cite|code|data|datalist|del|dfn|em|embed|font|i|"
               "iframe|img|input|ins|kbd|label|map|mark|math|meter|noscript|object|output|picture|progress|q|s|samp|"
               "select|small|span|strike|strong|sub|sup|svg|template|textarea|time|tt|u|var|video|wbr")
# Inline markup is taken out of the page before blocks are cut.
INLINE_TAG = rf"(?is)</?(?:{INLINE_TAGS})(?:[\s/][^>]*)?>"


def drop_scripts(x: str) -> str:
    return f"regexp_replace({x}, {q(SCRIPTS)}, '', 'g')"


def flat(x: str, links: bool = False) -> str:
    """The page without scripts and inline tags (and without link tags)."""
    out = f"regexp_replace({drop_scripts(x)}, {q(INLINE_TAG)}, '', 'g')"
    return f"regexp_replace({out}, {q(r'(?is)</?a(?:[\s/][^>]*)?>')}, '', 'g')" if links else out


def strip_ws(x: str) -> str:
    ws = T.WS_CLASS
    return f"regexp_replace({x}, {q(r'\A' + ws + '+|' + ws + r'+\z')}, '', 'g')"


def is_blank(x: str) -> str:
    return f"coalesce({strip_ws(x)} = '', true)"


def normalize_space(x: str) -> str:
    return f"trim(regexp_replace({x}, {q(T.XML_WS_CLASS + '+')}, ' ', 'g'))"


def unescape_basic(x: str) -> str:
    out = x
    for ent, ch in T.BASIC_ENTITIES:
        out = f"replace({out}, {q(ent)}, {q(ch)})"
    return out


def clean_text(x: str) -> str:
    return normalize_space(unescape_basic(f"regexp_replace({x}, '<[^>]*>', '', 'g')"))


HREF = r"""(?is)\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def _linked(html: str) -> str:
    """Opening tags with an href, and the text up to the next block or link tag."""
    return (f"list_filter(regexp_extract_all({flat(html)}, {q(r'(?is)<a\s[^>]*>[^<]*')}), "
            f"lambda t: regexp_matches(regexp_extract(t, '^[^>]*>'), {q(HREF)}))")


def link_hrefs(html: str) -> str:
    value = f"regexp_extract(regexp_extract(t, '^[^>]*>'), {q(HREF)}, 1)"
    bare = f"regexp_replace({value}, {q(chr(94) + '[' + chr(34) + chr(39) + ']|[' + chr(34) + chr(39) + ']$')}, '', 'g')"
    return f"list_transform({_linked(html)}, lambda t: {unescape_basic(bare)})"


def link_texts(html: str) -> str:
    return f"list_transform({_linked(html)}, lambda t: {clean_text('regexp_replace(t, ' + q('^[^>]*>') + ', ' + q('') + ')')})"


def title(html: str) -> str:
    return clean_text(f"regexp_extract({html}, {q(r'(?is)<title[^>]*>([^<]*)</title>')}, 1)")


def heading(html: str) -> str:
    return clean_text(f"regexp_extract({flat(html)}, {q(r'(?is)<h1[^>]*>([^<]*)')}, 1)")


def paragraphs(html: str) -> str:
    return (f"list_transform(regexp_extract_all({flat(html, True)}, {q(r'(?is)<p(?:\s[^>]*)?>([^<]*)')}, 1), "
            f"lambda t: {clean_text('t')})")


def first_line(x: str) -> str:
    return f"split_part({x}, chr(10), 1)"


def word_count(x: str) -> str:
    return f"coalesce(len(regexp_extract_all({x}, {q(T.NON_WS_CLASS + '+')})), 0)"


def first_token(x: str, default: str = "unknown") -> str:
    return (f"coalesce(nullif(regexp_extract({x}, {q('(' + T.NON_WS_CLASS + '+)')}, 1), ''), "
            f"{q(default)})")


def origin(u: str) -> str:
    return f"regexp_extract({u}, {q(r'^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)')}, 1)"


def url_path(u: str) -> str:
    return f"regexp_extract({u}, {q(r'^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)')}, 1)"


def resolve(base: str, href: str) -> str:
    """urljoin without dot-segment removal (the shapes in the tables)."""
    d = f"regexp_extract({url_path(base)}, '^(.*/)', 1)"
    return (
        f"CASE WHEN {href} IS NULL OR {base} IS NULL THEN NULL "
        f"WHEN {href} = '' THEN {base} "
        f"WHEN regexp_matches({href}, {q(r'^[A-Za-z][A-Za-z0-9+.\-]*://')}) THEN {href} "
        f"WHEN starts_with({href}, '//') THEN regexp_extract({base}, {q(r'^([A-Za-z][A-Za-z0-9+.\-]*):')}, 1) || ':' || {href} "
        f"WHEN starts_with({href}, '/') THEN {origin(base)} || {href} "
        f"WHEN starts_with({href}, '?') THEN regexp_extract({base}, '^([^?#]*)', 1) || {href} "
        f"WHEN starts_with({href}, '#') THEN regexp_extract({base}, '^([^#]*)', 1) || {href} "
        f"ELSE {origin(base)} || CASE WHEN {d} = '' THEN '/' ELSE {d} END || {href} END"
    )


def canonical_url(u: str) -> str:
    path = url_path(u)
    path = f"CASE WHEN {path} = '' THEN '/' ELSE regexp_replace({path}, '(.)/$', '\\1') END"
    query = f"regexp_extract({u}, {q(r'^[^?#]*\?([^#]*)')}, 1)"
    args = (f"array_to_string(list_sort(list_filter(string_split({query}, '&'), "
            f"lambda a: a <> '' AND NOT starts_with(a, 'utm_'))), '&')")
    return (f"lower({origin(u)}) || {path} || "
            f"CASE WHEN {args} = '' THEN '' ELSE '?' || {args} END")


def token_buckets_sql(text: str, dim: int) -> str:
    """Rows of tokens → bucket expression, used with unnest."""
    return f"regexp_extract_all(lower({text}), {q(TOKEN_RE)})"


def bucket_of(tok: str, dim: int) -> str:
    return f"(('0x' || substr(md5({tok}), 1, 8))::BIGINT % {dim})"


def hashed_vectors(table_sql: str, keys: list[str], text: str, dim: int) -> str:
    """SQL producing ``(*keys, bucket, weight)`` of the L2-normalised
    hashed bag-of-words vectors (weights unrounded)."""
    k = ", ".join(keys)
    return f"""
    (WITH __t AS (SELECT {k}, unnest({token_buckets_sql(text, dim)}) AS tok FROM {table_sql}),
          __b AS (SELECT {k}, {bucket_of('tok', dim)} AS bucket, count(*)::DOUBLE AS c
                  FROM __t GROUP BY ALL),
          __n AS (SELECT {k}, sqrt(sum(c * c)) AS norm FROM __b GROUP BY ALL)
     SELECT {k}, bucket, c / norm AS weight FROM __b JOIN __n USING ({k}))"""

"""Column functions for text fields.

All functions take and return ``Column`` objects built from Spark
built-ins, so they stay inside whole-stage codegen.  The regular
expressions are written in the subset that Java and RE2 (the SQL
oracle) read the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip()/str.split() treat as
# whitespace (str.isspace), in code point order.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a regex class (Java and RE2 syntax).
WS_CLASS = (
    r"[\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
NON_WS_CLASS = "[^" + WS_CLASS[1:]
# XPath normalize-space() only knows these four.
XML_WS_CLASS = r"[ \t\r\n]"

_STRIP_RE = r"\A" + WS_CLASS + "+|" + WS_CLASS + r"+\z"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ustrip(col) -> Column:
    """Python ``str.strip()``: remove Unicode whitespace at both ends
    (``btrim`` with the fixed character set; no regex)."""
    return F.btrim(_c(col), F.lit(WHITESPACE))


def normalize_space(col) -> Column:
    """XPath ``normalize-space``: collapse runs of XML whitespace, trim."""
    return F.trim(F.regexp_replace(_c(col), XML_WS_CLASS + "+", " "))


def or_default(col, default) -> Column:
    """``x or default``: null and the empty string both take the default."""
    return F.coalesce(F.nullif(_c(col), F.lit("")), F.lit(default))


def with_default(col, default) -> Column:
    """``dict.get(k, default)``: only a missing (null) value is replaced."""
    return F.coalesce(_c(col), F.lit(default))


def is_blank(col) -> Column:
    """True for null, empty or whitespace-only text."""
    return F.coalesce(ustrip(col) == F.lit(""), F.lit(True))


def first_line(col) -> Column:
    return F.split_part(_c(col), F.lit("\n"), F.lit(1))


def first_token(col, default: str = "unknown") -> Column:
    """``s.split()[0] if s else default``."""
    return or_default(F.regexp_extract(_c(col), "(" + NON_WS_CLASS + "+)", 1), default)


def word_count(col) -> Column:
    """``len(s.split())`` (runs of non-whitespace), 0 for null: split the
    trimmed text on whitespace runs (a positive character class; Java
    matches the negated Unicode class much more slowly)."""
    s = ustrip(col)
    return F.when(s.isNull() | (s == F.lit("")), F.lit(0)).otherwise(F.size(F.split(s, WS_CLASS + "+")))


def word_gate(col, limit: int = 100, blank: str = "") -> Column:
    """Keep text with fewer than ``limit`` words, else ``blank``."""
    return F.when(word_count(col) < F.lit(limit), _c(col)).otherwise(F.lit(blank))


def truncate(col, n: int) -> Column:
    """``s[:n]`` in code points (Spark's substring counts characters)."""
    return F.substring(_c(col), 1, n)


def was_truncated(col, n: int) -> Column:
    return F.coalesce(F.char_length(_c(col)) > F.lit(n), F.lit(False))


def concat_fields(*cols, sep: str = " ") -> Column:
    """f-string join: a null part becomes '' but keeps its separator
    (``concat_ws`` would drop both)."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(F.coalesce(_c(c).cast("string"), F.lit("")))
    return F.concat(*parts)


def template(prefix: str, col) -> Column:
    return F.concat(F.lit(prefix), _c(col))


def strip_tags(col) -> Column:
    return F.regexp_replace(_c(col), "<[^>]*>", "")


# The five XML entities plus the no-break space, decoded
# with '&amp;' last so that '&amp;lt;' decodes once, to '&lt;'.
BASIC_ENTITIES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&amp;", "&"),
)


def unescape_basic(col) -> Column:
    out = _c(col)
    for ent, ch in BASIC_ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out


# Two noncharacters that stand in for a genuine U+FFFD while a body is
# repaired (no text may hold them).
KEPT_MARK = "\ufdd0\ufdd1"


def drop_invalid_bytes(col) -> Column:
    """``bytes.decode('utf-8', errors='ignore')`` on a string column: valid
    strings are untouched, of others only the invalid bytes go (a U+FFFD
    that is in the bytes stays)."""
    c = _c(col)
    kept = F.replace(c, F.lit("\ufffd"), F.lit(KEPT_MARK))
    bare = F.replace(F.make_valid_utf8(kept), F.lit("\ufffd"), F.lit(""))
    return F.when(F.is_valid_utf8(c), c).otherwise(F.replace(bare, F.lit(KEPT_MARK), F.lit("\ufffd")))


def decode_body(col) -> Column:
    """Binary or string body to text with invalid bytes ignored."""
    return drop_invalid_bytes(_c(col).cast("string"))


def ilike_literal(col, keyword: str) -> Column:
    """Case-insensitive substring test with ``%`` and ``_`` in the
    keyword taken literally."""
    esc = keyword.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return _c(col).ilike(f"%{esc}%")

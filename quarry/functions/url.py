"""URL column functions.

``resolve_url`` follows ``urllib.parse.urljoin`` with built-ins only: a
``CASE`` over the reference shapes (absolute, other scheme, ``//host``,
``?query``, ``#fragment``, path), the stdlib's merge of relative paths
(empty inner segments dropped) and a stack fold for dot segments that
runs only on rows containing them.  No Python in the link hot path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEME_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
ABS_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*://"
ORIGIN_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"
PATH_RE = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)"

# The schemes for which urljoin resolves relative
# references (the standard library's list, in its order).
USES_RELATIVE = ("", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp",
                 "mms", "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def scheme(url) -> Column:
    return F.regexp_extract(_c(url), SCHEME_RE, 1)


def origin(url) -> Column:
    """``scheme://authority`` of an absolute URL, '' otherwise."""
    return F.regexp_extract(_c(url), ORIGIN_RE, 1)


def url_path(url) -> Column:
    return F.regexp_extract(_c(url), PATH_RE, 1)


def without_fragment(url) -> Column:
    return F.regexp_extract(_c(url), r"^([^#]*)", 1)


def without_query(url) -> Column:
    return F.regexp_extract(_c(url), r"^([^?#]*)", 1)


def _remove_dots(segs: Column) -> Column:
    """Resolve '.' and '..' segments with a stack fold (as urljoin does):
    '..' above the root is dropped, a trailing '.' or '..' leaves a
    trailing slash."""
    folded = F.aggregate(
        segs, F.array().cast("array<string>"),
        lambda acc, seg: F.when(seg == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1))
                                .otherwise(acc))
        .when(seg == ".", acc)
        .otherwise(F.concat(acc, F.array(seg))),
    )
    last = F.element_at(segs, -1)
    folded = F.when(last.isin(".", ".."), F.concat(folded, F.array(F.lit("")))).otherwise(folded)
    return F.array_join(folded, "/")


def with_resolved(df, base_col: str, href_col: str, out: str = "abs_url"):
    """Adds ``out`` = ``urllib.parse.urljoin(base, href)`` (null href stays
    null).  Each intermediate is its own projected column, so it is
    computed once per row and the expressions stay in whole-stage
    codegen; only rows with dot segments run the stack fold."""
    b, h = F.col(base_col), F.col(href_col)
    c = F.col
    t = (
        df.withColumn("__u_bs", F.lower(F.regexp_extract(b, SCHEME_RE, 1)))
        .withColumn("__u_hs", F.lower(F.regexp_extract(h, SCHEME_RE, 1)))
        .withColumn("__u_bo", origin(b))
        # 'scheme:rel' with the base's scheme is a relative reference.
        .withColumn("__u_rel", F.when((c("__u_hs") != "") & ~h.rlike(ABS_RE),
                                      F.regexp_replace(h, SCHEME_RE, "")).otherwise(h))
        # '//' with an empty authority ('//', '///p', '//?q') names no host:
        # what follows is an ordinary reference.
        .withColumn("__u_rel", F.when(c("__u_rel").rlike(r"^//([/?#]|$)"), F.substring(c("__u_rel"), 3, 1 << 30))
                    .otherwise(c("__u_rel")))
        .withColumn("__u_rp", F.regexp_extract(c("__u_rel"), r"^([^?#]*)", 1))
        .withColumn("__u_bd", F.split(F.when(b.rlike(ABS_RE), url_path(b))
                                      .otherwise(F.regexp_extract(b, r"^([^?#]*)", 1)), "/"))
        .withColumn("__u_bd", F.when(F.element_at(c("__u_bd"), -1) != "",
                                     F.slice(c("__u_bd"), 1, F.size(c("__u_bd")) - 1)).otherwise(c("__u_bd")))
        .withColumn("__u_m", F.when(c("__u_rp").startswith("/"), F.split(c("__u_rp"), "/"))
                    .otherwise(F.concat(c("__u_bd"), F.split(c("__u_rp"), "/"))))
        .withColumn("__u_m", F.when(~c("__u_rp").startswith("/") & (F.size(c("__u_m")) > 2),
                                    F.concat(F.slice(c("__u_m"), 1, 1),
                                             F.filter(F.slice(c("__u_m"), 2, F.size(c("__u_m")) - 2),
                                                      lambda x: x != ""),
                                             F.slice(c("__u_m"), F.size(c("__u_m")), 1)))
                    .otherwise(c("__u_m")))
        .withColumn("__u_j", F.when(F.array_contains(c("__u_m"), ".") | F.array_contains(c("__u_m"), ".."),
                                    _remove_dots(c("__u_m"))).otherwise(F.array_join(c("__u_m"), "/")))
        .withColumn("__u_j", F.when(c("__u_j") == "", F.lit("/"))
                    .when((c("__u_bo") != "") & ~c("__u_j").startswith("/"), F.concat(F.lit("/"), c("__u_j")))
                    .otherwise(c("__u_j")))
    )
    rel = c("__u_rel")
    resolved = (
        F.when(h.isNull(), F.lit(None).cast("string"))
        .when(b.isNull() | (b == ""), h)
        .when(h == "", b)
        .when((c("__u_hs") != "") & ((c("__u_hs") != c("__u_bs")) | ~c("__u_hs").isin(*USES_RELATIVE)), h)
        # a reference that names nothing (e.g. 'http:' or '//'): the base without its fragment
        .when(rel == "", without_fragment(b))
        # same scheme with an authority: re-assembled with the scheme lower-cased
        .when(h.rlike(ABS_RE), F.concat(c("__u_hs"), F.lit(":"), F.regexp_replace(h, SCHEME_RE, "")))
        .when(rel.startswith("//") & (c("__u_bs") == "") & h.startswith("//"), rel)
        .when(rel.startswith("//") & h.rlike(r"^([A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]"),
              F.concat(F.regexp_extract(b, SCHEME_RE, 1), F.lit(":"), rel))
        .when(rel.startswith("?"), F.concat(without_query(b), rel))
        .when(rel.startswith("#"), F.concat(without_fragment(b), rel))
        .otherwise(F.concat(c("__u_bo"), c("__u_j"), F.regexp_extract(rel, r"^[^?#]*(.*)$", 1)))
    )
    return t.withColumn(out, resolved).drop(*[x for x in t.columns if x.startswith("__u_")])


def url_stem(href, suffix: str = ".pdf") -> Column:
    """``href.split('/')[-1].replace(suffix, '')`` - no percent-decoding."""
    last = F.split_part(_c(href), F.lit("/"), F.lit(-1))
    return F.replace(last, F.lit(suffix), F.lit(""))


def canonical_url(url) -> Column:
    """Canonical form used for request fingerprints: lower-case scheme and
    host, fragment dropped, tracking arguments (``utm_*``) dropped, the
    other query arguments sorted, a trailing slash of a non-root path
    dropped."""
    u = _c(url)
    path = url_path(u)
    path = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, r"(.)/$", "$1"))
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    args = F.array_sort(
        F.filter(F.split(query, "&"), lambda a: (a != "") & ~a.startswith("utm_"))
    )
    q = F.array_join(args, "&")
    return F.concat(
        F.lower(origin(u)), path, F.when(q == "", F.lit("")).otherwise(F.concat(F.lit("?"), q))
    )


def fingerprint(col) -> Column:
    return F.sha1(_c(col))

"""Operator 9: url filters with redirect equivalence, in DataFrame
functions alone.

A rule (verdict, host, path) fits a url on its host or a subdomain whose
path starts with the rule's; the longest rule that fits decides, an allow
before a block of the same length.  Urls that redirect to each other (a
refresh element, or rows of a redirect table) or name one canonical address
are one class: connected components of those links.  A url without a rule
of its own is blocked if a rule blocks any member of its class, allowed
otherwise; an explicit allow stays allowed whatever its class.  The link
tables are joined and aggregated on urls; no class is collected.

Urls are compared without their fragments, with scheme and host in lower
case.  A null url, or one without ``://``, has empty host and path, no
links, no rule, and is allowed.  Null html has no links.  Repeated rows are
judged each; an empty table gives an empty result; further columns of the
page table are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.url import with_resolved
from quarry.llm.common import written
from quarry.llm.components import components

Rule = tuple[str, str, str]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?\s*canonical\b)[^>]*\bhref\s*=\s*(?:"([^">]*)"|'([^'>]*)'|([^\s"'>]+))"""
TAG = r"(?is)<(?:link|meta)\b[^>]*"
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?\s*refresh\b)[^>]*\bcontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*['"]?([^"'>\s]+)"""


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(url: Column) -> Column:
    """A url without fragment, scheme and host in lower case; null without ``://``."""
    scheme = F.translate(F.substr(url, F.lit(1), F.instr(url, "://") + 2), UPPER, LOWER)
    return F.when(F.instr(url, "://") > 0, F.concat(scheme, host_of(url), F.regexp_extract(after_scheme(url), r"^[^/?#]*([^#]*)", 1)))


def _fitting(host: Column, path: Column, rules: Sequence[Rule], value) -> Column:
    out = F.lit(None).cast("string")
    # the last condition wraps all others, so the strongest rule goes last
    for rule in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[0] == "allow")):
        fits = ((host == rule[1]) | host.endswith("." + rule[1])) & path.startswith(rule[2])
        out = F.when(fits, F.lit(value(rule))).otherwise(out)
    return out


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    return _fitting(host, path, rules, lambda r: r[1] + r[2])


def verdict_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The verdict of the rule that fits; null without one."""
    return _fitting(host, path, rules, lambda r: r[0])


def links(pages: DataFrame) -> DataFrame:
    """(a, b): each page's url and every address that it redirects to or
    names as canonical, as keys."""
    tags = pages.select("url", F.explode(F.regexp_extract_all("html", F.lit(TAG), F.lit(0))).alias("tag"))
    canonical = F.concat(*(F.coalesce(F.regexp_extract("tag", CANONICAL, k), F.lit("")) for k in (1, 2, 3)))
    found = tags.select("url", F.explode(F.array(canonical, F.regexp_extract("tag", REFRESH, 1))).alias("href")).where(F.col("href") != "")
    found = found.select("url", F.replace(F.trim("href"), F.lit("&amp;"), F.lit("&")).alias("href"))
    found = written(with_resolved(found, "url", "href", "target").select("url", "target"), "links")
    return found.select(key_of(F.col("url")).alias("a"), key_of(F.col("target")).alias("b"))


def filter_urls(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of every row.  ``rules`` is a short
    list, kept in the plan; ``redirects`` has columns from_url, to_url."""
    url = F.col("url").cast("string")
    edges = links(pages.select(url.alias("url"), F.col("html").cast("string").alias("html")))
    if redirects is not None:
        edges = edges.unionByName(redirects.select(key_of(F.col("from_url")).alias("a"), key_of(F.col("to_url")).alias("b")))
    alias = components(edges)
    node = F.col("node")
    blocked = alias.where(verdict_of(host_of(node), path_of(node), rules) == "block").select("component").distinct()
    tainted = written(alias.join(blocked, "component", "left_semi").select(F.col("node").alias("key")), "blocked")
    host, path = F.col("host"), F.col("path")
    judged = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), key_of(url).alias("key")) \
        .join(tainted.withColumn("tainted", F.lit(True)), "key", "left")
    verdict = F.coalesce(verdict_of(host, path, rules), F.when(F.col("tainted"), "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", rule_of(host, path, rules).alias("rule"), verdict.alias("verdict"))

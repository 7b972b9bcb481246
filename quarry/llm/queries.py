"""One query for each operator, ``opN_<name>``, over its whole table, and
``pipeline``; DuckDB SQL where SQL can express the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import bpe, classifier, codes, dedup, fim, langid, lm, neardup, packing, rules, tokens, topk, urls
from quarry.llm.common import table

TOKENIZER = "byte_bpe_50k.json"


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), tokenizer())


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer())


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.deduplicated(table(spark, sf_dir, "documents"))


def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(table(spark, sf_dir, "embeddings"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), tokenizer())


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: (verdict, host, path)
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.codes(table(spark, sf_dir, "embeddings"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_counts, op2_near_duplicates, op3_lm_score, op4_packing, op5_suffix_dedup, op6_topk, op7_bpe, op8_quality, op9_url_filters, op10_quality_rules,
                           op11_vector_codes, op12_fill_in_middle, op13_language_id, pipeline)
}


def _rounds_sql(rounds: int) -> str:
    """CTEs c1 .. cN (codebooks: p, k, part) and n0 .. nN (each part's nearest entry, m.k, and distance, m.d)."""
    near = """
n{r} AS MATERIALIZED (
  SELECT vec_id, label, p, any_value(v.part) AS part, min({{'d': list_sum(list_transform(list_zip(v.part, c.part), lambda x: (x[1] - x[2]) * (x[1] - x[2]))), 'k': c.k}}) AS m
  FROM parts v JOIN c{r} c USING (p) GROUP BY vec_id, label, p)"""
    move = """
m{r} AS (SELECT p, m.k AS k, j, sum(part[j]) AS s, count(*) AS n FROM n{b}, range(1, 1 + len(part)) AS r(j) GROUP BY p, m.k, j),
c{r} AS MATERIALIZED (
  SELECT c.p, c.k, coalesce(u.part, c.part) AS part
  FROM c{b} c LEFT JOIN (SELECT p, k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS part FROM m{r} GROUP BY p, k) u USING (p, k))"""
    return ",".join([near.format(r=0)] + [move.format(r=r, b=r - 1) + "," + near.format(r=r) for r in range(1, rounds + 1)])


LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLE: dict[str, str] = {
    "op6_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    # hrefs that aren't absolute are left out here: the pages hold none
    "op9_url_filters": rf"""
WITH RECURSIVE p AS (
  SELECT page_id, row_number() OVER () AS row, html, instr(url, '://') > 0 AS ok, substr(url, instr(url, '://') + 3) AS rest, translate(substr(url, 1, instr(url, '://') + 2), {LETTERS}) AS scheme FROM pages),
u AS (
  SELECT page_id, row, html, CASE WHEN ok THEN translate(regexp_extract(rest, '^[^/?#]*'), {LETTERS}) ELSE '' END AS host,
    CASE WHEN ok THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path,
    CASE WHEN ok THEN concat(scheme, translate(regexp_extract(rest, '^[^/?#]*'), {LETTERS}), regexp_extract(rest, '^[^/?#]*([^#]*)', 1)) END AS url FROM p),
tags AS (SELECT url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM u),
hrefs AS (
  SELECT url, regexp_extract(tag, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) AS href FROM tags WHERE regexp_matches(tag, '(?is)^<link.*\brel\s*=\s*["'']?\s*canonical\b')
  UNION ALL
  SELECT url, regexp_extract(tag, '(?is)\burl\s*=\s*[''"]?([^"''>\s]+)', 1) FROM tags WHERE regexp_matches(tag, '(?is)^<meta.*\bhttp-equiv\s*=\s*["'']?\s*refresh\b')),
links AS (
  SELECT url AS a, regexp_replace(replace(href, '&amp;', '&'), '#.*$', '') AS b FROM hrefs WHERE url IS NOT NULL AND instr(href, '://') > 0),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a AS x, a AS y FROM edges UNION SELECT r.x, e.b FROM reach r JOIN edges e ON r.y = e.a),
rules(verdict, rhost, rpath) AS (VALUES {", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)}),
nodes AS (
  SELECT url, regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*') AS host, regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT DISTINCT y AS url FROM reach)),
bad AS (
  SELECT url FROM (SELECT n.url, r.verdict, row_number() OVER (PARTITION BY n.url ORDER BY length(rhost) + length(rpath) DESC, r.verdict) AS k
    FROM nodes n JOIN rules r ON (n.host = rhost OR ends_with(n.host, '.' || rhost)) AND starts_with(n.path, rpath)) WHERE k = 1 AND verdict = 'block'),
tainted AS (SELECT DISTINCT x AS url FROM reach WHERE y IN (SELECT url FROM bad)),
best AS (
  SELECT page_id, host, path, url, rhost || rpath AS rule, verdict,
    row_number() OVER (PARTITION BY row ORDER BY length(rhost) + length(rpath) DESC NULLS LAST, verdict) AS k
  FROM u LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN url IN (SELECT url FROM tainted) THEN 'block' ELSE 'allow' END) AS verdict FROM best WHERE k = 1""",
    "op10_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS host FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS symbols FROM d),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS k FROM w, unnest(range(1, len(ws) - 6)) AS r(i)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(8) AS t(j) GROUP BY doc_id),
lines AS (
  SELECT * FROM (SELECT doc_id, host, text, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws
    FROM (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM d)) WHERE len(ws) > 0),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY doc_id),
normal AS (SELECT doc_id, host, text, translate(array_to_string(ws, ' '), {LETTERS}) AS line, len(ws) AS n FROM lines),
hosts AS (SELECT host, count(DISTINCT text) AS texts FROM d GROUP BY host),
common AS (
  SELECT n.host, n.line FROM normal n JOIN hosts USING (host) GROUP BY n.host, n.line, hosts.texts
  HAVING count(DISTINCT n.text) > {rules.LINE_LEAST} AND count(DISTINCT n.text) > {rules.LINE_SHARE} * hosts.texts),
removed AS (SELECT doc_id, sum(n) AS n FROM normal SEMI JOIN common USING (host, line) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars, symbols AS n_symbols,
    coalesce(dups.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words, CAST(coalesce(removed.n, 0) AS BIGINT) AS n_removed_words
  FROM w LEFT JOIN dups USING (doc_id) LEFT JOIN repeated USING (doc_id) LEFT JOIN removed USING (doc_id)),
f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND n_words - n_removed_words >= {rules.KEEP_WORDS} AND n_words - n_removed_words >= {rules.KEEP_SHARE} * n_words AS kept FROM f""",
    "op11_vector_codes": f"""
WITH v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, label, p, e[p * len(e) // {codes.PARTS} + 1:(p + 1) * len(e) // {codes.PARTS}] AS part FROM v, range({codes.PARTS}) AS r(p)),
c0 AS MATERIALIZED (SELECT p, k, part FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM v ORDER BY vec_id LIMIT {codes.ENTRIES}) USING (vec_id)),
{_rounds_sql(codes.ROUNDS)},
books AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p, k, j)) AS sha FROM (SELECT p, k, j, part[j] AS x FROM c{codes.ROUNDS}, range(1, 1 + len(part)) AS r(j))),
coded AS (SELECT vec_id, label, string_agg(printf('%02x', m.k), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM n{codes.ROUNDS} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, sha AS codebooks_sha256 FROM coded, books""",
    "op12_fill_in_middle": f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('{fim.SALT}:' || doc_id) AS h FROM documents),
d AS (SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS u, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS w, CAST('0x' || h[17:24] AS BIGINT) % 100 AS x, CAST('0x' || h[25:32] AS BIGINT) % 100 AS y FROM t),
f AS (
  SELECT *, CASE WHEN text = '' OR contains(text, '{fim.PREFIX}') OR contains(text, '{fim.SUFFIX}') OR contains(text, '{fim.MIDDLE}') OR x >= {fim.RATE} THEN 'plain' WHEN y < {fim.SPM} THEN 'spm' ELSE 'psm' END AS form,
    substr(text, 1, least(u, w)) AS a, substr(text, least(u, w) + 1, greatest(u, w) - least(u, w)) AS b, substr(text, greatest(u, w) + 1) AS c FROM d)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(b) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN concat('{fim.PREFIX}', a, '{fim.SUFFIX}', c, '{fim.MIDDLE}', b) ELSE concat('{fim.SUFFIX}', c, '{fim.PREFIX}', a, '{fim.MIDDLE}', b) END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM f""",
}

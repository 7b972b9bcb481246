"""Registered file scans and sinks: a given table is written as files in
the shared folder and read back through the feed readers."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import items as I
from ..operators import store as S
from ..session import checkpoint_dir
from ..sources import feeds
from . import oracle as O
from .docs_catalog import ITEMS_SQL, items
from .registry import register

FIELDS = ("url", "issue", "solution", "product", "category", "depth")


def scratch(spark, label: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/quarry-{label}-{uuid.uuid4().hex}"


def short(records):
    return records.select("url", F.sha2("issue", 256).alias("issue_sha"), F.sha2("solution", 256).alias("solution_sha"),
                          "product", "category", F.col("depth").cast("long").alias("depth"))


SHORT_SQL = f"""
SELECT url, sha256(issue) AS issue_sha, sha256(solution) AS solution_sha, product, category, depth::BIGINT AS depth FROM {ITEMS_SQL}"""


@register("scan_json_array", SHORT_SQL)
def scan_json_array(spark, sf):
    """JSON-array files, written in parallel and scanned in splits."""
    path = scratch(spark, "array")
    S.export_json_array(items(spark, sf).select(*FIELDS), path, one_file=False)
    return short(feeds.read_json_array(spark, path).records)


@register("scan_concatenated_arrays", f"""
SELECT url, sha256(concat(issue, '"}}][{{"')) AS issue_sha, sha256(solution) AS solution_sha, product, category, depth::BIGINT AS depth FROM {ITEMS_SQL}""")
def scan_concatenated_arrays(spark, sf):
    """Files that hold array after array, whose strings look like the ends of
    arrays: read in splits as their concatenation."""
    path = scratch(spark, "arrays")
    it = items(spark, sf).withColumn("issue", F.concat("issue", F.lit('"}][{"')))
    it.select(F.concat(F.lit("["), F.to_json(F.struct(*FIELDS)), F.lit("]")).alias("value")).write.text(path)
    return short(feeds.read_json_array(spark, path, repair=True).records)


@register("scan_jsonl_files", SHORT_SQL)
def scan_jsonl_files(spark, sf):
    """JSON Lines files, written in parallel and scanned strictly."""
    path = scratch(spark, "lines")
    S.write_jsonl(items(spark, sf).select(*FIELDS), path)
    return short(feeds.read_jsonl(spark, path, failfast=True).records)


@register("scan_auto_json", f"""
SELECT CASE WHEN category = 'en' THEN 0 ELSE 1 END::BIGINT AS source_index, url, sha256(issue) AS issue_sha FROM {ITEMS_SQL}""")
def scan_auto_json(spark, sf):
    """Array files and JSON Lines files under one reader, in list order;
    a missing path is skipped."""
    it = items(spark, sf)
    array, lines = scratch(spark, "auto"), scratch(spark, "auto") + ".jsonl"
    S.export_json_array(it.where("category = 'en'").select(*FIELDS), array, one_file=False)
    S.write_jsonl(it.where("category <> 'en'").select(*FIELDS), lines)
    got = feeds.read_auto(spark, [array, lines, f"{lines}-missing"]).records
    return got.select(F.col("source_index").cast("long").alias("source_index"), "url", F.sha2("issue", 256).alias("issue_sha"))


@register("quarantine_corrupt", f"""
SELECT CASE WHEN ordinal % 3 = 0 THEN 'record' WHEN ordinal % 3 = 1 THEN 'malformed' ELSE 'not_object:array' END AS what,
       count(*)::BIGINT AS n FROM {ITEMS_SQL} GROUP BY 1""")
def quarantine_corrupt(spark, sf):
    """Lines that are an object, a cut object and an array in turn: what
    isn't a record comes back as a reject with its reason."""
    it = items(spark, sf)
    whole = F.to_json(F.struct(*FIELDS))
    line = F.when(F.col("ordinal") % 3 == 0, whole).when(F.col("ordinal") % 3 == 1, F.substring(whole, F.lit(1), F.length(whole) - 1)) \
        .otherwise(F.concat(F.lit("["), whole, F.lit("]")))
    path = scratch(spark, "corrupt")
    it.select(line.alias("value")).write.text(path)
    feed = feeds.read_jsonl(spark, path)
    what = feed.records.select(F.lit("record").alias("what")).unionByName(feed.rejects.select(F.regexp_extract("reason", "^(malformed|not_object:array)", 1).alias("what")))
    return what.groupBy("what").agg(F.count(F.lit(1)).alias("n"))


@register("sink_json", f"""
SELECT CASE WHEN NOT {O.is_blank('issue')} OR NOT {O.is_blank('solution')} THEN 'kept' ELSE 'discarded' END AS route,
       url, sha256(solution) AS solution_sha FROM {ITEMS_SQL}""")
def sink_json(spark, sf):
    """The routed sink's files, read back by route."""
    path = scratch(spark, "routed")
    S.write_routed(I.route(items(spark, sf), fields=("issue", "solution")).select(*FIELDS, "route"), path)
    got = spark.read.schema("url string, solution string, route string").json(path)
    return got.select("route", "url", F.sha2("solution", 256).alias("solution_sha"))


@register("ensure_table", f"SELECT url, sha256(solution) AS solution_sha FROM {ITEMS_SQL}")
def ensure_table(spark, sf):
    """A table made if absent and loaded twice: the second load finds all
    keys stored and adds nothing."""
    path = scratch(spark, "table")
    new = items(spark, sf).select("ordinal", *FIELDS)
    for _ in range(2):
        stored = S.ensure_table(spark, path, new.schema)
        S.insert_if_absent(stored, new, "url", "ordinal").write.mode("append").parquet(path)
    return S.ensure_table(spark, path, new.schema).select("url", F.sha2("solution", 256).alias("solution_sha"))

"""JSON feed sources with a quarantine side output.

Every reader returns a ``Feed(records, rejects)``:

* ``records`` - one row per JSON object: ``file, ordinal`` (input order)
  plus the ITEM fields (``title``/``description`` normalised into
  ``issue``/``solution``) and ``keys`` (the keys present);
* ``rejects`` - ``file, ordinal, line, reason`` for every line or file
  that could not be used.  Nothing is dropped silently.

Parsing is strict (see ``quarry.functions.json``): trailing junk, two
objects on one line, an array on a line or a scalar are rejects, not
partial rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json as J
from ..functions import text as T
from ..operators.items import normalise_keys
from ..schema import ITEM
from .json_splits import read_elements


class Feed(NamedTuple):
    records: DataFrame
    rejects: DataFrame


REJECT_COLS = ("file", "ordinal", "line", "reason")
FILE_META = "_metadata.file_path"


def existing_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """Paths that exist, in the given order (missing ones are skipped)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    out = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if hp.getFileSystem(conf).exists(hp):
            out.append(p)
    return out


def _fields(v: Column) -> list[Column]:
    """ITEM fields out of an object variant (absent or null → null)."""
    cols = []
    for f in ITEM.fields:
        cols.append(F.try_variant_get(v, f"$.{f.name}", f.dataType.simpleString()).alias(f.name))
    return cols


def _records(objs: DataFrame) -> DataFrame:
    """``objs``: file, ordinal, v (object variant) → normalised records."""
    rec = objs.select("file", "ordinal", *_fields(F.col("v")),
                      F.json_object_keys(F.to_json(F.col("v"))).alias("keys"))
    return normalise_keys(rec)


def _classify(lines: DataFrame) -> DataFrame:
    """``lines``: file, ordinal, line → adds ``v`` (strict variant) and
    ``reason`` (null for a usable object)."""
    v = J.strict_variant(F.col("line"))
    kind = J.variant_kind(v)
    return lines.withColumn("v", v).withColumn(
        "reason",
        F.when(F.col("v").isNull(), F.lit("malformed"))
        .when(~F.upper(kind).startswith("OBJECT"), F.concat(F.lit("not_object:"), F.lower(kind)))
    )


def _split(classified: DataFrame, require_shape: bool) -> Feed:
    good = _records(classified.where(F.col("reason").isNull()).select("file", "ordinal", "v"))
    rejects = classified.where(F.col("reason").isNotNull()).select(*REJECT_COLS)
    if require_shape:
        shape = valid_shape(F.col("keys"))
        bad_shape = good.where(~shape).select(
            "file", "ordinal", F.lit(None).cast("string").alias("line"), F.lit("shape").alias("reason"))
        good = good.where(shape)
        rejects = rejects.unionByName(bad_shape)
    return Feed(good, rejects)


def valid_shape(keys: Column) -> Column:
    """(issue or title present) and (solution or description present) -
    presence of the key, not a non-null value."""
    return (
        (F.array_contains(keys, "issue") | F.array_contains(keys, "title"))
        & (F.array_contains(keys, "solution") | F.array_contains(keys, "description"))
    )


def read_jsonl(spark: SparkSession, paths: str | Sequence[str], require_shape: bool = False,
               failfast: bool = False) -> Feed:
    """JSON Lines: blank lines skipped, each other line must be exactly one
    JSON object.  ``failfast`` raises on the first reject instead."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.text(paths).select(
        F.col(FILE_META).alias("file"), F.monotonically_increasing_id().alias("ordinal"),
        F.col("value").alias("line"))
    lines = lines.where(~T.is_blank(F.col("line")))
    feed = _split(_classify(lines), require_shape)
    if failfast and not feed.rejects.isEmpty():
        r = feed.rejects.first()
        raise ValueError(f"bad JSON line in {r['file']}: {r['reason']}")
    return feed


def _file_elements(spark: SparkSession, paths: Sequence[str], repair: bool) -> tuple[DataFrame, DataFrame]:
    """(classified elements of the files that are arrays or one object; file,
    usable of every file)."""
    elements, files = read_elements(spark, paths)
    taken = ["array", "object"] + ["arrays"] * repair
    elements = elements.where(F.col("kind").isin(taken)).select("file", "ordinal", "line")
    return _classify(elements).select("file", "ordinal", "v", "reason", "line"), files.select("file", F.col("kind").isin(taken).alias("usable"))


def read_json_array(spark: SparkSession, paths: str | Sequence[str], require_shape: bool = False,
                    repair: bool = False, failfast: bool = False) -> Feed:
    """Files holding one JSON array of objects (a single object file gives
    one row).  A file that isn't one bracketed value is a reject; with
    ``repair`` a ``[…][…]`` file is read as the concatenation.  An element
    that isn't a JSON object is a reject of its own.  Files are read in
    splits (``json_splits``), whatever their size and line breaks; ``ordinal``
    is the byte at which an element begins.  Files without a byte give
    nothing."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    elements, files = _file_elements(spark, paths, repair)
    bad_files = files.where(~F.col("usable")).select(
        "file", F.lit(None).cast("long").alias("ordinal"), F.lit(None).cast("string").alias("line"),
        F.lit("malformed_file").alias("reason"))
    feed = _split(elements, require_shape)
    feed = Feed(feed.records, feed.rejects.unionByName(bad_files))
    if failfast and not feed.rejects.isEmpty():
        r = feed.rejects.first()
        raise ValueError(f"bad JSON array file {r['file']}: {r['reason']}")
    return feed


def read_auto(spark: SparkSession, paths: str | Sequence[str], require_shape: bool = True,
              repair: bool = False) -> Feed:
    """Auto-detecting reader: a file that is one JSON array gives its
    elements, a single object gives one row, anything else is read line by
    line as JSON Lines; either way in splits.  Missing paths are skipped;
    output keeps path order (``source_index``) then input order."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    paths = existing_paths(spark, paths)
    if not paths:
        empty = spark.createDataFrame([], "file string, ordinal long, line string, reason string")
        return Feed(_records(spark.createDataFrame([], "file string, ordinal long, v variant")), empty)
    elements, files = _file_elements(spark, paths, repair)
    lines = spark.read.text(paths).select(F.col(FILE_META).alias("file"), F.monotonically_increasing_id().alias("ordinal"), F.col("value").alias("line"))
    lines = lines.where(~T.is_blank(F.col("line"))).join(files.where(~F.col("usable")).select("file"), "file", "left_semi")
    feed = _split(elements.unionByName(_classify(lines).select("file", "ordinal", "v", "reason", "line")), require_shape)
    return Feed(feed.records.withColumn("source_index", source_index(spark, paths)), feed.rejects)


def source_index(spark: SparkSession, paths: Sequence[str]) -> Column:
    """Position of a row's source in the list of paths: the path is the
    row's file, or a folder above it (the longest such path); both are
    compared as qualified, decoded paths."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    full = []
    for i, p in enumerate(paths):
        hp = jvm.org.apache.hadoop.fs.Path(p)
        full.append((hp.getFileSystem(conf).makeQualified(hp).toUri().getPath().rstrip("/"), i))
    name = F.regexp_replace(F.url_decode(F.replace(F.col("file"), F.lit("+"), F.lit("%2B"))), "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    out = F.lit(len(paths))
    for path, i in sorted(full, key=lambda x: (len(x[0]), -x[1])):  # the longest is tested first
        out = F.when((name == path) | name.startswith(path + "/"), F.lit(i)).otherwise(out)
    return out


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; columns missing in a source are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out

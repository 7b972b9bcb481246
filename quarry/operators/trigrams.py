"""Substring search by posting lists of trigrams.

``postings`` gives for each brand and each three characters in a row the
rows that hold them, once a row.  A keyword of three characters or more is in
a row only if all its trigrams are, so ``candidates`` takes the rows of its
rarest trigram that are also among those of its second rarest; a keyword with
a trigram that no row has is done.  ``first_hits`` tests each keyword's
candidates in order, a few at first and more for those that aren't found, so
hardly more texts move than there are answers.  Lists are joined on (brand,
trigram), tests on the row's id: no key is constant, and a text is tested
against its own candidate keywords alone, ``BLOCK`` at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

GRAM = 3
#: Keywords tested together in one row's array.
BLOCK = 500
#: How many candidates of a keyword are tested, until one is a hit; at last all.
WIDTHS = (16,)
#: Up to so many wanted trigrams (8 bytes each) go to the tasks as an array, more are joined.
SENT_GRAMS = 1 << 18
#: Up to so many keywords, or tests of a keyword on a row, are sent to the tasks, more are joined by shuffles.
SENT_ROWS = 1 << 17
#: Characters of texts whose trigrams are emitted together.
BATCH_CHARS = 1 << 20


def text_grams(text: str) -> np.ndarray:
    """The distinct trigrams of a text, as 63-bit numbers."""
    c = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)
    return np.unique(c[:-2] | c[1:-1] << 21 | c[2:] << 42) if len(c) >= GRAM else np.zeros(0, np.int64)


def with_grams(rows: DataFrame, text: str, wanted: np.ndarray | None = None) -> DataFrame:
    """The other columns of ``rows`` beside each distinct trigram of ``text``
    (column gram), of ``wanted`` (sorted) alone if given; rows without any go."""
    sent = None if wanted is None else rows.sparkSession.sparkContext.broadcast(wanted)
    keep = [c for c in rows.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            def out(found: list[np.ndarray], end: int) -> pa.RecordBatch:
                row = np.repeat(np.arange(end - len(found), end), [len(g) for g in found])  # noqa: B023
                return pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(row)) for k in range(len(keep))] + [pa.array(np.concatenate(found), pa.int64())], [*keep, "gram"])  # noqa: B023

            found, chars = [], 0
            for k, value in enumerate(batch.column(len(keep))):
                own = text_grams(value.as_py() or "")
                found.append(own if sent is None else np.intersect1d(own, sent.value, assume_unique=True))
                chars += len(found[-1])
                if chars >= BATCH_CHARS:
                    yield out(found, k + 1)
                    found, chars = [], 0
            if found:
                yield out(found, batch.num_rows)

    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select(*keep, text).mapInArrow(run, f"{kinds}, gram long")


def postings(rows: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """brand, match_id, gram of ``rows`` (brand, match_id, low): the whole
    index, or its lists for the ``wanted`` (brand, gram) alone."""
    rows = rows.select("brand", "match_id", "low")
    if wanted is None:
        return with_grams(rows, "low")
    some = wanted.select("gram").distinct().limit(SENT_GRAMS + 1).collect()  # of bounded number
    sent = np.array(sorted(r["gram"] for r in some), np.int64) if len(some) <= SENT_GRAMS else None
    return with_grams(rows, "low", sent).join(wanted.distinct(), ["brand", "gram"], "left_semi")


def candidates(lists: DataFrame, grams: DataFrame) -> DataFrame:
    """brand, kw, match_id, n_postings (of the rarest trigram): the rows that
    hold the two rarest trigrams of each keyword.  ``grams``: brand, kw, gram.

    Lists are small as files and large as rows, so no list is ever sent whole:
    joins are by counted rows, not by the files' sizes."""
    sizes = lists.groupBy("brand", "gram").agg(F.count(F.lit(1)).alias("n"))
    ranked = grams.join(sizes, ["brand", "gram"], "left").groupBy("brand", "kw").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram"))).alias("g"))
    ranked = ranked.where(F.col("g")[0]["n"] > 0).select("brand", "kw", F.col("g")[0]["n"].alias("n_postings"), F.col("g")[0]["gram"].alias("gram"), F.coalesce(F.get("g", F.lit(1))["gram"], F.col("g")[0]["gram"]).alias("second"))
    ranked = materialize(ranked, "rarest")
    sent = ranked.count() <= SENT_ROWS
    asked = ranked.select("brand", "gram").unionByName(ranked.select("brand", F.col("second").alias("gram"))).distinct()
    lists = lists.join(F.broadcast(asked) if sent else asked.hint("merge"), ["brand", "gram"], "left_semi")
    met = lists.join(F.broadcast(ranked) if sent else ranked.hint("merge"), ["brand", "gram"]).select("brand", "kw", "n_postings", "match_id", F.col("second").alias("gram"))
    return met.join(lists.hint("merge"), ["brand", "gram", "match_id"], "left_semi").select("brand", "kw", "n_postings", "match_id")


def hits_of(tests: DataFrame, rows: DataFrame, blocks: int) -> DataFrame:
    """brand, kw, match_id: the least row of ``tests`` that holds the keyword."""
    own = tests.groupBy("brand", "match_id", F.pmod(F.xxhash64("kw"), F.lit(blocks))).agg(F.collect_list("kw").alias("kws"))
    own = F.broadcast(own) if tests.limit(SENT_ROWS + 1).count() <= SENT_ROWS else own.hint("merge")
    # the outer form: else the optimizer tests every keyword twice
    met = rows.join(own, ["brand", "match_id"]).select("brand", "match_id", F.explode_outer(F.filter("kws", lambda w: F.contains(F.col("low"), w))).alias("kw"))
    return met.where(F.col("kw").isNotNull()).groupBy("brand", "kw").agg(F.min("match_id").alias("match_id"))


def first_hits(rows: DataFrame, keywords: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(brand, kw, match_id: the least row that holds each keyword; brand, kw,
    n_postings, match_id: all candidates).  ``rows``: brand, match_id (unique
    in a brand), low; ``keywords``: brand, kw (distinct, of three characters
    or more)."""
    keywords = materialize(keywords, "keywords")
    blocks = max(1, -(-keywords.count() // BLOCK))
    grams = with_grams(keywords.select("brand", "kw", F.col("kw").alias("low")), "low")
    lists = materialize(postings(rows, grams.select("brand", "gram")), "postings")
    every = materialize(candidates(lists, grams), "candidates")
    waiting, found = every, None
    order = Window.partitionBy("brand", "kw").orderBy("match_id")
    for width in (*WIDTHS, None):
        tests = waiting if width is None else waiting.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= width).drop("rank")
        new = materialize(hits_of(tests.select("brand", "kw", "match_id"), rows, blocks), "hits")
        found = new if found is None else found.unionByName(new)
        if width is not None:
            waiting = waiting.join(new.select("brand", "kw"), ["brand", "kw"], "left_anti")
            if waiting.isEmpty():
                break
    return found, every

"""Operator 10: quality rules with cross-document line frequency.

One pass over the texts gives each document's base measures and the hashes
of its normalised lines (words in lower case A-Z, single spaces).  A line
is boilerplate of its host (``source``; null counts as '') where it lies
in more than ``max(least, share * documents of the host)`` distinct
documents; exact copies of a text count as one document there, so a page
that was merely copied is not taken for boilerplate.  Boilerplate lines
are removed, and a document that keeps fewer than ``min_words`` words or
less than ``min_share`` of its own is depleted and rejected: ``judge`` gives
the verdicts, ``cleaned`` the kept documents without those lines.  Nothing is
collected: lines are counted with partial aggregation and joined on (host,
line), an equi-join whose hot keys Spark splits.

Null and empty texts have no words and fail the base rule; repeated rows
give repeated results (and count once); an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import (Chunk, chunks, is_space, list_array, lower_ascii, mix64, occurrences, per_doc, signed,
                               span_hashes, word_spans, written)

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
LINE_LEAST, LINE_SHARE = 20, 0.05
KEEP_WORDS, KEEP_SHARE = 5, 0.3


def measure(chunk: Chunk) -> dict[str, np.ndarray]:
    """Base measures of each document, and its distinct lines, flat."""
    buf, off, n = chunk.buf, chunk.off, chunk.n
    starts, ends, doc = word_spans(buf, off)
    n_words = np.bincount(doc, minlength=n)
    out = {"n_words": n_words, "word_chars": per_doc(~is_space(buf) & ((buf & 0xC0) != 0x80), off)}
    out["n_symbols"] = per_doc(np.isin(buf, np.frombuffer(SYMBOLS.encode(), np.uint8)), off)
    salt = mix64(np.arange(1, n + 1, dtype=np.uint64))

    # words inside 8-word windows that occur twice in their document
    covered = np.zeros(len(starts) + 1, np.int64)
    if len(starts) >= REPEAT_WINDOW:
        word = span_hashes(buf, starts, ends)
        at = np.arange(len(starts) - REPEAT_WINDOW + 1)
        at = at[doc[at] == doc[at + REPEAT_WINDOW - 1]]
        _, total = occurrences(span_hashes(word, at, at + REPEAT_WINDOW) ^ salt[doc[at]])
        twice = at[total > 1]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + REPEAT_WINDOW, -1)
    out["n_repeat_words"] = np.bincount(doc[np.cumsum(covered[:-1]) > 0], minlength=n)

    # lines: cut at \n and at the ends of documents
    cut = np.zeros(len(buf) + 1, bool)
    cut[1:] = buf == 10
    cut[off] = True
    begin = np.flatnonzero(cut)
    first = np.searchsorted(starts, begin)  # first word at or after each line's start
    words = np.diff(np.append(first, len(starts)))
    has = np.flatnonzero(words)
    first, words = first[has], words[has]
    line_doc = doc[first] if len(first) else first
    end = np.append(begin, len(buf))[has + 1]
    end = end - ((buf[end - 1] == 10) & (end > begin[has])) if len(end) else end
    before, _ = occurrences(span_hashes(buf, begin[has], end) ^ salt[line_doc])
    out["n_dup_lines"] = np.bincount(line_doc[before > 0], minlength=n)

    low = span_hashes(lower_ascii(buf), starts, ends)
    line = span_hashes(low, first, first + words)
    order = np.lexsort((line, line_doc))
    line, line_doc, words = line[order], line_doc[order], words[order]
    new = np.ones(len(line), bool)
    new[1:] = (line[1:] != line[:-1]) | (line_doc[1:] != line_doc[:-1])
    at = np.flatnonzero(new)
    out["line_hashes"] = line[at]
    out["line_words"] = np.add.reduceat(words, at) if len(at) else words
    out["lines_of"] = np.bincount(line_doc[at], minlength=n)
    out["text_hash"] = span_hashes(buf, off[:-1], off[1:]) ^ mix64(np.diff(off).astype(np.uint64))
    return out


def measures(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host, base measures, line_hashes, line_words, text_hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        for batch in batches:
            for at, end, chunk in chunks(batch):
                x = measure(chunk)
                columns = [batch.column(0).slice(at, end - at), batch.column(2).slice(at, end - at), *(pa.array(x[k], pa.int64()) for k in names),
                           list_array(signed(x["line_hashes"]), x["lines_of"], pa.int64()), list_array(x["line_words"], x["lines_of"], pa.int64()), pa.array(signed(x["text_hash"]), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "host", *names, "line_hashes", "line_words", "text_hash"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"))
    return rows.mapInArrow(run, "doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, line_hashes array<long>, line_words array<long>, text_hash long")


def _judged(docs: DataFrame, host: str, least: int, share: float, min_words: int, min_share: float) -> DataFrame:
    """Per row: measures, host, n_removed_words, removed_lines (hashes; null
    for none), base_failed, kept."""
    base = written(measures(docs, host), "measures")
    lines = base.select("text_hash", "host", F.explode(F.arrays_zip("line_hashes", "line_words")).alias("line")) \
        .select("text_hash", "host", F.col("line.line_hashes").alias("line"), F.col("line.line_words").alias("words"))
    hosts = base.groupBy("host").agg(F.count_distinct("text_hash").alias("texts"))
    common = lines.groupBy("host", "line").agg(F.count_distinct("text_hash").alias("texts_with")).where(F.col("texts_with") > least)
    common = common.join(hosts, "host").where(F.col("texts_with") > F.lit(share) * F.col("texts")).select("host", "line")
    # copies share their removed lines, so each text of a host is looked up once
    removed = lines.dropDuplicates(["host", "text_hash", "line"]).join(common, ["host", "line"]).groupBy("host", "text_hash").agg(F.sum("words").alias("n_removed_words"), F.collect_list("line").alias("removed_lines"))
    judged = base.drop("line_hashes", "line_words").join(removed, ["host", "text_hash"], "left").withColumn("n_removed_words", F.coalesce("n_removed_words", F.lit(0)).cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words")
    kept = ~failed & (left >= min_words) & (left >= min_share * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn("kept", kept)


def judge(docs: DataFrame, host: str = "source", least: int = LINE_LEAST, share: float = LINE_SHARE,
          min_words: int = KEEP_WORDS, min_share: float = KEEP_SHARE) -> DataFrame:
    """Per row: doc_id, the base measures, n_removed_words, base_failed, kept."""
    return _judged(docs, host, least, share, min_words, min_share) \
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "base_failed", "kept")


def without_lines(text: bytes, removed: np.ndarray) -> bytes:
    """``text`` without the lines whose normalised words hash to ``removed``."""
    buf = np.frombuffer(text, np.uint8)
    starts, ends, _ = word_spans(buf, np.array([0, len(buf)]))
    begin = np.append(0, np.flatnonzero(buf == 10) + 1)
    first = np.searchsorted(starts, begin)
    after = np.append(first[1:], len(starts))
    line = span_hashes(span_hashes(lower_ascii(buf), starts, ends), first, after)
    gone = (after > first) & np.isin(signed(line), removed)
    return b"\n".join(x for x, out in zip(text.split(b"\n"), gone.tolist(), strict=True) if not out)


def _rewritten(text: Column, removed: Column) -> Column:
    @F.arrow_udf("string")
    def run(texts: pa.Array, lines: pa.Array) -> pa.Array:
        out = [t if t is None or not x else without_lines(t.encode(), np.array(x, np.int64)).decode() for t, x in zip(texts.to_pylist(), lines.to_pylist(), strict=True)]
        return pa.array(out, pa.string())

    return run(text, removed)


def cleaned(docs: DataFrame, host: str = "source", least: int = LINE_LEAST, share: float = LINE_SHARE,
            min_words: int = KEEP_WORDS, min_share: float = KEEP_SHARE) -> DataFrame:
    """The kept rows of ``docs`` with all columns, their texts without the
    boilerplate lines of their host; rows of one doc_id share its fate."""
    judged = written(_judged(docs, host, least, share, min_words, min_share).select("doc_id", "host", "removed_lines", "kept"), "judged")
    lines = judged.where("removed_lines IS NOT NULL").groupBy("doc_id", "host").agg(F.array_distinct(F.flatten(F.collect_set("removed_lines"))).alias("lines"))
    lines = lines.groupBy("doc_id").agg(F.collect_list(F.struct("host", "lines")).alias("__removed"))
    kept = judged.where("kept").select("doc_id").distinct().join(lines, "doc_id", "left")
    rows = docs.join(kept.hint("merge"), "doc_id").select(*docs.columns, "__removed")
    own = F.coalesce(F.col(host).cast("string"), F.lit(""))
    of_host = F.get(F.filter("__removed", lambda x: x["host"] == own), F.lit(0))["lines"]
    text = _rewritten(F.col("text").cast("string"), F.coalesce(of_host, F.array().cast("array<long>")))
    return rows.withColumn("text", text).drop("__removed")

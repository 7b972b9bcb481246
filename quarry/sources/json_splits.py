"""JSON array files read in splits.

Spark's text reader cuts a file into splits of any number; here it ends its
rows at ``}``, so a file needs no line breaks to be cut, and no row is much
longer than an object.  Whether a byte of a split lies in a string, and how
deep in brackets, depends on all bytes before it.  So each split is read
twice:

1. It is summarised as a transition: the parity of its quotes, and how much
   deeper it ends, for either state (outside or inside a string) at its
   start.  Summaries, one small row a split, are composed in file order and
   give every split its true start: state, depth and byte offset.
2. From there on its elements are cut: between the brackets and commas of an
   array at the top, or a whole object at the top.  What crosses the ends of
   splits comes as pieces, put together by the element that they belong to.

The splits' starts are joined to their rows on (file, split); nothing is
collected, and no task holds more than an Arrow batch and one element.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

QUOTE, BACKSLASH, COMMA = 34, 92, 44
OPENERS, CLOSERS = np.frombuffer(b"[{", np.uint8), np.frombuffer(b"]}", np.uint8)
BLANKS = np.frombuffer(b" \t\r\n\xef\xbb\xbf", np.uint8)  # and a byte order mark
#: What a row of pieces is: a whole element, its begin, a part with neither end, its end, or the split's counts.
WHOLE, BEGIN, INNER, END, COUNTS = range(5)
#: Bytes of a split that are looked at together, in whole rows: a byte takes dozens in numbers.
RUN_BYTES = 1 << 20


def fragments(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """file, split, size (of the file), at (rising in a split), value: rows
    that end at ``}``, without it."""
    rows = spark.read.option("lineSep", "}").text(list(paths))
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.col("_metadata.file_size").alias("size"),
                       F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("value"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """(file, split, first row, end row) of the rows of one split, of some
    ``RUN_BYTES`` at a time."""
    n = batch.num_rows
    if not n:
        return
    file, split = batch.column("file").dictionary_encode(), batch.column("split").to_numpy()
    code = file.indices.to_numpy()
    part = np.cumsum(pc.binary_length(batch.column("value")).to_numpy(zero_copy_only=False), dtype=np.int64) // RUN_BYTES
    cut = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (split[1:] != split[:-1]) | (part[1:] != part[:-1])))
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), n], strict=True):
        yield file.dictionary[int(code[a])].as_py(), int(split[a]), a, b


def _bytes(values: pa.Array) -> np.ndarray:
    """The bytes of the rows, each with its ``}``."""
    return np.frombuffer(b"}".join(values.to_pylist()) + b"}", np.uint8)


def quotes(buf: np.ndarray) -> np.ndarray:
    """Whether each byte is a quote that isn't escaped (a row's end is none's)."""
    quote = buf == QUOTE
    at = np.flatnonzero(quote)
    at = at[(at > 0) & (buf[at - 1] == BACKSLASH)]
    if len(at):
        last = np.maximum.accumulate(np.where(buf != BACKSLASH, np.arange(len(buf)), -1))
        quote[at[(at - 1 - last[at - 1]) % 2 == 1]] = False
    return quote


def _steps(buf: np.ndarray, outside: np.ndarray) -> np.ndarray:
    """1 for each bracket that opens, -1 for each that closes."""
    return (outside & np.isin(buf, OPENERS)).astype(np.int64) - (outside & np.isin(buf, CLOSERS))


def summaries(rows: DataFrame) -> DataFrame:
    """file, split, size, n_bytes, flips (of the state), deeper_out and
    deeper_in (from either state at its start) of each split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for file, split, a, b in _runs(batch):
                buf = _bytes(batch.column("value").slice(a, b - a))
                quote = quotes(buf)
                inside = np.cumsum(quote) % 2 == 1
                out.append((file, split, batch.column("size")[a].as_py(), batch.column("at")[a].as_py(), len(buf), int(quote.sum() % 2), int(_steps(buf, ~inside & ~quote).sum()), int(_steps(buf, inside & ~quote).sum())))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["file", "split", "size", "at", "n_bytes", "flips", "out", "in"])

    parts = rows.mapInArrow(run, "file string, split long, size long, at long, n_bytes long, flips long, out long, in long")
    # a split's batches in order: the state before each decides which of the two depths counts
    order = Window.partitionBy("file", "split").orderBy("at")
    parts = parts.withColumn("flipped", F.sum("flips").over(order) - F.col("flips"))
    even = F.col("flipped") % 2 == 0
    return parts.groupBy("file", "split").agg(
        F.first("size").alias("size"), F.sum("n_bytes").alias("n_bytes"), (F.sum("flips") % 2).alias("flips"),
        F.sum(F.when(even, F.col("out")).otherwise(F.col("in"))).alias("deeper_out"), F.sum(F.when(even, F.col("in")).otherwise(F.col("out"))).alias("deeper_in"))


def starts(splits: DataFrame) -> DataFrame:
    """file, split, state (1 in a string), depth and offset at its start, and
    last, the bytes (0 or 1) that the file lacks after its last row."""
    order = Window.partitionBy("file").orderBy("split")
    whole = Window.partitionBy("file")
    at = splits.withColumn("state", F.pmod(F.sum("flips").over(order) - F.col("flips"), F.lit(2)))
    at = at.withColumn("deeper", F.when(F.col("state") == 0, F.col("deeper_out")).otherwise(F.col("deeper_in")))
    return at.select("file", "split", "state", (F.sum("deeper").over(order) - F.col("deeper")).alias("depth"), (F.sum("n_bytes").over(order) - F.col("n_bytes")).alias("offset"),
                     F.when((F.col("split") == F.max("split").over(whole)) & (F.sum("n_bytes").over(whole) > F.col("size")), F.lit(1)).otherwise(F.lit(0)).alias("last"))


class Cutter:
    """Cuts the bytes of one split into elements and pieces."""

    def __init__(self, state: int, depth: int, offset: int):
        self.state, self.depth, self.offset = state, depth, offset
        self.open: list[bytes] | None = [] if depth > 0 else None  # of the element that goes on
        self.began, self.opener = None, None
        self.arrays = self.objects = self.junk = 0

    def feed(self, buf: np.ndarray) -> Iterator[tuple]:
        """(kind, offset, opener, closer, text) of what ends in ``buf``."""
        quote = quotes(buf)
        inside = (np.cumsum(quote) + self.state) % 2 == 1
        outside = ~inside & ~quote
        step = _steps(buf, outside)
        after = self.depth + np.cumsum(step)
        before = after - step
        self.junk += int(np.count_nonzero((before <= 0) & (inside | quote | ~np.isin(buf, BLANKS)) & ~((step == 1) & (before == 0)))) + int(np.count_nonzero(after < 0))
        comma = outside & (buf == COMMA) & (before == 1)
        edges = np.flatnonzero((step == 1) & (before == 0) | (step == -1) & (after == 0) | comma)
        data, at = buf.tobytes(), 0
        in_object = self.opener == b"{"
        for e in edges.tolist():
            mark = data[e:e + 1]
            if mark in b"[{" and before[e] == 0:
                self.arrays += mark == b"["
                self.objects += mark == b"{"
                at = e + (mark == b"[")
                self.open, self.began, self.opener, in_object = [], self.offset + at, mark, mark == b"{"
                continue
            if in_object and mark == b",":  # of the object's own
                continue
            if self.open is None:
                continue
            end = e + (in_object and mark == b"}")
            yield (END if self.began is None else WHOLE), self.began, self.opener, mark, b"".join([*self.open, data[at:end]])
            at = e + 1
            self.open, self.began, self.opener = ([], self.offset + at, mark) if mark == b"," else (None, None, None)
            in_object = False
        if self.open is not None:
            self.open.append(data[at:])
        self.state, self.depth, self.offset = int(inside[-1]) if len(inside) else self.state, int(after[-1]), self.offset + len(buf)

    def close(self) -> Iterator[tuple]:
        if self.open is not None:
            yield (INNER if self.began is None else BEGIN), self.began, self.opener, None, b"".join(self.open)


PIECES = "file string, split long, seq long, kind int, offset long, opener string, closer string, text binary, arrays long, objects long, junk long, depth long"


def pieces(rows: DataFrame, begins: DataFrame) -> DataFrame:
    """The elements and pieces of all splits, and a row of counts for each."""
    known = rows.join(begins, ["file", "split"]).sortWithinPartitions("file", "split", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cutter, seq, last = None, None, 0, 0
        held = b""  # the last row's } may not be there: it waits for the next row

        def rows_of(found, extra=(0, 0, 0, 0)):
            nonlocal seq
            out = []
            for kind, offset, opener, closer, text in found:
                out.append((*now, seq, kind, offset, opener and opener.decode(), closer and closer.decode(), text, *extra))
                seq += 1
            return out

        def finish():
            out = rows_of(cutter.feed(np.frombuffer(held[:len(held) - last], np.uint8))) if len(held) > last else []
            out += rows_of(cutter.close())
            ended = cutter.depth + (1 << 40) * cutter.state  # a string that doesn't end is no depth 0 either
            return out + rows_of([(COUNTS, None, None, None, None)], (cutter.arrays, cutter.objects, cutter.junk, ended))

        def batch_of(out):
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

        names = [x.split(" ")[0] for x in PIECES.split(", ")]
        kinds = [{"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[x.split(" ")[1]] for x in PIECES.split(", ")]
        for batch in batches:
            for file, split, a, b in _runs(batch):
                out = []
                if (file, split) != now:
                    if now is not None:
                        out += finish()
                    now, seq, held = (file, split), 0, b""
                    state, depth, offset, last = (batch.column(c)[a].as_py() for c in ("state", "depth", "offset", "last"))
                    cutter = Cutter(state, depth, offset)
                data = held + _bytes(batch.column("value").slice(a, b - a)).tobytes()
                held = data[-1:]
                if len(data) > 1:
                    out += rows_of(cutter.feed(np.frombuffer(data[:-1], np.uint8)))
                if out:
                    yield batch_of(out)
        if now is not None:
            yield batch_of(finish())

    return known.select("file", "split", "state", "depth", "offset", "last", "value").mapInArrow(run, PIECES)


def read_elements(spark: SparkSession, paths: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(elements, files).  Elements: file, ordinal (the byte at which it
    begins), line (its text; blanks for an empty place between commas), kind
    (its file's).  Files: file, kind: 'array', 'arrays' (several in a row),
    'object' (one), or 'other' (anything else: no elements are given)."""
    rows = fragments(spark, paths)
    begins = materialize(starts(summaries(rows)), "splits")  # of known size: small ones are broadcast, rows stay where they are
    found = materialize(pieces(rows, begins), "elements")
    ends = found.where(F.col("kind") == COUNTS)
    files = ends.groupBy("file").agg(F.sum("arrays").alias("arrays"), F.sum("objects").alias("objects"), F.sum("junk").alias("junk"), F.max_by("depth", "split").alias("ended"))
    sound = (F.col("junk") == 0) & (F.col("ended") == 0)
    files = materialize(files.select("file", F.when(sound & (F.col("arrays") == 1) & (F.col("objects") == 0), "array").when(sound & (F.col("arrays") > 1) & (F.col("objects") == 0), "arrays")
                                     .when(sound & (F.col("arrays") == 0) & (F.col("objects") == 1), "object").otherwise("other").alias("of")), "files")
    found = found.where(F.col("kind") != COUNTS).join(files.where("of <> 'other'"), "file")
    of_arrays = found.where("of <> 'object'")

    # pieces of one element: from its begin on to the next begin
    broken = of_arrays.where(F.col("kind") != WHOLE)
    owner = broken.groupBy("file", "split").agg(F.max(F.when(F.col("kind") == BEGIN, F.col("split"))).alias("begun"))
    before = F.last("begun", ignorenulls=True).over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1))
    broken = broken.join(owner.select("file", "split", before.alias("before")), ["file", "split"]).withColumn("begun", F.when(F.col("kind") == BEGIN, F.col("split")).otherwise(F.col("before")))
    joined = broken.groupBy("file", "of", "begun").agg(F.max("offset").alias("ordinal"), F.max("opener").alias("opener"), F.max("closer").alias("closer"), F.array_sort(F.collect_list(F.struct("split", "text"))).alias("parts"))
    whole = lambda parts: F.aggregate(parts, F.lit(b""), lambda text, part: F.concat(text, part))
    every = of_arrays.where(F.col("kind") == WHOLE).select("file", "of", F.col("offset").alias("ordinal"), "opener", "closer", "text")
    every = every.unionByName(joined.select("file", "of", "ordinal", "opener", "closer", whole(F.col("parts.text")).alias("text")))
    # nothing between the brackets of an array is no element
    empty = (F.col("opener") == "[") & (F.col("closer") == "]") & F.decode("text", "utf-8").rlike(r"^[ \t\r\n]*$")
    every = every.where(~empty).select("file", "of", "ordinal", "text")
    # an object that lies in several splits was cut at its own commas there
    cut = F.when(F.col("closer") == ",", F.lit(b",")).when((F.col("closer") == "}") & (F.coalesce("opener", F.lit("")) != "{"), F.lit(b"}")).otherwise(F.lit(b""))
    single = found.where("of = 'object'").groupBy("file", "of").agg(F.min("offset").alias("ordinal"), F.array_sort(F.collect_list(F.struct("split", "seq", F.concat("text", cut).alias("text")))).alias("parts"))
    every = every.unionByName(single.select("file", "of", "ordinal", whole(F.col("parts.text")).alias("text")))
    return every.select("file", "ordinal", F.decode("text", "utf-8").alias("line"), F.col("of").alias("kind")), files.withColumnRenamed("of", "kind")

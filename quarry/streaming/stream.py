"""Structured Streaming versions of the item flow.

The reference processes items one at a time as the crawler yields them
and appends them to a file.  Here new feed files land in a directory;
``readStream.text`` picks them up and the *same* column functions as the
batch path (strict JSON classification, normalisation, trimming,
routing) run per micro-batch.  The sink is ``foreachBatch`` into the
item table with insert-if-absent on a stable key, so a replayed batch
(after a failure between write and commit) inserts nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import delta as DT
from ..operators import items as I
from ..operators import store as S
from ..sources import feeds as FD

ITEM_COLS = ("url", "issue", "solution", "product", "category", "depth")


def read_feed_stream(spark: SparkSession, src_dir: str, max_files: int | None = None) -> DataFrame:
    """Streaming JSON Lines source: one row per non-blank line, classified
    strictly (``reason`` null = usable object)."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(src_dir).select(
        F.col(FD.FILE_META).alias("file"), F.col("value").alias("line"))
    lines = lines.where(~T.is_blank(F.col("line"))).withColumn("ordinal", F.lit(None).cast("long"))
    return FD._classify(lines)


def clean_items(classified: DataFrame) -> DataFrame:
    """Usable objects → trimmed, routed items (batch or stream)."""
    recs = FD._records(classified.where(F.col("reason").isNull()).select("file", "ordinal", "v"))
    recs = recs.select("file", *ITEM_COLS)
    recs = I.trim_fields(recs, [c for c in ITEM_COLS if c != "depth"])
    return I.route(recs)


def dedupe_stream(df: DataFrame, key: str = "url", event_time: str | None = None,
                  delay: str = "1 hour") -> DataFrame:
    """Streaming keep-first by key.  Without an event time the seen-key
    state is unbounded (as the reference's in-memory set); with one, the
    state is bounded by the watermark."""
    if event_time:
        return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
    return df.dropDuplicates([key])


def upsert_batch(table_path: str, key: str = "url"):
    """``foreachBatch`` function: append the batch's kept items whose key
    is not stored yet (existing row wins).  Safe to replay."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        kept = batch.where((F.col("route") == I.ROUTE_KEPT) & F.col(key).isNotNull() & (F.col(key) != ""))
        kept = kept.withColumn("__ord", F.monotonically_increasing_id())
        existing = S.ensure_table(spark, table_path, kept.drop("__ord", "file", "route").schema)
        new = S.insert_if_absent(existing, kept, key, "__ord").drop("__ord", "file", "route")
        new.write.mode("append").parquet(table_path)
    return run


def delta_batch(root: str, key: str, buckets: int, source: str, kept=lambda batch: batch, reports: list | None = None):
    """``foreachBatch`` function: insert the rows of ``kept(batch)`` whose key
    isn't stored into the bucketed table ``root``; only the keys of the
    buckets that the batch touches are read.  A batch of ``source`` that was
    committed before is skipped; a replay under another name finds its keys
    stored.  ``reports`` gets each load's report."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        rows = kept(batch).withColumn("__ord", F.monotonically_increasing_id())
        DT.create(batch.sparkSession, root, rows.drop("__ord").schema, key, buckets)
        report = DT.insert_new(batch.sparkSession, root, rows, "__ord", txn=(source, epoch_id))
        if reports is not None:
            reports.append(report)
    return run


def run_available(df: DataFrame, table_path: str, checkpoint: str, key: str = "url",
                  rejects_path: str | None = None, buckets: int | None = None):
    """Process everything currently in the source, then stop.  With
    ``buckets`` the table is a bucketed one (``operators.delta``), else one
    Parquet folder whose stored keys every batch reads."""
    def kept(batch: DataFrame) -> DataFrame:
        return batch.where((F.col("route") == I.ROUTE_KEPT) & (F.col(key) != "")).drop("file", "route")

    sink = delta_batch(table_path, key, buckets, checkpoint, kept) if buckets else upsert_batch(table_path, key)
    q = (df.writeStream.foreachBatch(sink)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def run_feed(spark: SparkSession, src_dir: str, table_path: str, checkpoint: str,
             rejects_path: str | None = None, key: str = "url", buckets: int | None = None):
    """The whole streaming load: classify → (rejects sink) → clean →
    dedupe → idempotent upsert."""
    classified = read_feed_stream(spark, src_dir)
    if rejects_path:
        rq = (classified.where(F.col("reason").isNotNull()).select("file", "line", "reason")
              .writeStream.format("parquet").option("path", rejects_path)
              .option("checkpointLocation", checkpoint.rstrip("/") + "_rejects")
              .trigger(availableNow=True).start())
        rq.awaitTermination()
    items = dedupe_stream(clean_items(classified), key)
    return run_available(items, table_path, checkpoint, key, buckets=buckets)

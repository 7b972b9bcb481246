"""Registered streaming and JSON-line keys over ``events``.

The events table stands in for a feed arriving over time: a file
stream source reads it, the same column functions as the batch path run
per micro-batch, and the sinks are written under the shared checkpoint
folder, then read back as the query result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import json as J
from ..operators import delta as DT
from ..session import checkpoint_dir, read_table, table_path
from ..sources import feeds as FD
from ..streaming import stream as ST
from .registry import register

STREAM_BUCKETS = 16


def _scratch(spark, label):
    return f"{checkpoint_dir(spark).rstrip('/')}/quarry-{label}-{uuid.uuid4().hex}"


def event_stream(spark, sf):
    schema = spark.read.parquet(table_path(sf, "events")).schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
            .option("maxFilesPerTrigger", 1).parquet(sf))


def classify_props(df):
    """Strict JSON-object check of ``props`` (one JSON value per line)."""
    lines = df.select("event_id", "user_id", "event_type", F.col("props").alias("line"),
                      F.lit(None).cast("string").alias("file"), F.col("event_id").alias("ordinal"))
    c = FD._classify(lines)
    return c.select("event_id", "user_id", "event_type", "reason",
                    F.try_variant_get(F.col("v"), "$.k", "bigint").alias("k"))


SCAN_SQL = """
SELECT event_id,
       CASE WHEN NOT json_valid(props) THEN 'malformed'
            WHEN json_type(props) <> 'OBJECT' THEN 'not_object' END AS reason,
       CASE WHEN json_type(props) = 'OBJECT' THEN json_extract(props, '$.k')::BIGINT END AS k
FROM events"""


@register("scan_jsonl", SCAN_SQL)
def scan_jsonl(spark, sf):
    """JSON-lines strictness over a text column: each ``props`` must be
    exactly one JSON object; others are rejects with a reason."""
    c = classify_props(read_table(spark, sf, "events"))
    return c.select("event_id", F.regexp_extract("reason", "^([a-z_]+)", 1).alias("r"), "k").select(
        "event_id", F.nullif(F.col("r"), F.lit("")).alias("reason"), "k")


@register("valid_shape", """
SELECT event_id, json_exists(props, '$.k') AS has_k FROM events WHERE json_type(props) = 'OBJECT'""")
def valid_shape(spark, sf):
    """Key-presence check on objects (present, even if null)."""
    ev = read_table(spark, sf, "events")
    v = J.strict_variant(F.col("props"))
    objs = ev.where(J.is_object(v))
    return objs.select("event_id", F.array_contains(J.object_keys(F.col("props")), "k").alias("has_k"))


@register("stream_clean", SCAN_SQL.replace("SELECT event_id,", "SELECT event_id, user_id,"))
def stream_clean(spark, sf):
    """Structured Streaming: strict classification per micro-batch,
    written by the stream, read back."""
    out = _scratch(spark, "stream-clean")
    c = classify_props(event_stream(spark, sf)).select(
        "event_id", "user_id", F.nullif(F.regexp_extract("reason", "^([a-z_]+)", 1), F.lit("")).alias("reason"), "k")
    q = (c.writeStream.format("parquet").option("path", out + "/data")
         .option("checkpointLocation", out + "/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out + "/data")


@register("stream_dedupe", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedupe(spark, sf):
    """Streaming keep-first per (user, event type): the seen-key state
    lives in the state store across micro-batches."""
    out = _scratch(spark, "stream-dedupe")
    d = event_stream(spark, sf).select("user_id", "event_type").dropDuplicates(["user_id", "event_type"])
    q = (d.writeStream.format("parquet").option("path", out + "/data")
         .option("checkpointLocation", out + "/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(out + "/data")


@register("stream_upsert", "SELECT event_id, user_id, event_type FROM events")
def stream_upsert(spark, sf):
    """Idempotent streaming load into a bucketed table: foreachBatch
    insert-if-absent keyed on ``event_id``, reading the keys of the touched
    buckets alone; the whole stream is replayed from a fresh checkpoint and
    the table does not change."""
    out = _scratch(spark, "stream-upsert")
    table = out + "/table"
    for run in ("a", "b"):
        sink = ST.delta_batch(table, "event_id", STREAM_BUCKETS, run, lambda batch: batch.select("event_id", "user_id", "event_type"))
        q = (event_stream(spark, sf).writeStream.foreachBatch(sink)
             .option("checkpointLocation", f"{out}/ckpt-{run}").trigger(availableNow=True).start())
        q.awaitTermination()
    return DT.read(spark, table)

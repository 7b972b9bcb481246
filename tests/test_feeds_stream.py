"""JSON feeds (fixtures X1-X6) and batch = stream."""

from quarry.operators import items as I
from quarry.sources import feeds as FD
from quarry.streaming import stream as ST

JSONL = ('{"url":"u1","title":"T","description":"D"}\n\n{bad\n3\n[{"url":"x"}]\n'
         '{"a":1} junk\n{"a":1}{"b":2}\n{"url":"u2","issue":" I ","solution":"S","depth":2}\n'
         '{"url":"u1","issue":"dup","solution":"later"}\n{"url":"u3","issue":" ","solution":"","product":""}\n')


def write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_jsonl_strict_and_quarantine(spark, workdir):
    write(f"{workdir}/a.jsonl", JSONL)
    feed = FD.read_jsonl(spark, f"{workdir}/a.jsonl")
    assert feed.records.count() == 4
    reasons = sorted(r["reason"] for r in feed.rejects.collect())
    assert reasons.count("malformed") == 3 and len(reasons) == 5
    assert any(r.startswith("not_object:array") for r in reasons)
    r = feed.records.where("url = 'u1' AND issue = 'T'").first()
    assert r["solution"] == "D"


def test_array_object_and_concatenated_files(spark, workdir):
    write(f"{workdir}/b.json", '[{"url":"u3","title":"T","description":"D"},{"url":"u4","issue":"I","solution":"S"},5]')
    write(f"{workdir}/o.json", '{"url":"one","title":null,"description":"D"}')
    write(f"{workdir}/c.json", "[ ][ ]")
    write(f"{workdir}/e.json", '[{"url":"r1","issue":"a","solution":"b"}][{"url":"r2","issue":"c","solution":"d"}]')
    f = FD.read_json_array(spark, [f"{workdir}/b.json", f"{workdir}/o.json", f"{workdir}/c.json"], require_shape=True)
    assert sorted(r["url"] for r in f.records.collect()) == ["one", "u3", "u4"]
    assert sorted(r["reason"] for r in f.rejects.collect()) == ["malformed_file", "not_object:bigint"]
    assert f.records.where("url = 'u3'").first()["issue"] == "T"
    assert f.records.where("url = 'one'").first()["issue"] is None
    f2 = FD.read_json_array(spark, [f"{workdir}/c.json", f"{workdir}/e.json"], repair=True)
    assert sorted(r["url"] for r in f2.records.collect()) == ["r1", "r2"] and f2.rejects.count() == 0


def test_auto_reader_skips_missing_and_keeps_order(spark, workdir):
    write(f"{workdir}/a.jsonl", JSONL)
    write(f"{workdir}/b.json", '[{"url":"u3","title":"T","description":"D"}]')
    f = FD.read_auto(spark, [f"{workdir}/missing.json", f"{workdir}/a.jsonl", f"{workdir}/b.json"])
    got = [(r["source_index"], r["url"]) for r in f.records.orderBy("source_index", "ordinal").collect()]
    assert got[0] == (0, "u1") and got[-1] == (1, "u3")


def test_stream_equals_batch_and_replay_is_harmless(spark, workdir):
    src = f"{workdir}/in"
    import os
    os.makedirs(src)
    write(f"{src}/part1.jsonl", JSONL)
    table, ckpt = f"{workdir}/items", f"{workdir}/ckpt"
    ST.run_feed(spark, src, table, ckpt, rejects_path=f"{workdir}/rejects")
    got = sorted((r["url"], r["issue"]) for r in spark.read.parquet(table).collect())
    batch = FD.read_jsonl(spark, f"{src}/part1.jsonl")
    b = I.route(I.trim_fields(batch.records.select("ordinal", "url", "issue", "solution", "product")))
    from quarry.operators import dedupe as D
    b = D.dedupe_first(b.where("route = 'kept'"), "url", "ordinal")
    assert {u for u, _ in got} == {r["url"] for r in b.collect()} == {"u1", "u2"}
    assert spark.read.parquet(f"{workdir}/rejects").count() == 5
    # A second file repeating a stored key, and a replay from a fresh checkpoint.
    write(f"{src}/part2.jsonl", '{"url":"u2","issue":"again","solution":"x"}\n{"url":"u9","issue":"n","solution":"s"}\n')
    ST.run_feed(spark, src, table, ckpt)
    ST.run_feed(spark, src, table, f"{workdir}/ckpt2")
    urls = sorted(r["url"] for r in spark.read.parquet(table).collect())
    assert urls == ["u1", "u2", "u9"]


def test_watermark_dedupe_stream(spark, workdir):
    import os
    from pyspark.sql import functions as F
    src = f"{workdir}/ev"
    os.makedirs(src)
    rows = [("u1", "2024-01-01 00:00:00"), ("u1", "2024-01-01 00:10:00"), ("u2", "2024-01-01 00:05:00")]
    spark.createDataFrame(rows, "url string, ts string").withColumn("ts", F.to_timestamp("ts")) \
        .coalesce(1).write.parquet(f"{src}/b1")
    stream = spark.readStream.schema("url string, ts timestamp").parquet(f"{src}/b1")
    d = ST.dedupe_stream(stream, "url", event_time="ts", delay="1 hour")
    q = (d.writeStream.format("memory").queryName("wm_dedupe").trigger(availableNow=True)
         .option("checkpointLocation", f"{workdir}/ck").start())
    q.awaitTermination()
    assert sorted(r["url"] for r in spark.sql("SELECT url FROM wm_dedupe").collect()) == ["u1", "u2"]

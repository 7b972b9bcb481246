"""Bucketed tables with delta files, against dictionaries."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import delta as DT
from quarry.plans import jobs as J
from quarry.streaming import stream as ST

SCHEMA = "id string, v long"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, n) for n, (k, v) in enumerate(rows)], SCHEMA + ", n long").repartition(3)


def stored(spark, root):
    rows = [tuple(r) for r in DT.read(spark, root).select("id", "v").collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


def table(spark, root, buckets=8):
    DT.create(spark, root, spark.createDataFrame([], SCHEMA).schema, "id", buckets)
    return root


def test_loads_against_a_dictionary(spark, workdir):
    root = table(spark, f"{workdir}/t")
    r, want = random.Random(5), {}
    for step in range(7):
        rows = [(r.choice([None, *[f"k{i}" for i in range(25)]]), r.randrange(1000)) for _ in range(r.randrange(1, 20))]
        if step % 3 == 1:
            report = DT.insert_new(spark, root, frame(spark, rows), "n")
            new = {}
            for k, v in rows:
                if k is not None and k not in want:
                    new.setdefault(k, v)
            want |= new
            assert report.written == len(new)
        else:
            report = DT.upsert(spark, root, frame(spark, rows), "n")
            want |= {k: v for k, v in rows if k is not None}
            assert report.files_read == 0
        assert (report.rows_in, report.null_keys) == (len(rows), sum(k is None for k, _ in rows))
        if step in (3, 5):
            DT.compact(spark, root)
            assert all(len(loads) == 1 for loads in DT.manifest(spark, root).loads.values())
        assert stored(spark, root) == want


def test_a_load_reads_the_touched_buckets_alone(spark, workdir):
    root = table(spark, f"{workdir}/t", 16)
    DT.insert_new(spark, root, frame(spark, [(f"k{i}", i) for i in range(200)]), "n")
    report = DT.insert_new(spark, root, frame(spark, [("k1", 0), ("new", 1)]), "n")
    assert report.files_total == 16 and report.files_read == report.buckets_touched <= 2 and report.written == 1
    keys = spark.createDataFrame([("k1",), ("new",), ("none",)], "id string")
    hit = DT.read(spark, root, keys)
    assert sorted(tuple(x) for x in hit.collect()) == [("k1", 1), ("new", 1)]
    assert len(hit.inputFiles()) < 16


def test_failed_concurrent_repeated_and_empty_loads(spark, workdir, monkeypatch):
    root = table(spark, f"{workdir}/t")
    DT.upsert(spark, root, frame(spark, [("a", 1)]), "n", txn=("feed", 4))
    before = DT.manifest(spark, root)
    # files of a load that was never committed
    DT._write(spark, root, before, frame(spark, [("b", 2)]))
    assert stored(spark, root) == {"a": 1}
    assert DT.upsert(spark, root, frame(spark, [("a", 9)]), "n", txn=("feed", 4)).skipped
    assert not DT.upsert(spark, root, frame(spark, []), "n", txn=("other", 4)).skipped
    # a second writer that read the manifest before the last load
    monkeypatch.setattr(DT, "manifest", lambda *_: before)
    with pytest.raises(DT.ConcurrentLoad):
        DT.upsert(spark, root, frame(spark, [("c", 3)]), "n")
    monkeypatch.undo()
    assert stored(spark, root) == {"a": 1}
    assert DT.compact(spark, root).skipped
    assert DT.upsert(spark, root, frame(spark, [("a", 5), ("d", 4)]), None).written == 2
    assert stored(spark, root) == {"a": 5, "d": 4}
    assert DT.create(spark, root, spark.createDataFrame([], SCHEMA).schema, "id", 99).buckets == 8
    with pytest.raises(ValueError):
        DT.read(spark, f"{workdir}/nothing")


def test_equal_ordinals_give_one_row_of_a_key(spark, workdir):
    root = table(spark, f"{workdir}/t", 2)
    ties = spark.createDataFrame([("a", 1, 0), ("a", 2, 0), ("b", 3, 0)], SCHEMA + ", n long")
    assert DT.insert_new(spark, root, ties, "n").written == 2
    assert DT.upsert(spark, root, ties, "n").written == 2
    assert sorted(stored(spark, root)) == ["a", "b"]


def test_old_manifests_go(spark, workdir, monkeypatch):
    import os
    monkeypatch.setattr(DT, "KEPT_MANIFESTS", 2)
    root = table(spark, f"{workdir}/t", 2)
    for i in range(4):
        DT.upsert(spark, root, frame(spark, [("a", i)]), "n")
    assert sorted(f for f in os.listdir(f"{root}/manifests") if f.endswith(".json")) == [f"{v:010d}.json" for v in (3, 4)]
    assert stored(spark, root) == {"a": 3}


def test_ids_follow_the_stored_ones(spark, workdir):
    root = f"{workdir}/t"
    DT.create(spark, root, spark.createDataFrame([], "id long, url string").schema, "url", 4)
    def load(urls):
        return DT.insert_new(spark, root, spark.createDataFrame([(u, n) for n, u in enumerate(urls)], "url string, n long"), "n", id_col="id")
    assert [load(u).written for u in (["a", "b", "a"], ["b", "c", None, "d"], ["d"])] == [2, 2, 0]
    assert {r.url: r.id for r in DT.read(spark, root).collect()} == {"a": 1, "b": 2, "c": 3, "d": 4}


def test_stream_into_buckets(spark, workdir):
    import os
    src = f"{workdir}/in"
    os.makedirs(src)
    def put(name, text):
        with open(f"{src}/{name}", "w") as f:
            f.write(text)
    put("a.jsonl", '{"url":"u1","issue":"i","solution":"s"}\n{"url":"u2","issue":"j","solution":"s"}\n{"url":"u1","issue":"late","solution":"s"}\n')
    root = f"{workdir}/items"
    ST.run_feed(spark, src, root, f"{workdir}/ckpt", buckets=8)
    put("b.jsonl", '{"url":"u2","issue":"again","solution":"x"}\n{"url":"u9","issue":"n","solution":"s"}\n')
    ST.run_feed(spark, src, root, f"{workdir}/ckpt", buckets=8)
    ST.run_feed(spark, src, root, f"{workdir}/ckpt2", buckets=8)
    got = {r.url: r.issue for r in DT.read(spark, root).collect()}
    assert sorted(got) == ["u1", "u2", "u9"] and got["u2"] == "j"


def test_catalogue_load_is_whole_after_a_stop_between_its_tables(spark, workdir, monkeypatch):
    items = spark.createDataFrame([(1, "u1", "p", "i", "s"), (2, "u2", None, "j", "t"), (3, "u1", "q", "k", "w"), (4, None, "p", "i", "s")],
                                  "ordinal long, url string, product string, issue string, solution string")
    table_root, vectors = f"{workdir}/t", f"{workdir}/v"
    real = DT.upsert
    def stop(*_, **__):
        raise RuntimeError("lost")
    monkeypatch.setattr(DT, "upsert", stop)
    with pytest.raises(RuntimeError):
        J.load_catalogue(items, table_root, vectors, buckets=4)
    monkeypatch.setattr(DT, "upsert", real)
    added, upserted = J.load_catalogue(items, table_root, vectors, buckets=4)
    assert added.written == 0 and upserted.written == 2
    assert {r.url: (r.id, r.product) for r in DT.read(spark, table_root).collect()} == {"u1": (1, "p"), "u2": (2, "unknown product")}
    assert {r.id for r in DT.read(spark, vectors).collect()} == {"doc_1", "doc_2"}
    assert DT.read(spark, vectors).where(F.size("embedding") == 64).count() == 2

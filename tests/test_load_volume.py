"""What loads into bucketed tables move: keys decide, texts move once."""

import glob

from pyspark.sql import functions as F

from quarry.operators import delta as DT
from quarry.plans import jobs as J
from quarry.session import checkpoint_dir

SCHEMA = "id string, v long"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, n) for n, (k, v) in enumerate(rows)], SCHEMA + ", n long")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def staged(spark):
    return set(glob.glob(f"{checkpoint_dir(spark).removeprefix('file:')}/quarry-delta-batch-*"))


def test_files_that_count_whole_or_not_at_all_are_not_joined(spark, workdir):
    root = f"{workdir}/t"
    DT.create(spark, root, spark.createDataFrame([], SCHEMA).schema, "id", 2)
    some, more = [(f"k{i}", i) for i in range(20)], [(f"m{i}", i) for i in range(20)]
    DT.insert_new(spark, root, frame(spark, some), "n")
    DT.insert_new(spark, root, frame(spark, some + more), "n")
    both = DT.read(spark, root)
    assert "Join" not in plan(both) and sorted(map(tuple, both.collect())) == sorted(some + more)
    named = DT.read(spark, root, both.select("id"))
    assert "Join" not in plan(named) and sorted(map(tuple, named.collect())) == sorted(some + more)
    DT.upsert(spark, root, frame(spark, [(k, -v) for k, v in some + more]), "n")
    replaced = DT.read(spark, root)
    assert "Join" not in plan(replaced) and {r.v for r in replaced.collect()} == {-v for v in range(20)}
    assert all("load=3-" in f for f in replaced.inputFiles())
    DT.upsert(spark, root, frame(spark, [("k1", 100)]), "n")  # a file of which some rows count
    assert sorted(map(tuple, DT.read(spark, root).collect())) == sorted([("k1", 100), *[(k, -v) for k, v in some + more if k != "k1"]])
    assert [tuple(r) for r in DT.read(spark, root, spark.createDataFrame([("k2",)], "id string")).collect()] == [("k2", -2)]


def test_rows_follow_their_marks_in_one_exchange(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("c", None, "n")], "k string, o long, text string")
    marks = spark.createDataFrame([("a", 1, 7), ("c", None, 8), ("d", 1, 9)], "k string, o long, id long")
    got = DT.follow(rows, marks, ["k", "o"], lambda both: (both.repartition("k", "o"), ()))
    physical = got._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.k, r.text, r.id) for r in got.collect()) == [("a", "x", 7), ("c", "n", 8)]
    assert physical.count("Exchange hashpartitioning") == 1 and "Join" not in physical


def test_jobs_load_without_writing_their_batches(spark, workdir):
    items = spark.createDataFrame([(n, f"u{n % 40}", "p", "i", f"s{n}", "docs") for n in range(60)], "ordinal long, url string, product string, issue string, solution string, source string")
    before = staged(spark)
    added, vectors = J.load_catalogue(items, f"{workdir}/t", f"{workdir}/v", buckets=4)
    assert (added.rows_in, added.written, vectors.written) == (60, 40, 40)
    assert {(r.id, r.url, r.solution) for r in DT.read(spark, f"{workdir}/t").collect()} == {(n + 1, f"u{n}", f"s{n}") for n in range(40)}
    assert {(r.metadata.db_id, r.metadata.solution) for r in DT.read(spark, f"{workdir}/v").collect()} == {(str(n + 1), f"s{n}") for n in range(40)}
    added, vectors = J.load_knowledge([items, items], {}, "generic", f"{workdir}/kt", f"{workdir}/kv", buckets=4)
    assert (added.rows_in, added.written, vectors.written) == (120, 60, 60)
    again, vectors = J.load_knowledge([items], {}, "generic", f"{workdir}/kt", f"{workdir}/kv", buckets=4)
    assert (again.written, vectors.written) == (0, 60)
    assert DT.read(spark, f"{workdir}/kt").agg(F.min("id"), F.max("id"), F.countDistinct("id")).first() == (1, 60, 60)
    assert staged(spark) == before

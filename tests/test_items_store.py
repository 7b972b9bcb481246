"""Item cleaning, dedupe, stores, retrieval edge cases."""

import numpy as np
from pyspark.sql import functions as F

from quarry.operators import dedupe as D
from quarry.operators import embed as EM
from quarry.operators import items as I
from quarry.operators import relevance as R
from quarry.operators import retrieve as RT
from quarry.operators import store as S


def test_trim_keeps_int_and_strips_unicode(spark):
    df = spark.createDataFrame([("\t a\n", " b ", 3)], "issue string, solution string, depth int")
    r = I.trim_fields(df).first()
    assert (r["issue"], r["solution"], r["depth"]) == ("a", "b", 3)


def test_route_discarded_when_all_blank(spark):
    df = spark.createDataFrame([("u", " ", "", None), ("u", "x", "", None)],
                               "url string, issue string, solution string, product string")
    assert [r["route"] for r in I.route(df).collect()] == ["discarded", "kept"]


def test_dedupe_keeps_first_and_null_keys_not_merged(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "a"), (4, None), (5, None)], "o long, url string")
    got = sorted((r["o"], r["url"]) for r in D.dedupe_first(df, "url", "o").collect())
    assert got == [(1, "a"), (4, None), (5, None)]


def test_insert_twice_is_idempotent(spark, workdir):
    path = f"{workdir}/table"
    schema = "url string, o long"
    new = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3)], schema)
    for _ in range(2):
        existing = S.ensure_table(spark, path, new.schema)
        ins = S.insert_if_absent(existing, new, "url", "o")
        ins.write.mode("append").parquet(path)
    assert sorted(r["url"] for r in spark.read.parquet(path).collect()) == ["a", "b"]


def test_assign_ids_dense_in_order(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7 % 1000).alias("k"))
    rows = S.assign_ids(df, "k", start=10).collect()
    assert sorted((r["k"], r["id"]) for r in rows) == [(k, k + 10) for k in range(1000)]


def test_upsert_replaces_and_inserts(spark):
    old = spark.createDataFrame([("1", 1.0), ("2", 2.0)], "id string, v double")
    new = spark.createDataFrame([("2", 20.0, 0), ("3", 30.0, 1), ("3", 31.0, 2)], "id string, v double, o long")
    got = sorted(tuple(r) for r in S.upsert(old, new.select("id", "v", "o"), "id", "o").select("id", "v").collect())
    assert got == [("1", 1.0), ("2", 20.0), ("3", 31.0)]


def test_validate_dimension_counts(spark):
    df = spark.createDataFrame([(1, [0.1] * 4), (2, None), (3, [0.1] * 3)], "id long, embedding array<double>")
    got = {r["id"]: r["vector_status"] for r in EM.validate_dimension(df, dim=4).collect()}
    assert got == {1: "ok", 2: "missing", 3: "wrong_dim"}


def test_verdict_normalisation(spark):
    df = spark.createDataFrame([(" Yes ",), ("yes.",), ("NO",), (None,)], "v string")
    assert [r[0] for r in df.select(R.normalise_verdict("v")).collect()] == [True, False, False, False]


def test_keyword_literal_and_no_match(spark):
    rows = spark.createDataFrame([(1, "50% off"), (2, "a_b"), (3, "axb")], "o long, text string")
    q = spark.createDataFrame([(1, "0%"), (2, "a_b"), (3, "zzz")], "query_id long, keyword string")
    got = {r["query_id"]: (r["match_id"], r["answer"]) for r in
           RT.keyword_first_match(rows, q, "text", "o").collect()}
    assert got == {1: (1, "50% off"), 2: (2, "a_b"), 3: (None, "No match")}


def test_topk_ties_by_id_and_zero_vector(spark):
    corpus = spark.createDataFrame([(5, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None)],
                                   "id long, embedding array<double>")
    q = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 0.0])], "query_id long, embedding array<double>")
    got = sorted(tuple(r) for r in RT.topk_cosine(corpus, q, k=3).collect())
    assert got[:3] == [(0, 1, 2, 1.0), (0, 2, 5, 1.0), (0, 3, 3, 0.0)]
    assert [r[3] for r in got[3:]] == [0.0, 0.0, 0.0]


def test_hashed_embedding_unit_length(spark):
    df = spark.createDataFrame([("Hello hello world",), ("",)], "t string")
    vecs = [r[0] for r in EM.embed_hashed(df, "t", 16).select("embedding").collect()]
    assert abs(np.linalg.norm(vecs[0]) - 1) < 1e-12 and sum(vecs[1]) == 0


def test_keyword_many_queries_same_as_few(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(
        ["Alpha beta", "50% OFF", "a_b c", "gamma", "beta again", "Ünïcode text"])], "o long, text string")
    kws = ["beta", "0%", "a_b", "zzz", "", "ünï", "GAMMA"] + [f"none{i}" for i in range(13)]
    q = spark.createDataFrame(list(enumerate(kws)), "query_id long, keyword string")
    many = {r["query_id"]: (r["match_id"], r["answer"]) for r in RT.keyword_first_match(rows, q, "text", "o").collect()}
    few = {}
    for qid, kw in enumerate(kws[:7]):
        one = spark.createDataFrame([(qid, kw)], "query_id long, keyword string")
        few.update({r["query_id"]: (r["match_id"], r["answer"]) for r in RT.keyword_first_match(rows, one, "text", "o").collect()})
    assert {k: many[k] for k in few} == few
    assert few[0] == (0, "Alpha beta") and few[3] == (None, "No match") and few[4][0] == 0
    assert few[5] == (5, "Ünïcode text") and few[6] == (3, "gamma")


def test_file_sinks_round_trip(spark, workdir):
    import json
    import os
    df = spark.createDataFrame([("u1", "é\nx", "kept"), ("u2", None, "discarded")],
                               "url string, issue string, route string")
    S.write_jsonl(df.drop("route"), f"{workdir}/jsonl")
    assert sorted(r["url"] for r in spark.read.json(f"{workdir}/jsonl").collect()) == ["u1", "u2"]
    S.write_routed(df, f"{workdir}/routed")
    assert os.path.isdir(f"{workdir}/routed/route=kept") and os.path.isdir(f"{workdir}/routed/route=discarded")
    S.export_json_array(df.drop("route"), f"{workdir}/arr")
    part = [f for f in os.listdir(f"{workdir}/arr") if f.startswith("part-")][0]
    data = json.load(open(f"{workdir}/arr/{part}"))
    assert sorted(d["url"] for d in data) == ["u1", "u2"] and any(d["issue"] is None for d in data)


def test_deliver_reports_failed_batches(spark):
    df = spark.range(0, 250, 1, 1).select(F.col("id").cast("string").alias("id"),
                                              F.floor(F.col("id") / 100).cast("long").alias("batch_id"))

    def send(recs):
        if recs[0]["id"] == "100":
            raise RuntimeError("service down")

    rep = sorted(tuple(r) for r in S.deliver(df, send).collect())
    assert [(b, n, ok) for b, _, n, ok, _ in rep] == [(0, 100, True), (1, 100, False), (2, 50, True)]


def test_zip_by_ordinal(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "ordinal long, item string")
    b = spark.createDataFrame([(2, 20), (3, 30)], "ordinal long, id long")
    got = sorted(tuple(r) for r in S.zip_by_ordinal(a, b).collect())
    assert got == [(1, "x", None), (2, "y", 20), (3, None, 30)]


def test_brand_table_fallback_and_providers(spark):
    df = spark.createDataFrame([(1, "src0", None), (2, "srcX", "sol")], "doc_id long, source string, solution string")
    brands = spark.createDataFrame([("src0", "Northwind")], "source string, brand string")
    got = {r["doc_id"]: r["brand"] for r in I.brand_by_table(df, brands, default="generic").collect()}
    assert got == {1: "Northwind", 2: "generic"}
    fb = {r["doc_id"]: r["fallback_text"] for r in I.fallback_text(df).collect()}
    assert fb == {1: "1 src0", 2: "sol"}
    texts = spark.createDataFrame([(1, "a b"), (2, "boom")], "id long, text string")

    def provider(batch):
        if "boom" in batch:
            raise RuntimeError("outage")
        return [[1.0, 0.0] for _ in batch]

    vec = {r["id"]: r["embedding"] for r in EM.embed_with(texts, "text", provider, dim=2).collect()}
    # one Arrow batch here: the failing text nulls the whole batch
    assert vec[2] is None and vec[1] in ([1.0, 0.0], None)
    verdicts = R.with_provider(texts, "text", lambda b: [" YES " if "a" in t else "no" for t in b])
    assert {r["id"]: r["relevant"] for r in verdicts.collect()} == {1: True, 2: False}


def test_versioned_upsert_pointer(spark, workdir):
    root = f"{workdir}/vectors"
    v1 = spark.createDataFrame([("1", 1.0)], "id string, v double")
    S.write_version(v1, root)
    cur = S.read_current(spark, root)
    v2 = S.upsert(cur, spark.createDataFrame([("1", 2.0, 0), ("2", 3.0, 0)], "id string, v double, o long")
                  .select("id", "v", "o"), "id", "o")
    S.write_version(v2, root)
    assert sorted(tuple(r) for r in S.read_current(spark, root).collect()) == [("1", 2.0), ("2", 3.0)]


def test_insert_report_counts_apart(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), ("c", 4)], "url string, o long")
    existing = spark.createDataFrame([("c", 0)], "url string, o long")
    ins = S.insert_if_absent(existing, new, "url", "o")
    r = S.insert_report(new, ins).first()
    assert (r["inserted"], r["skipped"]) == (2, 2)


def test_kb_load_empty_sources_short_circuit(spark):
    from quarry.plans import jobs as J
    empty = spark.createDataFrame([], "ordinal long, url string, issue string, solution string, product string, source string")
    kb, vec = J.kb_load([empty], {}, "generic")
    assert kb.count() == 0 and vec.count() == 0


def test_file_load_cuts_flags_and_replays(spark, workdir):
    import json

    from quarry.plans import jobs as J

    path = f"{workdir}/one.jsonl"
    rows = [{"url": "a", "issue": "i", "solution": "é" * 12 + " tail", "product": "p"}, {"url": "b", "issue": "j", "solution": "x" * 12},
            {"url": "a", "issue": "i", "solution": "é" * 12 + " tail", "product": "p"}, {"solution": ""}]
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(json.dumps(r, ensure_ascii=False) for r in rows) + "\n\n{broken\n")
    vectors, cut, rejects = J.file_load(spark, path, cut=12)
    got = {r.metadata.url: r.metadata.solution for r in vectors.collect()}
    assert got == {"a": "é" * 12, "b": "x" * 12}
    assert [(r.url, r.solution_chars) for r in cut.collect()] == [("a", 17)]
    assert rejects.count() == 1
    again, _, _ = J.file_load(spark, path, stored=vectors, cut=12)
    assert sorted(r.id for r in again.collect()) == sorted(r.id for r in vectors.collect())


def test_hashed_counts_of_arrow_tokens(monkeypatch):
    import hashlib

    import numpy as np
    import pyarrow as pa

    from quarry.operators import embed as EM
    monkeypatch.setattr(EM, "ROWS", 3)
    rows = [["a", "é", "a"], None, [], ["b"] * 5, ["a", "b", "c", "d"], None, ["é"]] * 2
    got = EM.hashed_counts(pa.array([["x"], *rows], pa.list_(pa.string())).slice(1), 8).to_pylist()
    for tokens, vector in zip(rows, got, strict=True):
        if tokens is None:
            assert vector is None
            continue
        want = np.bincount([int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % 8 for t in tokens], minlength=8).astype(float)
        n = np.sqrt(want @ want)
        assert vector == (want / n if n else want).tolist()

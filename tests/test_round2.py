"""Links, paragraphs, bodies, jobs and searches: the awkward forms."""

import json
import os

from pyspark.sql import functions as F

from quarry.functions import html as H
from quarry.functions import text as T
from quarry.operators import dedupe as D
from quarry.operators import parse as PA
from quarry.operators import relevance as R
from quarry.operators import retrieve as RT
from quarry.operators import store as S
from quarry.plans import jobs as J
from quarry.plans import pages_catalog as PC
from quarry.schema import VECTOR
from quarry.sources import feeds


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]


def test_anchor_forms(spark):
    html = ("""<A HREF="/up">U</A><a class=k href='/sq'>S <sub>2</sub></a><a href=/uq>Q</a><a data-href="/d" href="/real">R</a>"""
            """<a href="/q?a=1&amp;b=2">E</a><a name="none">n</a><abbr href="/x">x</abbr><a title="a > b href='/no'" href="/yes">Y<b>z</b></a><!-- <a href="/c">c</a> -->""")
    got = [(r.href, r.text) for r in one(spark, H.links, html)]
    assert got == [("/up", "U"), ("/sq", "S 2"), ("/uq", "Q"), ("/real", "R"), ("/q?a=1&b=2", "E"), ("/yes", "Yz")]
    nodes = PA.parse_nodes(html)
    assert [n["attrs"]["href"] for n in nodes if n["tag"] == "a" and "href" in n["attrs"]] == [h for h, _ in got]


def test_paragraphs_go_on_through_inline_tags(spark):
    html = '<p>See <a href="x">this</a> for more</p><P>H<sub>2</sub>O<p class="q">open<div>block</div><pre>no</pre>'
    assert one(spark, H.paragraphs, html) == ["See this for more", "H2O", "open"]


def test_bodies_keep_their_own_replacement_characters(spark):
    assert one(spark, T.decode_body, "a\ufffdb") == "a\ufffdb"
    assert one(spark, T.decode_body, b"a\xffb\xef\xbf\xbdc", "binary") == "ab\ufffdc"
    assert one(spark, T.decode_body, None) is None


def test_nested_list_items():
    nodes = PA.parse_nodes("<ul><li>A<ul><li>B</ul>tail<li>C</ul>")
    items = [(n["text"], n["depth"]) for n in nodes if n["tag"] == "li"]
    assert items == [("A B tail".replace(" ", ""), 1), ("B", 3), ("C", 1)]


def test_relevance_reads_whole_texts(spark):
    df = spark.createDataFrame([("x " * 3000 + "lighting",), ("x",)], "text string")
    assert [r.verdict for r in R.topic_rule(df, "text").collect()] == ["yes", "no"]


def test_catalogue_keeps_whole_texts_and_rejects(spark):
    long = " ".join(["word"] * 150)
    rows = [(0, "u1", "i", long, None, None, 0), (1, None, "i", "s", "p", "c", 0), (2, "u2", None, " ", "", None, 0), (3, "u1", "later", "s", "p", "c", 0)]
    df = spark.createDataFrame(rows, "ordinal long, url string, issue string, solution string, product string, category string, depth int")
    table, vectors = J.catalogue(df)
    assert sorted((r.url, r.product) for r in table.collect()) == [("u1", "unknown product"), ("u2", "")]
    got = vectors.collect()
    assert [r.metadata.solution for r in got] == [long]  # u2 is blank, so it has no vector
    assert [r.reason for r in J.catalogue_rejects(df).collect()] == ["no_url"]


def test_record_shape_is_each_rows_own(spark):
    a = spark.createDataFrame([("t", "d"), ("t", None)], "title string, description string")
    assert J.valid_shape(a).count() == 1 and J.shape_rejects(a).count() == 1
    keyed = spark.createDataFrame([(["title", "solution"],), (["title"],)], "keys array<string>")
    assert J.valid_shape(keyed).count() == 1


def test_vector_ids_are_unique(spark):
    rows = [("b", "u", "p1", "i", "s"), ("b", "u", "p2", "i", "s"), ("b", None, "p", "u", "s"), ("b", "u", "p", None, "s")]
    df = spark.createDataFrame(rows, "brand string, url string, product string, issue string, solution string")
    assert df.select(J.vector_id()).distinct().count() == 4


def test_second_load_adds_nothing(spark):
    rows = [("b", "u", "p1", "i", "s1", 0), ("b", "u", "p2", "i", "s2", 1), ("b", "u", "p2", "i", "s2", 2)]
    new = spark.createDataFrame(rows, "brand string, url string, product string, issue string, solution string, ordinal long")
    empty = spark.createDataFrame([], "id long, brand string, url string, product string, issue string, solution string")
    table, vectors = J.load(empty, spark.createDataFrame([], VECTOR), new)
    table, vectors = J.materialize(table), J.materialize(vectors)
    assert sorted(r.id for r in table.collect()) == [1, 2] and vectors.count() == 2
    again, after = J.load(table, vectors, new)
    assert again.count() == 0 and after.count() == 2
    more, _ = J.load(table, vectors, new.unionByName(new.withColumn("product", F.lit("p3")).limit(1)))
    assert [r.id for r in more.collect()] == [3]


def test_pages_sharing_an_id_stay_two_items(spark):
    df = spark.createDataFrame([(1, "http://a/how-to-reset-login", "<p>one</p>"), (1, "http://b/", "<p>" + "y " * 1500 + "</p>")], "page_id long, url string, html string")
    got = J.page_items(df).collect()
    assert len(got) == 2 and max(len(r.solution) for r in got) == 2999


def test_null_key_has_a_first_row(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "k"), (4, "k")], "o long, k string")
    assert [r.is_first for r in D.flag_first(df, "k", "o").orderBy("o").collect()] == [True, False, True, False]


def test_keep_first_carries_no_text_through_aggregation(spark):
    df = spark.createDataFrame([(1, "a", "t"), (2, "a", "u")], "o long, k string, body string")
    plan = D.dedupe_first(df, "k", "o")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "min_by" not in plan


def test_many_keyword_queries(spark):
    rows = spark.createDataFrame([(3, "has k77 in it"), (1, "no"), (2, "K77!")], "id long, text string")
    queries = spark.range(100_001).select(F.col("id").alias("query_id"), F.concat(F.lit("k"), F.col("id").cast("string")).alias("keyword"))
    got = RT.keyword_first_match(rows, queries, "text", "id")
    assert got.count() == 100_001
    hits = {r.query_id: (r.match_id, r.answer) for r in got.where("match_id is not null").collect()}
    assert hits == {7: (2, "K77!"), 77: (2, "K77!")}


def test_topk_over_several_blocks(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(RT, "QUERY_BLOCK", 5)
    monkeypatch.setattr(RT, "CORPUS_SLICE", 30)
    monkeypatch.setattr(RT, "TILE_ROWS", 8)
    r = np.random.default_rng(1)
    c, q = r.standard_normal((100, 6)).round(3), r.standard_normal((17, 6)).round(3)
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(c)], "id long, embedding array<double>")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "query_id long, embedding array<double>")
    got = {(x.query_id, x["rank"]): x.id for x in RT.topk_cosine(corpus, queries, 4).collect()}
    scores = (q / np.linalg.norm(q, axis=1)[:, None]) @ (c / np.linalg.norm(c, axis=1)[:, None]).T
    assert got == {(i, k + 1): int(j) for i in range(17) for k, j in enumerate(np.argsort(-scores[i])[:4])}


def test_link_graph_from_hrefs(spark):
    pages = [(1, "http://s.org/a", '<a href="b">x</a><a href="http://s.org/c?utm_source=q">y</a><a href="#top">z</a>'), (2, "http://s.org/b", '<a href="/c#f">x</a>'), (3, "http://S.org/c/", '<a href="http://else.org/">x</a>')]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert sorted(tuple(r) for r in PC.link_edges(df).collect()) == [(1, 2), (1, 3), (2, 3)]


def test_source_index_by_path(spark, workdir):
    for name, rows in (("f.json", [{"title": "a", "solution": "s"}]), ("f.jsonl", [{"title": None, "issue": "keep me", "solution": "s"}])):
        with open(os.path.join(workdir, name), "w") as f:
            f.write(json.dumps(rows) if name == "f.json" else "\n".join(map(json.dumps, rows)))
    got = feeds.read_auto(spark, [f"{workdir}/f.json", f"{workdir}/f.jsonl"]).records.collect()
    assert sorted((r.source_index, r.issue) for r in got) == [(0, "a"), (1, "keep me")]


def test_pointer_is_replaced_in_one_step(spark, workdir):
    for k in (1, 2):
        S.write_version(spark.range(k), f"{workdir}/t")
        assert S.read_current(spark, f"{workdir}/t").count() == k


def test_array_export_streams(spark, workdir):
    S.export_json_array(spark.range(0, 25_000, 1, 3), f"{workdir}/a")
    part = [f for f in os.listdir(f"{workdir}/a") if f.startswith("part-")]
    assert len(part) == 1 and len(json.load(open(f"{workdir}/a/{part[0]}"))) == 25_000
    S.export_json_array(spark.range(0), f"{workdir}/none")
    part = [f for f in os.listdir(f"{workdir}/none") if f.startswith("part-")]
    assert json.load(open(f"{workdir}/none/{part[0]}")) == []

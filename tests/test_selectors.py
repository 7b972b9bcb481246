"""Result containers, link titles, next links and resolved result links."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import pages as P
from quarry.operators import parse as PR

HTML = """<html><body><a href="out.pdf">outside</a>
<div id="my-searchResults-1"><p><a href="a.pdf" title=" T  1 "> </a></p><a href="b.html">b</a><a href="c.pdf?x=1">c</a></div>
<ul class="big results"><li class="result-item"><a href="/d.pdf">D  d</a></li></ul>
<embed type="application/pdf" src="e.pdf"><embed type="image/png" src="f.pdf"><embed type="application/pdf" href="" src="Video.mp4">
<a href="/p2" aria-label="go next"></a><a class="pagination-next" href="/p3">3</a></body></html>"""


@pytest.fixture(scope="module")
def nodes(spark):
    rows = [(1, "https://h.io/x/y", HTML), (2, "https://h.io/", ""), (3, None, None)]
    return PR.with_nodes(spark.createDataFrame(rows, "page_id long, url string, html string"))


def test_links_in_containers(nodes):
    got = [(r.page_id, r.tag, r.href, r.url) for r in PR.container_links(nodes).orderBy("page_id", "pos").collect()]
    assert got == [(1, "a", "a.pdf", "https://h.io/x/a.pdf"), (1, "a", "/d.pdf", "https://h.io/d.pdf"),
                   (1, "embed", "e.pdf", "https://h.io/x/e.pdf"), (1, "embed", "Video.mp4", "https://h.io/x/Video.mp4")]


def test_titles_and_next_links(nodes):
    one = nodes.where("page_id = 1")
    titles = one.select(F.transform(F.filter("nodes", lambda n: n["tag"] == "a"), lambda n: PR.link_title(n, "none")).alias("t")).first().t
    assert titles == ["outside", "T 1", "b", "c", "D d", "none", "3"]
    n = PR.next_link_containing(F.col("nodes"))
    assert one.select(PR.attr(n, "href").alias("h")).first().h == "/p2"
    assert nodes.where("page_id = 2").select(PR.attr(n, "href").alias("h")).first().h is None


def test_path_parts_and_resolved_results(spark, nodes):
    rows = [("HOMEworks x", "/a"), ("x", "/article/1"), ("x", "/Homeworks"), (None, "/product"), (None, None)]
    got = spark.createDataFrame(rows, "t string, h string").select(P.keyword_or_part_match(F.col("t"), F.col("h"), "homeworks").alias("m"))
    assert [r.m for r in got.collect()] == [True, True, False, True, False]
    res = PR.resolve_results(PR.extract_results(nodes, "li", "result-item", title_tags=("a",)))
    assert [(r.title, r.link, r.doc_link) for r in res.collect()] == [("D d", "https://h.io/d.pdf", "https://h.io/d.pdf")]
    none = PR.resolve_results(PR.extract_results(nodes, "embed", None))
    assert {r.doc_link for r in none.collect()} == {None}

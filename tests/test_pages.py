"""Page operators on invented pages (example.com)."""

from pyspark.sql import functions as F

from quarry.operators import crawl as C
from quarry.operators import pages as P

HTML = (
    '<html lang="en"><head><title> A &amp; B </title><script>var t="</p>";</script></head><body>'
    '<a href="/x.pdf">One</a><a href="/y.PDF">Two</a><a href="x.pdf?y">Three</a>'
    '<a href="VIDEO/1">V</a><div>Search results</div><a href="/after">THE Next</a>'
    '<a href="/uml">ÜBER</a><p><b>first<br><p>  </p><p>second &amp; more</p></body></html>'
)


def page_df(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, status int")


def test_link_predicates_differ(spark):
    p = page_df(spark, [(1, "https://example.com/a/", HTML, 200)])
    links = {r["href"]: r for r in P.explode_links(p).select(
        "href", P.href_contains(F.col("href"), ".pdf").alias("c"),
        P.href_endswith(F.col("href"), ".pdf").alias("e"),
        P.href_endswith_or_word(F.col("href"), ".pdf", "video").alias("w")).collect()}
    assert (links["/x.pdf"]["c"], links["/x.pdf"]["e"], links["/x.pdf"]["w"]) == (True, True, True)
    assert (links["/y.PDF"]["c"], links["/y.PDF"]["e"], links["/y.PDF"]["w"]) == (False, False, False)
    assert (links["x.pdf?y"]["c"], links["x.pdf?y"]["e"]) == (True, False)
    assert (links["VIDEO/1"]["c"], links["VIDEO/1"]["w"]) == (False, True)


def test_gate_drops_login_and_blocked(spark):
    p = page_df(spark, [(1, "https://example.com/LogonForm", HTML, 200),
                        (2, "https://example.com/ok", HTML, 401),
                        (3, "https://example.com/ok", HTML, 403),
                        (4, "https://example.com/ok", HTML, 200)])
    assert [r[0] for r in P.passed(P.as_pages(p)).select("page_id").collect()] == [4]


def test_title_paragraphs_and_script_text(spark):
    p = page_df(spark, [(1, "https://example.com/", HTML, 200),
                        (2, "https://example.com/", "<html><body><p>" + "x" * 1500 + "</p></body></html>", 200),
                        (3, "https://example.com/", "<html><body>no paragraphs</body></html>", 200)])
    t = {r[0]: r[1] for r in P.with_title(p).select("page_id", "title").collect()}
    assert t[1] == "A & B" and t[3] == "Untitled"
    txt = {r[0]: r[1] for r in P.paragraph_text(p).collect()}
    assert txt[1] == "first second & more"
    assert len(txt[2]) == 1000
    assert txt[3] == "No description available"
    rows = P.paragraph_rows(p.where("page_id = 1")).collect()
    assert [(r["pos"], r["text"]) for r in rows] == [(1, "first"), (3, "second & more")]


def test_keyword_folding_is_ascii_only(spark):
    p = page_df(spark, [(1, "https://example.com/", HTML, 200)])
    hits = P.explode_links(p).where(P.keyword_match(F.col("text"), F.col("href"), "next"))
    assert [r["href"] for r in hits.collect()] == ["/after"]
    # 'Ü' is not folded by translate(), so 'über' does not match the text;
    none = P.explode_links(p).where(P.keyword_match(F.col("text"), F.lit(""), "über"))
    assert none.count() == 0


def test_next_page_and_counts(spark):
    p = page_df(spark, [(1, "https://example.com/a/", HTML, 200)])
    assert P.next_page(p, "the next").first()["next_url"] == "https://example.com/after"
    c = P.link_counts(p, ".pdf").first()
    assert (c["n_links"], c["n_doc_links"]) == (6, 2)
    assert P.first_n_links(p, 2).count() == 2


def test_bfs_terminates_on_cycles_and_limits_depth(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(7)] + [(7, 0), (3, 1)], "src long, dst long")
    seeds = spark.createDataFrame([(0,)], "node long")
    got = {r["node"]: r["depth"] for r in C.bfs(seeds, edges, max_depth=5).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5}


def test_page_cap_depth_limit_and_selector_union(spark):
    from quarry.operators import parse as PR
    p = page_df(spark, [(i, "https://example.com/", HTML, 200) for i in range(8)])
    assert [r[0] for r in P.first_pages(p, 5).select("page_id").collect()] == [0, 1, 2, 3, 4]
    d = spark.createDataFrame([(1, 5), (2, 6), (3, None)], "page_id long, depth int")
    assert sorted(r[0] for r in P.within_depth(d).collect()) == [1, 3]
    n = PR.with_nodes(p.limit(1))
    sel = n.select(F.transform(PR.select_any(F.col("nodes"), lambda x: x["tag"] == "title",
                                             lambda x: x["tag"] == "a", lambda x: x["tag"] == "title"),
                               lambda x: x["tag"]).alias("t")).first()["t"]
    assert sel == ["title", "a", "a", "a", "a", "a", "a"]


CARDS = ('<html><body><div class="attachment-description"><a href="/d/x%20y.pdf"> Manual X </a>'
         '<div class="attachment-usage">Install Guide</div></div>'
         '<div class="attachment-description"><a href="/d/z.pdf">Z</a></div>'
         '<div class="attachment-description"><div class="attachment-usage">Only cat</div></div>'
         '<div>12 results</div><p>intro <a href="/a1">A1</a></p><a href="/a2">A2</a><p>after a2</p>'
         '<embed src="/v.mp4"><script>var t="</p>";</script></body></html>')


def test_cards_results_marker_and_snippets(spark):
    from quarry.operators import parse as PR
    p = spark.createDataFrame([(1, "https://example.com/s", CARDS)], "page_id long, url string, html string")
    good, bad = PR.split_cards(PR.extract_cards(p))
    g = good.collect()
    assert [(r["href"], r["product"], r["category"]) for r in g] == [("/d/x%20y.pdf", "Manual X", "Install Guide")]
    assert sorted(r["reason"] for r in bad.collect()) == ["no_category", "no_link"]
    assert [r["href"] for r in PR.links_after_marker(p).collect()] == ["/a1", "/a2"]
    snip = {r["title"]: r["snippet"] for r in PR.link_snippet(p).collect()}
    assert snip["A1"] == "intro A1" and snip["A2"] == "after a2"
    n = PR.with_nodes(p).select(PR.links_and_embeds(F.col("nodes")).alias("t")).first()["t"]
    assert n == ["/d/x%20y.pdf", "/d/z.pdf", "/a1", "/a2", "/v.mp4"]


def test_next_link_by_class_text_or_aria(spark):
    from quarry.operators import parse as PR
    html = ('<html><body><a href="/1">1</a><a class="next" href="/c">&raquo;</a>'
            '<a aria-label="Next" href="/aria">&gt;</a><a href="/t">Next</a></body></html>')
    p = spark.createDataFrame([(1, "https://example.com/", html)], "page_id long, url string, html string")
    n = PR.with_nodes(p).select(PR.next_link_by_label(F.col("nodes"), "next")["attrs"]["href"].alias("h")).first()
    assert n["h"] == "/c"


def test_node_tables_come_some_pages_at_a_time(spark, monkeypatch):
    import pyarrow as pa

    from quarry.operators import parse as PR
    pages = [CARDS, None, "", "plain", CARDS * 3] * 20
    monkeypatch.setattr(PR, "CHUNK_CHARS", len(CARDS) * 4)
    chunks = list(PR.node_chunks(pa.array(pages)))
    assert max(map(len, chunks)) <= 5 < len(chunks)
    got = [row for chunk in chunks for row in chunk.to_pylist(maps_as_pydicts="strict")]
    assert got == [PR.parse_nodes(p) for p in pages]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string").coalesce(1)
    assert [(r.page_id, r.nodes and len(r.nodes)) for r in PR.with_nodes(df).select("page_id", "nodes").collect()] == [(k, g and len(g)) for k, g in enumerate(got)]

"""Column functions against their Python definitions (property tests)."""

from urllib.parse import urljoin

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions import url as U

WS = list(T.WHITESPACE)
TEXT = st.text(alphabet=st.sampled_from(WS + list("ab é𝄞x.-")), max_size=12)


def one_col(spark, values, exprs):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return df.select("s", *exprs).collect()


@settings(max_examples=1, deadline=None)
@given(st.lists(TEXT, min_size=30, max_size=30))
def test_strip_split_token_truncate_match_python(spark, values):
    rows = one_col(spark, values, [
        T.ustrip("s").alias("st"), T.word_count("s").alias("wc"), T.first_token("s").alias("ft"),
        T.truncate("s", 5).alias("t5"), T.was_truncated("s", 5).alias("w5"),
    ])
    for r in rows:
        s = r["s"]
        assert r["st"] == s.strip()
        assert r["wc"] == len(s.split())
        assert r["ft"] == (s.split()[0] if s.split() else "unknown")
        assert r["t5"] == s[:5]
        assert r["w5"] == (len(s) > 5)


def test_truncation_boundaries_and_supplementary_char(spark):
    n = 4
    vals = ["abc", "abcd", "abcde", "ab𝄞de"]
    rows = one_col(spark, vals, [T.truncate("s", n).alias("t"), T.was_truncated("s", n).alias("w")])
    got = {r["s"]: (r["t"], r["w"]) for r in rows}
    assert got["abc"] == ("abc", False)
    assert got["abcd"] == ("abcd", False)
    assert got["abcde"] == ("abcd", True)
    assert got["ab𝄞de"] == ("ab𝄞d", True)  # code points, not UTF-16 units


def test_word_gate_99_100_101(spark):
    vals = [" ".join(["w"] * n) for n in (99, 100, 101)]
    rows = one_col(spark, vals, [T.word_gate("s").alias("g")])
    got = sorted((len(r["s"].split()), r["g"]) for r in rows)
    assert got[0][1] == vals[0]
    assert got[1][1] == "" and got[2][1] == ""


def test_or_default_vs_get_default(spark):
    rows = one_col(spark, ["", None, "x"], [T.or_default("s", "d").alias("o"),
                                            T.with_default("s", "d").alias("g")])
    got = {r["s"]: (r["o"], r["g"]) for r in rows}
    assert got[""] == ("d", "")
    assert got[None] == ("d", "d")
    assert got["x"] == ("x", "x")


def test_concat_fields_keeps_separator_for_null(spark):
    df = spark.createDataFrame([("a", None, "c")], "a string, b string, c string")
    assert df.select(T.concat_fields("a", "b", "c")).first()[0] == "a  c"


HREFS = ["http://other.org/x", "//cdn.example.com/p", "/p/q", "p", "../p", "./p/../q", "?q=1",
         "#f", "", "a/b/../../c", "../../../x", "g;x?y#s", "https:rel", "http:rel", "g//h", "g/",
         "/a/./b/../c", "/../x", ".", "..", "./", "../", "mailto:x@example.com", "javascript:void(0)",
         "g?y/./x", "g#s/../x", "HTTP://Upper.example.com/A", "//h2.example.com/a/../b", "a/./b/."]
BASES = ["http://a.example.com/b/c/d;p?q#frag", "https://h.example.org", "http://h/x/",
         "https://h.example.net/en/825?page=2&ref=x", "http://h.example.com/b//c/d", "relative/base",
         "http://h.example.com/a/b/"]


def test_resolve_url_equals_urljoin(spark):
    pairs = [(b, h) for b in BASES for h in HREFS] + [(BASES[0], None), ("", "x/y")]
    df = spark.createDataFrame(pairs, "base string, href string")
    bad = []
    for r in U.with_resolved(df, "base", "href", "r").collect():
        expect = None if r["href"] is None else urljoin(r["base"], r["href"])
        if r["r"] != expect:
            bad.append((r["base"], r["href"], r["r"], expect))
    assert not bad, bad


def test_url_stem_keeps_percent_escapes(spark):
    df = spark.createDataFrame([("/a/b%20c.pdf",), ("x.pdf?y",), ("/a/",)], "h string")
    got = [r[0] for r in df.select(U.url_stem(F.col("h"))).collect()]
    assert got == ["b%20c", "x?y", ""]


def test_canonical_url(spark):
    df = spark.createDataFrame([("HTTP://Ex.COM/a/b/?utm_source=x&b=2&a=1#frag",), ("http://ex.com",)], "u string")
    got = [r[0] for r in df.select(U.canonical_url(F.col("u"))).collect()]
    assert got == ["http://ex.com/a/b?a=1&b=2", "http://ex.com/"]


def test_unescape_once(spark):
    df = spark.createDataFrame([("&amp;lt; &lt;b&gt; &quot;x&quot;",)], "s string")
    assert df.select(T.unescape_basic("s")).first()[0] == '&lt; <b> "x"'


def test_resolve_url_random_references(spark):
    import random
    rnd = random.Random(7)
    parts = ["a", "b", ".", "..", "", "c.pdf", "%20x", "é"]

    def rpath(n):
        return "/".join(rnd.choice(parts) for _ in range(n))

    hrefs = set()
    for _ in range(1500):
        k, p = rnd.random(), rpath(rnd.randint(0, 5))
        if k < 0.2:
            p = "/" + p
        elif k < 0.3:
            p = "//h.example.com/" + p
        elif k < 0.35:
            p = "http:" + p
        elif k < 0.4:
            p = "//" + p
        if rnd.random() < 0.2:
            p += "?q=" + rnd.choice(parts)
        if rnd.random() < 0.1:
            p += "#f" + rnd.choice(parts)
        hrefs.add(p)
    pairs = [(b, h) for b in BASES[:5] for h in sorted(hrefs)]
    df = spark.createDataFrame(pairs, "base string, href string")
    bad = [(r["base"], r["href"], r["r"]) for r in U.with_resolved(df, "base", "href", "r").collect()
           if r["r"] != urljoin(r["base"], r["href"])]
    assert not bad, bad[:5]

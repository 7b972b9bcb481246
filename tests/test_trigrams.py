"""Trigram search against a test of every row with every keyword."""

import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import retrieve as RT
from quarry.operators import trigrams as TG


def table(seed, n):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcé🙂 -", k=r.randrange(1, 6)))
    rows = [(k, r.choice(["x", "y", None]), None if r.random() < 0.1 else " ".join(word() for _ in range(r.randrange(12)))) for k in range(n)]
    asked = [(k, r.choice(["x", "y", "z", None]), "".join(r.choices("ABcÉ🙂 -", k=r.randrange(6)))) for k in range(80)] + [(200, "x", None)]
    return rows, asked


@pytest.mark.parametrize("widths", [(1, 2), (4, 256)])
@pytest.mark.parametrize("branded", [True, False])
def test_first_match_against_every_pair(spark, monkeypatch, widths, branded):
    monkeypatch.setattr(TG, "WIDTHS", widths)
    monkeypatch.setattr(TG, "BLOCK", 7)
    monkeypatch.setattr(TG, "SENT_GRAMS", 5 if branded else 1000)
    rows, asked = table(len(widths) + branded + widths[0], 120)
    df = spark.createDataFrame(rows, "id long, brand string, body string").repartition(3)
    queries = spark.createDataFrame([(q, b, w) for q, b, w in asked], "query_id long, brand string, keyword string")
    queries = queries if branded else queries.drop("brand")
    got = {r.query_id: r.match_id for r in RT.keyword_first_match(df, queries, "body", "id", "brand" if branded else None).collect()}
    want = {q: min((i for i, b, t in rows if t is not None and (not branded or b is not None and b == brand) and (w or "").lower() in t.lower()), default=None) for q, brand, w in asked}
    assert got == want and any(want.values())


def test_candidates_hold_the_two_rarest_trigrams(spark):
    rows = [(k, "b", f"abcd {k}") for k in range(50)] + [(100, "b", "xbcd abc"), (101, "b", "abc xyz bcd"), (102, "c", "abcd")]
    df = spark.createDataFrame(rows, "match_id long, brand string, low string")
    words = spark.createDataFrame([("b", "xbcd"), ("b", "nope"), ("c", "abcd")], "brand string, kw string")
    hits, every = TG.first_hits(df, words)
    assert sorted(tuple(r) for r in hits.collect()) == [("b", "xbcd", 100), ("c", "abcd", 102)]
    assert sorted(tuple(r) for r in every.select("kw", "match_id", "n_postings").collect()) == [("abcd", 102, 1), ("xbcd", 100, 1)]


def test_text_grams():
    one = lambda s: sum(ord(c) << (21 * k) for k, c in enumerate(s))
    assert TG.text_grams("abab🙂").tolist() == sorted({one("aba"), one("bab"), one("ab🙂")})
    assert TG.text_grams("ab").tolist() == []


def test_plans_have_no_constant_key(spark):
    df = spark.createDataFrame([(1, "", "abc")], "match_id long, brand string, low string")
    grams = TG.with_grams(df.select("brand", F.col("low").alias("kw"), "low"), "low")
    plan = TG.candidates(TG.postings(df), grams)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("sent", [0, 1000])
def test_lists_are_never_sent_whole(spark, workdir, monkeypatch, sent):
    """Lists of many rows are small files: their size must not have them broadcast."""
    monkeypatch.setattr(TG, "SENT_ROWS", sent, raising=False)
    df = spark.range(20_000).select(F.col("id").alias("match_id"), F.lit("").alias("brand"), F.lit("abcd").alias("low"))
    grams = TG.with_grams(spark.createDataFrame([("", "abcd", "abcd")], "brand string, kw string, low string"), "low")
    TG.postings(df).write.parquet(f"{workdir}/lists")
    found = TG.candidates(spark.read.parquet(f"{workdir}/lists"), grams)
    assert found.count() == 20_000
    joins = [x for x in found._jdf.queryExecution().sparkPlan().toString().split("\n") if "Join" in x and "match_id" in x]
    assert joins and all("SortMergeJoin" in x for x in joins)

"""Operators and pipeline stages on small tables with awkward rows."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quarry.llm import bpe, classifier, components, dedup, lm, neardup, packing, queries, rules, tokens, topk, urls

PATH = queries.tokenizer()
SF = "/root/testdata/sf0.001"
CLASH = ["n_tokens", "score", "kept", "class_id", "host", "sequence_id", "block", "label", "words"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH)


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    vocabulary = ["".join(random.Random(f"{seed % 3}{k}").choice("etaoinshrdlu") for _ in range(3 + k % 6)) for k in range(400)]
    return "\n".join(" ".join(r.choices(vocabulary, k=12)) for _ in range(n // 12))


def edited(text: str, seed: int, every: int) -> str:
    words, r = text.split(" "), random.Random(seed)
    for k in range(r.randrange(every), len(words), every):
        words[k] = f"new{seed}x{k}"
    return " ".join(words)


@pytest.fixture(scope="module")
def texts():
    base = {k: prose(k, 360) for k in range(1, 13)}
    passage = prose(99, 72)
    out = [(0, None), (20, ""), (21, " \n\t "), (22, ""), *base.items()]
    out += [(30, base[3]), (31, base[3].upper()), (32, edited(base[4], 1, 15)), (33, edited(base[4], 2, 20)), (34, base[5] + "\n" + passage), (35, passage + "\n" + base[6][:900])]
    out += [(40, prose(41, 30_000)), (41, "x" * 3000), (42, "é" * 40 + passage[:60] + "🙂"), (43, "short"), (44, "short"), (45, "!!*** " * 40)]
    return out + [(7, base[7]), (34, dict(out)[34])]  # repeated rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", ["a", "b", None][i % 3], len(t or ""), *["clash"] * len(CLASH)) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def by_id(df):
    return sorted(tuple(r) for r in df.collect())


def test_token_counts(docs, empty, texts):
    own = Tokenizer.from_file(PATH)
    want = [(i, len((t or "").encode()), len(own.encode(t or "", add_special_tokens=False).ids)) for i, t in texts]
    got = tokens.token_counts(docs, PATH)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert by_id(got) == sorted((*w, w[2] > 1024) for w in want)
    assert tokens.token_counts(empty, PATH).collect() == []


def test_bpe(docs, empty, texts):
    own = Tokenizer.from_file(PATH)
    want = []
    for i, t in texts:
        ids = own.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert by_id(bpe.encode_digests(docs, PATH)) == sorted(want)
    assert by_id(bpe.encode_table(docs, PATH).select("doc_id", "decoded")) == sorted((i, t or "") for i, t in texts)
    assert bpe.encode_digests(empty, PATH).collect() == []


def test_packing(docs, empty, texts):
    own = Tokenizer.from_file(PATH)
    want = sorted((i, np.array([*own.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()) for i, t in texts)
    rows = packing.pack(docs, PATH, with_ids=True).collect()
    whole, sequences = {}, {}
    for r in rows:
        assert r.length == len(r.ids) // 4 and r.ids_crc32 == zlib.crc32(r.ids)
        whole.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, ids in dict(want).items():
        copies = sum(1 for x in want if x[0] == i)
        pieces = sorted(whole[i])[::copies]
        assert b"".join(p for _, p in pieces) == ids and len(whole[i]) == copies * len(pieces)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(len(x) // 4 for _, x in want)
    assert len(sequences) <= 1.05 * total / 1024 + 1
    assert packing.pack(empty, PATH).collect() == []


def test_near_duplicates(docs, empty, texts):
    got = {r.doc_id: r for r in neardup.near_duplicates(docs).collect()}
    assert len(got) == len({i for i, _ in texts})
    classes = {i: r.class_id for i, r in got.items()}
    assert classes[30] == classes[31] == classes[3] == 3 and got[31].copy_of == 3
    assert classes[32] == classes[33] == classes[4] == 4
    assert classes[20] == classes[21] == classes[22] == classes[0] == 0  # no words
    assert classes[43] == classes[44] == 43
    alone = [i for i in (1, 2, 5, 6, 8, 9, 10, 11, 12, 40, 41, 42, 45) if classes[i] != i]
    assert not alone and classes[34] in (5, 34)
    assert neardup.near_duplicates(empty).collect() == []


def test_near_duplicates_find_every_pair(spark):
    """Against all pairs on a table with copies of many degrees."""
    rows = [(k, prose(k, 240)) for k in range(40)]
    rows += [(100 + 10 * k + j, edited(rows[k][1], j, every)) for k in range(12) for j, every in enumerate((20, 30, 60, 90))]
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    words = {i: np.array([zlib.crc32(w.encode()) for w in t.split()], "<u4") for i, t in rows}
    parent = {i: i for i in words}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in words:
        for b in words:
            if a < b and neardup.is_near(words[a], words[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    assert {i: root(i) for i in words} == got


def test_near_duplicates_meet_an_original_that_is_no_centre(spark):
    """Copies that are links of the original alone, which has the highest
    doc_id and not the least hash."""
    words = prose(7, 600).split()
    ids = list(range(40))
    original = spark.range(1000, 1100).where(F.xxhash64("id") > 2**62).first()[0]
    rows = [(original, " ".join(words))]
    for k in ids:
        r, copy = random.Random(k), list(words)
        for part in r.sample(range(30), 4):  # 4 of 30 runs: 13 % of the words
            copy[20 * part:20 * part + 18] = [f"own{k}x{part}x{j}" for j in range(18)]
        rows.append((k, " ".join(copy)))
    coded = {i: np.array([zlib.crc32(w.encode()) for w in t.split()], "<u4") for i, t in rows}
    assert all(neardup.is_near(coded[original], coded[k]) for k in ids)
    assert sum(neardup.is_near(coded[k], coded[k + 1]) for k in ids[:-1]) < 10
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(got.values()) == {0}


def test_components(spark):
    edges = [("b", "a"), ("c", "b"), ("d", "c"), ("x", "y"), ("z", "z"), (None, "a"), ("b", "a")]
    got = by_id(components.components(spark.createDataFrame(edges, "a string, b string")))
    assert got == [("a", "a"), ("b", "a"), ("c", "a"), ("d", "a"), ("x", "x"), ("y", "x")]
    chain = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert components.components(chain).select("component").distinct().collect() == [(0,)]
    assert components.components(chain.where("false")).collect() == []


def brute_removed(rows):
    first = {}
    for i, t in rows:
        for s in range(len(t) - 49):
            first[t[s:s + 50]] = min(first.get(t[s:s + 50], i), i)
    out = []
    for i, t in rows:
        gone = np.zeros(len(t) + 1, bool)
        for s in range(len(t) - 49):
            if first[t[s:s + 50]] < i:
                gone[s:s + 50] = True
        kept = bytes(b for b, g in zip(t, gone, strict=False) if not g)
        out.append((i, len(t), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("hot", "block"), [(dedup.HOT, dedup.BLOCK_BYTES), (1, 4000)])
def test_suffix_dedup(docs, empty, texts, monkeypatch, hot, block):
    monkeypatch.setattr(dedup, "HOT", hot)
    monkeypatch.setattr(dedup, "BLOCK_BYTES", block)
    assert by_id(dedup.deduplicated(docs)) == brute_removed([(i, (t or "").encode()) for i, t in texts])
    assert dedup.deduplicated(empty).collect() == []


def test_rewritten_keeps_all_columns(docs, texts):
    got = dedup.rewritten(docs)
    assert got.schema.simpleString() == docs.schema.simpleString()
    rows = got.collect()
    assert len(rows) == len(texts) and all(r.kept == "clash" for r in rows)
    assert {r.doc_id: r.text for r in rows}[0] is None and {r.doc_id: r.text for r in rows}[30] == ""


def test_language_model(docs, empty, texts):
    rows = lm.score(docs, vocabulary=200, known=300).collect()
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts}
    counts: dict = {}
    words = {i: [*(t or "").encode().lower().split(), None] for i, t in texts}
    for i, _ in texts:
        for w in words[i] if not held[i] else ():
            counts[w] = counts.get(w, 0) + 1
    total, types = sum(counts.values()), len(counts)
    assert len(rows) == len(texts)
    for r in rows:
        base = sum(np.log10((counts.get(w, 0) + 1) / (total + types + 1)) for w in words[r.doc_id])
        assert r.held_out == held[r.doc_id] and r.n_tokens == len(words[r.doc_id]) and r.train_tokens == total
        assert r.n_known == sum(counts.get(w, 0) > 0 for w in words[r.doc_id])
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and r.score < 0
    assert lm.score(empty).collect() == []


def test_language_model_beats_the_base_on_held_out_texts(spark):
    row = queries.op3_lm_score(spark, SF).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert row[0] > row[1] + 0.02 * row[2]


def test_quality(docs, empty, texts, spark):
    labels = spark.createDataFrame([(i, int(i != 45)) for i, _ in texts] + [(None, 1), (3, None), (2, 7)], "doc_id long, quality int")
    rows = classifier.quality(docs, labels).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert classifier.quality(empty, labels).collect() == []
    assert {r.score for r in classifier.quality(docs, labels.where("false")).collect()} == {0.5}


def test_quality_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/../sf0.01/labels.parquet")
    scored = queries.op8_quality(spark, f"{SF}/../sf0.01").where("held_out").join(labels, "doc_id")
    right, bad, n = scored.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.avg(F.when(F.col("quality") == 1, F.col("predicted"))), F.count("*")).first()
    assert n > 50 and right > 0.9 and bad > 0.95


def test_quality_rules(docs, empty, texts, spark):
    got = {r.doc_id: r for r in rules.judge(docs).collect()}
    assert not got[0].kept and got[0].n_words == 0 and got[45].base_failed and got[1].kept and got[41].base_failed
    assert rules.judge(docs).count() == len(texts) and rules.judge(empty).collect() == []
    line, own = "menu home about contact help search login terms", [prose(k, 60) for k in range(60)]
    rows = [(k, f"{line}\n{own[k]}", "h") for k in range(59)] + [(59, f"{line}\n" * 2 + line + "\n" + " ".join(f"u{j}" for j in range(15)), "h"), (60, f"{line}\n" + own[1], None)]
    rows += [(100 + k, own[0], "copied") for k in range(70)]
    judged = {r.doc_id: r for r in rules.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert judged[0].kept and judged[0].n_removed_words == 8
    assert judged[60].n_removed_words == 0  # another host
    assert not judged[59].kept  # depleted or repetitive
    assert all(judged[100 + k].kept for k in range(70))  # copies are one document


def test_quality_rules_stage_removes_boilerplate_lines(spark):
    footer, own = "Contact  us | imprint and terms é", [prose(k, 60) for k in range(30)]
    rows = [(k, f"{own[k]}\n\n{footer}{' ' * (k % 2)}" if k % 3 else f"{footer.upper().replace('É', 'é')}\n{own[k]}\n", "en", "h", 0) for k in range(30)]
    rows += [(100, f"{own[0]}\n{footer}", "en", "other", 0), (1, f"{own[2]}\n{footer}", "en", "other", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.quality_rules(spark, docs, SF)
    assert got.schema == docs.schema
    want = [(k, f"{own[k]}\n" if k % 3 else f"{own[k]}\n", "en", "h") for k in range(30)]
    want += [(100, f"{own[0]}\n{footer}", "en", "other"), (1, f"{own[2]}\n{footer}", "en", "other")]  # not common there
    assert by_id(got) == sorted((*r, len(r[1])) for r in want)


def test_top_products_awkward_rows(spark):
    rows = [(0, [1.0, 0.5]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, []), (6, [0.0, 0.0]), (7, [0.25]), (50, [1.0, 0.5]), (50, [1.0, 0.5]), (8, [-1.0, 0.001])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = by_id(topk.top_products(df))
    clean = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in (0, 50):
        best = sorted(((-sum(a * b for a, b in zip(clean[q], v, strict=False)), i) for i, v in clean.items() if i != q))[:5]
        want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert got == want and topk.top_products(df.where("false")).collect() == []


PAGES = [(1, "http://a.example.org/x", "no"), (2, "https://b.example.org/y#f", '<LINK href="http://w.net/a?x=1&amp;y=2" rel="canonical">'),
         (3, "http://c.example.org/fr/z", "<meta http-equiv='refresh' content='0; url=http://b.example.org/y'>"), (4, "https://B.example.org/q", "<meta http-equiv=refresh content='0; url=https://b.example.org/y'>"),
         (5, None, '<link rel=canonical href="http://w.net/a">'), (6, "nourl", None), (7, "http://example.net/en/1", '<link rel="canonical" href="http://w.net/a">'), (8, "http://example.net", "x"),
         (9, "http://Example.com/de/1?a", "x"), (10, "http://l.org/1", "<META HTTP-EQUIV='Refresh' CONTENT=\"3;URL='https://b.example.org/q'\">"), (10, "http://l.org/1", None), (11, "", "")]


def test_url_filters(spark):
    df = spark.createDataFrame([(*r, "x") for r in PAGES], "page_id long, url string, html string, verdict string")
    got = by_id(urls.filter_urls(df, queries.URL_RULES))
    verdicts = {r[0]: r[4] for r in got}
    assert len(got) == len(PAGES)
    assert {i for i, v in verdicts.items() if v == "block"} == {2, 4, 9, 10}
    assert [r for r in got if r[0] in (5, 6, 11)] == [(i, "", "", None, "allow") for i in (5, 6, 11)]
    con = duckdb.connect()
    con.register("pages", df.select("page_id", "url", "html").toPandas())
    key = lambda rows: sorted(tuple(str(x) for x in r) for r in rows)
    assert key(con.sql(queries.ORACLE["op9_url_filters"]).fetchall()) == key(got)
    more = spark.createDataFrame([("http://a.example.org/x", "http://z.net/"), (None, "b")], "from_url string, to_url string")
    assert {r[0]: r[4] for r in by_id(urls.filter_urls(df, queries.URL_RULES, more))}[1] == "block"
    assert urls.filter_urls(df.where("false"), queries.URL_RULES).collect() == []
    assert "Python" not in urls.filter_urls(df, queries.URL_RULES)._jdf.queryExecution().toString()


@pytest.mark.parametrize("stage", range(5))
def test_stages(spark, docs, empty, stage, texts):
    run = corpus_pipeline.STAGES[stage][1]
    got = run(spark, docs, SF)
    assert run(spark, empty, SF).collect() == []
    if stage < 4:
        assert got.schema.simpleString() == docs.schema.simpleString()
    ids = sorted(r.doc_id for r in got.select("doc_id").distinct().collect())
    if stage == 0:
        assert {1, 2, 3, 40} <= set(ids) and not {0, 20, 21, 22, 43, 45} & set(ids)
    if stage == 2:
        assert got.count() == len(ids) and {3, 4} <= set(ids) and not {30, 31, 32, 33, 44} & set(ids)
    if stage == 3:
        left = {r.doc_id: r for r in got.collect()}
        assert left[30].text == "" and left[3].text == dict(texts)[3] and left[35].n_chars == len(left[35].text) < len(dict(texts)[35])


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "minhash_near_dedup", "suffix_array_dedup", "packing"]
    rows = corpus_pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "sequence_id", "offset"] and rows.count() > 100
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows.collect())


@pytest.mark.parametrize("key", sorted(queries.QUERIES))
def test_queries_have_a_stable_schema(spark, key):
    df = queries.QUERIES[key](spark, SF)
    assert df.count() > 0 and "doc_id" in df.columns or {"vec_id", "page_id"} & set(df.columns)

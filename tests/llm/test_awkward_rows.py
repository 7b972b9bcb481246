"""Short and empty texts, null ids and hot groups for operators 2, 4, 5 and 9."""

import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import dedup, neardup, packing, queries, units, urls
from quarry.llm.common import Chunk
from tests.llm.test_operators import brute_removed, by_id, edited, prose

PATH = queries.tokenizer()
KIND = "doc_id long, text string"


def chunk_of(texts):
    raw = [t.encode() for t in texts]
    return Chunk(np.arange(len(raw)), np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))


# --- operator 5

@pytest.mark.parametrize("block", [1, 60, 1 << 20])
def test_suffix_dedup_of_short_texts(spark, monkeypatch, block):
    monkeypatch.setattr(dedup, "BLOCK_BYTES", block)
    rows = [(k, "short" * (k % 3)) for k in range(9)]
    assert by_id(dedup.deduplicated(spark.createDataFrame(rows, KIND).repartition(5))) == brute_removed([(i, t.encode()) for i, t in rows])
    assert len(dedup.Block(np.array([3]), np.array([0, 5]), np.frombuffer(b"short", np.uint8), 1).asked()[0]) == 0
    line = prose(3, 24)
    rows += [(100, line), (101, "x" + line), (102, None)]
    assert by_id(dedup.deduplicated(spark.createDataFrame(rows, KIND).repartition(4))) == brute_removed([(i, (t or "").encode()) for i, t in rows])


def test_suffix_dedup_of_one_empty_text_a_partition(spark):
    df = spark.range(4, numPartitions=4).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))
    assert by_id(dedup.deduplicated(df)) == brute_removed([(i, b"") for i in range(4)])
    assert dedup.rewritten(df).count() == 4


def test_suffix_dedup_with_null_ids(spark):
    line = prose(5, 48)
    df = spark.createDataFrame([(None, line), (1, line), (2, line + " more"), (None, line), (-(1 << 63), "z")], KIND)
    got = {(r.doc_id, r.n_bytes): r.n_removed for r in dedup.deduplicated(df).collect()}
    assert got == {(None, len(line)): 0, (1, len(line)): 0, (2, len(line) + 5): len(line), (-(1 << 63), 1): 0}
    assert sorted(r.text for r in dedup.rewritten(df).where("doc_id IS NULL").collect()) == [line, line]


# --- operator 4

def test_packing_with_null_ids(spark):
    own = Tokenizer.from_file(PATH)
    big = (1 << 60) + 1
    rows = [(None, "one two"), (big, prose(1, 2400)), (None, None), (7, "")]
    got = packing.pack(spark.createDataFrame(rows, KIND), PATH, with_ids=True).collect()
    assert {r.doc_id for r in got} == {None, big, 7}
    parts = sorted((r.start, bytes(r.ids)) for r in got if r.doc_id == big)
    assert b"".join(p for _, p in parts) == np.array([*own.encode(rows[1][1], add_special_tokens=False).ids, 0], "<u4").tobytes()
    assert sorted(r.doc_tokens for r in got if r.doc_id is None) == [1, 1 + len(own.encode("one two").ids)]
    assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) and r.length == len(r.ids) // 4 for r in got)


LETTERS = [*"ab Z\n\t.,!?;:'é×÷ßÿ12#<|", " ", "　", " ", " ", "\x85", "<|endoftext|>", "語", "🙂", "Ü", " 's", " a"]


def test_unit_starts_are_the_patterns():
    r = random.Random(3)
    for _ in range(3000):
        text = "".join(r.choices(LETTERS, k=r.randrange(30)))
        raw = np.frombuffer(text.encode(), np.uint8)
        want = np.cumsum([0, *(len(u.encode()) for u in units.UNITS.findall(text))])[:-1]
        assert units.unit_starts(raw, np.array([0, len(raw)])).tolist() == want.tolist()


def test_bulk_ids_are_the_librarys():
    r = random.Random(4)
    own = Tokenizer.from_file(PATH)
    encode = packing.load(PATH)
    texts = ["".join(r.choices(LETTERS, k=r.randrange(30))) for _ in range(4000)] + ["", "", "x" * 3000, "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endof", "text|>"]
    ids, off = encode(chunk_of(texts))
    for k, t in enumerate(texts):
        assert ids[off[k]:off[k + 1]].tolist() == own.encode(t, add_special_tokens=False).ids
    whole = "".join(texts)
    memo = units.BulkMemo(lambda part: [np.array(x.ids, "<u4").tobytes() for x in own.encode_batch(part, add_special_tokens=False)], {"<|endoftext|>": own.token_to_id("<|endoftext|>").to_bytes(4, "little")}, limit=50)
    for most in (20, 1000):  # one text, read in parts
        assert memo.ids(chunk_of([whole]), most)[0].tolist() == own.encode(whole, add_special_tokens=False).ids


# --- operator 2

def test_near_duplicates_with_null_ids(spark):
    text = prose(2, 120)
    got = neardup.near_duplicates(spark.createDataFrame([(None, text), (5, text), (3, text), (None, None)], KIND)).collect()
    assert sorted((r.doc_id or 0, r.class_id, r.copy_of, r.n_words) for r in got if r.doc_id) == [(3, 3, 3, 120), (5, 3, 3, 120)]
    assert sorted(r.n_words for r in got if r.doc_id is None) == [0, 120] and all(r.class_id is None for r in got if r.doc_id is None)


def test_parities_never_rule_out_a_near_pair():
    r = random.Random(8)
    count = lambda x: int(np.bitwise_count(x).sum())
    for _ in range(200):
        a = [r.choice("abcdefgh" if r.random() < 0.3 else ["w%d" % r.randrange(500)]) for _ in range(r.randrange(1, 400))]
        b, edits = list(a), r.randrange(0, 80)
        for _ in range(edits):
            at = r.randrange(len(b) + 1)
            b[at:at + r.randrange(2)] = [r.choice(["new", "a", "w3"])] * r.randrange(2)
        hashes = [np.array([zlib.crc32(w.encode()) * 0x9E3779B97F4A7C15 % (1 << 64) for w in x], np.uint64) for x in (a, b)]
        p = [neardup.parities(h, np.zeros(len(h), np.int64), 1) for h in hashes]
        distance = neardup.banded_distance(hashes[0], hashes[1], 1000) if a and b else max(len(a), len(b))
        assert count(p[0] ^ p[1]) + abs(len(a) - len(b)) <= 2 * distance


def test_unlike_texts_around_one_passage_are_not_aligned(spark, monkeypatch):
    """600 texts that share a third of their words: few pairs are aligned;
    the copies among them are found."""
    passage = prose(77, 60)
    unlike = [(k, " ".join([*(f"u{k}x{j}" for j in range(60)), passage, *(f"v{k}x{j}" for j in range(60))])) for k in range(600)]
    copies = [(10_000 + k, edited(unlike[k][1], k, 30)) for k in range(0, 600, 50)]
    seen = []
    real = neardup.verified

    def counting(pairs, *more):
        seen.append(pairs.count())
        return real(pairs, *more)

    monkeypatch.setattr(neardup, "verified", counting)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark.createDataFrame(unlike + copies, KIND)).collect()}
    assert got == {k: k for k, _ in unlike} | {10_000 + k: k for k in range(0, 600, 50)}
    assert sum(seen) < 6 * len(got)  # all pairs are 187,000


# --- operator 9

def test_every_canonical_and_refresh_element_counts(spark):
    two = '<link rel=canonical href="http://b.io/">' + '<LINK href="http://c.net/x" rel="canonical">'
    pages = [(1, "http://a.io/1", two), (2, "http://d.io/1", "<meta http-equiv=refresh content='1;url=http://e.io/'><meta http-equiv=refresh content='0; url=http://f.net/'>"),
             (3, "http://b.io/", None), (4, "http://e.io/", ""), (5, "http://g.io/", "<link rel=canonical href='http://h.io/'> <link rel=stylesheet href='http://c.net/x'>"), (6, "http://i.io/", "<link rel=canonical href=http://j.net/")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = by_id(urls.filter_urls(df, queries.URL_RULES))
    assert {r[0] for r in got if r[4] == "block"} == {1, 2, 3, 4, 6}
    con = duckdb.connect()
    con.register("pages", df.where("page_id < 6").toPandas())  # its patterns read closed elements
    want = con.sql(queries.ORACLE["op9_url_filters"]).fetchall()
    assert sorted(map(str, want)) == sorted(str(r) for r in got if r[0] < 6)


def test_members_meet_centres_once_where_the_bounds_leave_room():
    """Against all pairs: lengths, classes, parities, the first shared bucket."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    n = 60
    near = rng.integers(0, 4000, 80).astype(np.uint64)
    texts = []
    for _ in range(n):
        t = near.copy()
        t[rng.choice(80, rng.integers(0, 20), replace=False)] = rng.integers(5000, 9000, 1)[0]
        texts.append(t[:rng.integers(50, 81)])
    bits = np.concatenate([neardup.parities(t, np.zeros(len(t), np.int64), 1) for t in texts])
    places = {k: sorted(rng.choice(4, rng.integers(1, 5), replace=False).tolist()) for k in range(n)}
    leads = {k: [b for b in places[k] if rng.random() < 0.4] for k in range(n)}
    classes = rng.integers(0, 20, n)

    def table(rows, **more):
        own = {"doc_id": rows, "n_words": [len(texts[k]) for k in rows], "class_id": [int(classes[k]) for k in rows],
               "parity": [bits[k].view(np.int64).tolist() for k in rows]}
        return pa.table(own | more)

    got = []
    for b in range(4):
        members, centres = [k for k in range(n) if b in places[k]], [k for k in range(n) if b in leads[k]]
        own = table(members, bucket=[b] * len(members), inside=[places[k] for k in members], centre=[b in leads[k] for k in members])
        led = table(centres, leads=[leads[k] for k in centres])
        for part in (own.slice(0, 7), own.slice(7)):
            out = neardup.meeting(0.8)(part, led)
            got += zip(out.column("a").to_pylist(), out.column("b").to_pylist(), strict=True)
    want = set()
    for i in range(n):
        for j in range(i):
            a, b = len(texts[i]), len(texts[j])
            flips = sum(int(x).bit_count() for x in bits[i] ^ bits[j])
            meet = set(places[i]) & set(leads[j]) or set(places[j]) & set(leads[i])
            if meet and classes[i] != classes[j] and min(a, b) >= 0.8 * max(a, b) - 1e-6 and flips + abs(a - b) <= 2 * int(0.2 * max(a, b) + 1e-9):
                want.add((i, j))
    assert set(got) == want and len(want) > 20
    assert len(got) <= 2 * len(want)

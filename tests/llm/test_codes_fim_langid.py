"""Operators 11 to 13 against plain versions, with awkward rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from quarry.llm import codes, fim, langid, queries
from quarry.llm.common import Chunk

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, label string, code string, error string, piece string"


def chunk_of(texts):
    raw = [t.encode() for t in texts]
    return Chunk(np.arange(len(raw)), np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))


# --- operator 11

def plain_codes(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error, digest) of ``rows`` (vec_id, vector, label) in Python's integers."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0], r[1]))
    whole = [[int(np.floor(4096 * np.float64(x))) for x in r[1]] for r in rows]
    width = len(whole[0]) // parts
    code, error, flat = [""] * len(rows), [0] * len(rows), []
    for p in range(parts):
        own = [v[p * width:(p + 1) * width] for v in whole]
        book = [list(x) for x in own[:entries]]
        near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))  # noqa: B023, E731
        for _ in range(rounds):
            of = [near(x)[1] for x in own]
            book = [[sum(c) // len(c) for c in zip(*(x for x, o in zip(own, of) if o == k))] or e for k, e in enumerate(book)]
        for i, x in enumerate(own):
            d, k = near(x)
            code[i], error[i] = code[i] + f"{k:02x}", error[i] + d
        flat += [x for e in book for x in e]
    total = defaultdict(int)
    for r, e in zip(rows, error):
        total[r[2]] += e
    sha = hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()
    top = (1 << 63) - 1
    lost = {r[2] for r, e in zip(rows, error) if e > top} | {k for k, t in total.items() if t > top}
    return sorted(((r[0], c, e if e <= top else None, None if r[2] in lost else total[r[2]], sha) for r, c, e in zip(rows, code, error)), key=str)


def vectors(n, dims, seed=0, spread=1.0):
    r = np.random.default_rng(seed)
    return [(int(i), (np.round(r.normal(size=dims) * 4) / 4 * spread).tolist(), ["a", "b", None][i % 3]) for i in r.permutation(n)]


@pytest.mark.parametrize("spread", [1.0, 1e5])
def test_codes_against_plain_rounds(spark, monkeypatch, spread):
    """Shared prefixes, several blocks and slices; 64 bits don't hold the products of the second."""
    monkeypatch.setattr(codes, "SLICE", 7)
    monkeypatch.setattr(codes, "BLOCK_VALUES", 24 * 16)
    rows = vectors(150, 24, spread=spread)
    rows += [(1000 + k, list(rows[5][1]), "a") for k in range(30)] + [(rows[7][0], rows[8][1], "b")]  # copies; a repeated vec_id
    rows += [(None, rows[9][1], None)]
    bad = [(2000, None, "a"), (2001, [], "a"), (2002, [None] * 24, "a"), (2003, [float("nan")] * 24, "a"), (2004, [float("inf")] * 24, "b"), (2005, [1.0] * 8, "b"), (2006, [1.0] * 23, None), (-1, [2.0 ** 50] * 24, "a")]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows + bad], VECTORS).repartition(3)
    got = sorted((tuple(r) for r in codes.codes(df).collect()), key=str)
    assert got == plain_codes(rows)


def test_codes_of_few_rows(spark):
    rows = vectors(5, 8)
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], VECTORS)
    assert sorted((tuple(r) for r in codes.codes(df).collect()), key=str) == plain_codes(rows)
    none = codes.codes(df.where("false"))
    assert none.collect() == [] and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    unlabelled = codes.codes(df.select("vec_id", "embedding")).collect()
    assert {r.label_error for r in unlabelled} == {sum(r.error for r in unlabelled)}


def test_error_beyond_a_long_is_null(spark):
    r = random.Random(1)
    rows = [(i, [r.choice((-1, 1)) * 1e12 * r.random() for _ in range(8)], "a") for i in range(40)]
    want = plain_codes(rows)
    got = sorted((tuple(x) for x in codes.codes(spark.createDataFrame([(*x, "x", "y", "z") for x in rows], VECTORS)).collect()), key=str)
    assert got == want and {g[3] for g in got} == {None} and None in {g[2] for g in got}


@pytest.mark.parametrize("slice_", [1, 3, 1000])
def test_walk_against_all_distances(monkeypatch, slice_):
    monkeypatch.setattr(codes, "SLICE", slice_)
    r = np.random.default_rng(3)
    part = r.integers(-2, 3, (400, 5))
    values, counts, which = codes.distinct_parts(part)
    assert counts.sum() == 400 and (values[which] == part).all()
    assert [tuple(x) for x in values.tolist()] == sorted(set(map(tuple, part.tolist())))
    entries = r.integers(-3, 4, (16, 5))
    best, distance = codes.nearest(values, entries)
    every = ((values[:, None] - entries[None]) ** 2).sum(2)
    assert (best == every.argmin(1)).all() and (distance == every.min(1)).all()


# --- operator 12

def plain_fim(i, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return i, len(text), "plain", None, None, sha(text), sha(text)
    form = "spm" if h4 % 100 < 20 else "psm"
    out = f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}" if form == "spm" else f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"
    return i, len(text), form, a, b - a, sha(out), sha(text)


@pytest.fixture(scope="module")
def awkward():
    r = random.Random(5)
    alphabet = "ab <>PSM\n\té🙂語" + "́"
    rows = [(i, "".join(r.choices(alphabet, k=r.randrange(60)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "<P>"), (1003, "x<M>y"), (1004, "<<S"), (None, "no id at all"), (None, None)]
    return rows + [(1005, "é🙂" * 400_000 + "end"), (1006, "a" * fim.BLOCK), (1007, "語" * fim.BLOCK), (7, rows[7][1])]


def test_fill_in_middle(spark, awkward):
    df = spark.createDataFrame([(i, t, "n", "f") for i, t in awkward], "doc_id long, text string, output string, form string").repartition(3)
    got = sorted((tuple(r) for r in fim.digests(df).collect()), key=str)
    assert got == sorted((plain_fim(i, t) for i, t in awkward), key=str)
    assert {g[2] for g in got} == {"plain", "psm", "spm"}
    assert fim.digests(df.where("false")).collect() == []


@pytest.mark.parametrize("unit", list(fim.UNITS))
def test_cuts_fall_between_units(spark, awkward, unit):
    rows = [r for r in awkward if r[0] is not None]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = fim.transformed(df, unit=unit)
    text = dict(rows)
    for r in made.select("*", fim.restored(made.output, made.form).alias("back")).collect():
        whole = text[r.doc_id] or ""
        assert r.back == whole
        buf = np.frombuffer(whole.encode(), np.uint8)
        starts = fim.UNITS[unit](buf)
        starts[:1] = True
        assert r.n == starts.sum()
        if r.form != "plain":
            for cut in (r.prefix_chars, r.prefix_chars + r.middle_chars):
                at = len(whole[:cut].encode())
                assert at == len(buf) or starts[at]


def test_fenwick_descent():
    r = np.random.default_rng(0)
    for size in (1, 2, 3, 8, 13, 64, 100):
        counts = r.integers(0, 4, (2, size))
        tree, total = fim.Fenwick(counts), np.concatenate([[0], np.cumsum(counts[0])])
        for k in range(int(total[-1])):
            leaf, (units, others) = tree.before(k)
            assert total[leaf] <= k < total[leaf + 1]
            assert units == total[leaf] and others == counts[1, :leaf].sum()


# --- operator 13

def plain_counts(text):
    symbols, letters = langid.symbol_tables()
    line = [langid.SEPARATOR]
    for c in [int(symbols[ord(x)]) for x in text] + [langid.SEPARATOR]:
        if c != langid.SEPARATOR or line[-1] != langid.SEPARATOR:
            line.append(c)
    grams = [tuple(line[k:k + n]) for n in (1, 2, 3) for k in range(len(line) - n + 1)]
    grams = [g for g in grams if langid.SEPARATOR not in g[1:-1] and set(g) != {langid.SEPARATOR}]
    out = defaultdict(int)
    for g in grams:
        code = sum(c << (21 * k) for k, c in enumerate(g))
        out[int(langid.mix64(np.array([code], np.uint64) + np.uint64(0x9E3779B97F4A7C15))[0] >> np.uint64(64 - langid.BITS))] += 1
    return dict(out), bool(letters[[ord(x) for x in text]].any()) if text else False


def test_grams_against_plain_python(monkeypatch):
    r = random.Random(2)
    texts = ["".join(r.choices("abÉß .,-9\néI語é", k=r.randrange(40))) for _ in range(60)] + ["", "", "...", "x", " x", "9"]
    doc, slot, count, lettered = langid.counted(chunk_of(texts))
    got = defaultdict(dict)
    for d, s, c in zip(doc.tolist(), slot.tolist(), count.tolist()):
        got[d][s] = c
    want = [plain_counts(t) for t in texts]
    assert [got[k] for k in range(len(texts))] == [w[0] for w in want] and lettered.tolist() == [w[1] for w in want]
    monkeypatch.setattr(langid, "CHUNK_BYTES", 5)  # one text in pieces
    for t in texts:
        if len(t.encode()) > 10:
            _, slot, count, lettered = langid.counted(chunk_of([t]))
            assert (dict(zip(slot.tolist(), count.tolist())), bool(lettered[0])) == plain_counts(t)


def test_updates_against_plain_ftrl():
    model, r = langid.Ftrl(6, 3), np.random.default_rng(1)
    z, n = [[0.0] * 3 for _ in range(6)], [[0.0] * 3 for _ in range(6)]

    def weight(i, c):
        if abs(z[i][c]) <= langid.L1:
            return 0.0
        return -(z[i][c] - np.sign(z[i][c]) * langid.L1) / ((langid.BETA + n[i][c] ** 0.5) / langid.ALPHA + langid.L2)

    for _ in range(40):
        at, x, label = r.choice(6, 3, replace=False), r.random(3), int(r.integers(3))
        model.update(at, x, label)
        w = [[weight(i, c) for c in range(3)] for i in at]
        e = np.exp([sum(w[k][c] * x[k] for k in range(3)) for c in range(3)])
        for k, i in enumerate(at):
            for c in range(3):
                g = x[k] * (e[c] / e.sum() - (c == label))
                z[i][c] += g - ((n[i][c] + g * g) ** 0.5 - n[i][c] ** 0.5) / langid.ALPHA * w[k][c]
                n[i][c] += g * g
    assert np.allclose(model.weights(slice(None)), [[weight(i, c) for c in range(3)] for i in range(6)])


def test_calibration_finds_the_temperature():
    r = np.random.default_rng(4)
    logits = r.normal(size=(20_000, 4)) * 3
    p = langid.softmax(logits / 2.5)
    labels = (p.cumsum(1) > r.random((len(p), 1))).argmax(1)
    assert abs(langid.calibrated(logits, labels) - 2.5) < 0.15
    assert langid.calibrated(logits[:0], labels[:0]) == 1.0
    assert langid.calibrated(np.eye(4) * 9, np.arange(4)) > 0.5  # rows that are all right don't make it certain


def test_document_frequencies(spark):
    rows = [(1, "aa ab"), (2, "ab"), (3, ""), (4, "...")]
    n, got = langid.document_frequencies(spark.createDataFrame(rows, "doc_id long, text string").repartition(2))
    want = defaultdict(int)
    for _, t in rows:
        for s in plain_counts(t)[0]:
            want[s] += 1
    assert n == 4 and {k: int(got[k]) for k in np.flatnonzero(got)} == dict(want)


def test_held_out_accuracy(spark):
    rows = queries.op13_language_id(spark, SF).collect()
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    assert len(rows) == len(truth) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_awkward_rows(spark):
    base = [(i, f"{'the and of with' if i % 2 else 'der und von mit'} {i}", ["de", "en"][i % 2]) for i in range(40)]
    odd = [(100, None, "de"), (101, "", "en"), (102, "12 34 !!", "en"), (103, "the", None), (None, "der und", "xx"), (104, "Der und " * 300_000, None), (1, "the and of with 1", "en")]
    df = spark.createDataFrame([(*r, "s", "l") for r in base + odd], "doc_id long, text string, lang string, score string, lang_pred string").repartition(3)
    got = {(r.doc_id): r for r in langid.languages(df).collect()}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (100, 101, 102))
    assert got[103].lang_pred == "en" and got[104].lang_pred == "de" and got[None].lang_pred == "de" and got[None].held_out is False
    assert all(got[i].lang_pred == lang for i, _, lang in base)
    none = langid.languages(df.where("lang IS NULL")).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert langid.languages(df.where("false")).collect() == []


@pytest.mark.parametrize("key", ["op11_vector_codes", "op12_fill_in_middle"])
def test_queries_equal_their_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[key](spark, SF)
    want = con.execute(queries.ORACLE[key])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted((tuple(r) for r in df.select(*names).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_sample_is_bounded_and_has_every_language(spark):
    rows = [(i, "x", "big") for i in range(3000)] + [(5000 + i, "y", "small") for i in range(30)] + [(5000, "y", "small")]
    got = [r.doc_id for r in langid.sampled(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4), 400).collect()]
    assert len(got) == len(set(got)) <= 400 and len([i for i in got if i >= 5000]) == 30 and 140 < len([i for i in got if i < 5000]) < 260

"""Parts of the operators that need no session."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quarry.llm import bpe, classifier, dedup, lm, neardup, packing, rules, suffixes, tokens, topk
from quarry.llm.common import Chunk, chunks, safe_pieces, span_hashes, word_spans

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  \n\n a  b", "x<|endoftext|> y  <|endoftext|>", "日本語のテキスト" * 50, "a" * 5000, "ab" * 3000, "\x1c!!\x1d \x85  x", "don't I'll'm",
       "1234567890" * 300, "é" * 3000, "the" * 2000, "�🙂🙂" * 400, "    " * 900, "Well, yes. No_. *. x's. (a), ²! ½? 3.5",
       "  x ", "".join(random.Random(1).choice("etaoinshr") for _ in range(9000))]


def chunk(*texts: str | None) -> Chunk:
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    return next(chunks(batch, 1 << 30))[2]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_chunks_cover_all_rows_and_nulls():
    batch = pa.record_batch([pa.array(range(5), pa.int64()), pa.array(["ab", None, "x" * 50, "", "ü"], pa.string())], ["doc_id", "text"]).slice(1)
    got = [(a, b, c.ids.tolist(), [c.bytes_of(k) for k in range(c.n)]) for a, b, c in chunks(batch, 10)]
    assert [i for _, _, ids, _ in got for i in ids] == [1, 2, 3, 4]
    assert [t for *_, texts in got for t in texts] == [b"", b"x" * 50, b"", "ü".encode()]


def test_words_never_cross_documents():
    c = chunk("ab", "c d", None, " e")
    starts, ends, doc = word_spans(c.buf, c.off)
    assert [c.buf[a:b].tobytes() for a, b in zip(starts, ends, strict=True)] == [b"ab", b"c", b"d", b"e"]
    assert doc.tolist() == [0, 1, 1, 3]


def test_safe_pieces_encode_as_the_whole(library):
    for text in ODD:
        pieces = list(safe_pieces(text, 40))
        assert "".join(pieces) == text
        assert [i for p in pieces for i in library.encode(p, add_special_tokens=False).ids] == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_counts_are_the_librarys(name):
    own = Tokenizer.from_file(public_tokenizers.path(name))
    assert list(tokens.load(public_tokenizers.path(name))(ODD)) == [len(own.encode(t, add_special_tokens=False).ids) for t in ODD]


def test_token_counts_of_a_sentencepiece_model():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    own = sentencepiece.SentencePieceProcessor(model_file=path)
    assert list(tokens.load(path)(ODD)) == [len(own.encode(t)) for t in ODD]


def test_encoder_and_decoder_are_the_librarys(library):
    encoder = bpe.Encoder(PATH)
    for text, ids in zip(ODD, encoder.encode(ODD), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        n, _, decoded = bpe.digests(encoder, ids)
        assert (n, decoded) == (len(want), hashlib.sha256(library.decode(want, skip_special_tokens=False).encode()).hexdigest())


def test_transducer_emits_only_stable_tokens(library):
    merges = bpe.load(PATH).merges
    assert merges.lookahead < 1000
    text = "".join(random.Random(2).choice(["th", "e", "in", "g", "a", "aa", "ou"]) for _ in range(4000))
    for step in (1, 7, 1000):
        machine, got = bpe.Transducer(merges), []
        data = text.encode()
        for at in range(0, len(data), step):
            for ids in machine.feed(data[at:at + step]):
                got += ids.tolist()
            assert len(machine.held) <= merges.window
        assert got + machine.close().tolist() == library.encode(text, add_special_tokens=False).ids


def test_lookahead_of_a_small_merge_list():
    """Every boundary further left than the lookahead stays, whatever follows."""
    vocab = {c: k for k, c in enumerate(bpe.byte_letters())}
    pairs = [("a", "b"), ("b", "a"), ("ab", "ab"), ("a", "a"), ("ba", "ab"), ("aa", "b")]
    for a, b in pairs:
        vocab.setdefault(a + b, len(vocab))
    merges, r = bpe.Merges(vocab, pairs), random.Random(3)
    for _ in range(300):
        text = bytes(r.choice(b"ab") for _ in range(30))
        ends = [set(np.cumsum(merges.length[merges.merge([text + more])[0]]).tolist()) for more in (b"", b"a", b"b", b"ab", b"ba", b"bb")]
        for other in ends[1:]:
            assert {e for e in ends[0] if e <= len(text) - merges.lookahead} == {e for e in other if e <= len(text) - merges.lookahead}


def test_decoder_keeps_open_characters():
    encoder = bpe.load(PATH)
    decoder, text = bpe.Decoder(encoder.pieces), "é🙂ß�"
    ids = np.frombuffer(next(encoder.encode([text])), "<u4").tolist()
    assert "".join(decoder.feed([i]) for i in ids) + decoder.close() == text


def test_packing_fills_windows_without_overlap():
    r = np.random.default_rng(5)
    for lengths in (r.integers(1, 1024, 3000), np.full(100, 700), np.array([1]), np.array([512, 512, 1023, 1]), np.zeros(0, np.int64)):
        number, offset = packing.pack_lengths(lengths)
        for k in range(int(number.max(initial=-1)) + 1):
            rows = np.flatnonzero(number == k)
            rows = rows[np.argsort(offset[rows])]
            assert (offset[rows] == np.cumsum(lengths[rows]) - lengths[rows]).all() and 0 < lengths[rows].sum() <= 1024
    total = np.bincount(packing.pack_lengths(r.integers(1, 1024, 20000))[0])
    assert len(total)


def test_subset_sums_against_all_multisets():
    r = random.Random(6)
    for _ in range(200):
        counts = {r.randint(1, 12): r.randint(1, 3) for _ in range(3)}
        capacity = r.randint(1, 40)
        sums = {0}
        for x, n in counts.items():
            sums = {s + x * k for s in sums for k in range(n + 1) if s + x * k <= capacity}
        best, steps, _ = packing.fill(counts, capacity)
        used = packing.walk_back(steps, best)
        assert best == max(sums) == sum(x * n for x, n in used.items()) and all(n <= counts[x] for x, n in used.items())


def test_suffix_arrays_and_prefixes():
    r = random.Random(7)
    for _ in range(200):
        letters = r.choice([b"ab", b"a", b"abcd", bytes(range(256))])
        texts = [bytes(r.choice(letters) for _ in range(r.randint(0, 30))) for _ in range(r.randint(1, 8))]
        t, _ = suffixes.symbols(texts)
        depth = r.choice([8, 16, 50])
        order = suffixes.suffix_array(t, depth)
        padded = np.concatenate([t, np.zeros(depth, t.dtype)])
        heads = [tuple(padded[i:i + depth]) for i in order]
        assert sorted(order.tolist()) == list(range(len(t))) and heads == sorted(heads)
        for k, got in enumerate(suffixes.common_prefixes(t, order, depth).tolist()[1:], 1):
            x, y, n = order[k - 1], order[k], 0
            while n < depth and t[x + n] == t[y + n] != 0:
                n += 1
            assert n == got


def test_edit_distance_and_similarity():
    r = random.Random(8)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    for _ in range(600):
        v = r.choice([3, 30, 1000])
        a = [r.randrange(v) for _ in range(r.randint(0, 60))]
        b = list(a)
        for _ in range(r.randint(0, max(1, len(a) // 3))):
            at, what = r.randrange(len(b) + 1), r.random()
            if what < 0.4 and at < len(b):
                b[at] = r.randrange(v)
            elif what < 0.7:
                b.insert(at, r.randrange(v))
            elif at < len(b):
                del b[at]
        x, y, d = np.array(a, "<u4"), np.array(b, "<u4"), distance(a, b)
        assert neardup.is_near(x, y) == (d <= int(0.2 * max(len(a), len(b)) + 1e-9))
        assert [neardup.banded_distance(x, y, w) for w in (1, 5, 70)] == [min(d, w + 1) for w in (1, 5, 70)]


def test_sketches_follow_order():
    words = [f"w{k}" for k in range(200)]
    turned = words[100:] + words[:100]
    x = neardup.sketches(chunk(" ".join(words), " ".join(words).upper(), " ".join(turned), "", "one two", "one  two "))
    assert (x["sketches"][0] == x["sketches"][1]).all() and x["h1"][0] == x["h1"][1] != x["h1"][2]
    same = (x["sketches"][0] == x["sketches"][2]).sum()
    assert 0 < same < neardup.SKETCHES  # k-mers are shared, their order only in part
    assert (x["sketches"][4] == x["sketches"][5]).all() and not x["sketches"][3].any()


def test_rule_measures_against_plain_python():
    word, r = re.compile(r"[^\x20\x09-\x0D]+"), random.Random(9)
    texts = ["", "\n\n", "a a\na a\n a a", "x " * 30, None] + ["".join(r.choice(["a ", "b ", "é\n", "c# ", "a b c d e f g h ", "\t\n"]) for _ in range(r.randint(0, 80))) for _ in range(60)]
    x = rules.measure(chunk(*texts))
    for k, text in enumerate(t or "" for t in texts):
        words = word.findall(text)
        seen = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
        covered = {i + j for i in range(len(words) - 7) if seen[tuple(words[i:i + 8])] > 1 for j in range(8)}
        lines = [line for line in text.split("\n") if word.search(line)]
        want = (len(words), sum(map(len, words)), sum(c in rules.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered), len({tuple(word.findall(line.lower())) for line in lines}))
        assert tuple(int(x[n][k]) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lines_of")) == want


def test_ftrl_learns_a_token():
    texts = [("good word " * 5, 1) if k % 2 else ("bad*** word!! " * 5, 0) for k in range(60)]
    doc, slot, value = classifier.features(chunk(*(t for t, _ in texts)))
    model, cut = classifier.Ftrl(1 << classifier.BITS), np.searchsorted(doc, np.arange(61))
    for _ in range(3):
        for k, (_, y) in enumerate(texts):
            model.update(slot[cut[k]:cut[k + 1]], value[cut[k]:cut[k + 1]], y)
    total = [model.weights(slot[a:b]) @ value[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
    assert all((t > 0) == (y == 1) for t, (_, y) in zip(total, texts, strict=True))


def test_network_gradients_and_lanes():
    counts = np.array([50, 40, 30, 9, 8, 7, 6, 5, 4, 3, 2, 1])
    shape = lm.Shape(counts, 20.0)
    r = np.random.default_rng(1)
    p = {k: r.standard_normal(v.shape).astype(np.float64) * 0.3 for k, v in shape.start().items()}
    inputs, targets, lanes = np.array([13, 1, 2, 3, 13, 4, 5]), np.array([1, 2, 3, 0, 4, 5, 0]), lm.Lanes(np.array([4, 3]), 2)
    lanes.order = np.array([0, 1])

    def loss():
        return lm.Network(shape, p).run(inputs, targets, lanes, False).sum()

    got = {}

    class Seen(lm.Network):
        def _step(self, name, rows, g):
            full = np.zeros_like(self.p[name])
            full[rows] = g
            got[name] = full * np.sqrt(len(targets))

    Seen(shape, p).run(inputs, targets, lanes, True)
    for name in p:
        for at in [tuple(r.integers(0, s) for s in p[name].shape) for _ in range(6)]:
            keep, h = p[name][at], 1e-4
            p[name][at] = keep + h
            up = loss()
            p[name][at] = keep - h
            slope = (up - loss()) / (2 * h)
            p[name][at] = keep
            assert abs(slope + got[name][at]) < 2e-3 * max(1, abs(slope)), (name, at, slope, got[name][at])


def test_probabilities_sum_to_one():
    counts = np.arange(40, 0, -1)
    shape = lm.Shape(counts, 7.0)
    p = shape.start()
    p["word_w"] += np.random.default_rng(2).standard_normal(p["word_w"].shape).astype(np.float32)
    n = shape.n + 1
    lanes = lm.Lanes(np.full(n, 2), n)
    inputs = np.tile([shape.n + 1, 3], n)
    targets = np.stack([np.full(n, 3), np.arange(n)], 1).ravel()
    lp = lm.Network(shape, p).run(inputs, targets, lanes, False).reshape(n, 2)[:, 1]
    assert abs(np.exp(lp).sum() - 1) < 1e-4


def test_state_is_carried_across_windows():
    """Scores don't depend on the lanes or on what else is scored."""
    shape = lm.Shape(np.arange(30, 0, -1), 5.0)
    words = lm.Words([b"%d" % k for k in range(30)], shape.counts, shape)
    p = shape.start()
    r = np.random.default_rng(3)
    p["class_w"] += r.standard_normal(p["class_w"].shape).astype(np.float32)
    texts = [b" ".join(b"%d" % r.integers(0, 33) for _ in range(n)) for n in (0, 100, 3, 41, 7)]
    ids, lengths, _ = words.read(texts)
    together = words.run(lm.Network(shape, p), ids, lengths, 2, False)
    alone = np.concatenate([words.run(lm.Network(shape, p), *words.read([t])[:2], 1, False) for t in texts])
    assert np.allclose(together, alone, atol=1e-4)


@pytest.mark.parametrize("kind", ["even", "skewed", "copies", "zeros"])
def test_search_against_all_products(kind):
    r = np.random.default_rng(4)
    v = r.integers(-200, 200, (3000, 16))
    if kind == "skewed":
        v = (v * r.lognormal(0, 1.5, 3000)[:, None]).astype(np.int64)
    if kind == "copies":
        v = np.repeat(v[:300], 10, 0)
    if kind == "zeros":
        v[:] = 0
    ids, ask = r.permutation(3000), np.arange(0, 3000, 50)
    row, one, score, _ = topk.search(v[ask], ids[ask], v, ids, 5)
    products = v[ask] @ v.T
    for k in range(len(ask)):
        best = [j for j in np.lexsort((ids, -products[k])) if ids[j] != ids[ask[k]]][:5]
        assert one[row == k].tolist() == ids[best].tolist() and score[row == k].tolist() == products[k][best].tolist()


def test_large_components_stay_exact():
    v = np.array([[1 << 29, 1], [1 << 29, 2], [3, 1 << 29]])
    _, one, score, _ = topk.search(v[:1], np.array([0]), v, np.arange(3), 2)
    assert one.tolist() == [1, 2] and score.tolist() == [(1 << 58) + 2, (3 << 29) + (1 << 29)]
    with pytest.raises(ValueError):
        topk.Products(np.array([[1 << 40]]))


def test_anchors_depend_on_windows_alone():
    r = random.Random(10)
    shared = bytes(r.choice(b"abcdefgh ") for _ in range(120))
    texts = [bytes(r.choice(b"abcdefgh ") for _ in range(200)) + shared + b"zz", b"q" + shared + bytes(r.choice(b"xyz") for _ in range(90)), b"a" * 200, b"x" * 49, b""]
    off = np.cumsum([0, *map(len, texts)])
    at, h = dedup.anchors(np.frombuffer(b"".join(texts), np.uint8), off)
    doc = np.searchsorted(off, at, side="right") - 1
    assert (at + dedup.K <= off[doc + 1]).all() and not np.isin(doc, [3, 4]).any()
    places = {x: [set((at[doc == x] - off[x]).tolist())][0] for x in (0, 1)}
    for s in range(len(shared) - dedup.LENGTH + 1):  # each window of the passage has the same anchors in both
        inside = [sorted(p - b - s for p in places[x] if b + s <= p <= b + s + dedup.SIDE) for x, b in ((0, 200), (1, 1))]
        assert set(inside[0]) & set(inside[1])


def test_pack_and_unpack():
    x = np.array([0, 1, 255, 1 << 39, (1 << 40) - 1], np.uint64)
    assert dedup.unpack(dedup.pack(x, 5), 5).tolist() == x.tolist()


def test_span_hashes_tell_lengths_apart():
    x = np.zeros(4, np.uint8)
    assert len(set(span_hashes(x, np.zeros(4, np.int64), np.arange(1, 5)).tolist())) == 4

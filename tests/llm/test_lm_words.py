"""Words of a chunk of texts are found and looked up in Arrow."""

import random

import numpy as np

from quarry.llm import lm


def test_words_of_many_texts_are_pythons():
    r = random.Random(4)
    texts = ["".join(r.choice(["é", "Ä", "A", "b", "Z", " ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x85", "\xa0", "\x00"]) for _ in range(r.randrange(12))).encode() for _ in range(500)]
    texts += [b"", b"  ", b" a", b"a ", b"\n"]
    words, sizes = lm.words_of(texts)
    want = [t.lower().split() for t in texts]
    assert words.to_pylist() == [w for t in want for w in t] and sizes.tolist() == [len(t) for t in want]
    assert [len(x) for x in lm.words_of([])] == [0, 0]


def test_ids_ends_and_unknown_words():
    shape = lm.Shape(np.array([9, 5]), 3.0)
    words = lm.Words([lm.END, b"a", b"b"], np.array([9, 5, 2]), shape)
    ids, lengths, unknown = words.read([b"A x b", b"", b" y\ta", b"b"])
    assert ids.tolist() == [1, -1, 2, 0, 0, -1, 1, 0, 2, 0] and lengths.tolist() == [4, 1, 3, 2]
    assert unknown.to_pylist() == [[b"x"], [], [b"y"], []]

"""Operator 7: byte-pair encoding and decoding as a streaming transducer.

``Merges`` holds a public tokenizer's merge list as arrays and computes
from it the sufficient lookahead: how many bytes to the right of a token's
end can at most decide whether the token stands.  The argument: let two
texts agree up to some point.  A difference to the right moves left past a
symbol u only when a rule (u, v) applies in one derivation and not in the
other, and the next such rule (u', v') has u at the left edge of v' and a
higher rank, for a symbol is made before it is used.  The longest such
chain of rules, weighted by the lengths of their left parts, bounds the
way (``lookahead``).

``Transducer`` reads bytes of one pattern match of any length, keeps a
window of bounded size, and emits every token that ends at least
``lookahead`` bytes before the window's end; the rest waits.  Matches that
fit into a window, nearly all, are closed at once; those of a chunk are
merged together, vectorised over words (all words take their lowest-ranked
pair in the same step).  ``Decoder`` turns ids into text, holding the
unfinished bytes of one character at most.

Null and empty texts have no tokens and decode to the empty text; special
tokens' strings in a text are the special token, as in the library's
default; repeated rows are encoded each; further columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.common import CHUNK_BYTES, WHITE, chunks, texts_of
from quarry.llm.units import UnitMemo

NONE = np.int64(1 << 40)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies:
    printable bytes are themselves, the others take code points from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    at = {b: b for b in printable} | {b: 256 + k for k, b in enumerate(rest)}
    return [chr(at[b]) for b in range(256)]


def byte_pattern() -> str:
    """The byte-level split pattern with its white space spelled out."""
    s, o = f"[{WHITE}]", rf"[^{WHITE}\p{{L}}\p{{N}}]"
    return rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?{o}+|{s}+(?![^{WHITE}])|{s}+"


class Merges:
    """A merge list as arrays; see the module's docstring."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        letters = byte_letters()
        back = {c: b for b, c in enumerate(letters)}
        self.bytes_of: dict[int, bytes] = {i: bytes(back[c] for c in t) for t, i in vocab.items() if all(c in back for c in t)}
        self.byte_ids = np.array([vocab.get(c, -1) for c in letters], np.int64)
        self.length = np.zeros(max(vocab.values()) + 1, np.int64)
        for i, b in self.bytes_of.items():
            self.length[i] = len(b)
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], np.int64)
        self._fill(left, right)
        self.lookahead = self._lookahead(left, right)
        #: A window holds the lookahead, a longest token, and room to emit.
        self.window = None if self.lookahead is None else 2 * (self.lookahead + int(self.length.max())) + 256

    def _fill(self, left: np.ndarray, right: np.ndarray) -> None:
        """Open addressing from pairs to ranks."""
        self.bits = max(10, int(np.ceil(np.log2(len(left) * 8 + 1))))
        keys = np.full(1 << self.bits, -1, np.int64)
        ranks = np.full(1 << self.bits, NONE, np.int64)
        pair = (left << 32) | right
        slots = self._slot(pair)
        mask, self.probes = (1 << self.bits) - 1, 1
        for rank, (key, slot) in enumerate(zip(pair.tolist(), slots.tolist(), strict=True)):
            probe = 0
            while keys[(slot + probe) & mask] not in (-1, key):
                probe += 1
            at = (slot + probe) & mask
            if keys[at] == -1:
                keys[at], ranks[at] = key, rank
            self.probes = max(self.probes, probe + 1)
        self.keys, self.ranks = keys, ranks

    def _slot(self, pair: np.ndarray) -> np.ndarray:
        x = (pair ^ (pair >> 29)).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (x >> np.uint64(64 - self.bits)).view(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; NONE where a pair has no rule."""
        pair = (left << 32) | right
        slot = self._slot(pair)
        out = np.where(self.keys[slot] == pair, self.ranks[slot], NONE)
        todo = np.flatnonzero((self.keys[slot] != pair) & (self.keys[slot] != -1))
        for probe in range(1, self.probes):
            if not len(todo):
                break
            at = (slot[todo] + probe) & ((1 << self.bits) - 1)
            same, free = self.keys[at] == pair[todo], self.keys[at] == -1
            out[todo[same]] = self.ranks[at[same]]
            todo = todo[~same & ~free]
        return out

    def _lookahead(self, left: np.ndarray, right: np.ndarray) -> int | None:
        """The longest chain; None where some rule comes before its parts."""
        made = {int(i): -1 for i in self.byte_ids}
        first: dict[int, int] = {}
        for rank, (a, b, c) in enumerate(zip(left.tolist(), right.tolist(), self.made.tolist(), strict=True)):
            if a not in made or b not in made:
                return None
            if c not in made:
                made[c], first[c] = rank, a
        reach = np.zeros(len(self.length), np.int64)  # by symbol: the longest chain of later rules with it at their left edge
        most = 0
        for a, b in zip(left[::-1].tolist(), right[::-1].tolist(), strict=True):
            f = int(self.length[a] + reach[a])
            most = max(most, f)
            edge: int | None = b
            while edge is not None:
                if reach[edge] < f:
                    reach[edge] = f
                edge = first.get(edge)
        return most

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, flat, and the number of ids of each word."""
        counts = np.fromiter(map(len, words), np.int64, len(words))
        symbols = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), counts)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            ranks = np.full(len(symbols), NONE, np.int64)
            ranks[:-1] = np.where(owner[1:] == owner[:-1], self.rank(symbols[:-1], symbols[1:]), NONE)
            new = np.ones(len(symbols), bool)
            new[1:] = owner[1:] != owner[:-1]
            starts = np.flatnonzero(new)
            least = np.minimum.reduceat(ranks, starts)
            size = np.diff(np.append(starts, len(symbols)))
            at_least = np.repeat(least, size)
            over = at_least == NONE
            if over.any():
                done.append((owner[over], symbols[over]))
                keep = ~over
                symbols, owner, ranks, at_least = symbols[keep], owner[keep], ranks[keep], at_least[keep]
                if not len(symbols):
                    break
            hit = ranks == at_least
            if (hit[1:] & hit[:-1]).any():  # x x x: pairs are taken from the left
                where = np.flatnonzero(hit)
                run = np.ones(len(where), bool)
                run[1:] = np.diff(where) != 1
                begin = np.flatnonzero(run)
                nth = np.arange(len(where)) - np.repeat(begin, np.diff(np.append(begin, len(where))))
                hit[where[nth % 2 == 1]] = False
            where = np.flatnonzero(hit)
            symbols[where] = self.made[ranks[where]]
            keep = np.ones(len(symbols), bool)
            keep[where + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        if not done:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        owners = np.concatenate([x[0] for x in done])
        order = np.argsort(owners, kind="stable")
        return np.concatenate([x[1] for x in done])[order], np.bincount(owners, minlength=len(words))


class Transducer:
    """Bytes of one pattern match in, ids out as soon as they are stable."""

    def __init__(self, merges: Merges, window: int | None = None):
        self.merges, self.held = merges, b""
        self.window = window or merges.window

    def feed(self, data: bytes) -> Iterator[np.ndarray]:
        at, look = 0, self.merges.lookahead
        while at < len(data):
            room = len(data) - at if self.window is None else self.window - len(self.held)
            self.held += data[at:at + room]
            at += room
            if self.window is not None and len(self.held) == self.window:
                ids, _ = self.merges.merge([self.held])
                ends = np.cumsum(self.merges.length[ids])
                stable = int(np.searchsorted(ends, self.window - look, side="right"))
                self.held = self.held[ends[stable - 1] if stable else 0:]
                yield ids[:stable]

    def close(self) -> np.ndarray:
        ids, _ = self.merges.merge([self.held])
        self.held = b""
        return ids


class Encoder:
    """A byte-level tokenizer file's encoder and decoder."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.merges = Merges(spec["model"]["vocab"], pairs)
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.pieces = self.merges.bytes_of | {i: t.encode() for t, i in special.items()}
        self.pattern = regex.compile(byte_pattern())
        self.words: dict[str, bytes] = {}
        self.memo = UnitMemo(self.encode_units, self.stream, {t: i.to_bytes(4, "little") for t, i in special.items()}, b"".join)

    def stream(self, text: str) -> Iterator[bytes]:
        """Ids of a text without special tokens, emitted as they get stable."""
        for match in self.pattern.finditer(text):
            machine = Transducer(self.merges)
            word = match[0]
            for at in range(0, len(word), 4096):
                for ids in machine.feed(word[at:at + 4096].encode()):
                    yield ids.astype("<u4").tobytes()
            yield machine.close().astype("<u4").tobytes()

    def encode_units(self, units: list[str]) -> list[bytes]:
        """Ids of each of many short units; their pattern matches that no
        window must cut are merged together."""
        cut = [self.pattern.findall(u) for u in units]
        if len(self.words) > self.memo.limit:
            self.words.clear()
        new = list({w for words in cut for w in words}.difference(self.words))
        if new:
            ids, counts = self.merges.merge([w.encode() for w in new])
            flat, at = ids.astype("<u4").tobytes(), 0
            for word, n in zip(new, (4 * counts).tolist(), strict=True):
                self.words[word] = flat[at:at + n]
                at += n
        get = self.words.__getitem__
        return [b"".join(map(get, words)) for words in cut]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        return self.memo.values(texts)


class Decoder:
    """Ids in, text out; keeps the open bytes of one character."""

    def __init__(self, pieces: dict[int, bytes]):
        self.pieces = pieces
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.machine.decode(b"".join(map(self.pieces.__getitem__, ids)))

    def close(self) -> str:
        return self.machine.decode(b"", True)


_LOADED: dict[str, Encoder] = {}


def load(path: str) -> Encoder:
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


#: Ids that the decoder takes at a time.
DECODE_IDS = 1 << 14


def digests(encoder: Encoder, ids: bytes) -> tuple[int, str, str]:
    """Number of ids, SHA-256 of the ids and of the decoded text."""
    decoder, own = Decoder(encoder.pieces), hashlib.sha256()
    array = np.frombuffer(ids, "<u4")
    for at in range(0, len(array), DECODE_IDS):
        own.update(decoder.feed(array[at:at + DECODE_IDS].tolist()).encode())
    own.update(decoder.close().encode())
    return len(array), hashlib.sha256(ids).hexdigest(), own.hexdigest()


def encode_table(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit), decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(tokenizer)
        for batch in batches:
            for at, end, _ in chunks(batch):
                texts = batch.column(1).slice(at, end - at)
                ids = list(encoder.encode(texts.to_pylist()))
                plain = []
                for x in ids:
                    decoder = Decoder(encoder.pieces)
                    plain.append(decoder.feed(np.frombuffer(x, "<u4").tolist()) + decoder.close())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), pa.array(ids, pa.binary()), pa.array(plain, pa.string())], ["doc_id", "ids", "decoded"])

    return texts_of(docs).mapInArrow(run, "doc_id long, ids binary, decoded string")


def encode_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(tokenizer)
        for batch in batches:
            for at, end, _ in chunks(batch, CHUNK_BYTES):
                texts = batch.column(1).slice(at, end - at).to_pylist()
                n, own, decoded = zip(*(digests(encoder, ids) for ids in encoder.encode(texts)), strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, end - at), pa.array(n, pa.int64()), pa.array(own, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts_of(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

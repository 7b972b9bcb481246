"""A bounded memo of encoded text units, for operators 1, 4 and 7.

A unit is white space and the run that follows it, cut once more between
a word of letters and the punctuation after it.  Byte-level patterns never
carry a token over the end of a unit, so a text's ids are its units' ids
joined."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

from quarry.llm.common import WHITE, Chunk, is_space

LETTERS = r"A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
UNITS = re.compile(rf"[{WHITE}]*[{LETTERS}]+(?=[{WHITE}.,;:!?]|$)|[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: Units of a generation of a worker's memo; of the generation before, the
#: ones met again move on, the others go.
MEMO_UNITS = 500_000
#: Units longer than this are encoded by themselves and not kept.
LONG_UNIT = 64


class UnitMemo[T]:
    """What texts encode to (ids as bytes, or counts of them), through their
    units: ``join`` puts the values of a text's units together."""

    def __init__(self, encode: Callable[[list[str]], list[T]], stream: Callable[[str], Iterable[T]],
                 special: dict[str, T], join: Callable[[Iterable[T]], T], limit: int = MEMO_UNITS):
        self.encode, self.stream, self.special, self.join, self.limit = encode, stream, special, join, limit
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.known: dict[str, T] = {}
        self.older: dict[str, T] = {}

    def parts(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is a special token, part) of a text."""
        if self.split is None or not any(s in text for s in self.special):
            yield False, text
            return
        for k, part in enumerate(self.split.split(text)):
            if part:
                yield bool(k % 2), part

    def learn(self, units: set[str]) -> None:
        """Encode the units that aren't known yet, all in one call."""
        new = units.difference(self.known)
        if len(self.known) + len(new) > self.limit:
            self.older, self.known = self.known, {}
            new = units
        again = new.intersection(self.older)
        self.known.update(zip(again, map(self.older.__getitem__, again), strict=True))
        new = [u for u in new.difference(again) if len(u) <= LONG_UNIT]
        if new:
            self.known.update(zip(new, self.encode(new), strict=True))

    def values(self, texts: list[str]) -> Iterator[T]:
        """The value of each of ``texts`` (together of bounded size)."""
        cut = [[(special, part if special else UNITS.findall(part)) for special, part in self.parts(text)] for text in texts]
        units: set[str] = set()
        for parts in cut:
            for special, part in parts:
                if not special:
                    units.update(part)
        self.learn(units)
        for parts in cut:
            yield self.join(self.special[part] if special else self._joined(part) for special, part in parts)

    def _joined(self, units: list[str]) -> T:
        try:
            return self.join(map(self.known.__getitem__, units))
        except KeyError:  # some are too long to be kept
            return self.join(self.known[u] if u in self.known else self.join(self.stream(u)) for u in units)


#: The characters of WHITE beyond ASCII, as (first bytes, last bytes).
WIDE_WHITE = ((b"\xc2", b"\x85\xa0"), (b"\xe1\x9a", b"\x80"), (b"\xe2\x80", b"\x80\x81\x82\x83\x84\x85\x86\x87\x88\x89\x8a\xa8\xa9\xaf"), (b"\xe2\x81", b"\x9f"), (b"\xe3\x80", b"\x80"))
PUNCTUATION = np.frombuffer(b".,;:!?", np.uint8)


def white_bytes(buf: np.ndarray) -> np.ndarray:
    """Whether each byte is part of a white space character."""
    white = is_space(buf)
    for lead, last in WIDE_WHITE:
        hit = np.flatnonzero(buf[:len(buf) - len(lead)] == lead[0])
        for k in range(1, len(lead)):
            hit = hit[buf[hit + k] == lead[k]]
        hit = hit[np.isin(buf[hit + len(lead)], np.frombuffer(last, np.uint8))]
        for k in range(len(lead) + 1):
            white[hit + k] = True
    return white


def unit_starts(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where the units (as ``UNITS`` cuts them) of the texts begin."""
    n = len(buf)
    white = white_bytes(buf)
    start = np.zeros(n + 1, bool)
    start[1:n] = white[1:] & ~white[:-1]
    start[off] = True
    letter = ((buf | 32) >= 97) & ((buf | 32) <= 122)
    wide = np.flatnonzero(buf[:-1] == 0xC3) if n else np.zeros(0, np.int64)
    wide = wide[(buf[wide + 1] != 0x97) & (buf[wide + 1] != 0xB7)]
    letter[wide] = letter[wide + 1] = True
    # a run of other characters is cut where its letters end in punctuation
    run = np.flatnonzero(~white & np.append(True, white[:-1]) | ~white & start[:n]) if n else np.zeros(0, np.int64)
    ends = np.append(np.flatnonzero(~letter), n)
    cut = ends[np.searchsorted(ends, run)]
    cut = cut[(cut > run) & (cut < n)]
    start[cut[np.isin(buf[cut], PUNCTUATION)]] = True
    return np.flatnonzero(start[:n])


class BulkMemo:
    """Ids of the texts of a chunk: their units are numbered by Arrow's
    dictionary encoding, and only distinct ones meet the memo."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], special: dict[str, bytes], limit: int = MEMO_UNITS):
        self.encode, self.special, self.limit = encode, {s.encode(): ids for s, ids in special.items()}, limit
        self.split = re.compile(b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if special else None
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def lookup(self, units: list[bytes]) -> list[bytes]:
        """Ids of distinct units."""
        if len(self.known) + len(units) > self.limit:
            self.older, self.known = self.known, {}
        out = list(map(self.known.get, units))
        missing = [k for k, ids in enumerate(out) if ids is None]
        new = []
        for k in missing:
            out[k] = self.older.get(units[k])
            if out[k] is None:
                new.append(k)
            else:
                self.known[units[k]] = out[k]
        for k, ids in zip(new, self.encode([units[k].decode() for k in new]) if new else (), strict=True):
            out[k] = ids
            if len(units[k]) <= LONG_UNIT:
                self.known[units[k]] = ids
        return out

    def ids(self, chunk: Chunk, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, flat; where each text's begin, and their end).
        A text of more than ``most`` bytes is read in parts cut at units."""
        if chunk.n > 1 or len(chunk.buf) <= most:
            return self._ids(chunk.buf, chunk.off)
        parts, at, size = [], 0, most
        while at < len(chunk.buf):
            part = chunk.buf[at:at + size]
            if at + size < len(chunk.buf):
                last = int(unit_starts(part, np.array([0, len(part)]))[-1])
                if not last:
                    size *= 2
                    continue
                part = part[:last]
            parts.append(self._ids(part, np.array([0, len(part)]))[0])
            at, size = at + len(part), most
        ids = np.concatenate(parts)
        return ids, np.array([0, len(ids)])

    def _ids(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = unit_starts(buf, off)
        whole = buf.tobytes()
        if self.split is not None and self.split.search(whole):
            starts, special = self._special(whole, off, starts)
        else:
            special = np.zeros(0, np.int64)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        ends = pa.array(np.append(starts, len(buf)), pa.int64())
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, ends.buffers()[1], pa.py_buffer(whole)]).dictionary_encode()
        code, units = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
        found = self.lookup(units)
        flat = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        at = np.cumsum(size) - size
        if len(special):  # a special token's string is that token, in its own place alone
            ids = [self.special[units[c]] for c in code[special].tolist()]
            flat, at, size = np.append(flat, np.frombuffer(b"".join(ids), "<u4")), np.append(at, len(flat) + np.arange(len(ids))), np.append(size, np.ones(len(ids), np.int64))
            code[special] = len(units) + np.arange(len(ids))
        count = size[code]
        passed = np.append(0, np.cumsum(count))
        ids = flat[np.repeat(at[code] - passed[:-1], count) + np.arange(passed[-1])]
        return ids, passed[np.searchsorted(starts, off)]

    def _special(self, whole: bytes, off: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of units and special tokens, and which are special tokens:
        texts that hold one are cut into parts first."""
        spans = [hit.span() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True) for hit in self.split.finditer(whole, a, b)]
        if not spans:  # across two texts
            return starts, np.zeros(0, np.int64)
        edge = np.array(spans, np.int64)
        token = edge[:, 0]
        texts = np.unique(np.searchsorted(off, token, side="right") - 1)
        marked = np.zeros(len(off) - 1, bool)
        marked[texts] = True
        out = [starts[~marked[np.searchsorted(off, starts, side="right") - 1]]]
        buf = np.frombuffer(whole, np.uint8)
        for t in texts.tolist():
            a, b = int(off[t]), int(off[t + 1])
            own = edge[(token >= a) & (token < b)].ravel()
            cut = np.unique(np.concatenate([[a], own, [b]]))
            here = unit_starts(buf[a:b], cut - a) + a
            inside = np.searchsorted(own, here, side="right") % 2 == 1  # between a token's ends
            out.append(np.union1d(here[~inside], token[(token >= a) & (token < b)]))
        starts = np.sort(np.concatenate(out))
        return starts, np.searchsorted(starts, token)

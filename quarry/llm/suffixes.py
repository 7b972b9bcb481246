"""Suffix arrays by two-stage sorting, vectorised (for operator 5).

Only suffixes smaller than their successors are sorted directly, here by
their first symbols as packed integers; the others are induced: buckets of
first symbols are scanned from the least, and each suffix found puts its
predecessor, if that one is larger, next in the predecessor's bucket.
Texts end with the separator symbol 0; orders hold to ``depth`` symbols at
least, which is all that common prefixes up to ``depth`` need.
"""

from __future__ import annotations

import numpy as np


def symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each followed by 0, and where each begins."""
    flat = np.frombuffer(b"".join(texts), np.uint8)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.cumsum(size + 1) - (size + 1)
    used = np.zeros(256, bool)
    used[flat] = True
    out = np.zeros(len(flat) + len(texts), np.int16)
    keep = np.ones(len(out), bool)
    keep[begin + size] = False
    out[keep] = (np.cumsum(used) * used)[flat]  # order is kept, and 255 values at most fit a byte
    return out, begin


class Packed:
    """Runs of ``per`` symbols from given positions on, as one integer."""

    def __init__(self, t: np.ndarray, depth: int):
        self.bits = 8 if (int(t.max()) if len(t) else 0) < 256 else 9
        self.per = 64 // self.bits
        if self.bits == 8:
            self.bytes = np.concatenate([t.astype(np.uint8), np.zeros(depth + 16, np.uint8)])
            self.words = np.ndarray((len(self.bytes) - 7,), ">u8", self.bytes, 0, (1,))
        else:
            self.wide = np.concatenate([t, np.zeros(depth + 16, t.dtype)]).astype(np.uint64)

    def __call__(self, at: np.ndarray) -> np.ndarray:
        if self.bits == 8:
            return self.words[at].astype(np.uint64)
        key = np.zeros(len(at), np.uint64)
        for k in range(self.per):
            key = (key << np.uint64(9)) | self.wide[at + k]
        return key


def sort_directly(at: np.ndarray, key: Packed, depth: int) -> np.ndarray:
    """Positions in order of their first ``depth`` symbols: by one packed
    key, then, among those that tie, by rank and the next symbols."""
    first = key(at)
    order = np.argsort(first)
    at, first = at[order], first[order]
    new = np.ones(len(at), bool)
    new[1:] = first[1:] != first[:-1]
    done, rank_bits = key.per, max(1, int(len(at)).bit_length())
    step = (64 - rank_bits) // key.bits
    while done < depth:
        tied = ~new
        tied[:-1] |= ~new[1:]
        rows = np.flatnonzero(tied)
        if not len(rows):
            break
        group = np.cumsum(new[rows]).astype(np.uint64)
        take = min(step, key.per)
        more = (group << np.uint64(take * key.bits)) | (key(at[rows] + done) >> np.uint64((key.per - take) * key.bits))
        order = np.argsort(more)
        at[rows] = at[rows][order]
        more = more[order]
        new[rows] = np.append(True, more[1:] != more[:-1])
        done += take
    return at


def smaller_than_next(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor (the last, of a
    separator alone, counts as smaller)."""
    step = np.zeros(len(t), np.int8)
    step[:-1] = np.sign(t[1:].astype(np.int32) - t[:-1])
    step[-1:] = 1
    at = np.where(step != 0, np.arange(len(t)), len(t) - 1)  # equal symbols: as the next unequal pair
    return step[np.minimum.accumulate(at[::-1])[::-1]] > 0


def suffix_array(t: np.ndarray, depth: int) -> np.ndarray:
    top = int(t.max()) if len(t) else 0
    direct = sort_directly(np.flatnonzero(smaller_than_next(t)), Packed(t, depth), depth)
    first = t[direct]
    cut = np.searchsorted(first, np.arange(top + 2))
    waiting: list[list[np.ndarray]] = [[] for _ in range(top + 1)]
    out = []
    for c in range(top + 1):
        bucket = waiting[c]
        now = np.concatenate(bucket) if bucket else np.zeros(0, np.int64)
        parts = [now]
        while len(now):  # runs of one symbol induce into their own bucket
            now = now[now > 0] - 1
            now = now[t[now] == c]
            parts.append(now)
        parts.append(direct[cut[c]:cut[c + 1]])
        whole = np.concatenate(parts)
        out.append(whole)
        before = whole[whole > 0] - 1
        symbol = t[before]
        larger = symbol > c
        before, symbol = before[larger], symbol[larger]
        order = np.argsort(symbol, kind="stable")
        before, symbol = before[order], symbol[order]
        for s, a in zip(*np.unique(symbol, return_index=True), strict=True):
            waiting[s].append(before[a:np.searchsorted(symbol, s, side="right")])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def common_prefixes(t: np.ndarray, sa: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each suffix in ``sa`` and the one before it, without
    separators, counted to ``depth`` at most."""
    ends = np.flatnonzero(t == 0)
    left = ends[np.searchsorted(ends, sa)] - sa  # symbols before the separator
    key = Packed(t, depth)
    bits, per = key.bits, key.per
    out = np.zeros(len(sa), np.int64)
    open_ = np.arange(1, len(sa))
    for k in range(0, depth, per):
        x = key(sa[open_ - 1] + k) ^ key(sa[open_] + k)
        same = x == 0
        differ = open_[~same]
        high = np.frexp((x[~same] >> np.uint64(11)).astype(np.float64))[1] + 11  # bits up to the first that differs
        low = x[~same] < 2048
        high = np.where(low, np.frexp(x[~same].astype(np.float64))[1], high)
        out[differ] = k + (per * bits - high) // bits
        open_ = open_[same]
        out[open_] = k + per
    out[1:] = np.minimum(out[1:], np.minimum(left[1:], left[:-1]))
    return np.minimum(out, depth)

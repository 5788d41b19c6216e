"""Byte-level BPE over chunks of text: vectorised splitting and a word cache.

Splitting follows the tokenizer's public pattern, a fixed value

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

on whole chunks with numpy, and each distinct piece is encoded once per worker.
Merges never cross pieces, so this equals encoding each text on its own.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Callable

import numpy as np

from .text import LEADS, Chunk, owner, same_spans, span_hashes, spread, words_at

OTHER, LETTER, NUMBER, SPACE = range(4)

#: Pieces that a worker remembers before it starts afresh.
CACHE_PIECES = 200_000
SLOT_BITS = 20


@functools.cache
def classes() -> np.ndarray:
    """The class of every code point."""
    import regex

    out = np.zeros(0x110000, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            a, b = ord(m[0][0]), ord(m[0][-1])
            out[a : b + 1] = kind
    return out


def split(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts of all pieces of a chunk, and the row of each."""
    if not len(chunk.data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(LEADS[chunk.data])
    points = np.frombuffer(chunk.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(points)
    kind = classes()[points]
    first = np.zeros(n + 1, bool)  # of a text
    first[np.searchsorted(at, chunk.bounds)] = True
    run = first[:n].copy()  # first of a run of one class in a text
    run[1:] |= kind[1:] != kind[:-1]
    last = np.ones(n, bool)
    last[:-1] = run[1:]
    space = kind == SPACE
    starts = run.copy()
    # a blank joins the run after it; of longer white space the last character stands apart
    before = np.zeros(n, bool)
    before[1:] = points[:-1] == 32
    starts &= space | first[:n] | ~before
    starts |= space & last & ~first[1:]
    # contractions, where an apostrophe is a run of its own and no blank joins it
    quotes = np.flatnonzero((points == 39) & run & last & starts & ~first[1:])
    if len(quotes):
        whose = owner(np.searchsorted(at, chunk.bounds), quotes)
        end = np.searchsorted(at, chunk.bounds)[whose + 1]
        one, two = points[np.minimum(quotes + 1, n - 1)], points[np.minimum(quotes + 2, n - 1)]
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = ((one == ord("r")) & (two == ord("e")) | (one == ord("v")) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))) & (quotes + 2 < end)
        hit = single | double
        starts[quotes[hit] + 1] = False
        stop = quotes[hit] + np.where(single, 2, 3)[hit]
        starts[stop[stop < end[hit]]] = True
    begin = at[np.flatnonzero(starts)]
    return begin, owner(chunk.bounds, begin)


class PieceCache:
    """Ids of pieces, filled by ``encode(list of bytes) -> list of id lists`` for those not seen.

    Pieces are found by hash and their bytes compared with those kept, so two pieces of one hash never share ids.
    """

    def __init__(self, encode: Callable[[list[bytes]], list[list[int]]]):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.known: dict[int, int] = {}
        self.entries = 0
        self.flat = np.zeros(1 << 16, np.int32)
        self.start = np.zeros(1 << 14, np.int64)
        self.count = np.zeros(1 << 14, np.int64)
        self.used = 0
        self.raw = np.zeros(1 << 17, np.uint8)
        self.raw_start = np.zeros(1 << 14, np.int64)
        self.raw_size = np.zeros(1 << 14, np.int64)
        self.raw_used = 0
        # a direct-mapped table in front of ``known``: the last piece seen in each slot
        self.slot_hash = np.zeros(1 << SLOT_BITS, np.uint64)
        self.slot_number = np.full(1 << SLOT_BITS, -1, np.int32)

    def _add(self, pieces: list[bytes]) -> range:
        """Encode and keep pieces; their numbers."""
        ids = self.encode(pieces)
        n, k = self.entries, len(ids)
        while len(self.start) < n + k:
            self.start, self.count, self.raw_start, self.raw_size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.count, self.raw_start, self.raw_size))
        self.used, self.flat = self._put(np.fromiter(itertools.chain.from_iterable(ids), np.int32), self.flat, self.used, np.fromiter(map(len, ids), np.int64, k), self.start, self.count, n)
        self.raw_used, self.raw = self._put(np.frombuffer(b"".join(pieces), np.uint8), self.raw, self.raw_used, np.fromiter(map(len, pieces), np.int64, k), self.raw_start, self.raw_size, n)
        self.entries = n + k
        return range(n, n + k)

    @staticmethod
    def _put(values: np.ndarray, flat: np.ndarray, used: int, sizes: np.ndarray, starts: np.ndarray, counts: np.ndarray, first: int) -> tuple[int, np.ndarray]:
        end = used + len(values)
        while len(flat) < end + 8:
            flat = np.concatenate([flat, np.zeros_like(flat)])
        flat[used:end] = values
        starts[first : first + len(sizes)] = used + np.cumsum(sizes) - sizes
        counts[first : first + len(sizes)] = sizes
        return end, flat

    def _numbers(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """The cache's number of each piece, and its row."""
        starts, rows = split(chunk)
        if not len(starts):
            return starts, rows
        ends = np.append(starts[1:], len(chunk.data))
        hashes = span_hashes(chunk.data, starts, ends)
        if self.entries > CACHE_PIECES:
            self.clear()
        raw = chunk.data.tobytes()
        slots = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        numbers = self.slot_number[slots].astype(np.int64)
        rest = np.flatnonzero((self.slot_hash[slots] != hashes) | (numbers < 0))
        if len(rest):
            wanted, at, back = np.unique(hashes[rest], return_index=True, return_inverse=True)
            keys, at = wanted.tolist(), rest[at]
            missing = [i for i, k in enumerate(keys) if k not in self.known]
            if missing:
                new = self._add([raw[starts[j] : ends[j]] for j in at[missing].tolist()])
                self.known.update(zip((keys[i] for i in missing), new, strict=True))
            known = self.known
            found = np.fromiter((known[k] for k in keys), np.int64, len(keys))
            numbers[rest] = found[back]
            self.slot_hash[slots[at]] = wanted
            self.slot_number[slots[at]] = found
        sizes = ends - starts
        kept = np.ndarray(len(self.raw) - 7, "<u8", self.raw, strides=(1,))
        same = self.raw_size[numbers] == sizes
        at = np.flatnonzero(same)
        same[at] = same_spans(words_at(chunk.data), starts[at], kept, self.raw_start[numbers[at]], sizes[at])
        if not same.all():  # another piece has this hash
            other = np.flatnonzero(~same)
            numbers[other] = self._add([raw[starts[j] : ends[j]] for j in other.tolist()])
        return numbers, rows

    def counts(self, chunk: Chunk) -> np.ndarray:
        """Tokens of each row."""
        number, rows = self._numbers(chunk)
        return np.bincount(rows, self.count[number] if len(number) else None, chunk.rows).astype(np.int64)

    def ids(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a chunk, and the bounds of each row in them."""
        number, rows = self._numbers(chunk)
        counts = self.count[number] if len(number) else np.zeros(0, np.int64)
        bounds = np.zeros(chunk.rows + 1, np.int64)
        np.cumsum(np.bincount(rows, counts, chunk.rows).astype(np.int64), out=bounds[1:])
        return self.flat[spread(self.start[number], counts)] if len(number) else self.flat[:0], bounds

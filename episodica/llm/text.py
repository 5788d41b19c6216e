"""Vectorised work on the bytes of Arrow text columns, shared by the operators.

Texts arrive as Arrow batches; everything below works on the UTF-8 buffer of
a few megabytes of rows at a time, so memory is bounded by ``CHUNK_BYTES`` and
the longest single text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 20

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

#: Spans of more bytes are hashed, and compared, one by one.
LONG_SPAN = 256


_HELD: dict[str, dict] = {}


def held(owner: str) -> dict:
    """What a Python worker keeps from task to task for one operator; what it kept for others is let go."""
    for other in [k for k in _HELD if k != owner]:
        del _HELD[other]
    return _HELD.setdefault(owner, {})


def worker(owner: str, batches: Iterator[pa.RecordBatch], keep: bool = False) -> Iterator[pa.RecordBatch]:
    """The batches of a task of one operator; memory freed is given back to the system after each.

    What the operator holds goes with the task, unless it is to ``keep`` for the next.
    """
    held(owner)
    for batch in batches:
        yield batch
        del batch
        _give_back()
    if not keep:
        _HELD.clear()
    _give_back()


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


def _libc() -> ctypes.CDLL | None:
    try:
        libc = ctypes.CDLL(None)
        return libc if hasattr(libc, "malloc_trim") else None  # glibc has it
    except OSError:
        return None


_LIBC = _libc()


@dataclass
class Chunk:
    """Rows ``first:last`` of a batch: text i is ``data[bounds[i]:bounds[i+1]]``."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray
    null: np.ndarray

    @property
    def rows(self) -> int:
        return self.last - self.first

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a string column into runs of rows of about ``limit`` bytes; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    null = np.asarray(column.is_null())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(n, max(first + 1, last))
        yield Chunk(first, last, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first], null[first:last])
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one integer; past the end they are zero."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of ``data[start:end]`` (of ``fold``'s bytes for them): eight bytes at a time, mixed into what came before.

    Equal bytes give equal hashes in any chunk. Spans of one length up to eight bytes never share one.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    if fold is not None:
        data = fold[data]
    words, sizes = words_at(data), ends - starts
    out = mix((words[starts] & _MASKS[np.minimum(sizes, 8)]) * _ODD + sizes.astype(np.uint64))
    at, done = np.flatnonzero(sizes > 8), 8
    while len(at):
        if done >= LONG_SPAN:
            for i, a, b in zip(at.tolist(), starts[at].tolist(), ends[at].tolist(), strict=True):
                out[i] = _long_hash(data[a:b])
            break
        out[at] = mix((out[at] ^ (words[starts[at] + done] & _MASKS[np.minimum(sizes[at] - done, 8)])) * _ODD + _U(done))
        done += 8
        at = at[sizes[at] > done]
    return out


def _long_hash(span: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(span.tobytes(), 11)


def same_spans(words: np.ndarray, starts: np.ndarray, other: np.ndarray, other_starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether spans of the same sizes in two buffers, given by their ``words_at``, hold the same bytes."""
    out = (words[starts] ^ other[other_starts]) & _MASKS[np.minimum(sizes, 8)] == 0
    at, done = np.flatnonzero(out & (sizes > 8)), 8
    while len(at):
        if done >= LONG_SPAN:
            for i in at.tolist():
                whole = np.arange(done, sizes[i] - 7, 8)
                out[i] = bool((words[starts[i] + whole] == other[other_starts[i] + whole]).all() and words[starts[i] + sizes[i] - 8] == other[other_starts[i] + sizes[i] - 8])
            break
        equal = (words[starts[at] + done] ^ other[other_starts[at] + done]) & _MASKS[np.minimum(sizes[at] - done, 8)] == 0
        out[at[~equal]] = False
        done += 8
        at = at[equal & (sizes[at] > done)]
    return out


def lower_bytes() -> np.ndarray:
    """Bytes by bytes, A-Z as a-z."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] = out[97:123]
    return out


def runs(mask: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that do not cross a text's bounds."""
    n = len(mask)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    starts = mask.copy()
    starts[1:] &= ~mask[:-1] | edge[1:n]
    ends = mask.copy()
    ends[:-1] &= ~mask[1:] | edge[1:n]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def owner(bounds: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The text that each (sorted) position lies in."""
    return np.searchsorted(bounds, at, "right") - 1


def any_of(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans, True in the given inclusive ranges."""
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


#: Bytes of `[^\x20\x09-\x0D]`.
NOT_SPACE = ~any_of((0x20, 0x20), (0x09, 0x0D))
#: Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` once A-Z are lower-cased.
WORD = any_of((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: Bytes that begin a code point.
LEADS = ~any_of((0x80, 0xBF))


def sums(weights: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``weights[start:end]``."""
    total = np.zeros(len(weights) + 1, np.int64)
    np.cumsum(weights, out=total[1:])
    return total[ends] - total[starts]


def find(sorted_keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Positions of wanted values in a sorted array, -1 where absent."""
    if not len(sorted_keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.searchsorted(sorted_keys, wanted)
    at[at == len(sorted_keys)] = 0
    return np.where(sorted_keys[at] == wanted, at, -1)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated ranges start, start+1, ... of the given lengths."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    return np.arange(total, dtype=np.int64) + shift

"""Operator 3: byte-level BPE by prefix dynamic programming.

For every byte prefix of a piece exactly one token can end its encoding. That
token is found from shorter prefixes: a token that ends the prefix is right
if and only if it is compatible with the last token of what precedes it, that
is, if merging would not cross or undo their border. The stored last tokens
spell the encoding backwards, allow appends without a new start, and tell
after an edit where old and new encodings meet again.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .pieces import PieceCache
from .shared import Carried, short_batches
from .text import chunks, held, worker

_NO_LIMIT = 1 << 62


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class PrefixEncoder:
    """Encodes pieces of bytes with a rank table that holds all single bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.merged: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.usable: dict[bytes, int] = {}
        self._seen: dict[int, bool] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: (len(x[0]) > 1, x[1])):
            if len(token) == 1:
                self.parts[rank] = (rank, rank)
                self.usable[token] = rank
                continue
            for i in range(1, len(token)):
                a, b = self.usable.get(token[:i]), self.usable.get(token[i:])
                if a is not None and b is not None and self._walk(a, b):
                    self.merged[a, b] = rank
                    self.parts[rank] = (a, b)
                    self.usable[token] = rank
                    break

    def _walk(self, a: int, b: int) -> bool:
        """Undo merges next to the border of a and b, latest first; a pair that would have merged across it earlier speaks against them."""
        limit = _NO_LIMIT
        while True:
            across = self.merged.get((a, b))
            if across is not None and across < limit:
                return False
            inner, outer = self.parts[a][1], self.parts[b][0]
            left, right = inner != a, outer != b
            if not left and not right:
                return True
            if left and (a > b or not right):
                limit, a = a, inner
            else:
                limit, b = b + 1, outer

    def compatible(self, a: int, b: int) -> bool:
        key = a << 32 | b
        seen = self._seen.get(key)
        if seen is None:
            if len(self._seen) > 150_000:
                self._seen.clear()
            seen = self._seen[key] = self._walk(a, b)
        return seen

    def extend(self, piece: bytes, begin: int, tokens: list[int], sizes: list[int]) -> None:
        """Append the last tokens, and their lengths, of piece[:begin], piece[:begin + 1], ..."""
        usable, seen, longest = self.usable, self._seen, self.longest
        for end in range(begin, len(piece) + 1):
            for size in range(1, min(end, longest) + 1):
                token = usable.get(piece[end - size : end])
                if token is not None:
                    if size == end:
                        break
                    before = tokens[end - size]
                    fits = seen.get(before << 32 | token)
                    if fits or fits is None and self.compatible(before, token):
                        break
            else:
                raise ValueError("a byte has no token")
            tokens.append(token)
            sizes.append(size)

    def encode(self, piece: bytes) -> list[int]:
        """Ids as the library gives them: a piece that is a token as a whole is that token."""
        whole = self.ranks.get(piece)
        return [whole] if whole is not None else Prefixes(self, piece).ids()

    def encode_all(self, pieces: list[bytes]) -> list[list[int]]:
        """As ``encode`` for each; in sorted order, so that pieces share the work on common prefixes."""
        out: list[list[int]] = [[]] * len(pieces)
        state = Prefixes(self)
        for i in sorted(range(len(pieces)), key=pieces.__getitem__):
            piece = pieces[i]
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = [whole]
                continue
            state.become(piece)
            out[i] = state.ids()
        return out


class Prefixes:
    """The last tokens of all prefixes of one piece."""

    def __init__(self, encoder: PrefixEncoder, piece: bytes = b""):
        self.encoder, self.piece, self.tokens, self.sizes = encoder, b"", [-1], [0]
        self.append(piece)

    def append(self, more: bytes) -> None:
        """Exact at the cost of the new bytes alone."""
        begin = len(self.piece) + 1
        self.piece += more
        self.encoder.extend(self.piece, begin, self.tokens, self.sizes)

    def become(self, piece: bytes) -> None:
        """Hold another piece instead; the common prefix is kept."""
        old, same, most = self.piece, 0, min(len(self.piece), len(piece))
        while same < most and old[same] == piece[same]:
            same += 1
        del self.tokens[same + 1 :], self.sizes[same + 1 :]
        self.piece = piece
        self.encoder.extend(piece, same + 1, self.tokens, self.sizes)

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` for piece[start:end]; returns how many prefixes were computed again.

        A prefix depends on those at most one longest token before it, so once as many
        in a row agree with the old ones, all later ones do.
        """
        old_tokens, old_sizes, tail = self.tokens, self.sizes, self.piece[end:]
        self.tokens, self.sizes, self.piece = old_tokens[: start + 1], old_sizes[: start + 1], self.piece[:start]
        self.append(new)
        again, agree, shift = len(new), 0, start + len(new) - end
        for at in range(len(tail)):
            self.append(tail[at : at + 1])
            again += 1
            now = len(self.piece)
            agree = agree + 1 if (self.tokens[now], self.sizes[now]) == (old_tokens[now - shift], old_sizes[now - shift]) else 0
            if agree >= self.encoder.longest:
                self.piece += tail[at + 1 :]
                self.tokens += old_tokens[now - shift + 1 :]
                self.sizes += old_sizes[now - shift + 1 :]
                break
        return again

    def ids(self) -> list[int]:
        out, at = [], len(self.piece)
        while at:
            out.append(self.tokens[at])
            at -= self.sizes[at]
        return out[::-1]


def _worker(version: str, ranks: dict[bytes, int]) -> tuple[PieceCache, list[bytes], list[bytes]]:
    """A worker's cache, the bytes of each id, and each id in decimal."""
    mine = held("byte-bpe")
    if version not in mine:
        size = max(ranks.values()) + 1
        raw = [b""] * size
        for token, rank in ranks.items():
            raw[rank] = token
        mine[version] = PieceCache(PrefixEncoder(ranks).encode_all), raw, [str(i).encode() for i in range(size)]
    return mine[version]


def byte_bpe(df: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), with_ids: bool = False) -> DataFrame:
    """Encode each text and decode the ids again.

    Returns ``id_col``, the columns in ``keep``, n_tokens, ids_sha256 (of the decimal ids
    joined by commas), decoded_sha256 (of the decoded bytes) and, if asked for, ids.
    Null and empty texts have no tokens; a null id, repeated rows and ties are kept as they
    are, one row out for each row in; other columns are not read, and one in ``keep`` whose name
    a result has gets an underscore. An empty table gives an empty result; a text of any length
    is encoded whole, a long one alone. The rank table is broadcast: it has the size of the
    vocabulary, whatever the data.
    """
    ranks = read_ranks(ranks_path)
    version = hashlib.sha256(repr(sorted(ranks.items(), key=lambda x: x[1])).encode()).hexdigest()
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    results = ["n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]
    carried = Carried(df, id_col, text_col, keep, results)
    short_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, raw, decimal = _worker(version, shared.value)
        for batch in worker("byte-bpe", batches, keep=True):
            for c in chunks(batch.column(carried.text)):
                ids, bounds = cache.ids(c)
                listed = ids.tolist()
                digests, decoded = [], []
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    own = listed[a:b]
                    digests.append(hashlib.sha256(b",".join([decimal[i] for i in own])).hexdigest())
                    decoded.append(hashlib.sha256(b"".join([raw[i] for i in own])).hexdigest())
                out = carried.parts(batch, c.first, c.rows)
                out += [pa.array(np.diff(bounds)), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids)))
                yield pa.RecordBatch.from_arrays(out, [*carried.heads, *results])

    schema = carried.schema + ", n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return carried.named(carried.source.mapInArrow(run, schema))

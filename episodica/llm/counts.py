"""Operator 6: token counts through a cache keyed by content and tokenizer digests."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ledger import addressed, bring_up_to_date
from .pieces import PieceCache
from .shared import shared_dir
from .text import Chunk, chunks, held, worker


def _byte_characters() -> dict[str, str]:
    """The character that stands for each byte in byte-level files: printable Latin-1 for itself, the others from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): chr(b) for b in own} | {chr(b): chr(256 + i) for i, b in enumerate(rest)}


_CHARACTERS = str.maketrans(_byte_characters())


def _plain(spec: str) -> bool:
    """Whether a file splits by the byte-level pattern alone, so that its texts may be encoded piece by piece."""
    file = json.loads(spec)
    split = file.get("pre_tokenizer") or {}
    by_pattern = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True)
    cut = any(file.get(k) for k in ("normalizer", "truncation", "padding"))
    return by_pattern and not cut and file["model"].get("type") == "BPE" and not file["model"].get("dropout")


class LibraryCounter:
    """Token ids of a file of the tokenizers library, without added special tokens.

    Where the file splits by the byte-level pattern, each distinct piece is given to the
    library's model once; a text that holds one of the file's special strings, and any text
    of another file, goes to the library whole.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.plain = _plain(spec)
        self.model = self.tokenizer.model
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache = PieceCache(self._pieces)

    def _pieces(self, pieces: list[bytes]) -> list[list[int]]:
        tokenize = self.model.tokenize
        return [[t.id for t in tokenize(p.decode("latin-1").translate(_CHARACTERS))] for p in pieces]

    def _library(self, text: bytes) -> list[int]:
        return self.tokenizer.encode(text.decode("utf-8"), add_special_tokens=False).ids

    def _whole(self, chunk: Chunk) -> dict[int, list[int]]:
        raw = chunk.data.tobytes()
        if not any(s in raw for s in self.special):
            return {}
        return {i: self._library(t) for i in range(chunk.rows) if any(s in (t := chunk.text(i)) for s in self.special)}

    def counts(self, chunk: Chunk) -> np.ndarray:
        if not self.plain:
            return np.array([len(self._library(chunk.text(i))) for i in range(chunk.rows)], np.int64)
        out = self.cache.counts(chunk)
        for i, ids in self._whole(chunk).items():
            out[i] = len(ids)
        return out

    def ids(self, chunk: Chunk, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a chunk, each row's followed by ``end_id``, and the bounds of each row in them."""
        flat, bounds = self.cache.ids(chunk) if self.plain else (np.zeros(0, np.int32), np.zeros(chunk.rows + 1, np.int64))
        whole = self._whole(chunk) if self.plain else {i: self._library(chunk.text(i)) for i in range(chunk.rows)}
        if whole:
            parts = [np.array(whole[i], np.int32) if i in whole else flat[bounds[i] : bounds[i + 1]] for i in range(chunk.rows)]
            flat, bounds = np.concatenate(parts), np.concatenate([[0], np.cumsum(list(map(len, parts)))])
        return np.insert(flat, bounds[1:], np.int32(end_id)), bounds + np.arange(len(bounds))


def library_counter(version: str, spec: str) -> LibraryCounter:
    mine = held("library")
    if version not in mine:
        mine[version] = LibraryCounter(spec)
    return mine[version]


def read_spec(path: str) -> tuple[str, str]:
    """A tokenizer file and its digest."""
    with open(path, encoding="utf-8") as f:
        spec = f.read()
    return hashlib.sha256(spec.encode()).hexdigest(), spec


def token_counts(df: DataFrame, tokenizer_path: str, limit: int = 512, cache_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """n_bytes, n_tokens and over_limit (n_tokens > limit) of every row.

    The content's normal form is its UTF-8 bytes, null as empty: anything looser would
    change counts. ``cache_path`` names a lasting cache; None starts an empty one.
    Null and empty texts count 0. A null id, repeated rows, ties and copies are kept, one row
    out for each row in; other columns are not read. An empty table gives an empty result; a
    text of any length is counted whole, a long one alone. A tokenizer file is broadcast: it
    has the size of the vocabulary, whatever the data.
    """
    spark = df.sparkSession
    version, spec = read_spec(tokenizer_path)
    shared = spark.sparkContext.broadcast(spec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = library_counter(version, shared.value)
        for batch in worker("library", batches, keep=True):
            for c in chunks(batch.column("__text")):
                yield pa.RecordBatch.from_arrays([batch.column("__digest").slice(c.first, c.rows), pa.array(counter.counts(c))], ["__digest", "n_tokens"])

    rows = addressed(df, id_col, text_col)
    cache = bring_up_to_date(df, rows, id_col, text_col, version, cache_path or shared_dir(spark, "token-counts"), run, "n_tokens long")
    return rows.join(cache, "__digest", "left").select(F.col("__id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))

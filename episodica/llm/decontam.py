"""Operator 4: benchmark decontamination by winnowing.

Fingerprints: of the hashes of ``k`` consecutive words, the least of every
``window - k + 1`` in a row is kept. Any shared span of ``window`` words then
shares a kept hash, wherever it lies; its hits are extended to the windows of
``window`` words around them, which are compared as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Carried, short_batches, written
from .text import WORD, Chunk, chunks, find, lower_bytes, mix, owner, runs, span_hashes, spread, worker

_STEP = np.uint64(0xD6E8FEB86659FD93)
_OTHER = np.uint64(0xA0761D6478BD642F)
_LOWER = lower_bytes()
RESULTS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")

#: Up to so many benchmark words the windows are broadcast (16 bytes each); beyond, they are joined.
BROADCAST_WORDS = 4_000_000


@dataclass
class Words:
    """The words of a chunk: hash and row of each, their number by row, and where their bytes are."""

    hashes: np.ndarray
    rows: np.ndarray
    counts: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, c: Chunk) -> Words:
        starts, ends = runs(WORD[c.data], c.bounds)
        rows = owner(c.bounds, starts)
        return cls(span_hashes(c.data, starts, ends, _LOWER), rows, np.bincount(rows, minlength=c.rows), c.data, starts, ends)

    def grams(self, n: int, second: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hashes (of another kind with ``second``) of n words from each word on, and whether they lie in one row."""
        size = len(self.hashes) - n + 1
        if size <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, bool)
        words = mix(self.hashes ^ _OTHER) if second else self.hashes
        out = np.zeros(size, np.uint64)
        for i in range(n):
            out = mix(out * _STEP + words[i : i + size])
        return mix(out + np.uint64(n)), self.rows[:size] == self.rows[n - 1 : n - 1 + size]

    def said(self, first: int, n: int) -> bytes:
        """Words from ``first`` on, lower-cased and parted by blanks."""
        return b" ".join([_LOWER[self.data[a:b]].tobytes() for a, b in zip(self.starts[first : first + n].tolist(), self.ends[first : first + n].tolist(), strict=True)])


def winnow(grams: np.ndarray, whole: np.ndarray, rows: np.ndarray, width: int) -> np.ndarray:
    """Positions whose hash is least in some run of ``width`` hashes of one row; of equal ones all."""
    size = len(grams) - width + 1
    if size <= 0:
        return np.zeros(0, np.int64)
    least = grams[:size]
    for i in range(1, width):
        least = np.minimum(least, grams[i : i + size])
    fits = whole[:size] & whole[width - 1 :] & (rows[:size] == rows[width - 1 : width - 1 + size])
    kept = np.zeros(len(grams), bool)
    for i in range(width):
        kept[i : i + size] |= fits & (grams[i : i + size] == least)
    return np.flatnonzero(kept)


def _around(at: np.ndarray, window: int, k: int, fits: np.ndarray) -> np.ndarray:
    """First words of all windows of one row that hold the k words at any of the positions."""
    starts = (at[:, None] - np.arange(window - k + 1)[None, :]).ravel()
    starts = starts[(starts >= 0) & (starts < len(fits))]
    starts = np.unique(starts)
    return starts[fits[starts]]


class Benchmark:
    """Fingerprints of long items, the distinct windows of all, and the items of each window."""

    def __init__(self, items: list[tuple[object, str | None]], window: int, k: int):
        self.window, self.k = window, k
        prints, self.short, read = [np.zeros(0, np.uint64)], set(), 0
        found = [(np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3)]  # hash, item, place and length of its words' bytes
        said = [np.zeros(0, np.uint8)]
        column = pa.array([t for _, t in items], pa.string())
        for c in chunks(column):
            w = Words.of(c)
            grams, whole = w.grams(k)
            prints.append(grams[winnow(grams, whole, w.rows, window - k + 1)])
            sizes = w.ends - w.starts
            said.append(np.insert(_LOWER[c.data[spread(w.starts, sizes)]], np.cumsum(sizes), np.uint8(32)))
            places = read + np.cumsum(sizes + 1) - sizes - 1
            read += len(said[-1])
            wide, fits = w.grams(window)
            at = np.flatnonzero(fits)
            found.append((wide[at], c.first + w.rows[at], places[at], places[at + window - 1] + sizes[at + window - 1] - places[at]))
            firsts = np.concatenate([[0], np.cumsum(w.counts)])
            few = (w.counts > 0) & (w.counts < window)
            for n in np.unique(w.counts[few]).tolist():
                at = firsts[np.flatnonzero(few & (w.counts == n))]
                found.append((w.grams(n)[0][at], c.first + w.rows[at], places[at], places[at + n - 1] + sizes[at + n - 1] - places[at]))
                self.short.add(n)
        self.prints = np.unique(np.concatenate(prints))
        self.said = np.concatenate(said).tobytes()
        hashes, whose, place, size = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((whose, hashes))
        hashes, self.whose = hashes[order], whose[order]
        self.windows, first = np.unique(hashes, return_index=True)
        self.first = np.append(first, len(hashes))
        self.place, self.size = place[order][first], size[order][first]
        self.names = ["" if i is None else str(i) for i, _ in items]

    def match(self, w: Words) -> list[tuple[np.ndarray, int, np.ndarray]]:
        """Occurrences of windows: first words, length, and the windows' numbers."""
        grams, whole = w.grams(self.k)
        at = winnow(grams, whole, w.rows, self.window - self.k + 1)
        at = at[find(self.prints, grams[at]) >= 0]
        wide, fits = w.grams(self.window)
        starts = _around(at, self.window, self.k, fits)
        out = [(starts, self.window, find(self.windows, wide[starts]))]
        for n in sorted(self.short):  # shorter than any span that winnowing promises to find: compared whole
            own, fits = w.grams(n)
            starts = np.flatnonzero(fits)
            out.append((starts, n, find(self.windows, own[starts])))
        return [self._same_words(w, s[i >= 0], n, i[i >= 0]) for s, n, i in out]

    def _same_words(self, w: Words, starts: np.ndarray, n: int, which: np.ndarray) -> tuple[np.ndarray, int, np.ndarray]:
        """Those whose words are the window's, and not just their hash."""
        spots = zip(starts.tolist(), self.place[which].tolist(), self.size[which].tolist(), strict=True)
        same = np.fromiter((w.said(s, n) == self.said[a : a + size] for s, a, size in spots), bool, len(starts))
        return starts[same], n, which[same]

    def judge(self, c: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """Words, hit words, items and the digest of the items, by row."""
        w = Words.of(c)
        cover = np.zeros(len(w.hashes) + 1, np.int64)
        pairs = [np.zeros((0, 2), np.int64)]
        for starts, n, which in self.match(w):
            np.add.at(cover, starts, 1)
            np.add.at(cover, starts + n, -1)
            counts = self.first[which + 1] - self.first[which]
            pairs.append(np.stack([np.repeat(w.rows[starts], counts), self.whose[spread(self.first[which], counts)]], 1))
        hit = np.bincount(w.rows, np.cumsum(cover[:-1]) > 0, c.rows).astype(np.int64)
        items: dict[int, set[str]] = {}
        for row, item in np.unique(np.concatenate(pairs), axis=0).tolist():
            items.setdefault(row, set()).add(self.names[item])
        nothing = hashlib.sha256(b"").hexdigest()
        digests, n_items = [nothing] * c.rows, np.zeros(c.rows, np.int64)
        for row, names in items.items():
            digests[row], n_items[row] = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), len(names)
        return w.counts, hit, n_items, digests


def decontaminate(df: DataFrame, benchmark: DataFrame, window: int = 10, k: int = 5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep: tuple[str, ...] = (), broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """n_words, n_hit, n_items, items_sha256 and contaminated for every row.

    A window is ``window`` consecutive words of an item (a shorter item, not empty, is one
    window); every document word in an occurrence of a window is hit. Null has no words. A
    null item id counts as an empty name; items that share an id count once. Repeated rows,
    ties and null ids are kept, one row out for each row in, with the columns in ``keep``.
    (a name that a result has gets an underscore). Empty tables give empty results or none
    hit; a text of any length is read whole, a long one alone.
    The benchmark's bytes are counted first: up to ``broadcast_words`` its windows are
    broadcast and compared word by word, beyond them fingerprints and windows are joined by
    two hashes of 64 bits.
    """
    spark = df.sparkSession
    carried = Carried(df, id_col, text_col, keep, RESULTS)
    items = benchmark.select(benchmark[item_col].alias("__item"), benchmark[item_text_col].alias("__text")).where(F.octet_length("__text") > 0)
    size = items.select(F.sum(F.octet_length("__text") + 1)).first()[0] or 0  # a word and what parts it from the next take 2 bytes at least
    if size > 2 * broadcast_words:
        return carried.named(_joined(carried, items, window, k))
    bench = spark.sparkContext.broadcast(Benchmark([tuple(r) for r in items.collect()], window, k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in worker("winnowing", batches):
            for c in chunks(batch.column(carried.text)):
                n, hit, n_items, digests = bench.value.judge(c)
                yield pa.RecordBatch.from_arrays([*carried.parts(batch, c.first, c.rows), pa.array(n), pa.array(hit), pa.array(n_items), pa.array(digests, pa.string()), pa.array(hit > 0)], [*carried.heads, *RESULTS])

    short_batches(spark)
    return carried.named(carried.source.mapInArrow(run, carried.schema + ", n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"))


_SPANS = "__key string, __print long, __start long, __n long, __hash long, __check long, __words long"


def _spans(df: DataFrame, window: int, k: int, lengths: tuple[int, ...], prints: bool = True) -> DataFrame:
    """Windows (key, print, start, n, two hashes, words of the text) of ``df`` (__key string, __text).

    With ``prints`` every window around every fingerprint, under that print; for each of ``lengths`` every run of words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in worker("winnowing", batches):
            for c in chunks(batch.column("__text")):
                w = Words.of(c)
                parts = []
                if prints:
                    grams, whole = w.grams(k)
                    at = winnow(grams, whole, w.rows, window - k + 1)
                    wide, fits = w.grams(window)
                    check = w.grams(window, True)[0]
                    starts = (at[:, None] - np.arange(window - k + 1)[None, :]).ravel()
                    under = np.repeat(grams[at], window - k + 1)
                    good = (starts >= 0) & (starts < len(fits))
                    starts, under = starts[good], under[good]
                    good = fits[starts] if len(starts) else np.zeros(0, bool)
                    parts.append((under[good], starts[good], window, wide[starts[good]] if len(starts) else wide[:0], check[starts[good]] if len(starts) else wide[:0]))
                for n in lengths:
                    own, fits = w.grams(n)
                    s = np.flatnonzero(fits)
                    parts.append((np.zeros(len(s), np.uint64), s, n, own[s], w.grams(n, True)[0][s]))
                firsts = np.concatenate([[0], np.cumsum(w.counts)])
                for under, s, n, h, g in parts:
                    rows = w.rows[s]
                    keys = batch.column("__key").slice(c.first, c.rows).take(pa.array(rows))
                    yield pa.RecordBatch.from_arrays([keys, pa.array(under.view(np.int64)), pa.array(s - firsts[rows]), pa.array(np.full(len(s), n, np.int64)), pa.array(h.view(np.int64)), pa.array(g.view(np.int64)), pa.array(w.counts[rows])], ["__key", "__print", "__start", "__n", "__hash", "__check", "__words"])

    short_batches(df.sparkSession)
    return df.mapInArrow(run, _SPANS)


def _joined(carried: Carried, items: DataFrame, window: int, k: int) -> DataFrame:
    """As ``decontaminate``, for a benchmark of any size: fingerprints meet in a join, then windows.

    Windows of short items meet by their own hash, so no key holds all runs of a length. Items
    that share a window stand under one digest of their list, so documents meet lists, not
    each window's items one by one.
    """
    text = F.coalesce(F.col(carried.text), F.lit(""))
    heads = [F.col(c) for c in carried.heads]
    docs = carried.source.withColumn("__key", F.sha2(F.concat_ws("\x00", F.coalesce(heads[0].cast("string"), F.lit("\x01")), text), 256)).withColumn("__read", text)
    item = F.coalesce(F.col("__item").cast("string"), F.lit(""))
    keyed = items.select(item.alias("__key"), "__text")
    place = ["__hash", "__check", "__n"]
    long = _spans(keyed, window, k, ())
    short = _spans(keyed, window, k, tuple(range(1, window)), prints=False).where(F.col("__n") == F.col("__words"))
    theirs = written(long.unionByName(short), "benchmark-windows")
    lists = theirs.select(*place, "__key").distinct().groupBy(*place).agg(F.sort_array(F.collect_list("__key")).alias("__list"))
    lists = written(lists.withColumn("__set", F.sha2(F.to_json("__list"), 256)), "benchmark-lists")
    windows = written(lists.select(*place, "__set"), "windows")
    members = written(lists.dropDuplicates(["__set"]).select("__set", F.explode("__list").alias("__item")), "members")
    lengths = tuple(r[0] for r in windows.where(F.col("__n") < window).select("__n").distinct().collect())  # window - 1 rows at most
    texts = docs.select("__key", F.col("__read").alias("__text"))
    met = _spans(texts, window, k, ()).join(theirs.where(F.col("__n") == window).select("__print").distinct(), "__print", "left_semi").select("__key", "__start", *place).distinct()
    if lengths:
        met = met.unionByName(_spans(texts, window, k, lengths, prints=False).select("__key", "__start", *place))
    hits = written(met.join(windows, place).select("__key", "__start", "__n", "__set"), "window-hits")
    spot = F.struct(F.col("__start").alias("a"), F.col("__n").alias("n"))
    words = F.array_distinct(F.flatten(F.transform(F.collect_set(spot), lambda x: F.sequence(x["a"], x["a"] + x["n"] - 1))))
    covered = hits.groupBy("__key").agg(F.size(words).cast("long").alias("__hit"))
    named = hits.select("__key", "__set").distinct().join(members, "__set").groupBy("__key").agg(F.sort_array(F.collect_set("__item")).alias("__items"))
    found = written(covered.join(named, "__key"), "hit-documents")
    counts = F.size(F.expr(r"regexp_extract_all(__read, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+', 0)")).cast("long")
    listed = F.coalesce("__items", F.array().cast("array<string>"))
    return (
        docs.withColumn("n_words", counts).drop("__read").join(found, "__key", "left")
        .select(*heads, "n_words", F.coalesce("__hit", F.lit(0).cast("long")).alias("n_hit"), F.size(listed).cast("long").alias("n_items"), F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), F.col("__hit").isNotNull().alias("contaminated"))
    )

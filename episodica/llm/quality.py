"""Operator 1: quality rules and n-gram perplexity under a modified Kneser-Ney model.

Spark counts the words and the pairs of neighbouring words of each language, every
distinct text once. Pairs and words that came once alone are not stored: their mass goes
to the shorter context, so a text is not made likely by itself. What is stored grows with
the corpus: counts of pairs, back-off weights of contexts and probabilities of words, in
arrays sorted by hash.

A first pass counts pairs by hash: tasks pass on sorted runs of hashes of five bytes and a
bucket's bits, which buckets merge, keeping those that came twice. A second pass looks each
pair up there and adds up what each word was followed by and what it followed. Up to a
counted bound the arrays are broadcast; beyond it pairs are counted as rows and the texts'
pairs are joined with them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import short_batches, written
from .text import LEADS, NOT_SPACE, Chunk, any_of, chunks, find, lower_bytes, mix, owner, runs, span_hashes, sums, worker

_SYMBOLS = any_of(*((ord(c), ord(c)) for c in "#*$%&|<>"))
_LOWER, _STEP = lower_bytes(), np.uint64(0xD6E8FEB86659FD93)
NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: Pairs of the model (12 bytes each), and words of it, up to which it is broadcast.
BROADCAST_ENTRIES = 16_000_000

#: Rows of per-language figures, and of texts that have copies, up to which they are broadcast.
BROADCAST_LANGUAGES, BROADCAST_COPIES = 10_000, 1_000_000

#: Pairs, or words, that a task gathers before it passes them on.
GATHERED = 4_000_000

#: Words of the corpus for each bucket of pair hashes, which one task merges; bytes taken for a word.
BUCKET_WORDS, WORD_BYTES = 1 << 21, 6

#: Parts in which the driver fetches the model.
FETCHES = 4

#: Pairs of the model that are compressed together in a broadcast.
SENT = 1_000_000

#: Bits of a hash that are stored beside those of its bucket.
STORED = 40

#: Log probabilities are whole numbers of this part of a bit, so that sums are the same in any order.
PART = 1 << 20

#: Discounts where counts of counts are too few to give them.
USUAL = (0.5, 1.0, 1.5)


def _base(c: Chunk) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each row."""
    start, end = c.bounds[:-1], c.bounds[1:]
    solid = NOT_SPACE[c.data]
    word_start, word_end = runs(solid, c.bounds)
    whose = owner(c.bounds, word_start)
    n_words = np.bincount(whose, minlength=c.rows)
    chars = sums(solid & LEADS[c.data], start, end)
    symbols = sums(_SYMBOLS[c.data], start, end)
    # lines: a row has one more than it has line feeds
    feeds = np.flatnonzero(c.data == 10)
    line_start = np.concatenate([start, feeds + 1])
    line_row = np.concatenate([np.arange(c.rows), owner(c.bounds, feeds)])
    order = np.lexsort((line_start, line_row))
    line_start, line_row = line_start[order], line_row[order]
    last = np.append(line_row[1:] != line_row[:-1], True)
    line_end = np.where(last, end[line_row], np.append(line_start[1:], 0) - 1)
    full = sums(solid, line_start, line_end) > 0
    line_start, line_end, line_row = line_start[full], line_end[full], line_row[full]
    salt = lambda rows: mix(rows.astype(np.uint64) + np.uint64(1))
    _, first = np.unique(span_hashes(c.data, line_start, line_end) ^ salt(line_row), return_index=True)
    dup_lines = np.bincount(line_row, minlength=c.rows) - np.bincount(line_row[first], minlength=c.rows)
    # windows of three words
    cover = np.zeros(len(whose) + 1, np.int64)
    if len(whose) >= 3:
        h = span_hashes(c.data, word_start, word_end)
        three = mix(mix(mix(h[:-2]) + h[1:-1]) + h[2:]) ^ salt(whose[:-2])
        at = np.flatnonzero(whose[:-2] == whose[2:])
        _, back, n = np.unique(three[at], return_inverse=True, return_counts=True)
        at = at[n[back] > 1]
        cover[at] += 1  # each position begins one window
        cover[at + 3] -= 1
    repeated = np.bincount(whose, np.cumsum(cover[:-1]) > 0, c.rows).astype(np.int64)
    return [n_words, chars, symbols, dup_lines, repeated]


def _salt(lang: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(lang.encode(), 5)


def pairs(c: Chunk, langs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of each word (A-Z lower-cased) and of the one before it, salted with the row's language, and the row.

    The first word of a text follows a mark.
    """
    starts, ends = runs(NOT_SPACE[c.data], c.bounds)
    rows = owner(c.bounds, starts)
    salts = {x: _salt(x) for x in set(langs)}
    salt = np.array([salts[x] for x in langs], np.uint64)
    words = mix(span_hashes(c.data, starts, ends, _LOWER) + salt[rows])
    before = mix(salt)[rows]
    same = np.flatnonzero(rows[1:] == rows[:-1]) + 1
    before[same] = words[same - 1]
    return before, words, rows


def _together(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(before * _STEP + words)


def _distinct_texts(df: DataFrame, id_col: str, lang_col: str, text_col: str) -> DataFrame:
    """__lang and __text of one row of each text: of the least id (null last), then the least language.

    Only hashes are shuffled, unless very many texts have copies. Rows that repeat a text's
    least id and language are alike and become one; their texts are shuffled for that.
    """
    rows = df.select(df[id_col].alias("__id"), F.coalesce(df[lang_col], F.lit("")).alias("__lang"), df[text_col].alias("__text"), F.xxhash64(df[text_col]).alias("__hash"))
    place = F.struct(F.col("__id").isNull().alias("no"), F.col("__id").alias("id"), F.col("__lang").alias("lang"))
    counts = rows.groupBy("__hash", place.alias("__place")).agg(F.count("*").alias("n"))
    groups = counts.groupBy("__hash").agg(F.min(F.struct("__place", "n")).alias("f"), F.sum("n").alias("n")).where("n > 1")
    copies = written(groups.select(F.col("__hash").alias("__copied"), F.col("f.__place").alias("__first"), F.col("f.n").alias("__alike")), "copied-texts")
    side = F.broadcast(copies) if copies.count() <= BROADCAST_COPIES else copies
    met = rows.join(side, F.col("__hash") == F.col("__copied"), "left").where(F.col("__copied").isNull() | place.eqNullSafe(F.col("__first")))
    if copies.where("__alike > 1").isEmpty():
        return met.select("__lang", "__text")
    alike = F.coalesce(F.col("__alike"), F.lit(1)) > 1
    return met.where(~alike).select("__lang", "__text").unionByName(met.where(alike).dropDuplicates(["__hash"]).select("__lang", "__text"))


def pair_counts(texts: DataFrame) -> DataFrame:
    """lang, u, w (hashes) and n of every pair of neighbours; tasks add up what they have read before the shuffle."""

    def passed(gathered: list[tuple]) -> pa.RecordBatch:
        lang, u, w, n = (np.concatenate(x) for x in zip(*gathered, strict=True))
        gathered.clear()
        _, first, back = np.unique(_together(u, w), return_index=True, return_inverse=True)
        n = np.bincount(back, n, len(first)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(lang[first], pa.string()), pa.array(u[first].view(np.int64)), pa.array(w[first].view(np.int64)), pa.array(n)], ["lang", "u", "w", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[tuple] = []
        size = 0
        for batch in worker("quality", batches):
            names = batch.column("__lang").to_pylist()
            for c in chunks(batch.column("__text")):
                langs = names[c.first : c.last]
                u, w, rows = pairs(c, langs)
                _, first, n = np.unique(_together(u, w), return_index=True, return_counts=True)
                gathered.append((np.array(langs, object)[rows[first]], u[first], w[first], n))
                size += len(first)
                if size >= GATHERED // 4:
                    yield passed(gathered)
                    size = 0
        if gathered:
            yield passed(gathered)

    short_batches(texts.sparkSession)
    return texts.mapInArrow(run, "lang string, u long, w long, n long").groupBy("lang", "u", "w").agg(F.sum("n").alias("n"))


def _tally(n: str) -> list[Column]:
    """How many counts are one, two, three and four."""
    return [F.count_if(F.col(n) == k).alias(f"{n}{k}") for k in (1, 2, 3, 4)]


def _discounts(n: str) -> list[Column]:
    """Discounts of counts one, two and three or more, from the numbers of counts one to four."""
    y = F.col(f"{n}1") / (F.col(f"{n}1") + 2 * F.col(f"{n}2"))
    known = (F.col(f"{n}1") > 0) & (F.col(f"{n}2") > 0)
    out = []
    for k, usual in zip((1, 2, 3), USUAL, strict=True):
        own = F.least(F.lit(float(k)), F.greatest(F.lit(0.0), k - (k + 1) * y * F.col(f"{n}{k + 1}") / F.col(f"{n}{k}")))
        out.append(F.when(known & (F.col(f"{n}{k}") > 0), own).otherwise(F.lit(usual)).alias(f"d_{n}{k}"))
    return out


def _cut(n: str) -> Column:
    return F.when(F.col(n) == 1, F.col(f"d_{n}1")).when(F.col(n) == 2, F.col(f"d_{n}2")).otherwise(F.col(f"d_{n}3"))


def _language_figures(tallies: DataFrame, follow: DataFrame) -> DataFrame:
    """Discounts of each language, and the probability ``rest`` of a word that followed less than two words.

    ``tallies``: n1 to n4, how many pairs came once to four times; ``follow``: m1 to m4, how
    many words followed one to four words, ``words``, how many two or more, and ``all``, the sum.
    """
    lower = follow.select("lang", "all", "words", "m1", "m2", *_discounts("m"))
    # words that followed one word alone give all their mass away
    given = F.col("m1") + F.col("m2") * F.col("d_m2") + (F.col("words") - F.col("m2")) * F.col("d_m3")
    lower = lower.withColumn("rest", given / F.col("all") / (F.col("words") + 1))
    return written(tallies.select("lang", *_discounts("n")).join(lower, "lang"), "language-figures")


def model(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The entries (kind, u, w, cost) of a model of all languages, and each language's cost of an unknown word.

    kind 2: a pair that came twice or more; kind 1: the back-off weight of such a pair's
    first word; kind 0: a word that followed two words or more. A cost is minus the
    logarithm, in ``PART`` parts of a bit. A pair that is not stored costs what its first
    word's back-off (none: 0) and its second word do.
    """
    cost = lambda p: F.round(-F.log2(p) * PART).cast("long").alias("cost")
    follow = written(counts.groupBy("lang", "w").agg(F.count("*").alias("m")), "followers")
    lower = follow.groupBy("lang").agg(*_tally("m"), F.sum("m").alias("all"), F.count_if(F.col("m") >= 2).alias("words"))
    langs = _language_figures(counts.groupBy("lang").agg(*_tally("n")), lower)
    by_lang = F.broadcast(langs) if langs.count() <= BROADCAST_LANGUAGES else langs
    words = follow.where("m >= 2").join(by_lang, "lang").select("w", ((F.col("m") - _cut("m")) / F.col("all") + F.col("rest")).alias("p"))
    words = written(words, "word-entries")
    given = F.count_if(F.col("n") == 1) + F.count_if(F.col("n") == 2) * F.first("d_n2") + F.count_if(F.col("n") >= 3) * F.first("d_n3")
    contexts = counts.join(by_lang.select("lang", "d_n2", "d_n3"), "lang").groupBy("u").agg(F.sum("n").alias("total"), given.alias("given"), F.max("n").alias("most")).where("most >= 2")
    contexts = written(contexts.select("u", "total", (F.col("given") / F.col("total")).alias("back")), "context-entries")
    twice = counts.where("n >= 2").join(by_lang.select("lang", "rest", "d_n1", "d_n2", "d_n3"), "lang").join(contexts, "u").join(words, "w", "left")
    twice = twice.select(F.lit(2).alias("kind"), "u", "w", cost((F.col("n") - _cut("n")) / F.col("total") + F.col("back") * F.coalesce("p", "rest")))
    entries = twice.unionByName(contexts.select(F.lit(1).alias("kind"), "u", F.lit(0).cast("long").alias("w"), cost(F.col("back")))).unionByName(words.select(F.lit(0).alias("kind"), F.lit(0).cast("long").alias("u"), "w", cost(F.col("p"))))
    return written(entries, "model-entries"), langs.select("lang", cost(F.col("rest")))


def _planes(values: np.ndarray, width: int, ordered: bool = False) -> bytes:
    """The low ``width`` bytes of whole numbers, of ``ordered`` ones their steps: all first bytes before all second ones, compressed."""
    if ordered:
        values = np.diff(values, prepend=np.zeros(1, values.dtype))
    raw = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return len(raw).to_bytes(4, "little") + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def _whole(planes: bytes, width: int, ordered: bool = False) -> np.ndarray:
    size = int.from_bytes(planes[:4], "little")
    out = np.zeros((size // width, 8), np.uint8)
    if size:
        raw = pa.Codec("zstd").decompress(planes[4:], size, asbytes=True)
        out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, -1).T
    values = out.view("<u8").reshape(-1)
    return np.cumsum(values, dtype=np.uint64) if ordered else values


def _low(keys: np.ndarray) -> np.ndarray:
    """The stored bits of hashes, without those of the bucket."""
    return keys & np.uint64((1 << STORED) - 1)


def _short(keys: np.ndarray, bits: int) -> np.ndarray:
    """The bits of pair hashes that are compared: those of the bucket and the stored ones."""
    return keys >> np.uint64(64 - STORED - bits)


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of each one's numbers."""
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(n, first)


def _buckets(keys: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The buckets of sorted keys, and the first and last place of each."""
    whose = (keys >> np.uint64(STORED)).astype(np.int32)
    cuts = np.append(np.flatnonzero(np.append(True, whose[1:] != whose[:-1])), len(keys))
    return whose[cuts[:-1]], list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))


def repeated_pairs(texts: DataFrame, bits: int) -> DataFrame:
    """lang, bucket, keys and n of the pairs that came twice or more, and n1 to n4, how many came once to four times.

    A task passes on one row a language and bucket for each ``GATHERED`` pairs: hashes of
    pairs that it met once, and those of others with their counts. A bucket holds
    ``BUCKET_WORDS`` words of the corpus or fewer, so what one task merges does not grow.
    """

    def passed(gathered: dict[str, list]) -> Iterator[pa.RecordBatch]:
        for lang, parts in gathered.items():
            keys, n = _added(*(np.concatenate(x) for x in zip(*parts, strict=True)))
            whose, places = _buckets(keys)
            once, more, times = [], [], []
            for i, j in places:
                single = n[i:j] == 1
                once.append(_planes(_low(keys[i:j][single]), 5, True))
                more.append(_planes(_low(keys[i:j][~single]), 5, True))
                times.append(_planes(n[i:j][~single], 4))
            rows = [pa.array([lang] * len(once)), pa.array(whose), *(pa.array(x, pa.binary()) for x in (once, more, times))]
            yield pa.RecordBatch.from_arrays(rows, ["lang", "bucket", "once", "more", "times"])
        gathered.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: dict[str, list] = {}
        size = 0
        for batch in worker("quality", batches):
            names = batch.column("__lang").to_pylist()
            for c in chunks(batch.column("__text")):
                langs = names[c.first : c.last]
                u, w, rows = pairs(c, langs)
                keys, codes, known = _short(_together(u, w), bits), *_coded(langs)
                for i, lang in enumerate(known):
                    own, n = np.unique(keys[codes[rows] == i], return_counts=True)
                    if len(own):
                        gathered.setdefault(lang, []).append((own, n))
                        size += len(own)
                if size >= GATHERED:
                    yield from passed(gathered)
                    size = 0
        yield from passed(gathered)

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        parts = {x: [_whole(b, width, width == 5) for b in table.column(x).to_pylist()] for x, width in (("once", 5), ("more", 5), ("times", 4))}
        ones = [np.ones(len(x), np.int64) for x in parts["once"]]
        keys, n = _added(np.concatenate(parts["once"] + parts["more"]), np.concatenate(ones + [x.astype(np.int64) for x in parts["times"]]))
        kept = n >= 2
        row = [key[0].as_py(), key[1].as_py(), _planes(keys[kept], 5, True), _planes(n[kept], 4), int(kept.sum()), *(int((n == k).sum()) for k in (1, 2, 3, 4))]
        return pa.table({f.name: pa.array([x], f.type) for f, x in zip(made, row, strict=True)})

    made = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("keys", pa.binary()), ("times", pa.binary()), ("pairs", pa.int64()), *((f"n{k}", pa.int64()) for k in (1, 2, 3, 4))])
    short_batches(texts.sparkSession)
    parts = texts.mapInArrow(run, "lang string, bucket int, once binary, more binary, times binary")
    return written(parts.groupBy("lang", "bucket").applyInArrow(merged, "lang string, bucket int, keys binary, times binary, pairs long, n1 long, n2 long, n3 long, n4 long"), "repeated-pairs")


def _coded(langs: list[str]) -> tuple[np.ndarray, list[str]]:
    """Each row's place in the list of distinct languages, and that list."""
    known = sorted(set(langs))
    place = {x: i for i, x in enumerate(known)}
    return np.array([place[x] for x in langs], np.int64), known


def _fetched(table: DataFrame, bits: int, *columns: str) -> Iterator[tuple]:
    """Rows of a table of buckets, in ``FETCHES`` parts, so that the driver holds one part beside what is made of it."""
    for i in range(FETCHES):
        own = F.col("bucket").between((i << bits) // FETCHES, ((i + 1 << bits) // FETCHES) - 1)
        part = table.where(own).select("bucket", *columns).toArrow()
        yield from zip(*(part.column(x).to_pylist() for x in ("bucket", *columns)), strict=True)


class Pairs:
    """Counts of the pairs that came twice or more, in arrays sorted by hash."""

    def __init__(self, repeated: DataFrame, bits: int, size: int):
        self.bits = bits
        keys, n, at = np.zeros(size, np.uint64), np.zeros(size, np.uint32), 0
        for bucket, k, t in _fetched(repeated, bits, "keys", "times"):
            own = _whole(k, 5, True) | np.uint64(bucket << STORED)
            keys[at : at + len(own)], n[at : at + len(own)] = own, _whole(t, 4)
            at += len(own)
        order = np.argsort(keys).astype(np.uint32)
        self.keys, self.n = keys[order], n[order]

    def __getstate__(self) -> tuple:
        """Parts of ``SENT`` pairs, compressed: a broadcast is kept in a file by the driver and each executor."""
        parts = [slice(i, i + SENT) for i in range(0, len(self.keys), SENT)]
        return self.bits, len(self.keys), [(_planes(self.keys[x], 8, True), _planes(self.n[x], 4)) for x in parts]

    def __setstate__(self, state: tuple) -> None:
        self.bits, size, parts = state
        self.keys, self.n = np.zeros(size, np.uint64), np.zeros(size, np.uint32)
        for i, (keys, n) in enumerate(parts):
            own = slice(i * SENT, (i + 1) * SENT)
            self.keys[own], self.n[own] = _whole(keys, 8, True), _whole(n, 4)

    def counts(self, before: np.ndarray, words: np.ndarray) -> np.ndarray:
        """How often each pair came: one where it is not stored."""
        wanted, back = np.unique(_short(_together(before, words), self.bits), return_inverse=True)
        at = find(self.keys, wanted)
        return np.where(at >= 0, self.n[at] if len(self.n) else 1, 1)[back].astype(np.int64)


FIGURES = ("ones", "n2", "n3", "total", "m")


def word_figures(texts: DataFrame, shared, bits: int) -> DataFrame:
    """Words and marks by language and bucket: words (hashes) and ``FIGURES`` of those in a pair that came twice, or that followed two words or more; m1 to m4, ``all`` and ``words`` of all.

    ones, n2 and n3: how many words followed it once, twice and more often; total: how often
    a word followed it; m: how many words it followed. A pair that came n times adds 1/n at
    each of its places; sums are rounded to the whole numbers that they are. Words that a task
    met once, in pairs that came once, are passed on as hashes alone.
    """
    counts, parts = ("ones", "twos", "more"), ("threes", "follows")

    def passed(gathered: dict[str, list]) -> Iterator[pa.RecordBatch]:
        for lang, some in gathered.items():
            words, *values = (np.concatenate(x) for x in zip(*some, strict=True))
            words, back = np.unique(words, return_inverse=True)
            values = np.array([np.bincount(back, x, len(words)) for x in values])
            plain = (values == np.array([1, 0, 0, 0, 1])[:, None]).all(axis=0)
            whose, places = _buckets(words)
            columns: list[list[bytes]] = [[] for _ in range(7)]
            for i, j in places:
                single, rest = plain[i:j], values[:, i:j][:, ~plain[i:j]]
                whole = [_low(words[i:j][single]), _low(words[i:j][~single]), *rest[:3].astype(np.int64), *(x.copy().view(np.int64) for x in rest[3:])]
                for column, x, width in zip(columns, whole, (5, 5, 4, 4, 4, 8, 8), strict=True):
                    column.append(_planes(x, width, width == 5))
            rows = [pa.array([lang] * len(places)), pa.array(whose), *(pa.array(x, pa.binary()) for x in columns)]
            yield pa.RecordBatch.from_arrays(rows, ["lang", "bucket", "plain", "words", *counts, *parts])
        gathered.clear()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        gathered: dict[str, list] = {}
        size = 0
        for batch in worker("quality", batches):
            names = batch.column("__lang").to_pylist()
            for c in chunks(batch.column("__text")):
                langs = names[c.first : c.last]
                u, w, rows = pairs(c, langs)
                codes, langs = _coded(langs)
                n = known.counts(u, w)
                words, first, back = np.unique(_short(np.concatenate([u, w]), bits), return_index=True, return_inverse=True)
                of_u, of_w = back[: len(u)], back[len(u) :]
                part = 1 / n
                values = [np.bincount(of_u, x, len(words)) for x in (n == 1, n == 2, n > 2, part * (n > 2))]
                values.append(np.bincount(of_w, part, len(words)))
                own = codes[np.concatenate([rows, rows])[first]]
                for i, lang in enumerate(langs):
                    at = own == i
                    if at.any():
                        gathered.setdefault(lang, []).append((words[at], *(x[at] for x in values)))
                size += len(words)
                if size >= GATHERED:
                    yield from passed(gathered)
                    size = 0
        yield from passed(gathered)

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        columns = {x: np.concatenate([_whole(b, width, width == 5) for b in table.column(x).to_pylist()]) for x, width in (("plain", 5), ("words", 5), *((x, 4) for x in counts), *((x, 8) for x in parts))}
        plain = np.ones(len(columns["plain"]))
        rest = [columns[x].astype(np.float64) for x in counts] + [columns[x].view(np.float64) for x in parts]
        words, back = np.unique(np.concatenate([columns["plain"], columns["words"]]), return_inverse=True)
        ones, twos, more, threes, follows = (np.bincount(back, np.concatenate([plain * own, x]), len(words)) for own, x in zip((1, 0, 0, 0, 1), rest, strict=True))
        n2, n3, m = (np.rint(x).astype(np.int64) for x in (twos / 2, threes, follows))
        kept = (m >= 2) | (n2 + n3 > 0)
        figures = [ones, n2, n3, ones + twos + more, m]
        row = [key[0].as_py(), key[1].as_py(), int(kept.sum()), _planes(words[kept], 5, True), *(_planes(x[kept].astype(np.int64), 6) for x in figures), *(int((m == k).sum()) for k in (1, 2, 3, 4)), int(m.sum()), int((m >= 2).sum())]
        return pa.table({f.name: pa.array([x], f.type) for f, x in zip(made, row, strict=True)})

    made = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("entries", pa.int64()), ("hashes", pa.binary()), *((x, pa.binary()) for x in FIGURES), *((x, pa.int64()) for x in ("m1", "m2", "m3", "m4", "all", "words"))])
    out = texts.mapInArrow(run, "lang string, bucket int, plain binary, words binary, " + ", ".join(f"{x} binary" for x in counts + parts))
    out = out.groupBy("lang", "bucket").applyInArrow(merged, "lang string, bucket int, entries long, hashes binary, " + ", ".join(f"{x} binary" for x in FIGURES) + ", m1 long, m2 long, m3 long, m4 long, all long, words long")
    return written(out, "word-figures")


class Words:
    """Figures of words and languages, in arrays sorted by hash."""

    def __init__(self, words: DataFrame, langs: DataFrame, bits: int):
        by_lang = {r["lang"]: r for r in langs.collect()}
        self.bits = bits
        self.langs = {x: (r["rest"], r["d_n2"], r["d_n3"]) for x, r in by_lang.items()}
        made = [(np.zeros(0, np.uint64), *[np.zeros(0)] * 3)]
        for bucket, lang, hashes, *planes in _fetched(words.where("entries > 0"), bits, "lang", "hashes", *FIGURES):
            r = by_lang[lang]
            ones, n2, n3, total, m = (_whole(x, 6).astype(np.float64) for x in planes)
            back = np.where(n2 + n3 > 0, ones + n2 * r["d_n2"] + n3 * r["d_n3"], 0) / np.maximum(total, 1)
            p = np.where(m >= 2, (m - np.where(m == 2, r["d_m2"], r["d_m3"])) / r["all"] + r["rest"], 0)
            made.append((_whole(hashes, 5, True) | np.uint64(bucket << STORED), total, back, p))
        keys, *rest = (np.concatenate(x) for x in zip(*made, strict=True))
        order = np.argsort(keys)
        self.words = keys[order]
        self.total, self.back, self.p = (x[order] for x in rest)

    def costs(self, before: np.ndarray, words: np.ndarray, n: np.ndarray, figures: np.ndarray) -> np.ndarray:
        """The cost of each word after the one before it; n: how often that pair came; ``figures``: rest and discounts of its language."""
        cost = lambda p: np.rint(-np.log2(p) * PART).astype(np.int64)
        rest, two, three = figures.T
        pad = lambda x, absent: np.append(x, absent)  # noqa: E731  (place -1: what is not stored)
        at_u, at_w = (find(self.words, _short(x, self.bits)) for x in (before, words))
        back, total, p = pad(self.back, 0)[at_u], pad(self.total, 0)[at_u], pad(self.p, 0)[at_w]
        p = np.where(p > 0, p, rest)
        again = n >= 2
        out = cost(np.where(back > 0, back, 1)) + cost(p)
        out[again] = cost((n[again] - np.where(n[again] == 2, two[again], three[again])) / total[again] + back[again] * p[again])
        return out


def counted(texts: DataFrame, size: int, bound: int) -> tuple[Broadcast, Broadcast] | None:
    """The model in sorted arrays (``Pairs`` and ``Words``), or None if it has over ``bound`` pairs or words. ``size``: bytes of all texts."""
    context = texts.sparkSession.sparkContext
    bits = min(24, max(8, math.ceil(math.log2(max(1, size) / WORD_BYTES / BUCKET_WORDS))))
    repeated = repeated_pairs(texts, bits)
    entries = lambda df, name: df.agg(F.coalesce(F.sum(name), F.lit(0))).first()[0]
    if (n := entries(repeated, "pairs")) > bound:
        return None
    known = context.broadcast(Pairs(repeated, bits, n))
    words = word_figures(texts, known, bits)
    tallies = repeated.groupBy("lang").agg(*(F.sum(f"n{k}").alias(f"n{k}") for k in (1, 2, 3, 4)))
    lower = words.groupBy("lang").agg(*(F.sum(x).alias(x) for x in ("m1", "m2", "m3", "m4", "all", "words")))
    langs = _language_figures(tallies, lower)
    if langs.count() > BROADCAST_LANGUAGES or entries(words, "entries") > bound:
        return None
    return known, context.broadcast(Words(words, langs, bits))


def _scored(df: DataFrame, arrays: tuple[Broadcast, Broadcast], id_col: str, lang_col: str, text_col: str) -> DataFrame:
    """__id, __lang, the base counts and __cost of every row, under a broadcast model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, figures = (x.value for x in arrays)
        for batch in worker("quality", batches):
            names = batch.column("__lang").to_pylist()
            for c in chunks(batch.column("__text")):
                langs = names[c.first : c.last]
                u, w, rows = pairs(c, langs)
                by_row = np.array([figures.langs.get(x, (1.0, *USUAL[1:])) for x in langs], np.float64).reshape(-1, 3)
                total = np.zeros(c.rows, np.int64)
                np.add.at(total, rows, figures.costs(u, w, known.counts(u, w), by_row[rows]))
                yield pa.RecordBatch.from_arrays([batch.column("__id").slice(c.first, c.rows), batch.column("__lang").slice(c.first, c.rows), *(pa.array(x.astype(np.int64)) for x in _base(c)), pa.array(total)], ["__id", "__lang", *NAMES, "__cost"])

    source = df.select(df[id_col].alias("__id"), F.coalesce(df[lang_col], F.lit("")).alias("__lang"), df[text_col].alias("__text"))
    return source.mapInArrow(run, f"__id {dict(source.dtypes)['__id']}, __lang string, {', '.join(f'{x} long' for x in NAMES)}, __cost long")


def _scored_by_joins(df: DataFrame, entries: DataFrame, unknown: DataFrame, id_col: str, lang_col: str, text_col: str) -> DataFrame:
    """As ``_scored``, for a model of any size: the texts' pairs meet its entries in joins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in worker("quality", batches):
            names = batch.column("__lang").to_pylist()
            for c in chunks(batch.column("__text")):
                u, w, rows = pairs(c, names[c.first : c.last])
                bounds = pa.array(np.searchsorted(rows, np.arange(c.rows + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(bounds, pa.array(x.view(np.int64))) for x in (u, w)]
                yield pa.RecordBatch.from_arrays([batch.column("__id").slice(c.first, c.rows), batch.column("__lang").slice(c.first, c.rows), *(pa.array(x.astype(np.int64)) for x in _base(c)), *lists], ["__id", "__lang", *NAMES, "__us", "__ws"])

    source = df.select(df[id_col].alias("__id"), F.coalesce(df[lang_col], F.lit("")).alias("__lang"), df[text_col].alias("__text"))
    rows = source.mapInArrow(run, f"__id {dict(source.dtypes)['__id']}, __lang string, {', '.join(f'{x} long' for x in NAMES)}, __us array<long>, __ws array<long>")
    rows = written(rows.withColumn("__row", F.monotonically_increasing_id()), "text-pairs")  # written: numbers stay as they are
    met = rows.select("__row", "__lang", F.explode(F.arrays_zip("__us", "__ws")).alias("p")).select("__row", "__lang", F.col("p.__us").alias("u"), F.col("p.__ws").alias("w"))
    met = met.groupBy("__row", "__lang", "u", "w").agg(F.count("*").alias("n"))
    part = lambda kind, name, *keys: entries.where(F.col("kind") == kind).select(*keys, F.col("cost").alias(name))
    met = met.join(part(2, "pair", "u", "w"), ["u", "w"], "left").join(part(1, "back", "u"), "u", "left").join(part(0, "word", "w"), "w", "left")
    met = met.join(unknown.withColumnsRenamed({"lang": "__lang", "cost": "unknown"}), "__lang", "left")
    own = F.coalesce("pair", F.coalesce("back", F.lit(0)) + F.coalesce("word", "unknown"))
    costs = written(met.groupBy("__row").agg(F.sum(own * F.col("n")).alias("__cost")), "text-costs")
    return rows.join(costs, "__row", "left").select("__id", "__lang", *NAMES, F.coalesce("__cost", F.lit(0)).alias("__cost"))


def quality(df: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", low_width: float = 9.0, high_width: float = 3.0, least_spread: float = 0.75, low_share: float = 0.001, low_margin: float = 0.25, broadcast_entries: int = BROADCAST_ENTRIES) -> DataFrame:
    """Base counts, perplexity and the verdict for every row.

    base_failed: under 50 words, or over half of the words in repeated windows of three.
    A text that passes is kept if the logarithm of its perplexity (of a word) lies in its
    language's band: the median of all texts that pass, ``low_width`` and ``high_width`` times
    their scaled median absolute deviation (``least_spread`` bits at least) below and above.
    Below, the band also ends with the language's own tail: ``low_margin`` deviations under the
    value that ``low_share`` of its texts (three at least) do not exceed. Near copies of clean
    texts reach far down, texts that repeat themselves farther.
    The model counts each distinct text once, so copies do not make each other likely. Null and empty texts have
    no words and fail the base; a null language is a language of its own; repeated rows, ties
    and null ids are kept, one row out for each row in; other columns are not read. An empty
    table gives an empty result; a text of any length is read whole, a long one alone.
    """
    spark = df.sparkSession
    short_batches(spark)
    texts = _distinct_texts(df, id_col, lang_col, text_col)
    size = df.agg(F.coalesce(F.sum(F.octet_length(df[text_col])), F.lit(0))).first()[0]
    if (arrays := counted(texts, size, broadcast_entries)) is not None:
        scored = _scored(df, arrays, id_col, lang_col, text_col)
    else:
        entries, unknown = model(written(pair_counts(texts), "pair-counts"))
        scored = _scored_by_joins(df, entries, unknown, id_col, lang_col, text_col)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    bits = F.when(F.col("n_words") > 0, F.col("__cost") / F.col("n_words") / PART)
    rows = written(scored.withColumns({"base_failed": failed, "__bits": bits}), "scored")
    step = 0.001
    bins = rows.where(~F.col("base_failed")).groupBy("__lang", F.floor(F.col("__bits") / step).alias("bin")).agg(F.count("*").alias("n"))
    middle = _quantile(bins, "bin").withColumnRenamed("quantile", "__middle")
    tail = _quantile(bins, "bin", low_share, 3).withColumnRenamed("quantile", "__tail")
    away = bins.join(middle, "__lang").groupBy("__lang", F.abs(F.col("bin") - F.col("__middle")).alias("bin")).agg(F.sum("n").alias("n"))
    spread = _quantile(away, "bin").withColumnRenamed("quantile", "__away")
    margin = F.greatest(F.lit(least_spread), F.col("__away") * (1.4826 * step))
    centre = (F.col("__middle") + 0.5) * step
    low = F.greatest(centre - low_width * margin, F.col("__tail") * step - low_margin * margin)
    band = middle.join(spread, "__lang").join(tail, "__lang").select("__lang", low.alias("low_bits"), (centre + high_width * margin).alias("high_bits"))
    band = written(band, "bands")
    judged = rows.join(F.broadcast(band) if band.count() <= BROADCAST_LANGUAGES else band, "__lang", "left")
    inside = F.coalesce(F.col("__bits").between(F.col("low_bits"), F.col("high_bits")), F.lit(False))
    return judged.select(F.col("__id").alias(id_col), *NAMES, "base_failed", (~F.col("base_failed") & inside).alias("kept"), F.pow(F.lit(2.0), F.col("__bits")).alias("perplexity"), F.pow(F.lit(2.0), F.col("low_bits")).alias("low"), F.pow(F.lit(2.0), F.col("high_bits")).alias("high"))


def _quantile(bins: DataFrame, value: str, share: float = 0.5, least: int = 1) -> DataFrame:
    """The value that ``share`` of a histogram's counts, ``least`` at least, do not exceed, by language; a language has as many rows as its figures have bins."""
    whole = Window.partitionBy("__lang")
    sums = bins.withColumn("__sum", F.sum("n").over(whole.orderBy(value))).withColumn("__all", F.sum("n").over(whole))
    return sums.where(F.col("__sum") >= F.least(F.col("__all"), F.greatest(F.lit(least), share * F.col("__all")))).groupBy("__lang").agg(F.min(value).alias("quantile"))

"""Operator 10: language identification with string kernels.

The kernel of two texts is the number of byte runs of length 1 to 3 that both hold
(blended spectrum, presence), divided by the root of the product of their numbers
of distinct runs. Landmarks, a bounded number of texts, give Nystrom features; kernel
ridge regression on those of all labelled texts, one language against the rest, gives a
weight for each landmark and language. Tasks add up products of features; the driver
solves a system of the landmarks' size. As the kernel is linear in presence, weights fold into one
matrix of runs by languages, and a batch of texts is scored by one product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Carried, short_batches
from .text import Chunk, any_of, chunks, held, owner, worker

ORDERS = (1, 2, 3)
RESULTS = ("held_out", "lang_pred", "score")
BLOCK_BYTES, BLOCK_ROWS = 1 << 18, 128
#: Features and scores are whole numbers of this part when they are added up or counted, so that sums do not depend on their order.
UNIT = 1 << 16
_ASCII_LETTER = any_of((0x41, 0x5A), (0x61, 0x7A))


def _fold() -> np.ndarray:
    """Letters without case; all other ASCII is a blank."""
    out = np.arange(256, dtype=np.uint32)
    out[:128] = 32
    out[97:123] = np.arange(97, 123)
    out[65:91] = np.arange(97, 123)
    return out


_FOLD = _fold()


def grams(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Row and code (order, then bytes) of every run of every order."""
    s, rows, codes = _FOLD[c.data], [], []
    whose = owner(c.bounds, np.arange(len(s)))
    for n in ORDERS:
        size = len(s) - n + 1
        if size <= 0:
            continue
        code = np.full(size, n << 24, np.uint32)
        for i in range(n):
            code |= s[i : i + size] << np.uint32(8 * (n - 1 - i))
        fits = whose[:size] == whose[n - 1 :]
        rows.append(whose[:size][fits])
        codes.append(code[fits])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint32)
    return np.concatenate(rows), np.concatenate(codes)


def _presence(texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """All distinct codes, and the codes of each text."""
    sets: list[np.ndarray] = []
    for c in chunks(pa.array(texts, pa.string())):
        rows, codes = grams(c)
        pairs = np.unique(rows.astype(np.uint64) << np.uint64(32) | codes)
        sets += np.split((pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.searchsorted(pairs >> np.uint64(32), np.arange(1, c.rows)))
    return np.unique(np.concatenate(sets)), sets


@dataclass
class Landmarks:
    """Texts that others are compared with: their runs, and the map from kernel rows to features of unit length at most."""

    codes: np.ndarray
    basis: np.ndarray
    size: np.ndarray
    root: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Landmarks:
        codes, sets = _presence(texts)
        basis = np.zeros((len(texts), len(codes)), np.float32)
        for row, own in zip(basis, sets, strict=True):
            row[np.searchsorted(codes, own)] = 1
        size = np.sqrt([max(1, len(own)) for own in sets])
        values, vectors = np.linalg.eigh((basis @ basis.T) / np.outer(size, size))
        good = values > 1e-6 * values[-1]
        return cls(codes, basis, size, vectors[:, good] / np.sqrt(values[good]))

    def features(self, c: Chunk) -> np.ndarray:
        seen, size = _present(self.codes, c)
        # counts of common runs are whole numbers, whatever the texts beside them
        return ((seen @ self.basis.T) / np.outer(np.sqrt(np.maximum(1, size)), self.size)) @ self.root

    def classifier(self, langs: list[str], squares: np.ndarray, sums: np.ndarray, ridge: float) -> KernelClassifier:
        """Ridge regression from the sum of features' products and each language's sum of features."""
        wanted = 2 * sums.T - sums.sum(axis=0)[:, None]  # 1 for the language, -1 for the rest
        solved = np.linalg.solve(squares + ridge * np.eye(len(squares)), wanted)
        return KernelClassifier(langs, self.codes, (self.basis.T @ ((self.root @ solved) / self.size[:, None])).astype(np.float32))


@dataclass
class KernelClassifier:
    langs: list[str]
    codes: np.ndarray
    weights: np.ndarray
    #: Score under which a text is likely in none of the languages, see ``fit``.
    least: float = 0.0

    @classmethod
    def fit(cls, texts: list[str], labels: list[str], landmarks: int, ridge: float) -> KernelClassifier:
        """From texts at hand. The first texts of each language, in turn, are the landmarks."""
        langs = sorted(set(labels))
        if not langs:
            return cls.empty()
        seen: dict[str, int] = {}
        turn = []
        for i, x in enumerate(labels):
            turn.append((seen.setdefault(x, 0), x, i))
            seen[x] += 1
        marks = Landmarks.of([texts[i] for *_, i in sorted(turn)[: _marks(landmarks, langs)]])
        features = np.concatenate([marks.features(block) for c in chunks(pa.array(texts, pa.string()), BLOCK_BYTES) for block, _ in _blocks(c)])
        own = np.array(labels)[:, None] == np.array(langs)[None, :]
        return marks.classifier(langs, features.T @ features, own.T @ features, ridge)

    @classmethod
    def empty(cls) -> KernelClassifier:
        return cls([], np.zeros(0, np.uint32), np.zeros((0, 0), np.float32))

    def leads(self, c: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """The best language of each text, and half its lead over the next, between 0 and 1."""
        scores = self.score(c)
        top = np.sort(scores, axis=1)
        return scores.argmax(axis=1), np.clip((top[:, -1] - (top[:, -2] if len(self.langs) > 1 else -1)) / 2, 0, 1)

    def score(self, c: Chunk) -> np.ndarray:
        seen, size = _present(self.codes, c)
        return (seen @ self.weights) / np.sqrt(np.maximum(1, size))[:, None]


def _marks(landmarks: int, langs: list[str]) -> int:
    return max(landmarks, 2 * len(langs))  # each language has two at least


def _tables(codes: np.ndarray) -> list[np.ndarray]:
    mine = held("langid")
    if mine.get("codes") is not codes:
        mine["codes"], mine["tables"] = codes, []
        for n in ORDERS:
            table = np.full(1 << 8 * n, -1, np.int32)
            at = np.flatnonzero(codes >> 24 == n)
            table[codes[at] & 0xFFFFFF] = at
            mine["tables"].append(table)
    return mine["tables"]


def _present(known_codes: np.ndarray, c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Texts by known runs, and each text's number of distinct runs, known or not."""
    rows, codes = grams(c)
    at = np.full(len(codes), -1, np.int32)
    order = codes >> 24
    for n, table in zip(ORDERS, _tables(known_codes), strict=True):
        own = order == n
        at[own] = table[codes[own] & 0xFFFFFF]
    out = np.zeros((c.rows, len(known_codes)), np.float32)
    known = at >= 0
    out[rows[known], at[known]] = 1
    rest = np.unique(rows[~known].astype(np.uint64) << np.uint64(32) | codes[~known])
    unknown = np.bincount((rest >> np.uint64(32)).astype(np.int64), minlength=c.rows)
    return out, out.sum(axis=1) + unknown


def _blocks(c: Chunk) -> Iterator[tuple[Chunk, int]]:
    for first in range(0, c.rows, BLOCK_ROWS):
        last = min(first + BLOCK_ROWS, c.rows)
        a, b = c.bounds[first], c.bounds[last]
        yield Chunk(c.first + first, c.first + last, c.data[a:b], c.bounds[first : last + 1] - a, c.null[first:last]), first


def held_out(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string")) % 3 == 1


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", landmarks: int = 128, ridge: float = 1e-3, share: float | None = 0.01) -> KernelClassifier:
    """Learn from all labelled, not held-out texts.

    The landmarks are those least by a hash of the id, each language in turn; ties of the hash
    go by id, then by the text's hash. Rows with a null text or language are not learned from;
    repeated rows are one landmark, but weigh as often as they come. An empty table gives a
    classifier that knows no language.

    ``least`` is learned from all these texts too: two classifiers, each of the half of them by a
    hash, score the other half's texts, and it is half the score that ``share`` of these do not
    reach (without a ``share`` it is 0, and not looked for). Texts of another script, language
    or of random letters score near 0.
    """
    short_batches(df.sparkSession)
    labelled = df.where(df[lang_col].isNotNull() & df[text_col].isNotNull() & ~held_out(df[id_col]))
    labelled = labelled.select(df[id_col].alias("id"), df[lang_col].alias("lang"), df[text_col].alias("text"), F.xxhash64(df[id_col]).alias("order"), F.xxhash64(df[text_col]).alias("hash"))
    langs = sorted(r["lang"] for r in labelled.select("lang").distinct().collect())  # a row for each language
    if not langs:
        return KernelClassifier.empty()
    turn = F.dense_rank().over(Window.partitionBy("lang").orderBy("order", "id", "hash"))
    ranked = labelled.select("id", "lang", "order", "hash").withColumn("turn", turn).where(F.col("turn") <= landmarks)
    chosen = ranked.distinct().orderBy("turn", "lang").limit(_marks(landmarks, langs)).withColumnsRenamed({"id": "__id", "lang": "__lang", "hash": "__hash"}).drop("order")
    same = F.col("id").eqNullSafe(F.col("__id")) & (F.col("lang") == F.col("__lang")) & (F.col("hash") == F.col("__hash"))
    found = labelled.join(F.broadcast(chosen), same).groupBy("turn", "lang").agg(F.min("text").alias("text")).collect()  # as many rows as landmarks
    marks = Landmarks.of([r["text"] for r in sorted(found, key=lambda r: (r["turn"], r["lang"]))])
    texts = labelled.select("text", "lang", (F.xxhash64("id", "hash") % 2 == 0).cast("int").alias("half"))
    squares, sums, counts = _added(texts, marks, langs)
    out = marks.classifier(langs, squares.sum(axis=0), sums.sum(axis=0), ridge)
    if share is not None and counts.any(axis=1).all():
        halves = []
        for half in (0, 1):
            own = np.flatnonzero(counts[half])
            halves.append(marks.classifier([langs[i] for i in own], squares[half], sums[half][own], ridge))
        out.least = _least(texts, halves, share)
    return out


def _added(texts: DataFrame, marks: Landmarks, langs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each half of the texts the sum of features' products; the sum of features and the number of texts by language."""
    size, upper = marks.root.shape[1], np.triu_indices(marks.root.shape[1])
    sent = texts.sparkSession.sparkContext.broadcast((marks, {x: i for i, x in enumerate(langs)}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number = sent.value
        squares = np.zeros((2, size, size), np.int64)
        sums = np.zeros((2, len(number), size + 1), np.int64)
        for batch in worker("langid", batches):
            halves, names = batch.column("half").to_numpy(), np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
            for whole in chunks(batch.column("text"), BLOCK_BYTES):
                for c, _ in _blocks(whole):
                    features = np.rint(own.features(c) * UNIT)
                    for half in (0, 1):
                        rows = halves[c.first : c.first + c.rows] == half
                        some = features[rows]
                        squares[half] += (some.T @ some).astype(np.int64)  # whole numbers below 2^53
                        np.add.at(sums[half], names[c.first : c.first + c.rows][rows], np.column_stack([some, np.ones(len(some))]).astype(np.int64))
        columns = {"half": [], "lang": [], "values": []}
        for half in (0, 1):
            for lang in [-1, *np.flatnonzero(sums[half, :, size]).tolist()] if sums[half].any() else []:
                columns["half"].append(half)
                columns["lang"].append(lang)
                columns["values"].append(squares[half][upper] if lang < 0 else sums[half, lang])
        yield pa.RecordBatch.from_arrays([pa.array(columns["half"], pa.int32()), pa.array(columns["lang"], pa.int32()), pa.array(columns["values"], pa.list_(pa.int64()))], list(columns))

    parts = texts.mapInArrow(run, "half int, lang int, values array<long>").select("half", "lang", F.posexplode("values").alias("at", "value"))
    got = parts.groupBy("half", "lang", "at").agg(F.sum("value").alias("value")).toArrow()  # landmarks x (landmarks + languages) rows at most
    half, lang, at, value = (got.column(c).to_numpy() for c in ("half", "lang", "at", "value"))
    squares, sums = np.zeros((2, size, size)), np.zeros((2, len(langs), size + 1))
    flat = lang < 0
    squares[half[flat], upper[0][at[flat]], upper[1][at[flat]]] = value[flat]
    squares[half[flat], upper[1][at[flat]], upper[0][at[flat]]] = value[flat]
    sums[half[~flat], lang[~flat], at[~flat]] = value[~flat]
    return squares / UNIT**2, sums[:, :, :size] / UNIT, sums[:, :, size]


def _least(texts: DataFrame, halves: list[KernelClassifier], share: float) -> float:
    """Half the ``share`` quantile of the scores that all texts get from the classifier of the other half, to parts of ``UNIT``."""
    sent = texts.sparkSession.sparkContext.broadcast(halves)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = sent.value
        for batch in worker("langid", batches):
            half = batch.column("half").to_numpy()
            for whole in chunks(batch.column("text"), BLOCK_BYTES):
                for c, _ in _blocks(whole):
                    leads = np.where(half[c.first : c.first + c.rows] == 0, both[1].leads(c)[1], both[0].leads(c)[1])
                    yield pa.RecordBatch.from_arrays([pa.array(np.floor(leads * UNIT).astype(np.int64))], ["score"])

    found = texts.mapInArrow(run, "score long").groupBy("score").agg(F.count("*").alias("n")).orderBy("score").toArrow()  # UNIT + 1 rows at most
    scores, ends = found.column("score").to_numpy(), np.cumsum(found.column("n").to_numpy())
    place = share * (ends[-1] - 1)
    below, above = (scores[np.searchsorted(ends, int(i), "right")] for i in (np.floor(place), np.ceil(place)))
    return float(below + (above - below) * (place % 1)) / UNIT / 2


def identify(df: DataFrame, classifier: KernelClassifier, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """held_out, lang_pred and score of every row, from its whole text alone.

    score is half the lead of the best language over the next, between 0 and 1. A null
    text, and one without a letter of any script, is `und` with score 0, as is all if
    nothing was labelled. A null id is not held out; repeated rows, ties (the first
    language by name) and null ids are kept, one row out for each row in, with the
    columns in ``keep`` (a name that a result has gets an underscore). The model's size is that
    of the landmarks' runs. An empty table gives an empty result; texts of any length are
    scored whole, a long one alone.
    """
    shared = df.sparkSession.sparkContext.broadcast(classifier)
    carried = Carried(df, id_col, text_col, keep, RESULTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in worker("langid", batches):
            for whole in chunks(batch.column(carried.text), BLOCK_BYTES):
                for c, _ in _blocks(whole):
                    letters = np.zeros(c.rows, bool)
                    letters[owner(c.bounds, np.flatnonzero(_ASCII_LETTER[c.data]))] = True
                    for i in np.flatnonzero(~letters).tolist():
                        letters[i] = any(map(str.isalpha, c.text(i).decode("utf-8")))
                    letters &= len(model.langs) > 0
                    langs, lead = np.full(c.rows, "und", object), np.zeros(c.rows)
                    if model.langs:
                        best, lead = model.leads(c)
                        langs[letters] = np.array(model.langs, object)[best[letters]]
                    lead = np.where(letters, lead, 0.0)
                    yield pa.RecordBatch.from_arrays([*carried.parts(batch, c.first, c.rows), pa.array(langs, pa.string()), pa.array(lead)], [*carried.heads, "lang_pred", "score"])

    short_batches(df.sparkSession)
    out = carried.source.mapInArrow(run, carried.schema + ", lang_pred string, score double")
    head = F.col(carried.short[id_col])
    return carried.named(out.withColumn("held_out", F.coalesce(held_out(head), F.lit(False))))

"""Operator 12: the Jaccard join of n-gram sets by a prefix tree.

A set's shingles are put into one global order, in which shingles of many sets come last.
Two sets of the similarity share a shingle among the first of both (their prefixes), so sets
meet there. Sets that met are compared along a prefix tree: the sorted order of the ordered
sets is that tree, depth first, so a task that reads it holds one probe and one path.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shared import short_batches, written
from .simhash import SIMILARITY, _sets
from .text import chunks, find, spread, worker

#: Prefixes that a shingle is in from which it counts as frequent and goes to the end of the order.
FREQUENT = 4

#: Frequent shingles whose place is broadcast, most frequent first (8 bytes and 4 for each); the others stay in order of their hashes.
PLACES = 500_000

#: Bits of a set's parity sketch: two sets differ in as many shingles at least as their sketches do in bits.
SKETCH = 512

#: Bits of the sketch that pairs pass before their sets are brought together; folded it is the short one, which tells sets of up to 1,100 shingles apart.
FINE = 2048

#: Keys (ids, sets or shingles) by which rows are chosen, that are broadcast; beyond them, rows are shuffled to meet the keys.
KEYS = 1_000_000

#: Rounds in which frequent shingles are looked for: one that has left the prefixes makes room for others.
ROUNDS = 2

#: Times that sets which are not under one root are compared with another set of each of their shingles, one each, before all of them meet.
MEETINGS = 4

#: Sets that meet one probe in a task; a probe that meets more is sent to several.
SPLIT = 512

#: Shingles before one that a set brings to where all meet: two sets that share one of them met there, so that a pair seldom comes twice.
BEFORE = 8

Order = tuple[np.ndarray, np.ndarray]  # frequent shingles, sorted, and their places
NODE = ("hi", "lo")
BITS = [f"b{i}" for i in range(SKETCH // 64)]


def _needed(n: np.ndarray, similarity: tuple[int, int]) -> np.ndarray:
    """The least intersection of a set of n with any similar one."""
    over, under = similarity
    return -(-over * n // under)


def _ordered(hashes: np.ndarray, bounds: np.ndarray, order: Order) -> np.ndarray:
    """Each set's hashes (sorted) in the global order: place, then hash."""
    at = find(order[0], hashes)
    if not (at >= 0).any():
        return hashes
    places = np.where(at >= 0, order[1][at], -1)
    return hashes[np.lexsort((hashes, places, np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))))]


def _digests(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set as two longs, zero for an empty one."""
    import xxhash

    out = np.zeros((2, len(bounds) - 1), np.uint64)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if a < b:
            whole = xxhash.xxh3_128_intdigest(hashes[a:b].tobytes())
            out[:, i] = whole >> 64, whole & 0xFFFFFFFFFFFFFFFF
    return out[0].view(np.int64), out[1].view(np.int64)


def _sketches(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of longs for each set, its fine sketch: bit j is the parity of the shingles that fall to j."""
    out = np.zeros((len(bounds) - 1, FINE // 64), np.int64)
    for first in range(0, len(out), 1024):
        some = bounds[first : first + 1025]
        rows = np.repeat(np.arange(len(some) - 1), np.diff(some))
        at = rows * FINE + (hashes[some[0] : some[-1]] >> np.uint64(20)).astype(np.int64) % FINE
        odd = np.bincount(at, minlength=(len(some) - 1) * FINE).astype(np.uint8) & 1
        out[first : first + 1024] = np.packbits(odd).view(np.int64).reshape(-1, FINE // 64)
    return out


def _folded(fine: np.ndarray) -> list[np.ndarray]:
    """A long column for each 64 bits of the short sketches."""
    short = np.bitwise_xor.reduce(fine.reshape(len(fine), -1, SKETCH // 64), axis=1)
    return list(np.ascontiguousarray(short.T))


def _heads(hashes: np.ndarray, bounds: np.ndarray, similarity: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Where the prefixes of all sets are, and their sizes; none for a set that only equal ones reach."""
    over, under = similarity
    n = np.diff(bounds)
    sizes = np.where((under - over) * n >= over, n - _needed(n, similarity) + 1, 0)
    return spread(bounds[:-1], sizes), sizes


def _chosen_by(keys: DataFrame, most: int) -> DataFrame:
    """Keys for a left semi join: broadcast if they are few."""
    return F.broadcast(keys) if keys.count() <= most else keys


class _Texts:
    """The text column of a table, read anew for each pass, as sets are larger than texts."""

    def __init__(self, df: DataFrame, id_col: str, text_col: str, shingle: int, similarity: tuple[int, int], keys: int = KEYS):
        short_batches(df.sparkSession)
        self.source = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
        self.kind = dict(self.source.dtypes)["id"]
        self.shingle, self.similarity, self.keys = shingle, similarity, keys

    def rows(self) -> DataFrame:
        """id, the digest of the set, its size and its sketches, of every row."""
        shingle = self.shingle

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in worker("jaccard", batches):
                for c in chunks(batch.column("text")):
                    hashes, bounds = _sets(c, shingle)
                    fine = _sketches(hashes, bounds)
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(fine) + 1, dtype=np.int32) * fine.shape[1]), pa.array(fine.ravel()))
                    yield pa.RecordBatch.from_arrays([batch.column("id").slice(c.first, c.rows), *map(pa.array, (*_digests(hashes, bounds), np.diff(bounds), *_folded(fine))), lists], ["id", *NODE, "n", *BITS, "fine"])

        return self.source.mapInArrow(run, f"id {self.kind}, hi long, lo long, n long, " + ", ".join(f"{b} long" for b in BITS) + ", fine array<long>")

    def counted(self, now: Order, before: Order | None = None) -> DataFrame:
        """token and c, the rows with it in their prefix by the order ``now``, but not by ``before``."""
        shingle, similarity = self.shingle, self.similarity
        orders = [self._sent(x) for x in (now, before) if x is not None]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in worker("jaccard", batches):
                for c in chunks(batch.column("text")):
                    hashes, bounds = _sets(c, shingle)
                    at, sizes = _heads(hashes, bounds, similarity)
                    tokens = _ordered(hashes, bounds, orders[0].value)[at]
                    if len(orders) > 1:
                        old = _ordered(hashes, bounds, orders[1].value)[at]
                        # both hold one prefix after the other, of the same sizes: what is new is in the first alone
                        whose = np.repeat(np.arange(c.rows), sizes)
                        tokens = tokens[_new(tokens, old, whose)]
                    tokens, counts = np.unique(tokens, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(counts)], ["token", "c"])

        return self.source.mapInArrow(run, "token long, c long").groupBy("token").agg(F.sum("c").alias("c"))

    def postings(self, order: Order) -> DataFrame:
        """token, the set it is in the prefix of, its place there and the set's size; a task gives each distinct set once."""
        shingle, similarity, sent = self.shingle, self.similarity, self._sent(order)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[tuple[int, int]] = set()
            for batch in worker("jaccard", batches):
                for c in chunks(batch.column("text")):
                    hashes, bounds = _sets(c, shingle)
                    hi, lo = _digests(hashes, bounds)
                    at, sizes = _heads(hashes, bounds, similarity)
                    tokens = _ordered(hashes, bounds, sent.value)[at]
                    fresh = np.zeros(c.rows, bool)
                    for i, key in enumerate(zip(hi.tolist(), lo.tolist(), strict=True)):
                        if sizes[i] and key not in seen:
                            seen.add(key)
                            fresh[i] = True
                    whose = np.repeat(np.arange(c.rows), sizes)
                    places = at - bounds[whose]
                    some = fresh[whose]
                    whose = whose[some]
                    columns = (tokens[some].view(np.int64), hi[whose], lo[whose], np.diff(bounds)[whose], places[some])
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], ["token", *NODE, "n", "at"])

        return self.source.mapInArrow(run, "token long, hi long, lo long, n long, at long")

    def sets(self, wanted: DataFrame, rows: DataFrame, order: Order) -> DataFrame:
        """hi, lo, n and the ordered set of every wanted node, once, perhaps of others too; only rows whose id one of them has are read on."""
        shingle, sent = self.shingle, self._sent(order)
        one = written(rows.join(wanted, [*NODE], "left_semi").groupBy(*NODE).agg(F.min("id").alias("one")), "jaccard-one")
        ids = _chosen_by(one.select("one").distinct(), self.keys)  # null where all rows of a set have no id
        nulls = not one.where("one IS NULL").isEmpty()
        same = F.col("id").eqNullSafe(F.col("one")) if nulls else F.col("id") == F.col("one")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in worker("jaccard", batches):
                for c in chunks(batch.column("text")):
                    hashes, bounds = _sets(c, shingle)
                    hi, lo = _digests(hashes, bounds)
                    hashes = _ordered(hashes, bounds, sent.value)
                    lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(hashes.view(np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.array(hi), pa.array(lo), pa.array(np.diff(bounds)), lists], [*NODE, "n", "grams"])

        texts = self.source.join(ids, same, "left_semi")
        made = texts.mapInArrow(run, "hi long, lo long, n long, grams array<long>")
        if nulls:  # all rows without an id are read
            made = made.join(wanted, [*NODE], "left_semi")
        made = written(made, "jaccard-sets")
        # rows come twice where an id does: sets are shuffled then alone
        twice = made.groupBy(*NODE).count().where("count > 1")
        return made if twice.isEmpty() else written(made.dropDuplicates([*NODE]), "jaccard-sets")

    def _sent(self, order: Order):
        return self.source.sparkSession.sparkContext.broadcast(order)


def _new(tokens: np.ndarray, old: np.ndarray, whose: np.ndarray) -> np.ndarray:
    """Which tokens of a row are not among its old ones; both are dealt to rows by ``whose``."""
    order = np.lexsort((np.repeat([0, 1], len(tokens)), np.concatenate([old, tokens]), np.concatenate([whose, whose])))
    both, rows = np.concatenate([old, tokens])[order], np.concatenate([whose, whose])[order]
    known = np.zeros(len(order), bool)
    known[1:] = (both[1:] == both[:-1]) & (rows[1:] == rows[:-1])
    out = np.ones(2 * len(tokens), bool)
    out[order] = ~known
    return out[len(tokens) :]


def _order(texts: _Texts, frequent: int, places: int, rounds: int) -> Order:
    """The global order: shingles of few prefixes by hash, then frequent ones by the number of prefixes they were found in.

    It decides what is compared, not the result. Its size is bounded by ``places``.
    """
    before, now = None, (np.zeros(0, np.uint64), np.zeros(0, np.int32))
    tokens, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for _ in range(rounds):
        many = written(texts.counted(now, before).where(F.col("c") >= frequent), "jaccard-frequent")
        # levels of counts from the top, as long as all of a level's shingles have a place
        levels = many.groupBy(F.floor(4 * F.log2("c")).alias("level")).agg(F.count("*").alias("n"), F.min("c").alias("c")).orderBy(F.desc("level")).collect()  # 256 rows at most
        fits = np.cumsum([r["n"] for r in levels]) <= places
        if not fits.any():
            break
        found = many.where(F.col("c") >= levels[int(fits.sum()) - 1]["c"]).toArrow()
        tokens = np.concatenate([tokens, found.column("token").to_numpy().view(np.uint64)])
        counts = np.concatenate([counts, found.column("c").to_numpy()])
        by_count = np.lexsort((tokens, -counts))
        tokens, firsts = np.unique(tokens[by_count], return_index=True)  # of one found twice, the greater count
        counts = counts[by_count][firsts]
        kept = np.sort(np.lexsort((tokens, -counts))[:places])
        tokens, counts = tokens[kept], counts[kept]
        before, now = now, (tokens, np.argsort(np.lexsort((tokens, counts))).astype(np.int32))
    return now


def _met(similarity: tuple[int, int], a: str = "", b: str = "x_") -> Column:
    """Whether two sets that share a shingle of their prefixes can reach the similarity.

    Their sizes must allow it, and what either has from the shingle on (which is the first that
    they share, or a later one, then an earlier row meets them too), and the bits in which
    their sketches differ.
    """
    over, under = similarity
    n, m, at, there = (F.col(x) for x in (f"{a}n", f"{b}n", f"{a}at", f"{b}at"))
    rest = F.least(n - at, m - there)
    apart = sum((F.bit_count(F.col(f"{a}{c}").bitwiseXOR(F.col(f"{b}{c}"))) for c in BITS), F.lit(0))
    # of n + m shingles, each side's differing ones counted, at most this share may differ
    near = F.lit(over + under) * apart <= F.lit(under - over) * (n + m)
    return (F.lit(under) * F.least(n, m) >= F.lit(over) * F.greatest(n, m)) & (F.lit(over + under) * rest >= F.lit(over) * (n + m)) & near


def _node(prefix: str = "") -> Column:
    return F.struct(*(F.col(f"{prefix}{c}").alias(c) for c in NODE))


def _told_apart(shared: DataFrame, keys: int = KEYS) -> DataFrame:
    """Of shingles that are in the prefixes of the same sets the first in the order, for each of those sets.

    It is the first for all of them, so what two sets have from their first common shingle on is not changed.
    """
    hash_ = F.xxhash64(*NODE)
    lists = shared.groupBy("token").agg(F.min(F.struct(*NODE, "at")).alias("least"), F.max(F.struct(*NODE)).alias("last"), F.count("*").alias("c"), F.bit_xor(hash_).alias("x"), F.sum(F.shiftright(F.xxhash64(*NODE, F.lit(7)), 32)).alias("s"))
    lists = lists.where((F.col("least.hi") != F.col("last.hi")) | (F.col("least.lo") != F.col("last.lo")))
    kept = lists.groupBy("least.hi", "least.lo", "last", "c", "x", "s").agg(F.min_by("token", "least.at").alias("token")).select("token")
    return written(shared.join(_chosen_by(written(kept, "jaccard-kept"), keys), "token", "left_semi"), "jaccard-shingles")


def _placed(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """The sets of each shingle with their roots."""
    placed = shared.join(roots.select(F.col("node.hi").alias("hi"), F.col("node.lo").alias("lo"), "root"), [*NODE], "left")
    return written(placed.withColumn("root", F.coalesce("root", _node())), "jaccard-placed")


def _meetings(placed: DataFrame, tried: DataFrame | None, turn: int, similarity: tuple[int, int]) -> DataFrame:
    """A pair of each set with one that is under another root: that which is most often the chosen set of a shingle that both have, and was not tried before; ``turn`` chooses."""
    own = [*NODE, "n", "at", *BITS, "root"]
    hubs = placed.groupBy("token").agg(F.min(F.struct(F.xxhash64(*NODE, F.lit(turn)).alias("h"), *own)).alias("hub"), F.min("root").alias("less"), F.max("root").alias("more"))
    hubs = hubs.where("less <> more").select("token", *(F.col(f"hub.{c}").alias(f"x_{c}") for c in own))
    met = placed.join(hubs, "token").where((F.col("root") != F.col("x_root")) & _met(similarity))
    votes = met.groupBy(_node("x_").alias("a"), _node().alias("b")).count()
    if tried is not None:
        known = tried.unionByName(tried.select(F.col("b").alias("a"), F.col("a").alias("b")))
        votes = votes.join(known, ["a", "b"], "left_anti")
    best = votes.groupBy("b").agg(F.max(F.struct("count", "a")).alias("best"))
    return written(best.select("best.a", "b"), "jaccard-meetings")


def _faced(placed: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """Pairs (a, b) of sets that share a shingle in their prefixes and are not under one root yet, few of them twice.

    Of two such sets one at least is not under the root of the shingle's least set, so those
    alone meet all sets of a shingle: a group under one root makes no pairs. At the first
    shingle that two sets share they have none of those before in common; where they have, they
    meet at that one, with more of both sets to come.
    """
    ahead = Window.partitionBy(*NODE).orderBy("at").rowsBetween(-BEFORE, -1)  # over one set's prefix
    placed = written(placed.withColumn("ahead", F.collect_list("token").over(ahead)), "jaccard-ahead")
    hubs = placed.groupBy("token").agg(F.min(F.struct(*NODE, "root")).alias("hub"))
    strange = placed.join(hubs.select("token", F.col("hub.root").alias("hub_root")), "token").where("root <> hub_root")
    strange = strange.select("token", *(F.col(c).alias(f"x_{c}") for c in (*NODE, "n", "at", "root", *BITS, "ahead")))
    both = strange.join(placed, "token").where((F.col("x_root") != F.col("root")) & _met(similarity) & ~F.arrays_overlap("x_ahead", "ahead"))
    # the lesser set is the probe, whichever of the two is strange, so that a pair is looked at once
    return both.select(F.least(_node("x_"), _node()).alias("a"), F.greatest(_node("x_"), _node()).alias("b"))


def _across(placed: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """The pairs of ``_faced``, each once."""
    return written(_faced(placed, similarity).distinct(), "jaccard-across")


def _climb(similarity: tuple[int, int]):
    """A mapper over (a, b, grams) rows in order of a, its own row first, then of grams: the pairs that are similar."""
    over, under = similarity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe_key, probe, path, misses, done = None, None, None, None, 0
        for batch in worker("jaccard", batches):
            grams = batch.column("grams")
            bounds, values = np.asarray(grams.offsets), np.asarray(grams.values)
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("a_hi", "a_lo", "part")), strict=True))
            is_probe, good = batch.column("probe").to_pylist(), []
            for i, key in enumerate(keys):
                one = values[bounds[i] : bounds[i + 1]]
                if is_probe[i]:
                    probe_key, probe, path, done = key, np.sort(one), np.zeros(0, np.int64), 0
                    misses = np.zeros(1, np.int64)
                    continue
                assert key == probe_key, "a probe comes before what it meets"
                n, size = len(one), len(probe)
                allowed = n - -(-over * (n + size) // (over + under))  # shingles of this set that the probe may lack
                # the path is shared with the set before up to the first difference; it was followed for ``done`` shingles
                common = min(done, n)
                apart = np.flatnonzero(path[:common] != one[:common])
                depth = int(apart[0]) if len(apart) else common
                missed = [misses[: depth + 1]]
                path, done = one, depth
                lacking = int(missed[0][-1])
                while done < n and lacking <= allowed:  # else the subtree goes: what remains is too short
                    step = one[done : done + 256]
                    lost = lacking + np.cumsum(find(probe, step) < 0)
                    missed.append(lost)
                    lacking, done = int(lost[-1]), done + len(step)
                misses = np.concatenate(missed)
                if lacking <= allowed and allowed >= 0:
                    good.append(i)
            out = batch.take(pa.array(good, pa.int64()))
            yield pa.RecordBatch.from_arrays([out.column(c) for c in ("a_hi", "a_lo", "b_hi", "b_lo")], ["a_hi", "a_lo", "b_hi", "b_lo"])

    return run


def _near(pairs: DataFrame, rows: DataFrame, similarity: tuple[int, int], keys: int = KEYS) -> DataFrame:
    """The pairs (a, b) whose fine sketches differ in no more bits than similar sets may in shingles."""
    over, under = similarity
    ends = written(pairs.select(F.explode(F.array("a", "b")).alias("x")).select("x.hi", "x.lo").distinct(), "jaccard-ends")
    sketches = rows.join(_chosen_by(ends, keys), [*NODE], "left_semi").select(*NODE, "n", "fine").dropDuplicates([*NODE])
    sketches = written(sketches.select(_node().alias("node"), F.struct("n", "fine").alias("s")), "jaccard-fine")
    both = pairs.join(sketches.select(F.col("node").alias("a"), F.col("s").alias("x")), "a").join(sketches.select(F.col("node").alias("b"), F.col("s").alias("y")), "b")
    apart = F.aggregate(F.zip_with("x.fine", "y.fine", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, bits: s + bits)
    return written(both.where(F.lit(over + under) * apart <= F.lit(under - over) * (F.col("x.n") + F.col("y.n"))).select("a", "b"), "jaccard-near")


def _similar(pairs: DataFrame, texts: _Texts, rows: DataFrame, order: Order, split: int) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the similarity: a is sent down the tree of the b's it meets."""
    if pairs.isEmpty():
        return pairs
    pairs = _near(pairs, rows, texts.similarity, texts.keys)
    if pairs.isEmpty():
        return pairs
    wanted = written(pairs.select(F.explode(F.array("a", "b")).alias("x")).select("x.hi", "x.lo").distinct(), "jaccard-wanted")
    sets = texts.sets(wanted, rows, order)
    parts = written(pairs.groupBy("a").agg(F.ceil(F.count("*") / split).cast("long").alias("parts")), "jaccard-parts")
    flat = pairs.join(parts, "a").select(F.col("a.hi").alias("a_hi"), F.col("a.lo").alias("a_lo"), F.pmod(F.xxhash64("b"), "parts").alias("part"), F.col("b.hi").alias("b_hi"), F.col("b.lo").alias("b_lo"))
    met = flat.join(sets.select(F.col("hi").alias("b_hi"), F.col("lo").alias("b_lo"), "grams"), ["b_hi", "b_lo"])
    probes = parts.select(F.col("a.hi").alias("a_hi"), F.col("a.lo").alias("a_lo"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    probes = probes.join(sets.select(F.col("hi").alias("a_hi"), F.col("lo").alias("a_lo"), "grams"), ["a_hi", "a_lo"])
    columns = ["a_hi", "a_lo", "part", "probe", "b_hi", "b_lo", "grams"]
    both = met.withColumn("probe", F.lit(False)).select(columns).unionByName(probes.withColumns({"probe": F.lit(True), "b_hi": F.lit(0).cast("long"), "b_lo": F.lit(0).cast("long")}).select(columns))
    both = both.repartition("a_hi", "a_lo", "part").sortWithinPartitions("a_hi", "a_lo", "part", F.desc("probe"), "grams")
    good = both.mapInArrow(_climb(texts.similarity), "a_hi long, a_lo long, b_hi long, b_lo long")
    return written(good.select(_node("a_").alias("a"), _node("b_").alias("b")), "jaccard-links")


def jaccard_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: tuple[int, int] = SIMILARITY,
    frequent: int = FREQUENT, places: int = PLACES, rounds: int = ROUNDS, meetings: int = MEETINGS, split: int = SPLIT,
    keys: int = KEYS,
) -> DataFrame:
    """``id_col``, n_shingles and component_id, the least id of all rows linked to it, of every row.

    A row's set holds the distinct runs of ``shingle`` words (A-Z lower-cased, words are runs
    without ASCII white space; fewer words are one run). Two rows link when the similarity of
    their sets is ``similarity``, a fraction, or more. All links are found, whatever the order
    of shingles that ``frequent``, ``places`` and ``rounds`` lead to, and however many ``meetings``
    come before all pairs that are left.

    Rows of equal sets are one node. A null or empty text, or one without words, has an empty
    set and is its own component. A null id is no candidate for the least; where all ids of a
    component are null, it is null. Repeated rows are kept; ties are of no effect, as ids alone
    name components. Other columns are not read, so they cannot clash. An empty table gives an
    empty result. A very long text is handled alone: a task holds its set, and a step of
    comparison two sets.
    """
    over, under = similarity
    texts = _Texts(df, id_col, text_col, shingle, similarity, keys)
    rows = written(texts.rows(), "jaccard-rows")
    nodes = written(rows.where("n > 0").groupBy(*NODE).agg(F.min("id").alias("least")), "jaccard-nodes")
    order = _order(texts, frequent, places, rounds)
    postings = written(texts.postings(order), "jaccard-postings")
    many = postings.groupBy("token").agg(F.count("*").alias("c")).where("c > 1").select("token")
    # shingles are told apart before sketches, many times a posting's size, are put to them
    shared = _told_apart(written(postings.join(written(many, "jaccard-tokens"), "token", "left_semi"), "jaccard-met"), keys)
    sketches = rows.select(*NODE, *BITS).join(written(shared.select(*NODE).distinct(), "jaccard-some"), [*NODE], "left_semi").dropDuplicates([*NODE])
    shared, tried = written(shared.join(sketches, [*NODE]), "jaccard-shared"), None
    roots = shared.select(_node().alias("node"), _node().alias("root")).limit(0)
    edges = lambda: roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    for turn in range(meetings):
        open_ = _placed(shared, roots)
        pairs = _meetings(open_, tried, turn, similarity)
        found = _similar(pairs, texts, rows, order, split)
        if found.isEmpty():
            break
        tried = pairs if tried is None else tried.unionByName(pairs)
        roots = components(edges().unionByName(found))
    open_ = _placed(shared, roots)
    across = _across(open_, similarity)
    if tried is not None:
        known = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        across = written(across.join(known, ["a", "b"], "left_anti"), "jaccard-pairs")
    more = _similar(across, texts, rows, order, split)
    if not more.isEmpty():
        roots = components(edges().unionByName(more))
    roots = roots.select(F.col("node.hi").alias("hi"), F.col("node.lo").alias("lo"), "root")
    placed = written(nodes.join(roots, [*NODE], "left").select(*NODE, "least", F.coalesce("root", _node()).alias("root")), "jaccard-roots")
    least = written(placed.groupBy("root").agg(F.min("least").alias("component_id")), "jaccard-least")
    named = written(placed.join(least, "root").select(*NODE, "component_id"), "jaccard-named")
    some = rows.where("n > 0").join(named, [*NODE]).select("id", "n", "component_id")
    out = some.unionByName(rows.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")

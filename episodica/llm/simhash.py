"""Operator 8: near-duplicates by SimHash fingerprints and multi-index hashing.

``near_duplicates`` links fingerprints at two bits or fewer. ``near_copies`` takes
fingerprints of sets of word shingles, any distance in bits and number of segments, and
links texts whose sets, compared as a whole, reach a Jaccard similarity.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import short_batches, written
from .text import NOT_SPACE, Chunk, chunks, lower_bytes, mix, owner, runs, span_hashes, worker

#: Entries of one table bucket up to which its candidates are fetched pair by pair.
BUCKET = 64


def _majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes, as a signed long."""
    n, ones = len(hashes), np.zeros(64, np.int64)
    for i in range(0, n, 255 * 64):  # sums of 255 bits fit a byte
        bits = np.unpackbits(hashes[i : i + 255 * 64].astype(">u8").view(np.uint8)).reshape(-1, 64)
        for j in range(0, len(bits), 255):
            ones += bits[j : j + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprint(text: bytes, shingle: int = 3) -> int:
    import xxhash

    words = text.lower().split()  # of bytes: A-Z alone, and the six ASCII white spaces
    if not words:
        return 0
    joined, size = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
    return _majority(np.array([digest(joined[a:b], 42) for a, b in spans], np.uint64))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """__id and __print of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in worker("simhash", batches):
            for c in chunks(batch.column("__text")):
                prints = [fingerprint(c.text(i), shingle) for i in range(c.rows)]
                yield pa.RecordBatch.from_arrays([batch.column("__id").slice(c.first, c.rows), pa.array(prints, pa.int64())], ["__id", "__print"])

    short_batches(df.sparkSession)
    source = df.select(df[id_col].alias("__id"), df[text_col].alias("__text"))
    return source.mapInArrow(run, f"__id {dict(source.dtypes)['__id']}, __print long")


def _half(x: Column, i: int) -> Column:
    return x.bitwiseAND(F.lit(0xFFFFFFFF)) if i else F.shiftrightunsigned(x, 32)


def _halves(prints: DataFrame) -> DataFrame:
    """__print, segment and value, two rows for each fingerprint."""
    return prints.select("__print", F.explode(F.array(*(F.struct(F.lit(i).alias("segment"), _half(F.col("__print"), i).alias("value")) for i in (0, 1)))).alias("__s")).select("__print", "__s.*")


def _met(some: DataFrame, others: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """A join by a shuffle of both sides, whatever Spark expects: its estimate takes exploded rows for one, so it would send them all through the driver."""
    return some.join(others.hint("merge"), on, how)


def _ball(value: Column, bits: int) -> Column:
    """The value and all values one bit away."""
    return F.concat(F.array(value), F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), lambda i: value.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i))))


def _links(prints: DataFrame, bucket: int) -> DataFrame:
    """Edges (a, b) that connect distinct fingerprints at two or fewer differing bits, directly or through others.

    Of two 32-bit segments one differs by at most one bit. Each fingerprint stands in a
    table under both segments and probes it with the ball of radius one around both;
    complete distances are verified. Where a table bucket has over ``bucket`` entries, the
    fingerprints that would probe it are linked instead through balls of radius one around
    the whole fingerprint: two within two bits share a centre, those that share one are
    within two bits, and at most 65 distinct fingerprints share one. Nothing is dropped.
    """
    halves = _halves(prints)
    crowded = written(halves.groupBy("segment", "value").count().where(F.col("count") > bucket).select("segment", "value"), "crowded")
    table = halves.join(crowded, ["segment", "value"], "left_anti").select("segment", "value", F.col("__print").alias("a"))
    probes = halves.select("segment", F.explode(_ball(F.col("value"), 32)).alias("value"), F.col("__print").alias("b"))
    near = _met(table, probes, ["segment", "value"]).where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2)).select("a", "b")
    around = crowded.select("segment", F.explode(_ball(F.col("value"), 32)).alias("value")).distinct()
    hot = _met(halves, around, ["segment", "value"], "left_semi").select("__print").distinct()
    centres = hot.select("__print", F.explode(_ball(F.col("__print"), 64)).alias("centre"))
    first = centres.groupBy("centre").agg(F.min("__print").alias("a"), F.count("*").alias("n")).where("n > 1").select("centre", "a")
    through = _met(centres, first, "centre").where("__print <> a").select("a", F.col("__print").alias("b"))
    return near.unionByName(through).distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bucket: int = BUCKET) -> DataFrame:
    """``id_col``, fingerprint (16 hex digits) and component_id of every row.

    component_id is the least id reachable over links of two or fewer differing bits. Rows
    with equal fingerprints, copies among them, are one node: they are aggregated before
    anything is joined. Null and empty texts have fingerprint zero and link like any other.
    A null id is no candidate for the least; where all ids are null, it is null. Repeated
    rows are kept; ties are of no effect. Columns not asked for are not read. An empty table
    gives an empty result; a text of any length is read whole, its shingles in one task.
    """
    rows = written(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    nodes = written(rows.groupBy("__print").agg(F.min("__id").alias("__least")), "nodes")
    roots = components(_links(nodes.select("__print"), bucket))
    linked = nodes.join(roots.withColumnRenamed("node", "__print"), "__print")
    least = linked.groupBy("root").agg(F.min("__least").alias("__all"))
    named = linked.join(least, "root").select("__print", "__all")
    named = nodes.join(named, "__print", "left").select("__print", F.coalesce("__all", "__least").alias("component_id"))
    named = written(named, "components")  # a plain shuffle on either side: Spark can split a fingerprint that many rows have
    return rows.join(named, "__print").select(F.col("__id").alias(id_col), F.lpad(F.lower(F.hex("__print")), 16, "0").alias("fingerprint"), "component_id")


_LOWER, _STEP = lower_bytes(), np.uint64(0xD6E8FEB86659FD93)

#: Least Jaccard similarity of a link, as a fraction.
SIMILARITY = (4, 5)

#: Bits at which shingle sets of that similarity are looked for, and segments of their 64 bits.
DISTANCE, SEGMENTS = 11, 4


def _sets(c: Chunk, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of the runs of ``shingle`` words, in order, of all rows, and their bounds; fewer words are one run."""
    starts, ends = runs(NOT_SPACE[c.data], c.bounds)
    rows = owner(c.bounds, starts)
    words = span_hashes(c.data, starts, ends, _LOWER)
    counts = np.bincount(rows, minlength=c.rows)
    size = max(0, len(words) - shingle + 1)
    out = np.zeros(size, np.uint64)
    for i in range(shingle):
        out = mix(out * _STEP + words[i : i + size])
    fits = rows[:size] == rows[shingle - 1 : shingle - 1 + size]
    out, whose = out[fits], rows[:size][fits]
    firsts = np.concatenate([[0], np.cumsum(counts)])
    few = np.flatnonzero((counts > 0) & (counts < shingle))
    brief = np.zeros(len(few), np.uint64)
    for i in range(shingle - 1):
        at = np.flatnonzero(counts[few] > i)
        brief[at] = mix(brief[at] * _STEP + words[firsts[few[at]] + i])
    brief = mix(brief + counts[few].astype(np.uint64))
    sizes = np.bincount(whose, minlength=c.rows)
    sizes[few] = 1
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    whole = np.empty(len(out) + len(few), np.uint64)
    whole[bounds[few]] = brief
    whole[np.arange(len(out)) + np.searchsorted(few, whose)] = out
    whose = np.repeat(np.arange(c.rows), sizes)
    if len(whole) < 16 * c.rows:
        whole = whole[np.lexsort((whole, whose))]
    else:
        for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            whole[i:j].sort()
    new = np.ones(len(whole), bool)
    new[1:] = (whole[1:] != whole[:-1]) | (whose[1:] != whose[:-1])
    return whole[new], np.concatenate([[0], np.cumsum(np.bincount(whose[new], minlength=c.rows))])


def _set_prints(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint and digest of each set; zero for an empty one."""
    import xxhash

    prints, digests = np.zeros(len(bounds) - 1, np.int64), np.zeros(len(bounds) - 1, np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        if a < b:
            prints[i] = _majority(hashes[a:b])
            digests[i] = xxhash.xxh3_64_intdigest(hashes[a:b].tobytes()) - (1 << 63)
    return prints, digests


def _described(df: DataFrame, id_col: str, text_col: str, shingle: int, sets: bool = False) -> DataFrame:
    """__id, print, digest and n (distinct shingles) of every row; with ``sets`` the hashes too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in worker("simhash", batches):
            for c in chunks(batch.column("__text")):
                hashes, bounds = _sets(c, shingle)
                prints, digests = _set_prints(hashes, bounds)
                columns = [pa.array(prints), pa.array(digests), pa.array(np.diff(bounds))]
                if sets:
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(hashes.view(np.int64))))
                yield pa.RecordBatch.from_arrays([batch.column("__id").slice(c.first, c.rows), *columns], ["__id", "print", "digest", "n", *["hashes"] * sets])

    short_batches(df.sparkSession)
    source = df.select(df[id_col].alias("__id"), df[text_col].alias("__text"))
    return source.mapInArrow(run, f"__id {dict(source.dtypes)['__id']}, print long, digest long, n long" + ", hashes array<long>" * sets)


def _masks(bits: int, radius: int) -> list[int]:
    """What to flip to reach all values within ``radius`` bits."""
    return [sum(1 << i for i in chosen) for r in range(radius + 1) for chosen in itertools.combinations(range(bits), r)]


def _entries(nodes: DataFrame, segments: int, radius: int) -> DataFrame:
    """The nodes' columns and a key (value and segment) for each segment and each value within ``radius`` bits of its own."""

    def ball(segment: int) -> Column:
        own, bits = _segment(F.col("print"), segment, segments)
        flips = F.array(*(F.lit(m).cast("long") for m in _masks(bits, radius)))
        return F.transform(flips, lambda m: own.bitwiseXOR(m) * F.lit(segments) + F.lit(segment))

    balls = [ball(i) for i in range(segments)]
    return nodes.select("*", F.explode(F.concat(*balls)).alias("key"))


def _segment(value: Column, segment: int, segments: int) -> tuple[Column, int]:
    """A segment of 64 bits, and its bits."""
    first, end = 64 * segment // segments, 64 * (segment + 1) // segments
    return F.shiftrightunsigned(value, first).bitwiseAND(F.lit((1 << (end - first)) - 1)), end - first


def _meeting(own: Column, other: Column, segments: int, radius: int) -> Column:
    """The one of all keys that two near fingerprints share under which they are paired.

    Of the first segment that differs in ``radius`` bits at most, ``own`` with the lowest
    ``radius // 2`` of these flipped: so far from ``own``, and no farther than the rest from ``other``.
    """
    out = F.lit(None).cast("long")
    for segment in reversed(range(segments)):
        value, _ = _segment(own, segment, segments)
        apart, _ = _segment(own.bitwiseXOR(other), segment, segments)
        rest = apart
        for _ in range(radius // 2):
            rest = rest.bitwiseAND(rest - 1)
        out = F.when(F.bit_count(apart) <= radius, value.bitwiseXOR(apart).bitwiseXOR(rest) * F.lit(segments) + F.lit(segment)).otherwise(out)
    return out


def _apart(distance: int, a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def _edge(columns: tuple[str, str], others: tuple[str, str]) -> list[Column]:
    """a and b, the less and the greater of two nodes."""
    own, other = (F.struct(F.col(p).alias("print"), F.col(d).alias("digest")) for p, d in (columns, others))
    return [F.least(own, other).alias("a"), F.greatest(own, other).alias("b")]


def _stars(nodes: DataFrame, distance: int, segments: int) -> DataFrame:
    """A pair of each node with the least of its keys' least nodes that is near it.

    Of the segments of two near fingerprints one differs by at most ``distance // segments``
    bits. Half of that radius is enumerated on either side, so the two meet under one key.
    """
    radius = distance // segments
    table, probes = _entries(nodes, segments, radius // 2), _entries(nodes, segments, radius - radius // 2)
    hubs = table.groupBy("key").agg(F.min(F.struct("print", "digest")).alias("hub"), F.count("*").alias("c"))
    if radius % 2 == 0:
        hubs = hubs.where("c > 1")
    met = _met(probes, hubs.select("key", F.col("hub.print").alias("hub_print"), F.col("hub.digest").alias("hub_digest")), "key")
    near = met.where(_apart(distance, "print", "hub_print") & ((F.col("print") != F.col("hub_print")) | (F.col("digest") != F.col("hub_digest"))))
    # one star is enough for each node: what it leaves apart is found when nodes meet across roots
    least = near.groupBy("print", "digest").agg(F.min(F.struct(F.col("hub_print").alias("print"), F.col("hub_digest").alias("digest"))).alias("hub"))
    least = least.select("print", "digest", F.col("hub.print").alias("hub_print"), F.col("hub.digest").alias("hub_digest"))
    return written(least.select(*_edge(("print", "digest"), ("hub_print", "hub_digest"))).distinct(), "stars")


def _across(nodes: DataFrame, roots: DataFrame, distance: int, segments: int, similarity: tuple[int, int]) -> DataFrame:
    """All near pairs of nodes, of sizes that can reach the similarity, that are not under one root yet.

    Of such two at least one is not under the root of their key's least node, so those alone
    meet all nodes of a key: a group under one root makes no pairs, whatever its size. Of the
    keys that two share one pairs them: of the lesser fingerprint if both sides have the same
    radius, else of the one in the table, so that it is the same key whichever is strange to it.
    """
    radius = distance // segments
    root = roots.select(F.col("node.print").alias("print"), F.col("node.digest").alias("digest"), F.col("root.print").alias("__rp"), F.col("root.digest").alias("__rd"))
    placed = nodes.join(root, ["print", "digest"], "left").select("print", "digest", "n", F.coalesce("__rp", "print").alias("rp"), F.coalesce("__rd", "digest").alias("rd"))
    placed = written(placed, "placed")
    table, probes = _entries(placed, segments, radius // 2), _entries(placed, segments, radius - radius // 2)
    hubs = table.groupBy("key").agg(F.min(F.struct("print", "digest", "rp", "rd")).alias("hub"), F.count("*").alias("c"))
    if radius % 2 == 0:
        hubs = hubs.where("c > 1")
    hubs = hubs.select("key", F.col("hub.rp").alias("hp"), F.col("hub.rd").alias("hd"))

    def few(entries: DataFrame) -> DataFrame:
        strange = _met(entries, hubs, "key").where((F.col("rp") != F.col("hp")) | (F.col("rd") != F.col("hd")))
        return strange.select("key", *(F.col(c).alias(f"x_{c}") for c in ("print", "digest", "n", "rp", "rd")))

    def pairs(some: DataFrame, all_: DataFrame, table_side: str) -> DataFrame:
        x, y = F.col("x_print"), F.col("print")
        own, other = (F.least(x, y), F.greatest(x, y)) if radius % 2 == 0 else (x, y) if table_side == "some" else (y, x)
        once = F.col("key") == _meeting(own, other, segments, radius)
        apart = (F.col("x_rp") != F.col("rp")) | (F.col("x_rd") != F.col("rd"))
        sizes = similarity[1] * F.least("x_n", "n") >= similarity[0] * F.greatest("x_n", "n")
        return _met(some, all_, "key").where(_apart(distance, "x_print", "print") & apart & sizes & once).select(*_edge(("x_print", "x_digest"), ("print", "digest")))

    out = pairs(few(table), probes, "some")
    if radius % 2:
        out = out.unionByName(pairs(few(probes), table, "all"))
    return written(out.distinct(), "across")


def _similar(pairs: DataFrame, df: DataFrame, rows: DataFrame, id_col: str, text_col: str, shingle: int, similarity: tuple[int, int]) -> DataFrame:
    """The pairs whose sets reach ``similarity``; only sets of nodes in pairs are made."""
    over, under = similarity
    named = lambda c: F.struct(F.col("print"), F.col("digest")).alias(c)
    if pairs.isEmpty():
        return pairs
    wanted = written(pairs.select("a.print", "a.digest").distinct().unionByName(pairs.select("b.print", "b.digest").distinct()).distinct(), "wanted")
    one = written(rows.join(wanted, ["print", "digest"], "left_semi").groupBy("print", "digest").agg(F.min("__id").alias("one"), F.max(F.col("__id").isNull()).alias("none")), "wanted-rows")
    ids = one.select(F.when(F.col("none"), F.lit(None)).otherwise(F.col("one")).alias("one")).distinct()
    texts = df.select(df[id_col].alias("__id"), df[text_col].alias("__text")).join(ids, F.col("__id").eqNullSafe(F.col("one")), "left_semi")
    sets = written(_described(texts, "__id", "__text", shingle, sets=True).join(wanted, ["print", "digest"], "left_semi").dropDuplicates(["print", "digest"]).select(named("node"), "n", "hashes"), "sets")
    side = lambda x: sets.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("hashes").alias(f"set_{x}"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    fit = under * F.least("n_a", "n_b") >= over * F.greatest("n_a", "n_b")
    met = pairs.join(side("a"), "a").join(side("b"), "b").where(fit)
    return written(met.where((over + under) * both >= over * (F.col("n_a") + F.col("n_b"))).select("a", "b"), "near-pairs")


def near_copies(df: DataFrame, id_col: str, text_col: str = "text", shingle: int = 5, similarity: tuple[int, int] = SIMILARITY, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """``id_col`` and component_id, the least id of the rows linked to it, of every row.

    Two texts are linked if their sets of ``shingle``-word runs (A-Z lower-cased; fewer words
    are one run) have a Jaccard similarity of ``similarity`` or more and their fingerprints
    differ in at most ``distance`` bits. All pairs within the distance are found and compared as
    whole sets; equal sets are one node, and texts without words are one. A text of so few
    runs that no other set can be that similar is not looked for. The distance decides which
    similar pairs are found: of 64 bits, 11 held 93 % of all pairs of similarity 0.8 when
    counted on the given tables. The keys that are enumerated grow with the texts, the
    fingerprints compared with their square over 2**(64 / segments): lower the distance or the
    segments for larger corpora. Texts within the distance that do not reach the similarity
    (a passage shared by many short texts) are compared pair by pair; linked ones are not.

    Ids tell rows of different texts apart (a struct will do); a null id is no candidate for
    the least. Repeated rows are kept; ties are of no effect. Other columns are not read.
    An empty table gives an empty result; a very long text is handled alone.
    """
    over, under = similarity
    rows = written(_described(df, id_col, text_col, shingle), "described")
    nodes = written(rows.groupBy("print", "digest").agg(F.min("__id").alias("least"), F.min("n").alias("n")), "set-nodes")
    looked = nodes.where((under - over) * F.col("n") >= over).select("print", "digest", "n")
    verify = lambda pairs: _similar(pairs, df, rows, id_col, text_col, shingle, similarity)
    stars = _stars(looked.select("print", "digest"), distance, segments)
    roots = components(verify(stars))
    across = _across(looked, roots, distance, segments, similarity)
    more = verify(written(across.join(stars, ["a", "b"], "left_anti"), "pairs"))
    if not more.isEmpty():
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    roots = roots.select(F.col("node.print").alias("print"), F.col("node.digest").alias("digest"), "root")
    own = F.struct(F.col("print"), F.col("digest"))
    placed = written(nodes.join(roots, ["print", "digest"], "left").select("print", "digest", "least", F.coalesce("root", own).alias("root")), "placed-nodes")
    least = written(placed.groupBy("root").agg(F.min("least").alias("component_id")), "least")
    named = written(placed.join(least, "root").select("print", "digest", "component_id"), "components")
    return rows.select("__id", "print", "digest").join(named, ["print", "digest"]).select(F.col("__id").alias(id_col), "component_id")

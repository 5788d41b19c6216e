"""Operator 7: near-duplicate lines by deletion neighbourhoods, in DataFrame functions alone.

A line goes if an earlier line equals it or lies within one edit (a character
put in, left out or replaced). Distinct lines are found by hash. Two lines one
edit apart share the first or the last half of the shorter one; lines that share no
half with another leave there. The rest emit their deletion variants: a line is cut
into blocks of 64 characters, and each block, with all before and after it hashed as
a whole, loses each of its characters in turn; blocks whose surroundings no other line
has are left out. Equal variants are joined:

* a replaced character: both lack the same place of equally long lines. All lines
  that share such a variant are one edit apart, so each meets the earliest alone.
* a character more: the longer line's variant is the shorter line itself, which is
  one distinct line, so each longer line meets that one alone.

No group is paired with itself. Pairs are verified with ``levenshtein``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import kept_names, quoted, written

BLOCK = 64

#: Rows of hashes (some 24 bytes each) up to which a side of a join is broadcast; beyond, it is shuffled.
BROADCAST_ROWS = 1_000_000


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a written table if its counted rows allow."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _lines(df: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """id, text hash, number, line and two hashes of every line that may go."""
    whole = df.select(df[id_col].alias("id"), F.xxhash64(df[text_col]).alias("th"), F.posexplode(F.split(df[text_col], "\n", -1)).alias("no", "line"))
    return whole.where(F.char_length(F.trim("line")) >= min_chars).withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(7), "line")})


def _distinct(lines: DataFrame) -> DataFrame:
    """One row for each distinct line: the hashes of its halves, its copies, its first place."""
    n = F.char_length("line")
    half, less = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")
    # the shorter of two lines may have one character less, and then a shorter half
    cut = lambda side, size: F.xxhash64(F.lit(side), size, F.left("line", size) if side == 0 else F.right("line", size))
    keyed = lines.select("h1", "h2", F.struct("id", "th", "no").alias("place"), *(cut(side, size).alias(f"k{i}") for i, (side, size) in enumerate(((0, half), (0, less), (1, half), (1, less)))))
    return keyed.groupBy("h1", "h2").agg(F.min("place").alias("place"), F.count("*").alias("copies"), *(F.min(f"k{i}").alias(f"k{i}") for i in range(4)))


def _candidates(distinct: DataFrame) -> DataFrame:
    """Distinct lines that share a half with another."""
    halves = distinct.select("h1", "h2", "place", F.explode(F.array_distinct(F.array("k0", "k1", "k2", "k3"))).alias("half"))
    shared = written(halves.groupBy("half").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a <> b").select("half"), "shared-halves")
    return written(halves.join(_small(shared), "half", "left_semi").select("h1", "h2", "place").distinct(), "line-candidates")


def _variants(lines: DataFrame) -> DataFrame:
    """key, kind and line: kind `same` lacks one character, `short` none, `long` one that the short line has not."""
    base = F.explode(F.array(F.struct(F.lit(0).alias("more"), F.col("n").alias("base")), F.struct(F.lit(1).alias("more"), (F.col("n") - 1).alias("base"))))
    roles = lines.withColumn("n", F.char_length("line")).select("h1", "h2", "place", "line", base.alias("r")).select("h1", "h2", "place", "line", "r.*").where("base > 0")
    blocks = roles.withColumn("b", F.explode(F.expr(f"sequence(0, CAST((base - 1) DIV {BLOCK} AS INT))")))
    size = F.expr(f"least({BLOCK}, base - b * {BLOCK}) + more")
    blocks = blocks.withColumn("size", size).select(
        "h1", "h2", "place", "more", "size",
        F.expr(f"substring(line, b * {BLOCK} + 1, size)").alias("part"),
        F.xxhash64("base", "b", F.expr(f"left(line, b * {BLOCK})"), F.expr(f"substring(line, b * {BLOCK} + size + 1)")).alias("rest"),
    )
    blocks = written(blocks, "line-blocks")
    shared = blocks.groupBy("rest").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a <> b").select("rest")
    blocks = written(blocks.join(shared, "rest", "left_semi"), "shared-blocks")
    gaps = blocks.withColumn("i", F.explode(F.expr("sequence(0, CAST(size AS INT) - 1)")))
    lacking = F.expr("concat(left(part, i), substring(part, i + 2))")
    out = lambda df, kind, *key: df.select("h1", "h2", "place", F.lit(kind).alias("kind"), F.xxhash64(F.lit(kind == "same"), "rest", *key).alias("key"))
    same = out(gaps.where("more = 0"), "same", F.col("i"), lacking)
    short = out(blocks.where("more = 0"), "short", F.lit(-1), F.col("part"))
    long = out(gaps.where("more = 1"), "long", F.lit(-1), lacking)
    return same.unionByName(short).unionByName(long)


def _near(df: DataFrame, candidates: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """h1 and h2 of the distinct lines within one edit of an earlier one."""
    places = _small(written(candidates.select("place.id", "place.th").distinct(), "candidate-texts"))
    here = df.select(df[id_col].alias("id"), df[text_col].alias("text"), F.xxhash64(df[text_col]).alias("th"))
    held = here.alias("t").join(places.alias("p"), F.col("t.id").eqNullSafe(F.col("p.id")) & (F.col("t.th") == F.col("p.th")), "left_semi")
    lines = _lines(held, "id", "text", min_chars).select("h1", "h2", F.struct("id", "th", "no").alias("place"), "line")
    lines = written(lines.join(_small(candidates.select("h1", "h2", "place")), ["h1", "h2", "place"], "left_semi").dropDuplicates(["h1", "h2"]), "candidate-lines")
    variants = written(_variants(lines), "line-variants")
    same = variants.where("kind = 'same'")
    first = same.groupBy("key").agg(F.min(F.struct("place", "h1", "h2")).alias("f"), F.count("*").alias("c")).where("c > 1").select("key", "f.*")
    first = first.select("key", F.col("h1").alias("e1"), F.col("h2").alias("e2"), F.col("place").alias("earlier"))
    star = same.join(first, "key").where("place > earlier").select("h1", "h2", "e1", "e2")
    short = variants.where("kind = 'short'").select("key", F.col("h1").alias("s1"), F.col("h2").alias("s2"), F.col("place").alias("s"))
    long = variants.where("kind = 'long'").join(short, "key").distinct()
    later = F.col("place") > F.col("s")
    grown = long.select(*(F.when(later, a).otherwise(b).alias(c) for a, b, c in ((F.col("h1"), F.col("s1"), "h1"), (F.col("h2"), F.col("s2"), "h2"), (F.col("s1"), F.col("h1"), "e1"), (F.col("s2"), F.col("h2"), "e2"))))
    pairs = star.unionByName(grown).distinct()
    text = lines.select("h1", "h2", "line")
    pairs = pairs.join(text, ["h1", "h2"]).join(text.select(F.col("h1").alias("e1"), F.col("h2").alias("e2"), F.col("line").alias("before")), ["e1", "e2"])
    return pairs.where(F.levenshtein("line", "before", 1) == 1).select("h1", "h2").distinct()


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1, bound: int = 1, lines_col: str = "__lines", removed_col: str = "__removed") -> DataFrame:
    """All columns of ``df`` with the text's remaining lines, and its lines' numbers before and gone.

    A line goes if an earlier one equals it or, with a ``bound`` of 1, lies within one edit; with
    0 equal lines alone go. Higher bounds are not offered: a line of n characters has about
    n**bound variants, and lines that share one need not be near. Lines, parted by line feeds,
    of under ``min_chars`` characters (without outer blanks) stay: blank ones, unless asked
    otherwise. Earlier means: by id (null first), then the text's hash, then the line's number.
    Rows that repeat an id and a text are treated alike, as one, so there are no ties. A null
    text stays null, an empty one empty; an empty table gives an empty result; lines and texts
    may be of any length. A column named as a result gets an underscore.
    Texts are shuffled once, to meet the list of their lines that go; hashes otherwise.
    """
    if bound not in (0, 1):
        raise ValueError("the edit bound is 0 or 1")
    names = kept_names("", df.columns, (lines_col, removed_col))
    short = {c: f"__c{i}" for i, c in enumerate(df.columns)}
    own = df.select(*(quoted(c).alias(x) for c, x in short.items()))
    the_id, the_text = short[id_col], short[text_col]
    lines = _lines(own, the_id, the_text, min_chars)
    distinct = written(_distinct(lines), "distinct-lines")
    if bound:
        near = written(_near(own, _candidates(distinct), the_id, the_text, min_chars), "near-lines")
    else:
        near = distinct.select("h1", "h2").limit(0)
    # lines without a copy and without a neighbour need no further look
    judged = distinct.where("copies > 1").select("h1", "h2", "place").join(_small(near.withColumn("near", F.lit(True))), ["h1", "h2"], "left")
    alone = distinct.where("copies = 1").select("h1", "h2", "place").join(_small(near), ["h1", "h2"], "left_semi").withColumn("near", F.lit(True))
    verdict = judged.unionByName(alone).select("h1", "h2", F.col("place").alias("first"), F.coalesce("near", F.lit(False)).alias("near"))
    gone = lines.select("id", "th", "no", "h1", "h2").join(verdict, ["h1", "h2"]).where(F.col("near") | (F.struct("id", "th", "no") != F.col("first"))).select("id", "th", "no")
    listed = written(gone.groupBy("id", "th").agg(F.sort_array(F.collect_set("no")).alias("__gone")).select(F.col("id").alias("__id"), F.col("th").alias("__th"), "__gone"), "lines-gone")
    out = own.withColumn("__own", F.xxhash64(the_text)).join(listed, F.col(the_id).eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__th")), "left")
    parts = F.split(F.col(the_text), "\n", -1)
    # numbers that stay, in order: both lists are sets of numbers of one text
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("__gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(parts, i)), "\n")
    left = F.when(F.col("__gone").isNull(), F.col(the_text)).otherwise(kept)
    count = F.when(F.col(the_text).isNull(), F.lit(0)).otherwise(F.size(parts)).cast("long")
    return out.select(*((left if c == text_col else F.col(x)).alias(names[c]) for c, x in short.items()), count.alias(lines_col), F.greatest(F.size("__gone"), F.lit(0)).cast("long").alias(removed_col))

"""Operator 11: how filters interact, whatever order they are applied in.

A relational word pipeline: words are exploded and counted by (row, word), then by row, for
totals and distincts; flags that need no words are joined to them. Rows are then known by
the set of filters they fail alone, one of 32, so each part is one row of 32 conditional
counts, and all 120 orders follow from those.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import quoted, written

#: Filters by letter; bit i of a mask is set where a row fails filter i.
FILTERS = "ABCDE"

_WHOLE = (1 << len(FILTERS)) - 1


def _rows(docs: DataFrame) -> DataFrame:
    """The columns that are read, under own names, and what text alone decides; a row is known by id and text hash."""
    text = F.coalesce(quoted("text"), F.lit(""))
    return docs.select(
        quoted("doc_id").alias("id"), F.xxhash64(text).alias("hash"), F.coalesce(quoted("lang"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"), F.char_length(text).cast("long").alias("chars"), F.regexp_count(text, F.lit("[A-Z]")).cast("long").alias("upper"), text.rlike(r"[#$%&*|]").alias("sign"),
    )


def _word_counts(docs: DataFrame) -> DataFrame:
    """words and uniques of every (id, hash) that has a word.

    Rows that repeat an id and a text become one, in the tasks that read them first. Texts are
    dealt out by id and hash; there words are exploded and counted by (row, word), then by row:
    both keys begin with what texts were dealt by, so words themselves are not shuffled.
    """
    text = F.coalesce(quoted("text"), F.lit(""))
    texts = docs.select(quoted("doc_id").alias("id"), F.xxhash64(text).alias("hash"), text.alias("text")).groupBy("id", "hash").agg(F.first("text").alias("text"))
    words = texts.select("id", "hash", F.split("text", r"[\x20\x09-\x0D]+").alias("words")).select("id", "hash", F.explode("words").alias("word")).where("word <> ''")
    by_word = words.groupBy("id", "hash", "word").agg(F.count("*").alias("c"))
    return by_word.groupBy("id", "hash").agg(F.sum("c").alias("words"), F.count("*").alias("uniques"))


def _flagged(docs: DataFrame, labels: DataFrame, least_words: int, distinct_percent: int, upper_percent: int) -> DataFrame:
    """Rows counted by (digest, part, id, good, toxic) and the mask of filters A to D."""
    rows = _rows(docs).groupBy("id", "hash", "part", "digest", "chars", "upper", "sign").agg(F.count("*").alias("n"))
    rows = written(rows, "audit-rows")
    counted = written(_word_counts(docs).withColumnsRenamed({"id": "i", "hash": "h"}), "audit-words")
    label = labels.select(quoted("doc_id").alias("l"), (quoted("quality") == 1).alias("good"), (quoted("toxic") == 1).alias("toxic")).where("l IS NOT NULL").groupBy("l").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    label = written(label.where("good OR toxic"), "audit-labels")
    out = rows.join(counted, F.col("i").eqNullSafe(F.col("id")) & (F.col("h") == F.col("hash")), "left").join(label, F.col("l") == F.col("id"), "left")
    words, uniques = F.coalesce("words", F.lit(0)), F.coalesce("uniques", F.lit(0))
    fails = (words < least_words, 100 * uniques < distinct_percent * words, 100 * F.col("upper") > upper_percent * F.col("chars"), F.col("sign"))
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    return written(out.select("digest", "part", "id", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), mask.alias("mask"), "n"), "audit-flagged")


def _masked(flagged: DataFrame) -> DataFrame:
    """n rows by part, mask of all filters, good and toxic: of a text's rows those of the least id pass E, as do those without an id.

    A text's rows, however many, are added up by (text, part, label) before the shuffle.
    """
    key = ["digest", "part", "good", "toxic", "mask"]
    by_id = flagged.groupBy(*key, "id").agg(F.sum("n").alias("n"))
    groups = by_id.groupBy(*key).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
        F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first"),
    )
    first = groups.groupBy("digest").agg(F.min("first.id").alias("least"))
    placed = groups.join(first, "digest")
    passing = F.col("unnamed") + F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    sides = F.array(F.struct(F.col("mask").alias("m"), passing.alias("k")), F.struct((F.col("mask") + (1 << FILTERS.index("E"))).alias("m"), (F.col("n") - passing).alias("k")))
    return placed.select("part", "good", "toxic", F.explode(sides).alias("s")).select("part", "good", "toxic", "s.m", "s.k")


def _conditional_counts(masked: DataFrame) -> DataFrame:
    """A row for each part: 32 conditional counts, of all rows, of good and of toxic ones."""
    condition = {"n": "", "good": " AND good", "toxic": " AND toxic"}
    return masked.groupBy("part").agg(*(F.expr(f"cast(sum(if(m = {m}{more}, k, 0)) AS bigint) AS {measure}_{m}") for measure, more in condition.items() for m in range(_WHOLE + 1)))


def _orders() -> list[tuple[str, int, int, int]]:
    """Order, step, the bit of the filter of the step, and the bits of those before."""
    out = []
    for order in itertools.permutations(range(len(FILTERS))):
        before = 0
        for step, i in enumerate(order, 1):
            out.append(("".join(FILTERS[j] for j in order), step, 1 << i, before))
            before |= 1 << i
    return out


def _steps(counts: DataFrame) -> DataFrame:
    """A row for each part, order and step, from the part's conditional counts."""
    orders = ", ".join(f"named_struct('filter_order', '{order}', 'step', {step}, 'bit', {bit}, 'before', {before})" for order, step, bit, before in _orders())  # 600 structs

    def added(measure: str, condition: str, times: str = "x") -> Column:
        cells = ", ".join(f"{measure}_{m}" for m in range(_WHOLE + 1))
        return F.expr(f"aggregate(transform(array({cells}), (x, m) -> if({condition}, {times}, 0L)), 0L, (a, x) -> a + x)")

    fails, earlier = "m & bit <> 0", "m & before <> 0"
    # of the 120 orders, those in which the filter comes first among a row's k failures are one in k
    share = f"x * ({math.factorial(len(FILTERS))} div greatest(1, bit_count(m)))"
    return counts.selectExpr("*", f"inline(array({orders}))").select(
        "part", "filter_order", "step", added("n", f"NOT ({fails}) AND NOT ({earlier})").alias("kept"), added("n", f"{fails} AND NOT ({earlier})").alias("removed"),
        added("n", f"{fails} AND {earlier}").alias("redundant"), added("n", "m = bit").alias("unique_fails"), added("good", f"{fails} AND NOT ({earlier})").alias("good_lost"),
        added("toxic", f"{fails} AND NOT ({earlier})").alias("toxic_lost"), added("n", fails, share).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, least_words: int = 200, distinct_percent: int = 50, upper_percent: int = 3) -> DataFrame:
    """One row a part (language; null as the empty string), order of the five filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley.

    A fails under ``least_words`` words (maximal runs without ASCII white space); B where 100 x
    distinct words is under ``distinct_percent`` x words; C where 100 x [A-Z] is over
    ``upper_percent`` x code points; D with one of #$%&*|; E where a smaller id has the same text.

    Null and empty texts are one text without words: it fails A, and E but for the least id. A
    row without an id has no smaller one and passes E, and has no label. Rows that repeat an id
    are judged by their own texts, and none of them is a smaller id's; an id's labels are good
    or toxic if any of them is. Ties: equal ids of one text all pass E. Other columns are not
    read, so they cannot clash. An empty table gives an empty result. A very long text's words
    are exploded in its task and spread after that.
    """
    flagged = _flagged(docs, labels, least_words, distinct_percent, upper_percent)
    return _steps(written(_conditional_counts(_masked(flagged)), "audit-counts"))

"""Joins and matches: positional, tolerance, nearest, interval, suffix and token matches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.folders import shared_folder


def left_merge(frames: DataFrame, extra: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Columns of ``extra`` where it has a value, those of ``frames`` otherwise; unmatched frames stay."""
    more = extra.select(*keys, *(F.col(c).alias(f"__{c}") for c in columns))
    return frames.join(more, keys, "left").select(*(F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in frames.columns), *(F.col(f"__{c}").alias(c) for c in columns if c not in frames.columns))


def status(present: dict[str, Column], good: Column, otherwise: str = "no overlap") -> Column:
    """The first part that is missing, `ok`, or why not."""
    out = None
    for name, there in present.items():
        out = F.when(~there, f"{name} missing") if out is None else out.when(~there, f"{name} missing")
    return out.when(good, "ok").otherwise(otherwise)


def _ranges(left: DataFrame, right: DataFrame, key: str, at: str, hit: Column) -> DataFrame:
    """Both sides in ranges of (key, place), written: __key, __at, __l (a left row, or null), __hit (of a right row) and __range.

    Right rows come before left rows of their place; left rows of one place are told apart by
    their hash, so ranges are even whatever key, or place, holds most rows.
    """
    spark = left.sparkSession
    whole = F.struct(*left.columns)
    mine = left.select(F.col(key).alias("__key"), F.col(at).alias("__at"), F.lit(1).alias("__side"), F.xxhash64(whole).alias("__tie"), whole.alias("__l"))
    theirs = right.select(F.col(key).alias("__key"), F.col(at).alias("__at"), F.lit(0).alias("__side"), F.lit(0).cast("long").alias("__tie"), hit.alias("__hit"))
    both = mine.unionByName(theirs, allowMissingColumns=True)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_folder(spark, "ranges")
    cut = both.repartitionByRange(ranges, "__key", "__at", "__side", "__tie").withColumn("__range", F.spark_partition_id())
    cut.write.parquet(path)
    return spark.read.schema(cut.schema).parquet(path)


def _neighbours(cut: DataFrame) -> DataFrame:
    """The left rows with __before and __after: the hits next to them in the order of their key.

    Within a range by a window over its rows of a key; across ranges by the last hit before
    and the first hit after each range, one row a range.
    """
    place = F.struct("__key", "__at")
    ends = cut.where("__side = 0").groupBy("__range").agg(F.max_by(F.struct("__key", "__hit"), place).alias("last"), F.min_by(F.struct("__key", "__hit"), place).alias("first"))
    order = Window.partitionBy(F.lit(1)).orderBy("__range")  # one row for each range
    all_ = cut.select("__range").distinct().join(ends, "__range", "left")
    carried = all_.select("__range", F.last("last", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("__c"), F.first("first", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("__d"))
    w = Window.partitionBy("__range", "__key")
    back = w.orderBy("__at", "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = w.orderBy("__at", "__side").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    near = cut.withColumn("__b", F.last("__hit", ignorenulls=True).over(back)).withColumn("__a", F.first("__hit", ignorenulls=True).over(ahead)).where("__side = 1")
    same = lambda c: F.when(F.col(f"{c}.__key").eqNullSafe(F.col("__key")), F.col(f"{c}.__hit"))
    return near.join(F.broadcast(carried), "__range").select("__l", "__at", F.coalesce("__b", same("__c")).alias("__before"), F.coalesce("__a", same("__d")).alias("__after"))


def nearest(left: DataFrame, right: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """Each left row with the right row of its key least far in ``at``; of two as far the earlier one, of two at one place the lesser value.

    Both sides are cut into ranges of key and place and looked over in either direction: no
    pairs, and a key of any size is spread. A left row without a place, or whose key has no
    right row, has nulls; right rows without a place are left out.
    """
    places = right.where(F.col(at).isNotNull()).groupBy(key, at).agg(F.min(value).alias(value))
    met = _neighbours(_ranges(left, places, key, at, F.struct(F.col(at).alias("t"), F.col(value).alias("v"))))
    far = lambda c: F.abs(F.col(f"{c}.t") - F.col("__at"))
    pick = F.when(F.col("__after").isNull() | (far("__before") <= far("__after")), F.col("__before")).otherwise(F.col("__after"))
    return met.withColumn("__p", F.when(F.col("__at").isNotNull(), pick)).select("__l.*", F.col("__p.t").alias(f"matched_{at}"), F.col("__p.v").alias(f"matched_{value}"))


def intervals(points: DataFrame, rounds: DataFrame, key: str, at: str, start: str, number: str) -> DataFrame:
    """Each point with the last interval that starts at or before it: intervals follow one another, past the end the last holds.

    A point before the first interval, or without a place, has none; of intervals that start at
    one place the greatest number holds. Cut into ranges as ``nearest``.
    """
    starts = rounds.where(F.col(start).isNotNull()).groupBy(key, F.col(start).cast(points.schema[at].dataType).alias(at)).agg(F.max(number).alias(number))
    met = _neighbours(_ranges(points, starts, key, at, F.struct(F.col(number).alias("v"))))
    return met.select("__l.*", F.when(F.col("__at").isNotNull(), F.col("__before.v")).alias(number))


def tolerance(left: DataFrame, right: DataFrame, left_id: str, right_id: str, length: str, value: str, within: float) -> DataFrame:
    """left_id and right_id: the least right id of equal length whose value differs by at most ``within``; else the least of equal length.

    No pairs are made: values are dealt into bins a little narrower than ``within``, so all of a
    bin are close to each other, and what else is close to a value is an end of the bin before
    and a beginning of the bin after it: running minima. Values near the very bound, where
    rounding decides, are met in narrow cells and compared. Equal values are one row on either side.
    """
    x, y = F.col("__x").cast("double"), F.col("__y").cast("double")
    lefts = left.select(length, F.col(value).alias("__x")).distinct()
    rights = right.where(F.col(value).isNotNull()).groupBy(length, F.col(value).alias("__y")).agg(F.min(right_id).alias("__id"))
    exact = F.abs(F.col("__x") - F.col("__y")) <= within
    # of values so much greater than the bound the places below are not exact: they meet in bins
    great = within * 2.0**30
    usual, others = lefts.where(F.abs(x) < great), rights.where(F.abs(y) < 2 * great)
    width, margin = within * (1 - 2.0**-20), within * 2.0**-19
    in_bin = lambda c: F.floor(c / width).cast("long")
    own = others.groupBy(length, in_bin(y).alias("__bin")).agg(F.min("__id").alias("__id"))
    found = usual.withColumn("__bin", in_bin(x)).join(own, [length, "__bin"]).select(length, "__x", "__id")
    # ends are beginnings of the values with the other sign
    ends, starts = (F.struct((in_bin(c) + b).alias("bin"), (s * (c + t)).alias("at"), F.lit(s).alias("sign")) for c, b, t, s in ((x, -1, margin - within, -1), (x, 1, within - margin, 1)))
    asked = usual.select(length, "__x", F.explode(F.array(ends, starts)).alias("__p")).withColumn("__side", F.lit(1))
    placed = [F.struct(in_bin(y).alias("bin"), (s * y).alias("at"), F.lit(s).alias("sign")) for s in (-1, 1)]
    held = others.select(length, "__id", F.explode(F.array(*placed)).alias("__p")).withColumn("__side", F.lit(0))
    run = Window.partitionBy(length, "__p.bin", "__p.sign").orderBy("__p.at", "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ran = asked.unionByName(held, allowMissingColumns=True).withColumn("__id", F.min("__id").over(run)).where((F.col("__side") == 1) & F.col("__id").isNotNull())
    cell = lambda c: F.floor(c / (2 * margin)).cast("long")
    bounds = F.array(*(cell(x + t) + i for t in (-within, within) for i in (-1, 0, 1)))
    edge = usual.withColumn("__cell", F.explode(F.array_distinct(bounds))).join(others.withColumn("__cell", cell(y)), [length, "__cell"]).where(exact)
    near = lambda c: F.floor(c / within).cast("long")
    far = lefts.where(F.abs(x) >= great).withColumn("__bin", F.explode(F.array(*(near(x) + i for i in (-2, -1, 0, 1, 2))))).join(rights.where(F.abs(y) >= great / 2).withColumn("__bin", near(y)), [length, "__bin"]).where(exact)
    close = found
    for part in (ran, edge, far):
        close = close.unionByName(part.select(length, "__x", "__id"))
    close = close.groupBy(length, F.col("__x").alias(value)).agg(F.min("__id").alias("__close"))
    equal = right.groupBy(length).agg(F.min(right_id).alias("__equal"))
    return left.join(close, [length, value], "left").join(equal, length, "left").select(left_id, F.coalesce("__close", "__equal").alias(right_id), F.col("__close").isNotNull().alias("close"))


def tolerance_vectors(left: DataFrame, right: DataFrame, left_id: str, right_id: str, length: str, vector: str, within: Sequence[float], grid: int = 3) -> DataFrame:
    """left_id and right_id: the least right id of equal length whose vector differs by at most ``within`` in each dimension; else the least of equal length; and whether it is close.

    The first ``grid`` dimensions are cut into cells as wide as their bounds: a vector meets its
    own cell and those beside it, and there each dimension is compared. Right vectors that are
    alike are met once, as their least id. Null vectors and ones too short are close to none.
    """
    size = len(within)
    if not 0 < grid <= size:
        raise ValueError("the grid has one dimension at least, and no more than there are bounds")
    cell = lambda i: F.floor(F.get(vector, F.lit(i)) / within[i]).cast("long")
    known = lambda df: df.where((F.size(vector) >= size) & F.col(length).isNotNull())
    names = [f"__g{i}" for i in range(grid)]
    alike = known(right).select(right_id, length, F.slice(vector, 1, size).alias(vector)).groupBy(length, vector).agg(F.min(right_id).alias("__r"))
    cells = alike.select(length, F.col(vector).alias("__y"), "__r", *(cell(i).alias(n) for i, n in enumerate(names)))
    probes = known(left).select(left_id, length, F.col(vector).alias("__x"), *(cell(i).alias(n) for i, n in enumerate(names)))
    for n in names:
        probes = probes.withColumn(n, F.explode(F.array(F.col(n) - 1, F.col(n), F.col(n) + 1)))
    near = F.lit(True)
    for i, w in enumerate(within):
        near = near & (F.abs(F.get("__x", F.lit(i)) - F.get("__y", F.lit(i))) <= w)
    close = probes.join(cells, [length, *names]).where(near).groupBy(left_id).agg(F.min("__r").alias("__close"))
    equal = right.groupBy(length).agg(F.min(right_id).alias("__equal"))
    return left.join(close, left_id, "left").join(equal, length, "left").select(left_id, F.coalesce("__close", "__equal").alias(right_id), F.col("__close").isNotNull().alias("close"))


def suffix(left: DataFrame, right: DataFrame, left_key: str, right_key: str, right_id: str, shortest: int = 1) -> DataFrame:
    """Each left row with the right row of the same key, else the first (by id) whose key ends the left key.

    Every left key is looked up by its endings, as equal keys: no theta join.
    """
    ends = left.select(left_key).distinct().withColumn("__e", F.explode(F.sequence(F.lit(1), F.greatest(F.length(left_key) - shortest + 1, F.lit(1))))).select(left_key, F.expr(f"substring({left_key}, __e)").alias("__end"), (F.col("__e") == 1).alias("__whole"))
    met = ends.join(right.select(F.col(right_key).alias("__end"), right_id), "__end")
    best = met.groupBy(left_key).agg(F.min(F.struct((~F.col("__whole")).alias("later"), F.col(right_id).alias("id"))).alias("__b"))
    return left.join(best.select(left_key, F.col("__b.id").alias(right_id), (~F.col("__b.later")).alias("exact")), left_key, "left")


def token_matches(left: DataFrame, right: DataFrame, idf: DataFrame, threshold: float = 0.35, margin: float = 0.10, missing: float = 1.0) -> DataFrame:
    """left_id, right_id and score: IDF-weighted Jaccard of token sets, at the threshold or over and within ``margin`` of the left row's best.

    Both sides have id and token (distinct rows). Rows meet at the tokens of their prefixes
    alone, see ``prefix_candidates``; a token without idf weighs ``missing``.
    """
    weigh = lambda df, name: df.join(idf.select("token", "idf"), "token", "left").select(F.col("id").alias(name), "token", F.coalesce("idf", F.lit(missing)).alias("w"))
    a, b = weigh(left, "left_id"), weigh(right, "right_id")
    size_a, size_b = a.groupBy("left_id").agg(F.sum("w").alias("wa")), b.groupBy("right_id").agg(F.sum("w").alias("wb"))
    pairs = prefix_candidates(a, b, threshold)
    shared = pairs.join(a, "left_id").join(b.drop("w"), ["right_id", "token"]).groupBy("left_id", "right_id").agg(F.sum("w").alias("both"))
    scored = shared.join(size_a, "left_id").join(size_b, "right_id").withColumn("score", F.col("both") / (F.col("wa") + F.col("wb") - F.col("both"))).where(F.col("score") >= threshold)
    top = F.max("score").over(Window.partitionBy("left_id"))
    return scored.withColumn("__t", top).where(F.col("score") >= F.col("__t") - margin).select("left_id", "right_id", "score")


def prefix_candidates(a: DataFrame, b: DataFrame, threshold: float) -> DataFrame:
    """left_id and right_id of all rows that can reach the threshold, of (left_id, token, w) and (right_id, token, w).

    Tokens are in one order, heaviest (rarest) first. What two rows share is at or after their
    first common token in both, and weighs ``threshold`` of either row at least: so a row needs
    to be met only at tokens from which on it still weighs that much, and where they meet, both
    must weigh enough for what they weigh together. Weights are positive.
    """
    slack = 1e-9  # sums of doubles

    def prefix(df: DataFrame, id_: str, name: str) -> DataFrame:
        own = Window.partitionBy(id_)
        rest = F.sum("w").over(own.orderBy(F.desc("w"), "token").rowsBetween(Window.currentRow, Window.unboundedFollowing))
        weighed = df.withColumn(f"rest_{name}", rest).withColumn(f"all_{name}", F.sum("w").over(own))
        return weighed.where(F.col(f"rest_{name}") >= threshold * F.col(f"all_{name}") - slack).drop("w")

    met = prefix(a, "left_id", "a").join(prefix(b, "right_id", "b"), "token")
    enough = F.least("rest_a", "rest_b") * (1 + threshold) >= threshold * (F.col("all_a") + F.col("all_b")) - slack
    return met.where(enough).select("left_id", "right_id").distinct()


def coverage(steps: DataFrame, plans: DataFrame, least: float = 0.6) -> DataFrame:
    """For each key the greatest plan index that its steps cover, the plan's size, and truncated (index < size - 2).

    A step covers the first plan entry equal to it, else the entry of best Jaccard of words
    (the first of equals) at ``least`` or over. ``steps``: key, step; ``plans``: key, plan (array).
    """
    from ..functions.texts import jaccard

    words = lambda c: F.array_distinct(F.split(F.lower(c), " "))
    joined = steps.join(plans, "key")
    scores = F.transform(F.col("plan"), lambda p: jaccard(words(p), words(F.col("step"))))
    exact = F.array_position("plan", F.col("step")) - 1
    best = F.when(F.array_max(scores) >= least, F.array_position(scores, F.array_max(scores)) - 1)
    found = joined.select("key", F.size("plan").alias("size"), F.when(exact >= 0, exact).otherwise(best).alias("at"))
    return found.groupBy("key").agg(F.max("at").cast("long").alias("covered"), F.max("size").cast("long").alias("size")).withColumn("truncated", F.coalesce(F.col("covered"), F.lit(-1)) < F.col("size") - 2)

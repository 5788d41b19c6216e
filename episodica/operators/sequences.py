"""Operators on ordered frames of episodes, as window expressions.

``ep`` and ``order`` name the columns that make an episode and order its frames. An
episode is a bounded recording; episodes are what is spread over the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .order import running

EP, FRAME = "ep", "frame"


def ordered(ep: str = EP, order: str = FRAME) -> WindowSpec:
    return Window.partitionBy(ep).orderBy(order)


def whole(ep: str = EP) -> WindowSpec:
    return Window.partitionBy(ep)


def gather(df: DataFrame, value: str, deltas: Sequence[int], clamp: bool = True, ep: str = EP, order: str = FRAME) -> DataFrame:
    """Rows (…, delta, got): the value ``delta`` frames on; beyond the ends the end's value, or 0."""
    w = ordered(ep, order)
    ends = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    out = []
    for d in deltas:
        there = F.lead(F.struct(F.col(value).alias("x")), d).over(w)
        end = (F.first(value) if d < 0 else F.last(value)).over(ends) if clamp else F.lit(0.0)
        out.append(F.struct(F.lit(d).cast("long").alias("delta"), F.when(there.isNotNull(), there["x"]).otherwise(end).alias("got")))
    return df.withColumn("__g", F.array(*out)).select("*", F.inline("__g")).drop("__g")


def chunk(df: DataFrame, value: str, size: int, ep: str = EP, order: str = FRAME) -> DataFrame:
    """``chunk``: the next ``size`` values, the last one repeated."""
    some = F.collect_list(value).over(ordered(ep, order).rowsBetween(0, size - 1))
    return df.withColumn("chunk", some).withColumn("chunk", F.concat("chunk", F.array_repeat(F.element_at("chunk", -1), F.lit(size) - F.size("chunk"))))


def moves(chunk_col: Column, threshold: float = 1e-3) -> Column:
    """Whether the first half of a chunk leaves its first value by over the threshold."""
    half = F.slice(chunk_col, 1, F.greatest(F.lit(1), F.floor(F.size(chunk_col) / 2).cast("int")))
    return F.exists(half, lambda x: F.abs(x - F.element_at(chunk_col, 1)) > threshold)


def first_difference(value: str, w: WindowSpec) -> Column:
    """v - previous; the first repeats the second's, and alone is 0."""
    return F.coalesce(F.col(value) - F.lag(value).over(w), F.lead(value).over(w) - F.col(value), F.lit(0.0))


def fill(value: Column, w: WindowSpec) -> Column:
    """The last known value; before the first known one, that."""
    before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return F.coalesce(F.last(value, ignorenulls=True).over(before), F.first(value, ignorenulls=True).over(after))


def toggles(df: DataFrame, value: str, ep: str = EP, order: str = FRAME) -> DataFrame:
    """``state`` (scaled by the episode's range and rounded half to even) and ``toggle``: the frame of the latest change, 0 before any."""
    low, high = F.min(value).over(whole(ep)), F.max(value).over(whole(ep))
    state = F.when(high - low > 1e-6, F.bround((F.col(value) - low) / (high - low))).otherwise(F.lit(0.0)).cast("long")
    df = df.withColumn("state", state)
    w = ordered(ep, order)
    changed = F.col("state") != F.lag("state").over(w)
    return df.withColumn("__c", F.when(changed, F.col(order))).withColumn("toggle", F.coalesce(F.max("__c").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0)).cast("long")).drop("__c")


def edges(df: DataFrame, value: str, ep: str = EP, order: str = FRAME) -> DataFrame:
    """ep, frame and kind (rise, fall) where the value crosses the middle of the episode's range; none in flat episodes."""
    low, high = F.min(value).over(whole(ep)), F.max(value).over(whole(ep))
    up = df.withColumn("__up", F.when(high > low, F.col(value) > (low + high) / 2))
    up = up.withColumn("__was", F.lag("__up").over(ordered(ep, order)))
    return up.where(F.col("__up") != F.col("__was")).select(ep, order, F.when(F.col("__up"), "rise").otherwise("fall").alias("kind"))


def runs(df: DataFrame, label: str, ep: str = EP, order: str = FRAME) -> DataFrame:
    """``run``: the number of the run of equal labels that each frame is in, from 0."""
    w = ordered(ep, order)
    new = F.coalesce(~F.col(label).eqNullSafe(F.lag(label).over(w)), F.lit(True)) & (F.row_number().over(w) > 1)
    return df.withColumn("__new", new.cast("long")).withColumn("run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("__new")


def run_ranges(df: DataFrame, label: str, ep: str = EP, order: str = FRAME) -> DataFrame:
    """ep, run, label, start, end (inclusive) and frames of each run."""
    return runs(df, label, ep, order).groupBy(ep, "run").agg(F.first(label).alias(label), F.min(order).alias("start"), F.max(order).alias("end"), F.count("*").alias("frames"))


def first_ordinals(df: DataFrame, label: str, ep: str = EP, order: str = FRAME) -> DataFrame:
    """``ordinal``: the rank of a label by its first frame in the episode; ``last``: its last frame there."""
    mine = Window.partitionBy(ep, label)
    df = df.withColumn("__first", F.min(order).over(mine)).withColumn("last", F.max(order).over(mine))
    return df.withColumn("ordinal", (F.dense_rank().over(Window.partitionBy(ep).orderBy("__first")) - 1).cast("long")).drop("__first")


def run_labels(df: DataFrame, label: str, ep: str = EP, order: str = FRAME) -> DataFrame:
    """ep and ``labels``, those of its runs in order."""
    ranges = run_ranges(df, label, ep, order)
    return ranges.groupBy(ep).agg(F.transform(F.array_sort(F.collect_list(F.struct("run", label))), lambda x: x[label]).alias("labels"))


def keep_moving(df: DataFrame, motion: str, jump: str, ep: str = EP, order: str = FRAME, threshold: float = 1e-3, step: float = 0.5) -> DataFrame:
    """Frames that move or whose gripper jumps, and the first and the last, numbered anew (``kept_frame``)."""
    w = ordered(ep, order)
    keep = (F.col(motion) > threshold) | (F.abs(F.col(jump) - F.lag(jump).over(w)) > step) | F.lag(order).over(w).isNull() | F.lead(order).over(w).isNull()
    return df.withColumn("__k", keep).where("__k").drop("__k").withColumn("kept_frame", (F.row_number().over(w) - 1).cast("long"))


def range_sum(df: DataFrame, value: str, ahead: int, ep: str = EP, order: str = FRAME) -> DataFrame:
    """``moved``: the sum over the next ``ahead`` frames, this one included, up to the end."""
    return df.withColumn("moved", F.sum(value).over(ordered(ep, order).rowsBetween(0, ahead - 1)))


def horizon(df: DataFrame, value: str, points: int, ep: str = EP, order: str = FRAME) -> DataFrame:
    """``next`` (clamped at the end) and ``path``: the next ``points`` values, nulls left out."""
    w = ordered(ep, order)
    return df.withColumn("next", F.coalesce(F.lead(value).over(w), F.col(value))).withColumn("path", F.collect_list(value).over(w.rowsBetween(0, points - 1)))


def key_frames(ranges: DataFrame, kind: str = "ends", k: int = 3, stride: int = 1) -> DataFrame:
    """Frames of each run (with start and end): its first, middle and last; k even ones; or every stride-th."""
    length = F.col("end") - F.col("start")
    at = {
        "ends": F.array_distinct(F.array("start", F.floor((F.col("start") + F.col("end")) / 2).cast("long"), "end")),
        "even": F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (F.col("start") + i * length / max(k - 1, 1)).cast("long"))),
        "stride": F.sequence(F.col("start"), F.col("end"), F.lit(stride).cast("long")),
    }[kind]
    return ranges.select("ep", "run", F.explode(at).alias("frame"))


def offsets(lengths: DataFrame, key: str, length: str = "length") -> DataFrame:
    """``offset``: lengths of all earlier keys, summed in ranges of the key."""
    return running(lengths, key, amount=F.col(length).cast("long"), name="offset")


def spread_plan(ranges: DataFrame, plan: Sequence[str], ep: str = EP) -> DataFrame:
    """``step``: the plan's steps spread over an episode's runs, rounded half to even."""
    total = F.count("*").over(whole(ep))
    at = F.bround(F.col("run") * (len(plan) - 1) / F.greatest(total - 1, F.lit(1))).cast("int")
    return ranges.withColumn("step", F.element_at(F.array(*map(F.lit, plan)), at + 1))


def samples(df: DataFrame, ep: str = EP, order: str = FRAME) -> DataFrame:
    """Each frame with its next one as ``target``; the last has none and goes."""
    return df.withColumn("target", F.lead(order).over(ordered(ep, order))).where(F.col("target").isNotNull())


def combined_id(spatial: Column, orient: Column, gripper: Column) -> Column:
    """Literal arithmetic; ids collide once a gripper frame reaches 100."""
    return spatial * 10000 + orient * 100 + gripper


def moving_order(df: DataFrame, value: str, thing: str, ep: str = EP, order: str = FRAME, least: float = 60.0, points: int = 3) -> DataFrame:
    """Things that move by ``least`` in all over ``points`` frames, in the order of their centres of movement.

    ``centre`` weighs frames by speed; ``until`` is the middle to the next thing's centre.
    """
    w = Window.partitionBy(ep, thing).orderBy(order)
    speed = df.withColumn("__v", F.abs(F.col(value) - F.lag(value).over(w))).where(F.col("__v").isNotNull())
    moved = speed.groupBy(ep, thing).agg(F.sum("__v").alias("total"), (F.count("*") + 1).alias("n"), F.try_divide(F.sum(F.col(order) * F.col("__v")), F.sum("__v")).alias("centre"))
    moved = moved.where((F.col("total") >= least) & (F.col("n") >= points))
    by = Window.partitionBy(ep).orderBy("centre", thing)
    return moved.withColumn("round", (F.row_number().over(by) - 1).cast("long")).withColumn("until", (F.col("centre") + F.lead("centre").over(by)) / 2)

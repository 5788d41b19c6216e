"""Exact quantiles by distributed selection.

Each wanted rank keeps an interval of values that it lies in. A pass counts the rows of every
interval in equal bins and goes on with the bin that holds the rank, so what is shuffled is a
row for each bin, and no task holds the values of a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.folders import shared_folder

#: Bins an interval is cut into by a pass.
BINS = 4096

#: Rows of a key, or of an interval, that are gathered and sorted at once.
GATHERED = 100_000


def quantile_name(q: float) -> str:
    return f"q{round(q * 100):02d}"


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], *keys: str, bins: int = BINS, gathered: int = GATHERED) -> DataFrame:
    """keys and a column q01, q50, ... for each of ``qs``: between the two values around rank q x (n - 1), in proportion.

    Keys of up to ``gathered`` rows are aggregated at once; larger ones by passes over their
    rows, each of which narrows the intervals of the wanted ranks ``bins`` times, until an
    interval has ``gathered`` rows or one value. Null values are left out; a key without others
    has no row. A null key is a key.
    """
    rows = df.select(*keys, F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    names = [quantile_name(q) for q in qs]
    at_once = lambda some: some.groupBy(*keys).agg(*(F.percentile("v", F.lit(q)).alias(n) for q, n in zip(qs, names, strict=True)))
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    if (sizes.agg(F.max("n")).first()[0] or 0) <= gathered:
        return at_once(rows)
    sizes = _written(sizes, "quantile-keys")
    small, large = sizes.where(F.col("n") <= gathered), sizes.where(F.col("n") > gathered)
    found = _selected(rows, large, qs, keys, bins, gathered)
    share = lambda q: F.lit(q) * (F.col("n") - 1) - F.floor(F.lit(q) * (F.col("n") - 1))
    of = lambda i, side: F.max(F.when((F.col("q") == i) & (F.col("side") == side), F.col("x")))
    wide = found.groupBy(*keys).agg(F.first("n").alias("n"), *(of(i, s).alias(f"x{i}{s}") for i in range(len(qs)) for s in (0, 1)))
    many = wide.select(*keys, *((F.col(f"x{i}0") + (F.col(f"x{i}1") - F.col(f"x{i}0")) * share(q)).alias(n) for i, (q, n) in enumerate(zip(qs, names, strict=True))))
    if not keys:
        return many
    return at_once(rows.alias("r").join(small.select(*keys).alias("k"), _same("r", "k", keys), "left_semi")).unionByName(many)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _same(a: str, b: str, keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return out


def _selected(rows: DataFrame, sizes: DataFrame, qs: Sequence[float], keys: Sequence[str], bins: int, gathered: int) -> DataFrame:
    """keys, n, q, side and x: the value of rank floor (side 0) and ceiling (side 1) of q x (n - 1)."""
    ranks = F.array(*(F.struct(F.lit(i).alias("q"), F.lit(s).alias("side"), (F.ceil if s else F.floor)(F.lit(q) * (F.col("n") - 1)).cast("long").alias("rank")) for i, q in enumerate(qs) for s in (0, 1)))
    # lo..hi are values that are there; ``rank`` is the rank among the rows from lo to hi, ``inside`` their number
    state = sizes.select(*keys, "n", "lo", "hi", F.col("n").alias("inside"), F.inline(ranks))
    state, done = _written(state, "quantile-ranks"), None
    while True:
        ready = (F.col("lo") == F.col("hi")) | (F.col("inside") <= gathered)
        finished = state.where(ready)
        done = finished if done is None else done.unionByName(finished)
        state = state.where(~ready)
        if state.isEmpty():
            break
        state = _written(_narrowed(rows, state, keys, bins), "quantile-ranks")
    id_ = [*keys, "n", "q", "side"]
    value = done.where("lo = hi").select(*id_, F.col("lo").alias("x"))
    open_ = done.where("lo < hi")
    met = _inside(rows, open_, keys).groupBy(*[F.col(f"s.{c}").alias(c) for c in (*id_, "rank")]).agg(F.sort_array(F.collect_list("r.v")).alias("vs"))
    return value.unionByName(met.select(*id_, F.get("vs", F.col("rank").cast("int")).alias("x")))


def _inside(rows: DataFrame, state: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.alias("r").join(state.alias("s"), _same("r", "s", keys) & F.col("r.v").between(F.col("s.lo"), F.col("s.hi")))


def _narrowed(rows: DataFrame, state: DataFrame, keys: Sequence[str], bins: int) -> DataFrame:
    """Each rank's interval down to the values of the bin that holds it."""
    id_ = [*keys, "n", "q", "side"]
    # halves, so that the widest range does not overflow
    part = (F.col("r.v") / 2 - F.col("s.lo") / 2) / (F.col("s.hi") / 2 - F.col("s.lo") / 2)
    bin_ = F.least(F.lit(bins - 1), F.floor(part * bins)).alias("bin")
    counted = _inside(rows, state, keys).select(*(F.col(f"s.{c}").alias(c) for c in (*id_, "rank")), F.col("r.v").alias("v"), bin_)
    counted = counted.groupBy(*id_, "rank", "bin").agg(F.count("*").alias("inside"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    before = F.sum("inside").over(Window.partitionBy(*id_).orderBy("bin")) - F.col("inside")  # at most ``bins`` rows
    here = counted.withColumn("before", before).where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("inside")))
    return here.select(*keys, "n", "lo", "hi", "inside", "q", "side", (F.col("rank") - F.col("before")).alias("rank"))

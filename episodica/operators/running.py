"""Aggregates with a merge of their own, and running statistics of vectors made with them.

An aggregate is built in each task over its Arrow batches; what tasks have built is merged
as a tree, so a task never holds more than a few states of one key.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import Any, Protocol, Self

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.folders import shared_folder

#: States of one key that meet in a task.
FAN_IN = 64

#: Size of the states that a task holds before it gives them away, in entries of ``Mergeable.size``.
HELD = 4_000_000


class Mergeable(Protocol):
    """A user-defined aggregate: ``merge`` must not depend on order or grouping."""

    #: Columns that are read, and the state's columns as a DDL schema.
    reads: Sequence[str]
    schema: str

    @classmethod
    def of(cls, rows: pa.RecordBatch) -> Self:
        """The state of some rows."""

    @classmethod
    def stored(cls, row: dict[str, Any]) -> Self:
        """A state again from its row."""

    def merge(self, other: Self) -> Self: ...

    def row(self) -> dict[str, Any]: ...

    def size(self) -> int: ...


def aggregate(df: DataFrame, kind: type[Mergeable], *keys: str, fan_in: int = FAN_IN, held: int = HELD) -> DataFrame:
    """keys and the columns of ``kind.schema``: one state for each key, in one pass over ``df``.

    Null keys are a key. An empty table has no states.
    """
    types = dict(df.dtypes)
    key_schema = "".join(f"`{k}` {types[k]}, " for k in keys)
    out = f"{key_schema}__part int, {kind.schema}"
    spark = df.sparkSession
    arrow = spark.createDataFrame([], out).toArrow().schema
    names = arrow.names

    def batch_of(states: list[tuple[tuple, Any]], part: int) -> pa.RecordBatch:
        rows = [dict(zip(keys, key, strict=True)) | {"__part": part} | state.row() for key, state in states]
        return pa.RecordBatch.from_pylist([{n: r[n] for n in names} for r in rows], schema=arrow)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, states = TaskContext.get().partitionId(), {}
        for batch in batches:
            for key, rows in _by_key(batch, keys):
                new = kind.of(rows.select(list(kind.reads)))
                states[key] = states[key].merge(new) if key in states else new
            if sum(s.size() for s in states.values()) > held:
                yield batch_of(list(states.items()), part)
                states = {}
        yield batch_of(list(states.items()), part)

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        whole = kind.stored(rows[0])
        for r in rows[1:]:
            whole = whole.merge(kind.stored(r))
        return pa.Table.from_batches([batch_of([(tuple(rows[0][k] for k in keys), whole)], rows[0]["__part"])])

    path = shared_folder(spark, "states")
    df.select(*keys, *kind.reads).mapInArrow(build, out).write.parquet(path)
    states = spark.read.schema(out).parquet(path)
    last = states.agg(F.max("__part")).first()[0] or 0
    while True:  # levels of the tree: a state of a key for each ``fan_in`` of those below
        level = states.withColumn("__part", F.floor(F.col("__part") / fan_in).cast("int"))
        states = level.groupBy(*keys, "__part").applyInArrow(merge, out)
        last //= fan_in
        if not last:
            return states.drop("__part")


def _by_key(batch: pa.RecordBatch, keys: Sequence[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    if not keys:
        if batch.num_rows:
            yield (), batch
        return
    rows: dict[tuple, list[int]] = {}
    for i, key in enumerate(zip(*(batch.column(k).to_pylist() for k in keys), strict=True)):
        rows.setdefault(key, []).append(i)
    for key, at in rows.items():
        yield key, batch.take(pa.array(at))


def _exponent(low: float, high: float, bins: int) -> int:
    """The least power of two as bin width by which all values from ``low`` to ``high`` fall into ``bins`` bins, and bin numbers are exact."""
    exact = math.frexp(max(abs(low), abs(high)))[1] - 52
    e = max(-1000, exact, math.frexp(high / bins - low / bins)[1] - 1 if high > low else -1000)
    while math.floor(math.ldexp(high, -e)) - math.floor(math.ldexp(low, -e)) >= bins:
        e += 1
    return e


def vector_stats(vector: str, bins: int = 5000) -> type[Mergeable]:
    """Running count, mean, squares, extremes and a histogram of every dimension of a column of vectors.

    Bins are as wide as a power of two, which doubles as the range grows: two bins become one
    and no count is guessed, so the state depends on the rows alone, not on their order or on
    how they are dealt to tasks.
    """

    class VectorStats:
        reads = (vector,)
        schema = "n long, mean array<double>, squares array<double>, low array<double>, high array<double>, width array<int>, bin array<array<long>>, count array<array<long>>"

        def __init__(self, n, mean, squares, low, high, width, bin_, count):  # noqa: ANN001
            self.n, self.mean, self.squares, self.low, self.high, self.width, self.bin, self.count = n, mean, squares, low, high, width, bin_, count

        @classmethod
        def of(cls, rows: pa.RecordBatch) -> VectorStats:
            column = rows.column(vector).drop_null()
            sizes = np.diff(np.asarray(column.offsets))
            if len(set(sizes.tolist())) > 1:
                raise ValueError(f"vectors of {vector} differ in length: {sorted(set(sizes.tolist()))[:5]}")
            values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), float).reshape(len(column), -1)
            if not np.isfinite(values).all():
                raise ValueError(f"a value of {vector} is null or not finite")
            if not len(column):
                return cls(0, *(np.zeros(0) for _ in range(4)), [], [], [])
            mean, low, high = values.mean(axis=0), values.min(axis=0), values.max(axis=0)
            width = [_exponent(a, b, bins) for a, b in zip(low.tolist(), high.tolist(), strict=True)]
            found = [np.unique(np.floor(np.ldexp(values[:, i], -e)).astype(np.int64), return_counts=True) for i, e in enumerate(width)]
            return cls(len(values), mean, ((values - mean) ** 2).sum(axis=0), low, high, width, [b for b, _ in found], [c for _, c in found])

        @classmethod
        def stored(cls, row: dict[str, Any]) -> VectorStats:
            floats = (np.array(row[c], float) for c in ("mean", "squares", "low", "high"))
            return cls(row["n"], *floats, row["width"], *([np.array(x, np.int64) for x in row[c]] for c in ("bin", "count")))

        def row(self) -> dict[str, Any]:
            return {"n": self.n, "mean": self.mean, "squares": self.squares, "low": self.low, "high": self.high, "width": self.width, "bin": self.bin, "count": self.count}

        def size(self) -> int:
            return 5 * len(self.mean) + 2 * sum(map(len, self.bin))

        def merge(self, other: VectorStats) -> VectorStats:
            if not (self.n and other.n):
                return self if self.n else other
            if len(self.mean) != len(other.mean):
                raise ValueError(f"vectors of {vector} differ in length: {sorted((len(self.mean), len(other.mean)))}")
            n, apart = self.n + other.n, other.mean - self.mean
            mean = self.mean + apart * (other.n / n)
            squares = self.squares + other.squares + apart * apart * (self.n * other.n / n)
            low, high = np.minimum(self.low, other.low), np.maximum(self.high, other.high)
            width = [_exponent(a, b, bins) for a, b in zip(low.tolist(), high.tolist(), strict=True)]
            bin_, count = [], []
            for i, e in enumerate(width):
                # two bins of half the width are one, again and again: a shift of the bin's number
                both = np.concatenate([s.bin[i] >> min(62, e - s.width[i]) for s in (self, other)])
                at, which = np.unique(both, return_inverse=True)
                total = np.zeros(len(at), np.int64)
                np.add.at(total, which, np.concatenate([self.count[i], other.count[i]]))
                bin_.append(at)
                count.append(total)
            return VectorStats(n, mean, squares, low, high, width, bin_, count)

    return VectorStats


def running_statistics(df: DataFrame, vector: str, *keys: str, quantiles: Sequence[float] = (0.01, 0.99), bins: int = 5000, fan_in: int = FAN_IN) -> DataFrame:
    """keys, dim, n, mean, std (of the population), min, max and the quantiles of every dimension, in one pass.

    A quantile is the left edge of the first bin at which the count reaches q x n; a bin is at
    most 2 / ``bins`` of the range wide (unless the range is below the values' precision).
    Null vectors are left out. Under two vectors of a key, vectors of unequal length, and nulls
    or values that are not finite within one, raise an error. An empty table without keys has
    no rows.
    """
    states = aggregate(df, vector_stats(vector, bins), *keys, fan_in=fan_in)
    enough = F.when(F.col("n") < 2, F.raise_error(F.concat(F.lit("statistics need two vectors, not "), F.col("n").cast("string")))).otherwise(F.col("n"))
    dims = states.withColumn("n", enough).select(*keys, "n", F.posexplode(F.arrays_zip("mean", "squares", "low", "high", "width", "bin", "count")).alias("dim", "s"))

    def edge(q: float):  # noqa: ANN202
        start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("long").alias("at"))
        step = lambda a, x: F.struct((a["seen"] + x["count"]).alias("seen"), F.when(a["at"].isNull() & (a["seen"] + x["count"] >= q * F.col("n")), x["bin"]).otherwise(a["at"]).alias("at"))
        first = F.aggregate(F.arrays_zip(F.col("s.bin").alias("bin"), F.col("s.count").alias("count")), start, step, lambda a: a["at"])
        return (first * F.pow(F.lit(2.0), F.col("s.width"))).alias(f"q{round(q * 100):02d}")

    return dims.select(
        *keys, F.col("dim").cast("long").alias("dim"), "n", F.col("s.mean").alias("mean"), F.sqrt(F.col("s.squares") / F.col("n")).alias("std"),
        F.col("s.low").alias("min"), F.col("s.high").alias("max"), *(edge(q) for q in quantiles),
    )

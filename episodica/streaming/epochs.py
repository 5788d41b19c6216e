"""An endless stream of shuffled epochs over a table.

A position of the stream is an epoch and a place in it; a seeded permutation of the epoch says
which row of the table stands there. So each row comes once in every epoch, in another order,
and no buffer or state is kept: a stream that is started again goes on where it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.order import permuted, running
from ..sources.folders import shared_folder

#: Positions that one task permutes: some 40 hashes each.
ROWS = 250_000


def numbered(df: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """The rows with ``place``, 0 to n - 1 in their order, written; and n."""
    spark = df.sparkSession
    path = shared_folder(spark, "numbered")
    placed = running(df, *order)
    placed.write.parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path)
    return rows, rows.count()


def endless(rows: DataFrame, n: int, seed: object, rows_per_batch: int) -> DataFrame:
    """position, epoch and the columns of ``rows`` (place, 0 to n - 1), over and over: ``rows_per_batch`` rows each trigger.

    Each trigger joins its positions with the table by place: in a task for each ``ROWS`` of them, four
    at least. An empty table has no stream.
    """
    if n < 1:
        raise ValueError("an empty table has no epochs")
    spark = rows.sparkSession
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch).option("numPartitions", max(4, -(-rows_per_batch // ROWS))).load()
    epoch = F.floor(F.col("value") / n).cast("long")
    at = permuted(F.col("value") % n, F.lit(n).cast("long"), seed, epoch=epoch)
    return ticks.select(F.col("value").alias("position"), epoch.alias("epoch"), at.alias("place")).join(rows, "place").drop("place")


def batched(stream: DataFrame, size: int) -> DataFrame:
    """``batch`` and ``slot`` of every row of an endless stream: batches of ``size`` go on over the end of an epoch, so none is short."""
    return stream.withColumns({"batch": F.floor(F.col("position") / size).cast("long"), "slot": (F.col("position") % size).cast("long")})

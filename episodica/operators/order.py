"""Numbers and running sums along an order of all rows, without a task that sees them all."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.folders import shared_folder


def running(df: DataFrame, *order: str, amount: Column | None = None, name: str = "place") -> DataFrame:
    """``name``: the sum of ``amount`` (1 a row) over all rows before in the order; the rows otherwise as they are.

    Rows are cut into ranges of the order and written; a range adds what the ranges before it
    hold, one row each, to sums of its own. Rows of equal order stay in one range, in any order.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = df.withColumn("__amount", F.lit(1).cast("long") if amount is None else amount).repartitionByRange(ranges, *order).withColumn("__range", F.spark_partition_id())
    path = shared_folder(spark, "ranges")
    cut.write.parquet(path)
    cut = spark.read.schema(cut.schema).parquet(path)
    sums = cut.groupBy("__range").agg(F.sum("__amount").alias("__sum"))
    earlier = Window.partitionBy(F.lit(1)).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    sums = sums.select("__range", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__earlier"))
    own = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.withColumn(name, F.coalesce(F.sum("__amount").over(own), F.lit(0)))
    return placed.join(F.broadcast(sums), "__range").withColumn(name, F.col(name) + F.col("__earlier")).drop("__amount", "__range", "__earlier")


def round_keys(seed: object, rounds: int) -> list[int]:
    """60 bits of the MD5 of seed and round for each round."""
    return [int(hashlib.md5(f"{seed}|{r}".encode()).hexdigest()[:15], 16) for r in range(rounds)]


def permuted(place: Column, n: Column, seed: object, rounds: int = 40, epoch: Column | None = None) -> Column:
    """The place of 0..n-1 that a seeded permutation moves ``place`` to: swap-or-not rounds.

    In each round a place and its mirror around the round's key are swapped, or not, by a bit
    that both share, so every round is a bijection of 0..n-1 for any n, and nothing is sorted.
    With ``epoch``, each value of it has a permutation of its own.
    """

    def swap(x: Column, key: Column) -> Column:
        mirror = F.pmod(F.pmod(key, n) + n - x, n)
        larger = F.greatest(x, mirror)
        # with epochs no SQL gives the same order, and a hash of numbers is cheaper than one of texts
        bit = F.md5(F.concat_ws("|", key.cast("string"), larger.cast("string"))) >= F.lit("8") if epoch is None else F.xxhash64(key, larger) >= 0
        return F.when(bit, mirror).otherwise(x)

    keys = F.array(*(F.lit(k).cast("long") for k in round_keys(seed, rounds)))
    if epoch is not None:
        keys = F.transform(keys, lambda k: F.shiftrightunsigned(F.xxhash64(k, epoch), 4))
    return F.aggregate(keys, place.cast("long"), swap)


def permuted_sql(place: str, n: str, seed: object, rounds: int = 40) -> str:
    """``permuted`` as DuckDB SQL."""
    keys = ", ".join(map(str, round_keys(seed, rounds)))
    mirror = f"(k % {n} + {n} - x) % {n}"
    return f"list_reduce([{place}] || [{keys}]::BIGINT[], lambda x, k: CASE WHEN md5(k || '|' || greatest(x, {mirror})) >= '8' THEN {mirror} ELSE x END)"

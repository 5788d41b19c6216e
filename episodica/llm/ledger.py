"""An append-only ledger of what was computed for which content under which version.

Operators 5 (findings of secret rules) and 6 (token counts) keep one each. A
content is known by its SHA-256; only pairs of content and version that the
ledger lacks are computed, one copy of each, and appended.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import exists, kept_names, quoted, short_batches, written


def addressed(df: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """__id, __digest and n_bytes of every row's content (null reads as empty), with ``keep`` as one struct, as a written table."""
    text = F.coalesce(df[text_col], F.lit(""))
    names = kept_names(id_col, keep, ())
    kept = [F.struct(*(quoted(k).alias(f"c{i}") for i, k in enumerate(names))).alias("__kept")] if names else []
    rows = df.select(df[id_col].alias("__id"), F.unhex(F.sha2(text, 256)).alias("__digest"), F.octet_length(text).cast("long").alias("n_bytes"), *kept)
    return written(rows, "addressed")


#: Unseen contents (32 bytes each) up to which their digests are broadcast, so that no text is shuffled.
BROADCAST_MISSES = 500_000


def bring_up_to_date(df: DataFrame, rows: DataFrame, id_col: str, text_col: str, version: str, path: str, compute: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], fields: str, broadcast_misses: int = BROADCAST_MISSES) -> DataFrame:
    """Compute what the ledger at ``path`` lacks for ``rows``, append it, and return its rows for the contents of ``rows``.

    ``compute`` gets batches of __digest and __text and returns __digest and ``fields``. The
    ledger is parted by version; only digests of this version are read to find misses. One row
    holds each distinct miss: the first by id, once where rows repeat an id and a content.
    Up to ``broadcast_misses`` misses meet their texts without a shuffle; beyond, texts are
    shuffled by id and content, copies dropped before, so that copies of one content meet nowhere.
    """
    spark = df.sparkSession
    short_batches(spark)
    ledger = lambda: spark.read.schema(f"__digest binary, {fields}, version string").parquet(path).where(F.col("version") == version).drop("version")
    firsts = rows.groupBy("__digest", "__id").agg(F.count("*").alias("n")).groupBy("__digest").agg(F.min(F.struct("__id", "n")).alias("first"))
    wanted = firsts.select("__digest", F.col("first.__id").alias("__first"), F.col("first.n").alias("__rows"))
    if exists(spark, path):
        wanted = wanted.join(ledger().select("__digest"), "__digest", "left_anti")
    wanted = written(wanted.withColumnRenamed("__digest", "__want"), "misses")
    text = F.coalesce(df[text_col], F.lit(""))
    texts = df.select(df[id_col].alias("__id"), text.alias("__text"), F.unhex(F.sha2(text, 256)).alias("__digest"))
    same = (F.col("__digest") == F.col("__want")) & F.col("__id").eqNullSafe(F.col("__first"))
    if wanted.count() <= broadcast_misses:
        misses = texts.join(F.broadcast(wanted.where("__rows = 1")), same)
        if not (again := wanted.where("__rows > 1")).isEmpty():  # rows that repeat an id and a content
            misses = misses.unionByName(texts.join(F.broadcast(again), same).dropDuplicates(["__digest"]))
    else:
        misses = texts.dropDuplicates(["__digest", "__id"]).join(wanted, same)
    misses.select("__digest", "__text").mapInArrow(compute, f"__digest binary, {fields}").withColumn("version", F.lit(version)).write.mode("append").partitionBy("version").parquet(path)
    # written, so that a join with many copies of one content has plain shuffles on both sides, which Spark can split
    return written(ledger().join(rows.select("__digest").distinct(), "__digest", "left_semi").dropDuplicates(["__digest"]), "ledger-rows")

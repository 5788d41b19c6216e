"""Operator 9: token ids in ORC files.

One row holds one document: doc_id, part and first (its place: the part of the
order that its file has, and the ids of that part before it), n_tokens and ids.
Files are sorted by document id; ORC run-length-encodes the integers, and keeps row
indexes and Bloom filters on doc_id, so that readers take stripes side by side
and skip those without the documents asked for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .counts import library_counter, read_spec
from .shared import short_batches
from .text import chunks, worker

ORC_OPTIONS = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true", "orc.row.index.stride": "1000", "orc.stripe.size": str(64 << 20), "compression": "zstd"}


def write_token_files(df: DataFrame, tokenizer_path: str, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, append ``end_id``, and write the ids in ascending order of ids.

    Texts, not ids, are shuffled: into ranges of document ids, sorted within each. Null
    and empty texts have the end id alone. Null document ids come first; rows that share
    an id follow one another by their texts' hashes, and ranges are cut between them too, so
    an id that many rows share is spread. Ids keep their type, an integer or not. Other columns
    are not read; an empty table gives no rows; a text of any length is one row.
    """
    version, spec = read_spec(tokenizer_path)
    short_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(spec)  # has the size of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, part, first = library_counter(version, shared.value), TaskContext.get().partitionId(), 0
        for batch in worker("library", batches, keep=True):
            for c in chunks(batch.column("__text")):
                flat, bounds = counter.ids(c, end_id)
                sizes = np.diff(bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(c.first, c.rows), pa.array(np.full(c.rows, part, np.int32)), pa.array(first + bounds[:-1]), pa.array(sizes), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat))],
                    ["doc_id", "part", "first", "n_tokens", "ids"],
                )
                first += int(bounds[-1])

    source = df.select(df[id_col].alias("doc_id"), df[text_col].alias("__text")).withColumn("__order", F.xxhash64("__text"))
    source = source.repartitionByRange("doc_id", "__order").sortWithinPartitions("doc_id", "__order").drop("__order")
    source.mapInArrow(run, f"doc_id {dict(source.dtypes)['doc_id']}, part int, first long, n_tokens long, ids array<int>").write.options(**ORC_OPTIONS).orc(path)


def read_token_files(spark: SparkSession, path: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """Rows of the files with ``start``, the ids of all documents before; for some documents only, stripes and row groups are skipped."""
    files = spark.read.orc(path)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    # a row for each written file: as many as shuffle partitions, whatever the data
    offsets = dict(parts.collect())
    total, before = 0, []
    for part in sorted(offsets):
        before.append((part, total))
        total += offsets[part]
    starts = spark.createDataFrame(before, "part int, __before long")
    if doc_ids is not None:
        files = files.where(F.col("doc_id").isin(list(doc_ids)))
    return files.join(F.broadcast(starts), "part", "left").select("doc_id", (F.col("first") + F.col("__before")).alias("start"), "n_tokens", "ids")


def checked(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian unsigned 32-bit integers), from the ids themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in worker("id-files", batches):
            ids = batch.column("ids")
            bounds = np.asarray(ids.offsets).tolist()
            flat = np.asarray(ids.values).astype("<u4")
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), pa.array(np.diff(bounds).astype(np.int64)), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, f"doc_id {dict(files.dtypes)['doc_id']}, start long, n_tokens long, ids_crc32 long")

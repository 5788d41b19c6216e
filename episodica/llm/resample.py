"""Operator 13: importance resampling towards a target distribution of hashed n-grams.

DuckDB counts in each task: SQL unnests words, windows n-grams and hashes them by a
registered CRC function. The buckets' counts go to Parquet; Spark adds them up, makes the
gains of the buckets, and ranks scores. A second pass of DuckDB adds up each text's gains.
"""

from __future__ import annotations

import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import short_batches, written
from .text import chunks, worker

#: DuckDB's memory in a task; beyond it, it spills to a folder that goes with the task.
MEMORY = "256MB"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bytes of text given to DuckDB at once; a longer text goes alone.
STEP = 8 << 20

_WORDS = rf"""
words AS (SELECT r, unnest(w) AS w, generate_subscripts(w, 1) AS p
  FROM (SELECT r, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts))"""


def _grams(shortest: int, longest: int) -> str:
    """SQL for r and g, the n-grams of every text, repeats included."""
    parts = []
    for n in range(shortest, longest + 1):
        if n == 1:
            parts.append("SELECT r, w AS g FROM words")
            continue
        gram = " || ' ' || ".join(["w", *(f"lead(w, {i}) OVER o" for i in range(1, n))])
        parts.append(f"SELECT r, g FROM (SELECT r, {gram} AS g FROM words WINDOW o AS (PARTITION BY r ORDER BY p)) WHERE g IS NOT NULL")
    return " UNION ALL ".join(parts)


class _Database:
    """A DuckDB of one task, with zlib's CRC registered."""

    def __init__(self):
        import duckdb

        self.folder = tempfile.TemporaryDirectory(prefix="resample-")
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": self.folder.name, "preserve_insertion_order": False})
        self.con.create_function("zlib_crc", _crc, ["VARCHAR"], "UINTEGER", type="arrow")

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.con.close()
        self.folder.cleanup()

    def run(self, texts: pa.Table, sql: str) -> pa.Table:
        self.con.register("texts", texts)
        out = self.con.execute(sql).to_arrow_table()
        self.con.unregister("texts")
        return out


def _crc(grams: pa.Array) -> pa.Array:
    return pa.array([zlib.crc32(g.encode()) for g in grams.to_pylist()], pa.uint32())


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.Table]]:
    """Parts of batches and their texts, by r, the row in the part."""
    for batch in worker("resample", batches):
        for c in chunks(batch.column("text"), STEP):
            part = batch.slice(c.first, c.rows)
            yield part, pa.table({"r": np.arange(c.rows), "text": part.column("text").fill_null("")})


def bucket_counts(df: DataFrame, text_col: str, shortest: int, longest: int, buckets: int) -> DataFrame:
    """bucket and n of every part of every partition; at most ``buckets`` rows each."""
    sql = f"WITH {_WORDS}, grams AS ({_grams(shortest, longest)}), by_gram AS (SELECT g, count(*) AS n FROM grams GROUP BY g) SELECT (zlib_crc(g) % {buckets})::INTEGER AS bucket, sum(n)::BIGINT AS n FROM by_gram GROUP BY 1"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, np.int64)
        with _Database() as db:
            for _, texts in _steps(batches):
                out = db.run(texts, sql)
                np.add.at(totals, out.column("bucket").to_numpy(), out.column("n").to_numpy())
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(totals[some])], ["bucket", "n"])

    short_batches(df.sparkSession)
    return df.select(df[text_col].alias("text")).mapInArrow(run, "bucket int, n long")


def gains(raw: DataFrame, target: DataFrame, text_cols: tuple[str, str], shortest: int, longest: int, buckets: int) -> DataFrame:
    """gain of each bucket: floor(1000 ln) of the target's share over the raw share, one added to each count."""
    counts = written(bucket_counts(raw, text_cols[0], shortest, longest, buckets).withColumn("side", F.lit("s")).unionByName(bucket_counts(target, text_cols[1], shortest, longest, buckets).withColumn("side", F.lit("t"))), "bucket-counts")
    sums = counts.groupBy("bucket").agg(*(F.coalesce(F.sum(F.when(F.col("side") == x, F.col("n"))), F.lit(0)).alias(x) for x in "st"))
    totals = counts.agg(*(F.coalesce(F.sum(F.when(F.col("side") == x, F.col("n"))), F.lit(0)).alias(f"all_{x.upper()}") for x in "st"))
    t, s, T, S = (F.col(f"all_{c}").cast("double") if c.isupper() else F.col(c).cast("double") for c in "tsTS")
    over = (t + 1) * (S + buckets) / ((s + 1) * (T + buckets))
    every = raw.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(sums, "bucket", "left").fillna(0, ["s", "t"])
    return every.join(F.broadcast(totals)).select("bucket", F.floor(1000 * F.log(over)).cast("long").alias("gain"))


def weights(df: DataFrame, gain: np.ndarray, id_col: str, text_col: str, shortest: int, longest: int) -> DataFrame:
    """id, n_words, n_features and weight of every row; ``gain`` by bucket."""
    buckets, sent = len(gain), df.sparkSession.sparkContext.broadcast(gain)
    sql = f"""WITH {_WORDS}, grams AS ({_grams(shortest, longest)}), by_gram AS (SELECT r, g, count(*) AS n FROM grams GROUP BY r, g),
      bucket AS (SELECT g, (zlib_crc(g) % {buckets})::INTEGER AS bucket FROM (SELECT DISTINCT g FROM by_gram))
      SELECT r, sum(n)::BIGINT AS n, sum(n * gain)::BIGINT AS weight FROM by_gram JOIN bucket USING (g) JOIN gains USING (bucket) GROUP BY r"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _Database() as db:
            db.con.register("given", pa.table({"bucket": np.arange(buckets, dtype=np.int32), "gain": sent.value}))
            db.con.execute("CREATE TABLE gains AS SELECT * FROM given")
            for part, texts in _steps(batches):
                out = db.run(texts, sql)
                r = out.column("r").to_numpy()
                n, weight = np.zeros((2, part.num_rows), np.int64)
                n[r], weight[r] = out.column("n").to_numpy(), out.column("weight").to_numpy()
                if shortest == longest == 1:
                    words = n
                else:
                    words = np.zeros(part.num_rows, np.int64)
                    got = db.run(texts, f"WITH {_WORDS} SELECT r, count(*)::BIGINT AS n FROM words GROUP BY r")
                    words[got.column("r").to_numpy()] = got.column("n").to_numpy()
                yield pa.RecordBatch.from_arrays([part.column("id"), *map(pa.array, (words, n, weight))], ["id", "n_words", "n_features", "weight"])

    short_batches(df.sparkSession)
    source = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    return source.mapInArrow(run, f"id {dict(source.dtypes)['id']}, n_words long, n_features long, weight long")


def _ranked(rows: DataFrame, drawn: int) -> DataFrame:
    """rank, 1, 2, 3 ..., of the ``drawn`` rows that come first by score and id, null for the others.

    Rows are sorted in ranges; a range's first rank is the number of rows in those before it,
    so no task numbers more than its own.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("weight"), F.asc("n_features")]
    sorted_ = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # a row's place within its range, in the order just made; the written table keeps both
    place = written(sorted_.select("*", F.monotonically_increasing_id().alias("place")), "ranges")
    sizes = place.groupBy(F.shiftright("place", 33).alias("range")).agg(F.count("*").alias("n")).collect()  # one row for each range
    first, before = {}, 0
    for r in sorted(sizes, key=lambda r: r["range"]):
        first[r["range"]] = before
        before += r["n"]
    if not first:
        return rows.withColumn("rank", F.lit(None).cast("long"))
    starts = F.create_map(*(F.lit(x) for pair in first.items() for x in pair))
    rank = (F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + F.element_at(starts, F.shiftright("place", 33)) + 1).cast("long")
    return place.select("*", F.when(rank <= drawn, rank).alias("rank")).drop("place")


def importance_resample(
    raw: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
    shortest: int = 1, longest: int = 2, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: str = "2024",
) -> DataFrame:
    """``id_col``, n_features, weight, score and rank of every row of ``raw``.

    Features are runs of ``shortest`` to ``longest`` words ([A-Z] lower-cased), hashed into
    ``buckets``; a bucket's gain compares its share in ``target`` with that in ``raw``, and a
    row's weight is the sum over its features. score adds noise from sha256 of ``seed:id``, so
    the highest scores are a draw without replacement. Of the N rows with ``least_words`` words,
    floor(percent * N / 100) are drawn and ranked, ties to the smaller id; other ranks are null.

    Null and empty texts have no features, weight 0 and no rank. A null id's noise is that of
    the empty id, and it comes last in ties. Repeated rows are rows of their own: they have one
    score and ranks next to each other. Other columns are not read, so they cannot clash. An
    empty table gives an empty result, an empty target a gain of its own for each bucket. A very
    long text goes to DuckDB alone, in ``MEMORY``. What is collected is one number a bucket and
    a range.
    """
    table = gains(raw, target, (text_col, target_text_col), shortest, longest, buckets).toArrow()
    gain = np.zeros(buckets, np.int64)
    gain[table.column("bucket").to_numpy()] = table.column("gain").to_numpy()
    weighed = weights(raw, gain, id_col, text_col, shortest, longest)
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    score = F.col("weight") + F.floor(-1000 * F.log(-F.log((noise + 0.5) / 4294967296.0)))
    scored = written(weighed.withColumn("score", score.cast("long")), "scores")
    eligible = scored.where(F.col("n_words") >= least_words)
    ranked = _ranked(eligible, percent * eligible.count() // 100)
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")

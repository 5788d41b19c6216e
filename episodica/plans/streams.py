"""Queries on streams: an extension. Each drains a stream over the events' files; the SQL is its batch twin."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from ..streaming import epochs as E
from ..streaming import operators as O
from .catalogue import query


def _name() -> str:
    return f"stream_{uuid.uuid4().hex}"


def _events(spark: SparkSession, d: str) -> DataFrame:
    files = spark.read.parquet(f"{d}/events.parquet")
    stream = spark.readStream.schema(files.schema).option("pathGlobFilter", "events*.parquet").parquet(d)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream_tumbling", "SELECT time_bucket(INTERVAL '1 day', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_tumbling(spark: SparkSession, d: str) -> DataFrame:
    return O.drain(O.tumbling(_events(spark, d), "1 day"), _name(), "complete").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")


@query("stream_session", "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL '6 hours' THEN 0 ELSE 1 END AS s FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), r AS (SELECT user_id, ts, sum(s) OVER (PARTITION BY user_id ORDER BY ts) AS r FROM g) SELECT user_id, min(ts) AS start, max(ts) + INTERVAL '6 hours' AS \"end\", count(*) AS n FROM r GROUP BY user_id, r")
def stream_session(spark: SparkSession, d: str) -> DataFrame:
    out = O.drain(O.sessions(_events(spark, d), "6 hours"), _name(), "complete")
    return out.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"), "n")


@query("stream_dedup", "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Every event twice in the stream, once after it."""
    twice = _events(spark, d).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return O.drain(O.deduplicated(twice, ["event_id"]), _name()).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


#: Events that the watermark, an hour behind the latest, has reached.
_PAST = "past AS (SELECT * FROM events WHERE epoch_ms(ts) <= (SELECT max(epoch_ms(ts)) FROM events) - 3600000)"


@query("stream_runs", f"WITH {_PAST}, t AS (SELECT user_id, row_number() OVER w - 1 AS frame, event_type, CASE WHEN event_type IS DISTINCT FROM lag(event_type) OVER w THEN 1 ELSE 0 END AS c FROM past WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), r AS (SELECT *, (sum(c) OVER (PARTITION BY user_id ORDER BY frame))::BIGINT - 1 AS run FROM t), g AS (SELECT user_id, run, min(event_type) AS label, min(frame) AS start, max(frame) AS \"end\", count(*) AS n FROM r GROUP BY 1, 2) SELECT * FROM g QUALIFY run < max(run) OVER (PARTITION BY user_id)")
def stream_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs that have ended within the events that the watermark is past: each user's last one is open."""
    return O.drain(O.stateful_runs(_events(spark, d)), _name())


@query("stream_chunk_broker", f"WITH {_PAST} SELECT user_id AS key, event_id AS seq, (row_number() OVER w - 1) // 8 AS chunk, (row_number() OVER w - 1) % 8 AS cursor FROM past WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def stream_chunk_broker(spark: SparkSession, d: str) -> DataFrame:
    asked = _events(spark, d).select(F.col("user_id").alias("key"), "ts", F.col("event_id").alias("seq"), F.lit(False).alias("reset"))
    return O.drain(O.chunk_broker(asked, 8), _name())


@query("stream_epochs", "SELECT event_id, 2::BIGINT AS times, 1::BIGINT AS least_epoch_times, (SELECT count(*) FROM events) // 4 AS full_batches FROM events")
def stream_epochs(spark: SparkSession, d: str) -> DataFrame:
    """The first two epochs of an endless stream: every row once in each, in batches of eight that go on over an epoch's end."""
    rows, n = E.numbered(table(spark, d, "events").select("event_id"), "event_id")
    out = O.drain(E.batched(E.endless(rows, n, 3, 2 * n), 8), _name())
    full = out.groupBy("batch").agg(F.count("*").alias("k")).agg(F.count_if(F.col("k") == 8).alias("full_batches"))  # one row
    by_epoch = out.groupBy("event_id", "epoch").agg(F.count("*").alias("k"))
    seen = by_epoch.groupBy("event_id").agg(F.sum("k").alias("times"), F.min("k").alias("least_epoch_times"))
    return seen.join(F.broadcast(full))

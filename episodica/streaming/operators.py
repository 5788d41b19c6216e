"""Structured Streaming twins of batch operators: an extension for unbounded input."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..sources.folders import shared_folder


def event_stream(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """Events from a folder of Parquet files, ts as a timestamp."""
    raw = spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, width: str, delay: str = "1 hour") -> DataFrame:
    """start, event_type, n and total of each window; events later than ``delay`` are dropped."""
    w = events.withWatermark("ts", delay).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return w.select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, width: str, step: str, delay: str = "1 hour") -> DataFrame:
    w = events.withWatermark("ts", delay).groupBy(F.window("ts", width, step)).agg(F.count("*").alias("n"))
    return w.select(F.col("window.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str, delay: str = "1 hour") -> DataFrame:
    """user_id, start, end and n of runs of events without a gap."""
    w = events.withWatermark("ts", delay).groupBy("user_id", F.session_window("ts", gap)).agg(F.count("*").alias("n"))
    return w.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def deduplicated(events: DataFrame, keys: list[str], delay: str = "1 hour") -> DataFrame:
    """The first event of each key within the delay."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(keys)


class InOrder(StatefulProcessor):
    """Hands a key's rows to ``step`` in order of time, whatever order, files or batches they come in.

    Rows are held as list state until the watermark reaches them, then released in order of
    (time, tie); rows behind the watermark are late and dropped by Spark. ``step`` takes what
    it kept of the key (a tuple, or None) and the row's fields, and gives back what to keep and
    the rows that come of it. Held are the rows of the delay, one key's at a time.
    """

    def __init__(self, held: str, kept: str, out: list[str], step: Callable[[tuple | None, tuple], tuple[tuple, list[tuple]]]):
        self.held_schema, self.kept_schema, self.out, self.step = held, kept, out, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", self.held_schema)
        self.kept = handle.getValueState("kept", self.kept_schema)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        for pdf in rows:
            self.held.appendList(list(pdf.iloc[:, 2:].itertuples(index=False, name=None)))  # without key and ts
        yield self._released(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        yield self._released(key, timerValues.getCurrentWatermarkInMs())

    def _released(self, key: tuple, watermark: int) -> pd.DataFrame:
        rows = sorted(self.held.get())
        due = [r for r in rows if r[0] // 1000 <= watermark]  # what is left lies ahead, so its timer does
        done = []
        if due:
            now = self.kept.get() if self.kept.exists() else None
            for r in due:
                now, made = self.step(now, r[2:])
                done += [(*key, *m) for m in made]
            self.kept.update(now)
            if len(due) < len(rows):
                self.held.put(rows[len(due) :])
            else:
                self.held.clear()
        if len(due) < len(rows):
            self.handle.registerTimer(rows[len(due)][0] // 1000)
        return pd.DataFrame(done, columns=self.out)


def in_order(events: DataFrame, key: str, ts: str, tie: str, fields: dict[str, str], delay: str, kept: str, out: str, step: Callable) -> DataFrame:
    """``out`` rows (the key first) that ``step`` makes of each key's rows, in order of ``ts`` and ``tie``; rows wait for the watermark, ``delay`` behind the latest.

    ``fields``: the columns that ``step`` gets, and their types. Needs the RocksDB state store.
    """
    micros = F.unix_micros(F.col(ts)).alias("__at")
    rows = events.withWatermark(ts, delay).select(F.col(key).alias("__key"), F.col(ts).alias("__ts"), micros, F.col(tie).cast("long").alias("__tie"), *(F.col(c).cast(t).alias(c) for c, t in fields.items()))
    held = "at long, tie long, " + ", ".join(f"{c} {t}" for c, t in fields.items())
    names = [f.strip().split(" ")[0] for f in out.split(",")]
    return rows.groupBy("__key").transformWithStateInPandas(InOrder(held, kept, names, step), out, "append", "EventTime")


def stateful_runs(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """user_id, run, label, start, end and n: as ``sequences.run_ranges``, a run is emitted when the next begins.

    A user's state is the open run and the events that the watermark has not passed; events may
    come in any order within the delay.
    """

    def step(now: tuple | None, row: tuple) -> tuple[tuple, list[tuple]]:
        run, label, start, end, n, frame = now or (-1, None, 0, 0, 0, 0)
        if n and row[0] == label:
            return (run, label, start, frame, n + 1, frame + 1), []
        return (run + 1, row[0], frame, frame, 1, frame + 1), [(run, label, start, end, n)] if n else []

    held = "run long, label string, start long, end long, n long, frame long"
    return in_order(events, "user_id", "ts", "event_id", {"event_type": "string"}, delay, held, "user_id long, run long, label string, start long, end long, n long", step)


def chunk_broker(requests: DataFrame, horizon: int, delay: str = "1 hour") -> DataFrame:
    """key, seq, chunk and cursor: each key asks for a new chunk every ``horizon`` requests and is dealt its rows one by one.

    ``requests``: key, ts, seq, reset (boolean; true begins a chunk anew), served in order of ts
    and seq.
    """

    def step(now: tuple | None, row: tuple) -> tuple[tuple, list[tuple]]:
        chunk, cursor = now or (-1, horizon)
        if row[1] or cursor >= horizon:
            chunk, cursor = chunk + 1, 0
        return (chunk, cursor + 1), [(row[0], chunk, cursor)]

    return in_order(requests, "key", "ts", "seq", {"seq": "long", "reset": "boolean"}, delay, "chunk long, cursor long", "key long, seq long, chunk long, cursor long", step)


#: The state store that list states and timers need.
_STORE = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Streams started within use RocksDB for their state; the session's own setting comes back after."""
    before = spark.conf.get(_STORE[0], None)
    spark.conf.set(*_STORE)
    try:
        yield
    finally:
        spark.conf.unset(_STORE[0]) if before is None else spark.conf.set(_STORE[0], before)


def drain(stream: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Run a stream over all that is there now, into files of the shared folder; in complete mode the last batch's rows replace those before."""
    spark = stream.sparkSession
    path = shared_folder(spark, name)
    state = checkpoint or shared_folder(spark, f"{name}-state")
    if mode == "append":
        writer = stream.writeStream.format("parquet").option("path", path)
    else:
        writer = stream.writeStream.outputMode(mode).foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path))
    with state_store(spark):
        writer.option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)

"""Datasets written, found and read again; JSON, NPZ and text sources; streams resumed."""

import json

import numpy as np
import pytest
from pyspark.sql import types as T

from episodica.operators import statistics as S
from episodica.sources import datasets as D
from episodica.streaming import operators as O


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sets") / "one")
    rows = [(e, f, f"task {e % 2}", [float(e), float(f)]) for e in range(4) for f in range(3 + e)]
    D.write_dataset(spark.createDataFrame(rows, "episode_index long, frame_index long, task string, state array<double>"), path)
    return path


def test_round_trip(spark, root):
    frames = D.read_frames(spark, root)
    assert frames.count() == 18
    assert {r["task_index"] for r in frames.where("episode_index = 1").collect()} == {1}
    assert sorted((r["episode_index"], r["task"], r["length"]) for r in D.read_episodes(spark, root).collect()) == [(0, "task 0", 3), (1, "task 1", 4), (2, "task 0", 5), (3, "task 1", 6)]
    assert [r["episode_index"] for r in D.read_episodes(spark, root, one_per_task=True).orderBy("task").collect()] == [0, 1]
    assert [tuple(r) for r in D.read_tasks(spark, root).orderBy("task_index").collect()] == [(0, "task 0"), (1, "task 1")]
    assert D.read_document(spark, f"{root}/meta/info.json")["total_frames"] == 18
    assert D.episode_rows(spark, root).agg({"n": "sum"}).first()[0] == 18


def test_discovery(spark, tmp_path):
    for name in ("x", "y"):
        (tmp_path / name / "meta").mkdir(parents=True)
        lines = [json.dumps({"episode_index": i, "tasks": [f"do {i % 2}", " "], "length": 3}) for i in range(3)] + ["{broken"]
        (tmp_path / name / "meta" / "episodes.jsonl").write_text("\n".join(lines))
    assert D.discover(spark, str(tmp_path)).count() == 2
    assert sorted((r["instruction"], r["dataset"], r["episode_index"]) for r in D.instructions(spark, str(tmp_path)).collect()) == [("do 0", "x", 0), ("do 1", "x", 1)]


def test_arrays(spark, tmp_path):
    np.savez(tmp_path / "a.npz", states=np.arange(6).reshape(3, 2))
    assert [r["values"] for r in D.read_arrays(spark, str(tmp_path), "states").orderBy("row").collect()] == [[0, 1], [2, 3], [4, 5]]


def test_texts(spark, tmp_path):
    (tmp_path / "a.txt").write_text("(define (:language Pick The Cup))")
    assert D.language_tags(spark, str(tmp_path)).first()["language"] == "pick the cup"
    (tmp_path / "b.yaml").write_text("model: m1 extra # note\n# only a note\n  style: 7\n")
    assert sorted(map(tuple, D.settings(spark, str(tmp_path / "b.yaml")).collect())) == [("model", "m1"), ("style", "7")]


def test_stats_and_missing(spark, root, tmp_path):
    stats = S.nested(S.summary(D.read_frames(spark, root), "state").withColumn("column", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("state")), "column").drop("n")
    D.write_stats(stats, str(tmp_path / "stats"))
    assert D.read_stats(spark, str(tmp_path / "stats")).first()["max"] == [3.0, 5.0]
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    D.write_missing(rows.where("k = 1"), str(tmp_path / "log"), ["k"])
    D.write_missing(rows, str(tmp_path / "log"), ["k"])
    assert spark.read.json(str(tmp_path / "log")).count() == 2


def test_synthetic(spark):
    schema = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("n", T.LongType()), T.StructField("v", T.ArrayType(T.DoubleType())), T.StructField("s", T.StringType())])
    df = D.synthetic(spark, 20, schema, 3)
    assert df.schema.fieldNames() == ["x", "n", "v", "s"] and df.where("x between -1 and 1 and n < 2048 and size(v) = 8").count() == 20


def test_both_layouts(spark, root, tmp_path):
    assert [r["dataset"].rsplit("/", 1)[1] for r in D.discover(spark, str(root).rsplit("/", 1)[0]).collect()] == ["one"]
    assert sorted(map(tuple, D.instructions(spark, str(root).rsplit("/", 1)[0]).collect())) == [("task 0", "one", 0), ("task 1", "one", 1)]
    assert D.read_episode(spark, root, 3).count() == 6
    (tmp_path / "data" / "chunk-001").mkdir(parents=True)
    D.read_episode(spark, root, 2).toPandas().to_parquet(tmp_path / "data" / "chunk-001" / "episode_001002.parquet")
    assert D.read_episode(spark, str(tmp_path), 1002).count() == 5
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        D.read_episode(spark, root, 99).count()
    allowed = spark.createDataFrame([("nowhere",)], "dataset string")
    assert D.discover(spark, str(root).rsplit("/", 1)[0], allowed).count() == 0
    assert D.read_document(spark, f"{root}/meta/info.json")["features"]["state"]["dtype"] == "array<double>"


ROWS = [(i, 60 * i + (7 * i) % 5, 1 + i % 3, "aab"[(i // 5) % 3] if i % 11 else "c", 0.0) for i in range(90)] + [(1000 + k, 10**6, 1 + k, "z", 0.0) for k in range(3)]


def files(spark, folder, rows, size):
    """Rows in files of a few, one file a micro-batch."""
    for i in range(0, len(rows), size):
        df = spark.createDataFrame(rows[i : i + size], "event_id long, t long, user_id long, event_type string, value double")
        df.selectExpr("event_id", "timestamp_seconds(t + 1700000000) AS ts", "user_id", "event_type", "value").coalesce(1).write.mode("append").parquet(folder)


def runs_of(rows):
    """Ended runs of the rows that the watermark is past."""
    out = []
    for user in (1, 2, 3):
        own = [r[3] for r in sorted((r for r in rows if r[2] == user and r[1] < 10**6 - 9000), key=lambda r: (r[1], r[0]))]
        run, start = 0, 0
        for i in range(1, len(own)):
            if own[i] != own[i - 1]:
                out.append((user, run, own[i - 1], start, i - 1, i - start))
                run, start = run + 1, i
    return sorted(out)


@pytest.mark.parametrize("order, batch", [("as is", 10000), ("reversed", 3), ("mixed", 2)])
def test_runs_in_any_order(spark, tmp_path, order, batch):
    """The same runs whatever the order of files and the size of Arrow batches."""
    import random

    rows = {"as is": ROWS, "reversed": ROWS[:90][::-1] + ROWS[90:], "mixed": random.Random(1).sample(ROWS[:90], 90) + ROWS[90:]}[order]
    files(spark, str(tmp_path / "in"), rows, 23)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        out = O.drain(O.stateful_runs(O.event_stream(spark, str(tmp_path / "in"), 1), "150 minutes"), "runs")
        assert sorted(map(tuple, out.collect())) == runs_of(ROWS)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) or "")


def test_broker_in_any_order(spark, tmp_path):
    files(spark, str(tmp_path / "in"), ROWS[:90][::-1] + ROWS[90:], 31)
    asked = O.event_stream(spark, str(tmp_path / "in"), 1).selectExpr("user_id AS key", "ts", "event_id AS seq", "event_type = 'c' AS reset")
    got = sorted(map(tuple, O.drain(O.chunk_broker(asked, 4, "150 minutes"), "broker").collect()))
    want = []
    for user in (1, 2, 3):
        chunk, cursor = -1, 4
        for r in sorted((r for r in ROWS[:90] if r[2] == user), key=lambda r: (r[1], r[0])):
            if r[3] == "c" or cursor >= 4:
                chunk, cursor = chunk + 1, 0
            want.append((user, r[0], chunk, cursor))
            cursor += 1
    assert got == sorted(want)


def test_stream_resumes(spark, tmp_path):
    """State outlives a query: runs that begin in one drain end in the next."""
    state = str(tmp_path / "state")

    def drained():
        runs = O.stateful_runs(O.event_stream(spark, str(tmp_path / "in"), 10), "0 seconds")
        with O.state_store(spark):
            q = runs.writeStream.format("parquet").option("checkpointLocation", state).option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
            q.awaitTermination()
        return sorted(tuple(r)[1:] for r in spark.read.parquet(str(tmp_path / "out")).collect())

    rows = [(i, i * 60, 1, label, 0.0) for i, label in enumerate("aabbbcc")]
    files(spark, str(tmp_path / "in"), rows[:4], 9)
    assert drained() == [(0, "a", 0, 1, 2)]
    files(spark, str(tmp_path / "in"), rows[4:], 9)
    assert drained() == [(0, "a", 0, 1, 2), (1, "b", 2, 4, 3)]


def test_files_do_not_follow_episodes(spark, tmp_path):
    """Many episodes are a few files, in one chunk and over its end; null tasks keep their frames."""
    frames = spark.range(6000).selectExpr("700 + id % 600 AS episode_index", "id div 600 AS frame_index", "nullif(concat('t', id % 3), 't2') AS task", "id AS x")
    D.write_dataset(frames, str(tmp_path / "set"))
    files = list((tmp_path / "set" / "data").rglob("*.parquet"))
    assert {f.parent.name for f in files} == {"chunk=0", "chunk=1"} and len(files) <= 8
    rows = D.episode_rows(spark, str(tmp_path / "set")).collect()
    assert sorted(r["episode_index"] for r in rows) == list(range(700, 1300)) and {r["n"] for r in rows} == {10}
    assert sorted(r["frame_index"] for r in D.read_episode(spark, str(tmp_path / "set"), 1001).collect()) == list(range(10))
    assert {(r["task"], r["length"]) for r in D.read_episodes(spark, str(tmp_path / "set")).collect()} == {("t0", 10), ("t1", 10), ("", 10)}
    documents = spark.range(500).selectExpr("id", "id % 7 AS n", "if(id % 5 = 0, 'gone', 'ok') AS status")
    assert {tuple(r) for r in D.write_documents(documents, str(tmp_path / "docs"), "id", "status").collect()} == {("gone", 100), ("ok", 400)}
    assert len(list((tmp_path / "docs").rglob("*.json"))) <= 4
    assert sorted(r["id"] for r in spark.read.json(str(tmp_path / "docs")).collect()) == [i for i in range(500) if i % 5]

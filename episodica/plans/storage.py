"""Queries that write a table as a dataset, a log or texts to the shared folder, and read it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import datasets as D
from ..sources.folders import shared_folder
from ..sources.tables import table, trajectories
from .catalogue import TRAJ, query


def _dataset(spark: SparkSession, d: str) -> str:
    """The events as a dataset of episodes, written anew for each query."""
    root = shared_folder(spark, "dataset")
    frames = trajectories(spark, d).select(F.col("ep").alias("episode_index"), F.col("frame").alias("frame_index"), F.col("label").alias("task"), "value")
    D.write_dataset(frames, root)
    return root


@query("dataset_frames", f"WITH {TRAJ} SELECT ep AS episode_index, frame AS frame_index, value FROM traj")
def dataset_frames(spark: SparkSession, d: str) -> DataFrame:
    frames = D.episode_frames(spark, _dataset(spark, d), ["frame_index", "value"])
    return frames.select("episode_index", F.col("frame_index").cast("long").alias("frame_index"), "value")


@query("dataset_episode_rows", "SELECT user_id AS episode_index, count(*) AS n FROM events GROUP BY 1")
def dataset_episode_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = D.episode_rows(spark, _dataset(spark, d))
    return rows.groupBy("episode_index").agg(F.sum("n").alias("n"))


@query("dataset_episodes", f"WITH {TRAJ} SELECT ep AS episode_index, arg_min(label, frame) AS task, count(*) AS length FROM traj GROUP BY 1")
def dataset_episodes(spark: SparkSession, d: str) -> DataFrame:
    return D.read_episodes(spark, _dataset(spark, d))


@query("dataset_one_per_task", f"WITH {TRAJ}, e AS (SELECT ep, arg_min(label, frame) AS task, count(*) AS length FROM traj GROUP BY 1) SELECT min(ep) AS episode_index, task, arg_min(length, ep) AS length FROM e GROUP BY task")
def dataset_one_per_task(spark: SparkSession, d: str) -> DataFrame:
    return D.read_episodes(spark, _dataset(spark, d), one_per_task=True)


@query("dataset_tasks", f"WITH {TRAJ}, f AS (SELECT label AS task, min(ep * 1000000000 + frame) AS place FROM traj GROUP BY 1) SELECT row_number() OVER (ORDER BY place) - 1 AS task_index, task FROM f")
def dataset_tasks(spark: SparkSession, d: str) -> DataFrame:
    return D.read_tasks(spark, _dataset(spark, d))


@query("dataset_info", "SELECT 20.0::DOUBLE AS fps, count(DISTINCT user_id) AS total_episodes, count(*) AS total_frames, count(DISTINCT event_type) AS total_tasks FROM events")
def dataset_info(spark: SparkSession, d: str) -> DataFrame:
    document = D.read_document(spark, f"{_dataset(spark, d)}/meta/info.json")
    row = (D.fps(document), document["total_episodes"], document["total_frames"], document["total_tasks"])
    return spark.createDataFrame([row], "fps double, total_episodes long, total_frames long, total_tasks long")


def _several(spark: SparkSession, d: str) -> str:
    """A folder of three datasets, of the users by their remainder."""
    root = shared_folder(spark, "datasets")
    frames = trajectories(spark, d).select(F.col("ep").alias("episode_index"), F.col("frame").alias("frame_index"), F.col("label").alias("task"), "value")
    for k in range(3):
        D.write_dataset(frames.where(F.col("episode_index") % 3 == k), f"{root}/group/set{k}")
    return root


@query("dataset_discovery", "SELECT 'set' || user_id % 3 AS dataset, count(DISTINCT user_id) AS episodes, count(*) AS frames FROM events GROUP BY 1")
def dataset_discovery(spark: SparkSession, d: str) -> DataFrame:
    """Datasets found below a folder, and what their metadata tell of their episodes."""
    root = _several(spark, d)
    found = D.discover(spark, root).join(D.all_episodes(spark, root), "dataset")
    return found.groupBy(F.element_at(F.split("dataset", "/"), -1).alias("dataset")).agg(F.count("*").alias("episodes"), F.sum("length").alias("frames"))


@query("dataset_instructions", f"WITH {TRAJ}, e AS (SELECT ep, arg_min(label, frame) AS instruction FROM traj GROUP BY 1), f AS (SELECT instruction, min(('set' || ep % 3, ep)) AS f FROM e GROUP BY 1) SELECT instruction, f[1] AS dataset, f[2] AS episode_index FROM f")
def dataset_instructions(spark: SparkSession, d: str) -> DataFrame:
    """Each instruction where it is first seen over all datasets below a folder."""
    return D.instructions(spark, _several(spark, d))


@query("dataset_episode", f"WITH {TRAJ}, p AS (SELECT * FROM traj WHERE ep = (SELECT max(user_id) FROM events)) SELECT frame AS frame_index, value FROM p")
def dataset_episode(spark: SparkSession, d: str) -> DataFrame:
    """A point read: the last episode by its path."""
    last = table(spark, d, "events").agg(F.max("user_id")).first()[0]
    return D.read_episode(spark, _dataset(spark, d), last).select("frame_index", "value")


@query("reexported_frames", f"WITH {TRAJ} SELECT ep AS episode_index, frame AS step, value FROM traj")
def reexported_frames(spark: SparkSession, d: str) -> DataFrame:
    frames = trajectories(spark, d).select(F.col("ep").alias("episode_index"), "frame", "label", "value")
    path = shared_folder(spark, "reexport")
    D.reexport(frames, ["label"], {"frame": "step"}).write.parquet(path)
    return spark.read.parquet(path)


@query("log_of_missing_rows", "SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY 1")
def log_of_missing_rows(spark: SparkSession, d: str) -> DataFrame:
    """Purchases are written first, then all events: only the others are appended."""
    rows, path = table(spark, d, "events").select("event_id", "event_type"), shared_folder(spark, "log")
    D.write_missing(rows.where("event_type = 'purchase'"), path, ["event_id"])
    D.write_missing(rows, path, ["event_id"])
    return spark.read.schema(rows.schema).json(path).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("merged_splits", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def merged_splits(spark: SparkSession, d: str) -> DataFrame:
    """One split holds the events of odd users, one those of even users, one is not there."""
    rows, root = table(spark, d, "events").select("event_id", "event_type", "user_id"), shared_folder(spark, "splits")
    for odd in (0, 1):
        rows.where(F.col("user_id") % 2 == odd).write.parquet(f"{root}/{odd}")
    merged, missing = D.merge_splits(spark, [f"{root}/{k}" for k in (0, 1, 2)], rows.schema)
    if missing != [f"{root}/2"]:
        raise ValueError(missing)
    return merged.groupBy("event_type").agg(F.count("*").alias("n"))


@query("language_tag_files", "SELECT lower(n_name) AS language, 1::BIGINT AS n FROM nation")
def language_tag_files(spark: SparkSession, d: str) -> DataFrame:
    path = shared_folder(spark, "tags")
    table(spark, d, "nation").select("n_nationkey", F.concat(F.lit("(define (:language "), "n_name", F.lit("))")).alias("value")).write.partitionBy("n_nationkey").text(path)
    return D.language_tags(spark, path).select("language", F.size("files").cast("long").alias("n"))


@query("settings_lines", "SELECT n_name AS key, n_regionkey::VARCHAR AS value FROM nation WHERE regexp_full_match(n_name, '[A-Za-z_]\\w*')")
def settings_lines(spark: SparkSession, d: str) -> DataFrame:
    path = shared_folder(spark, "settings")
    table(spark, d, "nation").select(F.concat("n_name", F.lit(": "), F.col("n_regionkey").cast("string"), F.lit(" more # a note"))).write.text(path)
    return D.settings(spark, path)


@query("gzip_files", "SELECT n_name || chr(10) AS text FROM nation")
def gzip_files(spark: SparkSession, d: str) -> DataFrame:
    path = shared_folder(spark, "gzip")
    table(spark, d, "nation").select("n_nationkey", "n_name").write.partitionBy("n_nationkey").option("compression", "gzip").text(path)
    return D.gzip_texts(spark, path).select("text")


@query("stats_file", "SELECT event_type AS \"column\", round(min(value), 6) AS low, round(max(value), 6) AS high FROM events GROUP BY 1")
def stats_file(spark: SparkSession, d: str) -> DataFrame:
    path = shared_folder(spark, "stats")
    one = lambda c, name: F.array(c).alias(name)
    stats = table(spark, d, "events").groupBy(F.col("event_type").alias("column")).agg(one(F.avg("value"), "mean"), one(F.stddev_pop("value"), "std"), one(F.min("value"), "min"), one(F.max("value"), "max"), one(F.min("value"), "q01"), one(F.max("value"), "q99"))
    D.write_stats(stats, path)
    return D.read_stats(spark, path).select("column", F.round(F.get("min", F.lit(0)), 6).alias("low"), F.round(F.get("max", F.lit(0)), 6).alias("high"))


@query("merged_maps", "SELECT event_type || (event_id % 50) AS key, arg_max(event_id, (user_id % 4, event_id)) AS value, 'part=' || max(user_id % 4) AS part FROM events GROUP BY 1")
def merged_maps(spark: SparkSession, d: str) -> DataFrame:
    """Four files of keys and values, of users by their remainder; of a key in several files the last file's value counts."""
    path = shared_folder(spark, "maps")
    rows = table(spark, d, "events").select((F.col("user_id") % 4).alias("part"), F.concat("event_type", (F.col("event_id") % 50).cast("string")).alias("key"), "event_id")
    own = rows.groupBy("part", "key").agg(F.max("event_id").alias("v"))
    own.groupBy("part").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("key", "v")))).alias("value")).write.partitionBy("part").text(path)
    return D.read_maps(spark, path, "bigint").select("key", "value", F.regexp_extract("path", "/(part=[0-9]+)/", 1).alias("part"))


@query("finished_runs", "SELECT 'run=' || CASE WHEN user_id % 3 = 0 THEN '1' ELSE '2' END AS run, count(DISTINCT user_id) AS tasks, round(sum(value), 4) AS total, (SELECT count(DISTINCT user_id) FROM events WHERE user_id % 3 = 0) AS skipped FROM events GROUP BY 1")
def finished_runs(spark: SparkSession, d: str) -> DataFrame:
    """A first run finishes a third of the users; the second skips those."""
    root = shared_folder(spark, "runs")
    rows = table(spark, d, "events").select(F.col("user_id").alias("task"), "value")
    D.write_run(rows.where("task % 3 = 0"), root, "1")
    counts = D.write_run(rows, root, "2")
    both = spark.read.schema("task long, value double, run string").parquet(root)
    return both.groupBy(F.concat(F.lit("run="), "run").alias("run")).agg(F.countDistinct("task").alias("tasks"), F.round(F.sum("value"), 4).alias("total"), F.lit(counts["skipped"]).cast("long").alias("skipped"))


@query("episode_documents", f"WITH {TRAJ}, e AS (SELECT ep, count(*) AS n, CASE WHEN ep % 5 = 0 THEN 'no camera' WHEN ep % 7 = 0 THEN 'no positions' ELSE 'ok' END AS status FROM traj GROUP BY ep) SELECT status, count(*) AS n, coalesce(sum(n) FILTER (status = 'ok'), 0)::BIGINT AS frames FROM e GROUP BY status")
def episode_documents(spark: SparkSession, d: str) -> DataFrame:
    """Documents of the episodes that have all parts, read again; what is missing is counted."""
    path = shared_folder(spark, "documents")
    ep = F.col("ep")
    status = F.when(ep % 5 == 0, "no camera").when(ep % 7 == 0, "no positions").otherwise("ok").alias("status")
    counts = D.write_documents(trajectories(spark, d).groupBy("ep").agg(F.count("*").alias("length")).select("*", status), path, "ep", "status")
    frames = spark.read.schema("length long, ep long").json(path).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("frames"))  # one row
    return counts.join(F.broadcast(frames)).select("status", "n", F.when(F.col("status") == "ok", F.col("frames")).otherwise(0).alias("frames"))


@query("reexported_dataset", f"WITH {TRAJ}, k AS (SELECT * FROM traj WHERE ep < 40) SELECT count(DISTINCT ep) AS episodes, count(*) AS frames, count(DISTINCT label) AS tasks, round(sum(value), 4) AS total, 'reading' AS stats FROM k")
def reexported_dataset(spark: SparkSession, d: str) -> DataFrame:
    """The first 40 episodes under another column name: totals and statistics follow."""
    root, out = shared_folder(spark, "dataset"), shared_folder(spark, "reexported")
    frames = trajectories(spark, d).select(F.col("ep").alias("episode_index"), F.col("frame").alias("frame_index"), F.col("label").alias("task"), "value", "k")
    D.write_dataset(frames, root)
    one = lambda c, name: F.array(c).alias(name)
    figures = lambda c: frames.agg(F.lit(c).alias("column"), one(F.avg(c), "mean"), one(F.stddev_pop(c), "std"), one(F.min(c).cast("double"), "min"), one(F.max(c).cast("double"), "max"), one(F.min(c).cast("double"), "q01"), one(F.max(c).cast("double"), "q99"))
    D.write_stats(figures("value").unionByName(figures("k")), f"{root}/meta/stats.json")
    D.reexport_dataset(spark, root, out, ["value", "k"], ["k"], {"value": "reading"}, 40)
    info = D.read_document(spark, f"{out}/meta/info.json")
    names = D.read_stats(spark, f"{out}/meta/stats.json").agg(F.array_join(F.sort_array(F.collect_list("column")), ",").alias("stats"))
    total = D.read_frames(spark, out, columns=["reading"]).agg(F.round(F.sum("reading"), 4).alias("total"))
    counts = spark.createDataFrame([(info["total_episodes"], info["total_frames"], info["total_tasks"])], "episodes long, frames long, tasks long")
    return counts.join(F.broadcast(total)).join(F.broadcast(names))

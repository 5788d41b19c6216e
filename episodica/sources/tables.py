"""Canonical views of the driver's tables: episodes of frames, vectors, dialogues, registries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trajectories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as episodes: ep (user), frame, label (event type), value, k, event_id."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("ep"), (F.row_number().over(order) - 1).cast("long").alias("frame"), F.col("event_type").alias("label"), "value",
        F.get_json_object("props", "$.k").cast("long").alias("k"), "event_id", "ts",
    )


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as frames: ep (label), frame (order of vec_id), vec_id, v (array of double)."""
    order = Window.partitionBy("label").orderBy("vec_id")
    return table(spark, sf_dir, "embeddings").select(F.col("label").cast("long").alias("ep"), (F.row_number().over(order) - 1).cast("long").alias("frame"), "vec_id", F.col("embedding").cast("array<double>").alias("v"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings without an order: vec_id, ep, v."""
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("long").alias("ep"), F.col("embedding").cast("array<double>").alias("v"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as episodes: ep, frame, label (role), text."""
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("ep"), F.col("turn").alias("frame"), F.col("role").alias("label"), "text")

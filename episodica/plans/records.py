"""Queries on nested records, transforms of frames, and the files they come from."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import records as R
from ..functions import vectors as V
from ..operators import transforms as X
from ..sources import datasets as D
from ..sources.demos import read_demos, write_demos
from ..sources.folders import shared_folder
from ..sources.tables import states, table, trajectories, vectors
from .catalogue import DIMS, TRAJ, VEC, query
from .vectors import MODALITIES


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """Line items as records."""
    c = F.col
    rate, value = F.struct(c("l_discount").alias("discount"), c("l_tax").alias("tax")), F.struct(c("l_quantity").alias("amount"), c("l_extendedprice").alias("net"))
    return table(spark, d, "lineitem").select(
        F.struct(c("l_orderkey").alias("order"), c("l_linenumber").alias("line")).alias("key"), F.struct(value.alias("value"), rate.alias("rate")).alias("price"),
        F.struct(c("l_returnflag").alias("returned"), c("l_linestatus").alias("status")).alias("flags"),
    )


def _flat(df: DataFrame) -> DataFrame:
    """Leaves as columns named by their paths, with underscores."""
    return df.select(*(c.alias(p.replace("/", "_")) for p, c in R.leaves(df).items()))


@query("record_repack", "SELECT l_orderkey AS id_order, l_linenumber AS id_line, l_tax AS rates_tax, l_quantity AS amount, l_returnflag AS flags_returned, l_linestatus AS flags_status FROM lineitem")
def record_repack(spark: SparkSession, d: str) -> DataFrame:
    return _flat(R.repack(_lines(spark, d), {"id": {"order": "key/order", "line": "key/line"}, "rates": {"tax": "price/rate/tax"}, "amount": "price/value/amount", "flags": "flags"}))


@query("record_rename", "SELECT l_orderkey AS order, l_linenumber AS line, l_quantity AS money_of_amount, l_extendedprice AS money_of_net, l_discount AS price_rate_discount FROM lineitem")
def record_rename(spark: SparkSession, d: str) -> DataFrame:
    return _flat(R.rename(_lines(spark, d), {"key/(.*)": r"\1", "price/value/(.*)": r"money/of/\1", ".*/tax": None, "flags/.*": None}))


@query("record_combine", "SELECT l_orderkey AS order, l_linenumber AS line, round(l_extendedprice * (1 - l_discount), 6) AS value_net, l_quantity AS value_amount, l_discount AS rate_discount, round(l_tax * 100, 6) AS rate_tax FROM lineitem")
def record_combine(spark: SparkSession, d: str) -> DataFrame:
    """Leaves of a price times those of the same path of a record of factors; the others stay."""
    df = _lines(spark, d).withColumn("by", F.struct(F.struct((1 - F.col("price.rate.discount")).alias("net")).alias("value"), F.struct(F.lit(100.0).alias("tax")).alias("rate")))
    made = R.combine(R.leaves(df, "price"), R.leaves(df, "by"), lambda a, b: F.round(a * b, 6), strict=True)
    return _flat(df.select("key.order", "key.line", *(c.alias(k) for k, c in R.nested(made).items())))


@query("record_update", "SELECT l_orderkey AS order, l_linenumber AS line, l_quantity AS value_amount, l_extendedprice AS value_net, l_discount AS rate_discount, 0.0::DOUBLE AS rate_tax, l_returnflag AS note FROM lineitem")
def record_update(spark: SparkSession, d: str) -> DataFrame:
    """A price updated by a record with a leaf that it has, and one that it lacks."""
    df = _lines(spark, d).withColumn("more", F.struct(F.struct(F.lit(0.0).alias("tax")).alias("rate"), F.col("flags.returned").alias("note")))
    return _flat(df.select("key.order", "key.line", R.record(R.update(R.leaves(df, "price"), R.leaves(df, "more"))).alias("p")).select("order", "line", "p.*"))


@query("record_pairs", "SELECT s_suppkey, unnest(['name', 'at/nation', 'at/half']) AS path, unnest([s_name, s_nationkey::VARCHAR, (s_suppkey // 2)::VARCHAR]) AS value FROM supplier")
def record_pairs(spark: SparkSession, d: str) -> DataFrame:
    df = table(spark, d, "supplier").select("s_suppkey", F.col("s_name").alias("name"), F.struct(F.col("s_nationkey").alias("nation"), F.floor(F.col("s_suppkey") / 2).alias("half")).alias("at"))
    return R.pairs(df, "s_suppkey")


@query("leaves_by_type", "SELECT p_partkey + 1 AS p_partkey, upper(p_name) AS p_name, -p_size AS p_size, round(p_retailprice * 2, 6) AS p_retailprice FROM part")
def leaves_by_type(spark: SparkSession, d: str) -> DataFrame:
    by_type = {T.LongType: lambda c: c + 1, T.IntegerType: lambda c: -c, T.StringType: F.upper, T.DoubleType: lambda c: F.round(c * 2, 6)}
    return R.map_leaves(table(spark, d, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"), by_type)


@query("packed_arrays", "SELECT event_id, to_base64(encode(event_type)) AS data, 'u1' AS dtype, length(event_type) AS size, event_type AS back FROM events")
def packed_arrays(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "events").select("event_id", F.encode("event_type", "utf-8").alias("raw"))
    packed = raw.select("event_id", R.pack_array(F.col("raw"), "u1", (1,)).alias("p"), F.octet_length("raw").cast("long").alias("size"))
    return packed.select("event_id", "p.data", "p.dtype", "size", F.decode(R.unpack_array(F.col("p")), "utf-8").alias("back"))


@query("segmentation_indices", f"WITH {DIMS} SELECT vec_id, CASE WHEN dim < 3 THEN dim ELSE dim - 3 END AS i, round(x, 6) AS x FROM dims WHERE dim < 3 OR (dim >= 6 AND dim < 8)")
def segmentation_indices(spark: SparkSession, d: str) -> DataFrame:
    """The elements that segments are cut by: position and gripper."""
    at = V.range_indices([MODALITIES["position"], MODALITIES["gripper"]])
    return vectors(spark, d).select("vec_id", F.posexplode(V.pick(F.col("v"), at)).alias("i", "x")).select("vec_id", F.col("i").cast("long").alias("i"), F.round("x", 6).alias("x"))


@query("modality_document", f"WITH {DIMS} SELECT vec_id, CASE WHEN dim < 3 THEN 'position' WHEN dim < 6 THEN 'rotation' ELSE 'gripper' END AS modality, round(sum(x), 6) AS total FROM dims WHERE dim < 8 GROUP BY 1, 2")
def modality_document(spark: SparkSession, d: str) -> DataFrame:
    """Ranges of a vector as a document tells them."""
    path = shared_folder(spark, "modality")
    written = json.dumps({"state": {k: {"start": a, "end": b} for k, (a, b) in MODALITIES.items()}})
    spark.range(1).select(F.lit(written).alias("value")).write.text(path)
    ranges = D.modality_ranges(D.read_document(spark, path))["state"]
    parts = F.array(*(F.struct(F.lit(k).alias("modality"), F.round(F.aggregate(V.part(F.col("v"), *r), F.lit(0.0), lambda a, x: a + x), 6).alias("total")) for k, r in ranges.items()))
    return vectors(spark, d).select("vec_id", F.inline(parts))


@query("policy_rows", f"WITH {VEC} SELECT vec_id, round(list_sum(v[1:6]), 6) AS state, 10::BIGINT AS state_size, 10::BIGINT AS action_size, round(v[9], 6) AS base, round(v[13], 6) AS wrist, 0.0::DOUBLE AS other, true AS has_base, ep % 2 = 0 AS has_wrist, false AS has_other, round(v[1], 6) AS first_action, 4::BIGINT AS cut FROM vec WHERE ep % 2 = 0 UNION ALL SELECT vec_id, round(list_sum(v[1:6]), 6), 10, 10, round(v[9], 6), 0.0, 0.0, true, false, false, round(v[1], 6), 4 FROM vec WHERE ep % 2 <> 0 OR ep IS NULL")
def policy_rows(spark: SparkSession, d: str) -> DataFrame:
    """A model's record: padded state and actions, three image slots of which one is never filled and one not always, and their masks; then its actions cut."""
    v = F.col("v")
    rows = vectors(spark, d).select(
        "vec_id", V.part(v, 0, 6).alias("state"), F.array(V.part(v, 0, 6), V.part(v, 6, 12)).alias("actions"), V.part(v, 8, 12).alias("image"), F.when(F.col("ep") % 2 == 0, V.part(v, 12, 16)).alias("wrist_image"),
    )
    made = X.chain(rows, [X.policy_input("state", "actions", 10), X.image_slots({"base": "image", "wrist": "wrist_image", "other": None})])
    made = made.withColumn("action_size", F.size(F.get("actions", F.lit(1))).cast("long")).transform(X.policy_output("actions", 4))
    first = lambda c: F.round(F.get(f"images.{c}", F.lit(0)), 6).alias(c)
    return made.select(
        "vec_id", F.round(F.aggregate("state", F.lit(0.0), lambda a, x: a + x), 6).alias("state"), F.size("state").cast("long").alias("state_size"), "action_size", first("base"), first("wrist"), first("other"),
        *(F.col(f"image_masks.{c}").alias(f"has_{c}") for c in ("base", "wrist", "other")), F.round(F.get(F.get("actions", F.lit(0)), F.lit(0)), 6).alias("first_action"), F.size(F.get("actions", F.lit(0))).cast("long").alias("cut"),
    )


@query("frame_prompts", f"WITH {TRAJ} SELECT event_id, CASE WHEN label = 'error' THEN 'wait' ELSE 'do ' || label END AS prompt FROM traj")
def frame_prompts(spark: SparkSession, d: str) -> DataFrame:
    """A prompt by task number; frames without a text get the default."""
    t = trajectories(spark, d).select("event_id", "label")
    tasks = t.groupBy("label").agg(F.min("event_id").alias("task_index"))
    known = tasks.select("task_index", F.concat(F.lit("do "), "label").alias("task"))
    frames = t.join(tasks, "label")
    rows = X.chain(frames, [X.prompt_of_task(known), lambda df: df.withColumn("prompt", F.when(F.col("label") != "error", F.col("prompt"))), X.default_prompt("wait")])
    return rows.select("event_id", "prompt")


@query("action_parts", f"WITH {VEC}, a AS (SELECT vec_id, v, v[4] AS x, v[5] AS y, v[6] AS z, sqrt(v[4] * v[4] + v[5] * v[5] + v[6] * v[6]) AS t FROM vec), q AS (SELECT vec_id, v, cos(t / 2) AS w, x * sin(t / 2) / t AS i, y * sin(t / 2) / t AS j, z * sin(t / 2) / t AS k FROM a) SELECT vec_id, round(v[1] + v[2] + v[3], 6) AS pos, round(v[4] + v[5] + v[6], 6) AS rot, round(1 - 2 * (j * j + k * k), 6) AS r1, round(2 * (j * k - i * w), 6) AS r6, round(v[7], 6) AS gripper, CASE WHEN vec_id % 2 = 0 THEN round(v[8], 6) END AS base_mode FROM q")
def action_parts(spark: SparkSession, d: str) -> DataFrame:
    """Actions of eight numbers, and of seven, which have no base mode."""
    v = F.when(F.col("vec_id") % 2 == 0, V.part(F.col("v"), 0, 8)).otherwise(V.part(F.col("v"), 0, 7))
    made = vectors(spark, d).select("vec_id", v.alias("a")).select("vec_id", *(c.alias(k) for k, c in X.action_parts(F.col("a")).items()))
    total = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda a, x: a + x), 6).alias(c)
    return made.select("vec_id", total("pos"), total("rot"), F.round(F.get("rot_6d", F.lit(0)), 6).alias("r1"), F.round(F.get("rot_6d", F.lit(5)), 6).alias("r6"), F.round("gripper", 6).alias("gripper"), F.round("base_mode", 6).alias("base_mode"))


_BOXES = "b AS (SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS box, list(l_returnflag ORDER BY l_linenumber, l_partkey, l_suppkey) AS name FROM lineitem GROUP BY l_orderkey)"


@query("task_boxes", f"WITH {_BOXES} SELECT l_orderkey, box[1] AS task_box, CASE WHEN l_orderkey % 3 = 0 THEN 'kind ' || name[1] WHEN l_orderkey % 3 = 1 THEN name[1] ELSE 'object' END AS task_name, coalesce(list_sum(box[2:]), 0)::BIGINT AS distractors, CASE WHEN l_orderkey % 3 = 0 THEN '' WHEN l_orderkey % 3 = 1 THEN array_to_string(name[2:], ',') ELSE '' END AS distractor_names FROM b")
def task_boxes(spark: SparkSession, d: str) -> DataFrame:
    """The first box of an order is its task's, the others distract; names by category, by list, or none."""
    rows = table(spark, d, "lineitem").select("l_orderkey", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag").alias("x"))
    boxes = rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("x")).alias("x")).select("l_orderkey", F.col("x.l_partkey").alias("box"), F.col("x.l_returnflag").alias("name"))
    third = F.col("l_orderkey") % 3
    kind, names = F.when(third == 0, F.concat(F.lit("kind "), F.get("name", F.lit(0)))), F.when(third == 1, F.col("name"))
    made = boxes.select("l_orderkey", *(c.alias(k) for k, c in X.task_object(F.col("box"), names, kind).items()))
    return made.select("l_orderkey", "task_box", "task_name", F.aggregate("distractors", F.lit(0).cast("long"), lambda a, x: a + x).alias("distractors"), F.array_join("distractor_names", ",").alias("distractor_names"))


@query("scene_targets", "WITH f AS (SELECT DISTINCT p_name AS thing FROM part), s AS (SELECT p_partkey, p_name, p_partkey % 3 AS k FROM part), t AS (SELECT p_partkey, p_name AS query, p_name AS label FROM s WHERE k = 0 UNION SELECT p_partkey, thing, thing FROM s JOIN f ON k > 0 AND len(list_filter(string_split(thing, ' '), lambda w: NOT list_contains(string_split(p_name || ' in the box', ' '), w))) = 0) SELECT * FROM t")
def scene_targets(spark: SparkSession, d: str) -> DataFrame:
    """Targets that a scene refers to; where it refers to none, the things whose words its instruction has. Things are found by their first word, not one by one."""
    scenes = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("ref"), F.concat("p_name", F.lit(" in the box")).alias("said"), (F.col("p_partkey") % 3).alias("k"))
    things = table(spark, d, "part").select(F.col("p_name").alias("thing")).distinct()
    return X.scene_targets(scenes.select("p_partkey", F.when(F.col("k") == 0, F.col("ref")).alias("ref"), "said"), things, "p_partkey", "ref", "said", "thing")


@query("scene_paths", "SELECT s_suppkey, 'layouts/' || CASE WHEN s_suppkey % 20 BETWEEN 1 AND 10 THEN 'test' ELSE 'train' END || '/layout' || lpad((s_suppkey % 20)::VARCHAR, 3, '0') || '.yaml' AS layout, 'styles/' || CASE WHEN s_nationkey BETWEEN 1 AND 10 THEN 'test' ELSE 'train' END || '/style' || lpad(s_nationkey::VARCHAR, 3, '0') || '.yaml' AS style FROM supplier")
def scene_paths(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select("s_suppkey", X.scene_path(F.col("s_suppkey") % 20, "layout").alias("layout"), X.scene_path(F.col("s_nationkey"), "style").alias("style"))


@query("transform_groups", f"WITH {DIMS} SELECT vec_id, dim AS i, round(x, 6) AS x FROM dims WHERE dim < 5 UNION ALL SELECT vec_id, unnest([5, 6, 7]), 0.0 FROM vec")
def transform_groups(spark: SparkSession, d: str) -> DataFrame:
    """Inputs of a group in order, its outputs after them: scaled, padded, and scaled back before the last step."""
    times = lambda k: lambda df: df.withColumn("v", F.transform("v", lambda x: x * k))
    pad = lambda df: df.withColumn("v", V.pad(F.col("v"), 8))
    group = X.Group((times(4.0),), (times(0.25),)).push([pad, times(2.0)], [times(0.5)])
    rows = X.chain(vectors(spark, d).select("vec_id", V.part(F.col("v"), 0, 5).alias("v")), [*group.inputs, *group.outputs])
    return rows.select("vec_id", F.posexplode("v").alias("i", "x")).select("vec_id", F.col("i").cast("long").alias("i"), F.round("x", 6).alias("x"))


_STATS = {"v": {"mean": [0.0, 0.1, -0.1, 0.0], "std": [0.5, 0.25, 1.0, 2.0], "q01": [-1.0, -0.5, -0.25, -0.1], "q99": [1.0, 0.5, 0.25, 0.1]}}
_NOISE = "0.2 * (('0x' || substr(sha256('9|' || vec_id || '|' || (i - 1)), 1, 13))::BIGINT / 4503599627370496.0 * 2 - 1)"


@query("modality_modes", f"WITH {VEC}, x AS (SELECT vec_id, unnest(range(1, 5)) AS i, v FROM vec), z AS (SELECT vec_id, i, (v[i] - [0.0, 0.1, -0.1, 0.0][i]) / ([0.5, 0.25, 1.0, 2.0][i] + 1e-6) AS z, v[i] AS x FROM x) SELECT vec_id, i - 1 AS i, round(z + {_NOISE}, 5) AS trained, round(z, 5) AS plain, round(x, 5) AS back FROM z")
def modality_modes(spark: SparkSession, d: str) -> DataFrame:
    """Scaled vectors with noise in training and without it else; the latter undone."""
    rows = vectors(spark, d).select("vec_id", V.part(F.col("v"), 0, 4).alias("v"))
    modes = X.Composed([X.Modality(["v"], _STATS, noise=0.2, key="vec_id", seed=9)])
    trained = modes.train(True).apply(rows).select("vec_id", F.col("v").alias("trained"))
    plain = modes.train(False).apply(rows)
    both = plain.join(modes.unapply(plain).select("vec_id", F.col("v").alias("back")), "vec_id").join(trained, "vec_id")
    return both.select("vec_id", F.posexplode(F.arrays_zip("trained", F.col("v").alias("plain"), "back")).alias("i", "p")).select("vec_id", F.col("i").cast("long").alias("i"), *(F.round(f"p.{c}", 5).alias(c) for c in ("trained", "plain", "back")))


def _changes(pdf: pd.DataFrame) -> pd.DataFrame:
    """A sample for each change of label: where, from what, to what."""
    pdf = pdf.sort_values("frame")
    before = pdf["label"].shift(1)
    at = before.notna() & (before != pdf["label"])
    return pd.DataFrame({"ep": pdf["ep"][at], "frame": pdf["frame"][at], "before": before[at], "after": pdf["label"][at]})


@query("episode_samples", f"WITH {TRAJ}, c AS (SELECT ep, frame, lag(label) OVER (PARTITION BY ep ORDER BY frame) AS before, label AS after FROM traj) SELECT * FROM c WHERE before <> after")
def episode_samples(spark: SparkSession, d: str) -> DataFrame:
    """A user's table function: any number of samples of each episode."""
    return X.sample_rows(trajectories(spark, d).select("ep", "frame", "label"), _changes, "ep long, frame long, before string, after string")


@query("first_files", "SELECT DISTINCT 'event_type=' || event_type AS task, CASE WHEN user_id % 2 = 0 THEN 'generated' ELSE 'human' END AS tier, 1::BIGINT AS n FROM events")
def first_files(spark: SparkSession, d: str) -> DataFrame:
    """One file of each task and kind, of a folder that Spark has written by both."""
    path = shared_folder(spark, "demos")
    kind = F.when(F.col("user_id") % 2 == 0, "mg").otherwise("by-hand").alias("kind")
    table(spark, d, "events").select("event_id", "event_type", kind).write.partitionBy("kind", "event_type").parquet(path)
    return D.first_files(spark, path, "part-*", "/kind=mg/").groupBy("task", "tier").agg(F.count("*").alias("n"))


@query("synthetic_rows", "SELECT count(*) AS n, count(*) AS fit, true AS differ FROM events")
def synthetic_rows(spark: SparkSession, d: str) -> DataFrame:
    """As many made-up rows as there are events, all of the schema's ranges, and not alike."""
    schema = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("k", T.LongType()), T.StructField("v", T.ArrayType(T.DoubleType()))])
    rows = D.synthetic(spark, table(spark, d, "events").count(), schema, 5)
    fits = F.col("x").between(-1, 1) & F.col("k").between(0, 2047) & (F.size("v") == 8) & F.forall("v", lambda e: e.between(-1, 1))
    return rows.agg(F.count("*").alias("n"), F.count_if(fits).alias("fit"), (F.approx_count_distinct("x") > F.count("*") / 2).alias("differ"))


def _halves() -> object:
    """A unit's work: two rows, or one for odd keys, which fail at first; every tenth fails for good."""
    seen: set[int] = set()

    def work(unit: dict) -> list[tuple]:
        key = unit["event_id"]
        if key % 10 == 9 or key % 2 and key not in seen:
            seen.add(key)
            raise RuntimeError(f"unit {key}")
        return [(unit["value"] / 2,)] * (1 if key % 2 else 2)

    return work


@query("work_units", "WITH u AS (SELECT event_id, value, CASE WHEN event_id % 10 = 9 THEN [0] WHEN event_id % 2 = 1 THEN [0] ELSE [0, 1] END AS places FROM events) SELECT event_id, unnest(places)::BIGINT AS place, CASE WHEN event_id % 10 = 9 THEN 3 WHEN event_id % 2 = 1 THEN 2 ELSE 1 END::BIGINT AS tries, CASE WHEN event_id % 10 = 9 THEN 'RuntimeError: unit ' || event_id END AS error, CASE WHEN event_id % 10 <> 9 THEN round(value / 2, 6) END AS half FROM u")
def work_units(spark: SparkSession, d: str) -> DataFrame:
    """Units that fail are tried again, three times at most; what they make keeps its place."""
    units = table(spark, d, "events").select("event_id", "value")
    return X.work_units(units, "event_id", _halves(), "half double").withColumn("half", F.round("half", 6))


@query("demo_files", f"WITH {VEC}, t AS (SELECT ep, frame, v FROM vec WHERE ep IS NOT NULL) SELECT 'demo_' || ep AS demo, ep AS number, frame, round(v[1] + v[2] + v[3], 5) AS position, round(v[7] + v[8], 5) AS gripper, 5::BIGINT AS size FROM t")
def demo_files(spark: SparkSession, d: str) -> DataFrame:
    """Archives written of every episode, and read again: two arrays of each frame, one after the other."""
    root = shared_folder(spark, "demo-files")
    v = F.col("v")
    frames = states(spark, d).where("ep IS NOT NULL").select("ep", "frame", V.part(v, 0, 3).alias("p"), V.part(v, 6, 8).alias("g"))
    write_demos(frames, root, "ep", "frame", {"position": "p", "gripper": "g"}).agg(F.count("*")).collect()
    total = lambda a, b: F.round(F.aggregate(V.part(F.col("state"), a, b), F.lit(0.0), lambda x, y: x + y), 5)
    return read_demos(spark, root, ["position", "gripper"]).select("demo", "number", "frame", total(0, 3).alias("position"), total(3, 5).alias("gripper"), F.size("state").cast("long").alias("size"))

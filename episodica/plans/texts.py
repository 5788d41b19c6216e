"""Queries on text: rendering, parsing, normal forms, flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import texts as T
from ..functions import vectors as V
from ..sources.tables import table, trajectories, vectors
from .catalogue import TRAJ, VEC, query

#: Texts in the forms that models write, as a table to parse.
def _move_sql() -> str:
    steps = [("move", "forward", "backward", "mm"), ("move", "left", "right", "mm"), ("move", "upward", "downward", "mm"), ("roll", "upward", "downward", "degrees"), ("pitch", "upward", "downward", "degrees"), ("yaw", "counterclockwise", "clockwise", "degrees")]
    parts = [f"'{n} ' || CASE WHEN v[{i}] > 0 THEN '{a}' ELSE '{b}' END || ' ' || round_even(abs({f'v[{i}] * 1000' if u == 'mm' else f'degrees(v[{i}])'}), 0)::BIGINT || ' {u}; '" for i, (n, a, b, u) in enumerate(steps, 1)]
    return f"WITH {VEC} SELECT vec_id, " + " || ".join(parts) + " || CASE WHEN v[7] * 5 > 0.5 THEN 'open gripper;' ELSE 'close gripper;' END AS said FROM vec"


@query("describe_move_text", _move_sql())
def describe_move_text(spark: SparkSession, d: str) -> DataFrame:
    v = F.concat(V.part(F.col("v"), 0, 6), F.array(F.element_at("v", 7) * 5))
    return vectors(spark, d).select("vec_id", T.describe_move(v).alias("said"))


_BOXES = "b AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE [p_size, p_size + 1, p_size + 5, p_size + 9] END AS a, [p_partkey % 100, p_size, p_partkey % 100 + 3, p_size + 4] AS b, CASE WHEN p_partkey % 3 > 0 THEN p_brand END AS n FROM part)"


def _two_boxes(spark: SparkSession, d: str) -> DataFrame:
    k, s = F.col("p_partkey") % 100, F.col("p_size").cast("long")
    first = F.when(F.col("p_partkey") % 5 != 0, F.array(s, s + 1, s + 5, s + 9))
    return table(spark, d, "part").select("p_partkey", F.array(first, F.array(k, s, k + 3, s + 4)).alias("boxes"), F.array(F.when(F.col("p_partkey") % 3 > 0, F.col("p_brand"))).alias("names"))




@query("render_boxes", f"WITH {_BOXES} SELECT p_partkey, coalesce(coalesce(n, 'obj_0') || ': [' || a[1] || ', ' || a[2] || '], [' || a[3] || ', ' || a[4] || ']' || chr(10), '') || 'obj_1: [' || b[1] || ', ' || b[2] || '], [' || b[3] || ', ' || b[4] || ']' AS said FROM b")
def render_boxes(spark: SparkSession, d: str) -> DataFrame:
    return _two_boxes(spark, d).select("p_partkey", T.boxes(F.col("boxes"), F.col("names")).alias("said"))


@query("parse_boxes", f"WITH {_BOXES}, u AS (SELECT p_partkey, coalesce(n, 'obj_0') AS name, a AS b FROM b WHERE a IS NOT NULL UNION ALL SELECT p_partkey, 'obj_1', b FROM b) SELECT p_partkey, name, b[1]::BIGINT AS x1, b[2]::BIGINT AS y1, b[3]::BIGINT AS x2, b[4]::BIGINT AS y2 FROM u")
def parse_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Rendered boxes read back."""
    said = _two_boxes(spark, d).select("p_partkey", T.parse_boxes(T.boxes(F.col("boxes"), F.col("names"), "  ")).alias("m"))
    rows = said.select("p_partkey", F.explode("m").alias("name", "b"))
    return rows.select("p_partkey", "name", *(F.element_at("b", i).alias(n) for i, n in ((1, "x1"), (2, "y1"), (3, "x2"), (4, "y2"))))


@query("parse_first_point", "SELECT event_id, CASE WHEN event_id % 4 > 0 THEN user_id END AS x, CASE WHEN event_id % 4 > 0 THEN -CAST(json_extract_string(props, '$.k') AS BIGINT) END AS y FROM events")
def parse_first_point(spark: SparkSession, d: str) -> DataFrame:
    p = T.point(F.array("ep", -F.col("k")))
    text = F.when(F.col("event_id") % 4 > 0, F.concat(F.lit("gripper at "), p, F.lit(" then [1, 2]"))).otherwise("gripper unseen")
    got = T.first_point(text)
    return trajectories(spark, d).select("event_id", F.element_at(got, 1).alias("x"), F.element_at(got, 2).alias("y"))


@query("parse_plan", "SELECT p_partkey, unnest([1, 2])::BIGINT AS number, unnest(['grasp ' || p_brand, 'place it']) AS label, unnest(['[1, 2];[' || p_size || ', 4];[5, 6]', '[7, 8];[9, 0];[1, 1]']) AS points FROM part")
def parse_plan(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("Plan:\n1. grasp "), F.col("p_brand"), F.lit(": [1, 2], ["), F.col("p_size").cast("string"), F.lit(", 4], [5, 6]\n2. place it: [7, 8], [9, 0], [1, 1]\n"))
    return table(spark, d, "part").select("p_partkey", F.inline(T.parse_plan(text))).withColumn("points", F.array_join("points", ";"))


_SAID = "CASE WHEN event_type IN ('view', 'click', 'purchase') THEN {} ELSE 'unknown label' END"


@query("check_labels", f"SELECT event_id, CASE event_id % 5 WHEN 0 THEN {_SAID.format("'ok'")} WHEN 1 THEN {_SAID.format("'wrong count'")} WHEN 2 THEN 'unreadable' WHEN 3 THEN 'not pairs' ELSE {_SAID.format("'ok'")} END AS status, [2, 1, 0, 1, 2][event_id % 5 + 1]::BIGINT AS pairs FROM events")
def check_labels(spark: SparkSession, d: str) -> DataFrame:
    """Answers that label two segments, with quoted or bare numbers; with one label, none, a label without a reason."""
    kind, e = F.col("event_id") % 5, F.col("event_type")
    text = (
        F.when(kind == 0, F.concat(F.lit("Here: {'0': ['"), e, F.lit("', 'it closes'], '1': ['view', 'it opens']}")))
        .when(kind == 1, F.concat(F.lit("{'0': ['"), e, F.lit("', 'x']}")))
        .when(kind == 2, "no labels").when(kind == 3, F.concat(F.lit("{'0': ['"), e, F.lit("']}")))
        .otherwise(F.concat(F.lit("{0: ['"), e, F.lit("', 'it closes'], 1: ['click', 'it opens']} done")))
    )
    allowed = F.array(F.lit("view"), F.lit("click"), F.lit("purchase"))
    return table(spark, d, "events").select("event_id", T.check_labels(text, F.lit(2), allowed).alias("status"), F.size(T.parse_labels(text)).cast("long").alias("pairs"))


@query("parse_list", "SELECT item_id, 'find ' || item_id || '|put it' AS items FROM benchmark WHERE item_id % 3 > 0 UNION ALL SELECT item_id, NULL FROM benchmark WHERE item_id % 3 = 0")
def parse_list(spark: SparkSession, d: str) -> DataFrame:
    text = F.when(F.col("item_id") % 3 > 0, F.concat(F.lit("```json\n[' find "), F.col("item_id").cast("string"), F.lit("', '', 'put it ']\n```"))).otherwise("[ ]")
    return table(spark, d, "benchmark").select("item_id", F.array_join(T.parse_list(text), "|").alias("items"))


@query("classify_phase", "SELECT event_id, CASE event_type WHEN 'view' THEN 'approach' WHEN 'click' THEN 'interact' WHEN 'purchase' THEN 'grasp' WHEN 'signup' THEN 'place' ELSE 'other' END AS phase, CASE event_type WHEN 'view' THEN 'shelf ' || user_id WHEN 'signup' THEN 'box ' || user_id END AS destination FROM events")
def classify_phase(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_type")
    place = F.col("user_id").cast("string")
    label = F.when(e == "view", F.concat(F.lit("Move to shelf "), place, F.lit("."))).when(e == "click", "press button").when(e == "purchase", "Pick it up").when(e == "signup", F.concat(F.lit("put cup in the tray into box "), place)).otherwise("wait")
    return table(spark, d, "events").select("event_id", T.phase(label).alias("phase"), T.destination(label).alias("destination"))


@query("object_names", "SELECT p_partkey, p_partkey % 7 || ' tall cup' AS spoken, 'Tall Cup Top' AS camel, CASE WHEN p_partkey % 2 = 0 THEN 'cup' ELSE 'gas' END AS singular, CASE WHEN p_partkey % 2 = 0 THEN 'place the cup to shelf' ELSE 'grasp the cup' END AS step FROM part")
def object_names(spark: SparkSession, d: str) -> DataFrame:
    even = F.col("p_partkey") % 2 == 0
    name = F.concat((F.col("p_partkey") % 7).cast("string"), F.lit("_tall_cup_"), F.col("p_size").cast("string"))
    kind = F.when(even, "place").otherwise("grasp")
    return table(spark, d, "part").select("p_partkey", T.spoken_name(name).alias("spoken"), T.camel_words(F.lit("TallCupTop")).alias("camel"), T.singular(F.when(even, "cups").otherwise("gas")).alias("singular"), T.step_text(kind, F.lit("cup"), F.when(even, "shelf")).alias("step"))


@query("normalize_tokens", "SELECT doc_id, trim(regexp_replace(lower(t), '[^a-z0-9]+', ' ', 'g')) AS plain, array_to_string(list_sort(list_distinct(list_filter(regexp_extract_all(lower(t), '[a-z]+'), lambda w: NOT list_contains(['a','an','the','of','to','in','on','and','it','is','from','with','by','for'], w)))), ' ') AS tokens, replace(replace(trim(t), '_', ' '), chr(10), ' ') AS prompt FROM (SELECT doc_id, text AS t FROM documents)")
def normalize_tokens(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", T.plain(t).alias("plain"), F.array_join(F.sort_array(T.tokens(t)), " ").alias("tokens"), T.clean_prompt(t).alias("prompt"))


@query("flag_same_category", "WITH w AS (SELECT item_id, list_filter(regexp_extract_all(lower(text), '[a-z]+'), lambda x: length(x) > 3) AS w FROM benchmark) SELECT item_id, len(w) <> len(list_distinct(w)) AS repeated, len(w)::BIGINT AS words FROM w")
def flag_same_category(spark: SparkSession, d: str) -> DataFrame:
    """Instructions that name one thing twice."""
    w = F.filter(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), 0), lambda x: F.length(x) > 3)
    return table(spark, d, "benchmark").select("item_id", (F.size(w) != F.size(F.array_distinct(w))).alias("repeated"), F.size(w).cast("long").alias("words"))


@query("multiphase_plans", f"WITH {TRAJ}, p AS (SELECT ep, frame, label, CASE WHEN label LIKE 'v%' OR frame = 0 THEN 1 ELSE 0 END AS s FROM traj) SELECT ep, frame, (sum(s) OVER (PARTITION BY ep ORDER BY frame) - 1)::BIGINT AS phase, sum(CASE WHEN label LIKE 'v%' THEN 1 ELSE 0 END) OVER (PARTITION BY ep) >= 2 AS multiphase FROM p")
def multiphase_plans(spark: SparkSession, d: str) -> DataFrame:
    """A plan cut at its approaches, as a running sum; index 0 always begins a phase."""
    w = Window.partitionBy("ep")
    start = F.lower("label").rlike("^v").cast("long")
    t = trajectories(spark, d).select("ep", "frame", F.coalesce(start, F.lit(0)).alias("start"))
    phase = F.sum(F.when(F.col("frame") == 0, 1).otherwise(F.col("start"))).over(w.orderBy("frame")) - 1
    return t.select("ep", "frame", phase.cast("long").alias("phase"), (F.sum("start").over(w) >= 2).alias("multiphase"))


@query("prompt_templates", "SELECT user_id AS ep, 'Task: ' || arg_min(event_type, event_id) || '. Steps: ' || count(*) || '.' AS prompt FROM events GROUP BY user_id")
def prompt_templates(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").groupBy(F.col("user_id").alias("ep")).agg(F.min_by("event_type", "event_id").alias("t"), F.count("*").alias("n"))
    return e.select("ep", F.format_string("Task: %s. Steps: %d.", "t", "n").alias("prompt"))


@query("path_parts", "SELECT event_id, event_type AS task, user_id AS episode, 'chunk-' || lpad((user_id // 1000)::VARCHAR, 3, '0') || '/episode_' || lpad(user_id::VARCHAR, 6, '0') || '.parquet' AS path, '/new/' || event_type || '.xml' AS moved FROM events")
def path_parts(spark: SparkSession, d: str) -> DataFrame:
    """Keys taken apart at the last bar, paths by template, prefixes rewritten."""
    from ..sources.datasets import episode_path

    key = F.concat("event_type", F.lit("|"), F.col("user_id").cast("string"))
    return table(spark, d, "events").select(
        "event_id", F.regexp_extract(key, r"^(.*)\|", 1).alias("task"), F.regexp_extract(key, r"\|(\d+)$", 1).cast("long").alias("episode"), episode_path(F.col("user_id")).alias("path"),
        T.moved_path(F.concat(F.lit("/old/assets/"), F.col("event_type"), F.lit(".xml")), "/old/assets", "/new").alias("moved"),
    )


@query("json_attributes", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CASE WHEN event_id % 2 = 0 THEN 'cup' END AS category FROM events")
def json_attributes(spark: SparkSession, d: str) -> DataFrame:
    """JSON attributes by an explicit schema, and the category of the object named obj, null where there is none."""
    meta = F.format_string('{"cfgs":[{"name":"other","cat":"x"},{"name":"%s","cat":"cup"}]}', F.when(F.col("event_id") % 2 == 0, "obj").otherwise("o2"))
    cfgs = F.from_json(meta, "cfgs array<struct<name:string,cat:string>>")["cfgs"]
    k = F.from_json("props", "k long", {"mode": "PERMISSIVE"})["k"]
    return table(spark, d, "events").select("event_id", k.alias("k"), F.get(F.filter(cfgs, lambda c: c["name"] == "obj"), F.lit(0))["cat"].alias("category"))


@query("padded_tokens", "SELECT event_id, array_to_string([coalesce(x[1], 0), coalesce(x[2], 0), coalesce(x[3], 0)], ',') AS ids, least(3, len(x))::BIGINT AS n FROM (SELECT event_id, list_transform(range(0, (event_id % 5)::BIGINT), lambda i: event_id + i) AS x FROM events)")
def padded_tokens(spark: SparkSession, d: str) -> DataFrame:
    n = (F.col("event_id") % 5).cast("int")
    ids = F.filter(F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.when(i < n, F.col("event_id") + i)), lambda x: x.isNotNull())
    out, mask = T.padded_tokens(ids, 3)
    return table(spark, d, "events").select("event_id", F.array_join(F.transform(out, lambda x: x.cast("string")), ",").alias("ids"), F.size(F.filter(mask, lambda m: m)).cast("long").alias("n"))

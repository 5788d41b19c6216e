"""Queries on ordered frames: gathers, runs, segments, key frames, targets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import texts as T
from ..operators import sequences as Q
from ..operators.segmentation import hdbscan_segments as cluster
from ..operators.segmentation import ordered_labels
from ..sources.tables import states, trajectories, turns
from .catalogue import TRAJ, VEC, query

_RUN = TRAJ + ", b AS (SELECT *, CASE WHEN frame > 0 AND label IS DISTINCT FROM lag(label) OVER (PARTITION BY ep ORDER BY frame) THEN 1 ELSE 0 END AS n FROM traj), run AS (SELECT *, (sum(n) OVER (PARTITION BY ep ORDER BY frame))::BIGINT AS run FROM b), rng AS (SELECT ep, run, min(label) AS label, min(frame) AS start, max(frame) AS \"end\", count(*) AS frames FROM run GROUP BY ep, run)"


@query("step_universe", f"WITH {TRAJ} SELECT ep, frame FROM traj")
def step_universe(spark: SparkSession, d: str) -> DataFrame:
    n = trajectories(spark, d).groupBy("ep").agg(F.count("*").alias("n"))
    return n.select("ep", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("frame"))


@query("episode_offsets", f"WITH {TRAJ}, n AS (SELECT ep, count(*) AS length FROM traj GROUP BY ep) SELECT ep, length, (sum(length) OVER (ORDER BY ep) - length)::BIGINT AS \"offset\" FROM n")
def episode_offsets(spark: SparkSession, d: str) -> DataFrame:
    return Q.offsets(trajectories(spark, d).groupBy("ep").agg(F.count("*").alias("length")), "ep")


_GATHER = f"WITH {TRAJ}, g AS (SELECT event_id, ep, frame, unnest([-2, 0, 3]) AS delta FROM traj), n AS (SELECT ep, max(frame) AS m FROM traj GROUP BY ep) SELECT g.event_id, delta::BIGINT AS delta, {{x}} AS got FROM g JOIN n USING (ep) LEFT JOIN traj t ON t.ep = g.ep AND t.frame = {{at}}"


@query("gather_first_last", _GATHER.replace("{x}", "t.value").replace("{at}", "greatest(0, least(n.m, g.frame + delta))"))
def gather_first_last(spark: SparkSession, d: str) -> DataFrame:
    return Q.gather(trajectories(spark, d), "value", (-2, 0, 3)).select("event_id", "delta", "got")


@query("gather_zero_pad", _GATHER.replace("{x}", "coalesce(t.value, 0)").replace("{at}", "g.frame + delta"))
def gather_zero_pad(spark: SparkSession, d: str) -> DataFrame:
    return Q.gather(trajectories(spark, d), "value", (-2, 0, 3), clamp=False).select("event_id", "delta", "got")


_CHUNK = TRAJ + ", i AS (SELECT event_id, ep, frame, unnest(range(0, 4)) AS i FROM traj), m AS (SELECT ep, max(frame) AS m FROM traj GROUP BY ep), ch AS (SELECT i.event_id, i.i, t.value AS x FROM i JOIN m USING (ep) JOIN traj t ON t.ep = i.ep AND t.frame = least(m.m, i.frame + i.i))"


@query("action_chunk_repeat_last", f"WITH {_CHUNK} SELECT event_id, i, x FROM ch")
def action_chunk_repeat_last(spark: SparkSession, d: str) -> DataFrame:
    return Q.chunk(trajectories(spark, d), "value", 4).select("event_id", F.posexplode("chunk").alias("i", "x")).withColumn("i", F.col("i").cast("long"))


@query("idle_chunk_filter", f"WITH {_CHUNK}, p AS (SELECT event_id, max(abs(round(x / 20) - round(y / 20))) AS d FROM (SELECT event_id, i, x, first(x) OVER (PARTITION BY event_id ORDER BY i) AS y FROM ch WHERE i < 2) GROUP BY event_id) SELECT event_id FROM p WHERE d > 0.001")
def idle_chunk_filter(spark: SparkSession, d: str) -> DataFrame:
    t = trajectories(spark, d).withColumn("value", F.round(F.col("value") / 20))
    return Q.chunk(t, "value", 4).where(Q.moves(F.col("chunk"))).select("event_id")


@query("first_difference", f"WITH {TRAJ} SELECT event_id, round(coalesce(value - lag(value) OVER w, lead(value) OVER w - value, 0), 6) AS delta FROM traj WINDOW w AS (PARTITION BY ep ORDER BY frame)")
def first_difference(spark: SparkSession, d: str) -> DataFrame:
    return trajectories(spark, d).select("event_id", F.round(Q.first_difference("value", Q.ordered()), 6).alias("delta"))


@query("ffill_bfill", f"WITH {TRAJ}, h AS (SELECT event_id, ep, frame, CASE WHEN k % 3 = 0 THEN k END AS x FROM traj) SELECT event_id, coalesce(last_value(x IGNORE NULLS) OVER (PARTITION BY ep ORDER BY frame), first_value(x IGNORE NULLS) OVER (PARTITION BY ep ORDER BY frame ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS x FROM h")
def ffill_bfill(spark: SparkSession, d: str) -> DataFrame:
    return trajectories(spark, d).select("event_id", Q.fill(F.when(F.col("k") % 3 == 0, F.col("k")), Q.ordered()).alias("x"))


@query("runs", f"WITH {_RUN} SELECT event_id, run FROM run")
def runs(spark: SparkSession, d: str) -> DataFrame:
    return Q.runs(trajectories(spark, d), "label").select("event_id", "run")


@query("run_ranges", f"WITH {_RUN} SELECT * FROM rng")
def run_ranges(spark: SparkSession, d: str) -> DataFrame:
    return Q.run_ranges(trajectories(spark, d), "label")


@query("segment_ordinals", f"WITH {TRAJ}, f AS (SELECT *, min(frame) OVER (PARTITION BY ep, label) AS a, max(frame) OVER (PARTITION BY ep, label) AS last FROM traj) SELECT event_id, dense_rank() OVER (PARTITION BY ep ORDER BY a) - 1 AS ordinal, last FROM f")
def segment_ordinals(spark: SparkSession, d: str) -> DataFrame:
    """Ordinal by first frame, and last frame, of each segment id."""
    return Q.first_ordinals(trajectories(spark, d), "label").select("event_id", "ordinal", "last")


@query("long_plan_text", "WITH b AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) IS DISTINCT FROM role AS n FROM conversations), r AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM b WHERE n) SELECT conv_id AS ep, string_agg(i || '. ' || role, chr(10) ORDER BY i) AS plan FROM r GROUP BY conv_id")
def long_plan_text(spark: SparkSession, d: str) -> DataFrame:
    return Q.run_labels(turns(spark, d), "label").select("ep", T.render_plan(F.col("labels")).alias("plan"))


_TOGGLE = TRAJ + ", z AS (SELECT *, min(value) OVER (PARTITION BY ep) AS lo, max(value) OVER (PARTITION BY ep) AS hi FROM traj), s AS (SELECT *, CASE WHEN hi - lo > 1e-6 THEN round_even((value - lo) / (hi - lo), 0) ELSE 0 END::BIGINT AS state FROM z), c AS (SELECT *, CASE WHEN state <> lag(state) OVER (PARTITION BY ep ORDER BY frame) THEN frame END AS ch FROM s), t AS (SELECT *, coalesce(max(ch) OVER (PARTITION BY ep ORDER BY frame), 0) AS toggle FROM c)"


@query("binary_toggle_segments", f"WITH {_TOGGLE} SELECT event_id, state, toggle FROM t")
def binary_toggle_segments(spark: SparkSession, d: str) -> DataFrame:
    return Q.toggles(trajectories(spark, d), "value").select("event_id", "state", "toggle")


@query("edge_events", f"WITH {TRAJ}, z AS (SELECT *, value > (min(value) OVER (PARTITION BY ep) + max(value) OVER (PARTITION BY ep)) / 2 AS up FROM traj), e AS (SELECT ep, frame, up, lag(up) OVER (PARTITION BY ep ORDER BY frame) AS was FROM z) SELECT ep, frame, CASE WHEN up THEN 'rise' ELSE 'fall' END AS kind FROM e WHERE up <> was")
def edge_events(spark: SparkSession, d: str) -> DataFrame:
    return Q.edges(trajectories(spark, d), "value")


@query("combined_segment_id", f"WITH {_TOGGLE} SELECT event_id, (k % 5) * 10000 + (k % 3) * 100 + toggle AS id FROM t")
def combined_segment_id(spark: SparkSession, d: str) -> DataFrame:
    return Q.toggles(trajectories(spark, d), "value").select("event_id", Q.combined_id(F.col("k") % 5, F.col("k") % 3, F.col("toggle")).alias("id"))


@query("noop_filter", f"WITH {TRAJ}, m AS (SELECT *, CASE WHEN value < 30 THEN 0 ELSE value END AS mo, lag(k) OVER w AS pk, lag(frame) OVER w IS NULL OR lead(frame) OVER w IS NULL AS e FROM traj WINDOW w AS (PARTITION BY ep ORDER BY frame)) SELECT event_id, row_number() OVER (PARTITION BY ep ORDER BY frame) - 1 AS kept_frame FROM m WHERE mo > 0.001 OR abs(k - pk) > 20 OR e")
def noop_filter(spark: SparkSession, d: str) -> DataFrame:
    t = trajectories(spark, d).withColumn("mo", F.when(F.col("value") < 30, 0.0).otherwise(F.col("value")))
    return Q.keep_moving(t, "mo", "k", step=20).select("event_id", "kept_frame")


@query("range_sum_move", f"WITH {TRAJ} SELECT event_id, round(sum(value) OVER (PARTITION BY ep ORDER BY frame ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING), 4) AS moved FROM traj")
def range_sum_move(spark: SparkSession, d: str) -> DataFrame:
    return Q.range_sum(trajectories(spark, d), "value", 5).select("event_id", F.round("moved", 4).alias("moved"))


@query("state_delta", f"WITH {VEC}, p AS (SELECT vec_id, v, lead(v) OVER (PARTITION BY ep ORDER BY frame) AS n FROM vec), i AS (SELECT vec_id, v, n, unnest(range(1, 8)) AS i FROM p WHERE n IS NOT NULL) SELECT vec_id, i - 1 AS i, round(CASE WHEN i = 7 THEN 1 - n[i] ELSE n[i] - v[i] END, 6) AS x FROM i")
def state_delta(spark: SparkSession, d: str) -> DataFrame:
    """Difference to the next frame's state, with the gripper inverted."""
    s = states(spark, d).withColumn("n", F.lead("v").over(Q.ordered())).where(F.col("n").isNotNull())
    moved = F.concat(F.zip_with(F.slice("n", 1, 6), F.slice("v", 1, 6), lambda a, b: a - b), F.array(1 - F.element_at("n", 7)))
    return s.select("vec_id", F.posexplode(moved).alias("i", "x")).select("vec_id", F.col("i").cast("long").alias("i"), F.round("x", 6).alias("x"))


@query("horizon_next_and_path", f"WITH {TRAJ}, h AS (SELECT event_id, ep, frame, CASE WHEN k % 4 > 0 THEN k END AS x FROM traj) SELECT event_id, coalesce(lead(x) OVER w, x) AS next, coalesce(list_aggregate(list_filter(list(x) OVER (PARTITION BY ep ORDER BY frame ROWS BETWEEN CURRENT ROW AND 20 FOLLOWING), lambda y: y IS NOT NULL), 'string_agg', ','), '') AS path FROM h WINDOW w AS (PARTITION BY ep ORDER BY frame)")
def horizon_next_and_path(spark: SparkSession, d: str) -> DataFrame:
    t = trajectories(spark, d).withColumn("x", F.when(F.col("k") % 4 > 0, F.col("k")))
    return Q.horizon(t, "x", 21).select("event_id", "next", F.array_join(F.transform("path", lambda x: x.cast("string")), ",").alias("path"))


@query("keyframes_first_mid_last", f"WITH {_RUN} SELECT DISTINCT ep, run, unnest([start, (start + \"end\") // 2, \"end\"]) AS frame FROM rng")
def keyframes_first_mid_last(spark: SparkSession, d: str) -> DataFrame:
    return Q.key_frames(Q.run_ranges(trajectories(spark, d), "label"))


@query("keyframes_linspace", f"WITH {TRAJ}, r AS (SELECT ep, min(frame) AS a, max(frame) AS b FROM traj GROUP BY ep) SELECT DISTINCT ep, 0::BIGINT AS run, trunc(a + unnest(range(0, 5)) * (b - a) / 4)::BIGINT AS frame FROM r")
def keyframes_linspace(spark: SparkSession, d: str) -> DataFrame:
    r = trajectories(spark, d).groupBy("ep").agg(F.min("frame").alias("start"), F.max("frame").alias("end")).withColumn("run", F.lit(0).cast("long"))
    return Q.key_frames(r, "even", k=5)


@query("keyframes_stride", f"WITH {TRAJ}, r AS (SELECT ep, max(frame) AS b FROM traj GROUP BY ep) SELECT ep, 0::BIGINT AS run, unnest(range(0, b + 1, 7)) AS frame FROM r")
def keyframes_stride(spark: SparkSession, d: str) -> DataFrame:
    r = trajectories(spark, d).groupBy("ep").agg(F.min("frame").alias("start"), F.max("frame").alias("end")).withColumn("run", F.lit(0).cast("long"))
    return Q.key_frames(r, "stride", stride=7)


@query("proportional_plan", f"WITH {_RUN}, m AS (SELECT ep, run, count(*) OVER (PARTITION BY ep) AS m FROM rng) SELECT ep, run, ['approach', 'grasp', 'move', 'place'][round_even(run * 3 / greatest(m - 1, 1), 0)::INT + 1] AS step FROM m")
def proportional_plan(spark: SparkSession, d: str) -> DataFrame:
    return Q.spread_plan(Q.run_ranges(trajectories(spark, d), "label"), ("approach", "grasp", "move", "place")).select("ep", "run", "step")


@query("moving_object_order", f"WITH {TRAJ}, v AS (SELECT ep, label, frame, abs(value - lag(value) OVER (PARTITION BY ep, label ORDER BY frame)) AS v FROM traj), c AS (SELECT ep, label, sum(v) AS total, count(*) + 1 AS n, sum(frame * v) / sum(v) AS centre FROM v WHERE v IS NOT NULL GROUP BY ep, label), k AS (SELECT * FROM c WHERE total >= 60 AND n >= 3) SELECT ep, label, row_number() OVER w - 1 AS round, round(centre, 6) AS centre, round((centre + lead(centre) OVER w) / 2, 6) AS until FROM k WINDOW w AS (PARTITION BY ep ORDER BY centre, label)")
def moving_object_order(spark: SparkSession, d: str) -> DataFrame:
    return Q.moving_order(trajectories(spark, d), "value", "label").select("ep", "label", "round", F.round("centre", 6).alias("centre"), F.round("until", 6).alias("until"))


@query("next_frame_samples", f"WITH {TRAJ} SELECT event_id, frame + 1 AS target FROM traj QUALIFY frame < max(frame) OVER (PARTITION BY ep)")
def next_frame_samples(spark: SparkSession, d: str) -> DataFrame:
    return Q.samples(trajectories(spark, d)).select("event_id", "target")


@query("next_segment_samples", f"WITH {_RUN} SELECT ep, run, start, lead(start) OVER (PARTITION BY ep ORDER BY run) AS target FROM rng QUALIFY lead(start) OVER (PARTITION BY ep ORDER BY run) IS NOT NULL")
def next_segment_samples(spark: SparkSession, d: str) -> DataFrame:
    r = Q.run_ranges(trajectories(spark, d), "label")
    return r.withColumn("target", F.lead("start").over(Window.partitionBy("ep").orderBy("run"))).where(F.col("target").isNotNull()).select("ep", "run", "start", "target")


@query("start_mid_end_points", f"WITH {_RUN} SELECT r.ep, r.run, a.k AS a, coalesce(m.k, 0) AS m, b.k AS b FROM rng r JOIN traj a ON a.ep = r.ep AND a.frame = r.start JOIN traj m ON m.ep = r.ep AND m.frame = (r.start + r.\"end\") // 2 JOIN traj b ON b.ep = r.ep AND b.frame = r.\"end\"")
def start_mid_end_points(spark: SparkSession, d: str) -> DataFrame:
    """Values at a run's first, middle and last frame, gathered in one pass over its frames."""
    t = Q.runs(trajectories(spark, d), "label")
    r = t.groupBy("ep", "run").agg(F.array_sort(F.collect_list(F.struct("frame", "k"))).alias("p"), F.min("frame").alias("s"), F.max("frame").alias("e"))
    at = lambda f: F.get(F.col("p"), (f - F.col("s")).cast("int"))["k"]
    return r.select("ep", "run", at(F.col("s")).alias("a"), F.coalesce(at(F.floor((F.col("s") + F.col("e")) / 2)), F.lit(0)).alias("m"), at(F.col("e")).alias("b"))


#: Segment by segment, for each place of the plan the heaviest chain that ends there; then each segment's label from the last of the chain up to it.
_ASCENT = TRAJ + """,
c AS (SELECT ep, frame, label, CASE WHEN label IS DISTINCT FROM lag(label) OVER (PARTITION BY ep ORDER BY frame) THEN 1 ELSE 0 END AS c FROM traj),
r AS (SELECT ep, frame, label, sum(c) OVER (PARTITION BY ep ORDER BY frame)::BIGINT - 1 AS segment FROM c),
seg AS (SELECT ep, segment, min(label) AS label, list_position(['signup', 'view', 'click', 'purchase', 'error'], min(label)) AS p, count(*)::DOUBLE AS weight FROM r GROUP BY ep, segment),
d(ep, i, best) AS (
  SELECT DISTINCT ep, 0::BIGINT, list_transform(range(5), lambda x: {'w': 0.0::DOUBLE, 'e': 1::BIGINT, 'c': []::BIGINT[]}) FROM seg
  UNION ALL
  SELECT d.ep, d.i + 1, list_transform(range(1, 6), lambda q: CASE WHEN q <> s.p THEN d.best[q] ELSE list_max([d.best[q],
    {'w': list_max(d.best[1 : s.p]).w + s.weight, 'e': -s.segment, 'c': list_append(list_max(d.best[1 : s.p]).c, s.segment)}]) END)
  FROM d JOIN seg s ON s.ep = d.ep AND s.segment = d.i),
n AS (SELECT ep, count(*) AS n FROM seg GROUP BY ep),
best AS (SELECT d.ep, list_max(d.best).c AS chain FROM d JOIN n ON n.ep = d.ep AND d.i = n.n),
h AS (SELECT s.ep, s.segment, s.label, coalesce(list_max(list_filter(b.chain, lambda x: x <= s.segment)), b.chain[1]) AS held FROM seg s JOIN best b ON b.ep = s.ep)
SELECT h.ep, h.segment, h.label, o.label AS ordered FROM h JOIN seg o ON o.ep = h.ep AND o.segment = h.held"""


@query("weighted_lnds", f"WITH RECURSIVE {_ASCENT}")
def weighted_lnds(spark: SparkSession, d: str) -> DataFrame:
    """Segment labels of an episode put into the order of its plan."""
    ranges = Q.run_ranges(trajectories(spark, d), "label").select("ep", F.col("run").alias("segment"), "label", F.col("frames").alias("weight"))
    return ordered_labels(ranges, ["signup", "view", "click", "purchase", "error"])


@query("hdbscan_segments")
def hdbscan_segments(spark: SparkSession, d: str) -> DataFrame:
    """Density clusters of each episode's states and times; an algorithm that SQL does not express."""
    return cluster(states(spark, d).select("ep", "frame", F.slice("v", 1, 3).alias("v")), fps=20.0, time_weight=0.05)

"""Queries on dataset checks and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import statistics as S
from ..operators.quantiles import exact_quantiles
from ..sources.tables import states, table, trajectories
from .catalogue import TRAJ, VEC, query


@query("episode_feature_stats", f"WITH {TRAJ} SELECT ep, round(min(value), 6) AS min, round(max(value), 6) AS max, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std, count(*) AS count FROM traj GROUP BY ep")
def episode_feature_stats(spark: SparkSession, d: str) -> DataFrame:
    """Figures of a scalar, taken as a vector of one."""
    s = S.summary(trajectories(spark, d).select("ep", F.array("value").alias("v")), "v", "ep", quantiles=False)
    return s.select("ep", *(F.round(c, 6).alias(c) for c in ("min", "max", "mean", "std")), F.col("n").alias("count"))


@query("dataset_report", f"WITH {TRAJ}, n AS (SELECT ep, count(*) AS n FROM traj GROUP BY ep) SELECT count(*) AS episodes, sum(n)::BIGINT AS frames, round(avg(n), 6) AS mean, round(stddev_pop(n), 6) AS std, min(n) AS least, max(n) AS most, (SELECT count(DISTINCT label) FROM traj) AS labels FROM n")
def dataset_report(spark: SparkSession, d: str) -> DataFrame:
    t = trajectories(spark, d)
    n = t.groupBy("ep").agg(F.count("*").alias("n"))
    report = n.agg(F.count("*").alias("episodes"), F.sum("n").alias("frames"), F.round(F.avg("n"), 6).alias("mean"), F.round(F.stddev_pop("n"), 6).alias("std"), F.min("n").alias("least"), F.max("n").alias("most"))
    return report.crossJoin(F.broadcast(t.agg(F.countDistinct("label").alias("labels"))))  # a row each


@query("layout_min_check", "SELECT n_nationkey, count(s_suppkey) AS demos, count(s_suppkey) >= (SELECT count(*) FROM supplier) // 50 AS enough FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_nationkey")
def layout_min_check(spark: SparkSession, d: str) -> DataFrame:
    """Demonstrations by layout, against half of an even share."""
    s = table(spark, d, "supplier")
    n = table(spark, d, "nation").select("n_nationkey").join(s.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("demos")), "n_nationkey", "left")
    return n.crossJoin(F.broadcast(s.agg(F.count("*").alias("all")))).select("n_nationkey", F.coalesce("demos", F.lit(0)).alias("demos"), (F.coalesce("demos", F.lit(0)) >= F.floor(F.col("all") / 50)).alias("enough"))


@query("group_avg_ignore_missing", "SELECT r_name, round(avg(x), 6) AS rate, floor(avg(x) + 0.5)::BIGINT AS shown, count(*) AS tasks, count(x) AS present FROM (SELECT r_name, avg(CASE WHEN s_acctbal > 5000 THEN 100.0 ELSE 0 END) FILTER (n_nationkey % 4 > 0 AND s_suppkey IS NOT NULL) AS x FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY r_name, n_nationkey) GROUP BY r_name")
def group_avg_ignore_missing(spark: SparkSession, d: str) -> DataFrame:
    """Mean success rate of each group's tasks; missing ones are left out."""
    s = table(spark, d, "supplier").where("s_nationkey % 4 > 0").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.avg(F.when(F.col("s_acctbal") > 5000, 100.0).otherwise(0.0)).alias("x"))
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).join(s, "n_nationkey", "left")
    return n.groupBy("r_name").agg(F.round(F.avg("x"), 6).alias("rate"), S.rounded(F.avg("x")).alias("shown"), F.count("*").alias("tasks"), F.count("x").alias("present"))


@query("metadata_groups", "SELECT label % 3 AS tag, count(DISTINCT label % 3) = 1 AS one_config, count(DISTINCT label) AS datasets, count(*) AS rows FROM embeddings GROUP BY 1")
def metadata_groups(spark: SparkSession, d: str) -> DataFrame:
    """Datasets of a tag must agree in their configuration, compared as JSON."""
    e = table(spark, d, "embeddings").select((F.col("label") % 3).alias("tag"), "label")
    config = F.to_json(F.struct("tag"))
    return e.groupBy("tag").agg((F.countDistinct(config) == 1).alias("one_config"), F.countDistinct("label").alias("datasets"), F.count("*").alias("rows"))


@query("alignment_guard", f"WITH {TRAJ}, a AS (SELECT ep, count(*) AS n FROM traj GROUP BY ep), b AS (SELECT ep, count(*) AS m FROM traj WHERE k < 95 GROUP BY ep) SELECT a.ep, n FROM a JOIN b USING (ep) WHERE n = m")
def alignment_guard(spark: SparkSession, d: str) -> DataFrame:
    """Episodes of which as many frames are annotated as kept."""
    n = trajectories(spark, d).groupBy("ep").agg(F.count("*").alias("n"), F.count_if(F.col("k") < 95).alias("m"))
    return n.where("n = m").select("ep", "n")


@query("group_exclude_flags", "SELECT DISTINCT p_brand FROM part WHERE p_type IN (SELECT DISTINCT p_type FROM part WHERE p_size < 10) AND p_brand NOT IN (SELECT p_brand FROM part GROUP BY p_brand HAVING count(*) FILTER (p_size > 49) > 4)")
def group_exclude_flags(spark: SparkSession, d: str) -> DataFrame:
    """The union of groups without the excluded ones."""
    p = table(spark, d, "part")
    group = p.where("p_size < 10").select("p_type").distinct()
    excluded = p.groupBy("p_brand").agg(F.count_if(F.col("p_size") > 49).alias("n")).where("n > 4")
    return p.join(group, "p_type", "left_semi").select("p_brand").distinct().join(excluded, "p_brand", "left_anti")


@query("taxonomy_overlap", "SELECT p_partkey FROM part WHERE list_has_any(string_split(lower(p_type), ' '), ['steel', 'promo', 'economy']) AND p_size > 10")
def taxonomy_overlap(spark: SparkSession, d: str) -> DataFrame:
    types = F.array(*map(F.lit, ("steel", "promo", "economy")))
    return table(spark, d, "part").where(F.arrays_overlap(F.split(F.lower("p_type"), " "), types) & (F.col("p_size") > 10)).select("p_partkey")


@query("success_filter", "SELECT event_id FROM events WHERE regexp_full_match('/run/' || event_type || '/x', '.*(purchase|signup).*')")
def success_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").where(F.concat(F.lit("/run/"), F.col("event_type"), F.lit("/x")).rlike("^.*(purchase|signup).*$")).select("event_id")


@query("timing_quantiles", "SELECT event_type, round(avg(value), 6) AS mean, round(min(value), 6) AS least, round(quantile_cont(value, 0.25), 6) AS p25, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.75), 6) AS p75, round(max(value), 6) AS most FROM events GROUP BY event_type")
def timing_quantiles(spark: SparkSession, d: str) -> DataFrame:
    """Quantiles by selection: a kind of event of any size is counted in bins, not gathered."""
    events = table(spark, d, "events").select("event_type", "value")
    figures = events.groupBy("event_type").agg(F.round(F.avg("value"), 6).alias("mean"), F.round(F.min("value"), 6).alias("least"), F.round(F.max("value"), 6).alias("most"))
    found = exact_quantiles(events, "value", (0.25, 0.5, 0.75), "event_type")
    found = found.select(F.col("event_type").alias("kind"), *(F.round(f"q{p}", 6).alias(f"p{p}") for p in (25, 50, 75)))
    return figures.join(found, F.col("event_type").eqNullSafe(F.col("kind")), "left").drop("kind")


@query("frames_per_segment", f"WITH {TRAJ} SELECT ep, label, greatest(1, count(*)) AS weight FROM traj GROUP BY ep, label")
def frames_per_segment(spark: SparkSession, d: str) -> DataFrame:
    return trajectories(spark, d).groupBy("ep", "label").agg(F.greatest(F.lit(1), F.count("*")).cast("long").alias("weight"))


@query("grouped_samples", f"WITH {TRAJ} SELECT ep, string_agg(k::VARCHAR, ',' ORDER BY frame) AS ks FROM traj GROUP BY ep")
def grouped_samples(spark: SparkSession, d: str) -> DataFrame:
    """Samples of an episode, gathered and sorted by frame."""
    listed = F.array_sort(F.collect_list(F.struct("frame", "k")))
    return trajectories(spark, d).groupBy("ep").agg(F.array_join(F.transform(listed, lambda x: x["k"].cast("string")), ",").alias("ks"))


@query("chunk_size_stats", f"WITH {VEC} SELECT ep, max(len(v))::BIGINT AS dims, count(*) AS n, count(*) FILTER (len(v) <> 64) AS bad FROM vec GROUP BY ep")
def chunk_size_stats(spark: SparkSession, d: str) -> DataFrame:
    """A vector's length is a fact of the schema: checked, not assumed."""
    return states(spark, d).groupBy("ep").agg(F.max(F.size("v")).cast("long").alias("dims"), F.count("*").alias("n"), F.count_if(F.size("v") != 64).alias("bad"))


@query("latest_task_stats", "SELECT o_custkey % 7 AS task, CASE WHEN o_orderkey % 2 = 0 THEN 'even' ELSE 'odd' END AS split, arg_max(o_orderkey, o_orderkey) AS run FROM orders GROUP BY 1, 2")
def latest_task_stats(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select((F.col("o_custkey") % 7).alias("task"), F.when(F.col("o_orderkey") % 2 == 0, "even").otherwise("odd").alias("split"), "o_orderkey")
    return o.groupBy("task", "split").agg(F.max_by("o_orderkey", "o_orderkey").alias("run"))


@query("pivot_rates", "SELECT event_type, round(avg(value) FILTER (user_id % 3 = 0), 6) AS s0, round(avg(value) FILTER (user_id % 3 = 1), 6) AS s1, round(avg(value) FILTER (user_id % 3 = 2), 6) AS s2 FROM events GROUP BY event_type")
def pivot_rates(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("s", F.concat(F.lit("s"), (F.col("user_id") % 3).cast("string")))
    return e.groupBy("event_type").pivot("s", ["s0", "s1", "s2"]).agg(F.round(F.avg("value"), 6))


@query("last_state_dropped", f"WITH {TRAJ} SELECT ep, count(*) - 1 AS n FROM traj GROUP BY ep")
def last_state_dropped(spark: SparkSession, d: str) -> DataFrame:
    """Every episode without its last state."""
    t = trajectories(spark, d).withColumn("next", F.lead("frame").over(Window.partitionBy("ep").orderBy("frame")))
    return t.where(F.col("next").isNotNull()).groupBy("ep").agg(F.count("*").alias("n"))

"""Queries on subsets, shards, weights and sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import texts as T
from ..operators import selection as C
from ..operators import statistics as S
from ..operators.order import permuted_sql
from ..sources.tables import table, trajectories
from .catalogue import TRAJ, query


@query("hash_subset_n", "SELECT doc_id FROM documents ORDER BY md5('42|' || doc_id), doc_id LIMIT 100")
def hash_subset_n(spark: SparkSession, d: str) -> DataFrame:
    """A seeded subset of 100: sampling is the operator."""
    return C.subset(table(spark, d, "documents").select("doc_id"), "doc_id", 100, 42)


@query("independent_subsets", "SELECT n AS size, o_custkey FROM (SELECT n, o_custkey, row_number() OVER (PARTITION BY n ORDER BY md5(n || '|' || o_custkey), o_custkey) AS r FROM (SELECT DISTINCT o_custkey FROM orders), (SELECT unnest([10, 50, 100]::BIGINT[]) AS n)) WHERE r <= n")
def independent_subsets(spark: SparkSession, d: str) -> DataFrame:
    return C.subsets(spark, table(spark, d, "orders").select("o_custkey").distinct(), "o_custkey", (10, 50, 100))


_EPS = "e AS (SELECT DISTINCT user_id AS ep FROM events), p AS (SELECT ep, row_number() OVER (ORDER BY ep) - 1 AS p, count(*) OVER () AS n FROM e)"


@query("seeded_prefix", f"WITH {_EPS}, x AS (SELECT ep, {permuted_sql('p', 'n', 0)} AS x FROM p) SELECT user_id AS ep, count(*) AS n FROM events WHERE user_id IN (SELECT ep FROM x WHERE x < 30) GROUP BY 1")
def seeded_prefix(spark: SparkSession, d: str) -> DataFrame:
    """30 episodes by a seeded permutation: sampling is the operator."""
    return C.shuffled_prefix(trajectories(spark, d), "ep", 30, 0).groupBy("ep").agg(F.count("*").alias("n"))



@query("contiguous_shards", f"WITH {_EPS} SELECT ep, floor(p / ceil(n / 7))::BIGINT AS shard FROM p")
def contiguous_shards(spark: SparkSession, d: str) -> DataFrame:
    return C.shard(trajectories(spark, d).select("ep").distinct(), "ep", 7)


@query("modulo_shards", f"WITH {_EPS} SELECT ep, p % 7 AS shard FROM p")
def modulo_shards(spark: SparkSession, d: str) -> DataFrame:
    return C.shard(trajectories(spark, d).select("ep").distinct(), "ep", 7, contiguous=False)


@query("shuffled_batches", "SELECT event_id, (p // 16)::BIGINT AS batch FROM (SELECT event_id, row_number() OVER (ORDER BY md5('7|' || event_id), event_id) - 1 AS p, count(*) OVER () AS n FROM events) WHERE p < n // 16 * 16")
def shuffled_batches(spark: SparkSession, d: str) -> DataFrame:
    """Batches of 16 in a seeded order."""
    return C.batches(table(spark, d, "events").select("event_id"), "event_id", 16, 7)


@query("random_choice", "SELECT event_id, ['first', 'second', 'third'][floor(('0x' || substr(sha256('5|' || event_id), 1, 13))::BIGINT / 4503599627370496.0 * 3)::INT + 1] AS choice FROM events")
def random_choice(spark: SparkSession, d: str) -> DataFrame:
    u = T.uniform(F.concat_ws("|", F.lit("5"), F.col("event_id").cast("string")))
    return table(spark, d, "events").select("event_id", F.element_at(F.array(F.lit("first"), F.lit("second"), F.lit("third")), F.floor(u * 3).cast("int") + 1).alias("choice"))


_PLACE = "('0x' || substr(sha256('13|{}|' || event_id), 1, 13))::BIGINT / 4503599627370496.0"


@query("registry_choice", f"WITH u AS (SELECT event_id, {_PLACE.format('registry')} AS r, {_PLACE.format('item')} AS i FROM events) SELECT event_id, CASE WHEN r < 0.5 THEN 'cups' WHEN r < 0.75 THEN 'pans' ELSE 'jars' END AS registry, CASE WHEN r < 0.5 THEN ['mug', 'glass', 'bowl'][floor(i * 3)::INT + 1] WHEN r < 0.75 THEN ['wok'][1] ELSE ['small', 'large'][floor(i * 2)::INT + 1] END AS item FROM u")
def registry_choice(spark: SparkSession, d: str) -> DataFrame:
    """Two levels: a registry by weight (one has none), then an item of it."""
    registry, item = C.registry_choice(F.col("event_id"), {"cups": (2.0, ["mug", "glass", "bowl"]), "none": (0.0, ["x"]), "pans": (1.0, ["wok"]), "jars": (1.0, ["small", "large"])}, 13)
    return table(spark, d, "events").select("event_id", registry.alias("registry"), item.alias("item"))


_DRAW = "('0x' || substr(sha256('11|{}|' || i), 1, 13))::BIGINT / 4503599627370496.0"


@query(
    "mixture_sample",
    f"""WITH e AS (SELECT o_custkey % 5 AS dataset, o_custkey AS episode, count(*) AS length FROM orders GROUP BY 1, 2),
    w AS (SELECT * FROM (VALUES (0, 1.0::DOUBLE), (1, 0.5::DOUBLE), (3, 2.0::DOUBLE), (4, 0.25::DOUBLE)) AS t(dataset, weight)),
    r AS (SELECT dataset, sum(weight) OVER (ORDER BY dataset) / sum(weight) OVER () AS high FROM w),
    q AS (SELECT i, {_DRAW.format("dataset")} AS ud, {_DRAW.format("episode")} AS ue, {_DRAW.format("step")} AS us FROM range(2000) AS t(i)),
    c AS (SELECT i, ue, us, (SELECT min(dataset) FROM r WHERE high > ud) AS dataset FROM q),
    h AS (SELECT dataset, episode, length, (sum(length) OVER k)::DOUBLE / (sum(length) OVER (PARTITION BY dataset))::DOUBLE AS high FROM e WINDOW k AS (PARTITION BY dataset ORDER BY episode)),
    g AS (SELECT *, coalesce(lag(high) OVER (PARTITION BY dataset ORDER BY episode), 0.0) AS low FROM h)
    SELECT i AS index, c.dataset::BIGINT AS dataset, episode, floor(us * length)::BIGINT AS step FROM c JOIN g ON c.dataset = g.dataset AND ue >= low AND ue < high""",
)
def mixture_sample(spark: SparkSession, d: str) -> DataFrame:
    """2,000 draws: a dataset by weight, an episode by length, a step; the draws' number is the operator's parameter."""
    t = table(spark, d, "orders").select((F.col("o_custkey") % 5).alias("dataset"), F.col("o_custkey").alias("episode"))
    episodes = t.groupBy("dataset", "episode").agg(F.count("*").alias("length"))
    datasets = spark.createDataFrame([(0, 1.0), (1, 0.5), (2, 0.0), (3, 2.0), (4, 0.25)], "dataset long, weight double")
    return C.mixture(spark.range(2000).withColumnRenamed("id", "index"), datasets, episodes, 11)


_LEN = TRAJ + ", n AS (SELECT ep % 10 AS ds, count(*) AS n FROM traj GROUP BY 1)"


def _lengths(spark: SparkSession, d: str) -> DataFrame:
    return trajectories(spark, d).groupBy((F.col("ep") % 10).alias("ds")).agg(F.count("*").alias("n"))


@query("alpha_weights", f"WITH {_LEN} SELECT ds, round(pow(n, 0.4) / first(pow(n, 0.4)) OVER (ORDER BY ds), 6) AS weight, round(pow(n, 0.4) / sum(pow(n, 0.4)) OVER (), 6) AS share FROM n")
def alpha_weights(spark: SparkSession, d: str) -> DataFrame:
    n = _lengths(spark, d).withColumn("w", F.pow("n", F.lit(0.4)))
    one = Window.partitionBy(F.lit(1))
    return n.select("ds", F.round(F.col("w") / F.first("w").over(one.orderBy("ds")), 6).alias("weight"), F.round(F.col("w") / F.sum("w").over(one), 6).alias("share"))


@query("balanced_weights", f"WITH {_LEN}, w AS (SELECT ds, n, CASE WHEN ds % 3 = 0 THEN 1.0::DOUBLE WHEN ds % 3 = 1 THEN 0.5 ELSE 0 END AS w FROM n) SELECT ds, round(w * n / sum(w * n) OVER (), 6) AS p FROM w")
def balanced_weights(spark: SparkSession, d: str) -> DataFrame:
    """Weights by length, in proportion to their sum; one at least must be 1."""
    w = _lengths(spark, d).withColumn("w", F.when(F.col("ds") % 3 == 0, 1.0).when(F.col("ds") % 3 == 1, 0.5).otherwise(0.0))
    C.must_be_empty(w.agg(F.max("w").alias("m")).where("m <> 1.0"), "no weight is 1")
    return w.select("ds", F.round(F.col("w") * F.col("n") / F.sum(F.col("w") * F.col("n")).over(Window.partitionBy(F.lit(1))), 6).alias("p"))


@query("first_weight_is_one", f"WITH {_LEN}, w AS (SELECT ds, (n % 7)::DOUBLE AS w, first((n % 7)::DOUBLE) OVER (ORDER BY ds) AS f FROM n) SELECT ds, round(w / nullif(f, 0), 6) AS weight FROM w WHERE w <> 0")
def first_weight_is_one(spark: SparkSession, d: str) -> DataFrame:
    w = _lengths(spark, d).select("ds", (F.col("n") % 7).cast("double").alias("w"))
    return S.first_is_one(w, "w", "ds").select("ds", F.round("weight", 6).alias("weight"))


@query("class_weights", "WITH d AS (SELECT n_nationkey AS k, CASE WHEN n_regionkey = 0 THEN 'real' WHEN n_regionkey < 3 THEN 'cousin' ELSE 'sim' END AS kind FROM nation), w AS (SELECT k, kind, CASE kind WHEN 'real' THEN 0.5 WHEN 'cousin' THEN 0.3 ELSE 0.2 END::DOUBLE / count(*) OVER (PARTITION BY kind) AS w FROM d) SELECT k, kind, round(w / first(w) OVER (ORDER BY k), 6) AS weight FROM w")
def class_weights(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("n_regionkey") == 0, "real").when(F.col("n_regionkey") < 3, "cousin").otherwise("sim")
    ds = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), kind.alias("kind"))
    return C.class_weights(ds, "kind", "k", {"real": 0.5, "cousin": 0.3, "sim": 0.2}).withColumn("weight", F.round("weight", 6))


_APPORTION = "WITH w AS (SELECT o_custkey % 9 AS ds, count(*)::DOUBLE AS w FROM orders GROUP BY 1), s AS (SELECT *, greatest(1, round_even({t} * w / sum(w) OVER (), 0))::BIGINT AS s FROM w), d AS (SELECT *, {t} - sum(s) OVER () AS d, count(*) OVER () AS k, row_number() OVER (ORDER BY w DESC, ds) AS hi, row_number() OVER (ORDER BY w, ds) AS lo FROM s) SELECT ds, (s + sign(d) * greatest(0, floor((abs(d) - CASE WHEN d < 0 THEN hi ELSE lo END) / k) + 1))::BIGINT AS share FROM d"


@query("apportion_epoch", _APPORTION.replace("{t}", "1000"))
def apportion_epoch(spark: SparkSession, d: str) -> DataFrame:
    w = table(spark, d, "orders").groupBy((F.col("o_custkey") % 9).alias("ds")).agg(F.count("*").cast("double").alias("w"))
    return S.apportion(w, "w", 1000, "ds").select("ds", "share")


@query("mixture_length", f"WITH {_LEN}, w AS (SELECT n, CASE WHEN ds % 3 = 0 THEN 1.0 ELSE 0.5 END::DOUBLE AS w, n::DOUBLE / sum(n) OVER () AS p FROM n) SELECT trunc(max(n / p) FILTER (w = 1.0))::BIGINT AS epoch FROM w")
def mixture_length(spark: SparkSession, d: str) -> DataFrame:
    """The epoch is as long as the largest primary dataset's length over its share."""
    n = _lengths(spark, d).withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))))
    return n.where("ds % 3 = 0").agg(F.max(F.col("n") / F.col("p")).cast("long").alias("epoch"))


@query("cycled_indices", f"WITH {_LEN}, s AS (SELECT ds, n, unnest(range(0, 1200)) AS i FROM n) SELECT ds, i, i % n AS row FROM s")
def cycled_indices(spark: SparkSession, d: str) -> DataFrame:
    """A share of 1,200 rows of each dataset, over again where it has fewer."""
    return _lengths(spark, d).select("ds", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(1199).cast("long"))).alias("i")).select("ds", "i", (F.col("i") % F.col("n")).alias("row"))


@query("global_index_lookup", f"WITH {TRAJ}, n AS (SELECT ep, count(*) AS n FROM traj GROUP BY ep), o AS (SELECT ep, n, (sum(n) OVER (ORDER BY ep) - n)::BIGINT AS o FROM n), t AS (SELECT sum(n)::BIGINT AS t FROM n), i AS (SELECT unnest(range(0, 2 * t)) AS i FROM t) SELECT i, ep, (i % t) - o AS frame FROM i, t JOIN o ON i % t >= o AND i % t < o + n")
def global_index_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Every global index and, past the end, every one again: indices and the episodes that hold them meet in bins."""
    from ..operators.sequences import offsets

    width = 1024
    lengths = offsets(trajectories(spark, d).groupBy("ep").agg(F.count("*").alias("length")), "ep")
    total = lengths.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    points = spark.range(0, 2 * total).select(F.col("id").alias("i"), (F.col("id") % max(total, 1)).alias("x")).withColumn("bin", F.floor(F.col("x") / width))
    end = F.col("offset") + F.col("length")
    held = lengths.withColumn("bin", F.explode(F.sequence(F.floor(F.col("offset") / width), F.floor((end - 1) / width))))
    return points.join(held, "bin").where((F.col("x") >= F.col("offset")) & (F.col("x") < end)).select("i", "ep", (F.col("x") - F.col("offset")).alias("frame"))


@query("demo_fraction", "SELECT n_nationkey, trunc([100, 500, 30, 50, 5000][n_regionkey + 1] * 0.33::DOUBLE)::BIGINT AS demos FROM nation")
def demo_fraction(spark: SparkSession, d: str) -> DataFrame:
    # fixed values: demonstrations of each source
    totals = F.array(*map(F.lit, (100, 500, 30, 50, 5000)))
    return table(spark, d, "nation").select("n_nationkey", (F.element_at(totals, F.col("n_regionkey") + 1) * F.lit(0.33)).cast("long").alias("demos"))


@query("seed_hashes", "SELECT event_id, ('0x' || substr(md5('a/' || event_id), 1, 8))::BIGINT AS id, substr(sha256('(0, ' || event_id || ', 42)'), 33, 32) AS seed FROM events")
def seed_hashes(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("event_id").cast("string")
    return table(spark, d, "events").select("event_id", T.short_hash(F.concat(F.lit("a/"), key)).alias("id"), T.seed_hash(F.concat(F.lit("(0, "), key, F.lit(", 42)"))).alias("seed"))


@query("instance_split", "SELECT p_partkey, CASE WHEN row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) <= greatest(count(*) OVER (PARTITION BY p_brand) - 5, ceil(count(*) OVER (PARTITION BY p_brand) / 2)) THEN 'train' ELSE 'test' END AS split FROM part")
def instance_split(spark: SparkSession, d: str) -> DataFrame:
    return C.instance_split(table(spark, d, "part").select("p_partkey", "p_brand"), "p_brand", "p_partkey").select("p_partkey", "split")



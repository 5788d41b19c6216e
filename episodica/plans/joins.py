"""Queries on joins, matches, orders and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import texts as T
from ..operators import matching as M
from ..operators import selection as C
from ..operators import statistics as S
from ..operators.order import running
from ..sources.tables import table, trajectories, vectors
from .catalogue import TRAJ, VEC, query


@query("left_merge_coalesce", f"WITH {TRAJ} SELECT t.event_id, coalesce(g.x, t.label) AS label, g.box FROM traj t LEFT JOIN (SELECT ep, frame, 'seen' AS x, k AS box FROM traj WHERE k % 3 = 0) g ON g.ep = t.ep AND g.frame = t.frame")
def left_merge_coalesce(spark: SparkSession, d: str) -> DataFrame:
    t = trajectories(spark, d)
    extra = t.where("k % 3 = 0").select("ep", "frame", F.lit("seen").alias("label"), F.col("k").alias("box"))
    return M.left_merge(t.select("event_id", "ep", "frame", "label"), extra, ["ep", "frame"], ["label", "box"]).select("event_id", "label", "box")


@query("positional_merge", "SELECT d.doc_id, b.item_id, b.n FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS p FROM documents) d JOIN (SELECT item_id, length(text) AS n, row_number() OVER (ORDER BY item_id) AS p FROM benchmark) b USING (p)")
def positional_merge(spark: SparkSession, d: str) -> DataFrame:
    """Two sequences by position, as long as the shorter one; either is numbered in ranges."""
    items = table(spark, d, "benchmark").select("item_id", F.length("text").cast("long").alias("n"))
    docs = table(spark, d, "documents").select("doc_id")
    return running(docs, "doc_id").join(running(items, "item_id"), "place").select("doc_id", "item_id", "n")


@query("status_rollup", "SELECT CASE WHEN l.doc_id IS NULL THEN 'label missing' WHEN d.n_chars < 100 THEN 'short' ELSE 'ok' END AS status, count(*) AS n FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1")
def status_rollup(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels").select("doc_id", F.lit(True).alias("there"))
    both = table(spark, d, "documents").select("doc_id", "n_chars").join(labels, "doc_id", "left")
    return both.groupBy(M.status({"label": F.coalesce("there", F.lit(False))}, F.col("n_chars") >= 100, "short").alias("status")).agg(F.count("*").alias("n"))


@query("multi_way_alignment", f"WITH {TRAJ} SELECT t.ep, t.frame, t.label, coalesce(c.role, 'unknown') AS role FROM traj t JOIN (SELECT ep, count(*) AS m FROM traj GROUP BY ep) z ON z.ep = t.ep JOIN (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id) y ON y.conv_id = t.ep LEFT JOIN conversations c ON c.conv_id = t.ep AND c.turn = t.frame WHERE t.frame < least(z.m, y.n)")
def multi_way_alignment(spark: SparkSession, d: str) -> DataFrame:
    """Frames up to the least length of the aligned sequences themselves; one that is absent has length 0."""
    t = trajectories(spark, d)
    roles = table(spark, d, "conversations").select(F.col("conv_id").alias("ep"), F.col("turn").alias("frame"), "role")
    sizes = t.groupBy("ep").agg(F.count("*").alias("m")).join(roles.groupBy("ep").agg(F.count("*").alias("n")), "ep")
    kept = t.join(sizes, "ep").where(F.col("frame") < F.least("m", "n"))
    return kept.join(roles, ["ep", "frame"], "left").select("ep", "frame", "label", F.coalesce("role", F.lit("unknown")).alias("role"))


@query("registry_lookup", "SELECT p_partkey, p_brand, CASE WHEN p_brand IN ('Brand#11', 'Brand#12') THEN 'atomic' WHEN p_brand LIKE 'Brand#2%' THEN 'composite' END AS kind, CASE WHEN p_brand IN ('Brand#11', 'Brand#12') THEN 100 WHEN p_brand LIKE 'Brand#2%' THEN 500 END::BIGINT AS demos FROM part")
def registry_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A keyed lookup over two registries, the first before the second; null where neither has the key."""
    brands = table(spark, d, "part").select("p_brand").distinct()
    first = brands.where(F.col("p_brand").isin("Brand#11", "Brand#12")).select("p_brand", F.lit("atomic").alias("kind"), F.lit(100).cast("long").alias("demos"))
    second = brands.where(F.col("p_brand").like("Brand#2%")).select("p_brand", F.lit("composite").alias("kind"), F.lit(500).cast("long").alias("demos"))
    return table(spark, d, "part").select("p_partkey", "p_brand").join(first.unionByName(second.join(first, "p_brand", "left_anti")), "p_brand", "left")


@query("soup_union", "SELECT s_suppkey, n_name, r_name, 'human' AS source FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE') UNION ALL SELECT s_suppkey, n_name, r_name, 'mg' FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'AMERICA')")
def soup_union(spark: SparkSession, d: str) -> DataFrame:
    """Task sets by sources, looked up in the registry; duplicates stay."""
    reg = table(spark, d, "supplier").join(table(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    soup = spark.createDataFrame([("human", "ASIA"), ("human", "EUROPE"), ("mg", "ASIA"), ("mg", "AMERICA"), ("mg", "NOWHERE")], "source string, r_name string")
    return reg.join(F.broadcast(soup), "r_name").select("s_suppkey", "n_name", "r_name", "source")  # five rows


@query("subset_semi_join", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def subset_semi_join(spark: SparkSession, d: str) -> DataFrame:
    chosen = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, d, "orders").join(chosen, "o_custkey", "left_semi").select("o_orderkey")


@query("cross_source_missing", "SELECT n_name, s AS source FROM nation, unnest(['a', 'b', 'c']) AS t(s) WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_nationkey = n_nationkey AND s_suppkey % 3 = CASE s WHEN 'a' THEN 0 WHEN 'b' THEN 1 ELSE 2 END AND s_acctbal > 5000)")
def cross_source_missing(spark: SparkSession, d: str) -> DataFrame:
    """Every task by every source, without those that exist."""
    sources = F.explode(F.array(F.lit("a"), F.lit("b"), F.lit("c")))
    every = table(spark, d, "nation").select("n_nationkey", "n_name", sources.alias("source"))
    have = table(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("n_nationkey"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("s_suppkey") % 3 + 1).cast("int")).alias("source"))
    return every.join(have, ["n_nationkey", "source"], "left_anti").select("n_name", "source")


@query("source_episode_numbers", "SELECT s_suppkey, row_number() OVER (ORDER BY s_acctbal < 0, s_suppkey) - 1 AS episode FROM supplier")
def source_episode_numbers(spark: SparkSession, d: str) -> DataFrame:
    """One running number over the first source and then the second; datasets, not frames."""
    s = table(spark, d, "supplier")
    both = s.where("s_acctbal >= 0").select("s_suppkey", F.lit(0).alias("tier")).unionByName(s.where("NOT s_acctbal >= 0").select("s_suppkey", F.lit(1).alias("tier")))
    return running(both, "tier", "s_suppkey", name="episode").select("s_suppkey", F.col("episode").cast("long").alias("episode"))


@query("tolerance_match", "WITH q AS (SELECT c_custkey, c_nationkey, c_acctbal FROM customer WHERE c_custkey % 2 = 0), r AS (SELECT c_custkey AS demo, c_nationkey, c_acctbal AS y FROM customer WHERE c_custkey % 2 = 1), c AS (SELECT q.c_custkey, min(r.demo) AS demo FROM q JOIN r ON q.c_nationkey = r.c_nationkey AND abs(q.c_acctbal - r.y) <= 100 GROUP BY 1), e AS (SELECT c_nationkey, min(demo) AS demo FROM r GROUP BY 1) SELECT q.c_custkey, coalesce(c.demo, e.demo) AS demo, c.demo IS NOT NULL AS close FROM q LEFT JOIN c USING (c_custkey) LEFT JOIN e USING (c_nationkey)")
def tolerance_match(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    right = c.where("c_custkey % 2 = 1").withColumnRenamed("c_custkey", "demo")
    return M.tolerance(c.where("c_custkey % 2 = 0"), right, "c_custkey", "demo", "c_nationkey", "c_acctbal", 100.0)


#: How far vectors may be apart in each of their first six dimensions.
BOUNDS = (0.1, 0.1, 0.1, 0.2, 0.2, 0.3)


@query("tolerance_match_vectors", f"WITH {VEC}, q AS (SELECT * FROM vec WHERE vec_id % 2 = 0), r AS (SELECT * FROM vec WHERE vec_id % 2 = 1), c AS (SELECT q.vec_id, min(r.vec_id) AS demo FROM q JOIN r ON q.ep = r.ep AND abs(q.v[1] - r.v[1]) <= 0.1::DOUBLE AND abs(q.v[2] - r.v[2]) <= 0.1::DOUBLE AND abs(q.v[3] - r.v[3]) <= 0.1::DOUBLE AND abs(q.v[4] - r.v[4]) <= 0.2::DOUBLE AND abs(q.v[5] - r.v[5]) <= 0.2::DOUBLE AND abs(q.v[6] - r.v[6]) <= 0.3::DOUBLE GROUP BY 1), e AS (SELECT ep, min(vec_id) AS demo FROM r GROUP BY ep) SELECT q.vec_id, coalesce(c.demo, e.demo) AS demo, c.demo IS NOT NULL AS close FROM q LEFT JOIN c USING (vec_id) LEFT JOIN e USING (ep)")
def tolerance_match_vectors(spark: SparkSession, d: str) -> DataFrame:
    v = vectors(spark, d).select("vec_id", "ep", "v")
    right = v.where("vec_id % 2 = 1").withColumnRenamed("vec_id", "demo")
    return M.tolerance_vectors(v.where("vec_id % 2 = 0"), right, "vec_id", "demo", "ep", "v", BOUNDS)


@query("interval_join_rounds", f"WITH {TRAJ}, r AS (SELECT ep, frame AS start, row_number() OVER (PARTITION BY ep ORDER BY frame) - 1 AS round FROM traj WHERE label = 'purchase') SELECT t.event_id, max(r.round) AS round FROM traj t LEFT JOIN r ON r.ep = t.ep AND r.start <= t.frame GROUP BY t.event_id")
def interval_join_rounds(spark: SparkSession, d: str) -> DataFrame:
    t = trajectories(spark, d).select("ep", "frame", "label", "event_id")
    rounds = t.where("label = 'purchase'").select("ep", F.col("frame").alias("start"), (F.row_number().over(Window.partitionBy("ep").orderBy("frame")) - 1).cast("long").alias("round"))
    return M.intervals(t, rounds, "ep", "frame", "start", "round").select("event_id", "round")


@query("nearest_time_match", f"WITH {TRAJ}, r AS (SELECT ep, frame, value FROM traj WHERE label = 'purchase'), p AS (SELECT t.event_id, r.frame, r.value, row_number() OVER (PARTITION BY t.event_id ORDER BY abs(t.frame - r.frame), r.frame) AS n FROM traj t JOIN r ON r.ep = t.ep WHERE t.label = 'click') SELECT t.event_id, p.frame AS matched_frame, p.value AS matched_value FROM traj t LEFT JOIN p ON p.event_id = t.event_id AND p.n = 1 WHERE t.label = 'click'")
def nearest_time_match(spark: SparkSession, d: str) -> DataFrame:
    t = trajectories(spark, d)
    return M.nearest(t.where("label = 'click'").select("ep", "frame", "event_id"), t.where("label = 'purchase'").select("ep", "frame", "value"), "ep", "frame", "value").select("event_id", "matched_frame", "matched_value")


@query("nearest_object", "WITH o AS (SELECT p_partkey, p_size AS x, p_size % 7 AS y FROM part), q AS (SELECT s_suppkey, (s_suppkey * 7 % 50) AS x, s_suppkey % 7 AS y FROM supplier), c AS (SELECT q.s_suppkey, o.p_partkey, abs(q.x - o.x) <= 8 AND abs(q.y - o.y) <= 8 AS inside, abs(q.x - o.x) + abs(q.y - o.y) AS far FROM q, o) SELECT s_suppkey, coalesce(min(p_partkey) FILTER (inside), arg_min(p_partkey, (far, p_partkey))) AS p_partkey FROM c GROUP BY s_suppkey")
def nearest_object(spark: SparkSession, d: str) -> DataFrame:
    """The first object whose box, 8 pixels wider, holds a point; else the nearest. Places of points meet places of objects, each with its least key, so pairs are bounded by the pixels."""
    o = table(spark, d, "part").groupBy(F.col("p_size").alias("ox"), (F.col("p_size") % 7).alias("oy")).agg(F.min("p_partkey").alias("p"))
    q = table(spark, d, "supplier").select("s_suppkey", (F.col("s_suppkey") * 7 % 50).alias("x"), (F.col("s_suppkey") % 7).alias("y"))
    dx, dy = F.abs(F.col("x") - F.col("ox")), F.abs(F.col("y") - F.col("oy"))
    met = q.select("x", "y").distinct().crossJoin(o)
    met = met.groupBy("x", "y").agg(F.coalesce(F.min(F.when((dx <= 8) & (dy <= 8), F.col("p"))), F.min(F.struct((dx + dy).alias("far"), "p"))["p"]).alias("p_partkey"))
    return q.join(met, ["x", "y"]).select("s_suppkey", "p_partkey")


@query("suffix_match", "WITH r AS (SELECT n_nationkey, lower(n_name) AS e FROM nation), l AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN lower(n_name) ELSE 'from ' || lower(n_name) END AS t FROM supplier JOIN nation ON s_nationkey = n_nationkey) SELECT s_suppkey, n_nationkey, exact FROM (SELECT l.s_suppkey, r.n_nationkey, l.t = r.e AS exact, row_number() OVER (PARTITION BY l.s_suppkey ORDER BY l.t <> r.e, r.n_nationkey) AS n FROM l JOIN r ON ends_with(l.t, r.e)) WHERE n = 1")
def suffix_match(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "nation").select("n_nationkey", F.lower("n_name").alias("e"))
    left = table(spark, d, "supplier").join(names, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.when(F.col("s_suppkey") % 3 == 0, F.col("e")).otherwise(F.concat(F.lit("from "), F.col("e"))).alias("t"))
    return M.suffix(left, names, "t", "e", "n_nationkey").select("s_suppkey", "n_nationkey", "exact")


_TOK = "tok AS (SELECT item_id AS id, unnest(list_distinct(list_filter(regexp_extract_all(lower(text), '[a-z]+'), lambda w: NOT list_contains(['a','an','the','of','to','in','on','and','it','is','from','with','by','for'], w)))) AS token FROM benchmark)"


@query("document_frequency", f"WITH {_TOK}, n AS (SELECT count(*) AS n FROM benchmark) SELECT token, count(*) AS df, round(ln(any_value(n) / (1 + count(*))) + 1, 6) AS idf FROM tok, n GROUP BY token")
def document_frequency(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "benchmark").select("item_id", T.tokens(F.col("text")).alias("t"))
    return S.inverse_document_frequency(items, "item_id", "t").withColumn("idf", F.round("idf", 6))


@query("idf_jaccard_match", f"WITH {_TOK}, n AS (SELECT count(*) AS n FROM benchmark), i AS (SELECT token, ln(any_value(n) / (1 + count(*))) + 1 AS idf FROM tok, n GROUP BY token), w AS (SELECT id, token, idf FROM tok JOIN i USING (token)), s AS (SELECT id, sum(idf) AS s FROM w GROUP BY id), b AS (SELECT a.id AS left_id, c.id AS right_id, sum(a.idf) AS b FROM w a JOIN w c USING (token) WHERE a.id % 2 = 0 AND c.id % 2 = 1 GROUP BY 1, 2), j AS (SELECT left_id, right_id, b / (x.s + y.s - b) AS score FROM b JOIN s x ON x.id = left_id JOIN s y ON y.id = right_id WHERE b / (x.s + y.s - b) >= 0.05) SELECT left_id, right_id, round(score, 6) AS score FROM (SELECT *, max(score) OVER (PARTITION BY left_id) AS t FROM j) WHERE score >= t - 0.02")
def idf_jaccard_match(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "benchmark").select("item_id", T.tokens(F.col("text")).alias("t"))
    idf = S.inverse_document_frequency(items, "item_id", "t")
    words = items.select(F.col("item_id").alias("id"), F.explode("t").alias("token"))
    return M.token_matches(words.where("id % 2 = 0"), words.where("id % 2 = 1"), idf, threshold=0.05, margin=0.02).withColumn("score", F.round("score", 6))


@query("jaccard_coverage", "WITH plan AS (SELECT ['open the view', 'click here', 'purchase it now', 'sign up', 'error page'] AS p), s AS (SELECT user_id AS key, event_id, CASE event_type WHEN 'view' THEN 'open view the' WHEN 'click' THEN 'click here' WHEN 'purchase' THEN 'purchase it' WHEN 'signup' THEN 'other words entirely' ELSE 'page' END AS step FROM events), m AS (SELECT key, event_id, CASE step WHEN 'open view the' THEN 0 WHEN 'click here' THEN 1 WHEN 'purchase it' THEN 2 END AS idx FROM s) SELECT key, max(idx)::BIGINT AS covered, 5::BIGINT AS size, coalesce(max(idx), -1) < 3 AS truncated FROM m GROUP BY key")
def jaccard_coverage(spark: SparkSession, d: str) -> DataFrame:
    return _coverage(table(spark, d, "events"))


def _coverage(events: DataFrame) -> DataFrame:
    said = F.create_map(*(F.lit(x) for x in ("view", "open view the", "click", "click here", "purchase", "purchase it", "signup", "other words entirely")))
    steps = events.select(F.col("user_id").alias("key"), F.coalesce(F.try_element_at(said, F.col("event_type")), F.lit("page")).alias("step"))
    plans = steps.select("key").distinct().withColumn("plan", F.array(*map(F.lit, ("open the view", "click here", "purchase it now", "sign up", "error page"))))
    return M.coverage(steps, plans)


@query("task_text_lookup", f"WITH {TRAJ}, tasks AS (SELECT label, row_number() OVER (ORDER BY min(event_id)) - 1 AS task_index FROM traj GROUP BY label) SELECT event_id, task_index FROM traj JOIN tasks USING (label)")
def task_text_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Texts numbered by first appearance (a small dictionary), looked up for each frame."""
    t = trajectories(spark, d)
    tasks = t.groupBy("label").agg(F.min("event_id").alias("a"))
    tasks = tasks.select("label", (F.row_number().over(Window.orderBy("a")) - 1).cast("long").alias("task_index"))
    return t.join(tasks, "label").select("event_id", "task_index")


@query("plan_default_on_miss", "SELECT item_id, CASE WHEN item_id % 4 = 0 THEN 'find,take,put' ELSE 'approach,interact,complete' END AS plan FROM benchmark")
def plan_default_on_miss(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "benchmark").select("item_id")
    known = items.where("item_id % 4 = 0").withColumn("p", F.array(F.lit("find"), F.lit("take"), F.lit("put")))
    usual = F.array(F.lit("approach"), F.lit("interact"), F.lit("complete"))
    return items.join(known, "item_id", "left").select("item_id", F.array_join(F.coalesce("p", usual), ",").alias("plan"))


@query("integrity_anti_join", "SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
def integrity_anti_join(spark: SparkSession, d: str) -> DataFrame:
    good = table(spark, d, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, d, "orders").join(good, "o_custkey", "left_anti").select("o_orderkey")


@query("natural_sort_ids", "SELECT name, row_number() OVER (ORDER BY coalesce(try_cast(nullif(regexp_extract(name, '(\\d+)$', 1), '') AS BIGINT), 1000000000), name) AS place FROM (SELECT CASE WHEN s_suppkey % 10 = 0 THEN 'extra' || chr((97 + s_suppkey // 10 % 26)::INT) || '_' ELSE 'demo_' || s_suppkey END AS name FROM supplier) GROUP BY name")
def natural_sort_ids(spark: SparkSession, d: str) -> DataFrame:
    name = F.when(F.col("s_suppkey") % 10 == 0, F.concat(F.lit("extra"), F.chr(97 + F.floor(F.col("s_suppkey") / 10) % 26), F.lit("_"))).otherwise(F.concat(F.lit("demo_"), F.col("s_suppkey").cast("string")))
    names = table(spark, d, "supplier").select(name.alias("name")).distinct()
    placed = running(names.withColumn("number", T.natural_number(F.col("name"))), "number", "name")
    return placed.select("name", (F.col("place") + 1).cast("long").alias("place"))


@query("latest_run", "SELECT o_custkey, max(o_orderdate) AS latest, arg_max(o_orderkey, strftime(o_orderdate, '%Y-%m-%d-%H-%M') || lpad(o_orderkey::VARCHAR, 12, '0')) AS o_orderkey FROM orders GROUP BY o_custkey")
def latest_run(spark: SparkSession, d: str) -> DataFrame:
    """The last of each task's runs by their formatted times."""
    stamp = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd-HH-mm"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").alias("latest"), F.max_by("o_orderkey", stamp).alias("o_orderkey"))


@query("topk_types", "SELECT p_type, count(*) AS n, min(p_size)::BIGINT AS least, max(p_size)::BIGINT AS most, round(avg(p_size), 6) AS mean FROM part GROUP BY p_type ORDER BY n DESC, p_type LIMIT 5")
def topk_types(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy("p_type").agg(F.count("*").alias("n"), F.min("p_size").cast("long").alias("least"), F.max("p_size").cast("long").alias("most"), F.round(F.avg("p_size"), 6).alias("mean")).orderBy(F.desc("n"), "p_type").limit(5)


@query("top_with_margin", "SELECT p_partkey, p_brand FROM part QUALIFY p_retailprice >= max(p_retailprice) OVER (PARTITION BY p_brand) - 0.10 * max(p_retailprice) OVER (PARTITION BY p_brand)")
def top_with_margin(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_retailprice")
    top = p.groupBy("p_brand").agg(F.max("p_retailprice").alias("t"))
    return p.join(top, "p_brand").where(F.col("p_retailprice") >= F.col("t") - 0.10 * F.col("t")).select("p_partkey", "p_brand")


@query("fill_id_gaps", "WITH i AS (SELECT s_suppkey AS id FROM supplier WHERE s_suppkey % 4 <> 0), n AS (SELECT count(*) AS n FROM i), h AS (SELECT x AS hole, row_number() OVER (ORDER BY x) AS r FROM (SELECT unnest(range(0, n)) AS x FROM n) WHERE x NOT IN (SELECT id FROM i)), m AS (SELECT id, row_number() OVER (ORDER BY id DESC) AS r FROM i, n WHERE id >= n) SELECT i.id, coalesce(h.hole, i.id) AS new FROM i LEFT JOIN m ON m.id = i.id LEFT JOIN h ON h.r = m.r")
def fill_id_gaps(spark: SparkSession, d: str) -> DataFrame:
    return C.fill_gaps(table(spark, d, "supplier").where("s_suppkey % 4 <> 0").select(F.col("s_suppkey").alias("id")), "id")


@query("expand_layout_ids", "WITH ids AS (SELECT p_partkey AS pos, CASE WHEN p_partkey % 3 = 0 THEN -(p_size % 30) ELSE p_size END::BIGINT AS id FROM part), g AS (SELECT -n_nationkey::BIGINT AS g, list(s_suppkey ORDER BY s_suppkey) AS m FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_nationkey > 0 GROUP BY n_nationkey), x AS (SELECT pos, coalesce(m, [id]) AS m FROM ids LEFT JOIN g ON g.g = ids.id) SELECT pos, unnest(range(0, len(m))) AS at, unnest(m) AS member FROM x")
def expand_layout_ids(spark: SparkSession, d: str) -> DataFrame:
    """Negative ids stand for the suppliers of a nation, in order; positive ones, and those of no nation, for themselves."""
    size = F.col("p_size").cast("long")
    ids = table(spark, d, "part").select(F.col("p_partkey").alias("pos"), F.when(F.col("p_partkey") % 3 == 0, -(size % 30)).otherwise(size).alias("id"))
    groups = table(spark, d, "supplier").where("s_nationkey > 0").groupBy((-F.col("s_nationkey")).cast("long").alias("group")).agg(F.sort_array(F.collect_list("s_suppkey")).alias("members"))
    return C.expand_groups(ids, groups).select("pos", F.col("at").cast("long").alias("at"), "member")


@query("set_operations", "SELECT 'minus' AS op, count(*) AS n FROM (SELECT s_nationkey FROM supplier EXCEPT SELECT c_nationkey FROM customer WHERE c_acctbal > 9900) UNION ALL SELECT 'both', count(*) FROM (SELECT s_nationkey FROM supplier INTERSECT SELECT c_nationkey FROM customer WHERE c_acctbal > 9900) UNION ALL SELECT 'either', count(*) FROM (SELECT s_nationkey FROM supplier UNION SELECT c_nationkey FROM customer WHERE c_acctbal > 9900) UNION ALL SELECT 'all', (SELECT count(*) FROM supplier) + (SELECT count(*) FROM customer WHERE c_acctbal > 9900)")
def set_operations(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))
    b = table(spark, d, "customer").where("c_acctbal > 9900").select(F.col("c_nationkey").alias("k"))
    parts = {"minus": a.subtract(b), "both": a.intersect(b), "either": a.union(b).distinct(), "all": a.unionByName(b)}
    out = None
    for name, df in parts.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("op"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("distinct_first_order", "SELECT event_type AS label, CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS k, min(event_id) AS first FROM events GROUP BY 1, 2")
def distinct_first_order(spark: SparkSession, d: str) -> DataFrame:
    """Distinct pairs, with their first place."""
    return trajectories(spark, d).groupBy("label", (F.col("k") % 10).alias("k")).agg(F.min("event_id").alias("first"))


@query("last_wins_update", "SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY o_custkey")
def last_wins_update(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.max_by("o_orderstatus", "o_orderkey").alias("status"))


@query("style_groups", "SELECT p_brand, min(p_partkey) AS representative, count(DISTINCT p_size) AS styles, string_agg(DISTINCT p_size::VARCHAR, ',' ORDER BY p_size::VARCHAR) AS listed FROM part GROUP BY p_brand")
def style_groups(spark: SparkSession, d: str) -> DataFrame:
    sizes = F.sort_array(F.collect_set(F.col("p_size").cast("string")))
    return table(spark, d, "part").groupBy("p_brand").agg(F.min("p_partkey").alias("representative"), F.size(sizes).cast("long").alias("styles"), F.array_join(sizes, ",").alias("listed"))

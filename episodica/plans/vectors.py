"""Queries on vectors: statistics, pooling, reshaping, scaling, geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import statistics as S
from ..operators.running import running_statistics
from ..sources.tables import states, table, trajectories, vectors
from .catalogue import DIMS, TRAJ, VEC, query

#: Sub-ranges of a state vector that stand for its modalities.
MODALITIES = {"position": (0, 3), "rotation": (3, 6), "gripper": (6, 8)}
ORDER = [(6, 8), (0, 3), (3, 6)]


def _exploded(df: DataFrame, array: str, *keys: str, digits: int = 6) -> DataFrame:
    return df.select(*keys, F.posexplode(array).alias("i", "x")).select(*keys, F.col("i").cast("long").alias("i"), F.round("x", digits).alias("x"))


def _stats(df: DataFrame) -> DataFrame:
    return df.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


@query("vector_stats", f"WITH {DIMS} SELECT dim, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max, count(*) AS n, round(quantile_cont(x, 0.01), 6) AS q01, round(quantile_cont(x, 0.99), 6) AS q99 FROM dims GROUP BY dim")
def vector_stats(spark: SparkSession, d: str) -> DataFrame:
    return _stats(S.summary(vectors(spark, d), "v"))


@query("vector_stats_by_label", f"WITH {DIMS} SELECT ep, dim, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max, count(*) AS n FROM dims GROUP BY ep, dim")
def vector_stats_by_label(spark: SparkSession, d: str) -> DataFrame:
    return _stats(S.summary(vectors(spark, d), "v", "ep", quantiles=False))


@query("vector_slice_modality", f"WITH {DIMS} SELECT vec_id, CASE WHEN dim < 3 THEN 'position' WHEN dim < 6 THEN 'rotation' ELSE 'gripper' END AS modality, CASE WHEN dim < 3 THEN dim WHEN dim < 6 THEN dim - 3 ELSE dim - 6 END AS i, round(x, 6) AS x FROM dims WHERE dim < 8")
def vector_slice_modality(spark: SparkSession, d: str) -> DataFrame:
    parts = F.array(*(F.struct(F.lit(k).alias("modality"), V.part(F.col("v"), a, b).alias("part")) for k, (a, b) in MODALITIES.items()))
    return _exploded(vectors(spark, d).select("vec_id", F.inline(parts)), "part", "vec_id", "modality")


@query("vector_permute", f"WITH {DIMS} SELECT vec_id, CASE WHEN dim >= 6 THEN dim - 6 ELSE dim + 2 END AS i, round(x, 6) AS x, dim AS restored FROM dims WHERE dim < 8")
def vector_permute(spark: SparkSession, d: str) -> DataFrame:
    out = vectors(spark, d).select("vec_id", V.permute(F.col("v"), ORDER).alias("p"), V.part(F.col("v"), 0, 8).alias("v"))
    back = F.transform(V.permute(F.col("p"), V.inverse_ranges(ORDER)), lambda x, i: F.struct(x.alias("x"), i.alias("i"), F.get(F.col("v"), i).alias("was")))
    places = out.select("vec_id", F.posexplode("p").alias("i", "x"), F.lit(0)).drop("0")
    restored = out.select("vec_id", F.inline(back)).where("x = was").select("vec_id", F.col("i").alias("restored"))
    to = F.when(F.col("restored") >= 6, F.col("restored") - 6).otherwise(F.col("restored") + 2)
    return places.join(restored.withColumn("i", to), ["vec_id", "i"]).select("vec_id", F.col("i").cast("long").alias("i"), F.round("x", 6).alias("x"), F.col("restored").cast("long").alias("restored"))


@query("vector_pick_pad", f"WITH {DIMS}, p AS (SELECT vec_id, v, unnest(range(0, 8)) AS i FROM vec) SELECT vec_id, i, CASE WHEN i < 5 THEN round(v[[1, 2, 7, 8, 4][i + 1]], 6) ELSE 0.0::DOUBLE END AS x FROM p")
def vector_pick_pad(spark: SparkSession, d: str) -> DataFrame:
    return _exploded(vectors(spark, d).select("vec_id", V.pad(V.pick(F.col("v"), [0, 1, 6, 7, 3]), 8).alias("p")), "p", "vec_id")


@query("vector_subsample", f"WITH {DIMS} SELECT vec_id, dim // 8 AS i, round(x, 6) AS x FROM dims WHERE dim % 8 = 0")
def vector_subsample(spark: SparkSession, d: str) -> DataFrame:
    return _exploded(vectors(spark, d).select("vec_id", V.every(F.col("v"), 8).alias("p")), "p", "vec_id")


_STATS = DIMS + ", st AS (SELECT dim, avg(x) AS m, stddev_pop(x) AS s, quantile_cont(x, 0.01) AS lo, quantile_cont(x, 0.99) AS hi FROM dims GROUP BY dim)"


def _with_stats(spark: SparkSession, d: str) -> DataFrame:
    v = vectors(spark, d)
    return v.crossJoin(F.broadcast(S.nested(S.summary(v, "v"))))  # one row of statistics


@query("zscore_normalize", f"WITH {_STATS} SELECT vec_id, dim AS i, round((x - m) / (s + 1e-6), 6) AS x FROM dims JOIN st USING (dim)")
def zscore_normalize(spark: SparkSession, d: str) -> DataFrame:
    return _exploded(_with_stats(spark, d).select("vec_id", V.zscore(F.col("v"), F.col("mean"), F.col("std")).alias("p")), "p", "vec_id")


@query("quantile_normalize", f"WITH {_STATS} SELECT vec_id, dim AS i, round((x - lo) / (hi - lo + 1e-6) * 2 - 1, 6) AS x FROM dims JOIN st USING (dim)")
def quantile_normalize(spark: SparkSession, d: str) -> DataFrame:
    return _exploded(_with_stats(spark, d).select("vec_id", V.to_quantiles(F.col("v"), F.col("q01"), F.col("q99")).alias("p")), "p", "vec_id")


@query("unnormalize_roundtrip", f"WITH {DIMS} SELECT vec_id, dim AS i, round(x, 6) AS z, round(x, 6) AS q FROM dims")
def unnormalize_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    out = _with_stats(spark, d).select("vec_id", V.unzscore(V.zscore(c("v"), c("mean"), c("std")), c("mean"), c("std")).alias("z"), V.from_quantiles(V.to_quantiles(c("v"), c("q01"), c("q99")), c("q01"), c("q99")).alias("q"))
    return out.select("vec_id", F.posexplode(F.arrays_zip("z", "q")).alias("i", "p")).select("vec_id", c("i").cast("long").alias("i"), F.round("p.z", 6).alias("z"), F.round("p.q", 6).alias("q"))


@query("clip_scale", f"WITH {DIMS}, st AS (SELECT ep, dim, quantile_cont(x, 0.01) AS lo, quantile_cont(x, 0.99) AS hi FROM dims GROUP BY ep, dim) SELECT vec_id, dim AS i, round(greatest(-1, least(1, 2 * (x - lo) / (hi - lo + 1e-8) - 1)), 6) AS x FROM dims JOIN st USING (ep, dim)")
def clip_scale(spark: SparkSession, d: str) -> DataFrame:
    v = vectors(spark, d)
    stats = S.summary(v, "v", "ep").select("ep", "dim", "q01", "q99")
    return S.by_dimension(v, "v", "ep", "vec_id").join(stats, ["ep", "dim"]).select("vec_id", F.col("dim").alias("i"), F.round(V.clipped(F.col("value"), F.col("q01"), F.col("q99")), 6).alias("x"))


_GROUPS = DIMS + ", g AS (SELECT ep, dim, avg(x) AS m, stddev_pop(x) AS s, min(x) AS lo, max(x) AS hi, count(*) AS n, quantile_cont(x, 0.01) AS q1, quantile_cont(x, 0.99) AS q9 FROM dims GROUP BY ep, dim), w AS (SELECT *, {w} / sum({w}) OVER (PARTITION BY dim) AS w FROM g)"


def _pool_sql(weight: str, q: str) -> str:
    lo, hi = ("sum(w * q1)", "sum(w * q9)") if q == "average" else ("min(q1)", "max(q9)")
    return f"WITH {_GROUPS.replace('{w}', weight)} SELECT dim, round(sum(w * m), 6) AS mean, round(sqrt(greatest(0, sum(w * (s * s + m * m)) - sum(w * m) * sum(w * m))), 6) AS std, round(min(lo), 6) AS min, round(max(hi), 6) AS max, round({lo}, 6) AS q01, round({hi}, 6) AS q99 FROM w GROUP BY dim"


def _pool(spark: SparkSession, d: str, weight, quantiles: str) -> DataFrame:  # noqa: ANN001
    stats = S.summary(vectors(spark, d), "v", "ep").withColumn("w", weight)
    return _stats(S.pooled(stats, "w", "dim", quantiles=quantiles))


@query("pooled_stats_weighted", _pool_sql("n", "average"))
def pooled_stats_weighted(spark: SparkSession, d: str) -> DataFrame:
    return _pool(spark, d, F.col("n"), "average")


@query("pooled_stats_minmax", _pool_sql("1", "extremes"))
def pooled_stats_minmax(spark: SparkSession, d: str) -> DataFrame:
    return _pool(spark, d, F.lit(1), "extremes")


@query("pooled_stats_alpha", _pool_sql("pow(n, 0.4)", "average"))
def pooled_stats_alpha(spark: SparkSession, d: str) -> DataFrame:
    return _pool(spark, d, F.pow("n", F.lit(0.4)), "average")


_HIST = "e AS (SELECT min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem), b AS (SELECT least(99, floor((l_quantity - lo) / ((hi - lo) / 100)))::BIGINT AS bin, lo, hi FROM lineitem, e), h AS (SELECT bin, min(lo + bin * ((hi - lo) / 100)) AS edge, count(*) AS n FROM b GROUP BY bin)"


@query("histogram", f"WITH {_HIST} SELECT bin, round(edge, 6) AS edge, n FROM h")
def histogram(spark: SparkSession, d: str) -> DataFrame:
    return S.histogram(table(spark, d, "lineitem").select("l_quantity"), "l_quantity", 100).withColumn("edge", F.round("edge", 6))


@query("histogram_quantile", f"WITH {_HIST}, c AS (SELECT edge, sum(n) OVER (ORDER BY bin) AS c, sum(n) OVER () AS t FROM h) SELECT round(min(edge) FILTER (c >= 0.01 * t), 6) AS q01, round(min(edge) FILTER (c >= 0.5 * t), 6) AS q50, round(min(edge) FILTER (c >= 0.99 * t), 6) AS q99 FROM c")
def histogram_quantile(spark: SparkSession, d: str) -> DataFrame:
    hist = S.histogram(table(spark, d, "lineitem").select("l_quantity"), "l_quantity", 100)
    return _stats(S.histogram_quantiles(hist, (0.01, 0.5, 0.99)))


#: The least power of two by which all values fall into 5,000 bins, and bin numbers have 52 bits; quantiles are left edges of bins.
_RUNNING = DIMS + """, f AS (SELECT {k}dim, count(*) AS n, avg(x) AS mean, stddev_pop(x) AS std, min(x) AS lo, max(x) AS hi FROM dims GROUP BY {k}dim),
e AS (SELECT {k}dim, min(e) AS e FROM f, (SELECT unnest(range(-120, 60)) AS e) WHERE floor(hi * pow(2.0, -e)) - floor(lo * pow(2.0, -e)) < 5000 AND greatest(abs(lo), abs(hi)) * pow(2.0, -e) < pow(2.0, 52) GROUP BY {k}dim),
b AS (SELECT {k}dim, e, floor(x * pow(2.0, -e)) AS bin, count(*) AS c FROM dims JOIN e USING ({k}dim) GROUP BY {k}dim, e, bin),
c AS (SELECT {k}dim, bin * pow(2.0, e) AS edge, sum(c) OVER (PARTITION BY {k}dim ORDER BY bin) AS c, sum(c) OVER (PARTITION BY {k}dim) AS n FROM b),
q AS (SELECT {k}dim, min(edge) FILTER (c >= 0.01::DOUBLE * n) AS q01, min(edge) FILTER (c >= 0.99::DOUBLE * n) AS q99 FROM c GROUP BY {k}dim)
SELECT {k}dim, n, round(mean, 6) AS mean, round(std, 6) AS std, round(lo, 6) AS min, round(hi, 6) AS max, round(q01, 6) AS q01, round(q99, 6) AS q99 FROM f JOIN q USING ({k}dim)"""


@query("running_stats", "WITH " + _RUNNING.replace("{k}", ""))
def running_stats(spark: SparkSession, d: str) -> DataFrame:
    """Statistics in one pass, merged as a tree."""
    return _stats(running_statistics(vectors(spark, d), "v"))


@query("running_stats_by_label", "WITH " + _RUNNING.replace("{k}", "ep, "))
def running_stats_by_label(spark: SparkSession, d: str) -> DataFrame:
    return _stats(running_statistics(vectors(spark, d), "v", "ep"))


_MASK = [True, True, False, True]
_DELTA = f"WITH {VEC}, c AS (SELECT vec_id, v AS state, [v, lead(v) OVER (PARTITION BY ep ORDER BY frame)] AS rows, lead(v) OVER (PARTITION BY ep ORDER BY frame) IS NOT NULL AS has FROM vec), r AS (SELECT vec_id, state, unnest(rows) AS row, unnest([0, 1]) AS step FROM c WHERE has), x AS (SELECT vec_id, step, state, row, unnest(range(0, 6)) AS i FROM r) SELECT vec_id, step::BIGINT AS step, i, round(row[i + 1] - CASE WHEN i IN (0, 1, 3) THEN state[i + 1] ELSE 0 END, 6) AS delta, round(row[i + 1], 6) AS back FROM x"


@query("delta_actions", _DELTA)
def delta_actions(spark: SparkSession, d: str) -> DataFrame:
    """Delta actions and, undone, absolute ones."""
    w = Window.partitionBy("ep").orderBy("frame")
    six = states(spark, d).withColumn("v", V.part(F.col("v"), 0, 6))
    rows = six.withColumn("after", F.lead("v").over(w)).where(F.col("after").isNotNull()).withColumn("rows", F.array("v", "after"))
    rows = rows.withColumn("delta", V.shift(F.col("rows"), F.col("v"), _MASK, -1)).withColumn("back", V.shift(F.col("delta"), F.col("v"), _MASK, 1))
    steps = rows.select("vec_id", F.posexplode(F.arrays_zip("delta", "back")).alias("step", "p"))
    out = steps.select("vec_id", F.col("step").cast("long").alias("step"), F.posexplode(F.arrays_zip("p.delta", "p.back")).alias("i", "q"))
    return out.select("vec_id", "step", F.col("i").cast("long").alias("i"), F.round(F.col("q")["delta"], 6).alias("delta"), F.round(F.col("q")["back"], 6).alias("back"))


@query("digitize", f"WITH {DIMS} SELECT vec_id, dim AS i, greatest(-1, least(255, floor((x * 4 + 1) * 128)))::BIGINT AS bin FROM dims")
def digitize(spark: SparkSession, d: str) -> DataFrame:
    return vectors(spark, d).select("vec_id", F.posexplode(F.transform("v", lambda x: V.digitize(x * 4))).alias("i", "bin")).withColumn("i", F.col("i").cast("long"))


@query("vector_reductions", f"WITH {DIMS} SELECT vec_id, round(sum(x), 6) AS total, round(max(x), 6) AS most, round(avg(x), 6) AS mean, round(sqrt(sum(x * x)), 6) AS norm FROM dims GROUP BY vec_id")
def vector_reductions(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("v")
    total = F.aggregate(v, F.lit(0.0), lambda s, x: s + x)
    return _stats(vectors(spark, d).select("vec_id", total.alias("total"), F.array_max(v).alias("most"), (total / F.size(v)).alias("mean"), V.norm(v).alias("norm")))


@query("one_hot", "SELECT vec_id, unnest(range(0, 10)) AS i, CASE WHEN unnest(range(0, 10)) = label THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS x FROM embeddings")
def one_hot(spark: SparkSession, d: str) -> DataFrame:
    return _exploded(vectors(spark, d).select("vec_id", V.one_hot(F.col("ep"), 10).alias("p")), "p", "vec_id")


@query("pad_sequence", f"WITH {VEC}, p AS (SELECT vec_id, list_concat([v[1], v[1]], list_concat(v[1:4], [v[4]])) AS same, list_concat([0.0, 0.0], list_concat(v[1:4], [0.0])) AS zero FROM vec) SELECT vec_id, unnest(range(0, 7)) AS i, round(unnest(same), 6) AS same, round(unnest(zero), 6) AS zero FROM p")
def pad_sequence(spark: SparkSession, d: str) -> DataFrame:
    v = V.part(F.col("v"), 0, 4)
    z = vectors(spark, d).select("vec_id", F.posexplode(F.arrays_zip(V.pad_rows(v, 2, 1, True).alias("same"), V.pad_rows(v, 2, 1, False).alias("zero"))).alias("i", "p"))
    return z.select("vec_id", F.col("i").cast("long").alias("i"), F.round("p.same", 6).alias("same"), F.round("p.zero", 6).alias("zero"))


@query("floor_std", f"WITH {DIMS}, s AS (SELECT ep, dim, stddev_pop(x) * 0.09 AS s FROM dims GROUP BY ep, dim) SELECT ep, dim AS i, CASE WHEN s < 0.01 THEN 1.0::DOUBLE ELSE round(s, 6) END AS x FROM s")
def floor_std(spark: SparkSession, d: str) -> DataFrame:
    stats = S.nested(S.summary(vectors(spark, d), "v", "ep", quantiles=False), "ep")
    return _exploded(stats.select("ep", V.floor_std(F.transform("std", lambda s: s * 0.09)).alias("p")), "p", "ep")




@query("project_to_pixel", f"WITH {VEC} SELECT vec_id, CASE WHEN v[3] - 0.05 < 0 THEN trunc(128.0 * v[1] / (0.05 - v[3]) + 128)::BIGINT END AS px, CASE WHEN v[3] - 0.05 < 0 THEN trunc(128 - 128.0 * v[2] / (0.05 - v[3]))::BIGINT END AS py FROM vec WHERE abs(v[3] - 0.05) > 0.001")
def project_to_pixel(spark: SparkSession, d: str) -> DataFrame:
    axes = [F.array(*(F.lit(1.0 if i == j else 0.0) for j in range(3))) for i in range(3)]
    camera = F.array(F.lit(0.0), F.lit(0.0), F.lit(0.05))
    u, v = V.project(V.part(F.col("v"), 0, 3), camera, axes, 90.0, 256, 256)
    return vectors(spark, d).where(F.abs(F.element_at("v", 3) - 0.05) > 0.001).select("vec_id", u.alias("px"), v.alias("py"))


_BOX = "b AS (SELECT vec_id, CASE WHEN v[9] > 0 THEN [trunc(abs(v[1]) * 500), trunc(abs(v[2]) * 500), trunc(abs(v[1]) * 500) + 10, trunc(abs(v[2]) * 500) + 7] END AS b FROM vec)"


def _boxes(spark: SparkSession, d: str) -> DataFrame:
    x, y = ((F.abs(F.element_at("v", i)) * 500).cast("long") for i in (1, 2))
    return vectors(spark, d).select("vec_id", F.when(F.element_at("v", 9) > 0, F.array(x, y, x + 10, y + 7)).alias("box"))


@query("box_flip_centre", f"WITH {VEC}, {_BOX} SELECT vec_id, (255 - b[3])::BIGINT AS x1, (255 - b[4])::BIGINT AS y1, (255 - b[1])::BIGINT AS x2, (255 - b[2])::BIGINT AS y2, trunc((b[1] + b[3]) / 2)::BIGINT AS cx, trunc((b[2] + b[4]) / 2)::BIGINT AS cy, trunc(b[1] * 224 / 256)::BIGINT AS rx FROM b")
def box_flip_centre(spark: SparkSession, d: str) -> DataFrame:
    flip, centre = V.flip_box(F.col("box"), 256, 256), V.box_centre(F.col("box"))
    return _boxes(spark, d).select("vec_id", *(F.element_at(flip, i).alias(n) for i, n in ((1, "x1"), (2, "y1"), (3, "x2"), (4, "y2"))), F.element_at(centre, 1).alias("cx"), F.element_at(centre, 2).alias("cy"), V.resized(F.element_at("box", 1), 224).alias("rx"))


@query("bbox_from_points", f"WITH {VEC}, {_BOX}, p AS (SELECT ep, b.b FROM b JOIN vec USING (vec_id)) SELECT e.ep, min(b[1])::BIGINT AS x1, min(b[2])::BIGINT AS y1, max(b[3])::BIGINT AS x2, max(b[4])::BIGINT AS y2 FROM (SELECT DISTINCT ep FROM vec) e LEFT JOIN p ON p.ep = e.ep AND p.b IS NOT NULL GROUP BY e.ep")
def bbox_from_points(spark: SparkSession, d: str) -> DataFrame:
    """The box of all pixels of an episode; null where there are none."""
    at = lambda i, n, f: f(F.element_at("box", i)).alias(n)
    return vectors(spark, d).select("vec_id", "ep").join(_boxes(spark, d), "vec_id").groupBy("ep").agg(at(1, "x1", F.min), at(2, "y1", F.min), at(3, "x2", F.max), at(4, "y2", F.max))


@query("rotations", f"WITH {VEC}, a AS (SELECT vec_id, v[1] AS x, v[2] AS y, v[3] AS z, sqrt(v[1] * v[1] + v[2] * v[2] + v[3] * v[3]) AS t FROM vec), q AS (SELECT vec_id, cos(t / 2) AS w, x * sin(t / 2) / t AS i, y * sin(t / 2) / t AS j, z * sin(t / 2) / t AS k FROM a) SELECT vec_id, round(1 - 2 * (j * j + k * k), 6) AS r1, round(2 * (i * j - k * w), 6) AS r2, round(2 * (i * k + j * w), 6) AS r3, round(2 * (i * j + k * w), 6) AS r4, round(1 - 2 * (i * i + k * k), 6) AS r5, round(2 * (j * k - i * w), 6) AS r6, round(2 * (j * k + i * w), 6) AS r8, round(atan2(2 * (w * k + i * j), 1 - 2 * (j * j + k * k)), 6) AS yaw FROM q")
def rotations(spark: SparkSession, d: str) -> DataFrame:
    """Axis-angle to quaternion, matrix, six numbers and back, and the turn about z."""
    a = V.part(F.col("v"), 0, 3)
    out = vectors(spark, d).select("vec_id", V.quaternion_of(a).alias("q"), V.six_of(a).alias("s")).withColumn("m", V.matrix_of_six(F.col("s")))
    return out.select("vec_id", *(F.round(F.element_at("s", i), 6).alias(f"r{i}") for i in range(1, 7)), F.round(F.element_at("m", 8), 6).alias("r8"), F.round(V.yaw_of(F.col("q")), 6).alias("yaw"))


@query("project_to_segment", f"WITH {VEC}, t AS (SELECT vec_id, v, (v[1] - v[4]) * (v[7] - v[4]) + (v[2] - v[5]) * (v[8] - v[5]) + (v[3] - v[6]) * (v[9] - v[6]) AS a, (v[7] - v[4]) * (v[7] - v[4]) + (v[8] - v[5]) * (v[8] - v[5]) + (v[9] - v[6]) * (v[9] - v[6]) AS b FROM vec), u AS (SELECT vec_id, v, greatest(0, least(1, a / b)) AS t FROM t) SELECT vec_id, round(v[4] + t * (v[7] - v[4]), 6) AS x, round(sqrt(pow(v[1] - v[4] - t * (v[7] - v[4]), 2) + pow(v[2] - v[5] - t * (v[8] - v[5]), 2) + pow(v[3] - v[6] - t * (v[9] - v[6]), 2)), 6) AS distance FROM u")
def project_to_segment(spark: SparkSession, d: str) -> DataFrame:
    p, a, b = (V.part(F.col("v"), i, i + 3) for i in (0, 3, 6))
    out = vectors(spark, d).select("vec_id", p.alias("p"), V.on_line(p, a, b, clamp=True).alias("f"))
    return out.select("vec_id", F.round(F.element_at("f", 1), 6).alias("x"), F.round(V.norm(V.minus(F.col("p"), F.col("f"))), 6).alias("distance"))


@query("sat_intersect", f"WITH {VEC} SELECT a.vec_id AS left_id, b.vec_id AS right_id, abs(a.v[1] - b.v[1]) <= 0.2 AND abs(a.v[2] - b.v[2]) <= 0.2 AND abs(a.v[3] - b.v[3]) <= 0.2 AS meets FROM vec a JOIN vec b ON a.ep = b.ep AND b.frame = a.frame + 1")
def sat_intersect(spark: SparkSession, d: str) -> DataFrame:
    """Whether the boxes of consecutive frames meet, by the separating-axis test."""
    w = Window.partitionBy("ep").orderBy("frame")
    half = F.array(*(F.lit(0.1),) * 3)
    box = states(spark, d).withColumn("c", V.corners(V.part(F.col("v"), 0, 3), half))
    pairs = box.withColumn("right_id", F.lead("vec_id").over(w)).withColumn("other", F.lead("c").over(w)).where(F.col("right_id").isNotNull())
    axes = [F.array(*(F.lit(1.0 if i == j else 0.0) for j in range(3))) for i in range(3)]
    return pairs.select(F.col("vec_id").alias("left_id"), "right_id", (~V.separated(F.col("c"), F.col("other"), axes)).alias("meets"))


@query("containment", f"WITH {VEC} SELECT vec_id, v[1] >= -0.15 AND v[1] <= 0.15 AND v[2] >= -0.15 AND v[2] <= 0.15 AND v[3] >= -0.15 AND v[3] <= 0.15 AS inside FROM vec")
def containment(spark: SparkSession, d: str) -> DataFrame:
    origin = F.array(*(F.lit(-0.1),) * 3)
    axes = [(F.array(*(F.lit(1.0 if i == j else 0.0) for j in range(3))), F.array(*(F.lit(0.1 if i == j else -0.1) for j in range(3)))) for i in range(3)]
    return vectors(spark, d).select("vec_id", V.inside(V.part(F.col("v"), 0, 3), origin, axes, 0.05).alias("inside"))


@query("cosine_local", f"WITH {VEC}, p AS (SELECT vec_id, v, lead(v) OVER (PARTITION BY ep ORDER BY frame) AS n FROM vec) SELECT vec_id, round(list_inner_product(v[1:8], n[1:8]) / greatest(sqrt(list_inner_product(v[1:8], v[1:8])) * sqrt(list_inner_product(n[1:8], n[1:8])), 1e-10), 6) AS cosine, round(cos(v[3]) * v[1] + sin(v[3]) * v[2], 6) AS lx, round(-sin(v[3]) * v[1] + cos(v[3]) * v[2], 6) AS ly FROM p WHERE n IS NOT NULL")
def cosine_local(spark: SparkSession, d: str) -> DataFrame:
    """Cosine with the next frame's vector, and plane coordinates in a turned frame."""
    w = Window.partitionBy("ep").orderBy("frame")
    p = states(spark, d).withColumn("n", F.lead("v").over(w)).where(F.col("n").isNotNull())
    x, y = V.to_local(F.element_at("v", 1), F.element_at("v", 2), F.element_at("v", 3))
    return p.select("vec_id", F.round(V.cosine(V.part(F.col("v"), 0, 8), V.part(F.col("n"), 0, 8)), 6).alias("cosine"), F.round(x, 6).alias("lx"), F.round(y, 6).alias("ly"))


@query("bounds_check", f"WITH {VEC} SELECT ep, count(*) AS n, count(*) FILTER (list_max(v) > 0.25 OR list_min(v) < -0.25) AS out_of_bounds FROM vec GROUP BY ep")
def bounds_check(spark: SparkSession, d: str) -> DataFrame:
    bad = F.exists("v", lambda x: (x < -0.25) | (x > 0.25))
    return vectors(spark, d).groupBy("ep").agg(F.count("*").alias("n"), F.count_if(bad).alias("out_of_bounds"))


@query("image_fit", "WITH p AS (SELECT p_partkey, (p_size * 13 + 40)::DOUBLE AS w, (p_size * 7 + 90)::DOUBLE AS h FROM part), r AS (SELECT p_partkey, w, h, greatest(w / 224, h / 224) AS r FROM p), s AS (SELECT p_partkey, trunc(w / r)::BIGINT AS width, trunc(h / r)::BIGINT AS height FROM r) SELECT p_partkey, width, height, floor((224 - width) / 2.0)::BIGINT AS pad_left, floor((224 - height) / 2.0)::BIGINT AS pad_top FROM s")
def image_fit(spark: SparkSession, d: str) -> DataFrame:
    w, h, left, top = V.fit_within((F.col("p_size") * 13 + 40).cast("double"), (F.col("p_size") * 7 + 90).cast("double"), 224, 224)
    return table(spark, d, "part").select("p_partkey", w.alias("width"), h.alias("height"), left.alias("pad_left"), top.alias("pad_top"))


@query("scale_values", f"WITH {TRAJ}, s AS (SELECT ep, min(value) AS lo, max(value) AS hi FROM traj GROUP BY ep) SELECT event_id, round((value - lo) / (hi - lo), 6) AS x, round((value - lo) / (hi - lo) * (hi - lo) + lo, 6) AS back FROM traj JOIN s USING (ep)")
def scale_values(spark: SparkSession, d: str) -> DataFrame:
    t = trajectories(spark, d)
    w = Window.partitionBy("ep")
    t = t.withColumn("lo", F.min("value").over(w)).withColumn("span", F.max("value").over(w) - F.col("lo"))
    x = V.scale(F.array("value"), F.array("lo"), F.array("span"))
    return t.select("event_id", F.round(F.element_at(x, 1), 6).alias("x"), F.round(F.element_at(V.unscale(x, F.array("lo"), F.array("span")), 1), 6).alias("back"))

"""Subsets, shards, mixtures, registries and sets."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.texts import uniform
from .order import permuted, running


def hash_rank(key: Column, seed: object) -> Column:
    """An order that depends on key and seed alone."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")))


def subset(df: DataFrame, key: str, n: int, seed: object) -> DataFrame:
    """The n rows first in a seeded order: a top-n, kept small in every task before tasks meet."""
    return df.orderBy(hash_rank(F.col(key), seed), key).limit(n)


def subsets(spark: SparkSession, df: DataFrame, key: str, sizes: Iterable[int]) -> DataFrame:
    """size and key: an independent draw for each size (draws are not nested)."""
    all_sizes = spark.createDataFrame([(int(n),) for n in sizes], "size long")  # fixed by the caller, not by data
    drawn = df.select(key).crossJoin(F.broadcast(all_sizes)).withColumn("__h", F.md5(F.concat_ws("|", F.col("size").cast("string"), F.col(key).cast("string"))))
    return drawn.withColumn("__r", F.row_number().over(Window.partitionBy("size").orderBy("__h", key))).where("__r <= size").select("size", key)


def shuffled_prefix(df: DataFrame, key: str, n: int, seed: object) -> DataFrame:
    """The rows whose keys a seeded permutation of all (distinct) keys puts among the first n; all where there are no more.

    Keys are numbered in their order and their places permuted one by one: nothing is sorted by
    a hash, nothing is collected.
    """
    keys = running(df.select(key).distinct(), key)
    total = keys.agg(F.count("*").alias("__all"))  # one row
    chosen = keys.join(F.broadcast(total)).where(permuted(F.col("place"), F.col("__all"), seed) < n).select(key)
    return df.join(chosen, key, "left_semi")


def shard(df: DataFrame, key: str, k: int, contiguous: bool = True) -> DataFrame:
    """``shard`` of sorted keys: blocks of ceil(n / k), or every k-th."""
    total = df.agg(F.count("*").alias("__all"))  # one row
    placed = running(df, key, name="__place").join(F.broadcast(total))
    number = F.floor(F.col("__place") / F.ceil(F.col("__all") / k)) if contiguous else F.col("__place") % k
    return placed.withColumn("shard", number.cast("long")).drop("__place", "__all")


def batches(df: DataFrame, key: str, size: int, seed: object) -> DataFrame:
    """``batch`` of rows in a seeded order of all rows, numbered in ranges of it; the last, incomplete batch goes."""
    total = df.agg(F.count("*").alias("__all"))  # one row
    placed = running(df.withColumn("__h", hash_rank(F.col(key), seed)), "__h", key, name="__place").join(F.broadcast(total))
    whole = F.col("__place") < F.floor(F.col("__all") / size) * size
    return placed.where(whole).withColumn("batch", F.floor(F.col("__place") / size).cast("long")).drop("__h", "__place", "__all")


def fill_gaps(df: DataFrame, key: str) -> DataFrame:
    """key and new: the highest ids move into the lowest holes of 0..n-1, the rest stay; holes and ids above are numbered in ranges."""
    total = df.count()
    ids = df.select(key)
    holes = running(df.sparkSession.range(total).withColumnRenamed("id", "hole").join(ids.withColumnRenamed(key, "hole"), "hole", "left_anti"), "hole")
    high = running(ids.where(F.col(key) >= total).withColumn("__down", -F.col(key)), "__down")
    moved = high.join(holes, "place").select(key, F.col("hole").alias("new"))
    return ids.join(moved, key, "left").select(key, F.coalesce("new", key).alias("new"))


def instance_split(df: DataFrame, key: str, order: str) -> DataFrame:
    """``split``: the last instances of each category are for tests, the first max(n - 5, ceil(n / 2)) for training."""
    n = F.count("*").over(Window.partitionBy(key))
    place = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return df.withColumn("split", F.when(place <= F.greatest(n - 5, F.ceil(n / 2)), "train").otherwise("test"))


def cumulative(df: DataFrame, weight: str, order: str) -> DataFrame:
    """``low`` and ``high``: the part of [0, 1) that a row's weight takes up. One row for each dataset."""
    w = Window.partitionBy(F.lit(1))
    run, total = F.sum(weight).over(w.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.sum(weight).over(w)
    return df.withColumn("high", run / total).withColumn("low", F.coalesce(F.lag("high").over(w.orderBy(order)), F.lit(0.0)))


def shares(df: DataFrame, length: str, order: str, key: str) -> DataFrame:
    """``low`` and ``high`` as ``cumulative``, of whole lengths within each key, and the key's rows (``n``): summed in ranges, so a key of any size is spread."""
    placed = running(df, key, order, amount=F.col(length).cast("long"), name="__before")
    totals = placed.groupBy(key).agg(F.min("__before").alias("__first"), F.sum(length).alias("__total"), F.count("*").alias("n"))
    own = placed.join(totals, key).withColumn("__before", F.col("__before") - F.col("__first"))
    return own.withColumns({"low": F.col("__before") / F.col("__total"), "high": (F.col("__before") + F.col(length)) / F.col("__total")}).drop("__before", "__first", "__total")


def mixture(draws: DataFrame, datasets: DataFrame, episodes: DataFrame, seed: object) -> DataFrame:
    """For each draw a dataset by weight, an episode of it by length, and a step, by hashes of seed and draw; without a seed each call draws anew.

    ``draws``: index; ``datasets``: dataset, weight; ``episodes``: dataset, episode, length.
    Datasets are few: their ranges are one array, searched by each draw. Episodes are
    found by dealing their ranges into as many bins as the dataset has episodes.
    """
    seed = uuid.uuid4().hex if seed is None else seed
    d = cumulative(datasets.where("weight > 0"), "weight", "dataset").agg(F.array_sort(F.collect_list(F.struct("low", "high", "dataset"))).alias("__d"))
    u = lambda part: uniform(F.concat_ws("|", F.lit(str(seed)), F.lit(part), F.col("index").cast("string")))
    drawn = draws.crossJoin(F.broadcast(d)).select("index", F.element_at(F.filter("__d", lambda x: x["high"] > u("dataset")), 1)["dataset"].alias("dataset"), u("episode").alias("ue"), u("step").alias("us"))
    ranges = shares(episodes, "length", "episode", "dataset").withColumnRenamed("n", "__n")
    binned = ranges.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("low") * F.col("__n")), F.least(F.floor(F.col("high") * F.col("__n")), F.col("__n") - 1))))
    sizes = episodes.groupBy("dataset").agg(F.count("*").alias("__n"))
    drawn = drawn.join(sizes, "dataset").withColumn("__bin", F.floor(F.col("ue") * F.col("__n")))
    met = drawn.drop("__n").join(binned.drop("__n"), ["dataset", "__bin"]).where((F.col("ue") >= F.col("low")) & (F.col("ue") < F.col("high")))
    return met.select("index", "dataset", "episode", F.floor(F.col("us") * F.col("length")).cast("long").alias("step"))


def registry_choice(key: Column, registries: Mapping[str, tuple[float, Sequence[str]]], seed: object) -> tuple[Column, Column]:
    """A registry by weight and one of its items, each as likely, by hashes of seed and key; ``registries``: name -> (weight, items), fixed by the caller.

    Registries without weight or items are never chosen.
    """
    known = [(name, weight, items) for name, (weight, items) in registries.items() if weight > 0 and items]
    if not known:
        raise ValueError("no registry to choose from")
    u = lambda part: uniform(F.concat_ws("|", F.lit(str(seed)), F.lit(part), key.cast("string")))
    total, run = sum(w for _, w, _ in known), 0.0
    names, chosen = F.lit(known[-1][0]), F.lit(known[-1][2][0])
    steps = []
    for name, weight, items in known:
        run += weight
        at = F.element_at(F.array(*map(F.lit, items)), (F.floor(u("item") * len(items)) + 1).cast("int"))
        steps.append((run / total, F.lit(name), at))
    for high, name, item in reversed(steps):
        names = F.when(u("registry") < high, name).otherwise(names)
        chosen = F.when(u("registry") < high, item).otherwise(chosen)
    return names, chosen


def class_weights(df: DataFrame, kind: str, key: str, totals: dict[str, float]) -> DataFrame:
    """Each class's total weight split evenly among its rows, over the first row's (by key). One row for each dataset."""
    own = F.create_map(*(x for k, v in totals.items() for x in (F.lit(k), F.lit(float(v)))))
    split = df.withColumn("__w", F.element_at(own, F.col(kind)) / F.count("*").over(Window.partitionBy(kind)))
    return split.withColumn("weight", F.col("__w") / F.first("__w").over(Window.partitionBy(F.lit(1)).orderBy(key))).drop("__w")


#: Members in one block, ids that meet it in one task, and rows that a task makes at most on average.
BLOCK, MEETING, TASK_ROWS = 1000, 1000, 4_000_000


def expand_groups(ids: DataFrame, groups: DataFrame, block: int = BLOCK, meeting: int = MEETING) -> DataFrame:
    """pos, at and member: an id that is a group's stands for its members, in order; any other for itself.

    ``ids``: pos, id; ``groups``: group (once), members (array). The result has a row for each id
    and member. It is counted first and made by as many tasks as it takes, as blocks of members
    meet parts of the ids: a group of any size, or one that most ids name, is spread.
    """
    sizes = ids.groupBy("id").agg(F.count("*").alias("__ids")).join(groups.select(F.col("group").alias("id"), F.size("members").alias("__n")).where("__n >= 0"), "id")
    sizes = sizes.select("id", "__n", "__ids", F.ceil(F.col("__ids") / meeting).cast("int").alias("__parts"))  # one row for each group
    rows = sizes.agg(F.coalesce(F.sum(F.col("__n").cast("long") * F.col("__ids")), F.lit(0))).first()[0]
    most = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(most, -(-rows // 50_000)), -(-rows // TASK_ROWS))
    placed = ids.join(sizes.drop("__ids"), "id", "left")
    alone = placed.where("__n IS NULL").select("pos", F.lit(0).alias("at"), F.col("id").alias("member"))
    firsts = F.sequence(F.lit(0), F.col("__n") - 1, F.lit(block))
    asked = placed.where("__n > 0").select("pos", "id", F.pmod(F.xxhash64("pos"), F.col("__parts")).cast("int").alias("__part"), F.explode(firsts).alias("__first"))
    cut = groups.withColumnRenamed("group", "id").join(sizes.drop("__ids"), "id").where("__n > 0").select("id", "members", "__parts", F.explode(firsts).alias("__first"))
    blocks = cut.select("id", "__first", F.slice("members", F.col("__first") + 1, F.lit(block)).alias("__block"), F.explode(F.sequence(F.lit(0), F.col("__parts") - 1)).alias("__part"))
    keys = ["id", "__part", "__first"]
    met = asked.repartition(tasks, *keys).join(blocks.repartition(tasks, *keys).hint("merge"), keys)
    made = met.select("pos", "__first", F.posexplode("__block").alias("__at", "member"))
    return alone.unionByName(made.select("pos", (F.col("__first") + F.col("__at")).alias("at"), "member"))


def must_be_empty(df: DataFrame, message: str) -> None:
    """Referential checks: rows that find no partner are an error."""
    bad = df.limit(5).collect()
    if bad:
        raise ValueError(f"{message}: {bad}")

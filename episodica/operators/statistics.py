"""Statistics of vectors by dimension, their pooling, histograms and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import exact_quantiles


def by_dimension(df: DataFrame, vector: str, *keys: str) -> DataFrame:
    """Keys, dim and value: one row for each element; null elements and vectors are left out."""
    return df.select(*keys, F.posexplode(vector).alias("dim", "value")).where(F.col("value").isNotNull()).withColumn("dim", F.col("dim").cast("long"))


def summary(df: DataFrame, vector: str, *keys: str, quantiles: bool = True) -> DataFrame:
    """mean, population std, min, max, n and exact q01 and q99 of every dimension.

    Partial aggregation leaves a row for each key and dimension to shuffle; quantiles are
    selected (``exact_quantiles``), so no task holds the values of a dimension. One pass with
    quantiles of a bounded error is ``running_statistics``.
    """
    v, rows = F.col("value"), by_dimension(df, vector, *keys)
    figures = rows.groupBy(*keys, "dim").agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"), F.count("*").alias("n"))
    if not quantiles:
        return figures
    found = exact_quantiles(rows, "value", (0.01, 0.99), *keys, "dim")
    same = F.col("f.dim") == F.col("q.dim")
    for k in keys:
        same = same & F.col(f"f.{k}").eqNullSafe(F.col(f"q.{k}"))
    return figures.alias("f").join(found.alias("q"), same).select("f.*", "q.q01", "q.q99")


def nested(stats: DataFrame, *keys: str) -> DataFrame:
    """Rows by dimension to one vector for each figure."""
    names = [c for c in stats.columns if c not in (*keys, "dim")]
    ordered = F.array_sort(F.collect_list(F.struct("dim", *names)))
    return stats.groupBy(*keys).agg(ordered.alias("__s")).select(*keys, *(F.col(f"__s.{n}").alias(n) for n in names))


def pooled(stats: DataFrame, weight: str, *keys: str, quantiles: str = "average") -> DataFrame:
    """Weighted mean, total variance (not under 0), extremes and quantiles over datasets, for each of ``keys``."""
    if quantiles not in ("average", "extremes"):
        raise ValueError(f"unknown method {quantiles}")
    w = F.col(weight) / F.sum(weight).over(Window.partitionBy(*keys))
    s = stats.withColumn("__w", w)
    mean = F.sum(F.col("__w") * F.col("mean"))
    second = F.sum(F.col("__w") * (F.col("std") * F.col("std") + F.col("mean") * F.col("mean")))
    q = {"average": lambda c, f: F.when(F.count_if(F.col(c).isNull()) == 0, F.sum(F.col("__w") * F.col(c))), "extremes": lambda c, f: f(c)}[quantiles]
    return s.groupBy(*keys).agg(mean.alias("mean"), F.sqrt(F.greatest(F.lit(0.0), second - mean * mean)).alias("std"), F.min("min").alias("min"), F.max("max").alias("max"), q("q01", F.min).alias("q01"), q("q99", F.max).alias("q99"))


def histogram(df: DataFrame, value: str, bins: int, *keys: str) -> DataFrame:
    """keys, bin, edge (its left end) and n over equal bins between the least and the greatest value; the greatest is in the last."""
    ends = df.groupBy(*keys).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    joined = df.join(ends, list(keys)) if keys else df.crossJoin(F.broadcast(ends))  # without keys the ends are one row
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(bins - 1), F.floor((F.col(value) - F.col("lo")) / width))).otherwise(0).cast("long")
    return joined.select(*keys, at.alias("bin"), (F.col("lo") + at * width).alias("edge")).groupBy(*keys, "bin").agg(F.min("edge").alias("edge"), F.count("*").alias("n"))


def histogram_quantiles(hist: DataFrame, qs: Sequence[float], *keys: str) -> DataFrame:
    """The left edge of the first bin at which the count reaches q of all. Works on bins, not rows."""
    part = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    run = hist.withColumn("__c", F.sum("n").over(part.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("__n", F.sum("n").over(part))
    return run.groupBy(*keys).agg(*(F.min(F.when(F.col("__c") >= q * F.col("__n"), F.col("edge"))).alias(f"q{round(q * 100):02d}") for q in qs))


def inverse_document_frequency(docs: DataFrame, key: str, tokens: str) -> DataFrame:
    """token, df and idf = ln(n / (1 + df)) + 1 over distinct tokens of each row."""
    n = docs.agg(F.count("*").alias("__n"))
    seen = docs.select(key, F.explode(F.array_distinct(tokens)).alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    return seen.crossJoin(F.broadcast(n)).select("token", "df", (F.log(F.col("__n") / (1 + F.col("df"))) + 1).alias("idf"))  # n is one row


def rounded(x: Column) -> Column:
    """To whole numbers, halves up."""
    return F.floor(x + 0.5)


def first_is_one(df: DataFrame, weight: str, order: str, *keys: str) -> DataFrame:
    """Weights over the first one's, without zeros; a first weight of 0 gives nulls."""
    w = Window.partitionBy(*keys).orderBy(order) if keys else Window.partitionBy(F.lit(1)).orderBy(order)
    return df.withColumn("weight", F.try_divide(F.col(weight), F.first(weight).over(w))).where(F.col(weight) != 0)


def apportion(df: DataFrame, weight: str, total: int, order: str) -> DataFrame:
    """``share`` of ``total`` by weight, 1 at least; rounding drift is mended one each, from the heaviest on if too many, from the lightest if too few.

    For mixtures: one row for each dataset passes a single task.
    """
    one = Window.partitionBy(F.lit(1))
    raw = df.withColumn("__s", F.greatest(F.lit(1), F.bround(F.lit(total) * F.col(weight) / F.sum(weight).over(one))).cast("long"))
    raw = raw.withColumn("__d", F.lit(total) - F.sum("__s").over(one)).withColumn("__k", F.count("*").over(one))
    place = F.when(F.col("__d") < 0, F.row_number().over(one.orderBy(F.col(weight).desc(), order))).otherwise(F.row_number().over(one.orderBy(F.col(weight).asc(), order)))
    rounds = F.floor((F.abs(F.col("__d")) - place) / F.col("__k")) + 1
    return raw.withColumn("share", (F.col("__s") + F.signum(F.col("__d").cast("double")).cast("long") * F.greatest(F.lit(0), rounds)).cast("long")).drop("__s", "__d", "__k")

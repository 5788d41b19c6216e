"""Mergeable aggregates, running statistics and exact quantiles against numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica.operators import running as R
from episodica.operators.order import permuted, running
from episodica.operators.quantiles import exact_quantiles


def vectors(spark, rows, parts):
    return spark.createDataFrame(rows, "k string, v array<double>").repartition(parts)


def plain(values, q, bins):
    """Quantile by bins of the least power of two, counted afresh."""
    lo, hi = min(values), max(values)
    e = -60
    while math.floor(hi / 2.0**e) - math.floor(lo / 2.0**e) >= bins:
        e += 1
    counts = np.unique([math.floor(x / 2.0**e) for x in values], return_counts=True)
    return counts[0][np.searchsorted(np.cumsum(counts[1]), q * len(values))] * 2.0**e


def test_running_statistics_do_not_depend_on_order(spark):
    rng = random.Random(2)
    # the range grows with the row, so a state is re-binned many times
    rows = [(rng.choice(["a", "b", None]), [rng.gauss(0, 1 + i), -float(i), 0.5, 1e9 * rng.random()]) for i in range(700)]
    seen = []
    for parts, fan_in, shuffled in ((1, 64, False), (7, 2, True), (3, 64, True)):
        some = rng.sample(rows, len(rows)) if shuffled else rows
        out = R.running_statistics(vectors(spark, some, parts), "v", "k", quantiles=(0.01, 0.5, 0.99), bins=50, fan_in=fan_in)
        seen.append({(r["k"], r["dim"]): r for r in out.collect()})
    exact = ("n", "min", "max", "q01", "q50", "q99")
    for key, r in seen[0].items():
        own = np.array([v[key[1]] for k, v in rows if k == key[0]])
        assert all([r[c] == other[key][c] for c in exact for other in seen[1:]])
        assert np.allclose([[s[key]["mean"], s[key]["std"]] for s in seen], [own.mean(), own.std()], rtol=1e-9)
        assert (r["n"], r["min"], r["max"]) == (len(own), own.min(), own.max())
        assert [r[c] for c in ("q01", "q50", "q99")] == [plain(own.tolist(), q, 50) for q in (0.01, 0.5, 0.99)]
    assert len(seen[0]) == 12


def test_running_statistics_refuse(spark):
    run = lambda rows: R.running_statistics(vectors(spark, rows, 2), "v", "k").collect()
    for rows, said in (([("a", [1.0])], "two vectors"), ([("a", [1.0]), ("a", [1.0, 2.0])], "differ in length"), ([("a", [1.0]), ("a", [math.nan])], "not finite"), ([("a", [None]), ("a", [1.0])], "not finite")):
        with pytest.raises(Exception, match=said):
            run(rows)
    assert run([]) == []
    assert [(r["n"], r["mean"]) for r in run([("a", [1.0]), ("a", None), ("a", [3.0])])] == [(2, 2.0)]


def product_kind():
    """An aggregate of a user's: products and the number of rows."""

    class Product:
        reads = ("x",)
        schema = "product double, n long"

        def __init__(self, product, n):
            self.product, self.n = product, n

        @classmethod
        def of(cls, rows):
            values = rows.column("x").to_pylist()
            return cls(math.prod(values), len(values))

        @classmethod
        def stored(cls, row):
            return cls(row["product"], row["n"])

        def merge(self, other):
            return type(self)(self.product * other.product, self.n + other.n)

        def row(self):
            return {"product": self.product, "n": self.n}

        def size(self):
            return 1

    return Product


@pytest.mark.parametrize("held", [0, 10**6])
def test_aggregate_of_a_user(spark, held):
    df = spark.range(1, 13).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("x")).repartition(5)
    got = {r["k"]: (r["product"], r["n"]) for r in R.aggregate(df, product_kind(), "k", fan_in=2, held=held).collect()}
    assert got == {0: (math.prod(range(2, 13, 2)), 6), 1: (math.prod(range(1, 12, 2)), 6)}
    assert [(r["product"], r["n"]) for r in R.aggregate(df, product_kind()).collect()] == [(math.factorial(12), 12)]


@pytest.mark.parametrize("gathered, bins", [(10**6, 4096), (40, 64), (1, 256)])
def test_exact_quantiles(spark, gathered, bins):
    rng = random.Random(3)
    rows = [("ties", rng.choice([1.0, 2.0, 2.0, 5.0])) for _ in range(300)] + [("wide", rng.choice([-1, 1]) * 10.0 ** rng.randrange(-3, 4) * rng.random()) for _ in range(300)]
    rows += [(None, rng.gauss(0, 1)) for _ in range(301)] + [("one", 7.0), ("none", None), ("few", 1.0), ("few", 2.0)]
    qs = (0.0, 0.01, 0.25, 0.5, 0.99, 1.0)
    got = {r["k"]: [r[f"q{round(q * 100):02d}"] for q in qs] for r in exact_quantiles(spark.createDataFrame(rows, "k string, x double").repartition(3), "x", qs, "k", bins=bins, gathered=gathered).collect()}
    assert got.keys() == {"ties", "wide", None, "one", "few"}
    for k, found in got.items():
        assert np.allclose(found, np.quantile([x for y, x in rows if y == k], qs), rtol=1e-12)
    whole = exact_quantiles(spark.createDataFrame(rows[:300], "k string, x double"), "x", (0.5,), bins=bins, gathered=gathered).collect()
    assert [tuple(r) for r in whole] == [(np.quantile([x for _, x in rows[:300]], 0.5),)]
    assert exact_quantiles(spark.createDataFrame([], "k string, x double"), "x", (0.5,), "k", gathered=gathered).collect() == []


def test_running_sums_and_permutation(spark):
    rng = random.Random(4)
    rows = [(k, rng.randrange(9)) for k in rng.sample(range(10**6), 500)]
    got = {r["k"]: (r["place"], r["before"]) for r in running(running(spark.createDataFrame(rows, "k long, w long"), "k"), "k", amount=F.col("w"), name="before").collect()}
    before = 0
    for i, (k, w) in enumerate(sorted(rows)):
        assert got[k] == (i, before)
        before += w
    for n in (1, 2, 37, 1000):
        places = [r[0] for r in spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("long"), "seed")).collect()]
        assert sorted(places) == list(range(n))
        assert n < 30 or sum(i == p for i, p in enumerate(places)) < 8

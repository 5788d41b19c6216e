"""Tolerance matches against every pair, and without pairs."""

import random

import pytest
from pyspark.sql import functions as F

from episodica.operators import matching as M


@pytest.mark.parametrize("within, scale", [(100.0, 1.0), (0.1, 0.01), (0.3, 1e-3), (0.1, 1e9)])
def test_tolerance_is_exact(spark, within, scale):
    """The bound itself, both zeros, NaN, infinities, nulls and numbers far greater than the bound."""
    rng, inf = random.Random(4), float("inf")
    base = [round(rng.uniform(-500, 500), rng.choice((0, 1, 2, 9))) * scale for _ in range(120)]
    values = base + [x + s * within * k for x in base[:60] for s, k in ((1, 1), (-1, 1), (1, 2))] + [0.0, -0.0, within, -within, float("nan"), inf, -inf, None, 3 * within, 2 * within]
    values += [x * (1 + 2.0**-52) for x in values if x is not None]
    rng.shuffle(values)
    rows = [(i, rng.choice((1, 2, None)), v) for i, v in enumerate(values)]
    left, right = rows[::2], rows[1::2]
    want = {}
    for i, k, x in left:
        same = [(j, y) for j, n, y in right if k is not None and n == k]
        close = [j for j, y in same if x is not None and y is not None and abs(x - y) <= within]
        want[i] = (min(close or [j for j, _ in same], default=None), bool(close))
    df = lambda r, name: spark.createDataFrame(r, f"{name} long, len long, v double")
    got = {r["q"]: (r["demo"], r["close"]) for r in M.tolerance(df(left, "q"), df(right, "demo"), "q", "demo", "len", "v", within).collect()}
    assert got == want
    assert any(c for _, c in want.values()) and not all(c for _, c in want.values())


def test_tolerance_makes_no_pairs(spark):
    """20,000 values of one bin on either side would be 400 million pairs."""
    rows = spark.range(40000).select("id", F.lit(1).alias("len"), (F.col("id") / 1e5).alias("v"))
    got = M.tolerance(rows.where("id % 2 = 0"), rows.where("id % 2 = 1").withColumnRenamed("id", "demo"), "id", "demo", "len", "v", 1.0)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and [tuple(r) for r in got.agg(F.count("*"), F.max("demo"), F.min("close")).collect()] == [(20000, 1, True)]

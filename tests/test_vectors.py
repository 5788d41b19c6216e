"""Column functions on vectors against fixed cases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica.functions import vectors as V
from episodica.operators import statistics as S


@pytest.fixture(scope="module")
def one(spark):
    return lambda *c: spark.range(1).select(*c).first()


def vec(*x):
    return F.array(*(F.lit(float(v)) for v in x))


def test_shifts_of_some_elements(one):
    rows, base, mask = F.array(vec(9, -1, 0.5, 2), vec(0, 10, 20, 30)), vec(4, 0.5, 100, -2), [True, False, False, True]
    assert one(V.shift(rows, base, mask, -1))[0] == [[5, -1, 0.5, 4], [-4, 10, 20, 32]]
    assert one(V.shift(V.shift(rows, base, mask, -1), base, mask, 1))[0] == [[9, -1, 0.5, 2], [0, 10, 20, 30]]
    assert one(V.shift(rows, base, None, -1))[0] == [[9, -1, 0.5, 2], [0, 10, 20, 30]]
    assert one(V.shift(rows, base, [True], -1))[0] == [[5, -1, 0.5, 2], [-4, 10, 20, 30]]  # a mask may be shorter


def test_masks_of_runs():
    assert V.run_mask(-1, 3, -2, 1) == [False, True, True, True, False, False, True]
    assert V.run_mask() == V.run_mask(0) == []


def test_digitize(one):
    assert [one(V.digitize(F.lit(x)))[0] for x in (-1.5, -1.0, 0.0, 1.0)] == [-1, 0, 128, 255]


def test_pad_keeps_longer(one):
    assert one(V.pad(vec(1, 2), 4))[0] == [1, 2, 0, 0]
    assert one(V.pad(vec(1, 2, 3), 2))[0] == [1, 2, 3]


def test_permutation_is_undone(one):
    ranges = [(4, 6), (0, 3), (3, 4)]
    v = vec(*range(6))
    assert one(V.permute(V.permute(v, ranges), V.inverse_ranges(ranges)))[0] == list(range(6))


def test_small_rotation_series(one):
    q = one(V.quaternion_of(vec(1e-8, 0, 0)))[0]
    assert q == pytest.approx([1, 5e-9, 0, 0])
    m = one(V.matrix_of_six(V.six_of(vec(0, 0, math.pi / 2))))[0]
    assert m == pytest.approx([0, -1, 0, 1, 0, 0, 0, 0, 1], abs=1e-12)


def test_population_figures(spark):
    values = [2.0, -7.5, 11.25, 2.0, 0.0, 30.0, -1.0]
    df = spark.createDataFrame([([x, -x],) for x in values], "v array<double>").repartition(3)
    for r in S.summary(df, "v").collect():
        own = np.array(values) * (1 - 2 * r["dim"])
        assert [r[c] for c in ("mean", "std", "min", "max", "n")] == pytest.approx([own.mean(), own.std(), own.min(), own.max(), 7])
        assert [r["q01"], r["q99"]] == pytest.approx(np.quantile(own, [0.01, 0.99]))


def test_unknown_pooling(spark):
    with pytest.raises(ValueError):
        S.pooled(spark.range(1), "id", quantiles="median")


def test_rotations_there_and_back(spark):
    rows = [(0.1, -0.2, 0.3), (2.0, 1.0, -1.5), (0.0, 0.0, 0.0), (3.0, 0.2, 0.1), (0.0, math.pi - 1e-3, 0.0)]
    df = spark.createDataFrame([(list(r),) for r in rows], "a array<double>").withColumn("m", V.matrix_of(V.quaternion_of(F.col("a"))))
    df = df.withColumn("back", V.axis_angle_of(V.quaternion_of_matrix(F.col("m")))).withColumn("e", V.matrix_of_euler(V.euler_of_matrix(F.col("m"))))
    for r in df.collect():
        assert r["back"] == pytest.approx(r["a"], abs=1e-5) and r["e"] == pytest.approx(r["m"], abs=1e-9)


def test_relative_frame(one):
    turn = V.matrix_of_euler(vec(0, 0, math.pi / 2))
    pos, rot = V.relative(vec(1, 0, 0), turn, vec(1, 2, 0), turn)
    assert one(pos)[0] == pytest.approx([2, 0, 0], abs=1e-12) and one(rot)[0] == pytest.approx([1, 0, 0, 0, 1, 0, 0, 0, 1], abs=1e-12)

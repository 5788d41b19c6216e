"""Sequence operators against fixed cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica.operators import matching as M
from episodica.operators import segmentation as G
from episodica.operators import selection as C
from episodica.operators import sequences as Q


@pytest.fixture(scope="module")
def frames(spark):
    return lambda values, kind="double": spark.createDataFrame([(0, i, v) for i, v in enumerate(values)], f"ep long, frame long, v {kind}")


def column(df, name):
    return [r[name] for r in df.orderBy("frame").collect()]


def test_toggles(frames):
    assert column(Q.toggles(frames([0.0, 0.0, 1.0, 1.0, 0.0]), "v"), "toggle") == [0, 0, 2, 2, 4]
    assert column(Q.toggles(frames([2.0, 2.0]), "v"), "toggle") == [0, 0]


def test_fill(frames):
    df = frames([None, None, 3, None, 5, None], "long")
    assert column(df.withColumn("x", Q.fill(F.col("v"), Q.ordered())), "x") == [3, 3, 3, 3, 5, 5]


def test_first_difference(frames):
    df = frames([1.0, 4.0, 6.0])
    assert column(df.withColumn("x", Q.first_difference("v", Q.ordered())), "x") == [3, 3, 2]


def test_chunk(frames):
    assert column(Q.chunk(frames(["a", "b", "c"], "string"), "v", 2), "chunk") == [["a", "b"], ["b", "c"], ["c", "c"]]


@pytest.mark.parametrize("clamp,want", [(True, [10, 10, 30]), (False, [0, 10, 0])])
def test_gather(frames, clamp, want):
    df = Q.gather(frames([10.0, 20.0, 30.0]), "v", (-1, 0, 3), clamp).where("frame = 0").orderBy("delta")
    assert [r["got"] for r in df.collect()] == want


def test_keep_moving(spark):
    df = spark.createDataFrame([(0, i, m, g) for i, (m, g) in enumerate([(0.0, 0.0), (0.0, 0.0), (0.01, 0.0), (0.0, 1.0)])], "ep long, frame long, m double, g double")
    assert [(r["frame"], r["kept_frame"]) for r in Q.keep_moving(df, "m", "g").orderBy("frame").collect()] == [(0, 0), (2, 1), (3, 2)]


def test_spread_plan(spark):
    df = spark.createDataFrame([(0, i) for i in range(5)], "ep long, run long")
    assert [r["step"] for r in Q.spread_plan(df, "abc").orderBy("run").collect()] == ["a", "a", "b", "c", "c"]


def test_combined_ids_collide(spark):
    df = spark.createDataFrame([(0, 1, 0), (0, 0, 100)], "s long, o long, g long")
    assert [r[0] for r in df.select(Q.combined_id(F.col("s"), F.col("o"), F.col("g"))).collect()] == [100, 100]


def test_labels_are_repaired():
    assert G.repaired([0, 2, 1, 2], [5, 1, 5, 5]) == [0, 0, 1, 2]
    assert G.repaired([-1, -1], [1, 1]) == [-1, -1]
    assert G.heaviest_ascent([1, 0], [1, 1]) == [0]


def test_ascent_is_heaviest():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = int(rng.integers(1, 8))
        places, weights = rng.integers(-1, 4, n).tolist(), rng.integers(1, 5, n).tolist()
        got = G.heaviest_ascent(places, weights)
        best = max(sum(weights[i] for i in s) for s in _subsequences(places))
        assert sum(weights[i] for i in got) == best
        assert all(places[a] <= places[b] for a, b in zip(got, got[1:], strict=False))


def _subsequences(places):
    for bits in range(1 << len(places)):
        s = [i for i in range(len(places)) if bits >> i & 1]
        if all(places[i] >= 0 for i in s) and all(places[a] <= places[b] for a, b in zip(s, s[1:], strict=False)):
            yield s


def test_density_clusters():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(0, 0.1, (30, 2)), rng.normal(5, 0.1, (30, 2))])
    labels = G.hdbscan(G.Frames(x, np.zeros(60)), 5)
    first, second = set(labels[:30].tolist()) - {-1}, set(labels[30:].tolist()) - {-1}
    assert len(first) == len(second) == 1 and first != second


@pytest.mark.parametrize("pace", [0.0, 0.01, 3.0])
def test_core_distances_and_tree_as_from_a_matrix(pace):
    """Windows of time and rows on demand give what the whole matrix of distances gives."""
    rng = np.random.default_rng(2)
    x, t = rng.normal(size=(80, 3)).cumsum(axis=0), pace * np.sort(rng.integers(0, 200, 80))
    frames = G.Frames(x, t)
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) + np.abs(t[:, None] - t[None])
    for k in (1, 4, 80):
        assert np.allclose(frames.core(k), np.sort(far, axis=1)[:, k - 1])
    core = frames.core(4)
    reach = np.maximum(np.maximum(core[:, None], core[None]), far)
    edges = G._spanning_tree(frames, core)
    # the least spanning tree's edges, sorted, are the same whatever tree of least weight it is
    root, weights = list(range(80)), []
    for w, i, j in sorted((reach[i, j], i, j) for i in range(80) for j in range(i)):
        while root[i] != i:
            i = root[i]
        while root[j] != j:
            j = root[j]
        if i != j:
            root[i] = j
            weights.append(w)
    assert np.allclose([e[0] for e in edges], weights)


def test_ascent_prefers_the_earliest():
    """Against the definition, one predecessor at a time."""
    rng = np.random.default_rng(1)
    for _ in range(200):
        n = int(rng.integers(1, 40))
        places, weights = rng.integers(-1, 6, n).tolist(), rng.integers(1, 4, n).tolist()
        total, link = [0] * n, [-1] * n
        for i in range(n):
            before = [j for j in range(i) if 0 <= places[j] <= places[i]]
            link[i] = max(before, key=lambda j: (total[j], -j), default=-1)
            total[i] = (weights[i] + (total[link[i]] if before else 0)) if places[i] >= 0 else 0
        want, at = [], max(range(n), key=lambda i: (total[i], -i)) if max(places) >= 0 else -1
        while at >= 0:
            want.append(at)
            at = link[at]
        assert G.heaviest_ascent(places, weights) == want[::-1]
    assert len(G.heaviest_ascent(list(range(50_000)), [1] * 50_000)) == 50_000  # not the square of an episode


def test_shuffled_prefix(spark):
    df = spark.range(20).select((F.col("id") * 3).alias("k"), F.col("id").alias("x"))
    df = df.unionByName(df)
    pick = lambda n, seed: sorted({r["k"] for r in C.shuffled_prefix(df, "k", n, seed).collect()})
    assert len(pick(50, 0)) == 20 and len(pick(6, 3)) == 6 and pick(6, 3) == pick(6, 3) != pick(6, 4)
    assert set(pick(4, 3)) < set(pick(9, 3)) and C.shuffled_prefix(df, "k", 6, 3).count() == 12


def test_batches_drop_the_last(spark):
    df = C.batches(spark.range(1003).withColumnRenamed("id", "k"), "k", 4, 0)
    assert sorted((r["batch"], r["count"]) for r in df.groupBy("batch").count().collect()) == [(i, 4) for i in range(250)]


def _one_key(spark, n):
    rng = np.random.default_rng(n)
    left = [(None if i % 11 == 0 else "hot", int(rng.integers(0, 60)), i) for i in range(n)] + [("alone", 3, 1000), ("hot", None, 1001)]
    right = [(None if i % 5 == 0 else "hot", int(rng.integers(0, 50)), i) for i in range(n // 4)] + [("other", 3, 1)]
    return left, right, spark.createDataFrame(left, "k string, t long, id long").repartition(3), spark.createDataFrame(right, "k string, t long, v long").repartition(2)


@pytest.mark.parametrize("n", [4, 40, 400])
def test_matches_within_one_key(spark, n):
    """A key that holds nearly all rows, with ties, over several ranges."""
    left, right, l_df, r_df = _one_key(spark, n)
    want_near, want_last = {}, {}
    for k, t, i in left:
        own = [(x, v) for y, x, v in right if y == k] if t is not None else []
        near = min(own, key=lambda r: (abs(r[0] - t), r[0], r[1]), default=(None, None))
        want_near[i] = near
        want_last[i] = max(((x, v) for x, v in own if x <= t), default=(None, None))[1]
    got = {r["id"]: (r["matched_t"], r["matched_v"]) for r in M.nearest(l_df, r_df, "k", "t", "v").collect()}
    assert got == want_near
    assert {r["id"]: r["v"] for r in M.intervals(l_df, r_df, "k", "t", "t", "v").collect()} == want_last


def test_few_candidates_of_token_matches(spark):
    """Rows that share frequent tokens alone are no candidates, and none that reaches the threshold is lost."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        own = set(rng.integers(100, 4000, 6).tolist()) | set(rng.integers(0, 8, 4).tolist())
        rows += [(i, str(t)) for t in own] + ([(i + 1000, str(t)) for t in sorted(own)[1:]] if i % 3 == 0 else [])
    words = spark.createDataFrame(rows, "id long, token string")
    n = len({i for i, _ in rows})
    df = {}
    for _, t in set(rows):
        df[t] = df.get(t, 0) + 1
    weight = {t: float(np.log(n / (1 + c)) + 1) for t, c in df.items()}
    idf = spark.createDataFrame(list(weight.items()), "token string, idf double")
    sets = {}
    for i, t in rows:
        sets.setdefault(i, set()).add(t)
    score = lambda a, b: sum(weight[t] for t in a & b) / sum(weight[t] for t in a | b)
    left, right = words.where("id < 1000"), words.where("id >= 1000")
    want = {(a, b): score(sets[a], sets[b]) for a in sets if a < 1000 for b in sets if b >= 1000 and score(sets[a], sets[b]) >= 0.35}
    best = {a: max(s for (x, _), s in want.items() if x == a) for a, _ in want}
    want = {p: s for p, s in want.items() if s >= best[p[0]] - 0.1}
    got = {(r["left_id"], r["right_id"]): r["score"] for r in M.token_matches(left, right, idf).collect()}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-9 for p in want)
    weigh = lambda d, name: d.join(idf, "token").select(F.col("id").alias(name), "token", F.col("idf").alias("w"))
    met = M.prefix_candidates(weigh(left, "left_id"), weigh(right, "right_id"), 0.35).count()
    sharing = sum(bool(sets[a] & sets[b]) for a in sets if a < 1000 for b in sets if b >= 1000)
    assert len(want) <= met < sharing / 20


def test_groups_of_any_size_are_spread(spark):
    """Groups of no, one and many members, ids of no group and null; blocks of a few, several tasks for one group."""
    members = {-1: [7], -2: list(range(100, 125)), -3: [], -4: None}
    groups = spark.createDataFrame(list(members.items()), "group long, members array<long>")
    rows = [(p, (-1, -2, -3, -4, -5, 6, None)[p % 7]) for p in range(140)] + [(3, -2), (3, -2)]
    ids = spark.createDataFrame(rows, "pos long, id long")
    want = []
    for p, i in rows:
        own = members.get(i)
        want += [(p, at, m) for at, m in enumerate([i] if own is None else own)]
    met = C.expand_groups(ids, groups, block=4, meeting=3)
    key = lambda r: (r[0], r[1], r[2] is None, r[2] or 0)
    assert sorted((tuple(r) for r in met.select("pos", "at", "member").collect()), key=key) == sorted(want, key=key)
    assert sorted((tuple(r) for r in C.expand_groups(ids, groups).select("pos", "at", "member").collect()), key=key) == sorted(want, key=key)

"""Operator 12 against brute force, with the ways that large inputs take forced by small bounds."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica.llm.jaccard import BITS, _faced, _met, _near, _Texts, jaccard_components
from episodica.llm.queries import OP12_SQL
from episodica.llm.text import CHUNK_BYTES


def grams(text, k=5):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(rows):
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 5 * len(a & b) >= 4 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted((str(d), len(sets[i]), str(least.get(find(i)) if sets[i] else d)) for i, (d, _) in enumerate(rows))


def corpus(seed=5):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = rng.choices(words, k=40)
    rows = []
    for group in range(25):
        base = rng.choices(words, k=rng.choice([3, 5, 8, 9, 12, 30, 60, 200]))
        for _ in range(rng.choice([1, 2, 5, 12])):
            new = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                new[rng.randrange(len(new))] = rng.choice(words)
            if rng.random() < 0.3:
                new += rng.choices(words, k=rng.choice([1, 2, 10]))
            rows.append(" ".join(new))
    for _ in range(60):  # texts that share a passage, around the similarity
        rows.append(" ".join(passage + rng.choices(words, k=rng.choice([2, 4, 6, 9, 14]))))
    rows += ["", " \t ", None, "one", "ONE", "a b c d e", "A B C D E", "É b c d e f", "é b c d e f", "a b c"]
    rng.shuffle(rows)
    out = [(1000 - i, t) for i, t in enumerate(rows)]
    return [*out, out[3], (7, out[9][1]), (7, out[10][1]), (None, out[11][1]), (None, "only null ids here and no other row"), (None, None)]


@pytest.mark.parametrize("bounds", [{}, {"frequent": 3, "places": 40, "rounds": 3, "split": 2, "meetings": 1}, {"frequent": 2, "places": 5, "rounds": 1, "split": 1, "meetings": 0}])
def test_against_brute_force(spark, bounds):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n": F.lit("x"), "hi": F.lit(1), "token": F.lit(2), "component_id": F.lit(3)}).repartition(3)
    out = jaccard_components(df, **bounds)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((str(a), b, str(c)) for a, b, c in out.collect()) == brute(rows)


def test_pairs_do_not_come_at_each_shared_shingle(spark):
    """Sets that share a run of shingles face each other at its beginning alone, and again after a break."""
    sets = {1: range(40), 2: range(40), 3: [*range(100, 110), *range(10, 40)]}
    rows = [(token, lo, at) for lo, tokens in sets.items() for at, token in enumerate(tokens)]
    placed = spark.createDataFrame(rows, "token long, lo long, at long").select("token", F.lit(0).cast("long").alias("hi"), "lo", F.lit(400).cast("long").alias("n"), "at", *(F.lit(0).cast("long").alias(b) for b in BITS), F.expr("struct(0L AS hi, lo) AS root"))
    found = [(r["a"]["lo"], r["b"]["lo"]) for r in _faced(placed, (4, 5)).collect()]
    assert set(found) == {(1, 2), (1, 3), (2, 3)} and len(found) <= 2 * 3


def test_empty_table_and_null_texts(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_components(empty).collect() == []
    nulls = spark.createDataFrame([(1, None), (2, None), (None, None)], "doc_id long, text string")
    assert sorted(map(str, (tuple(r) for r in jaccard_components(nulls).collect()))) == ["(1, 0, 1)", "(2, 0, 2)", "(None, 0, None)"]


def test_long_texts(spark):
    rng = random.Random(1)
    long = [str(rng.randrange(10**6)) for _ in range(CHUNK_BYTES // 5)]
    rows = [(1, " ".join(long)), (2, " ".join(long[: len(long) * 85 // 100])), (3, " ".join(long[: len(long) // 2])), (4, "x" * (CHUNK_BYTES + 9))]
    assert len(rows[0][1]) > CHUNK_BYTES
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(a), b, str(c)) for a, b, c in got) == brute(rows)


def test_sql(spark, sf_dir):
    rows = [(d, t) for d, t in corpus(8) if d is not None]
    rows = list({d: t for d, t in rows}.items())
    df = spark.createDataFrame(rows, "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    assert sorted(con.sql(OP12_SQL).fetchall()) == sorted(map(tuple, jaccard_components(df).collect()))


def test_pairs_pass_sketches_before_their_sets_meet(spark):
    """Of long sets that share the shingles of their prefixes, but not the similarity, the short sketch tells too little."""
    rng = random.Random(2)
    words = lambda n: [str(rng.randrange(10**6)) for _ in range(n)]
    base = words(1500)
    texts = [base, base[:1400] + words(100), base[:800] + words(700)]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = _Texts(df, "doc_id", "text", 5, (4, 5)).rows().localCheckpoint()
    node = {r["id"]: F.struct(F.lit(r["hi"]).alias("hi"), F.lit(r["lo"]).alias("lo")) for r in rows.collect()}
    pairs = spark.range(1).select(F.explode(F.array(*(F.struct(node[0].alias("a"), node[i].alias("b")) for i in (1, 2)))).alias("p")).select("p.*")
    ids = {(r["hi"], r["lo"]): r["id"] for r in rows.collect()}
    assert [ids[r["b"]["hi"], r["b"]["lo"]] for r in _near(pairs, rows, (4, 5)).collect()] == [1]
    pair = rows.where("id = 0").crossJoin(rows.where("id = 2").select(*(F.col(c).alias(f"x_{c}") for c in ("n", *BITS)))).withColumns({"at": F.lit(0), "x_at": F.lit(0)})
    assert pair.where(_met((4, 5))).count() == 1  # which is why the fine one is there


@pytest.mark.parametrize("keys", [0, 10**6])
def test_sets_are_read_once_by_either_way(spark, keys):
    df = spark.createDataFrame(corpus(), "doc_id long, text string").repartition(3)
    for some in (df, df.where("doc_id is not null")):
        texts = _Texts(some, "doc_id", "text", 5, (4, 5), keys)
        rows = texts.rows().where("n > 0").localCheckpoint()
        sets = texts.sets(rows.select("hi", "lo").distinct(), rows, (np.zeros(0, np.uint64), np.zeros(0, np.int32)))
        got = [tuple(r) for r in sets.where("n > 0").select("hi", "lo", "n").collect()]
        assert sorted(got) == sorted(tuple(r) for r in rows.select("hi", "lo", "n").distinct().collect())


def test_shuffled_keys_against_brute_force(spark):
    rows = corpus(9)
    out = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), keys=0)
    assert sorted((str(a), b, str(c)) for a, b, c in out.collect()) == brute(rows)

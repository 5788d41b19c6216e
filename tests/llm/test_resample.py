"""Operator 13 against plain counting in Python, and its SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from episodica.llm.queries import OP13_SQL
from episodica.llm.resample import importance_resample
from episodica.llm.text import CHUNK_BYTES

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, shortest, longest):
    words = WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return words, [" ".join(words[i : i + n]) for n in range(shortest, longest + 1) for i in range(len(words) - n + 1)]


def brute(docs, targets, shortest, longest, buckets, percent, least):
    bucket = lambda g: zlib.crc32(g.encode()) % buckets
    s, t = (Counter(bucket(g) for x in texts for g in features(x, shortest, longest)[1]) for texts in ([x for _, x in docs], targets))
    S, T = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    rows = []
    for d, text in docs:
        words, grams = features(text, shortest, longest)
        weight = sum(gain[bucket(g)] for g in grams)
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, len(grams), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words)])
    eligible = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[2], r[1]))
    for i, r in enumerate(eligible[: percent * len(eligible) // 100]):
        r[4] = i + 1
    return sorted(str(tuple(r[:5])) for r in rows)


def corpus():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(200)] + ["É", "straße", "Don't", "A_b"]
    docs = [(i, rng.choice([" ", "\n", ", "]).join(rng.choices(words, k=rng.choice([3, 19, 20, 21, 80])))) for i in range(120)]
    docs += [(200, None), (201, ""), (202, "-- !!"), (203, "x" * (CHUNK_BYTES + 5)), (204, "a b " * (CHUNK_BYTES // 3)), docs[7], docs[7], (7, docs[9][1]), (None, docs[4][1]), (None, None)]
    return docs, [" ".join(rng.choices(words[:60], k=30)) for _ in range(20)] + [None, ""]


@pytest.mark.parametrize("shortest, longest, percent", [(1, 1, 10), (1, 2, 50), (2, 3, 100)])
def test_against_brute_force(spark, shortest, longest, percent):
    docs, targets = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"score": F.lit("clash"), "r": F.lit(1), "w": F.lit(2), "id": F.lit(3)}).repartition(3)
    out = importance_resample(df, spark.createDataFrame([(t, 1) for t in targets], "text string, bucket int"), shortest=shortest, longest=longest, buckets=500, percent=percent)
    assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(str(tuple(r)) for r in out.collect()) == brute(docs, targets, shortest, longest, 500, percent, 20)


def test_empty_tables(spark):
    docs, targets = corpus()
    df, target = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(t,) for t in targets], "text string")
    assert importance_resample(df.limit(0), target).collect() == []
    got = importance_resample(df, target.limit(0), shortest=1, longest=1).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(docs, [], 1, 1, 10_000, 10, 20)


def test_sql(spark):
    docs, targets = corpus()
    docs = list({d: t for d, t in docs if d is not None and (d != 204 and d != 203)}.items())
    df, target = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(t,) for t in targets], "text string")
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    con.register("benchmark", target.toPandas())
    got = importance_resample(df, target, shortest=1, longest=1)
    assert sorted(str(r) for r in con.sql(OP13_SQL).fetchall()) == sorted(str(tuple(r)) for r in got.collect()) == brute(docs, targets, 1, 1, 10_000, 10, 20)

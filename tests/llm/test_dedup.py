"""Operators 4, 7 and 8, and components, against brute force."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from episodica.llm.components import components
from episodica.llm.decontam import decontaminate
from episodica.llm.lines import line_dedup
from episodica.llm.queries import OP4_SQL
from episodica.llm.simhash import fingerprint, near_duplicates


def edits_one(a, b):
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def test_line_dedup(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcd é") for _ in range(n)) for n in (20, 21, 63, 64, 65, 127, 128, 129, 200)]

    def changed(s):
        i, k = rng.randrange(len(s)), rng.choice("nnsid")
        return {"n": s, "s": s[:i] + rng.choice("abz") + s[i + 1 :], "i": s[:i] + rng.choice("abz") + s[i:], "d": s[:i] + s[i + 1 :]}[k]

    rows = [(d, "\n".join(changed(changed(rng.choice(base))) if rng.random() < 0.8 else rng.choice(["", "x", "short"]) for _ in range(rng.randint(1, 6)))) for d in range(90)]
    rows += [(200, None), (201, ""), (202, "x" * 3000), (203, "x" * 3001), (204, "\n\n"), (None, base[3]), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("line", F.lit("clash")).withColumn("th", F.lit(1))
    hashes = {(r[0], r[1]): r[2] for r in df.select("doc_id", "text", F.xxhash64("text")).collect()}
    seen, want = [], {}
    for x in sorted({x for x in rows if x[1] is not None}, key=lambda x: (x[0] is not None, x[0] or 0, hashes[x])):
        kept = []
        for line in x[1].split("\n"):
            if not line.strip(" "):
                kept.append(line)
                continue
            if not any(edits_one(line, s) for s in seen):
                kept.append(line)
            seen.append(line)
        want[x] = "\n".join(kept)
    got = sorted((str(r["doc_id"]), str(r["text"])) for r in line_dedup(df).collect())
    assert got == sorted((str(x[0]), str(want.get(x))) for x in rows)
    assert line_dedup(df).columns == ["doc_id", "text", "line", "th", "__lines", "__removed"]
    assert line_dedup(df.limit(0)).count() == 0


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def least_reachable(n, linked):
    parent = list(range(n))
    for a in range(n):
        for b in range(a):
            if linked(a, b):
                x, y = a, b
                while parent[x] != x:
                    x = parent[x]
                while parent[y] != y:
                    y = parent[y]
                parent[max(x, y)] = min(x, y)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    return [root(i) for i in range(n)]


@pytest.mark.parametrize("bucket", [64, 0])
def test_near_duplicates(spark, bucket):
    """With a bucket bound of 0 every fingerprint goes the way of crowded buckets."""
    rng = random.Random(1)
    words = [f"w{i}É" for i in range(60)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice((1, 2, 3, 120)))) for _ in range(12)]
    rows = []
    for _ in range(90):
        t = rng.choice(texts).split()
        if len(t) > 5 and rng.random() < 0.7:
            t[rng.randrange(len(t))] = rng.choice(words)
        rows.append((" ".join(t)).replace("w1É", "W1É"))
    rows += ["", "  \n", "\x1cword one\x1f two three", rows[0], rows[0]]
    df = spark.createDataFrame([*enumerate(rows), (len(rows), None)], "doc_id long, text string").withColumn("component_id", F.lit("clash"))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in near_duplicates(df, bucket=bucket).collect()}
    prints = [plain_print(t) for t in [*rows, None]]
    roots = least_reachable(len(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert got == {i: (f"{p:016x}", roots[i]) for i, p in enumerate(prints)}
    assert near_duplicates(df.limit(0)).count() == 0


def test_crowded_chain(spark, monkeypatch):
    """Distinct fingerprints in one bucket, two bits apart from the next only: one component."""
    from episodica.llm import simhash

    prints = [(1 << 2 * i) - 1 for i in range(16)] + [7 << 58]
    df = spark.createDataFrame(list(enumerate(prints)), "__id long, __print long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: df)
    for bucket in (64, 3):
        got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(df.withColumn("doc_id", F.lit(0)), bucket=bucket).collect()}
        assert got == {**{i: 0 for i in range(16)}, 16: 16}


def test_null_ids(spark):
    df = spark.createDataFrame([(None, "a b c"), (7, "a b c"), (None, "other words here")], "doc_id long, text string")
    assert sorted((str(r[0]), str(r[2])) for r in near_duplicates(df).collect()) == [("7", "7"), ("None", "7"), ("None", "None")]


def test_empty_fingerprint():
    assert fingerprint(b"") == 0


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 200, (120, 2))] + [(300 + i, 301 + i) for i in range(40)]
    linked = {frozenset(e) for e in edges}
    roots = least_reachable(400, lambda a, b: frozenset((a, b)) in linked)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: roots[n] for e in edges for n in e if e[0] != e[1]}


@pytest.fixture(scope="module")
def bench_case(spark):
    rng = random.Random(4)
    word = lambda: rng.choice(["Ab", "cd", "é9", "x", "Yz", "q1", "rr", "ÉÉ"])
    items = [(i, rng.choice([" ", ", ", "--"]).join(word() for _ in range(rng.choice((1, 3, 9, 10, 11, 14, 30))))) for i in range(25)]
    items += [(30, None), (31, "..."), (0, items[0][1]), (32, items[3][1])]
    docs = []
    for d in range(120):
        text = " ".join(f"{word()}{rng.randint(0, 99)}" for _ in range(rng.randint(0, 30)))
        if rng.random() < 0.6:
            inner = (rng.choice(items)[1] or "").split(" ")
            cut = rng.randint(0, 2)
            text += " " + " ".join(inner[cut:]).upper() + " tail"
        docs.append((d, text))
    docs += [(500, None), (501, ""), (502, "?!"), (7, docs[7][1])]
    return docs, items


@pytest.mark.parametrize("words", [4_000_000, 0])
def test_decontaminate(spark, bench_case, words):
    """Both ways, broadcast and joined, against windows compared one by one."""
    docs, items = bench_case
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: pattern.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for i, t in items:
        w = split(t)
        n = min(10, len(w))
        for p in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[p : p + n]), set()).add(i)
    want = []
    for d, t in docs:
        w, hit, found = split(t), set(), set()
        for n in {len(x) for x in windows}:
            for p in range(len(w) - n + 1):
                if (x := tuple(w[p : p + n])) in windows:
                    hit |= set(range(p, p + n))
                    found |= windows[x]
        want.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)))
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_hit", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate(df, bench, broadcast_words=words)
    assert sorted(map(tuple, out.collect())) == sorted(want)
    assert decontaminate(df.limit(0), bench, broadcast_words=words).count() == 0
    assert {r["contaminated"] for r in decontaminate(df, bench.limit(0), broadcast_words=words).collect()} == {False}


def test_decontaminate_sql(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    want = sorted(con.sql(OP4_SQL).fetchall())
    got = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("distance, segments", [(11, 4), (8, 3), (11, 3)])
def test_near_copies(spark, sf_dir, distance, segments):
    """All pairs of similarity 0.8 within the distance and no others, against every pair; most pairs of that similarity."""
    from episodica.llm.simhash import _sets, _set_prints, near_copies
    from episodica.llm.text import chunks

    rng = random.Random(5)
    texts = [None, "", " ", "one two", "One  two", "one two three", "a a a a a a", "A a a a a a a a"]
    for size in (6, 30, 80, 200):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        texts += [" ".join(base), " ".join(base).upper()]
        for _ in range(20):
            own = list(base)
            for _ in range(rng.randint(1, max(2, size // 25))):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(own[rng.randint(0, 2) :]))
    for t in list(texts[8:]):  # chains of small steps
        texts.append((t + " and some more words")[rng.randint(0, 9) :])
    texts += [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]

    def plain(t):
        words = (t or "").encode().lower().split()
        n = min(5, len(words))
        return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()

    prints = np.concatenate([_set_prints(*_sets(c, 5))[0] for c in chunks(__import__("pyarrow").array(texts))]).tolist()
    sets = [plain(t) for t in texts]
    similar = lambda a, b: a == b or bool(a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b))
    pairs = {(i, j) for i in range(len(sets)) for j in range(i) if similar(sets[i], sets[j])}
    near = {(i, j) for i, j in pairs if sets[i] == sets[j] or ((prints[i] ^ prints[j]) & (1 << 64) - 1).bit_count() <= distance}
    assert len(near) > (0.8 if distance == 11 else 0.5) * len(pairs)
    roots = least_reachable(len(sets), lambda a, b: (a, b) in near)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({"print": F.lit("clash"), "node": F.lit(0)})
    got = {r["doc_id"]: r["component_id"] for r in near_copies(df, "doc_id", distance=distance, segments=segments).collect()}
    assert got == dict(enumerate(roots))
    assert near_copies(df.limit(0), "doc_id").count() == 0


def test_large_group_makes_no_pairs(spark):
    """A group of near copies meets its least node alone; its pairs are not made."""
    from episodica.llm import simhash

    rng = random.Random(8)
    base = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    texts = []
    for i in range(300):
        own = list(base)
        own[rng.randrange(len(own))] = f"x{i}"
        texts.append(" ".join(own))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    nodes = simhash._described(df, "doc_id", "text", 5).select("print", "digest", "n").distinct()
    stars = simhash._stars(nodes.select("print", "digest"), 11, 4)
    assert stars.count() < 300
    assert simhash._across(nodes, components(stars), 11, 4, (4, 5)).count() < 300
    assert {r["component_id"] for r in simhash.near_copies(df, "doc_id").collect()} == {0}


def _stars_of(distance, segments):
    from episodica.llm import simhash

    def plan(prints):
        nodes = prints.select(F.col("__print").alias("print"), F.col("__print").alias("digest"), F.lit(9).cast("long").alias("n"))
        entries = simhash._entries(nodes, segments, distance // segments // 2)
        return simhash._met(entries, entries.groupBy("key").count(), "key")

    return plan


@pytest.mark.parametrize("make", [lambda p: __import__("episodica.llm.simhash", fromlist=["_links"])._links(p, 64), _stars_of(11, 4)])
def test_exploded_rows_are_not_broadcast(spark, make):
    """Spark takes an exploded row for one, so by its estimate it would send balls of any number through the driver."""
    prints = spark.range(2000).select(F.xxhash64("id").alias("__print"))
    plan = make(prints)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "SortMergeJoin" in plan
    assert all("LeftAnti" in line for line in plan.splitlines() if "BroadcastHashJoin" in line)  # of crowded buckets alone


@pytest.mark.parametrize("distance, segments", [(11, 4), (8, 3), (11, 3), (3, 4)])
def test_near_pairs_have_one_meeting(spark, distance, segments):
    """Two near fingerprints share the key under which they are paired, in the table and among the probes."""
    from episodica.llm import simhash

    rng, radius = random.Random(3), distance // segments
    pairs = []
    for i in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), i % (distance + 1)):
            b ^= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    df = spark.createDataFrame(pairs, "a long, b long").distinct()
    met = df.withColumn("meeting", simhash._meeting(F.col("a"), F.col("b"), segments, radius))
    sides = lambda c, r: simhash._entries(df.select("a", "b", F.col(c).alias("print")), segments, r).select("a", "b", F.col("key").alias("meeting"))
    both = met.join(sides("a", radius // 2), ["a", "b", "meeting"]).join(sides("b", radius - radius // 2), ["a", "b", "meeting"])
    assert both.count() == df.count()

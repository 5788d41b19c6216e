"""Operator 11 against plain loops over rows, and its SQL."""

import itertools
import random
import re

import duckdb
from pyspark.sql import functions as F

from episodica.llm.audit import filter_audit
from episodica.llm.queries import OP11_SQL
from episodica.llm.text import CHUNK_BYTES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def failures(doc_id, text, docs):
    text = text or ""
    words = WORDS.findall(text)
    out = set()
    if len(words) < 200:
        out.add("A")
    if 100 * len(set(words)) < 50 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text):
        out.add("C")
    if re.search(r"[#$%&*|]", text):
        out.add("D")
    if doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _ in docs):
        out.add("E")
    return out


def brute(docs, labels):
    good, toxic = ({d for d, *x in labels if d is not None and x[i] == 1} for i in (0, 1))
    out = []
    rows = [(lang or "", failures(d, t, docs), d in good, d in toxic) for d, t, lang in docs]
    for part in {r[0] for r in rows}:
        own, total, lines = [r for r in rows if r[0] == part], dict.fromkeys("ABCDE", 0), []
        for order in itertools.permutations("ABCDE"):
            left = list(own)
            for step, f in enumerate(order, 1):
                removed = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                bad = [r for r in own if f in r[1]]
                total[f] += len(removed)
                lines.append((f, (part, "".join(order), step, len(left), len(removed), len(bad) - len(removed), sum(r[1] == {f} for r in own), sum(r[2] for r in removed), sum(r[3] for r in removed))))
        out += [(*line, total[f]) for f, line in lines]
    return sorted(out)


def corpus():
    rng = random.Random(4)
    texts = [None, "", " \n\t", "A", "a $ b", "É" * 40, "x " * 500, "y " * (CHUNK_BYTES // 2 + 7)]
    for _ in range(60):
        n, vocabulary = rng.choice([150, 199, 200, 201, 400]), rng.choice([60, 100, 130, 4000])
        text = rng.choice([" ", "\n", " \t"]).join(rng.choice(["w", "W", "Wé"]) * (rng.random() < 0.1) + str(rng.randrange(vocabulary)) for _ in range(n))
        texts.append(text + rng.choice(["", "", " #", "|", " *x"]))
    docs = [(i, t, rng.choice(["en", "de", "fr", None, ""])) for i, t in enumerate(texts)]
    docs += [(100 + i, rng.choice(texts), rng.choice(["en", "de"])) for i in range(40)]
    docs += [docs[10], docs[10], (10, docs[10][1], "de"), (10, "another text of a known id", "en"), (None, docs[9][1], "en"), (None, docs[9][1], "en"), (None, "z", None)]
    labels = [(rng.choice([None, *range(140)]), rng.choice([0, 1, None]), rng.choice([0, 0, 1, None])) for _ in range(90)]
    return docs, labels


def test_against_brute_force(spark):
    docs, labels = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns({"part": F.lit("clash"), "id": F.lit(1), "quality": F.lit(1), "n": F.lit(2)}).repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumns({"text": F.lit("clash"), "lang": F.lit("xx")})
    out = filter_audit(df, lab)
    assert out.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, out.collect())) == brute(docs, labels)


def test_sql_and_empty_tables(spark):
    docs, labels = corpus()
    df, lab = spark.createDataFrame(docs, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    con = duckdb.connect()
    con.register("documents", df.toPandas().astype({"doc_id": "Int64"}))
    con.register("labels", lab.toPandas().astype("Int64"))
    assert sorted(con.sql(OP11_SQL).fetchall()) == brute(docs, labels)
    assert filter_audit(df.limit(0), lab).collect() == []
    assert sorted(map(tuple, filter_audit(df, lab.limit(0)).collect())) == brute(docs, [])

"""Records, transforms and further sources against fixed cases."""

import gzip

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from episodica.functions import records as R
from episodica.functions import texts
from episodica.operators import transforms as X
from episodica.sources import datasets as D


ORDERS = "struct<id: long, sum: struct<net: double, tax: double>, where: struct<town: struct<name: string, code: int>, lane: string>>"


@pytest.fixture
def orders(spark):
    rows = [((7, (10.0, 2.0), (("Ulm", 89), "Hafengasse")), 1), ((8, (5.5, None), None), 2), (None, 3)]
    return spark.createDataFrame(rows, f"bill {ORDERS}, n int")


def test_records_are_repacked(orders):
    out = R.repack(orders, {"total": {"net": "bill/sum/net", "n": "n"}, "town": "bill/where/town"})
    assert out.schema.simpleString() == "struct<total:struct<net:double,n:int>,town:struct<name:string,code:int>>"
    assert [r.asDict(True) for r in out.collect()] == [{"total": {"net": 10.0, "n": 1}, "town": {"name": "Ulm", "code": 89}}, {"total": {"net": 5.5, "n": 2}, "town": None}, {"total": {"net": None, "n": 3}, "town": None}]
    for missing in ("bill/su", "bill/sum/gross", "m"):
        with pytest.raises(KeyError):
            R.repack(orders, {"x": missing})
    assert R.flat(orders).columns == ["bill/id", "bill/sum/net", "bill/sum/tax", "bill/where/town/name", "bill/where/town/code", "bill/where/lane", "n"]
    assert sorted(map(tuple, R.pairs(orders.where("n = 1").select("bill.sum", "n"), "n").collect())) == [(1, "sum/net", "10.0"), (1, "sum/tax", "2.0")]


def test_records_are_renamed(orders):
    out = R.rename(orders, {"bill/where/town/(n.*|c.*)": r"place/\1", "bill/where/.*": None, ".*/(net|tax)": r"money/\1", "bill/sum/net": "never"})
    assert out.schema.simpleString() == "struct<bill:struct<id:bigint>,money:struct<net:double,tax:double>,place:struct<name:string,code:int>,n:int>"
    assert out.first().asDict(True) == {"bill": {"id": 7}, "money": {"net": 10.0, "tax": 2.0}, "place": {"name": "Ulm", "code": 89}, "n": 1}
    assert R.rename(orders, {"bill/.*": None}).columns == ["n"]
    assert R.rename(orders, {"ill/id": "x"}).schema == R.rename(orders, {}).schema  # a part of a path is no match


@pytest.mark.parametrize("patterns, said", [({"bill/sum/.*": "money"}, "two paths become money"), ({"n": "bill/id"}, "two paths become bill/id"), ({"n": "bill"}, "bill is a leaf"), ({"n": "bill/id/more"}, "bill/id is a leaf"), ({"bill/where/lane": "bill/where/town"}, "bill/where/town is a leaf")])
def test_renames_that_clash(orders, patterns, said):
    with pytest.raises(ValueError, match=said):
        R.rename(orders, patterns)


def test_records_are_combined_and_updated(spark, orders):
    df = orders.withColumn("more", F.struct(F.struct(F.lit(3.0).alias("net"), F.lit("!").alias("note")).alias("sum"), F.lit("here").alias("where")))
    left, right = R.leaves(df, "bill"), R.leaves(df, "more")
    both = df.select(R.record(R.combine(left, right, lambda a, b: a * b)).alias("r")).first()["r"].asDict(True)
    assert both == {"id": 7, "sum": {"net": 30.0, "tax": 2.0}, "where": {"town": {"name": "Ulm", "code": 89}, "lane": "Hafengasse"}}
    with pytest.raises(ValueError, match=r"unknown paths \['sum/note', 'where'\]"):
        R.combine(left, right, lambda a, b: a, strict=True)
    assert df.select(R.record(R.update(left, right)).alias("r")).first()["r"].asDict(True) == {"id": 7, "sum": {"net": 3.0, "tax": 2.0, "note": "!"}, "where": "here"}
    assert df.select(R.record(R.update(right, left)).alias("r")).first()["r"].asDict(True) == {"sum": {"net": 10.0, "note": "!", "tax": 2.0}, "id": 7, "where": {"town": {"name": "Ulm", "code": 89}, "lane": "Hafengasse"}}
    with pytest.raises(TypeError):
        R.leaves(df, "n")


def test_leaves_and_arrays(spark):
    df = spark.createDataFrame([(1, "x")], "n long, s string")
    assert R.map_leaves(df, {T.LongType: lambda c: c + 1, T.StringType: F.upper}).first() == (2, "X")
    with pytest.raises(TypeError):
        R.map_leaves(df, {T.LongType: lambda c: c})
    packed = R.pack_array(F.lit(b"\x01\x02"), "u1", (2,))
    assert bytes(spark.range(1).select(R.unpack_array(packed)).first()[0]) == b"\x01\x02"
    with pytest.raises(ValueError):
        R.pack_array(F.lit(b""), "O", (0,))


def test_prompts(spark):
    tasks = spark.createDataFrame([(4, "fold the towel"), (9, "fill the kettle")], "task_index long, task string")
    rows = spark.createDataFrame([(9, 1), (4, 2), (9, 3)], "task_index long, frame long")
    given = X.chain(rows, [X.prompt_of_task(tasks)])
    assert [r["prompt"] for r in given.orderBy("frame").collect()] == ["fill the kettle", "fold the towel", "fill the kettle"]
    with pytest.raises(Exception, match="no task 5"):
        X.chain(rows.withColumn("task_index", F.col("task_index") - 4), [X.prompt_of_task(tasks)]).collect()
    half = given.withColumn("prompt", F.when(F.col("frame") > 1, F.col("prompt")))
    assert [r["prompt"] for r in X.chain(half, [X.default_prompt("wait")]).orderBy("frame").collect()] == ["wait", "fold the towel", "fill the kettle"]
    assert {r["prompt"] for r in X.chain(rows, [X.default_prompt("wait")]).collect()} == {"wait"}
    with pytest.raises(ValueError, match="step 1"):
        X.chain(rows, [X.default_prompt("x"), lambda df: df.select("nothing")])


def test_groups_keep_their_order():
    a, b, c = (lambda df: df), (lambda df: df), (lambda df: df)
    g = X.Group((a,), (a,)).push([b], [c])
    assert g.inputs == (a, b) and g.outputs == (c, a)


def test_modalities_are_undone(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "v array<double>")
    stats = {"v": {"mean": [0.5, 1.0], "std": [2.0, 1.0], "q01": [0, 0], "q99": [4, 4]}}
    t = X.Composed([X.Modality(["v"], stats), X.Modality(["v"], stats, quantiles=True)]).train(False)
    assert t.unapply(t.apply(df)).first()["v"] == pytest.approx([1.0, 2.0])
    with pytest.raises(ValueError):
        X.Composed([X.Modality(["v"], {})]).apply(df)


def test_policy_rows(spark):
    df = spark.createDataFrame([([1.0], [[1.0, 2.0, 3.0]])], "s array<double>, a array<array<double>>")
    out = X.chain(df, [X.policy_input("s", "a", 4), X.policy_output("a", 2)]).first()
    assert out["s"] == [1, 0, 0, 0] and out["a"] == [[1, 2]]
    got = spark.range(1).select(*(c.alias(k) for k, c in X.token_layout(F.array(F.lit(5)), F.array(F.lit(6), F.lit(7)), 4).items())).first()
    assert got["tokens"] == [5, 6, 7, 0] and got["mask"] == [True, True, True, False] and got["ar_mask"] == [0, 1, 1, 0]
    parts = spark.range(1).select(*(c.alias(k) for k, c in X.action_parts(F.array(*(F.lit(0.0),) * 7)).items())).first()
    assert parts["rot_6d"] == [1, 0, 0, 0, 1, 0] and parts["base_mode"] is None
    assert spark.range(1).select(X.scene_path(F.lit(3), "layout"), X.scene_path(F.lit(11), "style"), X.subset_of_words(F.array(F.lit("red"), F.lit("cup")), F.lit("The cup, red"))).first() == ("layouts/test/layout003.yaml", "styles/train/style011.yaml", True)


def test_more_sources(spark, tmp_path):
    for name in ("t1/human_b.h", "t1/human_a.h", "t1/mg_a.h"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")
    assert sorted((r["tier"], r["path"].rsplit("/", 1)[1]) for r in D.first_files(spark, str(tmp_path), "*.h", "mg_").collect()) == [("generated", "mg_a.h"), ("human", "human_a.h")]
    (tmp_path / "m.xml.gz").write_bytes(gzip.compress(b"<a>\n</a>"))
    assert D.gzip_texts(spark, str(tmp_path)).first()["text"] == "<a>\n</a>"
    spark.range(3).write.parquet(str(tmp_path / "s0"))
    df, missing = D.merge_splits(spark, [str(tmp_path / "s0"), str(tmp_path / "s1")], "id long")
    assert df.count() == 3 and missing == [str(tmp_path / "s1")]


@pytest.mark.parametrize("text, status, pairs", [
    ("Here: {'0': ['grasp the cup', 'closes'], '1': ['place the cup', 'opens']}", "ok", 2), ("{0: ['grasp the cup', 'it closes'], 1: ['place the cup', 'it opens']} done", "ok", 2), ("no labels", "unreadable", 0), ("", "unreadable", 0), ("{'0': 3", "unreadable", 0),
    ("{'0': ['fly', 'x'], '1': ['place the cup', 'y']}", "unknown label", 2), ("{'0': ['grasp the cup']}", "not pairs", 1), ("{'0': ['grasp the cup', 'a']}", "wrong count", 1),
])
def test_labellings_are_checked(spark, text, status, pairs):
    allowed = F.array(F.lit("grasp the cup"), F.lit("place the cup"))
    assert spark.range(1).select(texts.check_labels(F.lit(text), F.lit(2), allowed), F.size(texts.parse_labels(F.lit(text)))).first() == (status, pairs)

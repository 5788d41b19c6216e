"""A corpus pipeline of five stages, each one operator of ``episodica.llm``.

Every stage takes the documents that its predecessor kept, with any columns beside
doc_id and text; all but the last return the columns of documents under their own names.
Null and empty texts go in the first stage. An empty table passes all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from episodica.llm import decontam, langid
from episodica.llm.bpe import byte_bpe
from episodica.llm.lines import line_dedup
from episodica.llm.shared import kept_names, quoted, shared_dir, written
from episodica.llm.simhash import near_copies


def _as_before(out: DataFrame, docs: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns of ``docs`` from an operator's result, where some have other names."""
    return out.select(*(quoted(names.get(c, c)).alias(c) for c in docs.columns))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a known language is found: those without a letter, null and empty ones among them, go, as do those of a score under the least that was learned (``langid.fit``).

    Rows are judged one by one by their texts alone: null ids, repeated rows and ties are of no
    effect, a text of any length is scored whole. An empty table passes.
    """
    others = tuple(c for c in docs.columns if c != "doc_id")
    classifier = langid.fit(docs)
    out = langid.identify(docs, classifier, keep=others)
    known = (F.col("lang_pred") != "und") & (F.col("score") >= classifier.least)
    return _as_before(out.where(known), docs, kept_names("doc_id", others, langid.RESULTS))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier one has, or has but for one edit; those of which only blanks remain go.

    Earlier is by doc_id (null first), then by text hash, then by line; rows that repeat both
    are treated alike. n_chars, where there is one, is counted again for changed texts.
    """
    names = kept_names("", docs.columns, ("__lines", "__removed"))
    out = line_dedup(docs)
    changed, text = F.col("__removed") > 0, quoted(names["text"])
    out = out.where(~(changed & (F.trim(F.coalesce(text, F.lit(""))) == "")))
    if "n_chars" in docs.columns:
        count = F.char_length(text).cast(docs.schema["n_chars"].dataType)
        out = out.withColumn(names["n_chars"], F.when(changed, count).otherwise(quoted(names["n_chars"])))
    return _as_before(out, docs, names)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (SimHash of five-word shingle sets, similarity 0.8): of the least id, nulls last, then of the least text hash.

    Rows are known by id and text hash together, so rows that repeat an id or lack one are
    judged by their texts; copies that share both are one row. Of groups as near the least id
    decides; an empty table passes; a text of any length is compared whole.
    """
    short = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    own = docs.select(*(quoted(c).alias(x) for c, x in short.items()))
    the_id, the_text = F.col(short["doc_id"]), F.col(short["text"])
    key = F.struct(the_id.isNull().alias("no_id"), the_id.alias("id"), F.xxhash64(the_text).alias("hash"))
    found = near_copies(own.select(key.alias("__key"), the_text.alias("text")), "__key").where(F.col("__key") == F.col("component_id"))
    stay = written(found.groupBy(F.col("__key.id").alias("__id"), F.col("__key.hash").alias("__hash")).agg(F.count("*").alias("__rows")), "kept-documents")
    same = the_id.eqNullSafe(F.col("__id")) & (F.xxhash64(the_text) == F.col("__hash"))
    out = own.join(stay.where("__rows = 1"), same, "left_semi")
    if not stay.where("__rows > 1").isEmpty():
        out = out.unionByName(own.join(stay.where("__rows > 1"), same, "left_semi").dropDuplicates([short["doc_id"], short["text"]]))
    return out.select(*(F.col(x).alias(c) for c, x in short.items()))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window; each row is judged by its text alone, one row out for each that stays.

    Null ids, repeated rows and ties are of no effect; an empty table, or an empty benchmark, passes; a text of any length is read whole.
    """
    others = tuple(c for c in docs.columns if c != "doc_id")
    out = decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), keep=others)
    return _as_before(out.where(~F.col("contaminated")), docs, kept_names("doc_id", others, decontam.RESULTS))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the digests of ids and decoded bytes, and the ids, one row for each row in.

    Null ids and repeated rows are kept as they are; an empty table gives an empty result; a text of any length is encoded whole.
    """
    return byte_bpe(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_documents),
    ("decontamination", decontaminated),
    ("byte_bpe", encoded),
]

#: Language identification is learned; SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each from a written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""Tables written to the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``. Where that is unset, a session in one JVM gets a temporary one; on a cluster this is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="episodica-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def short_batches(spark: SparkSession, rows: int = 1000, size: int = 32 << 20) -> None:
    """Arrow batches of fewer rows and bytes than the defaults, as rows are whole texts; settings of the user's stay."""
    for name, usual, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", ("10000",), rows), ("spark.sql.execution.arrow.maxBytesPerBatch", ("67108864b", "64MB", "67108864", "268435456b", "256MB"), size)):
        if (now := spark.conf.get(name, None)) is None or now in usual:
            spark.conf.set(name, str(value))


def quoted(name: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def kept_names(id_col: str, keep: Iterable[str], results: Iterable[str]) -> dict[str, str]:
    """Names in a result of the columns that pass through; one that a result column has gets underscores until it is free."""
    taken, out = {id_col, *results}, {}
    for name in keep:
        if name == id_col or name in out:
            continue
        free = name
        while free in taken:
            free += "_"
        out[name] = free
        taken.add(free)
    return out


class Carried:
    """Columns of ``df`` that pass through an operator under names that cannot clash, beside the text it reads."""

    def __init__(self, df: DataFrame, id_col: str, text_col: str, keep: Iterable[str], results: Iterable[str]):
        self.names = {id_col: id_col} | kept_names(id_col, keep, results)
        self.results = list(results)
        self.short = {name: f"__c{i}" for i, name in enumerate(self.names)}
        columns = [quoted(name).alias(short) for name, short in self.short.items()]
        self.text = self.short.get(text_col, "__text")
        self.source = df.select(*columns, *([] if text_col in self.short else [quoted(text_col).alias("__text")]))
        types = dict(self.source.dtypes)
        self.schema = ", ".join(f"{short} {types[short]}" for short in self.short.values())

    def __getstate__(self) -> dict:
        return {k: v for k, v in vars(self).items() if k != "source"}  # workers have no use for the plan

    def parts(self, batch: pa.RecordBatch, first: int, rows: int) -> list[pa.Array]:
        return [batch.column(short).slice(first, rows) for short in self.short.values()]

    @property
    def heads(self) -> list[str]:
        return list(self.short.values())

    def named(self, out: DataFrame) -> DataFrame:
        """The id, the results, and the columns kept."""
        columns = [F.col(self.short[name]).alias(free) for name, free in self.names.items()]
        return out.select(columns[0], *(quoted(r) for r in self.results), *columns[1:])


def exists(spark: SparkSession, path: str) -> bool:
    """By the file system of the path, whatever it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a written table: cuts lineage and survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

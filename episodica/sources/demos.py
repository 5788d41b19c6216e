"""Demonstrations as archives of named arrays (NPZ), one file a demo, read and written in the tasks that hold them."""

from __future__ import annotations

import io
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.texts import natural_number


def write_demos(frames: DataFrame, root: str, key: str, order: str, arrays: Mapping[str, str]) -> DataFrame:
    """Write demo_<key>.npz for every demo, its frames in order, an array for each of ``arrays`` (name -> column); gives key and n.

    The result must be read for the files to be there. A demo is one task's: a bounded
    recording. A file is written beside its place and moved there whole, so a task that is run
    again leaves the same file.
    """

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        system, folder = fs.FileSystem.from_uri(root)
        system.create_dir(folder, recursive=True)
        content = io.BytesIO()
        np.savez(content, **{name: np.stack(pdf[column].to_list()) for name, column in arrays.items()})
        place = f"{folder}/demo_{pdf[key].iloc[0]}.npz"
        with system.open_output_stream(f"{place}.part") as out:
            out.write(content.getvalue())
        system.move(f"{place}.part", place)
        return pd.DataFrame({key: pdf[key].iloc[:1], "n": [len(pdf)]})

    kind = dict(frames.dtypes)[key]
    return frames.select(key, order, *dict.fromkeys(arrays.values())).groupBy(key).applyInPandas(write, f"{key} {kind}, n long")


def read_demos(spark: SparkSession, root: str, arrays: Sequence[str], mask: Sequence[str] | None = None) -> DataFrame:
    """demo, number (at the end of its name), frame and state: the named arrays of each frame, one after the other.

    Of demos not in ``mask`` (names) no file is opened. An array that is not there, and arrays of unequal length in
    one demo, are errors. Files are read as they come, a demo at a time.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("demo").to_pylist(), batch.column("content"), strict=True):
                with np.load(io.BytesIO(content.as_buffer())) as archive:
                    parts = [np.asarray(archive[a], float) for a in arrays]
                if len({len(p) for p in parts}) > 1:
                    raise ValueError(f"arrays of {name} differ in length: {[len(p) for p in parts]}")
                rows = np.concatenate([p.reshape(len(p), -1) for p in parts], axis=1)
                bounds = pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(rows), pa.string()), pa.array(np.arange(len(rows))), pa.ListArray.from_arrays(bounds, pa.array(rows.ravel()))], ["demo", "frame", "state"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.npz").load(root)
    if mask is not None:
        files = files.where(F.col("_metadata.file_name").isin([f"{m}.npz" for m in mask]))
    named = files.select(F.regexp_extract(F.col("path"), r"([^/]+)\.npz$", 1).alias("demo"), "content")
    frames = named.mapInArrow(decode, "demo string, frame long, state array<double>")
    return frames.select("demo", natural_number(F.col("demo")).alias("number"), "frame", "state")

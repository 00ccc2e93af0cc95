"""Arrow batches in, tuples out: the one bridge between DataFrames and the Python kernels of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from transquill.operators.storage import stored  # noqa: F401  (the operators here write with it)

#: Rows that are turned into one output batch.
OUT_ROWS = 4096


def map_rows(df: DataFrame, columns: list[str], make: Callable[[], Callable[..., Iterable[tuple]]], schema: str) -> DataFrame:
    """Calls make() once a task; what it returns is called with each row's values and yields output tuples."""
    fields = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel, out = make(), []
        for batch in batches:
            for values in zip(*(c.to_pylist() for c in batch.columns)):
                out.extend(kernel(*values))
                if len(out) >= OUT_ROWS:
                    yield pack(out)
                    out = []
        if out:
            yield pack(out)

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return df.select(*columns).mapInArrow(run, fields)


def map_batches(df: DataFrame, columns: list[str], make: Callable[[], Callable[[list[list]], list[tuple]]], schema: str) -> DataFrame:
    """Like map_rows, but the kernel gets whole columns of a batch at once."""
    fields = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = make()
        for batch in batches:
            if rows := list(kernel([c.to_pylist() for c in batch.columns])):
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return df.select(*columns).mapInArrow(run, fields)


def map_columns(df: DataFrame, columns: list[str], make: Callable[[], Callable[[list[list]], list[list]]], schema: str) -> DataFrame:
    """Like map_batches, but the kernel gives whole columns, too, as arrays or lists: for many rows of numbers."""
    fields = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = make()
        for batch in batches:
            out = kernel([c.to_pylist() for c in batch.columns])
            if len(out[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(out, arrow)], schema=arrow)

    return df.select(*columns).mapInArrow(run, fields)


def has_text(column: str) -> Column:
    """Neither null nor only white space."""
    return F.col(column).isNotNull() & F.col(column).rlike(r"(?U)\S")


def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(video_id, text) of each row of videos with a text; an id's rows hold the same text, so results are made distinct, not texts."""
    videos = spark.read.parquet(f"{sf_dir}/videos.parquet")
    return videos.where(has_text("transcript")).select(F.col("id").alias("video_id"), F.col("transcript").alias("text"))


def collected(df: DataFrame) -> dict[str, np.ndarray]:
    """A small table's columns on the driver, as arrays; through Arrow, so without a Python object for each value."""
    got = df.toArrow()
    return {name: got[name].to_numpy() for name in got.column_names}

"""Document algorithms over Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def map_documents(df: DataFrame, columns: list[str], kernel: Callable[..., Iterable[tuple]], schema: str) -> DataFrame:
    """kernel gets a row's values and gives any number of output rows."""
    fields = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for values in zip(*(c.to_pylist() for c in batch.columns)) for r in kernel(*values)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return df.select(*columns).mapInArrow(run, fields)

"""Python stages over Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame

#: Most rows and bytes that a Python worker gets at once; a worker holds a few batches at a time.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


def in_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """`mapInArrow` in small batches, set for the session: a batch's size bounds a worker's memory.

    Columns go in by place, for `mapInArrow` can't take names with a point.
    """
    for key, value in BATCH.items():
        df.sparkSession.conf.set(key, value)
    names = df.columns

    def named(batches):
        return function(pa.RecordBatch.from_arrays(batch.columns, names=names) for batch in batches)

    return df.toDF(*[f"column_{k}" for k in range(len(names))]).mapInArrow(named, schema)

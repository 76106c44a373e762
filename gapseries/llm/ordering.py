"""Range-sorted tables with a running state that goes on over partition borders.

``spans`` sorts a table over all tasks by value ranges and lets a function walk
every partition in order. Each walk starts afresh, so what it says about the
first rows of a partition may need what the partitions before it held. The
result is written to the shared folder with the partition number, one summary
row a partition goes to the driver (as many rows as shuffle partitions), the
driver carries the state over the borders, and a later pass over the written
rows applies it. A key with a third of all rows is thus cut by the ranges.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gapseries.llm.common import arrow_rows, materialise

PART = T.StructField("part", T.IntegerType())


def spans(df: DataFrame, by: list[str], walk: Callable, fields: list[T.StructField], name: str) -> DataFrame:
    """Rows ``(part, *fields)``: ``walk(batches)`` of every range partition of ``df``, sorted by ``by``.

    ``walk`` yields lists of columns, one per field. Ranges follow in the order of ``part``.
    """
    schema = T.StructType([PART, *fields])

    def run(batches):
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        for columns in walk(batches):
            yield [pa.array([part] * len(columns[0]), pa.int32()), *columns]
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by)
    return materialise(ordered.mapInArrow(arrow_rows(run, schema), schema), name)

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gapseries.session import scratch_path


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: later stages reread files that every executor can reach,
    so a lost executor costs a reread and not a recomputation.
    """
    path = shared_path(df.sparkSession, name)
    if _recorded is not None:
        _recorded.append(path)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def discard(*tables: DataFrame) -> None:
    """Delete written intermediate tables (of ``materialise``) that nothing reads any more."""
    for table in tables:
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            remove(table.sparkSession, folder)


_recorded: list[str] | None = None


@contextlib.contextmanager
def recorded_scratch() -> Iterator[list[str]]:
    """The paths that ``materialise`` writes meanwhile, for a caller that knows when they are no longer read."""
    global _recorded
    before, _recorded = _recorded, []
    try:
        yield _recorded
    finally:
        _recorded = before


def without(columns: list[str], base: str) -> str:
    """``base``, or ``base`` with underscores in front until no column clashes (case-insensitively)."""
    taken = {c.lower() for c in columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def arrow_rows(fn: Callable[[Iterator[pa.RecordBatch]], Iterator[list]], schema: T.StructType):
    """Adapt ``fn`` (batches -> lists of columns, one per field) for ``mapInArrow``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in fn(batches):
            arrays = [c if isinstance(c, pa.Array) and c.type == f.type
                      else c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type)
                      for c, f in zip(columns, target)]
            yield pa.RecordBatch.from_arrays(arrays, schema=target)
    return run


def pieces(batches: Iterator[pa.RecordBatch], text: int = -1, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the strings of column ``text`` hold about ``limit`` bytes at a time.

    Bounds what one step of a task holds in memory; a single longer text is a piece of its own.
    """
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        column = batch.column(text if text >= 0 else batch.num_columns + text)
        if column.nbytes <= limit:
            yield batch
            continue
        import pyarrow.compute as pc
        length = pc.list_value_length if pa.types.is_list(column.type) else pc.binary_length
        width = max(1, column.nbytes // max(1, pc.sum(length(column)).as_py() or 1)) if pa.types.is_list(column.type) else 1
        sizes = pc.fill_null(pc.multiply(length(column).cast(pa.int64()), width), 0).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start, n - start)


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of consecutive rows that agree in the first ``keys`` (integer) columns of sorted batches.

    Holds one group at a time.
    """
    import numpy as np

    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        own = np.stack([batch.column(k).to_numpy() for k in range(keys)], 1)
        cuts = np.flatnonzero((own[1:] != own[:-1]).any(1)) + 1
        if held and tuple(own[0]) != last:
            yield pa.Table.from_batches(held)
            held = []
        starts, ends = np.append(0, cuts), np.append(cuts, batch.num_rows)
        for a, b in zip(starts.tolist(), ends.tolist()):
            held.append(batch.slice(a, b - a))
            if b < batch.num_rows:
                yield pa.Table.from_batches(held)
                held = []
        last = tuple(own[-1])
    if held:
        yield pa.Table.from_batches(held)

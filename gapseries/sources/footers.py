"""AGG-24: what each column of a Parquet table takes on disk, from the files' footers alone.

A batch Python data source plans the files of a table into partitions; a task
opens its files through Arrow's file systems (local, HDFS, object stores) and
reads nothing but the footers: no data page is touched, whatever the size of
the table. One row per file, row group and column; :func:`column_storage` adds
them up.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "parquet_footers"
FILES = 64                      # files a partition

SCHEMA = ("file string, row_group int, column string, type string, codec string, rows bigint, values bigint, nulls bigint, "
          "compressed_bytes bigint, plain_bytes bigint")
_ARROW = pa.schema([("file", pa.string()), ("row_group", pa.int32()), ("column", pa.string()), ("type", pa.string()), ("codec", pa.string()),
                    *[(c, pa.int64()) for c in ("rows", "values", "nulls", "compressed_bytes", "plain_bytes")]])


class _Files(InputPartition):
    def __init__(self, files: list[str]):
        self.files = files


def _locate(path: str):
    from pyarrow import fs
    # Spark writes local paths as file:/a/b as well
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


def data_files(path: str) -> list[str]:
    """Data files below ``path`` (or the file itself), hidden ones left out."""
    from pyarrow import fs
    system, inner = _locate(path)
    info = system.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [path]
    base, out = path.rstrip("/"), []
    for f in system.get_file_info(fs.FileSelector(inner, recursive=True)):
        below = f.path[len(inner.rstrip("/")) + 1:]
        if f.type == fs.FileType.File and f.size and not any(p.startswith(("_", ".")) for p in below.split("/")):
            out.append(f"{base}/{below}")
    return sorted(out)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.files = int(options.get("filesPerPartition", FILES))

    def partitions(self) -> list[InputPartition]:
        files = data_files(self.path)
        return [_Files(files[i:i + self.files]) for i in range(0, len(files), self.files)] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        for path in partition.files:
            system, inner = _locate(path)
            with system.open_input_file(inner) as source:
                meta = pq.read_metadata(source)
            columns: list[list] = [[] for _ in _ARROW]
            for g in range(meta.num_row_groups):
                group = meta.row_group(g)
                for i in range(group.num_columns):
                    c = group.column(i)
                    stats = c.statistics
                    nulls = stats.null_count if stats is not None and stats.has_null_count else None
                    for column, value in zip(columns, (path, g, c.path_in_schema, c.physical_type, c.compression, group.num_rows, c.num_values,
                                                       nulls, c.total_compressed_size, c.total_uncompressed_size)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, _ARROW)], schema=_ARROW)


class ParquetFooters(DataSource):
    """``spark.read.format("parquet_footers").load(path)``; option ``filesPerPartition``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


def footers(spark: SparkSession, path: str, files_per_partition: int = FILES) -> DataFrame:
    """One row per file, row group and column of the Parquet table at ``path``."""
    spark.dataSource.register(ParquetFooters)
    return spark.read.format(FORMAT).option("filesPerPartition", files_per_partition).load(path)


def column_storage(spark: SparkSession, path: str, files_per_partition: int = FILES) -> DataFrame:
    """AGG-24: per column: files, row groups, rows, nulls, compressed and plain bytes, compression ratio.

    ``nulls`` is NULL when some row group has no statistics. Nested columns
    are named by their leaves (``a.list.element``), whose ``values`` count
    their elements.
    """
    f = footers(spark, path, files_per_partition)
    compressed, plain = F.sum("compressed_bytes"), F.sum("plain_bytes")
    known = F.count("nulls") == F.count(F.lit(1))
    return f.groupBy("column").agg(
        F.min("type").alias("type"), F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("row_groups"), F.sum("rows").alias("rows"),
        F.sum("values").alias("values"), F.when(known, F.sum("nulls")).alias("nulls"), compressed.alias("compressed_bytes"),
        plain.alias("plain_bytes"), F.try_divide(plain, compressed).alias("ratio"))


def file_storage(spark: SparkSession, path: str, files_per_partition: int = FILES) -> DataFrame:
    """Per file: rows, row groups, compressed and plain bytes of its columns."""
    f = footers(spark, path, files_per_partition)
    groups = f.groupBy("file", "row_group").agg(F.max("rows").alias("rows"), F.sum("compressed_bytes").alias("c"), F.sum("plain_bytes").alias("p"))
    return groups.groupBy("file").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("row_groups"), F.sum("c").alias("compressed_bytes"),
                                      F.sum("p").alias("plain_bytes"))

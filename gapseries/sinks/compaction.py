"""Compaction by file size (SNK-12): small files of a folder are packed into files near a target size.

Only the listing decides what is rewritten: files of at least ``BIG`` of the
target stay as they are, the others are packed in name order into groups by a
running sum of their bytes. A group of one file stays too. Each group is one
task and one file, so no task reads more than 1.75 times the target.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gapseries.sinks.writers import _fs
from gapseries.session import cut_lineage

BIG = 0.75                      # of the target: from here on a file is left alone
TARGET_BYTES = 512 << 20
_STAGING = "_compaction"        # Spark reads no folder whose name starts so


def file_groups(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """``(folder, file, bytes, pack)`` of every Parquet file below ``path``; ``pack`` numbers a folder's groups, null: left alone.

    A listing only: the column of contents is pruned, so no file is opened.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
             .select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder"), F.substring_index("path", "/", -1).alias("file"),
                     F.col("length").alias("bytes")))
    small = F.col("bytes") < F.lit(BIG * target_bytes)
    before = Window.partitionBy("folder", small).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    own = files.withColumn("pack", F.when(small, F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / F.lit(target_bytes))))
    alone = F.count(F.lit(1)).over(Window.partitionBy("folder", "pack")) == 1
    packed = own.withColumn("pack", F.when(~alone, F.col("pack")))
    # numbered without gaps: the number is the task that writes the group
    rank = F.dense_rank().over(Window.partitionBy("folder", F.col("pack").isNull()).orderBy("pack")) - 1
    return packed.withColumn("pack", F.when(F.col("pack").isNotNull(), rank))


def _swap(spark: SparkSession, staging: str) -> None:
    """Put a finished group's files into their folder, then remove the files they replace. May be repeated after a failure."""
    fs, root = _fs(spark, staging)
    make = spark._jvm.org.apache.hadoop.fs.Path
    ready = make(root, "ready")
    if fs.exists(ready):
        lines = [r[0] for r in spark.read.text(ready.toString()).collect()]         # the folder, then its replaced files
        folder, replaced = make(lines[0]), lines[1:]
        for status in fs.listStatus(make(root, "files")):
            name = status.getPath().getName()
            if name.endswith(".parquet") and not fs.rename(status.getPath(), make(folder, name)):
                raise OSError(f"{name} could not be moved into {lines[0]}")
        for name in replaced:
            fs.delete(make(folder, name), False)
    fs.delete(root, True)


def compact_files(spark: SparkSession, path: str, sort_by: str | Sequence[str] = (), target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Compact every folder (partition) below ``path`` in place; returns ``(folder, files_before, files_after, bytes_rewritten)``.

    Rows of a new file are sorted by ``sort_by``. No row is missing at any time;
    while a folder's files are exchanged a reader may see rows of both the old
    and the new file, which reads by latest version per key resolve. A run that
    was cut off is finished by the next one: what it had written completely is
    exchanged, the rest is dropped. One run at a time, and none while the
    partition is overwritten. An empty table gives no rows.
    """
    sort_by = [sort_by] if isinstance(sort_by, str) else list(sort_by)
    fs, staging = _fs(spark, f"{path}/{_STAGING}")
    if fs.exists(staging):
        for left in fs.listStatus(staging):
            _swap(spark, left.getPath().toString())
    plan = cut_lineage(file_groups(spark, path, target_bytes))
    groups = F.max("pack") + 1
    folders = (plan.groupBy("folder").agg(F.count(F.lit(1)).alias("files_before"), F.coalesce(groups, F.lit(0)).alias("packs"),
                                          F.count("pack").alias("packed"),
                                          F.coalesce(F.sum(F.when(F.col("pack").isNotNull(), F.col("bytes"))), F.lit(0)).alias("bytes_rewritten")))
    done = cut_lineage(folders.select("folder", "files_before", (F.col("files_before") - F.col("packed") + F.col("packs")).alias("files_after"),
                                      "bytes_rewritten", "packs"))
    for row in done.where("packs > 0").orderBy("folder").collect():                 # one row per partition
        own = plan.where((F.col("folder") == row["folder"]) & F.col("pack").isNotNull()).select("file", "pack")
        names = [r["file"] for r in own.orderBy("file").collect()]                  # the listing of one partition
        new = f"{path}/{_STAGING}/{uuid.uuid4().hex}"
        rows = spark.read.parquet(*[f"{row['folder']}/{n}" for n in names])
        columns = rows.columns
        packed = (rows.select("*", F.col("_metadata.file_name").alias("_from_file"))
                  # the listing is sent to the tasks; left to choose, Spark sends the rows of a small folder through the driver
                  .join(F.broadcast(own.select(F.col("file").alias("_from_file"), F.col("pack").cast("int").alias("_pack"))), "_from_file")
                  .repartitionById(int(row["packs"]), "_pack").select(*columns))
        (packed.sortWithinPartitions(*sort_by) if sort_by else packed).write.parquet(f"{new}/files")
        out = fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{new}/ready.part"), True)
        out.write(bytearray("\n".join([row["folder"], *names]), "utf-8"))
        out.close()
        fs.rename(spark._jvm.org.apache.hadoop.fs.Path(f"{new}/ready.part"), spark._jvm.org.apache.hadoop.fs.Path(f"{new}/ready"))
        _swap(spark, new)
    if fs.exists(staging):
        fs.delete(staging, True)
    return done.drop("packs")

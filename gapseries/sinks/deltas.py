"""Upserts by delta (SNK-2): a flush appends its batch, a read lays it over the base, a merge rewrites once.

``upsert_table`` rewrites every month a batch touches. For frequent small
batches a table may instead be kept as ``<path>/base`` (a block table as
``upsert_table`` writes it) and ``<path>/delta/batch=<name>`` (one folder per
flush, sorted by key), so that the bytes of a flush follow its batch. A read
shuffles no base row whose key is in no delta, as long as the deltas' keys are
few enough to be broadcast (Spark decides by their size). ``merge_deltas``
upserts all batches into the base in one go and removes them.

A batch counts once it is committed (Spark's ``_SUCCESS``); a failed flush is
not read and is written anew under the same name. A merge that fails half-way
loses nothing: its batches are still there, and merging them again changes
nothing.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gapseries.operators.latest import latest
from gapseries.sinks.writers import KEY_SPAN, _fs, _list, _table_exists, _with_part, read_table, table_schema, upsert_table
from gapseries.sources.decoders import normalise_blocks

_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9_.-]*")


def batches(spark: SparkSession, path: str) -> list[str]:
    """Folders of the committed batches, by name."""
    fs, target = _fs(spark, f"{path}/delta")
    if not fs.exists(target):
        return []
    found = [s.getPath() for s in fs.listStatus(target)]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(p.toString() for p in found if fs.exists(done(p, "_SUCCESS")))


def append_delta(spark: SparkSession, path: str, incoming: DataFrame, batch: str, keys: str | Sequence[str] = "number",
                 seq_col: str = "_ingest_seq", part_col: str = "year_month") -> bool:
    """Append one batch; ``False`` if a batch of that name is committed already (a replay), which then stays as it is."""
    if not _NAME.fullmatch(batch):
        raise ValueError(f"a batch is named by letters, digits, '.', '_' and '-', not {batch!r}")
    keys, folder = _list(keys), f"{path}/delta/batch={batch}"
    fs, target = _fs(spark, f"{folder}/_SUCCESS")
    if fs.exists(target):
        return False
    rows = _with_part(normalise_blocks(incoming), part_col)
    if seq_col not in rows.columns:
        rows = rows.withColumn(seq_col, F.lit(0).cast("bigint"))
    (latest(rows, keys, seq_col).repartition(*[F.floor(F.col(k) / F.lit(KEY_SPAN)) for k in keys]).sortWithinPartitions(*keys)
     .write.mode("overwrite").parquet(folder))
    return True


def _delta_rows(spark: SparkSession, folders: list[str], seq_col: str, part_col: str) -> DataFrame:
    return spark.read.schema(table_schema(seq_col, part_col)).parquet(*folders)


def read_merged(spark: SparkSession, path: str, keys: str | Sequence[str] = "number", seq_col: str = "_ingest_seq",
                part_col: str = "year_month") -> DataFrame:
    """The table as a merge would leave it: per key the version of the highest sequence, of base and deltas."""
    keys, folders = _list(keys), batches(spark, path)
    if not _table_exists(spark, f"{path}/base"):
        if not folders:
            return spark.createDataFrame([], table_schema(seq_col, part_col))
        return latest(_delta_rows(spark, folders, seq_col, part_col), keys, seq_col)
    base = read_table(spark, f"{path}/base", part_col)
    if not folders:
        return base
    new = _delta_rows(spark, folders, seq_col, part_col).select(*base.columns)
    changed = new.select(*[F.col(k).alias(f"_key_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    kept = base.join(changed, same, "left_anti")
    stored = base.join(changed, same, "left_semi")
    return kept.unionByName(latest(stored.unionByName(new), keys, seq_col))


def merge_deltas(spark: SparkSession, path: str, keys: str | Sequence[str] = "number", seq_col: str = "_ingest_seq",
                 part_col: str = "year_month") -> int:
    """Upsert all committed batches into the base, each touched partition once, and remove them; returns their number.

    Batches that are committed meanwhile stay for the next merge.
    """
    folders = batches(spark, path)
    if folders:
        upsert_table(spark, f"{path}/base", _delta_rows(spark, folders, seq_col, part_col), keys, seq_col, part_col)
    for folder in folders:
        fs, target = _fs(spark, folder)
        fs.delete(target, True)
    return len(folders)

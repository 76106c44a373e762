"""Range reads, projections, era handling, top-k (FIL-*, TOP-1, JN-9, META-2)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gapseries.functions import timeargs
from gapseries.operators.latest import latest
from gapseries.sources.contract import DEPRECATED_COLUMNS, STANDARD_COLUMNS, Era, default_eras


def _month_key(d: dt.datetime) -> str:
    return d.strftime("%Y%m")


def time_range(df: DataFrame, ts_col: str = "timestamp", start: str | None = None, end: str | None = None,
               partition_col: str | None = None) -> DataFrame:
    """FIL-1: ``[start, end)`` with date-only ends covering the whole day.

    If the table is partitioned by ``yyyyMM`` (``partition_col``), the derived
    month bounds are added so partition pruning applies as well.
    """
    out = df
    if start:
        lo = timeargs.normalize_bound(start, is_end=False)
        out = out.filter(F.col(ts_col) >= F.lit(lo))
        if partition_col:
            out = out.filter(F.col(partition_col) >= F.lit(_month_key(lo)))
    if end:
        hi = timeargs.normalize_bound(end, is_end=True)
        out = out.filter(F.col(ts_col) < F.lit(hi))
        if partition_col:
            out = out.filter(F.col(partition_col) <= F.lit(_month_key(hi - dt.timedelta(microseconds=1))))
    return out


def standard_columns(df: DataFrame, include_deprecated: bool = False) -> DataFrame:
    """FIL-2: the 9 standard block columns, plus the 2 deprecated ones on request."""
    cols = STANDARD_COLUMNS + (DEPRECATED_COLUMNS if include_deprecated else [])
    return df.select(*cols)


def latest_n(df: DataFrame, key: str, n: int | None, ascending_result: bool = True) -> DataFrame:
    """TOP-1: the latest ``n`` rows by ``key``, returned ascending.

    ``orderBy(desc).limit(n)`` plans as ``TakeOrderedAndProject`` (per-task
    top-n, then a merge of n rows per task); the final ascending sort only
    touches those n rows. ``n=None`` keeps all rows, ``n=0`` none.
    """
    if n is None:
        return df.orderBy(F.col(key).asc()) if ascending_result else df
    top = df.orderBy(F.col(key).desc()).limit(int(n))
    return top.orderBy(F.col(key).asc()) if ascending_result else top


def fetch_blocks(df: DataFrame, start: str | None = None, end: str | None = None, limit: int | None = None,
                 include_deprecated: bool = False, key: str = "number", ts_col: str = "timestamp",
                 seq_col: str | None = "_ingest_seq", ts_stable: bool = False,
                 partition_col: str | None = None, sort: bool = True) -> DataFrame:
    """FIL-4: deduplicated range / latest-N read of a block table.

    ``df`` may hold several versions per key (``seq_col``); the latest wins,
    and the range holds for it: a block revised to a time outside the range
    is not returned. The keys with any version in the range are found first
    (pushed filters, the two columns alone), then all versions of those keys
    are read (bounded by their least and largest), deduplicated and filtered
    again. ``ts_stable`` promises that no version changes a block's time:
    then one pass does, with the filter before the deduplication.
    """
    timeargs.validate_range_args(start, end, limit)
    # project before deduplicating: the dedup packs the row into one struct,
    # which Catalyst cannot prune afterwards (the scan would read every column)
    wanted = STANDARD_COLUMNS + (DEPRECATED_COLUMNS if include_deprecated else [])
    keep = [c for c in df.columns if c in wanted or c in (key, ts_col, seq_col, partition_col)]
    src = df.select(*keep)
    several = bool(seq_col) and seq_col in src.columns
    ranged = start is not None or end is not None
    again = several and ranged and not ts_stable
    if again:
        near = time_range(src, ts_col, start, end, partition_col).select(key)
        ends = near.agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
        src = src.filter(F.col(key).between(ends.select("lo").scalar(), ends.select("hi").scalar())).join(near.distinct(), key, "left_semi")
    else:
        src = time_range(src, ts_col, start, end, partition_col)
    if several:
        if limit is not None and not again:
            # the limit-th largest key first, from the key column alone: only rows
            # from there on are deduplicated at full width
            newest = src.select(key).distinct().orderBy(F.desc(key)).limit(limit)
            src = src.filter(F.col(key) >= newest.agg(F.min(key)).scalar())
        src = latest(src, key, seq_col)
    if again:
        src = time_range(src, ts_col, start, end, partition_col)
    src = standard_columns(src, include_deprecated)
    if limit is None and not sort:
        return src
    return latest_n(src, key, limit)


def era_filter(df: DataFrame, boundary: int, key: str = "number") -> DataFrame:
    """FIL-5: keep blocks at or after an era boundary."""
    return df.filter(F.col(key) >= F.lit(boundary))


def mask_by_era(df: DataFrame, contract, key: str = "number") -> DataFrame:
    """FIL-6: NULL every column before the block it exists from.

    The boundary comes from ``since_block`` in the contract metadata. Stored
    zeros before the boundary (base fee written as 0) become NULL as well.
    """
    out = df
    for f in contract.fields:
        since = f.metadata.get("since_block") if f.metadata else None
        if since is None or f.name not in df.columns:
            continue
        out = out.withColumn(f.name, F.when(F.col(key) >= F.lit(since), F.col(f.name)))
    return out


def era_column(key: Column | str = "number", eras: Sequence[Era] | None = None, before: str = "pre_london") -> Column:
    """JN-9 as a column: the era name of a block number.

    Three boundaries make a ``when`` chain, which needs neither a join nor a
    broadcast; the era list is a fixed, tiny parameter.
    """
    eras = sorted(eras or default_eras(), key=lambda e: e.start_block, reverse=True)
    k = F.col(key) if isinstance(key, str) else key
    expr = None
    for e in eras:
        expr = F.when(k >= F.lit(e.start_block), F.lit(e.name)) if expr is None else expr.when(
            k >= F.lit(e.start_block), F.lit(e.name))
    return expr.otherwise(F.lit(before))


def label_era(df: DataFrame, eras: Sequence[Era] | None = None, key: str = "number", out: str = "era") -> DataFrame:
    return df.withColumn(out, era_column(key, eras))


def above(df: DataFrame, col: str, x) -> DataFrame:
    """FIL-7: threshold filter ``col > x``."""
    return df.filter(F.col(col) > F.lit(x))


def fill_nulls(df: DataFrame, cols: Sequence[str], value=0) -> DataFrame:
    """FIL-8 / FIL-9: replace NULL by a default, keeping the column type."""
    return df.select(*[
        F.coalesce(F.col(c), F.lit(value).cast(df.schema[c].dataType)).alias(c) if c in cols else F.col(c)
        for c in df.columns
    ])


def block_range(df: DataFrame, lo: int, hi: int, chunk: int | None = None, key: str = "number") -> DataFrame:
    """FIL-13: inclusive ``lo..hi``; with ``chunk`` adds ``chunk_id = floor((n-lo)/chunk)``."""
    out = df.filter(F.col(key).between(lo, hi))
    if chunk:
        out = out.withColumn("chunk_id", F.floor((F.col(key) - F.lit(lo)) / F.lit(chunk)).cast("bigint"))
    return out


def expected_grid(spark: SparkSession, start, end, interval_s: int, col: str = "ts") -> DataFrame:
    """FIL-12: timestamps ``start..end`` inclusive, step ``interval_s``.

    Generated with ``spark.range`` so the grid itself is distributed (one
    row per step, split over tasks) instead of one exploded array.
    """
    lo = timeargs.normalize_bound(start) if isinstance(start, str) else start
    hi = timeargs.normalize_bound(end) if isinstance(end, str) else end
    epoch = dt.datetime(1970, 1, 1)
    lo_s = (lo.replace(tzinfo=None) - epoch) // dt.timedelta(microseconds=1)
    hi_s = (hi.replace(tzinfo=None) - epoch) // dt.timedelta(microseconds=1)
    step = int(interval_s) * 1_000_000
    n = (hi_s - lo_s) // step + 1 if hi_s >= lo_s else 0
    return spark.range(0, n).select(F.timestamp_micros(F.lit(lo_s) + F.col("id") * F.lit(step)).alias(col))


def grid_between(df: DataFrame, lo_col: str, hi_col: str, interval_s: int, col: str = "ts",
                 chunk: int = 1 << 16) -> DataFrame:
    """FIL-12 on data: one row per step from ``lo_col`` to ``hi_col`` (inclusive) of each row,
    generated in chunks spread over tasks."""
    from gapseries.operators.gaps import spread_range
    step = int(interval_s) * 1_000_000
    n = F.floor((F.unix_micros(F.col(hi_col)) - F.unix_micros(F.col(lo_col))) / F.lit(step)) + 1
    r = spread_range(df, n, "_g_k", chunk)
    return r.withColumn(col, F.timestamp_micros(F.unix_micros(F.col(lo_col)) + F.col("_g_k") * F.lit(step))).drop(
        "_g_k")

"""Series window operators built on the bucketed kernels (WIN-1..15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapseries.operators import ordered


def _list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def lagged(df: DataFrame, order: str, cols, k: int = 1, by=None, **kw) -> DataFrame:
    """WIN-1 / WIN-2: previous (k>0) or next (k<0) values; lag-1 uses the edge kernel."""
    if k == 1:
        return ordered.with_prev(df, order, _list(cols), by=by, prefix="prev_", **kw)
    return ordered.shifted(df, [order, *kw.pop("tiebreak", [])], _list(cols), k, by=by, **kw)


def pct_change(df: DataFrame, order: str, col: str, by=None, out: str | None = None, **kw) -> DataFrame:
    """WIN-3: ``x / lag(x) - 1``; NULL on the first row and when the previous value is 0."""
    out = out or f"{col}_pct_change"
    d = ordered.with_prev(df, order, [col], by=by, prefix="_pc_", **kw)
    return d.withColumn(out, F.try_divide(F.col(col), F.col("_pc_" + col)) - F.lit(1)).drop("_pc_" + col)


def diff(df: DataFrame, order: str, col: str, by=None, out: str | None = None, seconds: bool | None = None,
         **kw) -> DataFrame:
    """WIN-4: ``x - lag(x)``; for timestamps the difference in seconds (double)."""
    out = out or f"{col}_diff"
    d = ordered.with_prev(df, order, [col], by=by, prefix="_df_", **kw)
    is_ts = seconds if seconds is not None else df.schema[col].dataType.typeName().startswith("timestamp")
    if is_ts:
        e = (F.unix_micros(F.col(col)) - F.unix_micros(F.col("_df_" + col))) / F.lit(1e6)
    else:
        e = F.col(col) - F.col("_df_" + col)
    return d.withColumn(out, e).drop("_df_" + col)


def monotonic(df: DataFrame, order: str = "number", ts: str = "timestamp", by=None, **kw) -> DataFrame:
    """WIN-14: ``ts_monotonic`` (ts >= previous ts) and ``contiguous`` (key = previous + 1)."""
    d = ordered.with_prev(df, order, [order, ts], by=by, prefix="_mo_", **kw)
    return (d.withColumn("ts_monotonic", F.col(ts) >= F.col("_mo_" + ts))
             .withColumn("contiguous", F.col(order) == F.col("_mo_" + order) + 1)
             .drop("_mo_" + order, "_mo_" + ts))


def rate_flag(df: DataFrame, order: str, col: str, max_abs: float = 0.5, by=None, **kw) -> DataFrame:
    """WIN-15: ``|pct_change| < max_abs`` (NULL where the change is undefined)."""
    d = pct_change(df, order, col, by=by, out="_rf", **kw)
    return d.withColumn(f"{col}_rate_ok", F.abs(F.col("_rf")) < F.lit(max_abs)).withColumnRenamed(
        "_rf", f"{col}_pct_change")


def zscore(df: DataFrame, col: str, by=None, min_count: int = 10, eps: float = 1e-10,
           threshold: float = 3.0) -> DataFrame:
    """WIN-10: whole-series (or per-``by``) z-score.

    The series statistics are a grouped aggregate joined back on the group
    key (for the whole series, a scalar subquery), not a window: the
    aggregate is combined map-side, so a huge group never sits in one task.
    ``z`` is NULL for series with fewer than ``min_count`` values; rows
    without a key are a series of their own.
    """
    df, by = ordered.keyed(df, by)
    stats = df.groupBy(*by).agg(F.avg(col).alias("_z_mean"), F.stddev_samp(col).alias("_z_std"),
                                F.count(col).alias("_z_n"))
    if by:
        j = df.join(stats, on=by, how="left")
    else:
        j = ordered.with_row(df, stats)
    z = F.when(F.col("_z_n") >= min_count, (F.col(col) - F.col("_z_mean")) / (F.col("_z_std") + F.lit(eps)))
    return (j.withColumn(f"{col}_z", z)
             .withColumn(f"{col}_outlier", F.abs(F.col(f"{col}_z")) > F.lit(threshold))
             .drop("_z_mean", "_z_std", "_z_n", ordered.KEY))


def filter_window(df: DataFrame, exprs: dict[str, Column], predicate: Column) -> DataFrame:
    """WIN-11 (QUALIFY): compute window columns, filter on them."""
    d = df
    for name, e in exprs.items():
        d = d.withColumn(name, e)
    return d.filter(predicate)


def rolling(df: DataFrame, order, col: str, n: int, fns: Sequence[str] = ("mean",), by=None, **kw) -> DataFrame:
    """WIN-5..9: see :func:`gapseries.operators.ordered.rolling`."""
    return ordered.rolling(df, order, col, n, fns, by=by, **kw)

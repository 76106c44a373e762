"""Rollups, profiles and summaries (AGG-6..24).

All are ``groupBy(...).agg(...)`` with map-side partial aggregation; none
collects a group into a list. Exact medians use a distributed rank
(``ordered.exact_quantile``); ``approx=True`` switches to
``percentile_approx``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def time_bucket(ts: str, width: str) -> Column:
    """Bucket start of a tumbling window of ``width`` (e.g. ``'1 hour'``), epoch aligned."""
    return F.window(F.col(ts), width).start


def bucket(df: DataFrame, ts: str, width: str, aggs: dict[str, Column], by=None, out: str = "bucket") -> DataFrame:
    """AGG-6: time-bucket rollup with arbitrary aggregates."""
    by = _list(by)
    return df.groupBy(*by, time_bucket(ts, width).alias(out)).agg(*[c.alias(n) for n, c in aggs.items()])


def resample(df: DataFrame, ts: str, width: str, value: str, order_cols: Sequence[str] | None = None,
             by=None, volume: str | None = None, out_ts: str = "ts") -> DataFrame:
    """AGG-7: OHLC(V) resample: first / max / min / last / sum / count per bucket.

    ``first``/``last`` are ``min_by``/``max_by`` over the (total) order
    ``order_cols`` — no sort, no collected lists.
    """
    by = _list(by)
    order = F.struct(*[F.col(c) for c in (order_cols or [ts])])
    vol = F.col(volume) if volume else F.col(value)
    return df.groupBy(*by, time_bucket(ts, width).alias(out_ts)).agg(
        F.min_by(F.col(value), order).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"),
        F.max_by(F.col(value), order).alias("close"), F.sum(vol).alias("volume"),
        F.count(F.lit(1)).alias("trades"))


def block_stats(df: DataFrame) -> DataFrame:
    """AGG-8: count, first/last block and time, average gas used, max base fee."""
    return df.agg(F.count(F.lit(1)).alias("blocks"), F.min("number").alias("first_block"),
                  F.max("number").alias("last_block"), F.min("timestamp").alias("first_ts"),
                  F.max("timestamp").alias("last_ts"), F.avg("gas_used").alias("avg_gas_used"),
                  F.max("base_fee_per_gas").alias("max_base_fee"))


def count_by_year(df: DataFrame, ts: str) -> DataFrame:
    """AGG-9: rows per calendar year (for write-then-verify)."""
    return df.groupBy(F.year(ts).alias("year")).agg(F.count(F.lit(1)).alias("rows"))


def count_by_month(df: DataFrame, ts: str) -> DataFrame:
    """FN-8: rows per ``yyyyMM`` partition key."""
    return df.groupBy(F.date_format(ts, "yyyyMM").alias("year_month")).agg(F.count(F.lit(1)).alias("rows"))


REPORT_DAYS = 7         # window of the failure and success reports


def last_days(df: DataFrame, as_of, days: int | None = REPORT_DAYS, ts: str = "timestamp") -> DataFrame:
    """Rows from midnight ``days`` days before the day of ``as_of`` on (None: all rows)."""
    if as_of is None or days is None:
        return df
    day = F.to_date(F.lit(as_of).cast("timestamp"))
    return df.filter(F.col(ts) >= F.date_sub(day, days).cast("timestamp"))


def failures_by(df: DataFrame, keys: Sequence[str], as_of=None, days: int | None = REPORT_DAYS) -> DataFrame:
    """AGG-10 / TOP-3: failed checks per key: count, total failures, latest failing run; most failures first.

    With ``as_of`` only the last ``days`` days count.
    """
    f = last_days(df, as_of, days).filter(F.col("status") == "fail")
    return f.groupBy(*keys).agg(F.count(F.lit(1)).alias("failure_count"),
                                F.sum("failures").cast("bigint").alias("total_failures"),
                                F.max("timestamp").alias("last_failure")).orderBy(F.desc("failure_count"), *keys)


def success_rate(df: DataFrame, keys: Sequence[str], as_of=None, days: int | None = REPORT_DAYS) -> DataFrame:
    """AGG-11: checks, passes, fails, warnings and success rate in percent, by key; with ``as_of`` of the last ``days`` days."""
    df = last_days(df, as_of, days)
    n = F.count(F.lit(1))
    passes = F.count_if(F.col("status") == "pass")
    return df.groupBy(*keys).agg(
        n.alias("total_checks"), passes.alias("passes"), F.count_if(F.col("status") == "fail").alias("fails"),
        F.count_if(F.col("status") == "warning").alias("warnings"),
        (passes.cast("double") / n * 100).alias("success_rate")).orderBy(*keys)


def layer_counts(df: DataFrame, layer: str = "layer", severity: str = "severity") -> DataFrame:
    """AGG-12: counts per layer x severity."""
    return df.groupBy(layer, severity).agg(F.count(F.lit(1)).alias("n"))


def first_seen(df: DataFrame, key: str, ts: str, source: str) -> DataFrame:
    """AGG-13: first time a key was seen and the sorted set of sources seeing it.

    ``collect_set`` over sources is bounded by the number of sources, not rows.
    """
    return df.groupBy(key).agg(F.min(ts).alias("first_seen"),
                               F.array_join(F.sort_array(F.collect_set(source)), ",").alias("sources"),
                               F.count(F.lit(1)).alias("sightings"))


def series_profile(df: DataFrame, ts: str, by=None) -> DataFrame:
    """AGG-14: count, first, last, span and average interval per series.

    ``avg_interval_by_count`` divides the span by the count (as the source
    does); ``avg_interval_s`` by ``count - 1``.
    """
    by = _list(by)
    span = (F.unix_micros(F.max(ts)) - F.unix_micros(F.min(ts))) / F.lit(1e6)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"),
        span.alias("span_s"),
        (span / F.count(F.lit(1))).alias("avg_interval_by_count"),
        F.try_divide(span, F.count(F.lit(1)) - 1).alias("avg_interval_s"))


def bar_summary(bars: DataFrame, by: str = "symbol") -> DataFrame:
    """AGG-15: per symbol bar count, first/last bar, price range, volume and trades."""
    return bars.groupBy(by).agg(
        F.count(F.lit(1)).alias("bars"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
        F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum("volume").alias("volume"), F.sum("trades").cast("bigint").alias("trades"))


def describe(df: DataFrame, cols: Sequence[str], approx: bool = False, key: str | None = None) -> DataFrame:
    """AGG-16: count, mean, sample std, min, median, max per column (one row per column).

    The columns are unpivoted to ``(column, value)`` once; one aggregation gives
    the moments and one distributed rank the exact medians of all columns (see
    :func:`gapseries.operators.ordered.exact_quantile`), instead of a
    ``percentile`` buffer with every distinct value in the final task;
    ``approx=True`` uses ``percentile_approx``. ``key`` (a unique column)
    breaks ties so that repeated values spread over partitions.
    """
    from gapseries.operators.ordered import exact_quantile
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols])
    long = df.select(*([F.col(key).alias("_key")] if key else []), F.explode(each).alias("_c")).select(
        *(["_key"] if key else []), "_c.*")
    x = F.col("value")
    aggs = [F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
            F.max(x).alias("max")]
    if approx:
        out = long.groupBy("column").agg(*aggs, F.percentile_approx(x, 0.5, 10000).cast("double").alias("median"))
    else:
        median = exact_quantile(long, "value", 0.5, by=["column"], out="median", tiebreak=["_key"] if key else [])
        out = long.groupBy("column").agg(*aggs).join(median, "column", "left")
    return out.select("column", "count", "mean", "std", "min", "median", "max")


def means(df: DataFrame, cols: Sequence[str], by=None) -> DataFrame:
    """AGG-17: averages of the given columns."""
    by = _list(by)
    return df.groupBy(*by).agg(*[F.avg(c).alias(f"avg_{c}") for c in cols])


def range_summary(df: DataFrame, by=None) -> DataFrame:
    """AGG-18: block range summary: blocks, time range, average gas, average and total transactions."""
    return df.groupBy(*_list(by)).agg(F.count(F.lit(1)).alias("blocks"), F.min("number").alias("first_block"),
                  F.max("number").alias("last_block"), F.min("timestamp").alias("start_ts"),
                  F.max("timestamp").alias("end_ts"),
                  ((F.unix_micros(F.max("timestamp")) - F.unix_micros(F.min("timestamp"))) / 1e6)
                  .alias("duration_s"),
                  F.avg("gas_used").alias("avg_gas_used"),
                  F.avg("transaction_count").alias("avg_tx"),
                  F.sum("transaction_count").cast("bigint").alias("total_tx"))


def tx_types(txs: DataFrame, col: str = "type") -> DataFrame:
    """AGG-19: transaction type distribution."""
    return txs.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def withdrawal_metrics(df: DataFrame, arr: str = "withdrawals", key: str = "number") -> DataFrame:
    """AGG-20: per block withdrawal count, total and average ETH, distinct recipients.

    Amounts arrive as hex gwei. Array functions work inside the row: no
    explode, no shuffle. Zeros for blocks without withdrawals.
    """
    from gapseries.functions.hexcodec import hex_to_decimal
    w = F.coalesce(F.col(arr), F.array().cast(df.schema[arr].dataType))
    amounts = F.transform(w, lambda x: hex_to_decimal(x["amount"]))
    total = F.aggregate(amounts, F.lit(0).cast("decimal(38,0)"), lambda acc, x: (acc + x).cast("decimal(38,0)"))
    n = F.size(w)
    total_eth = total.cast("double") / F.lit(1e9)
    return df.select(key, n.alias("withdrawal_count"), F.when(n > 0, total_eth).otherwise(F.lit(0.0))
                     .alias("total_eth_withdrawn"),
                     F.when(n > 0, total_eth / n).otherwise(F.lit(0.0)).alias("avg_withdrawal_eth"),
                     F.size(F.array_distinct(F.transform(w, lambda x: x["address"]))).alias("unique_recipients"))


def fee_trend(df: DataFrame, ts: str, fee: str, width: str = "1 hour", pct: float = 5.0, by=None) -> DataFrame:
    """AGG-21: first / last / min / max / avg fee per bucket, change % and trend label (±pct)."""
    by = _list(by)
    order = F.struct(F.col(ts), F.col("number")) if "number" in df.columns else F.col(ts)
    g = df.groupBy(*by, time_bucket(ts, width).alias("bucket")).agg(
        F.min_by(F.col(fee), order).alias("first_fee"), F.max_by(F.col(fee), order).alias("last_fee"),
        F.min(fee).alias("min_fee"), F.max(fee).alias("max_fee"), F.avg(fee).alias("avg_fee"))
    chg = F.try_divide((F.col("last_fee") - F.col("first_fee")) * 100.0, F.col("first_fee"))
    return g.withColumn("change_pct", chg).withColumn(
        "trend", F.when(F.col("change_pct") > pct, "increasing").when(F.col("change_pct") < -pct, "decreasing")
        .otherwise("stable"))


def congestion(df: DataFrame, ts: str, ratio: str, width: str = "1 hour", by=None) -> DataFrame:
    """AGG-22: mean gas ratio per bucket and level (< 0.5 low, < 0.8 moderate, else high)."""
    by = _list(by)
    g = df.groupBy(*by, time_bucket(ts, width).alias("bucket")).agg(
        F.avg(ratio).alias("avg_ratio"), F.count(F.lit(1)).alias("n"))
    return g.withColumn("level", F.when(F.col("avg_ratio") < 0.5, "low").when(F.col("avg_ratio") < 0.8, "moderate")
                        .otherwise("high"))


def correlation(df: DataFrame, a: str, b: str, by=None, window: int | None = None, order: str | None = None
                ) -> DataFrame:
    """AGG-23: Pearson correlation of two columns (per group), or over a trailing
    ``window`` of rows ordered by ``order`` (bucketed halo window, NULL until full)."""
    by = _list(by)
    if window:
        from gapseries.operators import ordered

        def build(w):
            f = w.rowsBetween(-(window - 1), 0)
            full = F.count(F.lit(1)).over(f) >= window
            r = F.try_divide(F.covar_samp(a, b).over(f), F.stddev_samp(a).over(f) * F.stddev_samp(b).over(f))
            return {f"corr_{a}_{b}_{window}": F.when(full, r)}
        return ordered.halo_window(df, [order], build, preceding=window - 1, by=by).drop(ordered.IDX)
    # NULL (not an error) when either side is constant
    r = F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b))
    return df.groupBy(*by).agg(r.alias(f"corr_{a}_{b}"), F.count(F.lit(1)).alias("n"))


def column_profile(df: DataFrame) -> DataFrame:
    """AGG-24: per column: type, rows and nulls, from one aggregation (unpivoted)."""
    nulls = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"_n{i}")
                                                       for i, f in enumerate(df.schema.fields)])
    each = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"), F.col("_rows").alias("rows"),
                     F.col(f"_n{i}").alias("nulls")) for i, f in enumerate(df.schema.fields)]
    return nulls.select(F.explode(F.array(*each)).alias("_c")).select("_c.*")


def storage_profile(df: DataFrame) -> DataFrame:
    """AGG-24 (re-aimed): rows and bytes per data file, from ``_metadata``."""
    m = df.select("_metadata.file_path", "_metadata.file_size")
    return m.groupBy("file_path").agg(F.count(F.lit(1)).alias("rows"), F.max("file_size").alias("file_bytes"))


def fee_history_summary(rows: DataFrame, by) -> DataFrame:
    """AGG-21 + AGG-22 + FN-16 per fee-history payload (decoded rows, see SRC-7).

    The base-fee series of a payload is the per-block fees plus the next
    block's fee (its newest value). Trend: change from the oldest to the
    newest value, ±5 %. Congestion: mean gas ratio < 0.5 low, < 0.8
    moderate, else high. Recommended fees: next base fee plus the
    25th/50th/75th priority percentile of the newest block.
    """
    by = _list(by)
    g = rows.groupBy(*by).agg(
        F.min_by("base_fee_per_gas", "number").alias("_oldest"), F.max("next_base_fee").alias("_next"),
        F.min("base_fee_per_gas").alias("_min"), F.max("base_fee_per_gas").alias("_max"),
        F.sum("base_fee_per_gas").alias("_sum"), F.count(F.lit(1)).alias("_n"),
        F.avg("gas_used_ratio").alias("_ratio"), F.coalesce(F.avg("blob_gas_used_ratio"), F.lit(0.0)).alias("_blob"),
        (F.max_by("gas_used_ratio", "number") > F.min_by("gas_used_ratio", "number")).alias("_rising"),
        F.max_by("reward_p25", "number").alias("_p25"), F.max_by("reward_p50", "number").alias("_p50"),
        F.max_by("reward_p75", "number").alias("_p75"))
    from gapseries.functions.features import recommended_fees
    rec = recommended_fees(F.col("_next"), F.array("_p25", "_p50", "_p75"))      # FN-16
    cur = F.col("_next") / F.lit(1e9)
    old = F.col("_oldest") / F.lit(1e9)
    chg = F.try_divide(cur - old, old) * F.lit(100)
    return g.select(
        *by, cur.alias("current_base_fee_gwei"),
        (F.least(F.col("_min"), F.col("_next")) / F.lit(1e9)).alias("min_base_fee_gwei"),
        (F.greatest(F.col("_max"), F.col("_next")) / F.lit(1e9)).alias("max_base_fee_gwei"),
        ((F.col("_sum") + F.col("_next")) / F.lit(1e9) / (F.col("_n") + 1)).alias("avg_base_fee_gwei"),
        chg.alias("base_fee_change_pct"),
        F.when(chg > 5, "increasing").when(chg < -5, "decreasing").otherwise("stable").alias("base_fee_trend"),
        (F.col("_ratio") * 100).alias("avg_gas_utilization_pct"), (F.col("_blob") * 100).alias("avg_blob_utilization_pct"),
        F.when(F.col("_ratio") < 0.5, "low").when(F.col("_ratio") < 0.8, "moderate").otherwise("high")
        .alias("congestion_level"),
        F.when(F.col("_rising"), "increasing").otherwise("decreasing").alias("recent_gas_trend"),
        *[rec[f"{k}_max_fee_gwei"].alias(f"{k}_max_fee_gwei") for k in ("slow", "standard", "fast")])

"""Window plans (lag, shift, rolling, z-scores, QUALIFY, forward fill)."""

from pyspark.sql import functions as F

from gapseries.operators import ordered, windows
from gapseries.operators.asof import asof_join, ffill
from gapseries.operators.ranges import grid_between
from gapseries.plans.registry import r9, register, round_doubles
from gapseries.plans.sqlviews import BARS, BLOCKS, PURCHASES, with_
from gapseries.sources import driver


def _util(spark, sf_dir):
    b = driver.blocks(spark, sf_dir, ["timestamp", "gas_used", "gas_limit", "base_fee_per_gas"])
    return b.select("number", "timestamp", "gas_used", "base_fee_per_gas",
                    (F.col("gas_used") / F.col("gas_limit")).alias("utilisation"),
                    (F.col("base_fee_per_gas") / F.lit(1e9)).alias("base_fee_gwei"))


UTIL = """util AS (
  SELECT number, "timestamp", gas_used, base_fee_per_gas, gas_used / gas_limit AS utilisation,
         base_fee_per_gas / 1e9 AS base_fee_gwei FROM blocks
)"""


@register("series_lags", "WIN-1 WIN-3 WIN-4", sql=with_(BLOCKS, UTIL) + """
SELECT number, prev_number, round(CASE WHEN prev_gas = 0 THEN NULL ELSE gas_used / prev_gas - 1 END, 9)
         AS gas_used_pct_change,
       round((epoch_us("timestamp") - epoch_us(prev_ts)) / 1e6, 9) AS block_time_s,
       number - prev_number - 1 AS skipped
FROM (SELECT number, gas_used, "timestamp", lag(number) OVER w AS prev_number, lag(gas_used) OVER w AS prev_gas,
             lag("timestamp") OVER w AS prev_ts FROM util WINDOW w AS (ORDER BY number)) t""")
def series_lags(spark, sf_dir):
    u = _util(spark, sf_dir).select("number", "gas_used", "timestamp")
    d = ordered.with_prev(u, "number", ["number", "gas_used", "timestamp"])
    return d.select(
        "number", "prev_number",
        r9(F.try_divide(F.col("gas_used"), F.col("prev_gas_used")) - 1).alias("gas_used_pct_change"),
        r9((F.unix_micros("timestamp") - F.unix_micros("prev_timestamp")) / F.lit(1e6)).alias("block_time_s"),
        (F.col("number") - F.col("prev_number") - 1).alias("skipped"))


@register("shift_targets", "WIN-2", sql=with_(BLOCKS, UTIL) + """
SELECT number, round(lead(utilisation, 5) OVER w, 9) AS target_5, round(lag(utilisation, 3) OVER w, 9) AS lag_3
FROM util WINDOW w AS (ORDER BY number)""")
def shift_targets(spark, sf_dir):
    u = _util(spark, sf_dir).select("number", "utilisation")
    out = ordered.halo_window(u, ["number"], lambda w: {
        "target_5": r9(F.lead("utilisation", 5).over(w)),
        "lag_3": r9(F.lag("utilisation", 3).over(w))}, preceding=3, following=5)
    return out.select("number", "target_5", "lag_3")


#: events whose key is missing for a tenth of the users
SOME_KEYS = """p AS (SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, CASE WHEN user_id % 10 <> 0 THEN user_id % 10 END AS k, value
  FROM events WHERE event_type <> 'error')"""


def _some_keys(spark, sf_dir):
    ev = driver.table(spark, sf_dir, "events").filter(F.col("event_type") != "error")
    k = F.col("user_id") % 10
    return ev.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.when(k != 0, k).alias("k"), "value")


@register("lags_by_key", "WIN-1 WIN-2 WIN-3 WIN-4 WIN-14", sql=with_(SOME_KEYS) + """
SELECT event_id, k, prev, round(CASE WHEN pv <> 0 THEN value / pv - 1 END, 9) AS value_pct_change, round(value - pv, 9) AS value_diff, back_3,
       ts >= pt AS ts_monotonic
FROM (SELECT *, lag(event_id) OVER w AS prev, lag(value) OVER w AS pv, lag(event_id, 3) OVER w AS back_3, lag(ts) OVER w AS pt
      FROM p WINDOW w AS (PARTITION BY k ORDER BY event_id)) t""")
def lags_by_key(spark, sf_dir):
    """Keyed lags over many buckets; rows without a key form a series like any other."""
    p = _some_keys(spark, sf_dir)
    d = ordered.with_prev(p, "event_id", ["event_id", "value", "ts"], by="k", width=512)
    back = ordered.halo_window(d, ["event_id"], lambda w: {"back_3": F.lag("event_id", 3).over(w)}, preceding=3, by="k", bucket_rows=100)
    return back.select("event_id", "k", F.col("prev_event_id").alias("prev"),
                       r9(F.try_divide(F.col("value"), F.col("prev_value")) - 1).alias("value_pct_change"),
                       r9(F.col("value") - F.col("prev_value")).alias("value_diff"), "back_3",
                       (F.col("ts") >= F.col("prev_ts")).alias("ts_monotonic"))


@register("zscore_by_key", "WIN-10", sql=with_(SOME_KEYS) + """
SELECT event_id, k, round((value - avg(value) OVER w) / (stddev_samp(value) OVER w + 1e-10), 9) AS value_z
FROM p WINDOW w AS (PARTITION BY k)""")
def zscore_by_key(spark, sf_dir):
    z = windows.zscore(_some_keys(spark, sf_dir), "value", by="k")
    return z.select("event_id", "k", r9("value_z").alias("value_z"))


@register("quantiles_by_key", "AGG-16", sql=with_(SOME_KEYS) + """
SELECT k, round(quantile_cont(value, 0.9), 9) AS value_q90 FROM p GROUP BY k""")
def quantiles_by_key(spark, sf_dir):
    q = ordered.exact_quantile(_some_keys(spark, sf_dir), "value", 0.9, by="k", tiebreak=["event_id"])
    return q.select("k", r9("value_q90").alias("value_q90"))


@register("asof_missing_keys", "JN-1", sql=with_(SOME_KEYS) + """,
l AS (SELECT * FROM p WHERE event_id % 2 = 0), r AS (SELECT event_id AS r_id, ts AS r_ts, k FROM p WHERE event_id % 2 = 1)
SELECT l.event_id, l.k, r.r_id, r.r_ts FROM l ASOF LEFT JOIN r ON l.k = r.k AND l.ts >= r.r_ts""")
def asof_missing_keys(spark, sf_dir):
    """Even events against odd ones, by key: a missing key matches nothing, as in an SQL join."""
    p = _some_keys(spark, sf_dir)
    r = p.filter("event_id % 2 = 1").select(F.col("event_id").alias("r_id"), F.col("ts").alias("r_ts"), "k")
    j = asof_join(p.filter("event_id % 2 = 0"), r, ("ts", "r_ts"), by="k", r_order=["r_id"])
    return j.select("event_id", "k", "r_id", "r_ts")


def _roll_sql(col: str, n: int, fn: str) -> str:
    agg = {"mean": f"avg({col})", "std": f"stddev_samp({col})", "sum": f"sum({col})",
           "median": f"quantile_cont({col}, 0.5)"}[fn]
    frame = f"(ORDER BY number ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"round(CASE WHEN count({col}) OVER {frame} >= {n} THEN {agg} OVER {frame} END, 9) AS {col}_{fn}_{n}"


ROLL_SPEC = [(12, "mean"), (60, "mean"), (25, "std"), (60, "median"), (60, "sum")]


@register("rolling_stats", "WIN-5 WIN-6 WIN-7 WIN-8", sql=with_(BLOCKS, UTIL) + "SELECT number, "
          + ", ".join(_roll_sql("utilisation", n, fn) for n, fn in ROLL_SPEC) + " FROM util")
def rolling_stats(spark, sf_dir):
    u = _util(spark, sf_dir).select("number", "utilisation")
    r = ordered.rolling_many(u, ["number"], [("utilisation", n, fn) for n, fn in ROLL_SPEC])
    return r.select("number", *[r9(f"utilisation_{fn}_{n}").alias(f"utilisation_{fn}_{n}") for n, fn in ROLL_SPEC])


DAY_SPEC = [(1440, "mean"), (1440, "std"), (1440, "sum"), (1440, "median")]


@register("rolling_day", "WIN-5 WIN-6 WIN-7 WIN-8", sql=with_(BLOCKS, UTIL) + "SELECT number, "
          + ", ".join(_roll_sql("utilisation", n, fn) for n, fn in DAY_SPEC) + " FROM util")
def rolling_day(spark, sf_dir):
    """Statistics over 1,440 blocks: a row costs what it costs over 60."""
    u = _util(spark, sf_dir).select("number", "utilisation")
    r = ordered.rolling_many(u, ["number"], [("utilisation", n, fn) for n, fn in DAY_SPEC])
    return r.select("number", *[r9(f"utilisation_{fn}_{n}").alias(f"utilisation_{fn}_{n}") for n, fn in DAY_SPEC])


@register("rolling_by_user", "WIN-5 WIN-6 WIN-7 WIN-9", sql=with_(SOME_KEYS) + """
SELECT event_id, k, round(CASE WHEN count(value) OVER w >= 30 THEN avg(value) OVER w END, 9) AS value_mean_30,
       round(CASE WHEN count(value) OVER w >= 30 THEN stddev_samp(value) OVER w END, 9) AS value_std_30,
       round(CASE WHEN count(value) OVER w >= 30 THEN quantile_cont(value, 0.5) OVER w END, 9) AS value_median_30,
       round(CASE WHEN count(value) OVER w >= 30 THEN max(value) OVER w END, 9) AS value_max_30
FROM p WINDOW w AS (PARTITION BY k ORDER BY event_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def rolling_by_user(spark, sf_dir):
    """Keyed statistics; rows without a key form a series of their own."""
    p = _some_keys(spark, sf_dir).drop("ts")
    fns = ["mean", "std", "median", "max"]
    r = ordered.rolling_many(p, ["event_id"], [("value", 30, fn) for fn in fns], by="k")
    return r.select("event_id", "k", *[r9(f"value_{fn}_30").alias(f"value_{fn}_30") for fn in fns])


@register("rolling_zscore", "WIN-9", sql=with_(BLOCKS, UTIL) + """
SELECT number,
  round(CASE WHEN count(base_fee_gwei) OVER w >= 60 THEN
        (base_fee_gwei - avg(base_fee_gwei) OVER w) / (stddev_samp(base_fee_gwei) OVER w + 1e-10) END, 9)
    AS base_fee_gwei_zscore_60
FROM util WINDOW w AS (ORDER BY number ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)""")
def rolling_zscore(spark, sf_dir):
    u = _util(spark, sf_dir).select("number", "base_fee_gwei")
    r = ordered.rolling(u, ["number"], "base_fee_gwei", 60, ["zscore"], eps=1e-10)
    return r.select("number", r9("base_fee_gwei_zscore_60").alias("base_fee_gwei_zscore_60"))


@register("zscore_by_user", "WIN-10", sql=with_(PURCHASES) + """
SELECT event_id, user_id, round(z, 9) AS value_z, abs(z) > 2.0 AS value_outlier FROM (
  SELECT event_id, user_id,
         CASE WHEN count(value) OVER u >= 10 THEN (value - avg(value) OVER u) / (stddev_samp(value) OVER u + 1e-10) END AS z
  FROM purchases WINDOW u AS (PARTITION BY user_id)) t""")
def zscore_by_user(spark, sf_dir):
    p = driver.purchases(spark, sf_dir).select("event_id", "user_id", "value")
    z = windows.zscore(p, "value", by="user_id", min_count=10, threshold=2.0)
    return z.select("event_id", "user_id", r9("value_z").alias("value_z"), "value_outlier")


@register("monotonic_check", "WIN-14", sql=with_(BLOCKS) + """
SELECT number, "timestamp" >= lag("timestamp") OVER w AS ts_monotonic, number = lag(number) OVER w + 1 AS contiguous
FROM blocks WINDOW w AS (ORDER BY number)""")
def monotonic_check(spark, sf_dir):
    b = driver.blocks(spark, sf_dir, ["timestamp"]).select("number", "timestamp")
    return windows.monotonic(b, "number", "timestamp").select("number", "ts_monotonic", "contiguous")


@register("rate_flags", "WIN-15 WIN-3", sql=with_(BLOCKS) + """
SELECT number, round(pc, 9) AS base_fee_per_gas_pct_change, abs(pc) < 0.5 AS base_fee_per_gas_rate_ok FROM (
  SELECT number, CASE WHEN lag(base_fee_per_gas) OVER w = 0 THEN NULL
                      ELSE base_fee_per_gas / lag(base_fee_per_gas) OVER w - 1 END AS pc
  FROM blocks WINDOW w AS (ORDER BY number)) t""")
def rate_flags(spark, sf_dir):
    b = driver.blocks(spark, sf_dir, ["base_fee_per_gas"]).select("number", "base_fee_per_gas")
    r = windows.rate_flag(b, "number", "base_fee_per_gas", 0.5)
    return r.select("number", r9("base_fee_per_gas_pct_change").alias("base_fee_per_gas_pct_change"),
                    "base_fee_per_gas_rate_ok")


@register("qualify_spikes", "WIN-11 WIN-5", sql=with_(BLOCKS, UTIL) + """
SELECT number, round(utilisation, 9) AS utilisation, round(m, 9) AS utilisation_mean_12 FROM (
  SELECT number, utilisation,
         CASE WHEN count(utilisation) OVER w >= 12 THEN avg(utilisation) OVER w END AS m
  FROM util WINDOW w AS (ORDER BY number ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)) t
WHERE utilisation > 1.5 * m""")
def qualify_spikes(spark, sf_dir):
    u = _util(spark, sf_dir).select("number", "utilisation")
    r = ordered.rolling(u, ["number"], "utilisation", 12, ["mean"])
    q = windows.filter_window(r, {}, F.col("utilisation") > F.lit(1.5) * F.col("utilisation_mean_12"))
    return q.select("number", r9("utilisation").alias("utilisation"),
                    r9("utilisation_mean_12").alias("utilisation_mean_12"))


@register("ffill_hourly", "WIN-13 FIL-12 JN-3", sql=with_(BARS) + """,
grid AS (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM bars)
SELECT g.ts, b.ts AS bar_ts, b.close AS close_prev, round(b.volume, 9) AS volume_prev
FROM grid g ASOF LEFT JOIN bars b ON g.ts >= b.ts""")
def ffill_hourly(spark, sf_dir):
    bars = driver.price_bars(spark, sf_dir)
    span = bars.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    grid = grid_between(span, "lo", "hi", 3600, "ts").select("ts")
    g = grid.join(bars.select("ts", F.col("ts").alias("bar_ts"), "close", "volume"), on="ts", how="left")
    out = ffill(g, "ts", ["bar_ts", "close", "volume"], present="bar_ts")
    return round_doubles(out.select("ts", "bar_ts", F.col("close").alias("close_prev"),
                                    F.col("volume").alias("volume_prev")))

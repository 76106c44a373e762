"""Feature plans: the row-local feature matrix, rolling pressure / velocity
features (two window passes) and cross-domain features after alignment."""

from pyspark.sql import functions as F

from gapseries.functions import features as X
from gapseries.operators import asof, ordered, windows
from gapseries.plans.registry import register, round_doubles
from gapseries.plans.sqlviews import BARS, BLOCKS, with_
from gapseries.session import cut_lineage
from gapseries.sources import driver

FM_SQL = """SELECT number,
  gas_used / gas_limit AS utilisation, gas_used / gas_limit * 100.0 AS utilisation_pct,
  CAST(gas_used / gas_limit > 0.5 AS INTEGER) AS high_congestion, base_fee_per_gas / 1e9 AS base_fee_gwei,
  transaction_count / size AS tx_density, size / transaction_count AS bytes_per_tx,
  gas_limit - gas_used AS gas_available,
  CASE WHEN transaction_count > 0 THEN gas_used / transaction_count ELSE 0.0 END AS avg_gas_per_tx,
  size / 1024.0 AS size_kb, size / 1048576.0 AS size_mb, COALESCE(blob_gas_used, 0) AS blob_gas,
  CAST(COALESCE(blob_gas_used, 0) > 0 AS INTEGER) AS has_blobs,
  COALESCE(blob_gas_used, 0) / 786432.0 AS blob_utilisation,
  CAST(floor(COALESCE(blob_gas_used, 0) / 131072) AS BIGINT) AS blob_count,
  CAST(hour("timestamp") AS INTEGER) AS hour, CAST(isodow("timestamp") - 1 AS INTEGER) AS day_of_week,
  isodow("timestamp") - 1 IN (5, 6) AS is_weekend, strftime("timestamp", '%Y%m') AS year_month,
  transaction_count / 12.0 AS tx_per_second
FROM blocks"""


@register("feature_matrix", "FN-28 FN-7 FN-8 FN-9 FN-10 FN-11 FN-12 FN-13 FN-24", sql=with_(BLOCKS) + f"""
SELECT * REPLACE (round(utilisation, 9) AS utilisation, round(utilisation_pct, 9) AS utilisation_pct,
                  round(tx_density, 9) AS tx_density, round(bytes_per_tx, 9) AS bytes_per_tx,
                  round(avg_gas_per_tx, 9) AS avg_gas_per_tx, round(size_kb, 9) AS size_kb,
                  round(size_mb, 9) AS size_mb, round(blob_utilisation, 9) AS blob_utilisation,
                  round(tx_per_second, 9) AS tx_per_second, round(base_fee_gwei, 9) AS base_fee_gwei)
FROM ({FM_SQL}) f""")
def feature_matrix(spark, sf_dir):
    b = driver.blocks(spark, sf_dir)
    fm = X.feature_matrix(b)
    return round_doubles(fm.drop(*[c for c in b.columns if c != "number"]))


PRESSURE_SQL = """pressure AS (
  SELECT number, "timestamp", base_fee_per_gas, gas_used, gas_limit, transaction_count,
         gas_used / gas_limit AS utilisation,
         CASE WHEN m60 = 0 THEN NULL ELSE base_fee_per_gas / m60 END AS gas_pressure_60,
         CASE WHEN m1440 = 0 THEN NULL ELSE base_fee_per_gas / m1440 END AS gas_pressure_1440,
         v60 AS tx_velocity_60
  FROM (SELECT *,
          CASE WHEN count(base_fee_per_gas) OVER w60 >= 60 THEN quantile_cont(base_fee_per_gas, 0.5) OVER w60 END AS m60,
          CASE WHEN count(base_fee_per_gas) OVER w1440 >= 1440
               THEN quantile_cont(base_fee_per_gas, 0.5) OVER w1440 END AS m1440,
          CASE WHEN count(transaction_count) OVER w60 >= 60 THEN sum(transaction_count) OVER w60 END AS v60
        FROM blocks
        WINDOW w60 AS (ORDER BY number ROWS BETWEEN 59 PRECEDING AND CURRENT ROW),
               w1440 AS (ORDER BY number ROWS BETWEEN 1439 PRECEDING AND CURRENT ROW)) t
),
congestion AS (
  SELECT *, 0.5 * gas_pressure_60 + 0.3 * utilisation
            + 0.2 * (CASE WHEN vm = 0 THEN NULL ELSE tx_velocity_60 / vm END) AS congestion_index
  FROM (SELECT *, CASE WHEN count(tx_velocity_60) OVER w >= 1440 THEN avg(tx_velocity_60) OVER w END AS vm
        FROM pressure WINDOW w AS (ORDER BY number ROWS BETWEEN 1439 PRECEDING AND CURRENT ROW)) t
)"""


def pressure_features(blocks):
    """FN-17 / FN-18: gas pressure vs rolling medians, tx velocity, congestion index.

    The congestion index needs a rolling mean *of* a rolling sum, so it
    runs as a second bucketed window pass over the first pass's output.
    """
    b = blocks.select("number", "timestamp", "base_fee_per_gas", "gas_used", "gas_limit", "transaction_count")
    p = ordered.rolling_many(b, ["number"], [("base_fee_per_gas", 60, "median"), ("base_fee_per_gas", 1440, "median"),
                                             ("transaction_count", 60, "sum")]).drop(ordered.IDX)
    p = p.select("number", "timestamp", "base_fee_per_gas", "gas_used", "gas_limit", "transaction_count",
                 X.utilisation().alias("utilisation"),
                 X.ratio("base_fee_per_gas", "base_fee_per_gas_median_60").alias("gas_pressure_60"),
                 X.ratio("base_fee_per_gas", "base_fee_per_gas_median_1440").alias("gas_pressure_1440"),
                 F.col("transaction_count_sum_60").alias("tx_velocity_60"))
    p2 = ordered.rolling_many(p, ["number"], [("tx_velocity_60", 1440, "mean")]).drop(ordered.IDX)
    return p2.withColumn("congestion_index", X.congestion_index("gas_pressure_60", "utilisation", "tx_velocity_60",
                                                                "tx_velocity_60_mean_1440")).drop(
        "tx_velocity_60_mean_1440")


@register("gas_pressure", "FN-17 FN-18 WIN-7 WIN-8 WIN-5", sql=with_(BLOCKS, PRESSURE_SQL) + """
SELECT number, round(gas_pressure_60, 9) AS gas_pressure_60, round(gas_pressure_1440, 9) AS gas_pressure_1440,
       tx_velocity_60, round(congestion_index, 9) AS congestion_index FROM congestion""")
def gas_pressure(spark, sf_dir):
    p = pressure_features(driver.blocks(spark, sf_dir))
    return round_doubles(p.select("number", "gas_pressure_60", "gas_pressure_1440", "tx_velocity_60",
                                  "congestion_index"))


ROLLING = list(X.ROLLING_FEATURES)


def _rolling_sql(n: str) -> str:
    column, [(rows, fn)], _ = X.ROLLING_FEATURES[n]
    agg = {"mean": f"avg({column})", "std": f"stddev_samp({column})", "sum": f"sum({column})", "median": f"quantile_cont({column}, 0.5)"}
    w = f"OVER (ORDER BY number ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    e = (f"({column} - avg({column}) {w}) / (stddev_samp({column}) {w} + 1e-10)" if fn == "zscore"
         else f"{column} / nullif({agg[fn]} {w}, 0)" if n.startswith("gas_pressure") else f"{agg[fn]} {w}")
    full = f"CASE WHEN count({column}) {w} >= {rows} THEN {e} END"
    return f"CAST({full} AS BIGINT) AS {n}" if fn == "sum" else f"round({full}, 9) AS {n}"


@register("feature_matrix_rolling", "FN-28 FN-17 FN-18 WIN-5 WIN-7 WIN-8 WIN-9", sql=with_(BLOCKS) + "SELECT number, round(utilisation, 9) AS utilisation, "
          + ", ".join(_rolling_sql(n) for n in ROLLING) + """
FROM (SELECT *, gas_used / gas_limit AS utilisation, base_fee_per_gas / 1e9 AS base_fee_gwei FROM blocks) b""")
def feature_matrix_rolling(spark, sf_dir):
    """Row-local and rolling features through the same call."""
    b = driver.blocks(spark, sf_dir, ["gas_used", "gas_limit", "base_fee_per_gas", "transaction_count"])
    m = X.feature_matrix(b, ["utilisation", *ROLLING]).select("number", "utilisation", *ROLLING)
    return round_doubles(m)


@register("network_velocity", "FN-23 WIN-4 WIN-10", sql=with_(BLOCKS) + """
SELECT number,
       round(CASE WHEN bt = 0 THEN NULL ELSE transaction_count / bt END, 9) AS tx_velocity,
       round((gas_used - avg(gas_used) OVER ()) / (stddev_samp(gas_used) OVER () + 1e-10), 9) AS congestion_z
FROM (SELECT *, (epoch_us("timestamp") - epoch_us(lag("timestamp") OVER (ORDER BY number))) / 1e6 AS bt FROM blocks) t""")
def network_velocity(spark, sf_dir):
    b = driver.blocks(spark, sf_dir, ["timestamp", "gas_used", "transaction_count"])
    d = windows.diff(b, "number", "timestamp", out="block_time_s")
    z = windows.zscore(d, "gas_used", by=None, min_count=1, eps=1e-10)
    return round_doubles(z.select("number", X.ratio("transaction_count", "block_time_s").alias("tx_velocity"),
                                  F.col("gas_used_z").alias("congestion_z")))


CROSS_SQL = """eth AS (
  SELECT "timestamp" AS eth_ts, number AS eth_number, gas_used AS eth_gas_used,
         base_fee_per_gas AS eth_base_fee_per_gas, gas_pressure_60 AS eth_gas_pressure_60 FROM pressure
),
mp AS (
  SELECT CAST(date_trunc('second', ts) AS TIMESTAMP) AS btc_ts, event_id AS btc_id,
         round(value / 10) + 2 AS btc_fastest_fee, value * 10000 / 1e6 AS btc_vsize_mb,
         user_id * 100 AS btc_unconfirmed_count, value * 1000000 / 1e8 AS btc_total_fee_btc
  FROM events
),
mpp AS (
  SELECT *, CASE WHEN m = 0 THEN NULL ELSE btc_fastest_fee / m END AS btc_fee_pressure_60
  FROM (SELECT *, CASE WHEN count(btc_fastest_fee) OVER w >= 60 THEN quantile_cont(btc_fastest_fee, 0.5) OVER w END AS m
        FROM mp WINDOW w AS (ORDER BY btc_ts, btc_id ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)) t
),
x AS (
  SELECT y.*, m.* FROM (SELECT b.*, e.* FROM bars b ASOF LEFT JOIN eth e ON b.ts >= e.eth_ts) y
  ASOF LEFT JOIN (SELECT * FROM mpp QUALIFY row_number() OVER (PARTITION BY btc_ts ORDER BY btc_id DESC) = 1) m ON y.ts >= m.btc_ts
),
xm AS (SELECT *, CASE WHEN lag(close) OVER (ORDER BY ts) = 0 THEN NULL
                      ELSE close / lag(close) OVER (ORDER BY ts) - 1 END AS price_momentum FROM x)"""


@register("cross_domain", "FN-20 FN-21 FN-22 FN-23 JN-4 WIN-3", sql=with_(BLOCKS, PRESSURE_SQL, BARS, CROSS_SQL) + """
SELECT ts,
  round((close - open) / (eth_base_fee_per_gas + 1), 9) AS gas_adjusted_return,
  round(volume / (trades + 1e-10), 9) AS volume_per_tx,
  round(price_momentum, 9) AS price_momentum,
  round(price_momentum * (1 + eth_gas_pressure_60), 9) AS network_confirmed_momentum,
  round(CASE WHEN volume = 0 THEN NULL ELSE eth_gas_used / volume END, 9) AS gas_per_volume,
  round(CASE WHEN close = 0 THEN NULL ELSE eth_base_fee_per_gas / 1e9 / close END, 9) AS fee_to_price,
  round(CASE WHEN btc_fee_pressure_60 = 0 THEN NULL ELSE eth_gas_pressure_60 / btc_fee_pressure_60 END, 9)
    AS relative_congestion,
  round(CASE WHEN btc_unconfirmed_count = 0 THEN NULL ELSE volume / btc_unconfirmed_count END, 9)
    AS volume_per_unconfirmed,
  round(CASE WHEN btc_vsize_mb = 0 THEN NULL ELSE btc_total_fee_btc / btc_vsize_mb END, 9) AS fee_efficiency,
  round(CASE WHEN btc_vsize_mb = 0 THEN NULL ELSE eth_gas_used / btc_vsize_mb END, 9) AS relative_activity
FROM xm""")
def cross_domain(spark, sf_dir):
    p = pressure_features(driver.blocks(spark, sf_dir))
    eth = p.select(F.col("timestamp").alias("eth_ts"), F.col("number").alias("eth_number"),
                   F.col("gas_used").alias("eth_gas_used"), F.col("base_fee_per_gas").alias("eth_base_fee_per_gas"),
                   F.col("gas_pressure_60").alias("eth_gas_pressure_60"))
    ev = driver.table(spark, sf_dir, "events")
    fee = F.round(F.col("value") / 10)
    mp = ev.select(F.date_trunc("second", F.col("ts").cast("timestamp")).alias("btc_ts"),
                   F.col("event_id").alias("btc_id"), (fee + 2).alias("btc_fastest_fee"),
                   (F.col("value") * 10000 / 1e6).alias("btc_vsize_mb"),
                   (F.col("user_id") * 100).alias("btc_unconfirmed_count"),
                   (F.col("value") * 1000000 / 1e8).alias("btc_total_fee_btc"))
    mpp = ordered.rolling_many(mp, ["btc_ts", "btc_id"], [("btc_fastest_fee", 60, "median")]).drop(ordered.IDX)
    mpp = mpp.withColumn("btc_fee_pressure_60", X.ratio("btc_fastest_fee", "btc_fastest_fee_median_60")).drop(
        "btc_fastest_fee_median_60")
    # the two feature tables are materialised in the shared checkpoint folder
    # before the as-of joins: each is reused and has a deep window lineage
    eth, mpp = cut_lineage(eth), cut_lineage(mpp)
    bars = driver.price_bars(spark, sf_dir)
    # both networks in one pass
    c = asof.carry(bars, "ts", [asof.Carried(eth, "eth_ts", ["eth_number"], "backward", "_eth"),
                                asof.Carried(mpp, "btc_ts", ["btc_id"], "backward", "_btc")])
    x = c.select(*[F.col(f"_as_l.{n}").alias(n) for n in bars.columns], "_eth.*", "_btc.*")
    x = windows.pct_change(x, "ts", "close", out="price_momentum")
    return round_doubles(x.select(
        "ts",
        X.gas_adjusted_return("open", "close", "eth_base_fee_per_gas").alias("gas_adjusted_return"),
        X.volume_per_tx().alias("volume_per_tx"),
        "price_momentum",
        X.confirmed_momentum("price_momentum", "eth_gas_pressure_60").alias("network_confirmed_momentum"),
        X.gas_per_volume("eth_gas_used", "volume").alias("gas_per_volume"),
        X.fee_to_price("eth_base_fee_per_gas", "close").alias("fee_to_price"),
        X.ratio("eth_gas_pressure_60", "btc_fee_pressure_60").alias("relative_congestion"),
        X.ratio("volume", "btc_unconfirmed_count").alias("volume_per_unconfirmed"),
        X.ratio("btc_total_fee_btc", "btc_vsize_mb").alias("fee_efficiency"),
        X.ratio("eth_gas_used", "btc_vsize_mb").alias("relative_activity")))

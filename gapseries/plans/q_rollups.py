"""Rollup, profile and summary plans (AGG-6..24)."""

from pyspark.sql import functions as F

from gapseries.operators import rollup
from gapseries.operators.ranges import block_range, label_era
from gapseries.plans.registry import register, round_doubles
from gapseries.plans.sqlviews import BARS, BLOCKS, SOURCES, with_
from gapseries.sources import driver, footers


UTIL_COLS = ["timestamp", "gas_used", "gas_limit", "base_fee_per_gas", "transaction_count", "size"]


def _util(b):
    return b.withColumn("utilisation", F.col("gas_used") / F.col("gas_limit")).withColumn(
        "base_fee_gwei", F.col("base_fee_per_gas") / F.lit(1e9))


UTIL = """util AS (SELECT *, gas_used / gas_limit AS utilisation, base_fee_per_gas / 1e9 AS base_fee_gwei FROM blocks)"""


@register("hourly_rollup", "AGG-6", sql=with_(BLOCKS) + """
SELECT date_trunc('hour', "timestamp") AS bucket, count(*) AS blocks,
       CAST(sum(transaction_count) AS BIGINT) AS tx, round(avg(gas_used), 9) AS avg_gas_used,
       max(base_fee_per_gas) AS max_base_fee
FROM blocks GROUP BY 1""")
def hourly_rollup(spark, sf_dir):
    b = driver.blocks(spark, sf_dir, ["timestamp", "transaction_count", "gas_used", "base_fee_per_gas"])
    return round_doubles(rollup.bucket(b, "timestamp", "1 hour", {
        "blocks": F.count(F.lit(1)), "tx": F.sum("transaction_count").cast("bigint"),
        "avg_gas_used": F.avg("gas_used"), "max_base_fee": F.max("base_fee_per_gas")}))


@register("price_bars", "AGG-7", sql=with_(BARS) + """
SELECT symbol, ts, open, high, low, close, round(volume, 9) AS volume, trades FROM bars""")
def price_bars(spark, sf_dir):
    return round_doubles(driver.price_bars(spark, sf_dir))


@register("block_stats", "AGG-8", sql=with_(BLOCKS) + """
SELECT count(*) AS blocks, min(number) AS first_block, max(number) AS last_block, min("timestamp") AS first_ts,
       max("timestamp") AS last_ts, round(avg(gas_used), 9) AS avg_gas_used, max(base_fee_per_gas) AS max_base_fee
FROM blocks""")
def block_stats(spark, sf_dir):
    return round_doubles(rollup.block_stats(driver.blocks(spark, sf_dir, ["timestamp", "gas_used", "base_fee_per_gas"])))


@register("orders_by_year", "AGG-9 SNK-7", sql="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS rows FROM orders GROUP BY 1""")
def orders_by_year(spark, sf_dir):
    # second domain: the same operator on a TPC-H-like table keyed by date
    return rollup.count_by_year(driver.table(spark, sf_dir, "orders").select("o_orderdate"), "o_orderdate")


@register("blocks_by_month", "FN-8 AGG-9", sql=with_(BLOCKS) + """
SELECT strftime("timestamp", '%Y%m') AS year_month, count(*) AS rows FROM blocks GROUP BY 1""")
def blocks_by_month(spark, sf_dir):
    return rollup.count_by_month(driver.blocks(spark, sf_dir, ["timestamp"]), "timestamp")


@register("first_seen", "AGG-13 SET-1", sql=with_(SOURCES) + """
SELECT number, min("timestamp") AS first_seen, string_agg(DISTINCT src, ',' ORDER BY src) AS sources,
       count(*) AS sightings
FROM (SELECT number, "timestamp", 'primary' AS src FROM src_primary
      UNION ALL SELECT number, "timestamp", 'backfill' AS src FROM src_backfill) u
GROUP BY number""")
def first_seen(spark, sf_dir):
    a = driver.source_blocks(spark, sf_dir, "primary").select("number", "timestamp", F.lit("primary").alias("src"))
    b = driver.source_blocks(spark, sf_dir, "backfill").select("number", "timestamp", F.lit("backfill").alias("src"))
    return rollup.first_seen(a.unionByName(b), "number", "timestamp", "src")


@register("series_profile", "AGG-14 T20", sql="""
SELECT event_type, count(*) AS n, min(CAST(ts AS TIMESTAMP)) AS first_ts, max(CAST(ts AS TIMESTAMP)) AS last_ts,
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 9) AS span_s,
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 / count(*), 9) AS avg_interval_by_count,
       round(CASE WHEN count(*) > 1 THEN (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 / (count(*) - 1) END, 9)
         AS avg_interval_s
FROM events GROUP BY event_type""")
def series_profile(spark, sf_dir):
    ev = driver.table(spark, sf_dir, "events").select("event_type", F.col("ts").cast("timestamp").alias("ts"))
    return round_doubles(rollup.series_profile(ev, "ts", by="event_type"))


@register("bar_summary", "AGG-15", sql=with_(BARS) + """
SELECT symbol, count(*) AS bars, min(ts) AS first_ts, max(ts) AS last_ts, min(low) AS low, max(high) AS high,
       round(sum(volume), 9) AS volume, CAST(sum(trades) AS BIGINT) AS trades
FROM bars GROUP BY symbol""")
def bar_summary(spark, sf_dir):
    return round_doubles(rollup.bar_summary(driver.price_bars(spark, sf_dir)))


DESCRIBE_COLS = ["utilisation", "base_fee_gwei", "transaction_count"]


def _describe_sql(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT '{c}' AS \"column\", count({x}) AS count, round(avg({x}), 9) AS mean, "
            f"round(stddev_samp({x}), 9) AS std, round(min({x}), 9) AS min, "
            f"round(quantile_cont({x}, 0.5), 9) AS median, round(max({x}), 9) AS max FROM util")


@register("describe_blocks", "AGG-16", sql=with_(BLOCKS, UTIL) + "\nUNION ALL\n".join(
    _describe_sql(c) for c in DESCRIBE_COLS))
def describe_blocks(spark, sf_dir):
    return round_doubles(rollup.describe(_util(driver.blocks(spark, sf_dir, UTIL_COLS)), DESCRIBE_COLS, key="number"))


@register("means_by_era", "AGG-17 JN-9", sql=with_(BLOCKS, UTIL) + """
SELECT CASE WHEN number >= 9713 THEN 'dencun' WHEN number >= 7768 THEN 'merge'
            WHEN number >= 6482 THEN 'london' ELSE 'pre_london' END AS era,
       round(avg(utilisation), 9) AS avg_utilisation, round(avg(base_fee_gwei), 9) AS avg_base_fee_gwei,
       round(avg(transaction_count), 9) AS avg_transaction_count
FROM util GROUP BY 1""")
def means_by_era(spark, sf_dir):
    b = label_era(_util(driver.blocks(spark, sf_dir, UTIL_COLS)), driver.scaled_eras())
    return round_doubles(rollup.means(b, ["utilisation", "base_fee_gwei", "transaction_count"], by="era"))


@register("range_summary", "AGG-18 FIL-13", sql=with_(BLOCKS) + """
SELECT CAST(floor(number / 1000) AS BIGINT) AS chunk_id, count(*) AS blocks, min(number) AS first_block,
       max(number) AS last_block, min("timestamp") AS start_ts, max("timestamp") AS end_ts,
       round((epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 1e6, 9) AS duration_s,
       round(avg(gas_used), 9) AS avg_gas_used, round(avg(transaction_count), 9) AS avg_tx,
       CAST(sum(transaction_count) AS BIGINT) AS total_tx
FROM blocks GROUP BY 1""")
def range_summary(spark, sf_dir):
    b = block_range(driver.blocks(spark, sf_dir, ["timestamp", "gas_used", "transaction_count"]), 0, 1 << 62, chunk=1000)
    summary = rollup.range_summary(b, by="chunk_id")
    return round_doubles(summary)


@register("fee_trend", "AGG-21 FN-25", sql=with_(BLOCKS, UTIL) + """
SELECT bucket, first_fee, last_fee, min_fee, max_fee, round(avg_fee, 9) AS avg_fee, round(change_pct, 9) AS change_pct,
       CASE WHEN change_pct > 5 THEN 'increasing' WHEN change_pct < -5 THEN 'decreasing' ELSE 'stable' END AS trend
FROM (SELECT date_trunc('hour', "timestamp") AS bucket,
             arg_min(base_fee_gwei, ("timestamp", number)) AS first_fee,
             arg_max(base_fee_gwei, ("timestamp", number)) AS last_fee,
             min(base_fee_gwei) AS min_fee, max(base_fee_gwei) AS max_fee, avg(base_fee_gwei) AS avg_fee,
             CASE WHEN arg_min(base_fee_gwei, ("timestamp", number)) = 0 THEN NULL ELSE
               (arg_max(base_fee_gwei, ("timestamp", number)) - arg_min(base_fee_gwei, ("timestamp", number))) * 100.0
               / arg_min(base_fee_gwei, ("timestamp", number)) END AS change_pct
      FROM util GROUP BY 1) t""")
def fee_trend(spark, sf_dir):
    b = _util(driver.blocks(spark, sf_dir, UTIL_COLS))
    return round_doubles(rollup.fee_trend(b, "timestamp", "base_fee_gwei", "1 hour", 5.0))


@register("congestion", "AGG-22 FN-25", sql=with_(BLOCKS, UTIL) + """
SELECT bucket, round(avg_ratio * 1e12) / 1e12 AS avg_ratio, n,
       CASE WHEN avg_ratio < 0.5 THEN 'low' WHEN avg_ratio < 0.8 THEN 'moderate' ELSE 'high' END AS level
FROM (SELECT date_trunc('hour', "timestamp") AS bucket, avg(utilisation) AS avg_ratio, count(*) AS n
      FROM util GROUP BY 1) t""")
def congestion(spark, sf_dir):
    b = _util(driver.blocks(spark, sf_dir, UTIL_COLS))
    # the hourly mean of ratios often ends exactly on a 10th-decimal 5; 12 decimals keep ties away
    return round_doubles(rollup.congestion(b, "timestamp", "utilisation", "1 hour"), 12)


@register("daily_correlation", "AGG-23", sql=with_(BLOCKS, UTIL) + """
SELECT CAST("timestamp" AS DATE) AS day, round(CASE WHEN stddev_samp(utilisation) * stddev_samp(base_fee_gwei) <> 0
                  THEN corr(utilisation, base_fee_gwei) END, 9) AS corr_utilisation_base_fee_gwei,
       count(*) AS n
FROM util GROUP BY 1""")
def daily_correlation(spark, sf_dir):
    b = _util(driver.blocks(spark, sf_dir, UTIL_COLS)).withColumn("day", F.to_date("timestamp"))
    return round_doubles(rollup.correlation(b, "utilisation", "base_fee_gwei", by="day"))


#: The twins below read file metadata, which views do not show: they name the oracle's own folder.
ORACLE_DIR = "/root/testdata/sf0.01"


@register("storage_profile", "AGG-24", sql=f"""
SELECT b.filename AS file_path, m.num_rows AS rows, CAST(b.size AS BIGINT) AS file_bytes
FROM read_blob('{ORACLE_DIR}/lineitem.parquet') b, parquet_file_metadata('{ORACLE_DIR}/lineitem.parquet') m""")
def storage_profile(spark, sf_dir):
    """Rows and bytes per data file of the largest driver table."""
    files = rollup.storage_profile(driver.table(spark, sf_dir, "lineitem"))
    return files.withColumn("file_path", F.regexp_replace("file_path", "^file:/+", "/"))


STORED = ("lineitem", "events", "documents")


@register("column_storage", "AGG-24", sql=" UNION ALL ".join(f"""
SELECT '{t}' AS "table", path_in_schema AS "column", min(type) AS type, CAST(count(*) AS BIGINT) AS row_groups,
       CAST(sum(row_group_num_rows) AS BIGINT) AS rows, CAST(sum(num_values) AS BIGINT) AS "values", CAST(sum(stats_null_count) AS BIGINT) AS nulls,
       CAST(sum(total_compressed_size) AS BIGINT) AS compressed_bytes, CAST(sum(total_uncompressed_size) AS BIGINT) AS plain_bytes,
       round(sum(total_uncompressed_size) / sum(total_compressed_size), 9) AS ratio
FROM parquet_metadata('{ORACLE_DIR}/{t}.parquet') GROUP BY path_in_schema""" for t in STORED))
def column_storage(spark, sf_dir):
    """Stored size of every column of three tables, from the footers alone."""
    out = None
    for t in STORED:
        one = footers.column_storage(spark, f"{sf_dir}/{t}.parquet").drop("files").withColumn("table", F.lit(t))
        out = one if out is None else out.unionByName(one)
    return round_doubles(out)

"""Join plans: as-of, alignment, fusion, nearest, set differences, source comparison."""

from pyspark.sql import functions as F

from gapseries.operators import asof, rollup, sets
from gapseries.plans.registry import register, round_doubles
from gapseries.plans.sqlviews import BARS, BLOCKS, PURCHASES, SOURCES, TXS, VIEWS, with_
from gapseries.sources import driver


@register("asof_purchase_view", "JN-1", sql=with_(PURCHASES, VIEWS) + """
SELECT p.event_id, p.ts, p.user_id, p.value, v.view_id, v.ts AS ts_right, v.view_value
FROM purchases p ASOF LEFT JOIN views v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def asof_purchase_view(spark, sf_dir):
    return asof.asof_join(driver.purchases(spark, sf_dir), driver.views(spark, sf_dir), "ts", by="user_id",
                          r_order=["view_id"])


NET = 'SELECT "timestamp", number, gas_used, base_fee_per_gas FROM blocks'


@register("align_with_ohlcv", "JN-2", sql=with_(BARS, BLOCKS) + f""",
net AS ({NET})
SELECT b.symbol, b.ts, b.open, b.high, b.low, b.close, round(b.volume, 9) AS volume, b.trades,
       n."timestamp", n.number, n.gas_used, n.base_fee_per_gas
FROM bars b ASOF LEFT JOIN net n ON b.ts >= n."timestamp\"""")
def align_with_ohlcv(spark, sf_dir):
    net = driver.blocks(spark, sf_dir, ["timestamp", "gas_used", "base_fee_per_gas"]).select(
        "timestamp", "number", "gas_used", "base_fee_per_gas")
    return round_doubles(asof.align_with_ohlcv(driver.price_bars(spark, sf_dir), net))


@register("exact_join_hourly", "JN-3 AGG-6", sql=with_(BARS, BLOCKS) + """,
hourly AS (SELECT date_trunc('hour', "timestamp") AS ts, count(*) AS blocks, CAST(sum(gas_used) AS BIGINT) AS gas
           FROM blocks GROUP BY 1)
SELECT b.ts, b.close, b.trades, h.blocks, h.gas FROM bars b LEFT JOIN hourly h ON b.ts = h.ts""")
def exact_join_hourly(spark, sf_dir):
    bars = driver.price_bars(spark, sf_dir).select("ts", "close", "trades")
    hourly = rollup.bucket(driver.blocks(spark, sf_dir, ["timestamp", "gas_used"]), "timestamp", "1 hour",
                           {"blocks": F.count(F.lit(1)), "gas": F.sum("gas_used").cast("bigint")}, out="ts")
    return asof.exact_join(bars, hourly, "ts")


@register("fuse_sources", "JN-4 T22", sql=with_(BARS, BLOCKS, VIEWS) + """,
eth AS (SELECT "timestamp" AS eth_timestamp, number AS eth_number, gas_used AS eth_gas_used FROM blocks),
net AS (SELECT ts AS net_ts, view_id AS net_view_id, view_value AS net_view_value FROM views)
SELECT x.ts, x.close, x.eth_timestamp, x.eth_number, x.eth_gas_used, n.net_ts, n.net_view_id, n.net_view_value
FROM (SELECT b.ts, b.close, e.* FROM bars b ASOF LEFT JOIN eth e ON b.ts >= e.eth_timestamp) x
ASOF LEFT JOIN net n ON x.ts >= n.net_ts""")
def fuse_sources(spark, sf_dir):
    bars = driver.price_bars(spark, sf_dir).select("ts", "close")
    eth = driver.blocks(spark, sf_dir, ["timestamp", "gas_used"]).select("timestamp", "number", "gas_used")
    net = driver.views(spark, sf_dir).select(F.col("ts").alias("timestamp"), "view_id", "view_value")
    out = asof.fuse(bars, {"eth": eth, "net": net})
    return out.withColumnRenamed("net_timestamp", "net_ts")


@register("nearest_block", "JN-8", sql=with_(BARS, BLOCKS) + """,
t AS (SELECT ts FROM bars),
bk AS (SELECT t.ts, k.number AS b_key, k."timestamp" AS b_ts FROM t ASOF LEFT JOIN blocks k ON t.ts >= k."timestamp"),
fw AS (SELECT bk.*, k.number AS f_key, k."timestamp" AS f_ts FROM bk ASOF LEFT JOIN blocks k ON bk.ts <= k."timestamp"),
d AS (SELECT ts, b_key, b_ts, f_key, f_ts, (epoch_us(ts) - epoch_us(b_ts)) / 1e6 AS db,
             (epoch_us(f_ts) - epoch_us(ts)) / 1e6 AS df FROM fw),
p AS (SELECT ts, CASE WHEN f_ts IS NULL OR (b_ts IS NOT NULL AND (db < df OR (db = df AND b_key <= f_key)))
                      THEN true ELSE false END AS pick_b, * EXCLUDE (ts) FROM d)
SELECT ts, CASE WHEN (CASE WHEN pick_b THEN db ELSE df END) <= 300 THEN (CASE WHEN pick_b THEN b_key ELSE f_key END) END
         AS nearest_number,
       CASE WHEN (CASE WHEN pick_b THEN db ELSE df END) <= 300 THEN (CASE WHEN pick_b THEN b_ts ELSE f_ts END) END
         AS nearest_timestamp,
       CASE WHEN (CASE WHEN pick_b THEN db ELSE df END) <= 300 THEN round(CASE WHEN pick_b THEN db ELSE df END, 9) END
         AS distance_s
FROM p""")
def nearest_block(spark, sf_dir):
    targets = driver.price_bars(spark, sf_dir).select("ts")
    return round_doubles(asof.nearest(targets, driver.blocks(spark, sf_dir, ["timestamp"]), "ts", "timestamp", "number",
                                      tolerance_s=300))


@register("effective_price", "JN-11 FN-14 FN-15", sql=with_(BLOCKS, TXS) + """
SELECT t.tx_hash, t.block_number, t.type,
       CASE WHEN t.type = 2 THEN 'EIP-1559' WHEN t.type = 1 THEN 'EIP-2930' ELSE 'Legacy' END AS tx_type,
       CASE WHEN t.type = 2 THEN b.base_fee_per_gas + least(t.max_priority_fee_per_gas, t.max_fee_per_gas - b.base_fee_per_gas)
            ELSE t.gas_price END AS effective_gas_price,
       CASE WHEN t.type = 2 THEN least(t.max_priority_fee_per_gas, t.max_fee_per_gas - b.base_fee_per_gas)
            ELSE t.gas_price - b.base_fee_per_gas END AS effective_priority_fee,
       CAST(t.value_wei AS DOUBLE) / 1e18 AS value_eth,
       t.to_address IS NOT NULL AND CAST(t.value_wei AS DOUBLE) / 1e18 = 0 AS is_contract_call,
       CAST(t.value_wei AS DOUBLE) / 1e18 > 0 AS is_eth_transfer
FROM txs t JOIN blocks b ON t.block_number = b.number""")
def effective_price(spark, sf_dir):
    return round_doubles(sets.effective_price(driver.transactions(spark, sf_dir),
                                            driver.blocks(spark, sf_dir, ["base_fee_per_gas"])))


@register("tx_types", "AGG-19", sql=with_(TXS) + "SELECT type, count(*) AS n FROM txs GROUP BY type")
def tx_types(spark, sf_dir):
    return rollup.tx_types(driver.transactions(spark, sf_dir))


@register("pending_not_included", "JN-12", sql=with_(BLOCKS, TXS) + """
SELECT tx_hash, block_number, type FROM txs t
WHERE NOT EXISTS (SELECT 1 FROM txs i JOIN blocks b ON i.block_number = b.number WHERE i.tx_hash = t.tx_hash)""")
def pending_not_included(spark, sf_dir):
    txs = driver.transactions(spark, sf_dir)
    included = txs.join(driver.blocks(spark, sf_dir, ["number"]).select(F.col("number").alias("block_number")),
                        "block_number", "left_semi")
    return sets.exclude_included(txs.select("tx_hash", "block_number", "type"), included, "tx_hash")


@register("compare_sources", "JN-13", sql=with_(SOURCES) + """
SELECT COALESCE(a.number, b.number) AS number, a.number IS NOT NULL AS in_primary, b.number IS NOT NULL AS in_backfill,
       CASE WHEN a.number IS NOT NULL AND b.number IS NOT NULL THEN a."timestamp" IS DISTINCT FROM b."timestamp" END
         AS timestamp_differs,
       CASE WHEN a.number IS NOT NULL AND b.number IS NOT NULL THEN a.gas_used IS DISTINCT FROM b.gas_used END
         AS gas_used_differs,
       CASE WHEN a.number IS NOT NULL AND b.number IS NOT NULL THEN a.blob_gas_used IS DISTINCT FROM b.blob_gas_used END
         AS blob_gas_used_differs
FROM src_primary a FULL OUTER JOIN src_backfill b ON a.number = b.number""")
def compare_sources(spark, sf_dir):
    a = driver.source_blocks(spark, sf_dir, "primary")
    b = driver.source_blocks(spark, sf_dir, "backfill")
    return sets.compare_sources(a, b, "number", ["timestamp", "gas_used", "blob_gas_used"],
                                names=("primary", "backfill"))


@register("unify_sources", "SET-1 SNK-2", sql=with_(SOURCES) + """
SELECT * EXCLUDE (_rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY number ORDER BY _ingest_seq DESC) AS _rn FROM (
    SELECT *, CAST(1 AS BIGINT) AS _ingest_seq FROM src_primary
    UNION ALL SELECT *, CAST(3 AS BIGINT) AS _ingest_seq FROM src_backfill) u) t WHERE _rn = 1""")
def unify_sources(spark, sf_dir):
    a = driver.source_blocks(spark, sf_dir, "primary").withColumn("_ingest_seq", F.lit(1).cast("bigint"))
    b = driver.source_blocks(spark, sf_dir, "backfill").withColumn("_ingest_seq", F.lit(3).cast("bigint"))
    return sets.unify(a, b, "number")


@register("insert_ignore", "SNK-3", sql=with_(SOURCES) + """
SELECT b.* FROM src_backfill b WHERE NOT EXISTS (SELECT 1 FROM src_primary a WHERE a.number = b.number)""")
def insert_ignore(spark, sf_dir):
    a = driver.source_blocks(spark, sf_dir, "primary")
    b = driver.source_blocks(spark, sf_dir, "backfill")
    return sets.insert_ignore(a, b, "number")

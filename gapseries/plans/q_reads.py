"""Range, latest-N and dedup reads over the derived block table."""

from pyspark.sql import functions as F

from gapseries.operators import ranges
from gapseries.operators.latest import latest
from gapseries.plans.registry import register
from gapseries.plans.sqlviews import BLOCKS, RAW_BLOCKS, with_
from gapseries.sources import driver

STD = ('"timestamp", number, gas_limit, gas_used, base_fee_per_gas, transaction_count, size, '
       'blob_gas_used, excess_blob_gas')


@register("fetch_blocks_latest", "FIL-4 SRC-1 FIL-1 FIL-2 TOP-1", sql=with_(BLOCKS) + f"""
SELECT {STD} FROM blocks
WHERE "timestamp" >= TIMESTAMP '2024-01-05 00:00:00' AND "timestamp" < TIMESTAMP '2024-01-06 00:00:00'
ORDER BY number DESC LIMIT 100""")
def fetch_blocks_latest(spark, sf_dir):
    # latest 100 blocks of one day (date-only end covers the whole day)
    return ranges.fetch_blocks(driver.raw_blocks(spark, sf_dir), start="2024-01-05", end="2024-01-05", limit=100)


@register("fetch_blocks_range", "FIL-4 FIL-1 FIL-2 SRC-1", sql=with_(BLOCKS) + f"""
SELECT {STD}, difficulty, total_difficulty FROM blocks
WHERE "timestamp" >= TIMESTAMP '2024-01-03 12:30:00' AND "timestamp" < TIMESTAMP '2024-01-21 00:00:00'""")
def fetch_blocks_range(spark, sf_dir):
    return ranges.fetch_blocks(driver.raw_blocks(spark, sf_dir), start="2024-01-03 12:30:00", end="2024-01-20",
                               include_deprecated=True)


@register("fetch_blocks_limit_only", "FIL-4 TOP-1", sql=with_(BLOCKS) + f"""
SELECT {STD} FROM blocks ORDER BY number DESC LIMIT 1000""")
def fetch_blocks_limit_only(spark, sf_dir):
    return ranges.fetch_blocks(driver.raw_blocks(spark, sf_dir), limit=1000)


MOVED = """moved AS (SELECT * REPLACE (CASE WHEN _ingest_seq = 2 THEN "timestamp" + to_days(CAST(number % 5 AS INTEGER)) ELSE "timestamp" END AS "timestamp")
  FROM raw_blocks), newest AS (SELECT * EXCLUDE (_rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY number ORDER BY _ingest_seq DESC) AS _rn FROM moved) WHERE _rn = 1)"""


def _moved(spark, sf_dir):
    raw = driver.raw_blocks(spark, sf_dir)
    days = F.when(F.col("_ingest_seq") == 2, F.col("number") % 5).otherwise(F.lit(0)).cast("int")
    return raw.withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(days))


@register("fetch_blocks_moved", "FIL-4 FIL-1", sql=with_(RAW_BLOCKS, MOVED) + f"""
SELECT {STD} FROM newest WHERE "timestamp" >= TIMESTAMP '2024-01-05 00:00:00' AND "timestamp" < TIMESTAMP '2024-01-08 00:00:00'""")
def fetch_blocks_moved(spark, sf_dir):
    """Revisions that move a block to another day: it leaves the old range and enters the new one."""
    return ranges.fetch_blocks(_moved(spark, sf_dir), start="2024-01-05", end="2024-01-07")


@register("fetch_blocks_moved_latest", "FIL-4 TOP-1", sql=with_(RAW_BLOCKS, MOVED) + f"""
SELECT {STD} FROM newest WHERE "timestamp" < TIMESTAMP '2024-01-15 12:00:00' ORDER BY number DESC LIMIT 500""")
def fetch_blocks_moved_latest(spark, sf_dir):
    return ranges.fetch_blocks(_moved(spark, sf_dir), end="2024-01-15 12:00:00", limit=500)


@register("latest_dedup", "SRC-1 WIN-12 SNK-2", sql=with_(RAW_BLOCKS) + """
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY number ORDER BY _ingest_seq DESC) AS _rn FROM raw_blocks
) WHERE _rn = 1""".replace("SELECT * FROM (", "SELECT * EXCLUDE (_rn) FROM ("))
def latest_dedup(spark, sf_dir):
    return latest(driver.raw_blocks(spark, sf_dir), "number", "_ingest_seq")


@register("era_labels", "JN-9 FIL-5 META-2", sql=with_(BLOCKS) + """
SELECT CASE WHEN number >= 9713 THEN 'dencun' WHEN number >= 7768 THEN 'merge'
            WHEN number >= 6482 THEN 'london' ELSE 'pre_london' END AS era,
       count(*) AS blocks, min(number) AS first_block, max(number) AS last_block
FROM blocks GROUP BY 1""")
def era_labels(spark, sf_dir):
    b = ranges.label_era(driver.blocks(spark, sf_dir, ["number"]), driver.scaled_eras())
    return b.groupBy("era").agg(F.count(F.lit(1)).alias("blocks"), F.min("number").alias("first_block"),
                                F.max("number").alias("last_block"))


@register("era_masked", "FIL-6 FIL-5 FIL-8", sql=with_(BLOCKS) + """
SELECT number,
       CASE WHEN number >= 6482 THEN base_fee_per_gas END AS base_fee_per_gas,
       CASE WHEN number >= 9713 THEN blob_gas_used END AS blob_gas_used,
       COALESCE(CASE WHEN number >= 9713 THEN blob_gas_used END, 0) AS blob_gas_filled
FROM blocks WHERE number >= 6482""")
def era_masked(spark, sf_dir):
    b = driver.blocks(spark, sf_dir, ["base_fee_per_gas", "blob_gas_used", "excess_blob_gas"])
    b = ranges.era_filter(b, driver.SCALED_LONDON)
    m = ranges.mask_by_era(b, driver.scaled_contract()).select("number", "base_fee_per_gas", "blob_gas_used")
    m = m.withColumn("blob_gas_filled", F.col("blob_gas_used"))
    return ranges.fill_nulls(m, ["blob_gas_filled"], 0)


@register("high_utilisation", "FIL-7", sql=with_(BLOCKS) + """
SELECT number, gas_used FROM blocks WHERE gas_used > 15000000""")
def high_utilisation(spark, sf_dir):
    b = driver.blocks(spark, sf_dir, ["gas_used"])
    return ranges.above(b, "gas_used", 15_000_000).select("number", "gas_used")

"""Plans of operators that other plans do not reach: year and look-back reads, CSV blocks, schema diff,
range copies, stored defaults, withdrawals, missed-key append, state expiry, the era table, landed
mempool streams, windowed correlation, column profiles, decoders fed with bad records."""

import os
import uuid

from pyspark.sql import functions as F

from gapseries.operators import gaps as G
from gapseries.operators import asof, ordered, rollup, sets
from gapseries.plans.q_gaps import GAPS, _gaps_sql
from gapseries.plans.q_streaming import _finish
from gapseries.plans.registry import register, round_doubles
from gapseries.plans.sqlviews import BLOCKS, PURCHASES, SOURCES, VIEWS, with_
from gapseries.session import scratch_path
from gapseries.sinks import writers as W
from gapseries.sources import contract as C
from gapseries.sources import decoders as D
from gapseries.sources import driver

AS_OF = "2024-01-31 00:00:00"


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


@register("read_years", "SRC-2", sql="""
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '1994-01-01' AND o_orderdate < DATE '1996-01-01'""")
def read_years(spark, sf_dir):
    return D.read_years(driver.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), 1994, 1996, "o_orderdate")


@register("read_lookback", "SRC-3", sql=with_(BLOCKS) + """
SELECT number, "timestamp" FROM blocks
WHERE "timestamp" >= TIMESTAMP '2024-01-29 00:00:00' AND "timestamp" < TIMESTAMP '2024-01-31 00:00:00'""")
def read_lookback(spark, sf_dir):
    return D.read_lookback(driver.blocks(spark, sf_dir, ["timestamp"]), 48, AS_OF)


@register("csv_blocks", "SRC-10 SNK-5", sql=with_(BLOCKS) + """
SELECT number AS block_number, date_trunc('second', "timestamp") AS ts, gas_used, gas_limit, base_fee_per_gas,
       CAST(transaction_count AS INTEGER) AS tx_count FROM blocks""")
def csv_blocks(spark, sf_dir):
    """Export all blocks in the CSV layout of the block-range files and read them back with the declared schema."""
    b = driver.blocks(spark, sf_dir)
    text = F.concat(F.lit("0x"), F.sha1(F.col("number").cast("string").cast("binary")))
    rows = b.select(F.col("number").alias("block_number"), F.unix_seconds("timestamp").alias("timestamp"),
                    F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("datetime_utc"), text.alias("hash"),
                    text.alias("parent_hash"), text.alias("miner"), "gas_used", "gas_limit", "base_fee_per_gas",
                    F.col("transaction_count").alias("tx_count"))
    path = os.path.join(_scratch(spark, "csv"), "blocks")
    W.export(rows, path, "csv")
    return D.read_csv_blocks(spark, path).select("block_number", "ts", "gas_used", "gas_limit", "base_fee_per_gas", "tx_count")


@register("export_formats", "SNK-11", sql=with_(BLOCKS) + """
SELECT f.fmt, count(*) AS blocks, CAST(sum(transaction_count) AS BIGINT) AS tx, max("timestamp") AS newest
FROM blocks, (VALUES ('csv'), ('json'), ('parquet')) f(fmt) GROUP BY f.fmt""")
def export_formats(spark, sf_dir):
    """The same rows through every export format."""
    rows, base = driver.blocks(spark, sf_dir, ["timestamp", "transaction_count"]), _scratch(spark, "export")
    out = None
    for fmt in ("csv", "json", "parquet"):
        path = os.path.join(base, fmt)
        W.export(rows, path, fmt)
        back = spark.read.schema(rows.schema).option("header", True).format(fmt).load(path)
        one = back.agg(F.lit(fmt).alias("fmt"), F.count("*").alias("blocks"), F.sum("transaction_count").alias("tx"),
                       F.max("timestamp").alias("newest"))
        out = one if out is None else out.unionByName(one)
    return out


@register("schema_diff", "JN-10 SRC-14 META-2", sql=with_(BLOCKS) + """
SELECT * FROM (VALUES
  ('timestamp', 'ok', (SELECT count("timestamp") FROM blocks)), ('number', 'ok', (SELECT count(number) FROM blocks)),
  ('gas_limit', 'ok', (SELECT count(gas_limit) FROM blocks)), ('gas_used', 'type_mismatch', (SELECT count(gas_used) FROM blocks)),
  ('base_fee_per_gas', 'ok', (SELECT count(base_fee_per_gas) FROM blocks)),
  ('transaction_count', 'ok', (SELECT count(transaction_count) FROM blocks)), ('size', 'missing_in_live', NULL),
  ('blob_gas_used', 'ok', (SELECT count(blob_gas_used) FROM blocks)),
  ('excess_blob_gas', 'ok', (SELECT count(excess_blob_gas) FROM blocks)), ('difficulty', 'ok', (SELECT count(difficulty) FROM blocks)),
  ('total_difficulty', 'ok', (SELECT count(total_difficulty) FROM blocks)), ('note', 'extra_in_live', 0)) t(name, status, present)""")
def schema_diff(spark, sf_dir):
    """Contract against a live table that lacks a column, has another and a changed type; with the live non-null counts."""
    live = driver.blocks(spark, sf_dir).drop("size").withColumn("gas_used", F.col("gas_used").cast("double")).withColumn(
        "note", F.lit(None).cast("string"))
    diff = C.schema_diff(spark, C.contract_schema("ethereum_mainnet"), live.schema)
    counts = rollup.column_profile(live).select(F.col("column").alias("name"), (F.col("rows") - F.col("nulls")).alias("present"))
    return diff.join(counts, "name", "left").select("name", "status", "present")


#: a third chain, declared in a file alone
TESTNET = """{"chain": "event_testnet", "columns": [
  {"name": "event_id", "type": "bigint", "nullable": false, "minimum": 100, "rank": 1, "comment": "key"},
  {"name": "user_id", "type": "bigint", "nullable": false},
  {"name": "value", "type": "double", "nullable": false, "minimum": 2.5},
  {"name": "fee", "type": "decimal(38,0)", "nullable": false, "since_block": 9000, "minimum": 0},
  {"name": "event_type", "type": "string"}]}"""


@register("contract_from_file", "SRC-14 DQ-1 DQ-2", sql="""
WITH t AS (SELECT event_id, value, event_id >= 9000 AS late FROM events)
SELECT rule, count(*) AS n_rows FROM (
  SELECT 'kept' AS rule FROM t WHERE event_id >= 100 AND value >= 2.5 AND NOT late
  UNION ALL SELECT 'event_id:minimum' FROM t WHERE event_id < 100
  UNION ALL SELECT 'value:minimum' FROM t WHERE value < 2.5
  UNION ALL SELECT 'fee:null' FROM t WHERE late) r GROUP BY rule""")
def contract_from_file(spark, sf_dir):
    """A chain that only a contract file knows: its table is read and held against the rules, without code for it."""
    path = os.path.join(_scratch(spark, "contract"), "event_testnet.json")
    spark.createDataFrame([(" ".join(TESTNET.split()),)], "value string").coalesce(1).write.text(path)
    C.load_contract(spark, path)
    good, bad = C.read_contract(spark, f"{sf_dir}/events.parquet", C.contract_schema("event_testnet"), key="event_id")
    rules = good.select(F.lit("kept").alias("rule")).unionByName(bad.select(F.explode("violations").alias("rule")))
    return rules.groupBy("rule").agg(F.count("*").alias("n_rows"))


@register("column_profile", "AGG-24", sql=with_(BLOCKS) + """
SELECT column_name AS column, rows, nulls FROM (
  SELECT 'number' AS column_name, count(*) AS rows, count(*) - count(number) AS nulls FROM blocks
  UNION ALL SELECT 'timestamp', count(*), count(*) - count("timestamp") FROM blocks
  UNION ALL SELECT 'blob_gas_used', count(*), count(*) - count(blob_gas_used) FROM blocks
  UNION ALL SELECT 'excess_blob_gas', count(*), count(*) - count(excess_blob_gas) FROM blocks) t""")
def column_profile(spark, sf_dir):
    b = driver.blocks(spark, sf_dir, ["timestamp", "blob_gas_used", "excess_blob_gas"])
    return rollup.column_profile(b).drop("type")


@register("copy_range", "SNK-6", sql=with_(BLOCKS) + """
SELECT number, "timestamp", gas_used FROM blocks
WHERE "timestamp" >= TIMESTAMP '2024-01-10 00:00:00' AND "timestamp" < TIMESTAMP '2024-01-13 00:00:00'""")
def copy_range(spark, sf_dir):
    """Copy three days of a stored table with several versions per block into another table, and read that."""
    base = _scratch(spark, "copy")
    src, dst = os.path.join(base, "src"), os.path.join(base, "dst")
    W.write_blocks(driver.raw_blocks(spark, sf_dir), src, mode="overwrite")
    W.copy_range(W.read_table(spark, src), dst, start="2024-01-10", end="2024-01-12")
    return W.read_table(spark, dst).select("number", "timestamp", "gas_used")


@register("stored_defaults", "FIL-9 SNK-1", sql=with_(BLOCKS) + """
SELECT number, CASE WHEN number % 3 = 0 THEN 0 ELSE base_fee_per_gas END AS base_fee_per_gas,
       CASE WHEN number % 5 = 0 THEN CAST(0 AS DECIMAL(38,0)) ELSE difficulty END AS difficulty,
       CASE WHEN number % 7 = 0 THEN CAST(0 AS DECIMAL(38,0)) ELSE total_difficulty END AS total_difficulty
FROM blocks""")
def stored_defaults(spark, sf_dir):
    """NULL base fees and difficulties are stored as 0."""
    b = driver.blocks(spark, sf_dir)
    for name, k in (("base_fee_per_gas", 3), ("difficulty", 5), ("total_difficulty", 7)):
        b = b.withColumn(name, F.when(F.col("number") % k != 0, F.col(name)))
    return D.normalise_blocks(b).select("number", "base_fee_per_gas", "difficulty", "total_difficulty")


@register("withdrawal_metrics", "AGG-20 FN-2", sql="""
SELECT o_orderkey AS number, CAST(count(l_orderkey) AS INTEGER) AS withdrawal_count,
       round(coalesce(CAST(sum(CAST(l_quantity AS BIGINT) * 1000000007) AS DOUBLE), 0) / 1e9, 9) AS total_eth_withdrawn,
       CASE WHEN count(l_orderkey) > 0 THEN round(CAST(sum(CAST(l_quantity AS BIGINT) * 1000000007) AS DOUBLE) / 1e9 / count(l_orderkey), 9)
            ELSE 0 END AS avg_withdrawal_eth, CAST(count(DISTINCT l_suppkey) AS INTEGER) AS unique_recipients
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""")
def withdrawal_metrics(spark, sf_dir):
    """An order as a block, its lines as withdrawals (hex gwei; at most seven a block)."""
    from gapseries.functions import hexcodec as H
    li = driver.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    w = F.struct(F.col("l_suppkey").cast("string").alias("address"),
                 H.long_to_hex(F.col("l_quantity").cast("bigint") * F.lit(1_000_000_007)).alias("amount"),
                 F.col("l_linenumber").cast("string").alias("index"), F.lit("0").alias("validatorIndex"))
    per = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(w).alias("withdrawals"))
    blocks = driver.table(spark, sf_dir, "orders").select("o_orderkey").join(per, "o_orderkey", "left")
    return round_doubles(rollup.withdrawal_metrics(blocks.withColumnRenamed("o_orderkey", "number")))


@register("missed_append", "SET-5 JN-6", sql=with_(SOURCES, _gaps_sql("src_primary", "pg"), _gaps_sql("src_backfill", "bg")) + """
SELECT DISTINCT number FROM (
  SELECT unnest(range(gap_start, gap_end + 1)) AS number FROM pg UNION ALL SELECT unnest(range(gap_start, gap_end + 1)) FROM bg) t""")
def missed_append(spark, sf_dir):
    """Keys missed by either source, each once."""
    missing = [G.missing_keys(driver.source_blocks(spark, sf_dir, which)) for which in ("primary", "backfill")]
    return sets.add_missed(*missing)


@register("gap_state_expiry", "GAP-8 GAP-4", sql=with_(BLOCKS, GAPS) + """
SELECT gap_start, gap_end, CASE WHEN gap_start % 4 = 0 THEN 'EXPIRED' WHEN gap_start % 4 = 1 THEN 'PERSISTENT' ELSE 'NOTIFIED' END AS status
FROM gaps WHERE gap_start % 4 < 3
UNION ALL SELECT gap_start, gap_end, 'NEW' FROM gaps WHERE gap_start % 4 IN (0, 3)""")
def gap_state_expiry(spark, sf_dir):
    """Tracked gaps not seen for a day expire (and count as new while they are still there)."""
    gaps = G.detect_gaps(driver.blocks(spark, sf_dir, ["number"]))
    now = F.lit(AS_OF).cast("timestamp")
    state = gaps.filter(F.col("gap_start") % 4 < 3).select(
        "gap_start", "gap_end", "gap_size", (now - F.expr("INTERVAL 2 DAYS")).alias("first_seen"),
        F.when(F.col("gap_start") % 4 == 0, now - F.expr("INTERVAL 25 HOURS")).otherwise(now - F.expr("INTERVAL 1 HOUR")).alias("last_seen"),
        (F.col("gap_start") % 4 == 2).alias("notified"))
    return G.update_gap_state(gaps, state, AS_OF, expire_h=24)[1].select("gap_start", "gap_end", "status")


@register("blocks_by_era", "META-2 JN-9", sql=with_(BLOCKS) + f"""
SELECT CASE WHEN number >= {driver.SCALED_DENCUN} THEN 'dencun' WHEN number >= {driver.SCALED_MERGE} THEN 'merge'
            ELSE 'london' END AS era, count(*) AS blocks, min(number) AS first_block
FROM blocks WHERE number >= {driver.SCALED_LONDON} GROUP BY 1""")
def blocks_by_era(spark, sf_dir):
    """The era table joined to the blocks on the half-open range (three eras, so Spark plans a broadcast)."""
    eras = C.protocol_eras(spark, driver.scaled_eras())
    b = driver.blocks(spark, sf_dir, ["number"])
    inside = (b["number"] >= eras["start_block"]) & (eras["end_block"].isNull() | (b["number"] < eras["end_block"]))
    return b.join(eras, inside).groupBy("era").agg(F.count("*").alias("blocks"), F.min("number").alias("first_block"))


BURST_SQL = """burst AS (SELECT view_id, user_id, view_value, CASE WHEN view_id % 3 = 0 THEN TIMESTAMP '2024-01-15 12:00:00' ELSE ts END AS ts
          FROM views)"""


@register("asof_burst", "JN-1 WIN-16", sql=with_(PURCHASES, VIEWS, BURST_SQL) + """
SELECT event_id, user_id, view_id FROM (
  SELECT p.event_id, p.user_id, b.view_id,
         row_number() OVER (PARTITION BY p.event_id ORDER BY b.ts DESC, b.view_id DESC) AS rn
  FROM purchases p LEFT JOIN burst b ON b.user_id = p.user_id AND b.ts <= p.ts) t WHERE rn = 1""")
def asof_burst(spark, sf_dir):
    """A third of the right rows share one timestamp: buckets of equal row counts split the burst."""
    v = driver.views(spark, sf_dir)
    v = v.withColumn("ts", F.when(F.col("view_id") % 3 == 0, F.lit("2024-01-15 12:00:00").cast("timestamp")).otherwise(F.col("ts")))
    p = driver.purchases(spark, sf_dir).select("event_id", "ts", "user_id")
    j = asof.asof_join(p, v.select("ts", "user_id", "view_id"), "ts", by="user_id", r_order=["view_id"], keep_right_ts=False,
                       skew_safe=True, bucket_rows=256)
    return j.select("event_id", "user_id", "view_id")


@register("time_gaps_burst", "GAP-2 WIN-16", sql=with_(VIEWS, BURST_SQL) + """
SELECT p AS gap_start, ts AS gap_end FROM (SELECT ts, lag(ts) OVER (ORDER BY ts, view_id) AS p FROM burst) t
WHERE epoch_us(ts) - epoch_us(p) > 450000000""")
def time_gaps_burst(spark, sf_dir):
    """Time gaps of a series with a burst of equal timestamps; the burst is measured and split by row count."""
    v = driver.views(spark, sf_dir)
    v = v.withColumn("ts", F.when(F.col("view_id") % 3 == 0, F.lit("2024-01-15 12:00:00").cast("timestamp")).otherwise(F.col("ts")))
    d = v.select("ts", "view_id")
    safe = ordered.crowded(d.select(ordered.bucket_expr(d, "ts").alias("b")), ["b"], limit=200)
    return G.detect_time_gaps(d, "ts", 300, 1.5, tiebreak=["view_id"], skew_safe=safe).select("gap_start", "gap_end")


def _mempool_json(ev):
    """A payload per event; each eleventh has no readable time, each thirteenth is no JSON."""
    when = F.when(F.col("event_id") % 11 == 0, F.lit("yesterday, 25:61")).otherwise(
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    payload = F.to_json(F.struct(when.alias("timestamp"), F.struct((F.col("user_id") * 100).alias("count")).alias("mempool")))
    return ev.select(F.when(F.col("event_id") % 13 == 0, F.lit("{broken")).otherwise(payload).alias("value"))


@register("mempool_stream", "STR-7 SRC-6 STR-11", sql="""
WITH e AS (SELECT *, event_id % 11 = 0 OR event_id % 13 = 0 AS bad, CAST(date_trunc('second', ts) AS TIMESTAMP) AS t FROM events),
g AS (SELECT t, lag(t) OVER (ORDER BY t) AS p FROM e WHERE NOT bad)
SELECT (SELECT count(*) FROM e WHERE NOT bad) AS snapshots, (SELECT count(*) FROM e WHERE bad) AS quarantined,
       (SELECT count(*) FROM g WHERE epoch_us(t) - epoch_us(p) > 600000000) AS late_steps""")
def mempool_stream(spark, sf_dir):
    """Landed snapshots as a stream: bad ones are set aside, the cadence (five minutes, twice at most) of the rest is checked."""
    base = _scratch(spark, "mempool")
    landed, out = os.path.join(base, "in"), os.path.join(base, "out")
    _mempool_json(driver.table(spark, sf_dir, "events")).repartition(3).write.text(landed)
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(landed)
    _finish(D.decode_mempool(stream, "value").writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", os.path.join(base, "ckpt")).outputMode("append").trigger(availableNow=True).start())
    good, bad = D.split_timed(spark.read.parquet(out))
    late = G.detect_time_gaps(good.select("timestamp"), "timestamp", 300, 2.0)
    row = ordered.with_row(good.agg(F.count("*").alias("snapshots")), bad.agg(F.count("*").alias("quarantined")))
    return ordered.with_row(row, late.agg(F.count("*").alias("late_steps")))


@register("fee_history_bad_rows", "SRC-7 STR-11", sql="""
SELECT event_id, CASE WHEN event_id % 5 > 1 THEN event_id END AS number,
       CASE WHEN event_id % 5 <> 0 AND event_id % 3 = 0 THEN CAST(1000 AS BIGINT) END AS base_fee_per_gas,
       CASE WHEN event_id % 5 <> 0 AND event_id % 3 = 0 THEN CAST(7 AS BIGINT) END AS reward_p25,
       CASE WHEN event_id % 5 <> 0 AND event_id % 3 <> 2 THEN CAST(9 AS BIGINT) END AS next_base_fee,
       event_id % 5 < 2 AS set_aside FROM events""")
def fee_history_bad_rows(spark, sf_dir):
    """Payloads with short reward and fee lists, bad hex, an unreadable block and no JSON at all, among good ones: none is lost."""
    ev = driver.table(spark, sf_dir, "events").select("event_id")
    block = F.when(F.col("event_id") % 5 == 1, F.lit("zz")).otherwise(F.lower(F.hex("event_id")))
    number = F.concat(F.lit('{"oldestBlock":"0x'), block, F.lit('","gasUsedRatio":[0.5],"baseFeePerGas":'))
    rest = F.get(F.array(F.lit('["0x3e8","0x9"],"reward":[["0x7","0x8","0x9"]]}'), F.lit('["0xzz","0x9"],"reward":[[]]}'),
                         F.lit('[],"reward":[]}')), (F.col("event_id") % 3).cast("int"))
    text = F.when(F.col("event_id") % 5 == 0, F.lit("not json")).otherwise(F.concat(number, rest))
    rows = D.decode_fee_history(ev.select("event_id", text.alias("json")), keep=["event_id"])
    good, bad = D.split_timed(rows, "number")
    kept = ["event_id", "number", "base_fee_per_gas", "reward_p25", "next_base_fee"]
    return good.select(*kept, F.lit(False).alias("set_aside")).unionByName(bad.select(*kept, F.lit(True).alias("set_aside")))


@register("klines_bad_rows", "SRC-8 STR-11", sql="""
SELECT count(*) FILTER (WHERE event_id % 7 < 3) AS bars, count(*) FILTER (WHERE event_id % 7 BETWEEN 3 AND 5) AS quarantined,
       count(*) FILTER (WHERE event_id % 7 IN (0, 2)) AS with_close, count(*) FILTER (WHERE event_id % 7 = 0) AS with_trades
FROM events""")
def klines_bad_rows(spark, sf_dir):
    """Short arrays, unreadable numbers, times beyond any year and no JSON at all among good bars: every row is decoded
    or set aside; an empty list stands for no bars."""
    ev = driver.table(spark, sf_dir, "events").select("event_id")
    t = F.concat(F.lit("[["), F.col("event_id").cast("string"))
    text = F.get(F.array(F.concat(t, F.lit(',"1","2","0.5","1.5","10",0,"0",7,"0","0","0"]]')), F.concat(t, F.lit(',"1"]]')),
                         F.concat(t, F.lit(',"1","2","0.5","1.5","n/a"]]')), F.lit('[["soon","1"]]'), F.lit('[[9223372036854775807,"1"]]'),
                         F.lit("not json"), F.lit("[]")), (F.col("event_id") % 7).cast("int"))
    good, bad = D.split_timed(D.decode_klines(ev.select(text.alias("json")), symbol=F.lit("X")), "ts")
    row = good.agg(F.count("*").alias("bars"), F.count("close").alias("with_close"), F.count("trades").alias("with_trades"))
    return ordered.with_row(row, bad.agg(F.count("*").alias("quarantined")))


@register("series_bad_rows", "SRC-9 STR-11 FN-3", sql="""
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN make_timestamp(event_id * 1000000) END AS ts,
       CAST(CASE WHEN event_id % 4 < 2 THEN 0.5 END AS DOUBLE) AS value FROM events""")
def series_bad_rows(spark, sf_dir):
    """Chart payloads: good points, times beyond any year, points without a time and text that is no JSON."""
    ev = driver.table(spark, sf_dir, "events").select("event_id")
    good = F.concat(F.lit('{"values":[{"x":'), F.col("event_id").cast("string"), F.lit(',"y":0.5}]}'))
    text = F.get(F.array(good, F.lit('{"values":[{"x":9223372036854775807,"y":0.5}]}'), F.lit('{"values":[{}]}'), F.lit("<html>")),
                 (F.col("event_id") % 4).cast("int"))
    return D.decode_series(ev.select("event_id", text.alias("json")), keep=["event_id"])


@register("windowed_correlation", "AGG-23", sql=with_(BLOCKS) + """
SELECT number, round(r, 9) AS corr_60 FROM (
  SELECT number, CASE WHEN count(*) OVER w >= 60 THEN covar_samp(gas_used, size) OVER w
         / nullif(stddev_samp(gas_used) OVER w * stddev_samp(size) OVER w, 0) END AS r
  FROM blocks WINDOW w AS (ORDER BY number ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)) t""")
def windowed_correlation(spark, sf_dir):
    b = driver.blocks(spark, sf_dir, ["gas_used", "size"])
    r = rollup.correlation(b, "gas_used", "size", window=60, order="number")
    return round_doubles(r.select("number", F.col("corr_gas_used_size_60").alias("corr_60")))


@register("wide_hex_round_trip", "FN-2 SRC-4", sql=with_(BLOCKS) + """
SELECT number, CAST(number AS DECIMAL(38,0)) * 1152921504606846976 - 1 AS total_difficulty FROM blocks WHERE number > 0""")
def wide_hex_round_trip(spark, sf_dir):
    """Wide decimals next to multiples of 2^60 survive encoding and decoding."""
    b = driver.blocks(spark, sf_dir).filter("number > 0").withColumn(
        "total_difficulty", F.expr("cast(cast(number as decimal(20,0)) * cast(1152921504606846976 as decimal(20,0)) - 1 as decimal(38,0))"))
    return D.decode_blocks(D.encode_blocks(driver.spread(b))).select("number", "total_difficulty")
